from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, row string, n_words string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "x", "y", "z") for i, t in rows], SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls in id and text, empty, blank, odd characters, a long text, ties and repeated rows."""
    long = " ".join(f"word{i % 997}x{i % 31}" for i in range(60_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "Hello World hello world"), (4, "Hello World hello world"), (5, "hello world HELLO WORLD"),
        (6, "　été 日本語 \x1c x y"), (7, long), (8, long), (None, "no id here at all"), (9, "<|endoftext|> token=abcdefgh12 AKIAABCDEFGHIJKL"), (10, "\x00 ퟿ 👍🏽"),
    ]
