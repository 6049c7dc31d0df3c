"""Token ids of whole texts by the tokenizers library, with a table of known words in each Python worker.

Both vocabularies here cut a text before every single space, and around every line end, that stands
between other characters, so the ids of a text are those of its words in turn, each with the space or
line end before it. Distinct words of a unit of texts are looked up together; new ones are encoded by
the library and kept. A text with any other arrangement of white space, with a special token's string
or with a very long word is encoded whole by the library. The table only saves time.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from captionlake.llm.textkit import Words, blocks_of

#: Words that the table may hold, about 35 bytes each; beyond that the half that was used longest ago goes.
KNOWN_WORDS = 2_000_000
#: Longer words (in bytes) are not looked up by hash.
LONGEST_WORD = 256
_BETWEEN = np.ones(256, bool)
_BETWEEN[[10, 32]] = False
_AFTER_SPACE, _AFTER_LINE = np.uint64(0x9AE16A3B2F90404F), np.uint64(0xC949C7DEFA5A4E15)
_WHOLE = -1
#: New words that the library encodes in one call.
_AT_ONCE = 4096

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.line_end = self.whole("\n")
        self._keeps_space = len(self.line_end) > 0
        self._keys, self._at, self._size, self._last = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self._store, self._used, self._now = np.zeros(1 << 16, np.uint32), 0, 0

    def _forget(self) -> None:
        """Keep the words that were used last, at most half."""
        kept = np.flatnonzero(self._last > np.partition(self._last, len(self._last) // 2)[len(self._last) // 2])
        size = np.maximum(self._size[kept], 0).astype(np.int64)
        begin = np.cumsum(size) - size
        self._store = self._store[np.repeat(self._at[kept] - begin, size) + np.arange(int(size.sum()))]
        self._keys, self._at, self._size, self._last, self._used = self._keys[kept], begin, self._size[kept], self._last[kept], int(size.sum())

    def whole(self, text: str) -> np.ndarray:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[tuple[str, str]]) -> None:
        """Encode new words, given with what stands before them, and keep their ids."""
        plain = [word.split() == [word] and not any(s in word for s in self._special) for _, word in words]
        lead = lambda before: before if before == " " else ""
        at_once = [lead(b) + w for (b, w), ok in zip(words, plain) if ok]
        found = (e.ids for i in range(0, len(at_once), _AT_ONCE) for e in self._tokenizer.encode_batch_fast(at_once[i : i + _AT_ONCE], add_special_tokens=False))
        sizes, new, line_end = np.full(len(words), _WHOLE, np.int32), array("I"), self.line_end.tolist()
        for i, ((before, _), ok) in enumerate(zip(words, plain)):
            if ok:
                ids = line_end + next(found) if before == "\n" else next(found)
                new.extend(ids)
                sizes[i] = len(ids)
        new = np.frombuffer(new, np.uint32)
        if self._used + len(new) > len(self._store):
            self._store = np.concatenate([self._store[: self._used], np.zeros(max(len(new), len(self._store) // 4), np.uint32)])
        self._store[self._used : self._used + len(new)] = new
        at = self._used + np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
        self._used += len(new)
        where = np.searchsorted(self._keys, keys)
        self._keys, self._at, self._size = np.insert(self._keys, where, keys), np.insert(self._at, where, at), np.insert(self._size, where, sizes)
        self._last = np.insert(self._last, where, self._now)

    def _unit(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a run of texts, and how many each text has."""
        words = Words(data, offsets, _BETWEEN, fold=False)
        n = len(offsets) - 1
        # separators single and inside: as many bytes lie outside words as there are words less one
        inside = np.bincount(words.texts, words.ends - words.starts, n)
        simple = (words.counts > 0) & (np.diff(offsets) - inside == words.counts - 1)
        simple[words.texts[words.ends - words.starts > LONGEST_WORD]] = False
        keys = words.hashes
        first = np.zeros(len(keys), bool)
        first[words.first[words.counts > 0]] = True
        after_line = ~first & (data[np.maximum(words.starts - 1, 0)] == 10)
        if self._keeps_space:
            keys = np.where(first, keys, keys ^ np.where(after_line, _AFTER_LINE, _AFTER_SPACE))
        distinct, example, which = np.unique(keys, return_index=True, return_inverse=True)
        if len(self._keys) and len(self._keys) + len(distinct) > KNOWN_WORDS:
            self._forget()
        self._now += 1
        at = np.searchsorted(self._keys, distinct)
        known = self._keys[np.minimum(at, len(self._keys) - 1)] == distinct if len(self._keys) else np.zeros(len(distinct), bool)
        if not known.all():
            new = np.flatnonzero(~known)
            told = []
            for i in example[new].tolist():
                before = "" if first[i] or not self._keeps_space else "\n" if after_line[i] else " "
                told.append((before, data[words.starts[i] : words.ends[i]].tobytes().decode() if words.ends[i] - words.starts[i] <= LONGEST_WORD else ""))
            self._learn(distinct[new], told)
            at = np.searchsorted(self._keys, distinct)
        self._last[at] = self._now
        size, place = self._size[at][which], self._at[at][which]
        simple[words.texts[size == _WHOLE]] = False
        size = np.where(simple[words.texts], size, 0).astype(np.int64)
        before = np.cumsum(size) - size
        ids = self._store[np.repeat(place - before, size) + np.arange(int(size.sum()))]
        counts = np.bincount(words.texts, size, n).astype(np.int64)
        odd = np.flatnonzero(~simple & (np.diff(offsets) > 0))
        if len(odd):
            parts, ends, last = [], np.cumsum(counts), 0
            for i in odd.tolist():
                parts += [ids[last : ends[i]], self.whole(data[offsets[i] : offsets[i + 1]].tobytes().decode())]
                last, counts[i] = ends[i], len(parts[-1])
            ids = np.concatenate([*parts, ids[last:]])
        return ids, counts

    def units(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of texts (null: empty): first row, row after the last, all their ids, and how many each has."""
        for a, b, data, offsets in blocks_of(column, 2 << 20):
            yield a, b, *self._unit(data, offsets)


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1


def encoder(path: str) -> WordEncoder:
    """The encoder of a vocabulary file, one for each Python worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
