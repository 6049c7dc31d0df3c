"""Chat formatting into budgeted windows.

Turns are counted as they are written, escaped and between their control strings. Prefix sums of these
counts cut a conversation into blocks of many windows, which tasks take one by one. In a block each
window begins where the one before ended and takes turns while they fit, so spans end with turns. A
window begins with the conversation's system turn and with as many of the turns before its span as fit
the history limit and what the span leaves of the budget; these repeat and are masked, so every
assistant turn is a target exactly once.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n``. Inside roles and texts, ``<``, any number of
backslashes and ``|`` get one backslash more; so no control string occurs there, and taking one
backslash away gives the text back. Roles also write a line end as ``\\n`` and a backslash twice.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from captionlake.llm.common import materialize
from captionlake.llm.tokens import encoder

BEGIN, STOP = "<|im_start|>", "<|im_end|>\n"
#: A block of a conversation holds turns that begin within so many budgets' worth of tokens.
BLOCK_WINDOWS = 64
_ESCAPED = re.compile(r"<(\\*)\\\|")
_TO_ESCAPE = re.compile(r"<(\\*)\|")


@dataclass(frozen=True)
class ChatBudget:
    """Tokens of a window, of repeated history in it at most, and what new turns may take of it at least, where the system turn leaves that much."""

    window: int = 2048
    history: int = 512
    least: int = 256

    def span(self, system: int) -> int:
        """Tokens that new turns after a system turn may take, so that history has room."""
        return max(self.window - system - self.history, min(self.least, self.window - system), 0)


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def _placed(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Turns, formatted, with their tokens ``n``, ``idx`` (place in the conversation) and ``before`` (tokens of turns before it)."""
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(parts, "k", "turn", "h").sortWithinPartitions("k", "turn", "h", "role", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, at, idx, before = encoder(tokenizer_path), None, 0, 0
        for batch in batches:
            heads = [f"{BEGIN}{escape_role(r)}\n" for r in batch.column("role").to_pylist()]
            # the last line end stands by itself; without it, words are looked up
            texts = [head + escape(t.as_py()) + STOP[:-1] for head, t in zip(heads, batch.column("text"))]
            bare = pa.array(texts, pa.large_string())
            sizes = np.concatenate([np.zeros(0, np.int64), *(counts + len(encode.line_end) for _, _, _, counts in encode.units(bare))])
            out = []
            for k, n in zip(batch.column("k").to_pylist(), sizes.tolist()):
                if k != at:
                    at, idx, before = k, 0, 0
                out.append((idx, before, n))
                idx, before = idx + 1, before + n
            numbers = [pa.array(list(map(len, heads)), pa.int32()), *(pa.array([r[i] for r in out], pa.int64()) for i in range(3))]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("conv_id"), batch.column("role"), pa.array([t + STOP[-1] for t in texts], pa.string()), batch.column("part"), *numbers], names=["k", "conv_id", "role", "text", "part", "head", "idx", "before", "n"])

    kind = turns.schema["conv_id"].dataType.simpleString()
    dealt = dealt.select("k", "conv_id", "role", "text", F.spark_partition_id().alias("part"))
    local = materialize(dealt.mapInArrow(count, f"k string, conv_id {kind}, role string, text string, part int, head int, idx bigint, before bigint, n bigint"), "chat-turns")
    # only the first conversation of a partition can go on from the one before: at most one row for each partition
    sums = local.groupBy("k", "part").agg(F.sum("n").alias("n"), F.count("*").alias("m"))
    earlier = Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("k", "part", F.sum("n").over(earlier).alias("more"), F.sum("m").over(earlier).alias("rows")).where("rows > 0")
    carried = F.broadcast(carried) if carried.count() <= 10_000 else carried
    zero = F.lit(0).cast("bigint")
    return local.join(carried, ["k", "part"], "left").select(
        "k", "conv_id", "role", "text", "head", "n", (F.col("idx") + F.coalesce("rows", zero)).alias("idx"), (F.col("before") + F.coalesce("more", zero)).alias("before")
    )


#: What a row of a block is, in order: the system turn, turns of the block before it, and its own.
_SYSTEM, _EARLIER, _OWN = 0, 1, 2


@dataclass
class _Turn:
    idx: int
    text: str
    n: int
    #: code points before the text proper, if it is a target
    head: int | None


def _windows(system: _Turn | None, turns: Iterator[tuple[int, _Turn]], budget: ChatBudget) -> Iterator[tuple[int, str, int, list[dict], int]]:
    """(first turn, text, repeated turns, spans of targets, tokens) of one block's windows; ``turns`` come with their kind, in order."""
    fixed = system.n if system else 0
    past: deque[_Turn] = deque()
    held, own, used = 0, [], 0

    def recall(turn: _Turn) -> None:
        nonlocal held
        past.append(turn)
        held += turn.n
        while past and held > budget.history:
            held -= past.popleft().n

    def out() -> tuple[int, str, int, list[dict], int]:
        first = own[0].idx
        lead, room = [system] if system and first else [], 0
        repeated: list[_Turn] = []
        room = min(budget.history, budget.window - used - (fixed if lead else 0))
        for turn in reversed(past):
            if turn.n > room:
                break
            repeated.append(turn)
            room -= turn.n
        context, spans, at = [*lead, *reversed(repeated)], [], 0
        at = sum(len(t.text) for t in context)
        for turn in own:
            if turn.head is not None:
                spans.append({"start": at + turn.head, "end": at + len(turn.text) - len(STOP)})
            at += len(turn.text)
        return first, "".join(t.text for t in [*context, *own]), len(context), spans, used + sum(t.n for t in context)

    for kind, turn in turns:
        if kind == _EARLIER:
            recall(turn)
            continue
        # nothing can be repeated in a conversation's first window, so that may be full
        if own and used + turn.n > (budget.window if own[0].idx == 0 else budget.span(fixed)):
            yield out()
            for t in own:
                if not (system and t.idx == 0):
                    recall(t)
            own, used = [], 0
        own.append(turn)
        used += turn.n
    if own:
        yield out()


def format_conversations(conversations: DataFrame, tokenizer_path: str, budget: ChatBudget = ChatBudget(), conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per window: ``conv_id``, ``first_turn`` (place of its first new turn), ``text``, ``n_context``, ``loss_spans`` and ``n_tokens``.

    The first ``n_context`` turns in ``text`` are repeated. ``loss_spans`` are code-point intervals of
    the escaped texts of new assistant turns. A first turn whose role is ``system`` is the system turn.
    A window keeps the budget in tokens, as written, but for one of a single new turn that is too long
    for it next to the system turn; nothing else is repeated there.

    Null roles and texts are empty; rows with a null conversation are one conversation; null turns come
    first, and equal turn numbers are ordered by the hash of role and text. Repeated rows are turns of
    their own. An empty table gives no windows. Long texts are not cut, and long conversations are dealt
    out in blocks of about ``block_windows`` windows, whose last one may be short. Other columns,
    whatever their names, are not read.
    """
    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = conversations.schema[conv_col].dataType.simpleString()
    turns = conversations.select(
        F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("k"), F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    ).withColumn("h", F.xxhash64("role", "text"))
    placed = materialize(_placed(turns, tokenizer_path), "chat-placed")
    size = max(block_windows * budget.window, budget.history)
    placed = placed.withColumn("block", F.floor(F.col("before") / size))
    placed = placed.withColumn("last", F.floor((F.col("before") + budget.history) / size))
    columns = ["k", "block", "conv_id", "role", "text", "head", "n", "idx"]
    own = placed.select(*columns, F.lit(_OWN).alias("kind"))
    earlier = placed.where("last > block AND NOT (idx = 0 AND role = 'system')").select("k", F.col("last").alias("block"), *columns[2:], F.lit(_EARLIER).alias("kind"))
    # a system turn goes to all later blocks of its conversation, of which there is a row each
    system = placed.where("idx = 0 AND role = 'system'").select("k", "conv_id", "role", "text", "head", "n", "idx")
    blocks = placed.where("block > 0").select("k", "block").distinct()
    repeated = blocks.join(system, "k").select(*columns, F.lit(_SYSTEM).alias("kind"))
    dealt = own.unionByName(earlier).unionByName(repeated).repartition(parts, "k", "block").sortWithinPartitions("k", "block", "kind", "idx")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c) for c in ("k", "block", "conv_id", "role", "text", "head", "n", "idx", "kind"))))
        row, out, chars = next(rows, None), [], 0
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

        def table(conv_type: pa.DataType) -> pa.RecordBatch:
            types = (conv_type, pa.int64(), pa.string(), pa.int32(), spans, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["conv_id", "first_turn", "text", "n_context", "loss_spans", "n_tokens"])

        while row is not None:
            block, conv, system = (row[0].as_py(), row[1].as_py()), row[2], None

            def turns() -> Iterator[tuple[int, _Turn]]:
                nonlocal row, system
                while row is not None and (row[0].as_py(), row[1].as_py()) == block:
                    role, text, head, n, idx, what = (v.as_py() for v in row[3:])
                    yield what, _Turn(idx, text, n, head if role == "assistant" else None)
                    row = next(rows, None)

            own = turns()
            head = next(own)
            if head[0] == _SYSTEM:
                system, lead = head[1], []
            else:
                lead = [head]
                if head[1].idx == 0 and row[3].as_py() == "system":
                    system = head[1]

            def rest(lead: list = lead, own: Iterator = own) -> Iterator[tuple[int, _Turn]]:
                yield from lead
                yield from own

            for found in _windows(system, rest(), budget):
                out.append((conv.as_py(), *found))
                chars += len(found[1])
                if len(out) >= 256 or chars >= 4 << 20:
                    yield table(conv.type)
                    out, chars = [], 0
        if out:
            yield table(conv.type)

    return dealt.mapInArrow(run, f"conv_id {kind}, first_turn bigint, text string, n_context int, loss_spans array<struct<start:int,end:int>>, n_tokens bigint")


def parse_window(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    out = []
    for turn in text.split(STOP)[:-1]:
        role, _, body = turn[len(BEGIN) :].partition("\n")
        out.append((unescape_role(role), unescape(body)))
    return out


def read_conversations(windows: DataFrame) -> DataFrame:
    """Digests of every conversation, read back from its windows: turns in order, and the text under the loss mask."""
    parts = int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = windows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = object(), None

        def done() -> pa.RecordBatch:
            n, turns, chars, loss, formatted = state
            return pa.RecordBatch.from_arrays([pa.array([at], arrow_type), *(pa.array([v]) for v in (n, turns.hexdigest(), chars, loss.hexdigest(), formatted))], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            arrow_type = batch.column("conv_id").type
            for conv, text, skip, spans in zip(*(batch.column(c) for c in ("conv_id", "text", "n_context", "loss_spans"))):
                if conv.as_py() != at:
                    if state:
                        yield done()
                    at, state = conv.as_py(), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = text.as_py()
                for role, body in parse_window(text)[skip.as_py() :]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8", "surrogatepass"))
                for span in spans.as_py():
                    target = unescape(text[span["start"] : span["end"]])
                    state[2] += len(target)
                    state[3].update(target.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
        if state:
            yield done()

    dealt = windows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "first_turn")
    return dealt.mapInArrow(run, f"conv_id {id_type}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def write_windows(windows: DataFrame) -> DataFrame:
    """Write the formatted windows into the shared folder and read them back."""
    return materialize(windows, "chat-windows")
