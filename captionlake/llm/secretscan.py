"""Secret scans in DataFrame expressions only: fixed patterns plus sliding-window entropy.

Base kinds are regular expressions. The method adds spans: over maximal candidate strings of one
character class, a window of fixed width slides along and the Shannon entropy of its characters is
kept up to date by two count changes a step (one character in, one out). A candidate with a window
at or above the class's threshold is reported from its first such window to the end of its last.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from captionlake.llm.common import let, spread

#: The base patterns, in the order in which kinds are listed.
BASE_PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{12,}+",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32,}+",
}
MIN_ASSIGNED = 8


@dataclass(frozen=True)
class EntropyClass:
    """Candidates are maximal runs of at least ``window`` (at most 31) characters of ``alphabet``; those of one letter case have a threshold of their own."""

    kind: str
    char_class: str
    alphabet: str
    threshold: float
    one_case: float
    window: int = 20


HEX_CLASS = EntropyClass("entropy_hex", "0-9A-Fa-f", "0123456789abcdef", 3.0, 3.0)
BASE64_CLASS = EntropyClass("entropy_base64", "A-Za-z0-9+/_-", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.7, 3.5)

#: Candidates that match one of these are never reported: no digit, no letter, UUIDs and numbered paths.
ALLOWED = (
    "^[^0-9]*$",
    "^[^A-Za-z]*$",
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "^[A-Za-z/_-]+[0-9]{1,4}$",
)
#: Nor are spans whose own characters do, though the rest of their candidate may be random: dates and sequences.
ALLOWED_SPANS = ("^[0-9]{4}[-/_][0-9]{2}[-/_][0-9]{2}[^0-9A-Za-z]?[A-Za-z/_-]*$", "(?i)^(?:0123456789abcdef|abcdefghijklmnop|1234567890)+[0-9a-z]{0,9}$")
#: Matches whose places are summed up in one fold.
BLOCK = 256
#: Counts of a window, five bits each, packed into 64-bit words.
_PACKED = 12


def _span_type() -> str:
    return "array<struct<start:int,end:int,kind:string,rank:int>>"


def _located(text: Column, pattern: str, group_length: tuple[int, int] | None, rank: int, kind: str) -> Column:
    """Matches with their places, from the lengths of the pieces between matches and of the matches.

    Lengths are summed up within blocks of matches and over the blocks, so no array grows match by match.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = _span_type().replace(">>", ",m:string>>")
    none = F.array().cast(kept)

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), x["m"].alias("m"))
        return F.struct(end.alias("at"), F.array_append(state["out"], span).alias("out"))

    def block(state: Column, rows: Column) -> Column:
        start = F.struct(state["at"].alias("at"), none.alias("out"))
        return let(F.aggregate(rows, start, step), lambda s: F.struct(s["at"].alias("at"), F.array_append(state["out"], s["out"]).alias("out")))

    def spans(found: Column) -> Column:
        rows = F.zip_with(found, F.slice(F.split(text, pattern), 1, F.size(found)), lambda m, gap: F.struct(m.alias("m"), gap.alias("gap")))
        last = F.floor((F.size(found) - 1) / BLOCK).cast("int")

        def blocks(rows: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(rows, i * BLOCK + 1, F.lit(BLOCK)))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kept}>").alias("out"))
        placed = F.flatten(F.aggregate(let(rows, blocks), start, block, lambda s: s["out"]))
        if group_length:
            placed = F.filter(placed, lambda x: F.length(F.regexp_extract(x["m"], pattern, group_length[0])) >= group_length[1])
        return F.when(F.size(found) > 0, placed).otherwise(none)

    return let(matches, spans)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda x: x.dropFields("m"))


def base_spans(text: Column) -> Column:
    """All base spans of a non-null text as (start, end, kind, rank), by start and then kind as listed."""
    none = F.array().cast(_span_type())
    found = []
    for rank, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        spans = _plain(_located(text, pattern, (2, MIN_ASSIGNED) if kind == "assign" else None, rank, kind))
        found.append(F.when(F.contains(text, F.lit("AKIA")), spans).otherwise(none) if kind == "access" else spans)
    return F.array_sort(F.concat(*found), _by_start)


def _by_start(a: Column, b: Column) -> Column:
    key = lambda x: F.struct(x["start"], x["rank"], x["end"])
    return F.when(key(a) < key(b), F.lit(-1)).when(key(a) > key(b), F.lit(1)).otherwise(F.lit(0))


def _entropy_hull(candidate: Column, kind: EntropyClass) -> Column:
    """(first, last) window starts at or above the threshold, null where no window is.

    The counts of a window's characters are packed into a few words. A step changes two of them by one
    (one character in, one out) and the entropy by these two, so a candidate costs its length.
    """
    w, alphabet = kind.window, kind.alphabet
    folded = F.lower(candidate) if alphabet == alphabet.lower() else candidate
    words = -(-len(alphabet) // _PACKED)
    place = {ord(c): i for i, c in enumerate(alphabet)}
    # by ASCII code: the word of a character's count, and the count's bit in it
    word_of = F.array(*[F.lit(place.get(c, 0) // _PACKED) for c in range(128)])
    bit_of = F.array(*[F.lit(5 * (place.get(c, 0) % _PACKED)) for c in range(128)])
    weight = F.array(*[F.lit(n * log2(n) if n else 0.0) for n in range(w + 2)])
    state = F.struct(F.array_repeat(F.lit(0).cast("bigint"), words).alias("n"), F.lit(0.0).alias("s"), F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))
    threshold = F.when(F.rlike(candidate, F.lit("[a-z]")) & F.rlike(candidate, F.lit("[A-Z]")), F.lit(kind.threshold)).otherwise(F.lit(kind.one_case))

    def over(chars: Column, least: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            into, out = F.get(chars, k), F.get(chars, k - w)
            count = lambda n, c: F.call_function("shiftright", F.get(n, c["word"]), c["bit"]).bitwiseAND(F.lit(31)).cast("int")
            unit = lambda c: F.call_function("shiftleft", F.lit(1).cast("bigint"), c["bit"])
            # one out, where the window is full
            left = F.when(k >= w, F.transform(acc["n"], lambda v, i: F.when(i == out["word"], v - unit(out)).otherwise(v))).otherwise(acc["n"])
            less = F.when(k >= w, let(count(acc["n"], out), lambda n: F.get(weight, n - 1) - F.get(weight, n))).otherwise(F.lit(0.0))

            def grown(n: Column) -> Column:
                more = let(count(n, into), lambda c: F.get(weight, c + 1) - F.get(weight, c))
                total = acc["s"] + less + more
                return let(
                    F.struct(total.alias("s"), ((k >= w - 1) & (F.lit(log2(w)) - total / w >= least)).alias("hit")),
                    lambda t: F.struct(
                        F.transform(n, lambda v, i: F.when(i == into["word"], v + unit(into)).otherwise(v)).alias("n"), t["s"].alias("s"),
                        F.when(t["hit"], F.coalesce(acc["first"], k - (w - 1))).otherwise(acc["first"]).alias("first"),
                        F.when(t["hit"], k - (w - 1)).otherwise(acc["last"]).alias("last"),
                    ),
                )

            return let(left, grown)

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), state, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    one = lambda c: F.struct(F.get(word_of, F.ascii(c)).alias("word"), F.get(bit_of, F.ascii(c)).alias("bit"))
    chars = F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), one)
    return let(F.struct(chars.alias("c"), threshold.alias("t")), lambda x: over(x["c"], x["t"]))


def entropy_spans(text: Column, kind: EntropyClass, rank: int, allow: tuple[str, ...] = ALLOWED, allow_strings: tuple[str, ...] = (), allow_spans: tuple[str, ...] = ALLOWED_SPANS) -> Column:
    """Spans that the entropy of ``kind`` finds in a non-null text, in order."""
    cls = kind.char_class
    pattern = f"(?<![{cls}])[{cls}]{{{kind.window},}}+"
    none = F.array().cast(_span_type())

    def wanted(found: Column, rules: tuple[str, ...]) -> Column:
        good = ~found.isin(*allow_strings) if allow_strings else F.lit(True)
        for rule in rules:
            good = good & ~F.rlike(found, F.lit(rule))
        return good

    def hulls(spans: Column) -> Column:
        def one(x: Column) -> Column:
            hull = F.when(wanted(x["m"], allow), _entropy_hull(x["m"], kind))
            found = lambda h: F.substring(x["m"], h["first"] + 1, h["last"] + kind.window - h["first"])
            return let(
                hull,
                lambda h: F.struct(F.when(wanted(found(h), allow_spans), x["start"] + h["first"]).alias("start"), (x["start"] + h["last"] + kind.window).alias("end"), F.lit(kind.kind).alias("kind"), F.lit(rank).alias("rank")),
            )

        return F.when(F.size(spans) > 0, F.filter(F.transform(spans, one), lambda x: x["start"].isNotNull())).otherwise(none)

    return let(_located(text, pattern, None, rank, kind.kind), hulls)


def secret_spans(text: Column, allow: tuple[str, ...] = ALLOWED, allow_strings: tuple[str, ...] = ()) -> Column:
    """A struct of ``base`` and ``spans``: base spans, and those with the method's spans that no single base span contains."""

    def added(base: Column) -> Column:
        more = [entropy_spans(text, kind, len(BASE_PATTERNS) + i, allow, allow_strings) for i, kind in enumerate((HEX_CLASS, BASE64_CLASS))]
        clear = F.filter(F.concat(*more), lambda x: ~F.exists(base, lambda b: (b["start"] <= x["start"]) & (x["end"] <= b["end"])))
        return F.struct(base.alias("base"), F.array_sort(F.concat(base, clear), _by_start).alias("spans"))

    return let(base_spans(text), added)


def spans_string(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: tuple[str, ...] = ALLOWED, allow_strings: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``base`` and ``spans`` as arrays of (start, end, kind, rank).

    Offsets count code points, ends are exclusive. Null text counts as empty and has no span. Texts of
    any length are read whole, and a candidate costs time by its length. Repeated rows and ids, a null
    id among them, give a row each, an empty table an empty result; other columns, whatever their names,
    are not read.
    """
    found = secret_spans(F.coalesce(F.col(text_col), F.lit("")), allow, allow_strings)
    rows = spread(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)))
    return rows.select("doc_id", found.alias("s")).select("doc_id", "s.base", "s.spans")


def redact(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """``text`` with each maximal stretch that spans (sorted by start) cover replaced by ``mask``."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,size:int>>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        fresh = F.struct(state["at"].alias("from"), (x["start"] - state["at"]).alias("size"))
        joined = (x["start"] < state["at"]) & (state["at"] > 0)
        out = F.when(joined, state["out"]).otherwise(F.array_append(state["out"], fresh))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    def kept(state: Column) -> Column:
        gaps = F.array_append(state["out"], F.struct(state["at"].alias("from"), F.length(text).alias("size")))
        return F.array_join(F.transform(gaps, lambda g: F.substring(text, g["from"] + 1, g["size"])), mask)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, kept)).otherwise(text)
