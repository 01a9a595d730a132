"""Secret scans with native expressions: keyword, access-key and hex rules, and sliding-window entropy."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

#: Fixed patterns of the base kinds. Letters of an assignment's keyword match in either case (ASCII).
KEYWORDS = "password|passwd|secret|token|api_?key"
ASSIGN = "(" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in KEYWORDS) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A whole run is 20+ (24+) long or no match in it is: the same spans as `+` with a length test after it.
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
ASSIGN_CHARS = 6

#: Entropy rule: candidate strings, the window, and by character class (the first that a candidate is wholly in) the
#: least bits a character of a window.
CANDIDATE, WINDOW = "[A-Za-z0-9+/_=-]{20,}", 20
CLASSES = [("hex", "^[0-9a-fA-F]+$", 3.0), ("upper", "^[0-9A-Z=_-]+$", 3.5), ("lower", "^[0-9a-z=_-]+$", 3.5), ("mixed", "^", 3.7)]
#: Allow-list: a candidate is not a secret if it has no digit, no letter, is a UUID, is a path or a dashed name of
#: plain words (nothing is left beside separators when these are taken out), or holds a placeholder.
WORDS = "[a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]{1,4}"
ALLOWED = [
    "^[^0-9]*$", "^[^A-Za-z]*$", "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "(?:example|EXAMPLE|xxxxxx|XXXXXX|abcdefgh|0123456789)",
]
#: c * log2(c) in millionths, so that sums are exact.
GAIN = [round(1e6 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]
#: The counts of a window's characters: five bits each, SLOTS of them in a long.
ALPHABET, SLOTS, COUNT_BITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 12, 5
#: Matches that are placed together, so that no array is copied for each match.
BLOCK = 64


def gain_limit(bits: float) -> int:
    """Largest sum of c*log2(c) over a window's counts whose entropy is still at least bits."""
    return math.floor(1e6 * WINDOW * (math.log2(WINDOW) - bits))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _located(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, whole, part) of the leftmost non-overlapping matches; starts in code points from 0.

    Starts are running sums of the lengths of gaps and matches, within blocks of BLOCK matches and then over blocks.
    """
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(F.zip_with(between, whole, lambda a, b: F.struct(F.length(a).alias("gap"), b.alias("whole"))), part,
                      lambda a, b: F.struct(a.gap.alias("gap"), a.whole.alias("whole"), b.alias("part")))
    one = "array<struct<start:int,whole:string,part:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(one).alias("found"))

    def place(s: Column, r: Column) -> Column:
        begin = s.at + r.gap
        return F.struct((begin + F.length(r.whole)).alias("at"), F.concat(s.found, F.array(F.struct(begin.alias("start"), r.whole.alias("whole"), r.part.alias("part")))).alias("found"))

    def within(all_rows: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.call_function("div", F.size(all_rows) - 1, F.lit(BLOCK)).cast("int"))
        return F.transform(blocks, lambda b: F.aggregate(F.slice(all_rows, b * BLOCK + 1, BLOCK), start, place))

    def over(s: Column, b: Column) -> Column:
        return F.struct((s.at + b.at).alias("at"), F.concat(s.bases, F.array(s.at)).alias("bases"))

    def moved(blocks: Column) -> Column:
        bases = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("bases")), over, lambda s: s.bases)
        return F.flatten(F.zip_with(blocks, bases, lambda b, base: F.transform(b.found, lambda m: F.struct((m.start + base).alias("start"), m.whole.alias("whole"), m.part.alias("part")))))

    # What stands after the last match is a gap without a match.
    found = _let(rows, lambda r: _let(within(F.slice(r, 1, F.size(r) - 1)), moved))
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(one))


def _spans(matches: Column, kind: str, order: int) -> Column:
    return F.transform(matches, lambda m: F.struct(m.start.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), (m.start + F.length(m.whole)).alias("end")))


def _entropy_hits(candidate: Column, limit: Column) -> Column:
    """(first, last) window start whose entropy is high enough; nulls if none.

    One pass over the characters carries the window's counts and the sum of c * log2(c) over them: a step takes the
    count of the character that enters one up and that of the one that leaves one down.
    """
    gains = F.array(*[F.lit(g) for g in GAIN])
    slots = {ord(c): k for k, c in enumerate(ALPHABET)}
    words = F.array(*[F.lit(slots.get(c, 0) // SLOTS) for c in range(128)])
    shifts = F.array(*[F.lit(COUNT_BITS * (slots.get(c, 0) % SLOTS)) for c in range(128)])
    nothing = F.lit(None).cast("int")
    empty = F.array(*[F.lit(0).cast("long")] * -(-len(ALPHABET) // SLOTS))
    begin = F.struct(F.lit(0).alias("sum"), empty.alias("counts"), nothing.alias("first"), nothing.alias("last"))

    def count(s: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(s["counts"], F.get(words, code)), F.get(shifts, code)).bitwiseAND(F.lit(31)).cast("int")

    def unit(code: Column, word: Column) -> Column:
        return F.when(F.get(words, code) == word, F.call_function("shiftleft", F.lit(1).cast("long"), F.get(shifts, code))).otherwise(F.lit(0).cast("long"))

    def seen(s: Column, at: Column) -> Column:
        """The window starting at `at` joins the hits if the carried sum says so."""
        hit = (at >= 0) & (s["sum"] <= limit)
        return F.struct(F.when(hit, F.coalesce(s["first"], at)).otherwise(s["first"]).alias("first"), F.when(hit, at).otherwise(s["last"]).alias("last"))

    def scan(codes: Column) -> Column:
        def fills(s: Column, i: Column) -> Column:
            new = F.get(codes, i)
            c = count(s, new)
            return F.struct((s["sum"] + F.get(gains, c + 1) - F.get(gains, c)).alias("sum"), F.transform(s["counts"], lambda x, w: x + unit(new, w)).alias("counts"), s["first"].alias("first"), s["last"].alias("last"))

        def slides(s: Column, i: Column) -> Column:
            new, old = F.get(codes, i), F.get(codes, i - WINDOW)
            enters, leaves = count(s, new), count(s, old)
            change = F.get(gains, enters + 1) - F.get(gains, enters) + F.get(gains, leaves - 1) - F.get(gains, leaves)
            hits = seen(s, i - WINDOW)
            moved = F.struct((s["sum"] + change).alias("sum"), F.transform(s["counts"], lambda x, w: x + unit(new, w) - unit(old, w)).alias("counts"), hits["first"].alias("first"), hits["last"].alias("last"))
            same = F.struct(s["sum"].alias("sum"), s["counts"].alias("counts"), hits["first"].alias("first"), hits["last"].alias("last"))
            return F.when(new == old, same).otherwise(moved)

        return F.aggregate(
            F.sequence(F.lit(0), F.size(codes) - 1), begin, lambda s, i: F.when(i < WINDOW, fills(s, i)).otherwise(slides(s, i)), lambda s: seen(s, F.size(codes) - WINDOW)
        )

    return _let(F.transform(F.split(candidate, ""), F.ascii), scan)


def _limit(candidate: Column) -> Column:
    """Largest sum of c * log2(c) that counts as a hit, by character class."""
    out = F.lit(gain_limit(CLASSES[-1][2]))
    for _, pattern, bits in reversed(CLASSES[:-1]):
        out = F.when(candidate.rlike(pattern), F.lit(gain_limit(bits))).otherwise(out)
    return out


def entropy_spans(text: Column) -> Column:
    """Spans of kind entropy: in each candidate that is not allowed, from its first window to its last one."""
    found = F.filter(_located(text, CANDIDATE), lambda m: ~_allowed(m.whole))
    scored = F.transform(
        found,
        lambda m: F.struct(m.start.alias("start"), _let(_limit(m.whole), lambda limit: _entropy_hits(m.whole, limit)).alias("hit")),
    )
    kept = F.filter(scored, lambda m: m.hit["first"].isNotNull())
    return F.transform(kept, lambda m: F.struct((m.start + m.hit["first"]).alias("start"), F.lit(4).alias("order"), F.lit("entropy").alias("kind"), (m.start + m.hit["last"] + WINDOW).alias("end")))


def _allowed(text: Column) -> Column:
    out = F.lit(False)
    for p in ALLOWED:
        out = out | text.rlike(p)
    # One separator is put before; possessive runs that start at their first separator keep the search linear.
    plain = f"(?<![/_=-])[/_=-]++({WORDS})(?=[/_=-]|$)"
    return out | F.regexp_replace(F.concat(F.lit("/"), text), plain, "").rlike("^[/_=-]*$")


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined; empty if there are none."""
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_assign, n_access, n_hex, n_entropy, base_sha256, spans.

    Spans are code points, end exclusive. Base kinds: an assignment to a keyword with a value of 6 or more characters,
    an access key, a hex run; the entropy rule adds spans and never removes one. A null text is an empty one: no spans,
    and base_sha256 of the empty string. Repeated rows give repeated results; only key and text are read.
    """
    body = F.col("_text")
    assign = F.filter(_located(body, ASSIGN, 2), lambda m: F.length(m.part) >= ASSIGN_CHARS)
    parts = docs.select(F.col(key), text_or_empty(text).alias("_text")).select(
        key,
        _spans(assign, "assign", 1).alias("a"), _spans(_located(body, ACCESS), "access", 2).alias("b"),
        _spans(_located(body, HEX), "hex", 3).alias("c"), entropy_spans(body).alias("d"),
    )
    count = [F.size(x).cast("long").alias(n) for x, n in zip("abcd", ("n_assign", "n_access", "n_hex", "n_entropy"), strict=True)]
    return parts.select(key, *count, F.sha2(_joined(F.concat("a", "b", "c")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat("a", "b", "c", "d")).alias("spans"))
