"""Secrets in texts: known forms, and candidate strings of high entropy.

Three known forms (an assignment to a secret's name, an access key, a long
hexadecimal string) are found by pattern. Beside them every long unbroken string
of key characters is a candidate: a window slides over it, the counts of the
window's characters change by the one that enters and the one that leaves, and
with them the window's Shannon entropy. A candidate with a window at or above
the limit of its character class is a secret unless an allow-list pattern takes
it for a word, a path, an identifier or a placeholder.

DataFrame functions only, narrow: a row's arrays hold its matches. Positions come
from the lengths of matches and of the text between them, by running sums in
blocks, so that a text with very many matches costs no quadratic copying.

Counts of a window are kept as a string with one character for each symbol (its
code is the count), as replacing a character of a string is one copy. Entropy is
compared in integers: with T(n) = round(2^20 * n * log2(n)), a window of w
characters has log2(w) - sum(T(count)) / (2^20 * w) bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import text_of

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "entropy")

# The known forms, and the shortest length of what they name.
ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
          r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24

#: Characters of the window, and candidates: strings of at least as many.
WINDOW = 20
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}"
#: Character classes, the narrowest first, with the least bits of a window.
CLASSES = (("^[0-9a-fA-F]+$", 3.0), ("^[A-Za-z0-9]+$", 3.7), ("", 3.8))
#: Candidates that are no secrets.
ALLOWED = (
    "^[0-9]+$",                                                   # numbers
    "^(?:[A-Z]?[a-z]+|[A-Z]+)$",                                  # words
    "^(?:[A-Z]?[a-z]{2,})+[0-9]{0,4}$",                           # joined words
    "^[-_/+=]*(?:[A-Za-z]+|[0-9]{1,8})(?:[-_/+=]+(?:[A-Za-z]+|[0-9]{1,8}))*[-_/+=]*$",  # paths, slugs, names
    "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",     # UUIDs
    "(?i)example|sample|placeholder|changeme|dummy|x{6}|0{8}|1234567",
)

SCALE = 1 << 20
#: Symbols are '+' (43) to 'z' (122), and a count is a character from 'A' on.
SYMBOLS, FIRST_SYMBOL, NO_COUNT = 80, 42, 65
BLOCK = 256


def entropy_table(window: int) -> list[int]:
    """T(n) for n = 0 .. window."""
    return [round(SCALE * n * math.log2(n)) if n else 0 for n in range(window + 1)]


def entropy_limit(window: int, bits: float) -> int:
    """The greatest sum of T that still means ``bits`` bits."""
    return math.floor(SCALE * window * (math.log2(window) - bits))


def scan(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running ``op`` over an array of long, each element included: in blocks,
    then over the blocks' results. ``op`` has 0 as its neutral value."""
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")

    def running(items: Column, start: Column) -> Column:
        state = F.struct(none.alias("out"), start.alias("last"))

        def step(s: Column, x: Column) -> Column:
            now = op(s["last"], x)
            return F.struct(F.concat(s["out"], F.array(now)).alias("out"), now.alias("last"))

        return F.aggregate(items, state, step, lambda s: s["out"])

    n = F.size(values)
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                                       lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK))))
    ends = running(F.transform(blocks, lambda b: F.aggregate(b, zero, op)), zero)
    starts = F.concat(F.array(zero), ends)
    inner = F.transform(blocks, lambda b, i: running(b, F.get(starts, i)))
    return F.coalesce(F.flatten(inner), none)


def _found(df: DataFrame, kind: str, pattern: str, column: str = "text", size: Callable | None = None,
           least: int = 1) -> DataFrame:
    """Add ``kind``: the spans of the pattern's matches from left to right
    whose ``size`` (of the match, by default its length) is at least ``least``,
    as structs of start, kind's number, end and the match."""
    size = size or F.length
    m, gaps, ends = f"_{kind}_m", f"_{kind}_g", f"_{kind}_e"
    df = df.withColumn(m, F.regexp_extract_all(column, F.lit(pattern), F.lit(0)))
    between = F.transform(F.split(column, pattern, -1), lambda g: F.length(g).cast("bigint"))
    df = df.withColumn(gaps, F.when(F.size(m) > 0, F.zip_with(
        m, between, lambda x, g: F.when(x.isNotNull(), g + F.length(x)))))
    # The text behind the last match has no match of its own.
    df = df.withColumn(ends, F.when(F.size(m) > 0, scan(F.slice(gaps, 1, F.size(m)), lambda a, b: a + b)))
    spans = F.zip_with(m, ends, lambda x, e: F.struct(
        (e - F.length(x)).alias("start"), F.lit(KINDS.index(kind)).alias("kind"), e.alias("end"), x.alias("match")))
    kept = F.filter(F.coalesce(spans, F.array().cast("array<struct<start:bigint,kind:int,end:bigint,match:string>>")),
                    lambda s: size(s["match"]) >= least)
    return df.withColumn(kind, kept).drop(m, gaps, ends)


def least_sum(token: Column, window: int) -> Column:
    """Over all windows of an ASCII string, the least sum of T(count): that of
    the window of highest entropy."""
    table = F.array(*(F.lit(t).cast("bigint") for t in entropy_table(window)))
    symbols = F.transform(F.split(token, ""), lambda c: F.ascii(c) - FIRST_SYMBOL)
    n = F.length(token)
    leaving = F.concat(F.array_repeat(F.lit(0), F.lit(window)), F.slice(symbols, F.lit(1), n - window))
    # One event for each character that enters (+) or leaves (-), in order.
    events = F.flatten(F.zip_with(F.slice(symbols, F.lit(1), n), leaving,
                                  lambda e, x: F.when(x > 0, F.array(-x, e)).otherwise(F.array(e))))
    start = F.struct(F.lit(chr(NO_COUNT) * SYMBOLS).alias("counts"), F.lit(0).cast("bigint").alias("sum"),
                     F.lit(0).alias("entered"), F.lit(1 << 62).cast("bigint").alias("least"))

    def step(s: Column, e: Column) -> Column:
        at = F.abs(e)
        old = F.ascii(F.substr(s["counts"], at, F.lit(1))) - NO_COUNT
        new = old + F.signum(e).cast("int")
        total = s["sum"] + F.get(table, new) - F.get(table, old)
        entered = s["entered"] + (e > 0).cast("int")
        return F.struct(F.overlay(s["counts"], F.char(new + NO_COUNT), at).alias("counts"), total.alias("sum"),
                        entered.alias("entered"),
                        F.when((e > 0) & (entered >= window), F.least(s["least"], total))
                        .otherwise(s["least"]).alias("least"))

    return F.aggregate(events, start, step, lambda s: s["least"])


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
            classes: Sequence[tuple[str, float]] = CLASSES, allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs``; ``spans`` is an array of
    ``kind, start, end`` by start, then kind as in ``KINDS``, in code points, the
    end excluded.

    Spans of the known forms are always there. A candidate's span (``entropy``)
    is added if one of its windows reaches the bits of the first class that has
    all its characters, no allowed pattern is found in it, and no span of a known
    form covers it.

    A null text counts as empty and has no spans. Each row is taken by itself,
    whole; an empty table gives an empty result. Other columns are not read.
    """
    df = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    df = _found(df, "assign", ASSIGN, size=lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)), least=ASSIGN_LENGTH)
    df = _found(df, "access", ACCESS, least=ACCESS_LENGTH)
    # A maximal run of one class that is too short holds no longer match.
    df = _found(df, "hex", "[0-9a-f]{%d,}" % HEX_LENGTH)
    df = _found(df, "entropy", CANDIDATE % window)

    def limit(token: Column) -> Column:
        least = F.lit(None).cast("bigint")
        for pattern, bits in reversed(classes):
            least = F.when(token.rlike(pattern), F.lit(entropy_limit(window, bits)).cast("bigint")).otherwise(least)
        return least

    def dense(s: Column) -> Column:
        ok = F.lit(True)
        for pattern in allowed:
            ok = ok & ~s["match"].rlike(pattern)
        return ok & (least_sum(s["match"], window) <= limit(s["match"]))

    entropy = KINDS.index("entropy")
    df = df.select("doc_id", F.array_sort(F.concat("assign", "access", "hex", F.filter("entropy", dense))).alias("all"))
    known = F.transform("all", lambda s: F.when(s["kind"] == entropy, 0).otherwise(s["end"]).cast("bigint"))
    df = df.withColumn("covered", scan(known, lambda a, b: F.greatest(a, b)))
    spans = F.zip_with("all", "covered", lambda s, c: F.when(
        (s["kind"] < entropy) | (c < s["end"]),
        F.struct(F.get(F.array(*map(F.lit, KINDS)), s["kind"]).alias("kind"), s["start"].alias("start"),
                 s["end"].alias("end"))))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return df.select("doc_id", F.coalesce(F.array_compact(spans), none).alias("spans"))


def secret_digests(docs: DataFrame) -> DataFrame:
    """Per document: how many spans of each known form, the digest of these
    spans, and all spans, written as kind:start:end and comma-joined."""
    found = secrets(docs)

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    counts = map(number, KINDS[:3])
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
