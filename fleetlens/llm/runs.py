"""Runs (maximal repetitions) of words by an enhanced suffix array.

A square is a stretch of 2d words whose halves are equal; it branches where the
word behind it differs from the word d places before. A run of period d has one
branching square, its last 2d words, so the branching squares give all runs:

1. the suffix array of a slice of texts by prefix doubling (a word's number is
   its own text's, so texts never share a prefix and need one array);
2. the LCP array, by the ranks of the doublings;
3. the LCP intervals, by a stack of depths over the LCP array. There are no tree
   nodes: an interval is its depth and its borders in the suffix array;
4. the branching-tandem test: for each interval of depth d, each suffix i outside
   its largest child, is i + d or i - d in the interval too (by the inverse
   suffix array) and the next word another? A suffix is in the smaller children
   of at most log n intervals;
5. squares rotate left word by word while they stay squares; a square inside a
   run of a smaller period with the same end is that run's, and goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import SPACE, slices, text_of

#: Characters of texts in one suffix array; a longer text has its own.
CHARS = 1 << 20

RESULT = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_array(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, inverse, and the ranks after each doubling: suffixes have
    the same rank in the k-th if their first 2**k words are the same."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.empty(n, np.int64)
    starts = np.flatnonzero(np.append(True, words[order][1:] != words[order][:-1]))
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    ranks, step = [rank.astype(np.int32)], 1
    sizes = np.diff(np.append(starts, n))
    open_ = order[np.repeat(sizes, sizes) > 1]  # suffixes of groups of two and more, in order
    while len(open_):
        ahead = open_ + step
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        key = rank[open_] * (n + 1) + second
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(starts, len(key)))
        # A group starts in the array where its old group did, plus its place there.
        old = key // (n + 1)
        old_start = np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        offset = np.arange(len(old)) - np.repeat(old_start, np.diff(np.append(old_start, len(old))))
        rank[open_] = np.repeat((old + offset)[starts], sizes)
        open_ = open_[np.repeat(sizes, sizes) > 1]
        step *= 2
        ranks.append(rank.astype(np.int32))
    array = np.empty(n, np.int64)
    array[rank] = np.arange(n)
    return array, rank, ranks


def lcp_array(array: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array; 0
    for the first, and one 0 behind the last."""
    n = len(array)
    lcp = np.zeros(n + 1, np.int64)
    which = np.arange(1, n)
    left, right = array[:-1].copy(), array[1:].copy()
    for k in range(len(ranks) - 1, -1, -1):
        there = np.flatnonzero((left < n) & (right < n))
        same = there[ranks[k][left[there]] == ranks[k][right[there]]]
        lcp[which[same]] += 1 << k
        left[same] += 1 << k
        right[same] += 1 << k
    return lcp


def smaller_children(lcp: np.ndarray) -> np.ndarray:
    """Rows (start, stop, left, right, depth): for every LCP interval
    [left, right) of a depth of 1 or more, the parts of it beside its largest
    child, as stretches of the suffix array."""
    found: list[tuple[int, int, int, int, int]] = []
    # Per open interval: its depth, left border, and its largest child so far.
    depth, left, best_lo, best_hi = [0], [0], [0], [0]
    for k, h in enumerate(lcp.tolist()[1:], 1):
        lo = k - 1  # the child that ends here: a suffix, or the interval closed last
        while depth[-1] > h:
            d, start, b_lo, b_hi = depth.pop(), left.pop(), best_lo.pop(), best_hi.pop()
            if k - lo > b_hi - b_lo:
                b_lo, b_hi = lo, k
            if b_lo > start:
                found.append((start, b_lo, start, k, d))
            if b_hi < k:
                found.append((b_hi, k, start, k, d))
            lo = start
        if depth[-1] < h:
            depth.append(h)
            left.append(lo)
            best_lo.append(lo)
            best_hi.append(k)
        elif k - lo > best_hi[-1] - best_lo[-1]:
            best_lo[-1], best_hi[-1] = lo, k
    return np.array(found, np.int64).reshape(-1, 5)


def branching_squares(words: np.ndarray, array: np.ndarray, inverse: np.ndarray, parts: np.ndarray,
                      at_once: int = 1 << 20) -> np.ndarray:
    """Rows (end, period) of all branching squares, by end, then period."""
    n = len(words)
    behind = np.append(words, -1)
    ends, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    cuts = np.searchsorted(np.cumsum(parts[:, 1] - parts[:, 0]), np.arange(at_once, n * 64, at_once))
    for some in np.split(parts, np.unique(cuts)):
        sizes = some[:, 1] - some[:, 0]
        total = int(sizes.sum())
        if not total:
            continue
        place = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(some[:, 0], sizes)
        i = array[place]
        lo, hi, d = (np.repeat(some[:, c], sizes) for c in (2, 3, 4))
        for first in (i, i - d):
            second = first + d
            other = second if first is i else first
            ok = np.flatnonzero((other >= 0) & (other < n))
            at = inverse[other[ok]]
            ok = ok[(at >= lo[ok]) & (at < hi[ok])]
            end = second[ok] + d[ok]
            new = behind[second[ok]] != behind[np.minimum(end, n)]
            ends.append(end[new])
            periods.append(d[ok][new])
    found = np.unique(np.concatenate(ends) * (n + 1) + np.concatenate(periods))
    return np.stack(np.divmod(found, n + 1), axis=1)


def rotated(words: np.ndarray, start: np.ndarray, period: np.ndarray, width: int = 8) -> np.ndarray:
    """How far left each square's start moves while it stays a square."""
    out, live = start.copy(), np.arange(len(start))
    while len(live):
        chunk = max(1, (1 << 20) // width)
        going = []
        for part in (live[x:x + chunk] for x in range(0, len(live), chunk)):
            at = out[part, None] - 1 - np.arange(width)
            same = (at >= 0) & (words[np.maximum(at, 0)] == words[np.maximum(at, 0) + period[part, None]])
            moved = np.where(same.all(axis=1), width, same.argmin(axis=1))
            out[part] -= moved
            going.append(part[moved == width])
        live, width = np.concatenate(going), width * 4
    return out


def runs_of(words: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of all runs of an array of word numbers."""
    array, inverse, ranks = suffix_array(words)
    parts = smaller_children(lcp_array(array, ranks))
    squares = branching_squares(words, array, inverse, parts)
    found = [np.empty((0, 3), np.int64)]
    while len(squares):
        # The smallest period that is left of each end is a run's own.
        first = np.append(True, squares[1:, 0] != squares[:-1, 0])
        end, period = squares[first].T
        start = rotated(words, end - 2 * period, period)
        found.append(np.stack([start, end, period], axis=1))
        which = np.cumsum(first) - 1
        inside = start[which] <= squares[:, 0] - 2 * squares[:, 1]
        squares = squares[~first & ~inside]
    return np.concatenate(found)


def numbered(texts: list[list[bytes]]) -> np.ndarray:
    """Word numbers that no two texts share."""
    out, base = [], 0
    for words in texts:
        numbers: dict[bytes, int] = {}
        out += [base + numbers.setdefault(w, len(numbers)) for w in words]
        base += len(numbers)
    return np.array(out, np.int64)


def text_runs(texts: list[str], min_length: int) -> Iterator[tuple[int, list, str]]:
    """Per text: its number of words, runs of ``min_length`` words and more by
    start, then period, and the text without the repeats."""
    words = [t.encode().split() for t in texts]
    sizes = np.array([len(w) for w in words])
    begins = np.cumsum(sizes) - sizes
    found = runs_of(numbered(words)) if sizes.sum() else np.empty((0, 3), np.int64)
    found = found[found[:, 1] - found[:, 0] >= min_length]
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    owner = np.searchsorted(begins, found[:, 0], "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(words) + 1))
    for t, own in enumerate(words):
        mine = found[bounds[t]:bounds[t + 1]]
        runs = []
        if len(mine):
            start, end, period = (mine - [begins[t], begins[t], 0]).T
            edge = np.zeros(len(own) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, end, -1)
            dropped = np.cumsum(edge)[:-1] > 0
            own = [w for w, gone in zip(own, dropped.tolist(), strict=True) if not gone]
            runs = [{"start": s, "length": e - s, "period": p}
                    for s, e, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True)]
        yield int(sizes[t]), runs, b" ".join(own).decode()


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 12) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are runs of other than ASCII white space, numbered from 0. A run is a
    stretch of at least ``min_length`` words and of twice its smallest period,
    which no neighbouring word extends with that period; ``runs`` lists them by
    start, then period. ``collapsed`` has the words that no run contains after
    its first period, joined by one space.

    Null and blank texts have no words, no runs and the empty text. Each row is
    taken by itself: rows that repeat give equal results, an empty table an
    empty one. Texts may be of any length; memory of a task follows ``CHARS``
    characters or its longest text. Other columns are not read.
    """
    src = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = 0
            for texts in slices(b.column(1).to_pylist(), CHARS):
                n, runs, collapsed = zip(*text_runs(texts, min_length), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(texts)), pa.array(n, pa.int64()), pa.array(runs, pa.list_(RUN)),
                     pa.array(collapsed, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
                done += len(texts)

    return src.mapInArrow(found, f"doc_id {kind}, {RESULT}")


# --- the registered query's texts and digests -----------------------------------

def with_stammer(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them (crc32 of the id ends in 0) with a tail
    that repeats: each word i >= a becomes word a + (i - a) % p. A row without
    doc_id has the checksum of the empty text."""
    spaced = F.split(text_of("text"), SPACE)
    h = F.crc32(text_of("doc_id").cast("binary"))
    picked = docs.select("doc_id", "text", h.alias("h"))
    rest = picked.filter(F.col("h") % 10 != 0).select("doc_id", "text")
    words = (picked.filter(F.col("h") % 10 == 0)
             .select("doc_id", F.floor(F.col("h") / 10).alias("g"), F.array_remove(spaced, "").alias("words"))
             .withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
             .withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)")))
    tail = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT))), 1, n - a)")
    made = F.when(F.col("n") > 0, F.array_join(F.concat(F.expr("slice(words, 1, a)"), tail), " ")).otherwise("")
    return rest.unionByName(words.select("doc_id", made.alias("text")))


def run_digests(docs: DataFrame) -> DataFrame:
    """The figures of ``periodic_runs`` over ``with_stammer``: per document its
    number of runs, the longest (ties: smallest start, then period), and digests
    of all runs and of the collapsed text."""
    found = periodic_runs(with_stammer(docs))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return (found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"),
                         F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                    (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
