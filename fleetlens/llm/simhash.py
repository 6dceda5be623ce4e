"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits that differ in at most ``max_distance`` bits are
linked; the components of the links are the groups.

Candidates meet at anchors. The 64 bits are cut into ``max_distance // 2 + 1``
blocks, so that a linked pair differs by at most one bit in at least one block.
The anchors of a block are the words of a Hamming code over its first
``2**r - 1`` bits: a perfect covering code of radius 1. Each fingerprint is
replicated to every anchor within radius plus threshold, 1 + 1 bits, of its
block: to itself if it is a code word, else to 16 (r = 5) anchors. Of a pair
that differs by one bit in the block, the anchor next to one of the two is
within 2 bits of the other, so the pair meets. At each anchor fingerprints are
compared in all 64 bits.

Copies are gone before that (a fingerprint is one row however many documents
have it). An anchor with many distinct fingerprints is dealt out again by
pieces of the bits that it does not cover: cut into ``max_distance + 1`` pieces,
a linked pair agrees in at least one. Groups that are still large are dealt out
by pieces of the bits left over, and so on until too few bits are left; what
then shares a group differs in few bits that are not held fast. Of a group of over 16 fingerprints only a spanning
forest of its links is reported, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import checkpointed, free_name, written
from fleetlens.llm.components import connected_components

WORDS = 3
MAX_DISTANCE = 2
#: An anchor's fingerprints beyond this number are dealt out again.
CROWD = 2048
#: Shingles hashed at once, to bound memory in long texts.
CHUNK = 1 << 16


def fingerprint_of(text: str, words: int = WORDS) -> int:
    """The SimHash of a text as unsigned integer, by XXH64 with seed 42.

    A-Z in lower case, words without ASCII white space, all shingles with
    repeats; bit set where over half the hashes have it; no words: zero.
    """
    import xxhash

    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) < words:
        return digest(b" ".join(tokens), 42)
    n = len(tokens) - words + 1
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, CHUNK):
        stop = min(start + CHUNK, n)
        shingles = map(b" ".join, zip(*(tokens[start + k:stop + k] for k in range(words)), strict=True))
        hashes = np.fromiter((digest(s, 42) for s in shingles), dtype="<u8", count=stop - start)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      words: int = WORDS) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) per row."""
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint_of(t or "", words) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, fp bigint")


def blocks_of(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the blocks."""
    n = max_distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def anchors_of(fps: np.ndarray, first: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, anchors) of all code words within 2 bits of the block's
    covered bits. The syndrome of a word, the XOR of the positions (from 1) of
    its set bits, names the one bit to flip for the nearest code word."""
    r = (width + 1).bit_length() - 1
    n = (1 << r) - 1
    words = (fps >> np.uint64(first)) & np.uint64((1 << n) - 1)
    syndrome = np.zeros(len(words), dtype=np.uint64)
    for p in range(1, n + 1):
        syndrome ^= ((words >> np.uint64(p - 1)) & np.uint64(1)) * np.uint64(p)
    flip = np.concatenate([[0], np.uint64(1) << np.arange(n, dtype=np.uint64)]).astype(np.uint64)
    nearest = words ^ flip[syndrome]
    rows, found = [np.arange(len(words))], [nearest]
    # Code words two bits away: flip p and the position that then corrects it.
    off = np.flatnonzero(syndrome)
    s = syndrome[off]
    for p in range(1, n + 1):
        q = s ^ np.uint64(p)
        pair = q > p
        rows.append(off[pair])
        found.append(words[off[pair]] ^ flip[p] ^ flip[q[pair]])
    return np.concatenate(rows), np.concatenate(found)


def at_anchors(distinct: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """Each fingerprint at each of its anchors: block, anchor, fp (longs)."""
    blocks = blocks_of(max_distance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy().view(np.uint64)
            for i, (first, width) in enumerate(blocks):
                rows, anchors = anchors_of(fps, first, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), i, dtype=np.int64)), pa.array(anchors.view(np.int64)),
                     pa.array(fps[rows].view(np.int64))], ["block", "anchor", "fp"])

    return distinct.select("fp").mapInArrow(run, "block bigint, anchor bigint, fp bigint")


def near(fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that link all of ``fps`` (distinct, unsigned) whose bits
    differ in at most ``max_distance`` places, as a spanning forest.

    Breadth first: the rows not yet reached are compared with one reached row
    at a time, so no more than a row's distances are held.
    """
    left, a, b = np.arange(len(fps)), [], []
    limit = np.uint8(max_distance)
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            hit = np.bitwise_count(fps[left] ^ fps[at]) <= limit
            if hit.any():
                new = left[hit]
                left = left[~hit]
                reached.extend(new)
                a.append(np.full(len(new), at))
                b.append(new)
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def compare_groups(rows: DataFrame, keys: list[str], max_distance: int, crowd: int | None) -> DataFrame:
    """Links within the groups of ``keys`` (long columns), as rows (a, b, null).

    Dealt out by the keys and sorted, so a task holds one batch and the group
    at its end. All small groups of a batch are compared together, by their
    distance in the sorted order; a larger one goes through ``near``. The rows
    of a group of over ``crowd`` fingerprints are passed on as they come, as
    (fp, second key, first key).
    """
    small_size = 16

    def links(group: np.ndarray, starts: np.ndarray, sizes: np.ndarray, fps: np.ndarray):
        small = np.flatnonzero(((sizes > 1) & (sizes <= small_size))[group])
        g, f = group[small], fps[small]
        for lag in range(1, min(small_size, len(small))):
            at = np.flatnonzero(g[lag:] == g[:-lag])
            if not len(at):
                break
            at = at[np.bitwise_count(f[at] ^ f[at + lag]) <= max_distance]
            yield f[at], f[at + lag], None
        for k in np.flatnonzero(sizes > small_size):
            own = fps[starts[k]:starts[k] + sizes[k]]
            a, b = near(own, max_distance)
            yield own[a], own[b], None

    def emit(columns: list[np.ndarray], passing: tuple | None):
        """Complete groups; those too large, or begun as such, are passed on."""
        keyed, fps = columns[:-1], columns[-1].view(np.uint64)
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in keyed])) + 1
        starts = np.concatenate([[0], change])
        sizes = np.diff(np.concatenate([starts, [len(fps)]]))
        over = sizes > (crowd or len(fps))
        if passing is not None and all(c[0] == v for c, v in zip(keyed, passing, strict=True)):
            over[0] = True
        group = np.repeat(np.arange(len(starts)), sizes)
        for k in np.flatnonzero(over):
            own = slice(starts[k], starts[k] + sizes[k])
            yield fps[own], keyed[1][own], keyed[0][own]
        yield from links(group, starts, np.where(over, 0, sizes), fps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        passing: tuple | None = None

        def made(columns):
            for a, b, key in emit(columns, passing):
                if len(a):
                    key = pa.nulls(len(a), pa.int64()) if key is None else pa.array(key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), key], ["a", "b", "key"])

        for b in batches:
            if not b.num_rows:
                continue
            columns = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if held is not None:
                columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
            same = np.logical_and.reduce([c == c[-1] for c in columns[:-1]])
            cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
            if crowd and len(same) - cut > crowd:
                yield from made(columns)
                passing, held = tuple(c[-1] for c in columns[:-1]), None
                continue
            held = [c[cut:] for c in columns]
            if cut:
                yield from made([c[:cut] for c in columns])
        if held is not None:
            yield from made(held)

    return (rows.repartition(*keys).sortWithinPartitions(*keys).select(*keys, "fp")
            .mapInArrow(run, "a bigint, b bigint, key bigint"))


def free_bits(deal: int, max_distance: int) -> list[int]:
    """The bits that neither the anchor covers nor a piece has fixed, of a
    group's deal: its block, and from it the pieces' numbers (from 1) as digits."""
    blocks, n = blocks_of(max_distance), max_distance + 2
    deal, block = divmod(deal, len(blocks))
    first, width = blocks[block]
    covered = range(first, first + (1 << ((width + 1).bit_length() - 1)) - 1)
    free = [b for b in range(64) if b not in covered]
    while deal:
        deal, piece = divmod(deal, n)
        fixed = pieces_of(free, max_distance)[piece - 1]
        free = [b for b in free if b not in fixed]
    return free


def pieces_of(free: list[int], max_distance: int) -> list[list[int]]:
    cuts = [len(free) * i // (max_distance + 1) for i in range(max_distance + 2)]
    return [free[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def dealt_again(crowded: DataFrame, level: int, max_distance: int) -> DataFrame:
    """Each fingerprint of a crowded group (deal, anchor) at each piece of the
    group's free bits: deal, anchor, fp. The new anchor is a hash of the group
    and the piece's bits (groups that share one are compared in all bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = len(blocks_of(max_distance)) * (max_distance + 2) ** level
        for b in batches:
            deals, anchors, fps = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            for deal in np.unique(deals).tolist():
                at = deals == deal
                for i, bits in enumerate(pieces_of(free_bits(deal, max_distance), max_distance), 1):
                    part = (fps[at].view(np.uint64) & np.uint64(sum(1 << x for x in bits))).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(at.sum(), deal + i * step, dtype=np.int64)), pa.array(anchors[at]),
                         pa.array(part), pa.array(fps[at])], ["deal", "anchor", "part", "fp"])

    return (crowded.select("deal", "anchor", "fp").mapInArrow(run, "deal bigint, anchor bigint, part bigint, fp bigint")
            .select("deal", F.xxhash64("deal", "anchor", "part").alias("anchor"), "fp"))


def fingerprint_links(distinct: DataFrame, max_distance: int = MAX_DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) of at most ``max_distance`` bits, enough of them to join
    whatever distinct ``fp`` such links can join."""
    met = written(compare_groups(at_anchors(distinct, max_distance), ["block", "anchor"], max_distance, crowd),
                  "anchors")
    links, level = met.filter("key is null").select("a", "b"), 0
    left = max(len(free_bits(i, max_distance)) for i in range(len(blocks_of(max_distance))))
    while left > max_distance and not met.filter("key is not null").isEmpty():
        crowded = met.filter("key is not null").select(
            F.col("key").alias("deal"), F.col("b").alias("anchor"), F.col("a").alias("fp"))
        left -= left // (max_distance + 1)
        met = written(compare_groups(dealt_again(crowded, level, max_distance), ["deal", "anchor"], max_distance,
                                     crowd if left > max_distance else None), "anchors")
        links, level = links.union(met.filter("key is null").select("a", "b")), level + 1
    return links


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                   max_distance: int = MAX_DISTANCE, crowd: int = CROWD) -> DataFrame:
    """One row per row: doc_id, fingerprint (16 lowercase hex digits),
    component_id (smallest doc_id reachable by links, its own included).

    A null text is an empty one (fingerprint zero, linked like any other).
    Rows without doc_id link too; a component without any doc_id has none.
    An empty table gives an empty result; other columns are not read.
    """
    rows = written(with_fingerprints(docs, doc_id, text, words), "simhash")
    distinct = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = connected_components(fingerprint_links(distinct, max_distance, crowd), "a", "b")
    member = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    # Two steps, so that neither join meets a document's copies and a
    # component's fingerprints at once.
    labels = member.join(named, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                        max_distance: int = MAX_DISTANCE) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest
    doc_id (of rows with one doc_id the first in the table as it is written here).
    Rows that share a doc_id and are not near copies all stay; so does a row
    without doc_id, which no other stands for.

    Rows are numbered once, in a written table, so that what is dropped is the
    same rows whichever executor is lost; only numbers and fingerprints meet."""
    key = free_name(docs.columns, "near_key")

    @F.pandas_udf("bigint")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t or "", words) for t in texts], np.uint64).view(np.int64))

    marked = written(docs.select("*", F.struct(fingerprint(F.col(text).cast("string")).alias("fp"),
                                               F.monotonically_increasing_id().alias("row")).alias(key)), "near-marked")
    rows = marked.select(F.col(doc_id).alias("doc_id"), F.col(f"{key}.fp"), F.col(f"{key}.row"))
    rows = rows.filter(F.col("doc_id").isNotNull())
    first = F.min(F.struct("doc_id", "row"))
    # Copies of one fingerprint first, then the fingerprints of a component.
    distinct = checkpointed(rows.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(fingerprint_links(distinct.select("fp"), max_distance), "a", "b")
    kept = (distinct.join(roots, distinct.fp == roots.node, "left").groupBy(F.coalesce("root", "fp"))
            .agg(F.min("first").alias("first")).select(F.col("first.row").alias("row")))
    dropped = rows.select("row").join(kept, "row", "left_anti").withColumnRenamed("row", key)
    return marked.join(dropped, marked[f"{key}.row"] == dropped[key], "left_anti").drop(key)
