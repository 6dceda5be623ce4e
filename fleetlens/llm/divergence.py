"""Divergence of sources by the terms they use, with terms found by iceberg
prefix refinement.

A term is kept where enough documents of its language have it. No prefix of a
term is in fewer documents than the term, so prefixes are refined level by
level: the documents' terms are cut to ``length`` bytes, the distinct documents
of each cut are counted, and what lies below the threshold is discarded with
every term behind it. A term of at most ``length`` bytes is complete at that
level: its count is its own, it is kept or dropped, and it leaves. Longer terms
behind a prefix that is left go on to the next level, of twice the length, until
no prefix is left. Then the kept terms are counted by source.

- Texts are cut into terms once, in slices of one language: a row holds a
  slice's vocabulary and postings (document, term) as packed numbers. A document
  is one row and lies in one slice, so its distinct cuts are found there. Each
  level writes the postings that go on and reads only those.
- Tasks add up what their slices count and send sums, not documents.
- The prefixes that are left reach the next level, and the kept terms the count
  by source, as a Bloom filter of fixed size (``BITS``), whatever their number. A
  prefix it lets through by mistake is counted exactly, and discarded, one level
  on, and a term by a join; the filter never drops a term and never keeps one.

All figures are exact integers; 1e9 * count is taken in decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import LARGE_ROWS, listed, slices, text_of, texts_of, written

#: Bits of a filter: two megabytes.
BITS = 1 << 24
#: Bytes of the first level's prefixes; every level doubles them.
FIRST_LENGTH = 4
#: Characters of the texts of a slice (a longer text has one of its own).
CHARS = 2 << 20
#: Rows of sums that a task holds before it adds them up, or sends them.
SUMS = 400_000
#: Pairs of sources that are compared at once.
PAIRS_AT_ONCE = 200_000

#: Bytes to terms: A-Z become a-z, all other ASCII but a-z parts terms, and
#: bytes of other characters stay.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

#: A slice: its terms joined by a space, its postings in order of documents as
#: 32-bit numbers of document and term, with the occurrences; each document's
#: source.
SLICE = ("lang string, sources array<string>, vocabulary binary, docs binary, terms binary, counts binary, "
         "doc_sources binary")
LEFT = "lang string, vocabulary binary, docs binary, terms binary"


def term_slices(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The terms of ``docs`` in ``SLICE`` rows. Nulls count as ''."""

    def packed(lang: str, texts: list[str], sources: pa.Array) -> pa.RecordBatch:
        found = [t.encode().translate(LETTERS).split() for t in texts]
        flat = pa.array([x for words in found for x in words], pa.binary()).dictionary_encode()
        n = max(len(flat.dictionary), 1)
        doc = np.repeat(np.arange(len(texts)), [len(words) for words in found])
        pairs, counts = np.unique(doc * n + flat.indices.to_numpy(), return_counts=True)
        doc, term = np.divmod(pairs, n)
        names = sources.dictionary_encode()
        numbers = (doc, term, counts, names.indices.to_numpy())
        blobs = [b" ".join(listed(flat.dictionary)), *(x.astype("<i4").tobytes() for x in numbers)]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]), pa.array([names.dictionary.to_pylist()], pa.list_(pa.string())),
             *(pa.array([x], pa.binary()) for x in blobs)],
            names=["lang", "sources", "vocabulary", "docs", "terms", "counts", "doc_sources"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes, langs = coded(b.column(0))
            for i, name in enumerate(langs.to_pylist()):
                part = b.filter(pa.array(codes == i))
                done = 0
                for texts in slices(texts_of(part.column(2)), CHARS):
                    yield packed(name, texts, part.column(1).slice(done, len(texts)))
                    done += len(texts)

    return docs.select(text_of(lang).alias("lang"), text_of(source).alias("source"),
                       text_of(text).alias("text")).mapInArrow(cut, SLICE)


def coded(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    enc = column.dictionary_encode()
    return enc.indices.to_numpy(), enc.dictionary


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Slices one by one, their numbers as arrays, their vocabulary unpacked."""
    for b in batches:
        for i in range(len(b)):
            row = {n: b.column(n)[i] for n in b.schema.names}
            blob = row["vocabulary"].as_py()
            out = {"lang": row["lang"].as_py(), "vocabulary": pa.array(blob.split(b" ") if blob else [], pa.binary())}
            out |= {n: np.frombuffer(row[n].as_buffer(), "<i4") for n in ("docs", "terms", "counts", "doc_sources") if n in row}
            if "sources" in row:
                out["sources"] = pa.array(row["sources"].as_py(), pa.string())
            yield out


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and, per key, exact sums of integer values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.array([], int)
    return keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v for v in values)


class Sums:
    """Rows of keys with a number, added up by keys; what a task has counted
    goes out when it is too much to hold, and at the end."""

    def __init__(self, keys: list[str], value: str):
        self.keys, self.value, self.parts, self.size = keys, value, [], 0

    def _added(self) -> pa.Table:
        t = pa.concat_tables(self.parts).group_by(self.keys, use_threads=False).aggregate([(self.value, "sum")])
        return t.select([*self.keys, f"{self.value}_sum"]).rename_columns([*self.keys, self.value])

    def add(self, columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        self.parts.append(pa.table(columns, names=[*self.keys, self.value]))
        self.size += len(columns[0])
        if self.size > SUMS:
            self.parts = [self._added()]
            self.size = len(self.parts[0])
            if 2 * self.size > SUMS:
                yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            yield from self._added().to_batches(max_chunksize=100_000)
        self.parts, self.size = [], 0
        pa.default_memory_pool().release_unused()


def cut_terms(vocabulary: pa.Array, length: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of a vocabulary: the code of each term's prefix, the prefixes, and
    whether the term is complete."""
    complete = pc.less_equal(pc.binary_length(vocabulary), length).to_numpy(zero_copy_only=False)
    codes, cuts = coded(pc.binary_slice(vocabulary, 0, length))
    return codes, cuts, complete


def level_counts(rows: DataFrame, length: int) -> DataFrame:
    """``lang, prefix, complete, docs``: distinct documents of every term that
    is at most ``length`` bytes long, and of every longer term's prefix."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "prefix", "complete"], "docs")

        def add(lang: str, prefix: pa.Array, complete: bool, docs: np.ndarray) -> Iterator[pa.RecordBatch]:
            return sums.add([pa.array([lang] * len(docs), pa.string()), prefix, pa.array(np.full(len(docs), complete)),
                             pa.array(docs, pa.int64())])

        for row in rows_of(batches):
            codes, cuts, complete = cut_terms(row["vocabulary"], length)
            # A posting is one document with one term.
            docs = np.bincount(row["terms"], minlength=len(codes))
            whole = np.flatnonzero(complete)
            yield from add(row["lang"], row["vocabulary"].take(pa.array(whole)), True, docs[whole])
            # A document's longer terms with one prefix count it once.
            longer = ~complete[row["terms"]]
            n = max(len(cuts), 1)
            seen = np.unique(row["docs"][longer].astype(np.int64) * n + codes[row["terms"][longer]]) % n
            code, docs = np.unique(seen, return_counts=True)
            yield from add(row["lang"], cuts.take(pa.array(code)), False, docs)
        yield from sums.rest()

    return (rows.select("lang", "vocabulary", "docs", "terms")
            .mapInArrow(counted, "lang string, prefix binary, complete boolean, docs bigint")
            .groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs")))


def mark(lang: Column | str, prefix: Column | str) -> Column:
    """The hash by which the filter knows a language's prefix."""
    return F.xxhash64(lang, prefix)


def marks(lang: str, cuts: list[bytes]) -> np.ndarray:
    """The same hash in a task."""
    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return np.array([xxhash.xxh64_intdigest(c, seed) for c in cuts], dtype=np.uint64)


def places(mark: np.ndarray) -> Iterator[np.ndarray]:
    """The two bits of each mark in the filter."""
    yield mark & np.uint64(BITS - 1)
    yield (mark >> np.uint64(32)) & np.uint64(BITS - 1)


def prefix_filter(prefixes: DataFrame) -> bytes | None:
    """A Bloom filter of ``BITS`` bits of the rows' ``lang, prefix``, built by
    an aggregate of at most ``BITS / 64`` rows; None without any."""
    code = mark("lang", "prefix")
    spots = F.explode(F.array(code.bitwiseAND(BITS - 1), F.shiftrightunsigned(code, 32).bitwiseAND(BITS - 1)))
    rows = (prefixes.select(spots.alias("spot"))
            .groupBy(F.shiftright("spot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, CAST(spot & 63 AS INT))")).alias("bits")).collect())
    if not rows:
        return None
    words = np.zeros(BITS // 64, np.int64)
    words[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return words.tobytes()


def held(lang: str, cuts: pa.Array, kept: bytes) -> np.ndarray:
    """Which prefixes the filter has."""
    words = np.frombuffer(kept, np.uint64)
    code = marks(lang, listed(cuts))
    out = np.ones(len(code), bool)
    for spot in places(code):
        out &= (words[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) > 0
    return out


def refined(rows: DataFrame, length: int, left: bytes) -> DataFrame:
    """Slices with the postings whose term is longer than ``length`` and has a
    prefix that the filter ``left`` holds; slices without any go."""

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            codes, cuts, complete = cut_terms(row["vocabulary"], length)
            here = np.zeros(len(cuts), bool)
            longer = np.unique(codes[~complete])
            here[longer] = held(row["lang"], cuts.take(pa.array(longer)), left)
            keep = ~complete & here[codes]
            if not keep.any():
                continue
            new = np.cumsum(keep, dtype=np.int32) - 1
            on = keep[row["terms"]]
            vocabulary = b" ".join(listed(row["vocabulary"].filter(pa.array(keep))))
            blobs = (vocabulary, row["docs"][on].tobytes(), new[row["terms"][on]].astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([row["lang"]]), *(pa.array([x], pa.binary()) for x in blobs)],
                                             names=["lang", "vocabulary", "docs", "terms"])

    return rows.select("lang", "vocabulary", "docs", "terms").mapInArrow(narrowed, LEFT)


def term_uses(rows: DataFrame, kept: bytes) -> DataFrame:
    """``lang, source, prefix, n``: occurrences of the terms that the filter
    ``kept`` holds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "source", "prefix"], "n")
        for row in rows_of(batches):
            here = held(row["lang"], row["vocabulary"], kept)
            on = here[row["terms"]]
            n = max(len(here), 1)
            source = row["doc_sources"][row["docs"][on]].astype(np.int64)
            keys, uses = summed(source * n + row["terms"][on], row["counts"][on].astype(np.int64))
            source, term = np.divmod(keys, n)
            yield from sums.add([pa.array([row["lang"]] * len(keys), pa.string()), row["sources"].take(pa.array(source)),
                                 row["vocabulary"].take(pa.array(term)), pa.array(uses, pa.int64())])
        yield from sums.rest()

    return (rows.mapInArrow(counted, "lang string, source string, prefix binary, n bigint")
            .groupBy("lang", "source", "prefix").agg(F.sum("n").alias("n")))


def kept_terms(docs: DataFrame, min_docs: int = 10, text: str = "text", lang: str = "lang",
               source: str = "source", first_length: int = FIRST_LENGTH) -> DataFrame:
    """``lang, source, term, n``: the occurrences, by source, of every term in
    at least ``min_docs`` documents (rows) of its language.

    Terms are runs of ASCII letters and of any characters beyond ASCII, with
    A-Z lowered. Null text, lang and source count as ''; a row that repeats is
    a document of its own; an empty table has no terms. Other columns are not
    read. Terms may be of any length.
    """
    whole = rows = written(term_slices(docs, text, lang, source), "term-slices", LARGE_ROWS)
    length, found = first_length, []
    while True:
        level = written(level_counts(rows, length).filter(F.col("docs") >= min_docs), "term-level")
        found.append(level.filter("complete").select("lang", "prefix"))
        left = prefix_filter(level.filter("NOT complete"))
        if left is None:
            break
        rows = written(refined(rows, length, left), "term-slices", LARGE_ROWS)
        length *= 2
    terms = found[0]
    for more in found[1:]:
        terms = terms.unionByName(more)
    kept = prefix_filter(terms)
    if kept is None:
        kept = bytes(BITS // 8)
    uses = term_uses(whole, kept).join(terms, ["lang", "prefix"])
    return written(uses.select("lang", "source", F.col("prefix").cast("string").alias("term"), "n"), "kept-terms")


# --- divergence ---------------------------------------------------------------

def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(1e9 * (count + 2) / (total + 2 * terms)); null without terms."""
    wide = "decimal(20,0)"
    top = F.lit(1_000_000_000).cast(wide) * (count + 2).cast(wide)
    below = F.when(terms > 0, (total + 2 * terms).cast("decimal(38,0)"))
    return F.lit(1) + F.call_function("div", top, below)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 1e9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def both_sided(cells: DataFrame) -> DataFrame:
    """Over the terms that two sources of a language share, the sum of what
    the gap differs by from gaps to a source without the term:
    ``lang, source, item, both`` for source < item. Tasks add up the pairs of
    their terms and send sums; pairs of one term are never rows."""

    def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // (p + q)

    def pair_sums(source: np.ndarray, p: np.ndarray, p0: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of terms with as many sources each (a row a term): codes of pairs
        with their sums."""
        i, j = np.triu_indices(source.shape[1], 1)
        a, b, a0, b0 = p[:, i], p[:, j], p0[:, i], p0[:, j]
        value = f(a, b) - f(a, b0) - f(a0, b) + f(a0, b0)
        return summed((source[:, i] * n + source[:, j]).ravel(), value.ravel())

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums(["lang", "source", "item"], "both")
        for b in batches:
            codes, langs = coded(b.column(0))
            for k, lang in enumerate(langs.to_pylist()):
                lists = b.column(1).filter(pa.array(codes == k))
                cells = lists.flatten()
                names, dictionary = coded(cells.field("source"))
                # Codes in the order of names: the smaller name is a pair's source.
                order = np.array(sorted(range(len(dictionary)), key=lambda x: dictionary[x].as_py().encode()), np.int64)
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                source = rank[names]
                p, p0 = (cells.field(c).to_numpy() for c in ("p", "p0"))
                sizes = pc.list_value_length(lists).to_numpy()
                starts = np.cumsum(sizes) - sizes
                for size in np.unique(sizes).tolist():
                    at_once = max(1, PAIRS_AT_ONCE // (size * size))
                    of = starts[sizes == size]
                    for first in range(0, len(of), at_once):
                        place = of[first:first + at_once, None] + np.arange(size)
                        pair, value = pair_sums(source[place], p[place], p0[place], len(order))
                        s, t = (dictionary.take(pa.array(order[x])) for x in np.divmod(pair, len(order)))
                        yield from sums.add([pa.array([lang] * len(pair), pa.string()), s, t, pa.array(value, pa.int64())])
        yield from sums.rest()

    vectors = (cells.groupBy("lang", "term")
               .agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("cells"))
               .filter(F.size("cells") > 1).select("lang", "cells"))
    return (vectors.mapInArrow(partial, "lang string, source string, item string, both bigint")
            .groupBy("lang", "source", "item").agg(F.sum("both").alias("both")))


def source_divergence(docs: DataFrame, min_docs: int = 10, top: int = 10, text: str = "text",
                      lang: str = "lang", source: str = "source",
                      first_length: int = FIRST_LENGTH) -> DataFrame:
    """``lang, source, part, item, value, rank`` over the terms that
    ``kept_terms`` finds.

    Part ``pair``: every other source of the language by the gap summed over
    all kept terms (0 without any). Part ``term``: the ``top`` terms that a
    source uses more than its language does, by gap. Ranks start at 1 per source
    and part, by value descending, then item in UTF-8 order.

    Null lang and source count as ''. A source without terms has pairs, and no
    term rows. A language of one source has no pairs. An empty table gives no
    rows.

    The sum over all terms of two sources is made of the terms that each has
    (a histogram of its shares) and a correction for those that both have, so
    that work follows the terms that occur, not terms times sources.
    """
    uses = kept_terms(docs, min_docs, text, lang, source, first_length)
    by_term = uses.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    sizes = by_term.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = uses.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("used"))
    groups = docs.select(text_of(lang).alias("lang"), text_of(source).alias("source")).distinct()
    zero = F.lit(0).cast("bigint")
    groups = written(groups.join(sizes, "lang", "left").join(totals, ["lang", "source"], "left")
                     .select("lang", "source", *(F.coalesce(c, zero).alias(c) for c in ("terms", "total", "used")))
                     .withColumn("p0", share(zero, F.col("total"), F.col("terms"))), "source-groups")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("total_lang"))

    cells = written(uses.join(by_term, ["lang", "term"])
                    .join(groups.select("lang", "source", "terms", "total", "p0"), ["lang", "source"])
                    .join(whole, "lang")
                    .select("lang", "source", "term", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
                            "p0", share(F.col("n_lang"), F.col("total_lang"), F.col("terms")).alias("q")),
                    "source-cells")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = (cells.filter(F.col("p") > F.col("q"))
             .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     gap(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))

    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("used").alias("used2"))
    pairs = (groups.select("lang", "source", "terms", "p0", "used").join(others, "lang")
             .filter(F.col("source") != F.col("item")))
    # A source's own terms against every other source without them.
    shares = cells.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    one_sided = (shares.join(others, "lang").filter(F.col("source") != F.col("item"))
                 .groupBy("lang", "source", "item")
                 .agg(F.sum(F.col("m") * gap(F.col("p"), F.col("q0"))).alias("one")))
    one_sided = written(one_sided, "one-sided")
    mirrored = one_sided.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                                F.col("one").alias("two"))
    both = both_sided(cells)
    both = written(both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                                                "both")), "both-sided")
    keys = ["lang", "source", "item"]
    neither = (F.col("terms") - F.col("used") - F.col("used2")) * gap(F.col("p0"), F.col("q0"))
    value = sum((F.coalesce(c, zero) for c in (F.col("one"), F.col("two"), F.col("both"))), F.coalesce(neither, zero))
    paired = (pairs.join(one_sided, keys, "left").join(mirrored, keys, "left").join(both, keys, "left")
              .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
              .withColumn("rank", F.row_number().over(order)))
    return paired.unionByName(terms)
