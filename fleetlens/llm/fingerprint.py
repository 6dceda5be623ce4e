"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash space, so
its size follows the text's length, and sketches of very unequal texts can be
compared and merged: hashes below the threshold of both are a uniform sample of
the union's shingles. One fraction for all lengths would keep next to nothing of
a short text, so fractions are a ladder (``LADDER``): all hashes of a text of few
shingles, a fixed part of a longer text's. A sketch carries ``limit``, the bound up
to which it is complete, and two sketches are compared below the smaller of their
limits; texts on the lowest step are compared exactly.

Shingles are ``WORDS`` consecutive words (maximal runs without ASCII white
space, lower case); a text of fewer words is one shingle, one without words has
none. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import SPACE, text_of, written

WORDS = 5
#: Distinct shingles up to which one hash in so many is kept; beyond, one in SCALE.
LADDER = ((256, 1), (2048, 4))
SCALE = 16
#: Hashes are non-negative: XXH64 without its sign bit.
TOP = (1 << 63) - 1


def with_sketch(df: DataFrame, text: str, name: str, ladder: Sequence[tuple[int, int]] = LADDER,
                scale: int = SCALE) -> DataFrame:
    """``df`` with struct ``name`` (limit long, hashes sorted array<long>).

    The steps are columns of their own because a lambda would evaluate an
    expression that it names anew for every element.
    """
    words, hashes = f"{name}_words", f"{name}_hashes"
    df = df.withColumn(words, F.filter(F.split(F.lower(text), SPACE), lambda w: w != ""))
    last = F.greatest(F.size(words) - WORDS, F.lit(0))
    shingle = F.transform(F.sequence(F.lit(1), last + 1),
                          lambda i: F.xxhash64(F.slice(words, i, WORDS)).bitwiseAND(TOP))
    df = df.withColumn(hashes, F.when(F.size(words) > 0, F.sort_array(F.array_distinct(shingle)))
                       .otherwise(F.array().cast("array<bigint>")))
    limit = F.lit(TOP // scale)
    for up_to, one_in in reversed(ladder):
        limit = F.when(F.size(hashes) <= up_to, F.lit(TOP // one_in)).otherwise(limit)
    df = df.withColumn(f"{name}_limit", limit)
    kept = F.filter(hashes, lambda h: h <= F.col(f"{name}_limit"))
    return (df.withColumn(name, F.struct(F.col(f"{name}_limit").alias("limit"), kept.alias("hashes")))
            .drop(words, hashes, f"{name}_limit"))


def as_string(sketch: str) -> Column:
    """The limit, a colon and the hashes, each as 16 hexadecimal digits."""
    def digits(x: Column) -> Column:
        return F.lower(F.lpad(F.hex(x), 16, "0"))

    return F.concat(digits(F.col(f"{sketch}.limit")), F.lit(":"),
                    F.array_join(F.transform(f"{sketch}.hashes", digits), ""))


def compared(df: DataFrame, a: str, b: str, likeness: str, containment: str) -> DataFrame:
    """``df`` with the estimated share of shingles of the union that both
    texts have, and of the shingles of ``a`` that ``b`` has (0 to 1). Two
    texts without shingles are alike; one without is unlike any other."""
    below = f"{likeness}_below"
    df = df.withColumn(below, F.least(f"{a}.limit", f"{b}.limit"))
    for s in (a, b):
        df = df.withColumn(f"{below}_{s}", F.filter(f"{s}.hashes", lambda h: h <= F.col(below)))
    x, y = F.size(f"{below}_{a}"), F.size(f"{below}_{b}")
    df = df.withColumn(f"{below}_both", F.size(F.array_intersect(f"{below}_{a}", f"{below}_{b}")))
    both = F.col(f"{below}_both")
    return (df.withColumn(likeness, F.when(x + y == 0, F.lit(1.0)).otherwise(both / (x + y - both)))
            .withColumn(containment, F.when(x == 0, (y == 0).cast("double")).otherwise(both / x))
            .drop(below, f"{below}_{a}", f"{below}_{b}", f"{below}_both"))


def merged(a: str, b: str) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    limit = F.least(f"{a}.limit", f"{b}.limit")
    return F.struct(limit.alias("limit"),
                    F.filter(F.sort_array(F.array_union(f"{a}.hashes", f"{b}.hashes")),
                             lambda h: h <= limit).alias("hashes"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: doc_id, fingerprint (string)."""
    df = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    return with_sketch(df, "text", "sketch").select("doc_id", as_string("sketch").alias("fingerprint"))


def _ring(rows: DataFrame) -> DataFrame:
    """Each distinct (doc_id, text) with the keys of its neighbours in
    ascending order; the last one's next is the first.

    Range partitions are numbered and written; neighbours inside one are a
    window's, across two come from one row per partition.
    """
    order = ["doc_id", "h1", "h2"]
    ids = rows.groupBy("h1", "h2").agg(
        F.first("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies"))
    ids = written(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ring")
    me = F.struct(*order, "n")
    ends = ids.groupBy("part").agg(F.min(me).alias("low"), F.max(me).alias("high"))
    # One row per partition.
    across = Window.orderBy("part")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lag("high").over(across), F.last("high").over(whole)).alias("before"),
        F.coalesce(F.lead("low").over(across), F.first("low").over(whole)).alias("after"))
    inside = Window.partitionBy("part").orderBy(*order)
    linked = ids.select("*", F.lag(me).over(inside).alias("previous"), F.lead(me).over(inside).alias("next"))
    return linked.join(ends, "part").select(
        "h1", "h2", "doc_id", "n", "copies",
        F.coalesce("previous", "before").alias("previous"), F.coalesce("next", "after").alias("next"))


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last half of its
    code points replaced by as many from the next document's start.

    Gives doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (likeness to the edited and the next text), and
    inside_edited, inside_next (the share of its own shingles found there).

    A null text is empty. Rows without doc_id come first; rows equal in doc_id
    are ordered by hashes of their text; rows equal in both are one document
    with the same result for each. A lone document is its own next one.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    rows = rows.select("doc_id", "text", F.length("text").cast("long").alias("n"),
                       F.xxhash64("doc_id", "text").alias("h1"), F.xxhash64("text", "doc_id").alias("h2"))
    ring = written(_ring(rows.select("doc_id", "n", "h1", "h2")), "neighbours")
    # Each text goes to its key's task once; its first half stays there, what
    # the previous document needs of it and its sketch go on to that one.
    texts = rows.select("h1", "h2", "text").dropDuplicates(["h1", "h2"])
    whole = ring.join(texts, ["h1", "h2"])
    own = with_sketch(whole.withColumn("take", F.expr("int(n div 2)")), "text", "own").select(
        "h1", "h2", "doc_id", "n", "copies", "take", "own", F.expr("left(text, int(n) - take)").alias("head"))
    given = with_sketch(whole, "text", "following").select(
        F.col("previous.h1").alias("h1"), F.col("previous.h2").alias("h2"), "following",
        F.expr("left(text, int(previous.n div 2))").alias("given"))
    both = own.join(given, ["h1", "h2"]).withColumn("edited_text", F.concat("head", "given"))
    both = with_sketch(both, "edited_text", "edited")
    both = compared(both, "own", "edited", "near_edited", "inside_edited")
    both = compared(both, "own", "following", "near_next", "inside_next")
    out = both.select(
        "doc_id", F.col("n").alias("n_chars"), F.sha2("edited_text", 256).alias("edited_sha256"),
        as_string("own").alias("fingerprint"), as_string("edited").alias("edited_fingerprint"),
        "near_edited", "near_next", "inside_edited", "inside_next", "copies")
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .drop("copies", "copy"))
