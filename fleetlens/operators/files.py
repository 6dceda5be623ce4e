"""Files to ship, package sets and their fingerprints."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import fleetlens.operators.udf  # noqa: F401  (package functions pickle by value)
from fleetlens.session import materialize


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def normalize_uri(uri: Column, staging_dir: str | None = None) -> Column:
    """``hdfs://x`` becomes ``hdfs:///x`` (so ``hdfs://nn:8020/p`` becomes
    ``hdfs:///nn:8020/p``, as in the reference); other schemes are kept. A
    path without a scheme goes to ``<staging_dir>/<base name>`` when a
    staging folder is given (where it is uploaded to), else gets ``file:``."""
    hdfs_short = uri.startswith("hdfs://") & ~uri.startswith("hdfs:///")
    has_scheme = uri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    if staging_dir is None:
        local = F.concat(F.lit("file:"), uri)
    else:
        local = F.concat(F.lit(staging_dir.rstrip("/") + "/"), base_name(uri))
    return (F.when(hdfs_short, F.concat(F.lit("hdfs:///"), F.substring(uri, 8, 1 << 30)))
            .when(has_scheme, uri)
            .otherwise(local))


def normalize_uris(df: DataFrame, uri_col: str = "uri", staging_dir: str | None = None) -> DataFrame:
    """Normalised URIs and how many references point at each."""
    return (df.select(normalize_uri(F.col(uri_col), staging_dir).alias("uri"))
            .groupBy("uri").agg(F.count(F.lit(1)).alias("n_refs")))


def upload_delta(local: DataFrame, remote: DataFrame, always: bool = False,
                 match_on: str = "path") -> DataFrame:
    """What to do with each local file: ``missing`` (not remote), ``size``
    (sizes differ), ``stale`` (local not strictly older than remote) or
    ``skip``; ``always=True`` gives ``upload`` for all, as the reference's
    upload-always switch. ``match_on="basename"`` matches on the file name
    alone, as the reference's flat staging folder does. A size or time that
    is not known counts as different, so the file is uploaded."""
    if always:
        return local.select("path", F.lit("upload").alias("action"))
    if match_on == "basename":
        lk, rk = base_name(F.col("path")), base_name(F.col("path"))
    else:
        lk, rk = F.col("path"), F.col("path")
    l = local.select(F.col("path"), lk.alias("_k"), "size", "mtime")
    # One remote entry per key (the newest), so the join cannot fan out even
    # when names repeat; a map-side max_by before the shuffle.
    r = (remote.select(rk.alias("_k"), F.struct(F.col("last_mod"), F.col("size").alias("_rsize")).alias("_r"))
         .groupBy("_k").agg(F.max("_r").alias("_r"))
         .select("_k", "_r.last_mod", "_r._rsize", F.lit(True).alias("_there")))
    j = l.join(r, on="_k", how="left")
    action = (F.when(F.col("_there").isNull(), "missing")
              .when(~F.coalesce(F.col("size") == F.col("_rsize"), F.lit(False)), "size")
              .when(~F.coalesce(F.col("mtime") < F.col("last_mod"), F.lit(False)), "stale")
              .otherwise("skip"))
    return j.select("path", action.alias("action"))


def set_fingerprint(df: DataFrame, group: str, item: str, out: str = "fp",
                    sep: str = "-", channel: str | None = None) -> DataFrame:
    """SHA-1 of the sorted, distinct items of each group joined by ``sep``;
    with ``channel`` (a boolean column, true for a package channel) the
    channels follow the packages, each sorted, so that two environments that
    differ in channels differ.

    Items are taken as strings. Null items count for nothing; a group without
    any other item has the hash of the empty text. A null group is one group.

    SHA-1 is not mergeable: the bytes of a group must pass one hasher in order.
    All else is spread. Distinct (group, item) pairs come from a hash aggregate
    and are written; they are dealt by ranges of (group, item), so a hot group
    spans as many tasks as it needs, and each task joins the items of a group into
    chunks of bytes, an Arrow batch at a time, without touching single items. Only
    the chunks, a few large rows, meet by group, where a task hashes one after the
    other.
    """
    last = F.lit(False) if channel is None else F.coalesce(F.col(channel), F.lit(False))
    pairs = df.select(F.col(group).alias("_g"), last.alias("_c"), F.col(item).cast("string").alias("_i")).distinct()
    ranges = materialize(df.sparkSession, pairs).repartitionByRange("_g", "_c", "_i").sortWithinPartitions("_g", "_c", "_i")
    key = df.schema[group]
    place = [T.StructField("_range", T.IntegerType()), T.StructField("_at", T.LongType()),
             T.StructField("_chunk", T.BinaryType())]
    digest = T.StructType([key, T.StructField(out, T.StringType(), False)])
    joiner = sep.encode()

    def group_starts(values: pa.Array) -> np.ndarray:
        """Where another group begins in a sorted array, the first place included."""
        codes = values.dictionary_encode("encode").indices.to_numpy()
        return np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, task = 0, TaskContext.get().partitionId()
        for b in batches:
            if not b.num_rows:
                continue
            starts = group_starts(b.column(0))
            items = b.column(2).cast(pa.binary())
            there = items.is_valid()
            kept = items.filter(there)
            # Null items leave their group's list shorter, or empty.
            before = np.append(0, np.cumsum(there.to_numpy(zero_copy_only=False)))
            offsets = before[np.append(starts, b.num_rows)].astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, kept), joiner)
            joined = pc.if_else(pa.array(np.diff(offsets) > 0), joined, None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(starts)), pa.array(np.full(len(starts), task, np.int32)),
                 pa.array(np.arange(at, at + len(starts))), joined], names=["_g", "_range", "_at", "_chunk"])
            at += len(starts)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h, empty = None, None, True  # now: an array of one, its type kept

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([now, pa.array([h.hexdigest()])], names=[group, out])

        for b in batches:
            groups = b.column(0)
            for i, (value, chunk) in enumerate(zip(groups.to_pylist(), b.column(3), strict=True)):
                if h is None or now[0].as_py() != value:
                    if h is not None:
                        yield made()
                    now, h, empty = groups.slice(i, 1), hashlib.sha1(), True
                if chunk.is_valid:
                    if not empty:
                        h.update(joiner)
                    h.update(chunk.as_buffer())
                    empty = False
        if h is not None:
            yield made()

    parts = ranges.mapInArrow(chunks, T.StructType([T.StructField("_g", key.dataType), *place]))
    return parts.repartition("_g").sortWithinPartitions("_g", "_range", "_at").mapInArrow(hashed, digest)


def first_by_key(df: DataFrame, group: str, item: str, order: str,
                 key_pattern: str = r"^\w+") -> DataFrame:
    """The first item (lowest ``order``) for each leading word of an item
    within a group: user items placed before defaults win. As in the
    reference, ``scikit-learn`` and ``scikit-image`` share the key ``scikit``.
    One aggregate with map-side ``min_by`` (sort-based, as it holds strings)."""
    key = F.regexp_extract(F.col(item), key_pattern, 0)
    return (df.select(F.col(group).alias("_g"), key.alias("_k"), F.col(item).alias("_i"),
                      F.col(order).alias("_o"))
            .groupBy("_g", "_k")
            .agg(F.min_by("_i", "_o").alias("_i"))
            .select(F.col("_g").alias(group), F.col("_k").alias("key"), F.col("_i").alias(item)))


def resolve_cached_sets(sets: DataFrame, archives: DataFrame, dirs: DataFrame,
                        fp: str = "fp") -> DataFrame:
    """``reuse`` when the fingerprint has an archive, ``zip`` when it has a
    built folder, else ``build``."""
    a = archives.select(fp).distinct().withColumn("_arch", F.lit(True))
    d = dirs.select(fp).distinct().withColumn("_dir", F.lit(True))
    j = sets.join(a, on=fp, how="left").join(d, on=fp, how="left")
    action = (F.when(F.col("_arch"), "reuse").when(F.col("_dir"), "zip").otherwise("build"))
    return j.select(*[c for c in sets.columns], action.alias("action"))
