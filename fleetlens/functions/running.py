"""Skew-safe running (cumulative) sums.

``sum(v) over (partition by k order by o rows unbounded preceding)`` puts
every row of one key into one task; a key that holds a third of the table
then runs on one core. Here the ordered rows of a key are cut into buckets
by an expression that does not decrease along the order (a time bucket, for
example). Each (key, bucket) gets its own window, and the totals of the
earlier buckets of the same key are added as an offset:

    running(row) = sum within (key, bucket) up to row
                 + sum of totals of (key, earlier buckets)

The offsets come from a partial aggregate with one row per (key, bucket),
so the only full-size shuffle is the one on (key, bucket). The result is
exact for any bucketing; finer buckets spread a hot key wider.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_rs_bucket"


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 values: Mapping[str, Column], bucket: Column) -> DataFrame:
    """Add one inclusive running-sum column per entry of ``values``.

    ``bucket`` must be non-decreasing in ``order`` within each key.
    """
    names = list(values)
    staged = df.select("*", bucket.alias(_BUCKET),
                       *[v.cast("bigint").alias(f"_rs_v_{n}") for n, v in values.items()])
    part = [*keys, _BUCKET]
    inner = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = staged.select(
        "*", *[F.sum(f"_rs_v_{n}").over(inner).alias(f"_rs_in_{n}") for n in names])

    totals = staged.groupBy(*part).agg(*[F.sum(f"_rs_v_{n}").alias(f"_rs_t_{n}") for n in names])
    before = Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part, *[F.coalesce(F.sum(f"_rs_t_{n}").over(before), F.lit(0)).alias(f"_rs_o_{n}")
                 for n in names])

    # Null-safe keys: rows with a null key or bucket form their own group in
    # the window and must find their offset too.
    o = offsets.select(*[F.col(c).alias(f"_rs_k{i}") for i, c in enumerate(part)],
                       *[f"_rs_o_{n}" for n in names])
    cond = [within[c].eqNullSafe(o[f"_rs_k{i}"]) for i, c in enumerate(part)]
    joined = within.join(o, on=cond, how="inner")
    out_cols = [c for c in df.columns if c not in names]
    return joined.select(
        *out_cols, *[(F.col(f"_rs_in_{n}") + F.coalesce(F.col(f"_rs_o_{n}"), F.lit(0))).alias(n)
                     for n in names])
