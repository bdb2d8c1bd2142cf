"""Positions and running totals over big groups.

A plain window over one key puts the whole key into one task. Here each group is
first cut into order-preserving buckets; the window runs inside a bucket and a
small table of bucket offsets makes the result global. A key that holds a third
of all rows is thus spread over as many tasks as there are buckets. Buckets come
from a number (``with_buckets``) or from sampled bounds of the whole sort key
(``ranged``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.session import written

BUCKET = "_bucket"
PART = "_part"


def with_buckets(df: DataFrame, value: Column, buckets: int | None = None) -> DataFrame:
    """Add an order-preserving bucket number for a numeric ``value``.

    Bounds are approximate quantiles (a fixed-size list), so buckets hold similar
    numbers of rows whatever the distribution; equal values share a bucket.
    """
    spark = df.sparkSession
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    marks = [i / buckets for i in range(1, buckets)]
    keyed = df.withColumn("_value", value.cast("double"))
    bounds = keyed.agg(F.percentile_approx("_value", marks, 10 * buckets)).first()[0] or []
    splits = [float("-inf"), *sorted(set(bounds)), float("inf")]
    binned = Bucketizer(splits=splits, inputCol="_value", outputCol=BUCKET).transform(keyed)
    return binned.withColumn(BUCKET, F.col(BUCKET).cast("int")).drop("_value")


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Running sum of ``value`` per ``keys`` in ``order``; ``df`` carries BUCKET."""
    group = [*keys, BUCKET]
    last = W.currentRow if inclusive else -1
    inside = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    before = W.partitionBy(*keys).orderBy(BUCKET).rowsBetween(W.unboundedPreceding, -1)
    # One row per key and bucket: the unsplit window below never sees more.
    offsets = (
        df.groupBy(*group)
        .agg(F.sum(value).alias("_sum"))
        .select(*group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    local = df.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        local.join(offsets, group)
        .withColumn(out, F.col(out) + F.col("_offset"))
        .drop("_offset", BUCKET)
    )


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str
) -> DataFrame:
    """1-based position per ``keys``; ``value`` is numeric and agrees with ``order``."""
    return running(with_buckets(df, value), keys, order, F.lit(1).cast("long"), out)


def ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` range-sorted into parts of similar size, numbered in ``order`` by PART; nulls come first.

    Bounds are sampled from whole keys, so terms that share a long beginning are
    spread as well; rows with equal keys share a part. The rows are written, so
    that a part stays what it is.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(parts, *order).withColumn(PART, F.spark_partition_id()), "ranged")


def part_offsets(parts: DataFrame, value: Column) -> DataFrame:
    """(PART, _sum, _offset): total of ``value`` in each part and in all parts before it (one row per part)."""
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    sums = parts.groupBy(PART).agg(F.sum(value).alias("_sum"))
    return sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0)))


def running_by_range(
    df: DataFrame, order: Sequence[str], values: dict[str, Column], inclusive: bool = True
) -> DataFrame:
    """Running sums over the whole table in ``order`` (ascending, nulls first), by output name."""
    parts = ranged(df, order)
    last = W.currentRow if inclusive else -1
    inside = W.partitionBy(PART).orderBy(*order).rowsBetween(W.unboundedPreceding, last)
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    # One row per partition of the sort: a setting, not a size of the data.
    sums = parts.groupBy(PART).agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    offsets = sums.select(PART, *[F.coalesce(F.sum(f"_sum_{k}").over(before), F.lit(0)).alias(f"_offset_{k}") for k in values])
    local = parts.withColumns({k: F.coalesce(F.sum(v).over(inside), F.lit(0)) for k, v in values.items()})
    placed = local.join(F.broadcast(offsets), PART).withColumns({k: F.col(k) + F.col(f"_offset_{k}") for k in values})
    return placed.drop(PART, *[f"_offset_{k}" for k in values])
