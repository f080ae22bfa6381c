"""Neighbours in an order inside groups of any size: windows over buckets of a group, and carries from bucket to bucket over a small table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Orders are cut into buckets of this width, so that a group is never sorted in one task.
WIDTH = 1000


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on the keys (nulls match) and the bucket; the right's columns come with a prefix."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in [*keys, "_bucket"]], *[F.col(c) for c in right.columns if c not in (*keys, "_bucket")])
    on = F.lit(True)
    for k in [*keys, "_bucket"]:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in [*keys, "_bucket"]])


def with_neighbours(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, before: str = "before", after: str = "after") -> DataFrame:
    """`df` with the value of the row before and of the row after, in the order inside the keys. `bucket` must not fall as the order rises."""
    cut_ = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    near = cut_.withColumn("_b", F.lag(value).over(inner)).withColumn("_a", F.lead(value).over(inner)).withColumn("_first", F.row_number().over(inner) == 1)
    near = near.withColumn("_last", F.lead(F.lit(True)).over(inner).isNull())
    place = F.struct(*order)
    ends = cut_.groupBy(*keys, "_bucket").agg(F.min_by(value, place).alias("_low"), F.max_by(value, place).alias("_high"))
    over = Window.partitionBy(*keys).orderBy("_bucket")
    carried = ends.select(*keys, "_bucket", F.lag("_high").over(over).alias("_cb"), F.lead("_low").over(over).alias("_ca"))
    joined = _matched(near, carried, keys)
    return joined.withColumn(before, F.when(F.col("_first"), F.col("_cb")).otherwise(F.col("_b"))).withColumn(after, F.when(F.col("_last"), F.col("_ca")).otherwise(F.col("_a"))).drop("_bucket", "_b", "_a", "_first", "_last", "_cb", "_ca")


def with_last(df: DataFrame, keys: list[str], order: list[str], values: dict[str, Column], bucket: Column, inclusive: bool = False) -> DataFrame:
    """`df` with, for each of `values`, the last one that is not null on an earlier row of the keys (or on the row itself)."""
    cut_ = df.withColumn("_bucket", bucket)
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    near = cut_.select("*", *[F.last(v, ignorenulls=True).over(inner).alias(f"_in_{n}") for n, v in values.items()])
    place = F.struct(*order)
    lasts = cut_.groupBy(*keys, "_bucket").agg(*[F.max_by(v, F.when(v.isNotNull(), place)).alias(f"_l_{n}") for n, v in values.items()])
    over = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(*keys, "_bucket", *[F.last(f"_l_{n}", ignorenulls=True).over(over).alias(f"_c_{n}") for n in values])
    joined = _matched(near, carried, keys)
    for n in values:
        joined = joined.withColumn(n, F.coalesce(f"_in_{n}", f"_c_{n}"))
    return joined.drop("_bucket", *[f"_in_{n}" for n in values], *[f"_c_{n}" for n in values])
