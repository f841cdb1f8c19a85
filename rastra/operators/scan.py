"""Ranks and running sums over whole tables without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_sum(df: DataFrame, value: Column, bucket: Column, order: list[Column], group: list[str] | None = None, name: str = "running") -> DataFrame:
    """Adds the sum of ``value`` over all rows before a row, in the order of ``bucket`` and then ``order``.

    ``bucket`` must be monotone in the order and spread the rows; each bucket is
    summed in a task of its own and the buckets' totals are summed in one, so
    the number of buckets has to be small and not that of rows.
    """
    group = group or []
    dealt = df.withColumns({"_v": value, "_b": bucket})
    totals = dealt.groupBy(*group, "_b").agg(F.sum("_v").alias("_total"))
    before = F.sum("_total").over(Window.partitionBy(*group, F.lit(0)).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    base = totals.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_b").alias("_bb"), F.coalesce(before, F.lit(0)).alias("_base"))
    on = F.col("_b").eqNullSafe(F.col("_bb"))
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = F.sum("_v").over(Window.partitionBy(*group, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    out = dealt.withColumn("_in", F.coalesce(inside, F.lit(0))).join(base, on)
    return out.withColumn(name, F.col("_in") + F.col("_base")).drop("_v", "_b", "_bb", "_in", "_base", *[f"_g{i}" for i in range(len(group))])


def global_rank(df: DataFrame, bucket: Column, order: list[Column], group: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Adds the number of rows before a row, from 0."""
    return running_sum(df, F.lit(1).cast("long"), bucket, order, group, name)
