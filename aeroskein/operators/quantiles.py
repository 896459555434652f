"""Exact values at places of sorted groups, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.sources.scratch import scratch_path


def running_counts(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, x, n, upto, total): each value of a group, how many rows have it, or it or a smaller one, and how many there are.

    Equal values are counted first. The counts are range-partitioned by group and value and
    written, so that a group spreads over as many tasks as it fills; running sums are made
    within a partition and start from the partitions' totals. Nulls don't count.
    """
    spark = rows.sparkSession
    counts = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("x")).agg(F.count("*").alias("n"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = counts.repartitionByRange(parts, *by, "x").withColumn("_part", F.spark_partition_id())
    path = scratch_path(spark, "places")
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    group = Window.partitionBy(*by)
    totals = cut.groupBy(*by, "_part").agg(F.sum("n").alias("_m"))
    before = F.coalesce(F.sum("_m").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_of"), before.alias("_before"), F.sum("_m").over(group).alias("total"))
    inside = F.sum("n").over(Window.partitionBy(*by, "_part").orderBy("x"))
    same = F.col("_part") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return cut.withColumn("_upto", inside).join(starts, same).select(*by, "x", "n", (F.col("_upto") + F.col("_before")).alias("upto"), "total")


def values_at(rows: DataFrame, by: list[str], value: str, places: dict[str, Column]) -> DataFrame:
    """(by, names): the values at places, counted from 0, of a group's sorted values; places may use column total."""
    return running_counts(rows, by, value).groupBy(*by).agg(*[F.min(F.when(F.col("upto") > place, F.col("x"))).alias(name) for name, place in places.items()])


def quantiles(rows: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """(by, names): quantiles of a group's values, interpolated between the two nearest places."""
    at = {name: F.lit(float(share)) * (F.col("total") - 1) for name, share in shares.items()}
    places = {f"{name}{end}": f(place) for name, place in at.items() for end, f in (("_low", F.floor), ("_high", F.ceil))}
    found = running_counts(rows, by, value).groupBy(*by).agg(
        F.max("total").alias("total"), *[F.min(F.when(F.col("upto") > place, F.col("x"))).alias(name) for name, place in places.items()],
    )
    part = lambda name: at[name] - F.floor(at[name])
    low, high = (lambda name: F.col(f"{name}_low")), (lambda name: F.col(f"{name}_high"))
    return found.select(*by, *[(low(n) * (1 - part(n)) + high(n) * part(n)).alias(n) for n in shares])
