"""Ten-minute detail of one radar: resampled layers, a second integration, time by height."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SD_VVP, RAIN_BINS, RAIN_SHARE, RAIN_DBZ = 2.0, 3, 0.8, 7.0


def day_interval(layers: DataFrame, day: str, hours: int = 24) -> DataFrame:
    """Layers of a day, or of 72 hours centred on it; days without rows are no matter."""
    before = (hours // 24 - 1) // 2
    start = F.date_sub(F.lit(day).cast("date"), before).cast("timestamp")
    end = F.date_add(F.lit(day).cast("date"), hours // 24 - before).cast("timestamp")
    return layers.where((F.col("ts") >= start) & (F.col("ts") < end))


def resample_layers(layers: DataFrame, minutes: int = 10) -> DataFrame:
    """Means of each (radar, pulse, slot, height); a gap if any row is one."""
    slot = F.window("ts", f"{minutes} minutes").start
    return layers.groupBy("radar", "pulse", slot.alias("slot"), "height").agg(*[F.avg(c).alias(c) for c in ("dens", "eta", "ff", "sd_vvp", "dbzh")], F.bool_or("gap").alias("gap"))


def sd_filter(layers: DataFrame, low: float = 200.0, high: float = 4000.0) -> DataFrame:
    """Layers in the band with enough spread of speeds, without gaps; a missing spread drops a layer."""
    return layers.where((F.col("sd_vvp") >= SD_VVP) & F.col("height").between(low, high) & ~F.coalesce("gap", F.lit(False)))


def detail_metrics(slots: DataFrame) -> DataFrame:
    """VID, VIR, MTR and RTR of each slot.

    Unlike the archive's rule, a layer is as wide as the mean gap of heights, rain bins count
    at 7 dBZ and above, and their share is of all low layers. Rain leaves only VID and VIR.
    """
    ok = sd_filter(slots)
    low = F.col("height") <= 2000
    z: Column = F.lit(0.0)
    sums = ok.groupBy("radar", "pulse", "slot").agg(
        F.countDistinct("height").alias("n"), F.max("height").alias("top"), F.min("height").alias("bottom"), F.sum(F.coalesce("dens", z)).alias("d"), F.sum(F.coalesce("eta", z)).alias("e"),
        F.sum(F.coalesce(F.col("ff") * F.col("dens") * 3.6, z)).alias("m"), F.sum(F.coalesce(F.col("ff") * F.col("eta") * 3.6, z)).alias("r"),
        F.count_if(low).alias("low"), F.count_if(low & (F.col("dbzh") >= RAIN_DBZ)).alias("rain"),
    )
    width = F.when(F.col("n") > 1, (F.col("top") - F.col("bottom")) / F.greatest(F.col("n") - 1, F.lit(1))).otherwise(200.0) / 1000.0
    wet = (F.col("rain") >= RAIN_BINS) & (F.col("rain") / F.greatest("low", F.lit(1)) >= RAIN_SHARE)
    return sums.select(
        "radar", "pulse", "slot", (F.col("d") * width).alias("vid"), (F.col("e") * width).alias("vir"), F.when(~wet, F.col("m") * width).alias("mtr"), F.when(~wet, F.col("r") * width).alias("rtr"),
    )


def time_height(slots: DataFrame) -> DataFrame:
    """Density of each (slot, height) and its logarithmic share of the radar's largest, from 0 to 1."""
    top = slots.groupBy("radar", "pulse").agg(F.greatest(F.max("dens"), F.lit(1.0)).alias("_top"))
    share = F.log1p(F.greatest("dens", F.lit(0.0))) / F.log1p("_top")
    return slots.join(top, ["radar", "pulse"]).select("radar", "pulse", "slot", "height", "dens", F.least(F.lit(1.0), share).alias("share"))
