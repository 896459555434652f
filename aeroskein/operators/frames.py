"""Predictions as frames: long to wide, nested by hour, checked by day, with colour scales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.functions.scales import log_ticks, nice_ceil, nice_floor
from aeroskein.operators.quantiles import quantiles, values_at
from aeroskein.sources.scratch import written

TARGETS = ("mtr", "vid", "u", "v")
#: Side of a frame's tiles.
TILE_DEGREES = 5.0
#: Cells of frames that a task puts in order, as whole rows of the grid.
ROWS_A_TASK = 250_000


def to_long(wide: DataFrame, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """(hour, pulse, latitude, longitude, support, target, value, uncertainty) from columns of targets."""
    rows = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("value"), F.col(f"uncertainty_{t}").alias("uncertainty")) for t in targets]))
    return wide.select("hour", "pulse", "latitude", "longitude", "support", rows.alias("r")).select("hour", "pulse", "latitude", "longitude", "support", "r.*")


def to_wide(long: DataFrame, targets: tuple[str, ...] = TARGETS) -> DataFrame:
    """A column for each target, the largest uncertainty, and only cells that have all targets.

    One aggregation with partial sums; a target's largest value stands for repeated ones.
    """
    wide = long.groupBy("hour", "pulse", "latitude", "longitude").agg(
        F.max("support").alias("support"), F.max("uncertainty").alias("uncertainty"), *[F.max(F.when(F.col("target") == t, F.col("value"))).alias(t) for t in targets],
    )
    return wide.dropna(subset=list(targets))


def tile() -> list[Column]:
    """South-western corner of a cell's tile."""
    return [(F.floor(F.col(axis) / F.lit(TILE_DEGREES)) * F.lit(TILE_DEGREES)).cast("double").alias(f"tile_{axis}") for axis in ("latitude", "longitude")]


def nest_frames(wide: DataFrame, fields: tuple[str, ...] = (*TARGETS, "support")) -> DataFrame:
    """One row a (pulse, hour, tile) with the tile's cells from north to south, then west to east.

    A tile is a square of TILE_DEGREES, named by its south-western corner, so a row holds what
    the grid's step lets into it, however large the map is. Cells that come dealt by tile() are nested where they are.
    """
    cell = F.struct(F.negative("latitude").alias("_south"), F.col("longitude"), F.col("latitude"), *fields)
    nested = wide.groupBy("pulse", "hour", *tile()).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    return nested.withColumn("cells", F.transform("cells", lambda c: c.dropFields("_south"))).withColumn("cell_count", F.size("cells"))


def day_checks(wide: DataFrame) -> DataFrame:
    """Of each (pulse, day): hours, fewest and most cells an hour, and whether the day is whole."""
    hours = wide.groupBy("pulse", "hour").agg(F.count("*").alias("cells"))
    days = hours.groupBy("pulse", F.to_date("hour").alias("day")).agg(F.count("*").alias("hours"), F.min("cells").alias("fewest"), F.max("cells").alias("most"))
    return days.withColumn("ok", (F.col("hours") == 24) & (F.col("fewest") == F.col("most")) & (F.col("fewest") >= 1))


def equal_grids(wide: DataFrame) -> DataFrame:
    """Cells that only one pulse has."""
    cells = wide.groupBy("latitude", "longitude").agg(F.array_sort(F.collect_set("pulse")).alias("pulses"))
    return cells.where(F.size("pulses") < 2)


def merge_days(parts: list[DataFrame]) -> DataFrame:
    """Union of daily predictions, which must have the same columns."""
    first, *rest = parts
    for p in rest:
        if set(p.columns) != set(first.columns):
            raise ValueError("daily predictions differ in columns")
        first = first.unionByName(p)
    return first


def merge_checks(wide: DataFrame, spine: DataFrame) -> DataFrame:
    """Of each expected day: its hours and cells; ok if there are 24 hours and as many cells as on other days."""
    days = wide.groupBy(F.to_date("hour").alias("day")).agg(F.countDistinct("hour").alias("hours"), F.countDistinct("latitude", "longitude").alias("cells"))
    usual = days.agg(F.max("cells").alias("usual"))
    joined = spine.join(days, "day", "left").join(usual)
    return joined.select("day", F.coalesce("hours", F.lit(0)).alias("hours"), F.coalesce("cells", F.lit(0)).alias("cells"), F.coalesce((F.col("hours") == 24) & (F.col("cells") == F.col("usual")), F.lit(False)).alias("ok"))


def axis_steps(cells: DataFrame, axis: str, default: float = 0.25) -> DataFrame:
    """One row: distinct values of an axis, its ends and the smallest step between neighbours."""
    values = cells.select(axis).distinct()
    gaps = values.withColumn("gap", F.col(axis) - F.lag(axis).over(Window.orderBy(axis)))
    return gaps.agg(F.count("*").alias(f"{axis}_count"), F.min(axis).alias(f"{axis}_min"), F.max(axis).alias(f"{axis}_max"), F.coalesce(F.min(F.when(F.col("gap") > 0, F.round("gap", 9))), F.lit(default)).alias(f"{axis}_step"))


def grid_descriptor(cells: DataFrame) -> DataFrame:
    """One row: steps, counts, bounds by half steps and number of cells. An axis has few distinct values."""
    distinct = cells.select("latitude", "longitude").distinct()
    both = axis_steps(distinct, "latitude").join(axis_steps(distinct, "longitude")).join(distinct.agg(F.count("*").alias("cell_count")))
    edge = lambda axis, end, sign: F.col(f"{axis}_{end}") + sign * F.col(f"{axis}_step") / 2
    return both.select(
        "latitude_step", "longitude_step", "latitude_count", "longitude_count", "cell_count", edge("longitude", "min", -1).alias("west"), edge("longitude", "max", 1).alias("east"),
        edge("latitude", "min", -1).alias("south"), edge("latitude", "max", 1).alias("north"),
    )


def log_scale(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Bounds and ticks of a logarithmic scale: the 1 and 99 % quantiles of positive values, rounded outwards."""
    q = quantiles(rows.where(F.col(value) > 0), by, value, {"q_low": 0.01, "q_high": 0.99})
    low, high = nice_floor(F.col("q_low")), nice_ceil(F.col("q_high"))
    out = q.select(*by, low.alias("minimum"), F.when(high > low, high).otherwise(nice_ceil(low * 10.0)).alias("maximum"))
    return out.withColumn("ticks", log_ticks(F.col("minimum"), F.col("maximum")))


def linear_scale(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Bounds and five ticks of a linear scale: the 5 and 95 % quantiles."""
    q = rows.select(*by).distinct().join(quantiles(rows, by, value, {"q_low": 0.05, "q_high": 0.95}), by, "left")
    low, high = F.coalesce("q_low", F.lit(0.0)), F.coalesce("q_high", F.lit(1.0))
    out = q.select(*by, low.alias("minimum"), F.when(high > low, high).otherwise(low + 1.0).alias("maximum"))
    step = (F.col("maximum") - F.col("minimum")) / 4
    return out.withColumn("ticks", F.array(*[F.col("minimum") + step * i for i in range(5)]))


def fallback_scale(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """Bounds at places floor(.05 n) and min(n - 1, floor(.95 n)) of sorted values."""
    low, high = F.floor(F.col("total") * 0.05), F.least(F.col("total") - 1, F.floor(F.col("total") * 0.95))
    return values_at(rows, by, value, {"minimum": low, "maximum": high})


def bounded_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows of smallest key hash: the same whatever the layout."""
    return rows.orderBy(F.md5(F.col(key).cast("string").cast("binary")), key).limit(n)


def visible_cells(wide: DataFrame, least: float = 10.0) -> DataFrame:
    return wide.where(F.col("mtr") >= least)


def every_nth(wide: DataFrame, stride: int = 8) -> DataFrame:
    """Every stride-th cell of each frame, from north to south and west to east.

    Cells are counted by row of the grid; a row's first number is that of all cells further
    north, so only a row's own cells are put in order together, never a frame's. Rows are dealt to as many
    tasks as they fill, by a text of their latitude, since Spark deals doubles anew for a window.
    """
    frame, row = ["pulse", "hour"], ["pulse", "hour", "_row"]
    cells = wide.withColumn("_row", (F.col("latitude") + 0.0).cast("string"))
    rows = written(cells.groupBy(*row).agg(F.max("latitude").alias("_north"), F.count("*").alias("_cells")), "rows")
    tasks = max(1, -(-(rows.agg(F.sum("_cells")).first()[0] or 0) // ROWS_A_TASK))
    north = Window.partitionBy(*frame).orderBy(F.desc("_north")).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.select(*row, F.coalesce(F.sum("_cells").over(north), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*row).orderBy("longitude")) - 1
    dealt = cells.repartition(tasks, *row).withColumn("_n", inside)
    return dealt.join(starts, row).where((F.col("_start") + F.col("_n")) % stride == 0).select(*wide.columns)
