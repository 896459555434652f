"""What an archive should hold, what it holds, and what an incremental run has to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PULSES = ("lp", "sp")
KEY_PATTERN = r"([^/]+)/(\d{4})/(\d{8})_(lp|sp)_vpts\.(csv|h5)$"


def parse_object_key(key: Column) -> dict[str, Column]:
    """Radar, day, pulse and suffix of an archive key; else the first eight digits and the suffix."""
    text = lambda i: F.nullif(F.regexp_extract(key, KEY_PATTERN, i), F.lit(""))
    loose = F.nullif(F.regexp_extract(key, r"(\d{8})", 1), F.lit(""))
    day = F.try_to_date(F.coalesce(text(3), loose), "yyyyMMdd") if hasattr(F, "try_to_date") else F.coalesce(text(3), loose).try_cast("date")
    suffix = F.coalesce(text(5), F.nullif(F.regexp_extract(key, r"\.([A-Za-z0-9]+)$", 1), F.lit("")))
    return {"radar": text(1), "day": day, "pulse": text(4), "suffix": suffix}


def object_key(radar: Column, day: Column, pulse: Column, prefix: str = "vpts") -> Column:
    return F.concat(F.lit(prefix + "/"), radar, F.lit("/"), F.date_format(day, "yyyy"), F.lit("/"), F.date_format(day, "yyyyMMdd"), F.lit("_"), pulse, F.lit("_vpts.csv"))


def coverage_objects(coverage: DataFrame, source: str, radar: str, start: str, end: str) -> DataFrame:
    """Daily objects of a coverage listing (directory = source/kind/radar/Y/M/D); wrong dates are dropped."""
    p = F.split("directory", "/")
    day = F.concat_ws("-", F.get(p, F.lit(3)), F.lpad(F.get(p, F.lit(4)), 2, "0"), F.lpad(F.get(p, F.lit(5)), 2, "0")).try_cast("date")
    rows = coverage.select(F.get(p, F.lit(0)).alias("source"), F.get(p, F.lit(2)).alias("radar"), day.alias("day"))
    kept = rows.where((F.col("source") == source) & (F.col("radar") == radar) & F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).distinct()
    return kept.withColumn("key", F.concat("source", F.lit("/daily/"), "radar", F.lit("/"), F.date_format("day", "yyyy"), F.lit("/"), "radar", F.lit("_vpts_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")))


def date_spine(bounds: DataFrame) -> DataFrame:
    """A row a day from start to end, both included; `bounds` has start, end and any keys."""
    keys = [c for c in bounds.columns if c not in ("start", "end")]
    return bounds.where("start <= end").select(*keys, F.explode(F.sequence("start", "end")).alias("day"))


def month_periods(days: DataFrame) -> DataFrame:
    """First and last day of each month's part of a spine."""
    return days.groupBy(F.trunc("day", "month").alias("_m")).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("days")).drop("_m")


def expected_objects(radars: DataFrame, days: DataFrame) -> DataFrame:
    """Every radar, day and pulse: both sides are small, and the product is what is asked for."""
    return radars.select("radar").join(days.select("day")).withColumn("pulse", F.explode(F.array(*[F.lit(p) for p in PULSES])))


def expected_vs_available(radars: DataFrame, days: DataFrame, objects: DataFrame) -> DataFrame:
    """Expected (radar, day, pulse) with the key that is there, or null."""
    return expected_objects(radars, days).join(objects.select("radar", "day", "pulse", "key"), ["radar", "day", "pulse"], "left")


def radar_coverage(expected: DataFrame) -> DataFrame:
    """Days asked for, days with an object of any pulse, missing days and the share, by radar."""
    days = expected.groupBy("radar", "day").agg(F.count("key").alias("n"))
    return days.groupBy("radar").agg(
        F.count("*").alias("requested"), F.count_if(F.col("n") > 0).alias("available"),
        F.array_sort(F.collect_list(F.when(F.col("n") == 0, F.col("day").cast("string")))).alias("missing"),
        F.round(F.avg((F.col("n") > 0).cast("double")), 6).alias("fraction"),
    )


def prefer_lp(objects: DataFrame) -> DataFrame:
    """One object a (radar, day): the long pulse if there is one; and which pulses there are."""
    rest = [c for c in objects.columns if c not in ("radar", "day")]
    rank = F.when(F.col("pulse") == "lp", 0).otherwise(1)
    return objects.groupBy("radar", "day").agg(F.min(F.struct(rank.alias("rank"), *rest)).alias("m"), F.array_sort(F.collect_set("pulse")).alias("available_pulses")).select("radar", "day", *[f"m.{c}" for c in rest], "available_pulses")


def incremental_targets(catalog: DataFrame, cursor: DataFrame, lookback: int = 8, most: int = 7) -> DataFrame:
    """Days that each radar of the catalog (radar, last_date) has to be read for, given the cursor (radar, source_date).

    A new radar is read from `lookback` days before its newest day on. One that moved on is
    read from its cursor on, at most `most` days further, so that no day is skipped; one that
    did not is read for its last two days again. A newest day before the cursor is a regression.
    """
    both = catalog.select("radar", "last_date").join(cursor.select("radar", "source_date"), "radar", "left")
    last, was = F.col("last_date"), F.col("source_date")
    state = F.when(was.isNull(), "bootstrap").when(last < was, "regression").when(last == was, "unchanged").otherwise("catch_up")
    first = F.when(was.isNull(), F.date_sub(last, max(1, lookback))).when(last > was, was).otherwise(F.date_sub(last, 1))
    target = F.when(last > was, F.least(last, F.date_add(was, max(1, most)))).otherwise(last)
    return both.withColumns({"state": state, "first_date": first, "target_date": target})


def target_days(targets: DataFrame) -> DataFrame:
    """The days to read; a regression is an error and has none."""
    return date_spine(targets.where("state != 'regression'").select("radar", F.col("first_date").alias("start"), F.col("target_date").alias("end")))


def catch_up_status(targets: DataFrame, objects: DataFrame, cursor_objects: DataFrame) -> DataFrame:
    """What a run over the targets reads of each radar, and the cursor that it would leave.

    Of each day one object is selected (the long pulse if there is one). A radar has changed
    if its target isn't its cursor's day or a selected object's etag isn't the cursor's.
    """
    days = targets.select("radar", F.explode(F.sequence("first_date", "target_date")).alias("day"), "target_date")
    selected = prefer_lp(objects).join(days, ["radar", "day"]).join(cursor_objects.select("key", F.col("etag").alias("_was")), "key", "left")
    found = selected.groupBy("radar").agg(
        F.count("*").alias("n"), F.count_if(F.col("day") == F.col("target_date")).alias("at_target"), F.count_if(~F.col("etag").eqNullSafe(F.col("_was"))).alias("new"),
    )
    n = lambda c: F.coalesce(c, F.lit(0))
    return targets.join(found, "radar", "left").select(
        "radar", "state", F.col("target_date").alias("proposed_source_date"), F.date_sub("target_date", 1).alias("latest_complete_night"), n("n").alias("selected_file_count"),
        (n("at_target") == 0).alias("missing_target"), (~F.col("source_date").eqNullSafe(F.col("target_date")) | (n("new") > 0)).alias("changed"),
    )


def run_status(status: DataFrame) -> DataFrame:
    """One row: whether a run may go on, whether it has nothing to do, and how many files it reads. Any error leaves no files."""
    ok = F.bool_and((F.col("state") != "regression") & ~F.col("missing_target"))
    return status.agg(ok.alias("ok"), F.count_if("changed").alias("changed_radars"), F.sum(F.when(F.col("changed"), F.col("selected_file_count")).otherwise(0)).alias("files")).select(
        "ok", (F.col("ok") & (F.col("changed_radars") == 0)).alias("no_change"), "changed_radars", F.when(F.col("ok"), F.col("files")).otherwise(0).alias("files"),
    )


def missing_targets(catalog: DataFrame, objects: DataFrame) -> DataFrame:
    """Radars whose newest declared day has no object."""
    return catalog.join(objects.select("radar", F.col("day").alias("last_date")).distinct(), ["radar", "last_date"], "left_anti")


def latest_common_window(catalog: DataFrame, days: int, pinned: str | None = None) -> DataFrame:
    """One row: the window of `days` that ends the day before the earliest newest day, or at a pinned end, which may not be later."""
    common = F.date_sub(F.min("last_date"), 1)
    end = F.lit(pinned).cast("date") if pinned else F.col("common")
    return catalog.agg(common.alias("common")).withColumn("end", end).withColumn("start", F.date_sub("end", days - 1)).withColumn("ok", F.col("end") <= F.col("common"))


def changed_radars(objects: DataFrame, cursor_objects: DataFrame) -> DataFrame:
    """Radars with objects that are new or whose etag isn't the cursor's, and how many."""
    was = cursor_objects.select("key", F.col("etag").alias("_was"))
    both = objects.join(was, "key", "left")
    return both.groupBy("radar").agg(F.count_if(~F.col("etag").eqNullSafe(F.col("_was"))).alias("changed"), F.max("day").alias("source_date")).where("changed > 0")


def catalog_health(catalog: DataFrame, generated_at: str, now: str, declared: int) -> DataFrame:
    """One row: age in hours and the problems of a catalog."""
    age = (F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.lit(generated_at).cast("timestamp"))) / 3600.0
    found = F.array_compact(F.array(
        F.when(F.col("age_hours") < -1, F.lit("future")), F.when(F.col("age_hours") > 48, F.lit("stale")), F.when(F.col("radars") != declared, F.lit("radar_count")),
    ))
    return catalog.agg(F.countDistinct("radar").alias("radars")).withColumn("age_hours", age).withColumn("problems", found)


def manifest_summary(objects: DataFrame) -> DataFrame:
    """One row: count, sorted radars, first and last day, and whether every record is whole."""
    return objects.agg(
        F.count("*").alias("count"), F.array_sort(F.collect_set("radar")).alias("radars"), F.min("day").alias("first_day"), F.max("day").alias("last_day"),
        F.bool_and(F.col("key").isNotNull() & F.col("pulse").isNotNull()).alias("ok"),
    )


def first_n_objects(objects: DataFrame, n: int) -> DataFrame:
    """The first objects in order of radar, day and pulse, when a run is to read only so many."""
    return objects.orderBy("radar", "day", "pulse").limit(n)
