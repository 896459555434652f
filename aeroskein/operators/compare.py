"""Comparison of archives: nearest profiles, common altitudes, error statistics, crosswalks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.functions.domain import match_class
from aeroskein.operators.quantiles import quantiles
from aeroskein.sources.scratch import written

TOLERANCE_S = 300


def select_nearest_profile(layers: DataFrame, requested: Column) -> DataFrame:
    """All layers of the time nearest to the requested one, by radar; of equals the earlier."""
    gap = F.abs(F.unix_micros("ts") - F.unix_micros(requested))
    best = layers.groupBy("radar").agg(F.min(F.struct(gap.alias("gap"), F.col("ts"))).alias("m")).select("radar", F.col("m.ts").alias("ts"))
    return layers.join(best, ["radar", "ts"])


def asof_nearest(left: DataFrame, right: DataFrame, by: tuple[str, ...] = ("radar",), tolerance_s: int = TOLERANCE_S, nearest: int = 1) -> DataFrame:
    """For each row of `left` (by, ts) the row of `right` nearest in time on the same day, if within tolerance.

    Times fall in buckets as long as the tolerance, so a partner is in the same or a
    neighbouring bucket: a hash join, never a comparison of all times. Columns of the right
    side get the suffix _r; of equally near rows the earlier is taken. With nearest > 1 that
    many are taken, numbered in column rank.
    """
    keys = list(by)
    bucket = F.floor(F.unix_seconds("ts") / tolerance_s)
    # rows of one time share their partner, so each time is looked up once
    a = left.select(*keys, "ts").distinct().withColumn("_b", bucket)
    b = right.withColumn("_day", F.to_date("ts")).select(*keys, *[F.col(c).alias(f"{c}_r") for c in right.columns if c not in keys], "_day", F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("_b"))
    gap = F.abs(F.unix_micros("ts") - F.unix_micros("ts_r"))
    near = a.join(b, [*keys, "_b"]).where((F.to_date("ts") == F.col("_day")) & (gap <= tolerance_s * 1_000_000))
    w = Window.partitionBy(*keys, "ts").orderBy(gap, "ts_r", *[c for c in b.columns if c.endswith("_r") and c != "ts_r"])
    best = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= nearest)
    best = best if nearest > 1 else best.drop("rank")
    best = best.withColumn("offset_s", (F.unix_micros("ts") - F.unix_micros("ts_r")) / 1e6).withColumn("match", match_class(F.abs("offset_s"))).drop("_b", "_day")
    return left.join(best, [*keys, "ts"])


def match_altitudes(left: DataFrame, right: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """Rows of both sides at one height with the variables as <name>_a and <name>_b; each side's last row of a height counts."""

    def last(df: DataFrame, mark: str) -> DataFrame:
        return df.groupBy(*keys, "height").agg(*[F.max_by(v, "bin").alias(f"{v}_{mark}") for v in variables])

    return last(left, "a").join(last(right, "b"), [*keys, "height"])


def long_pairs(matched: DataFrame, keys: list[str], variables: list[str]) -> DataFrame:
    """One row a variable: (keys, variable, a, b), complete pairs only."""
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_a").cast("double").alias("a"), F.col(f"{v}_b").cast("double").alias("b")) for v in variables]))
    return matched.select(*keys, rows.alias("p")).select(*keys, "p.*").where("a is not null and b is not null")


def error_metrics(pairs: DataFrame, by: list[str], digits: int | None = None) -> DataFrame:
    """Count, means, bias, MAE and RMSE of b - a in each group."""
    d = F.col("b") - F.col("a")
    out = pairs.groupBy(*by).agg(
        F.count("*").alias("count"), F.avg("a").alias("mean_a"), F.avg("b").alias("mean_b"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"),
    )
    return out if digits is None else out.withColumns({c: F.round(c, digits) for c in ("mean_a", "mean_b", "bias", "mae", "rmse")})


def safe_corr(a: str, b: str) -> Column:
    """Pearson's coefficient from sums; null if either side doesn't vary."""
    n = F.count("*").cast("double")
    va, vb = F.var_pop(a), F.var_pop(b)
    return F.when((n > 1) & (va > 0) & (vb > 0), F.covar_pop(a, b) / F.nullif(F.sqrt(va * vb), F.lit(0.0)))


def pair_statistics(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Error metrics with correlation and median ratio of (by, variable, a, b); the median of log10 ratios for densities."""
    pairs = written(pairs.select(*dict.fromkeys([*by, "variable", "a", "b"])), "pairs")
    d = F.col("b") - F.col("a")
    sums = pairs.groupBy(*by).agg(
        F.count("*").alias("count"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"), safe_corr("a", "b").alias("correlation"),
    )
    ratio = F.col("a") / F.nullif("b", F.lit(0.0))
    kinds = F.array(F.struct(F.lit("median_ratio").alias("kind"), ratio.alias("x")), F.struct(F.lit("median_log10_ratio").alias("kind"), F.when(F.col("variable") == "dens", F.log10(ratio)).alias("x")))
    ratios = pairs.where("a > 0 and b > 0").select(*by, F.explode(kinds).alias("r")).select(*by, "r.*")
    medians = quantiles(ratios, [*by, "kind"], "x", {"median": 0.5})
    of = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("median"))).alias(kind)
    return sums.join(medians.groupBy(*by).agg(of("median_ratio"), of("median_log10_ratio")), by, "left")


def median_offsets(matched: DataFrame, by: list[str]) -> DataFrame:
    """(by, median_offset_s): the median distance in time of matched profiles (by, offset_s), whatever its sign."""
    return quantiles(matched.withColumn("_gap", F.abs("offset_s")), by, "_gap", {"median_offset_s": 0.5})


def unmatched_radars(mapping: DataFrame, radars: DataFrame) -> DataFrame:
    """Radars that no mapping names, by name."""
    return radars.select("radar").distinct().join(mapping.select("radar"), "radar", "left_anti").orderBy("radar")


def build_crosswalk(mapping: DataFrame, radars: DataFrame, sources: list[str], classes: list[str]) -> DataFrame:
    """Mapping (radar, other, source, class, tolerance_s) with its problems; a default tolerance of 0 if exact, else 300."""
    twice = mapping.groupBy("radar").agg(F.count("*").alias("_n"))
    known = radars.select("radar", F.lit(True).alias("_known"))
    problems = F.array_compact(F.array(
        F.when(F.col("_known").isNull(), F.lit("unknown_radar")), F.when(~F.col("source").isin(*sources), F.lit("source")), F.when(~F.col("class").isin(*classes), F.lit("class")), F.when(F.col("_n") > 1, F.lit("duplicate")),
    ))
    out = mapping.join(twice, "radar").join(known, "radar", "left").withColumn("problems", problems)
    return out.withColumn("tolerance_s", F.coalesce("tolerance_s", F.when(F.col("class") == "exact", 0).otherwise(TOLERANCE_S))).drop("_n", "_known")


def comparison_index(crosswalk: DataFrame, reports: DataFrame) -> DataFrame:
    """Each crosswalk entry with its newest report (radar, source, other, generated_at, levels), or none; of equals the first.

    Names of radars agree whatever their case; an archive's source has to be the same.
    """
    names = [F.lower("radar").alias("_radar"), F.col("source").alias("_source"), F.lower("other").alias("_other")]
    newest = reports.groupBy(*names).agg(F.max(F.struct("generated_at", F.negative("order").alias("o"), "levels")).alias("m"))
    joined = crosswalk.join(newest, (F.lower("radar") == F.col("_radar")) & (F.col("source") == F.col("_source")) & (F.lower("other") == F.col("_other")), "left")
    return joined.select(*crosswalk.columns, F.col("m").isNotNull().alias("report_available"), F.col("m.generated_at").alias("generated_at"), F.col("m.levels").alias("levels"))


def comparison_status(radars: DataFrame, index: DataFrame) -> DataFrame:
    """none, configured, or published with its number of levels, by radar."""
    joined = radars.select("radar").join(index.select("radar", "report_available", "levels"), "radar", "left")
    text = F.when(F.col("report_available").isNull(), "none").when(~F.col("report_available"), "configured").otherwise(F.concat(F.lit("published ("), F.col("levels").cast("string"), F.lit(" levels)")))
    return joined.select("radar", text.alias("status"))


def match_hours(observed: DataFrame, predicted: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Observed and predicted rows of equal keys; of several predictions of a key the last by `order` counts."""
    rest = [c for c in predicted.columns if c not in (*keys, order)]
    last = predicted.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in rest])
    return observed.join(last, keys)
