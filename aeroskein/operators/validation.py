"""Scores of predictions, ranks and agreement of aggregates, model selection rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.operators.compare import safe_corr
from aeroskein.operators.quantiles import quantiles, running_counts
from aeroskein.sources.scratch import written

#: The targets of models, intensities and parts of the vector.
INTENSITY, VECTORS = ("mtr_birds_km_h", "vid_birds_per_km2"), ("bird_u_ms", "bird_v_ms")
VALIDATIONS = ("leave_one_radar_out", "blocked_time")


def score_regression(pairs: DataFrame, by: list[str]) -> DataFrame:
    """RMSE, MAE, bias, R2 and precision and recall of the top decile of (by, observed, predicted).

    The decile is the 0.9 quantile of what was observed, by group. Undefined shares are 0. The
    pairs are written once: cut and sums read what is written.
    """
    pairs = written(pairs.select(*by, "observed", "predicted"), "pairs")
    e = F.col("predicted") - F.col("observed")
    o = F.col("observed")
    # sums about the mean need no second look at the rows
    sums = pairs.groupBy(*by).agg(
        F.count("*").alias("row_count"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.avg(e).alias("bias"), F.sum(e * e).alias("_ee"), (F.var_pop(o) * F.count(o)).alias("_oo"),
    )
    cut = quantiles(pairs, by, "observed", {"_cut": 0.9})
    hit, said = o >= F.col("_cut"), F.col("predicted") >= F.col("_cut")
    events = pairs.join(cut, by).groupBy(*by).agg(F.count_if(hit & said).alias("_both"), F.count_if(said).alias("_said"), F.count_if(hit).alias("_hit"))
    share = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.join(events, by).select(
        *by, "row_count", "rmse", "mae", "bias", F.coalesce(1 - F.try_divide(F.col("_ee"), F.col("_oo")), F.lit(0.0)).alias("r_squared"),
        share(F.col("_both"), F.col("_said")).alias("top_decile_precision"), share(F.col("_both"), F.col("_hit")).alias("top_decile_recall"),
    )


def pooled_and_per_site(pairs: DataFrame, group: str, site: str) -> DataFrame:
    """Error metrics of each (group, site) and of each group over all sites, whose site is null."""
    d = F.col("predicted") - F.col("observed")
    return pairs.groupingSets([[group, site], [group]], group, site).agg(
        F.count("*").alias("count"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.sqrt(F.avg(d * d)).alias("rmse"),
    )


def average_ranks(rows: DataFrame, by: list[str], *values: str) -> DataFrame:
    """Ranks of each value within a group, ties averaged, as rank_<value>; a null has none.

    Ranks come from running counts of the distinct values, which no task holds a group of, and
    are joined back by group and value.
    """
    out = rows
    for v in values:
        counts = running_counts(rows, by, v).select(*[F.col(c).alias(f"_{c}") for c in by], "x", (F.col("upto") - (F.col("n") - 1) / 2.0).alias(f"rank_{v}"))
        same = F.col(v) == F.col("x")
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        out = out.join(counts, same, "left").drop("x", *[f"_{c}" for c in by])
    return out


def pearson(a: str, b: str) -> Column:
    """Pearson's coefficient; 0 if it isn't defined."""
    return F.coalesce(safe_corr(a, b), F.lit(0.0))


def spearman(rows: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    return average_ranks(rows, by, a, b).groupBy(*by).agg(pearson(f"rank_{a}", f"rank_{b}").alias("spearman"))


def top_fraction(rows: DataFrame, by: list[str], value: str, order: list[str], fraction: float = 0.2) -> DataFrame:
    """Flag top_<value>: the highest ceil(fraction * n) rows of a group, at least one; ties by `order`; nulls are lowest.

    The value at the cut comes from running counts. Rows above it are in; only those that equal
    it are put in order.
    """
    out = rows.withColumn("_v", F.coalesce(F.col(value).cast("double"), F.lit(float("-inf"))))
    wanted = F.greatest(F.lit(1), F.ceil(F.col("total") * fraction))
    above = F.col("total") - F.col("upto")
    cuts = running_counts(out, by, "_v").where((above < wanted) & (wanted <= above + F.col("n")))
    cuts = cuts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("x").alias("_cut"), (wanted - above).alias("_left"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # a group has one cut
    at = out.join(cuts, same).drop(*[f"_{c}" for c in by])
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    ties = at.where("_v = _cut").withColumn(f"top_{value}", place <= F.col("_left"))
    rest = at.where("_v <> _cut").withColumn(f"top_{value}", F.col("_v") > F.col("_cut"))
    return rest.unionByName(ties).drop("_v", "_cut", "_left")


def top_overlap(rows: DataFrame, by: list[str], a: str, b: str, order: list[str]) -> DataFrame:
    """Jaccard similarity of the top fifths by a and by b."""
    both = top_fraction(top_fraction(rows, by, a, order), by, b, order)
    x, y = F.col(f"top_{a}"), F.col(f"top_{b}")
    return both.groupBy(*by).agg((F.count_if(x & y) / F.count_if(x | y)).alias("overlap"))


def peak_rows(rows: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """The row of a group with the highest value; of equals the first by `order`."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def top_rows(rows: DataFrame, by: list[str], value: str, order: str, k: int) -> DataFrame:
    """The k rows of a group with the highest values, numbered in column place; of equals the first by `order`."""
    w = Window.partitionBy(*by).orderBy(F.desc(value), order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def peak_timing_error(rows: DataFrame) -> DataFrame:
    """Weeks between the peaks of the two series by region."""
    a = peak_rows(rows, ["region"], "reporting_rate", "week_start").select("region", F.col("week_start").alias("rate_peak"))
    b = peak_rows(rows, ["region"], "radar_intensity", "week_start").select("region", F.col("week_start").alias("radar_peak"))
    return a.join(b, "region").withColumn("weeks", F.abs(F.datediff("rate_peak", "radar_peak")) / 7.0)


def match_region_weeks(bto: DataFrame, radar: DataFrame) -> DataFrame:
    """Both series of a (region, week); of several radar rows the last by row_order counts."""
    last = radar.groupBy("region", "week_start").agg(F.max_by("radar_intensity", "row_order").alias("radar_intensity"))
    return bto.join(last, ["region", "week_start"])


def metric_delta(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """R2 and RMSE of both runs by (pulse, target), and the candidate's gain; a missing side gives null."""
    side = lambda df, m: df.select("pulse", "target", F.col("r_squared").alias(f"r_squared_{m}"), F.col("rmse").alias(f"rmse_{m}"))
    both = side(baseline, "baseline").join(side(candidate, "candidate"), ["pulse", "target"], "full_outer")
    return both.withColumn("d_r_squared", F.col("r_squared_candidate") - F.col("r_squared_baseline")).withColumn("d_rmse", F.col("rmse_candidate") - F.col("rmse_baseline"))


def blocked_time_split(rows: DataFrame, share: float = 0.8, least_times: int = 10, least_train: int = 30, least_test: int = 1) -> DataFrame:
    """`rows` with is_train: times up to the one at place floor(share * n) of the sorted distinct times.

    Without enough times, or enough rows on either side, there are no rows. Times are ranked
    among the distinct ones, which are few against rows.
    """
    times = rows.groupBy("hour").agg(F.count("*").alias("_rows"))
    ranked = times.withColumn("_i", F.row_number().over(Window.orderBy("hour"))).withColumn("_n", F.count("*").over(Window.partitionBy()))
    early = F.col("_i") <= F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    side = lambda which: F.coalesce(F.sum(F.when(which, F.col("_rows"))), F.lit(0))
    cut = ranked.agg(F.max(F.when(early, F.col("hour"))).alias("_cut"), F.max("_n").alias("_n"), side(early).alias("_train"), side(~early).alias("_test"))
    cut = cut.where((F.col("_n") >= least_times) & (F.col("_train") >= least_train) & (F.col("_test") >= least_test)).select("_cut")
    return rows.join(F.broadcast(cut)).withColumn("is_train", F.col("hour") <= F.col("_cut")).drop("_cut")


def evidence_gate(rows: DataFrame, by: list[str], least_rows: int = 30, least_radars: int = 2) -> DataFrame:
    """Rows and radars of each group and whether they are enough."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.countDistinct("radar").alias("radars")).withColumn("enough", (F.col("rows") >= least_rows) & (F.col("radars") >= least_radars))


def family_checks(baseline: DataFrame, challenger: DataFrame, gain: float = 0.10) -> DataFrame:
    """A row for each validation, pulse and intensity target: the challenger's gain in RMSE, its events, and whether it passes.

    It passes with an RMSE better by `gain` and precision and recall no worse. A row that
    either side lacks fails with a reason, as does a baseline RMSE that isn't positive.
    """
    m = ["rmse", "top_decile_precision", "top_decile_recall"]
    side = lambda df, k: df.select("validation", "pulse", "target", *[F.col(c).alias(f"{c}_{k}") for c in m], F.lit(True).alias(f"has_{k}"))
    names = lambda xs: F.explode(F.array(*[F.lit(x) for x in xs]))
    grid = baseline.sparkSession.range(1).select(names(VALIDATIONS).alias("validation")).withColumn("pulse", names(("lp", "sp"))).withColumn("target", names(INTENSITY))
    both = grid.join(side(baseline, "b"), ["validation", "pulse", "target"], "left").join(side(challenger, "c"), ["validation", "pulse", "target"], "left")
    there = F.col("has_b").isNotNull() & F.col("has_c").isNotNull()
    better = F.when(F.col("rmse_b") > 0, (F.col("rmse_b") - F.col("rmse_c")) / F.nullif("rmse_b", F.lit(0.0)))
    shares = (F.col("top_decile_precision_c") >= F.col("top_decile_precision_b")) & (F.col("top_decile_recall_c") >= F.col("top_decile_recall_b"))
    improvement = F.when(there, F.coalesce(better, F.lit(-float("inf"))))
    return both.select(
        "validation", "pulse", "target", improvement.alias("improvement"), F.when(there, shares).alias("events_better"),
        F.coalesce(there & (improvement >= gain) & shares, F.lit(False)).alias("passed"), F.when(~there, F.lit("missing_metrics")).alias("reason"),
    )


def select_model_family(baseline: DataFrame, challenger: DataFrame, gain: float = 0.10, slack: float = 1.02) -> DataFrame:
    """One row: the family to publish, and why.

    The challenger is selected if on held-out radars every intensity target of both pulses
    passes family_checks() and every vector's RMSE is within `slack`, and if the intensity
    targets pass on blocked times too, where either side has blocked times at all.
    """
    checks = family_checks(baseline, challenger, gain).groupBy().pivot("validation", list(VALIDATIONS)).agg(F.bool_and("passed")).select(*VALIDATIONS)
    keys = ["pulse", "target"]
    vectors = lambda df, k: df.where((F.col("validation") == VALIDATIONS[0]) & F.col("target").isin(*VECTORS) & F.col("pulse").isin("lp", "sp")).select(*keys, F.col("rmse").alias(k))
    pairs = vectors(baseline, "b").join(vectors(challenger, "c"), keys).agg(F.count_if(F.col("c") <= F.col("b") * slack).alias("good"))
    blocked = baseline.select("validation").union(challenger.select("validation")).agg(F.coalesce(F.bool_or(F.col("validation") == VALIDATIONS[1]), F.lit(False)).alias("temporal_required"))
    row = checks.join(pairs).join(blocked)  # one row each
    chosen = F.col(VALIDATIONS[0]) & (F.col("good") == 2 * len(VECTORS)) & (~F.col("temporal_required") | F.col(VALIDATIONS[1]))
    return row.select(
        F.col(VALIDATIONS[0]).alias("intensity_ok"), (F.col("good") == 2 * len(VECTORS)).alias("vectors_not_worse"), "temporal_required", F.col(VALIDATIONS[1]).alias("temporal_ok"),
        F.when(chosen, "challenger").otherwise("baseline").alias("selected"),
    )


#: The intensity targets that a candidate may not harm: the short pulse's VID isn't stable enough to be one.
PRIMARY = (("lp", INTENSITY[0]), ("lp", INTENSITY[1]), ("sp", INTENSITY[0]))


def candidate_gate(delta: DataFrame, loss: float = 0.01, gain: float = 0.02) -> DataFrame:
    """One row: worst change of R2 over the primary intensity targets, mean gain over long-pulse vectors, and the decision.

    Keys that either side lacks don't count; without any the candidate isn't accepted.
    """
    primary = F.struct("pulse", "target").isin(*[F.struct(F.lit(p), F.lit(t)) for p, t in PRIMARY])
    vectors = F.col("target").isin(*VECTORS) & (F.col("pulse") == "lp")
    sums = delta.agg(F.min(F.when(primary, F.col("d_r_squared"))).alias("worst_intensity"), F.avg(F.when(vectors, F.col("d_r_squared"))).alias("mean_vector_gain"))
    good = lambda c, least: F.coalesce(F.col(c) >= least, F.lit(False))
    return sums.withColumn("accept", good("worst_intensity", -loss) & good("mean_vector_gain", gain))


def component_selection(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """The run to use for each (pulse, target): the candidate for short-pulse vectors that beat the baseline in all validations."""
    side = lambda df, k: df.select("validation", "pulse", "target", F.col("r_squared").alias(k))
    both = side(baseline, "b").join(side(candidate, "c"), ["validation", "pulse", "target"], "left")
    wins = F.bool_and(F.coalesce(F.col("c") > F.col("b"), F.lit(False)))
    chosen = (F.col("pulse") == "sp") & F.col("target").isin(*VECTORS) & F.col("wins")
    return both.groupBy("pulse", "target").agg(wins.alias("wins")).select("pulse", "target", F.when(chosen, "candidate").otherwise("baseline").alias("run"))
