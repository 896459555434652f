"""Models on rows whose answer is known."""

import pytest
from pyspark.sql import functions as F

from aeroskein.operators import models as M
from aeroskein.operators import validation as V
from aeroskein.plans import model_queries as Q


@pytest.fixture(scope="module")
def rows(spark):
    """Rates that follow two predictors, and a vector that is the wind plus one."""
    return spark.range(400).selectExpr(
        "concat('radar-', cast(id % 4 as string)) as radar", "timestampadd(HOUR, cast(id div 4 as int), timestamp '2025-07-14 00:00:00') as hour", "cast(id % 10 as double) as a", "cast(id % 7 as double) as b",
        "5.0D as profile_count", "cast(pow(1 + id % 10, 3) as double) as mtr_birds_km_h", "cast(id % 7 + 1 as double) as bird_u_ms",
    )


def spec(target="mtr_birds_km_h", **more):
    return M.ModelSpec(target, predictors=("a", "b"), **({"response": "cube_root"} | more))


def test_additive_model_finds_the_rate(rows):
    model = M.fit(rows, spec(family="additive", reg=0.0))
    err = model.predict(rows).agg(F.max(F.abs(F.col("predicted") - F.col("mtr_birds_km_h")))).first()[0]
    assert err < 1e-6


def test_offset_is_added_back(rows):
    s = spec("bird_u_ms", family="additive", response="identity", weights="mtr", offset="b", reg=0.0)
    out = M.fit(rows, s).predict(rows)
    assert out.agg(F.max(F.abs(F.col("predicted") - F.col("bird_u_ms")))).first()[0] < 1e-6


def test_held_out_radars_and_times(rows):
    s = spec(family="additive", reg=0.0)
    assert M.leave_one_radar_out(rows, s).count() == 400
    assert 0 < M.blocked_time(rows, s).count() <= 80


def test_too_little_evidence_is_no_model(rows):
    s = spec(family="additive", reg=0.0)
    few = rows.where("hour < '2025-07-14 09:00:00'")
    assert M.blocked_time(few, s).count() == 0
    assert M.leave_one_radar_out(few, s).count() == 0  # 27 rows are left without a radar
    both = few.withColumn("pulse", F.lit("sp")).union(rows.where("radar = 'radar-1'").withColumn("pulse", F.lit("lp")))
    assert evidence(both) == {"lp": False, "sp": True} and {r.pulse for r in M.validation_metrics(both, {s.target: s}).collect()} <= {"sp"}


def evidence(rows):
    return {r["pulse"]: r["enough"] for r in V.evidence_gate(rows, ["pulse"]).collect()}


def selection_rows(spark, factor, without=()):
    out = [(v, p, t, 10.0 * factor, 0.5 + (1 - factor) / 10, 0.4, 0.4) for v in V.VALIDATIONS for p in ("lp", "sp") for t in (*V.INTENSITY, *V.VECTORS) if (v, p, t) not in without]
    return spark.createDataFrame(out, "validation string, pulse string, target string, rmse double, r_squared double, top_decile_precision double, top_decile_recall double")


def test_a_better_challenger_is_selected_by_the_models_own_targets(spark):
    base, better = selection_rows(spark, 1.0), selection_rows(spark, 0.5)
    assert V.select_model_family(base, better).first()["selected"] == "challenger"
    assert V.select_model_family(better, base).first()["selected"] == "baseline"
    missing = selection_rows(spark, 0.5, {("blocked_time", "sp", "vid_birds_per_km2")})
    row = V.select_model_family(base, missing).first()
    assert (row["selected"], row["intensity_ok"], row["temporal_ok"]) == ("baseline", True, False)
    held = lambda m: m.where("validation = 'leave_one_radar_out'")
    gate = V.candidate_gate(V.metric_delta(held(base), held(better))).first()
    assert gate["accept"] and gate["mean_vector_gain"] == pytest.approx(0.05)
    runs = {(r["pulse"], r["target"]): r["run"] for r in V.component_selection(base, better).collect()}
    assert runs["sp", "bird_u_ms"] == "candidate" and runs["lp", "bird_u_ms"] == "baseline" and runs["sp", "mtr_birds_km_h"] == "baseline"


@pytest.mark.parametrize("family", ["boosted", "tweedie"])
def test_other_families_predict_no_negative_rates(rows, family):
    model = M.fit(rows, spec(family=family, max_iter=3))
    assert model.predict(rows).where("predicted < 0 or predicted is null").count() == 0


def test_radar_effect_is_left_out_when_predicting(rows):
    model = M.fit(rows, spec(family="additive", radar_effect=True))
    one = model.predict(rows.where("a = 3 and b = 2")).select("predicted").distinct()
    assert one.count() == 1


def test_unknown_family(rows):
    with pytest.raises(ValueError, match="family"):
        M.fit(rows, spec(family="none"))


def test_boosted_fits_are_of_all_targets_and_pulses(spark, monkeypatch):
    assert set(Q.BOOSTED) == {*M.INTENSITY, *M.VECTORS} and all(s.family == "boosted" and s.max_iter >= 50 for s in Q.BOOSTED.values())
    monkeypatch.setattr(Q, "BOOSTED", {t: M.replace(s, max_iter=1) for t, s in Q.BOOSTED.items()})
    assert {r["pulse"] for r in Q.m3(spark, "/root/testdata/sf0.001").collect()} == {"lp"}  # the smallest table has too few rows of the short pulse
    rows = Q.m3(spark, "/root/testdata/sf0.01").collect()
    assert {(r["pulse"], r["target"]) for r in rows} == {(p, t) for p in ("lp", "sp") for t in Q.BOOSTED} and len(rows) == 8
