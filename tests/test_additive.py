"""Additive models against dense numpy solutions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroskein.operators import additive as A

SPEC = A.SplineSpec("bird_u_ms", (A.surface("easting_m", "northing_m", 5), A.smooth("a", 6), A.cyclic("utc_hour", 24.0, 6), A.product(A.cyclic("day_of_year", 365.25, 4), A.cyclic("utc_hour", 24.0, 4))))


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for pulse in ("lp", "sp"):
        for i in range(400):
            x, y, a = rng.uniform(0, 10, 3).tolist()
            hour = i % 200
            truth = np.sin(x) + 0.1 * x * y + a**2 / 20 + np.cos(2 * np.pi * hour / 24)
            data.append((pulse, f"r{i % 4}", hour, x, y, a, float(truth + rng.normal(0, 0.1)), float(1 + i % 5), float(1 + i % 7)))
    schema = "pulse string, radar string, h int, easting_m double, northing_m double, a double, bird_u_ms double, profile_count double, mtr_birds_km_h double"
    df = spark.createDataFrame(data, schema).withColumn("hour", F.expr("timestampadd(HOUR, h, timestamp '2025-07-14 00:00:00')")).drop("h")
    return A.with_calendar(df).persist()


def dense(frame, layout):
    """Coefficients by stacking the rows over square roots of the penalties, at given smoothing."""
    spec = layout.spec
    x = A.design({c: frame[c].to_numpy() for c in spec.columns}, layout)
    w = np.maximum(frame["profile_count"].to_numpy(), 1)
    total = w.sum()
    extra = [np.sqrt(total * A.RIDGE) * np.eye(layout.width)[1:]]
    for start, term in zip(layout.starts(), spec.terms):
        for s, u in zip(*(lambda v: (v[0], v[1].T))(np.linalg.eigh(term.penalty()))):
            if s > 1e-12:
                row = np.zeros((1, layout.width))
                row[0, start : start + term.size] = np.sqrt(total * term.smoothing * s) * u
                extra.append(row)
    top = x * np.sqrt(w)[:, None]
    right = np.concatenate([frame["bird_u_ms"].to_numpy() * np.sqrt(w), np.zeros(sum(len(e) for e in extra))])
    return np.linalg.lstsq(np.vstack([top, *extra]), right, rcond=None)[0]


def fixed(value=1e-3):
    return A.SplineSpec(SPEC.target, tuple(A.Term(t.margins, value) for t in SPEC.terms))


def test_fit_equals_a_dense_solution(rows):
    layout = A.layout_of(rows, fixed())
    models = {r.pulse: r for r in A.fit_groups(rows, layout, ["pulse"]).collect()}
    for pulse in ("lp", "sp"):
        frame = rows.where(F.col("pulse") == pulse).toPandas()
        beta = dense(frame, layout)
        x = A.design({c: frame[c].to_numpy() for c in layout.spec.columns}, layout)
        assert np.allclose(x @ np.array(models[pulse].coefficients), x @ beta, atol=1e-6)
        assert models[pulse].n == 400 and 10 < models[pulse].freedom < layout.width


def test_predictions_in_columns_equal_the_design(rows):
    layout = A.layout_of(rows, fixed())
    models = A.fit_groups(rows, layout, ["pulse"])
    out = A.predict_groups(rows, models, layout, ["pulse"]).toPandas()
    by = {r.pulse: np.array(r.coefficients) for r in models.collect()}
    x = A.design({c: out[c].to_numpy() for c in layout.spec.columns}, layout)
    want = np.array([row @ by[p] for row, p in zip(x, out["pulse"])])
    assert np.allclose(out["predicted"], want, atol=1e-9)
    beyond = A.predict_groups(rows.withColumn("a", F.lit(1e9)), models, layout, ["pulse"]).agg(F.max("predicted")).first()[0]
    assert abs(beyond) < 100  # beyond its range a smooth stays at its end


def test_held_out_radars_equal_separate_fits_in_one_pass(rows, spark):
    layout = A.layout_of(rows, fixed())
    found = A.leave_one_out(rows, layout, ["pulse"]).toPandas()
    assert len(found) == 800
    for pulse, radar in (("lp", "r1"), ("sp", "r3")):
        others = rows.where((F.col("pulse") == pulse) & (F.col("radar") != radar))
        beta = np.array(A.fit_groups(others, layout, ["pulse"]).first().coefficients)
        mine = found[(found["pulse"] == pulse) & (found["radar"] == radar)]
        x = A.design({c: mine[c].to_numpy() for c in layout.spec.columns}, layout)
        assert np.allclose(mine["predicted"], x @ beta, atol=1e-9)


def test_smoothing_is_chosen_by_cross_validation(rows):
    layout = A.layout_of(rows, SPEC)
    row = A.fit_groups(rows, layout, ["pulse"]).where("pulse = 'lp'").first()
    frame = rows.where("pulse = 'lp'").toPandas()
    x = A.design({c: frame[c].to_numpy() for c in SPEC.columns}, layout)
    z = np.hstack([x, frame["bird_u_ms"].to_numpy()[:, None]])
    matrix = z.T @ (z * np.maximum(frame["profile_count"].to_numpy(), 1)[:, None])
    best = A.solved(matrix, len(frame), layout)
    assert row.smoothing == list(best.smoothing) and np.allclose(row.coefficients, best.coefficients, atol=1e-6)
    for value in A.GRID:
        other = A.SplineSpec(SPEC.target, tuple(A.Term(t.margins, value) for t in SPEC.terms))
        assert A.solved(matrix, len(frame), A.Layout(other, layout.ranges)).score >= best.score * (1 - 1e-9)
    residual = frame["bird_u_ms"].to_numpy() - x @ np.array(row.coefficients)
    assert np.sqrt(np.mean(residual**2)) < 0.2


def test_cyclic_smooths_meet_at_both_ends():
    margin, step = A.Margin("utc_hour", 8, 24.0), 1e-5
    at = lambda x: A.margin_values(np.array([x]), margin, 0, 0)[0]
    assert np.allclose(at(0.0), at(24.0)) and np.allclose(at(step) - at(0.0), at(24.0 + step) - at(24.0), atol=1e-12)
    assert np.allclose((at(step) - at(0.0)) / step, (at(24.0) - at(24.0 - step)) / step, atol=1e-4)
    assert np.allclose(A.margin_values(np.linspace(0, 48, 200), margin, 0, 0).sum(axis=1), 1)
    assert np.allclose(A.margin_values(np.linspace(0, 1, 200), A.Margin("x", 7), 0, 1).sum(axis=1), 1)
    assert np.allclose(A.cyclic("h", 24.0, 6).penalty() @ np.ones(6), 0) and np.allclose(A.surface("x", "y", 5).penalty() @ np.ones(25), 0)


def test_radar_effects_are_left_out_of_predictions(rows):
    shifted = rows.withColumn("bird_u_ms", F.col("bird_u_ms") + F.when(F.col("radar") == "r0", 5.0).otherwise(0.0))
    plain = fixed()
    spec = A.SplineSpec(plain.target, plain.terms, effect="radar", effect_smoothing=1e-5)
    layout = A.layout_of(shifted, spec)
    row = A.fit_groups(shifted, layout, ["pulse"]).where("pulse = 'lp'").first()
    effects = np.array(row.coefficients[-4:])
    assert layout.levels == ("r0", "r1", "r2", "r3") and effects[0] - effects[1:].mean() == pytest.approx(5.0, abs=0.2)
    out = A.predict_groups(shifted.where("pulse = 'lp'").limit(1).select("*", F.explode(F.array(F.lit("r0"), F.lit("new"))).alias("_r")).drop("radar").withColumnRenamed("_r", "radar"), A.fit_groups(shifted, layout, ["pulse"]), layout, ["pulse"])
    assert out.select("predicted").distinct().count() == 1


def test_evidence_and_split_guards(rows):
    few = rows.where("pulse = 'lp'").limit(20).unionByName(rows.where("pulse = 'sp' and radar = 'r1'"))
    reasons = {r.pulse: r.reason for r in A.enough_evidence(few, ["pulse"], "radar", 30, 2).collect()}
    assert reasons == {"lp": "too_few_rows", "sp": "too_few_radars"}
    layout = A.layout_of(rows, fixed())
    assert A.leave_one_out(few, layout, ["pulse"]).count() == 0
    short = rows.where("hour < '2025-07-14 09:00:00'")
    assert {r.reason for r in A.blocked_cut(short, ["pulse"]).collect()} == {"too_few_times"}
    assert {r.reason for r in A.blocked_cut(rows.where("hour < '2025-07-14 12:00:00'"), ["pulse"]).collect()} == {"too_few_training_rows"}
    assert {r.reason for r in A.blocked_cut(rows, ["pulse"], least_test=1000).collect()} == {"too_few_test_rows"}
    assert A.blocked_times(short, layout, ["pulse"]).count() == 0
    cut = A.blocked_cut(rows, ["pulse"]).first()
    assert (cut.times, cut.train, cut.test) == (200, 320, 80) and A.blocked_times(rows, layout, ["pulse"]).count() == 160


def test_pooled_scores_beside_those_of_folds(rows):
    pairs = rows.select("pulse", "radar", F.col("bird_u_ms").alias("observed"), (F.col("bird_u_ms") + F.when(F.col("radar") == "r0", 1.0).otherwise(0.0)).alias("predicted"))
    scores = {(r.pulse, r.radar): r for r in A.fold_scores(pairs, ["pulse"], "radar").collect()}
    assert len(scores) == 10 and scores["lp", "r0"].rmse == pytest.approx(1) and scores["lp", "r1"].rmse == 0 and scores["lp", None].rmse == pytest.approx(0.5) and scores["sp", None].row_count == 400
