"""Validations and choices of spline models, and SQL that sums and solves the same normal equations."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from aeroskein.functions import geo
from aeroskein.functions.coerce import iso
from aeroskein.operators import additive as A
from aeroskein.operators import validation as V
from aeroskein.plans import model_queries as M
from aeroskein.plans import weather_queries  # noqa: F401  its tables are used in SQL
from aeroskein.plans.registry import query

TARGETS = (*V.INTENSITY, *V.VECTORS)
SURFACE = A.surface("easting_m", "northing_m", 4, 1e-3)
SMOOTHS = tuple(A.smooth(c, 5, 1e-2) for c in ("temperature_850_k", "u_850_ms", "v_850_ms"))
YEAR, DAY = A.cyclic(*A.YEAR, 4, 1e-2), A.cyclic(*A.DAY, 6, 1e-2)


def spec_of(target: str, *terms: A.Term, **more) -> A.SplineSpec:
    response, weights = ("cube_root", "profile_count") if target in V.INTENSITY else ("identity", "mtr")
    return A.SplineSpec(target, terms or (SURFACE, *SMOOTHS), **({"response": response, "weights": weights} | more))


def rows_of(spark, d):
    return A.with_calendar(M.learnable(spark, d))


# the same in SQL

def _laea() -> tuple[str, str]:
    """Easting and northing in SQL."""
    e = math.sqrt(2 * geo.FLATTENING - geo.FLATTENING**2)
    qp, q0 = geo._authalic(e, 1.0), geo._authalic(e, math.sin(math.radians(geo.LAT0)))
    b0, rq, s0 = math.asin(q0 / qp), geo.SEMI_MAJOR * math.sqrt(qp / 2), math.sin(math.radians(geo.LAT0))
    d = geo.SEMI_MAJOR * math.cos(math.radians(geo.LAT0)) / math.sqrt(1 - (e * s0) ** 2) / (rq * math.cos(b0))
    es = f"({e!r} * sin(radians(latitude)))"
    beta = f"asin(least(1.0, greatest(-1.0, {1 - e * e!r} * (sin(radians(latitude)) / (1 - {es} * {es}) - ln((1 - {es}) / (1 + {es})) / {2 * e!r}) / {qp!r})))"
    dlon = f"radians(longitude - {geo.LON0!r})"
    b = f"{rq!r} * sqrt(2 / (1 + {math.sin(b0)!r} * sin({beta}) + {math.cos(b0)!r} * cos({beta}) * cos({dlon})))"
    return f"{geo.FALSE_E!r} + {b} * {d!r} * cos({beta}) * sin({dlon})", f"{geo.FALSE_N!r} + {b} / {d!r} * ({math.cos(b0)!r} * sin({beta}) - {math.sin(b0)!r} * cos({beta}) * cos({dlon}))"


EAST, NORTH = _laea()
#: Columns of training rows in SQL.
SQL = {
    "easting_m": EAST, "northing_m": NORTH, "temperature_850_k": "t_pressure_level_850", "relative_humidity_850_percent": "r_pressure_level_850", "u_850_ms": "u_pressure_level_850",
    "v_850_ms": "v_pressure_level_850", "day_of_year": "date_part('doy', hour)::double", "utc_hour": "date_part('hour', hour)::double", "mtr_birds_km_h": "mean_mtr_birds_km_h",
    "vid_birds_per_km2": "mean_vid_birds_per_km2", "bird_u_ms": "mean_ground_speed_ms * sin(radians(dominant_direction_deg))", "bird_v_ms": "mean_ground_speed_ms * cos(radians(dominant_direction_deg))",
}
RESPONSE = {"identity": "{}", "cube_root": "cbrt(greatest({}, 0))", "sqrt": "sqrt(greatest({}, 0))", "log1p": "ln(1 + greatest({}, 0))"}
UNITS = {"identity": "{}", "cube_root": "power(greatest({}, 0), 3)", "sqrt": "power(greatest({}, 0), 2)", "log1p": "exp(greatest({}, 0)) - 1"}
WEIGHT = {"profile_count": "greatest(usable_mtr_profile_count, 1)::double", "mtr": "greatest(mean_mtr_birds_km_h, 0.01)", "sqrt_mtr": "sqrt(greatest(mean_mtr_birds_km_h, 0.01))"}
RADARS = [f"radar-{i:02d}" for i in range(4)]
FITTED = "usable_mtr_profile_count, mean_mtr_birds_km_h, radar, pulse, hour"


def _bell(distance: str) -> str:
    return f"(case when {distance} < 1 then (4 - 6 * {distance} * {distance} + 3 * {distance} * {distance} * {distance}) / 6 when {distance} < 2 then (2 - {distance}) * (2 - {distance}) * (2 - {distance}) / 6 else 0 end)"


def _margin(m: A.Margin) -> str:
    n = m.intervals()
    if m.period:
        t = f"({m.column} / {m.period!r} - floor({m.column} / {m.period!r})) * {n}"
        away = f"abs({t} - j)"
        ring = f"least({away}, {n} - {away})"
        return f"list_transform(range({m.size}), lambda j: {_bell(ring)})"
    t = f"(case when high_{m.column} > low_{m.column} then least(greatest(({m.column} - low_{m.column}) / (high_{m.column} - low_{m.column}), 0), 1) * {n} else 0 end)"
    return f"list_transform(range({m.size}), lambda j: {_bell(f'abs({t} - (j - 1))')})"


def _term(t: A.Term) -> str:
    parts = [_margin(m) for m in t.margins]
    return parts[0] if len(parts) == 1 else f"flatten(list_transform({parts[0]}, lambda a: list_transform({parts[1]}, lambda b: a * b)))"


def spline_sql(spec: A.SplineSpec, name: str, held: str) -> str:
    """CTEs that end with <name>: (pulse, radar, target, validation, observed, predicted) of held-out radars or blocked times ("all": fitted rows)."""
    layout = A.Layout(spec, {}, tuple(RADARS) if spec.effect else ())
    p, n = layout.width, name
    whole = sum((t.smoothing * s for t, s in zip(spec.terms, A._penalties(layout))), A.RIDGE * 1.0 * _eye(p))
    whole[0, 0] = 0.0
    for i in range(p - len(layout.levels), p):
        whole[i, i] += spec.effect_smoothing
    penalty = ", ".join(f"({i}, {j}, {float(whole[i, j])!r}::double)" for i in range(p) for j in range(p) if whole[i, j])
    offset = SQL[spec.offset] if spec.offset else "0.0::double"
    columns = ", ".join(f"{SQL[c]} as {c}" for c in spec.columns)
    ranges = ", ".join(f"{f}({c}) as {k}_{c}" for c in spec.columns for f, k in (("min", "low"), ("max", "high")))
    effect = ", [" + ", ".join(f"case when radar = '{r}' then 1.0::double else 0.0::double end" for r in RADARS) + "]" if spec.effect else ""
    plain = f"list_transform(x, lambda v, i: case when i > {p - len(layout.levels)} then 0 else v end)"
    train, keys, groups = {
        "radar": ("true", "pulse, held", f"select pulse, radar as held from {n}_b join {n}_ok using (pulse) group by all"),
        "time": ("hour <= cut", "pulse", f"select pulse from {n}_ok"),
        "all": ("true", "pulse", f"select pulse from {n}_ok"),
    }[held]
    enough = {
        "radar": f"select pulse, null::timestamp as cut from {n}_b group by pulse having count(*) >= 30 and count(distinct radar) >= 2",
        "time": f"""select pulse, max(hour) filter (where i <= greatest(1, floor(m * 0.8))) as cut from (select pulse, hour, count(*) as rows, row_number() over (partition by pulse order by hour) as i, count(*) over (partition by pulse) as m from {n}_b group by pulse, hour)
          group by pulse having max(m) >= 10 and sum(rows) filter (where i <= greatest(1, floor(m * 0.8))) >= 30 and sum(rows) filter (where i > greatest(1, floor(m * 0.8))) >= 1""",
        "all": f"select pulse, null::timestamp as cut from {n}_b group by pulse",
    }[held]
    return f"""
{n}_r as (select {FITTED}, {SQL[spec.target]} as observed, {offset} as wind, {columns} from qc_rows where {SQL[spec.target]} is not null),
{n}_g as (select {ranges} from {n}_r),
{n}_b as (select pulse, radar, hour, observed, wind, {RESPONSE[spec.response].format("(observed - wind)") if spec.intensity else "(observed - wind)"} as y, {WEIGHT[spec.weights]} as w,
  flatten([[1.0::double], {", ".join(_term(t) for t in spec.terms)}{effect}]) as x from {n}_r cross join {n}_g),
{n}_ok as ({enough}),
{n}_z as (select b.pulse, radar, w, list_append(x, y) as z from {n}_b b join {n}_ok using (pulse) where {train}),
{n}_p as (select pulse, radar, i, j, sum(w * z[i + 1] * z[j + 1]) as v from {n}_z, (select unnest(range({p})) as i), (select unnest(range({p + 1})) as j) group by all),
{n}_c as (select pulse, radar, count(*) as rows from {n}_z group by all),
{n}_k as ({groups}),
{n}_s as (select {keys}, i, j, sum(v) as v from {n}_k join {n}_p using (pulse){" where radar <> held" if held == "radar" else ""} group by all),
{n}_m as (select {keys}, i, j, v + coalesce(s, 0) * max(case when i = 0 and j = 0 then v end) over (partition by {keys}) as v from {n}_s left join (values {penalty}) q(i, j, s) using (i, j)),
{n}_e as (
  select 0 as step, {keys}, i, j, v from {n}_m
  union all
  select step + 1, {keys}, i, j, case when i = step then v / diag else v - beside * above / diag end from (
    select *, max(case when j = step then v end) over (partition by {keys}, i) as beside, max(case when i = step then v end) over (partition by {keys}, j) as above,
      max(case when i = step and j = step then v end) over (partition by {keys}) as diag from {n}_e where step < {p})),
{n}_f as (select {keys}, list(v order by i) as beta from {n}_e where step = {p} and j = {p} group by all),
{n} as (
  select b.pulse, b.radar, '{spec.target}' as target, '{ {"radar": "leave_one_radar_out", "time": "blocked_time", "all": "none"}[held]}' as validation, b.hour, observed,
    {UNITS[spec.response if spec.intensity else "identity"].format(f"list_dot_product({plain}, beta)")} + wind as predicted
  from {n}_b b join {n}_ok using (pulse) join {n}_f f on f.pulse = b.pulse{" and f.held = b.radar" if held == "radar" else ""}{" where hour > cut" if held == "time" else ""}
  {f"where (select sum(rows) from {n}_c c where c.pulse = b.pulse and c.radar <> b.radar) >= 30" if held == "radar" else ""})"""


def _eye(n: int):
    import numpy as np

    return np.eye(n)


SCORES = "row_count rmse mae bias r_squared top_decile_precision top_decile_recall".split()


def scores_sql(pairs: str, keys: str) -> str:
    """score_regression() of `pairs` in SQL, unrounded."""
    on = " and ".join(f"p.{k.strip()} is not distinct from q.{k.strip()}" for k in keys.split(","))
    picked = ", ".join(f"p.{k.strip()}" for k in keys.split(","))
    return f"""select {picked}, count(*) as row_count, sqrt(avg(power(predicted - observed, 2))) as rmse, avg(abs(predicted - observed)) as mae, avg(predicted - observed) as bias,
  coalesce(1 - sum(power(predicted - observed, 2)) / nullif(sum(power(observed - mean, 2)), 0), 0) as r_squared,
  coalesce(count(*) filter (where observed >= cut and predicted >= cut) / nullif(count(*) filter (where predicted >= cut), 0), 0) as top_decile_precision,
  coalesce(count(*) filter (where observed >= cut and predicted >= cut) / nullif(count(*) filter (where observed >= cut), 0), 0) as top_decile_recall
from ({pairs}) p join (select {keys}, quantile_cont(observed, 0.9) as cut, avg(observed) as mean from ({pairs}) group by all) q on {on} group by all"""


def rounded_sql(scores: str, keys: str) -> str:
    return f"select {keys}, row_count, {', '.join(f'round({c}, 4) + 0.0 as {c}' for c in SCORES[1:])} from ({scores})"


def rounded(scores, keys):
    return scores.select(*keys, "row_count", *[(F.round(c, 4) + 0.0).alias(c) for c in SCORES[1:]])


def _pairs_sql(specs: dict[str, A.SplineSpec], kinds: dict[str, str], prefix: str = "f") -> tuple[str, str]:
    """CTEs and a union of the pairs of all targets and validations."""
    names = {f"{prefix}{i}{k}": (s, h) for i, s in enumerate(specs.values()) for k, h in kinds.items()}
    return ",".join(spline_sql(s, n, h) for n, (s, h) in names.items()), " union all ".join(f"select * from {n}" for n in names)


def _blocked(name: str, **specs: A.SplineSpec):
    """A query of scores on blocked times."""
    ctes, pairs = _pairs_sql(specs, {"t": "time"})

    @query(name, f"with recursive {ctes.lstrip()}, pairs as ({pairs}) {rounded_sql(scores_sql('select * from pairs', 'pulse, target, validation'), 'pulse, target, validation')}")
    def run(spark, d):
        rows, out = rows_of(spark, d), None
        for target, spec in specs.items():
            layout = A.layout_of(A.prepared(rows, spec), spec)
            part = A.blocked_times(rows, layout, ["pulse"]).select("pulse", F.lit(target).alias("target"), F.lit("blocked_time").alias("validation"), "observed", "predicted")
            out = part if out is None else out.unionByName(part)
        return rounded(V.score_regression(out, ["pulse", "target", "validation"]), ["pulse", "target", "validation"])

    return run


ALL = {t: spec_of(t) for t in TARGETS}
_blocked("m4_fit_additive", vid_birds_per_km2=ALL["vid_birds_per_km2"])
_blocked("m5_cyclic_smooths", mtr_birds_km_h=spec_of("mtr_birds_km_h", SURFACE, SMOOTHS[0], YEAR, DAY, A.product(YEAR, DAY, 1e-2)))
_blocked("m6_interactions", bird_u_ms=spec_of("bird_u_ms", SURFACE, *SMOOTHS, A.product(A.smooth("temperature_850_k", 4), A.smooth("relative_humidity_850_percent", 4), 1e-2), A.product(A.smooth("u_850_ms", 4), A.smooth("v_850_ms", 4), 1e-2)))
_blocked("m8_radar_effect", mtr_birds_km_h=spec_of("mtr_birds_km_h", *SMOOTHS, effect="radar"))
_blocked("m10_blocked_time", **ALL)
_blocked("m12_target_overrides", mtr_birds_km_h=spec_of("mtr_birds_km_h", SURFACE, SMOOTHS[0], response="log1p", weights="sqrt_mtr"), vid_birds_per_km2=spec_of("vid_birds_per_km2", response="sqrt"))
_blocked("m17_wind_offset_fit", bird_u_ms=spec_of("bird_u_ms", offset="u_850_ms"), bird_v_ms=spec_of("bird_v_ms", offset="v_850_ms"))


_CTES, _PAIRS = _pairs_sql(ALL, {"h": "radar"})
_FOLDS = "select pulse, target, validation, observed, predicted, unnest(['', radar]) as fold from pairs"


@query("m9_leave_one_radar_out", f"with recursive {_CTES.lstrip()}, pairs as ({_PAIRS}), folds as ({_FOLDS}) select * exclude (fold), nullif(fold, '') as held_out_radar from ({rounded_sql(scores_sql('select * from folds', 'pulse, target, validation, fold'), 'pulse, target, validation, fold')})")
def m9(spark, d):
    """All radars held out, scores of each and of all together."""
    rows, out = rows_of(spark, d), None
    for target, spec in ALL.items():
        layout = A.layout_of(A.prepared(rows, spec), spec)
        part = A.leave_one_out(rows, layout, ["pulse"]).select("pulse", F.lit(target).alias("target"), F.lit("leave_one_radar_out").alias("validation"), F.col("radar").alias("held_out_radar"), "observed", "predicted")
        out = part if out is None else out.unionByName(part)
    keys = ["pulse", "target", "validation"]
    return rounded(A.fold_scores(out, keys, "held_out_radar"), [*keys, "held_out_radar"])


#: A plain family and one with winds and hours, for the choice between them.
PLAIN = {t: spec_of(t, A.smooth("temperature_850_k", 5, 1e-2)) for t in TARGETS}
RICH = {t: spec_of(t, *SMOOTHS, DAY) for t in TARGETS}
_KINDS = {"h": "radar", "t": "time"}
(_PLAIN_CTES, _PLAIN_PAIRS), (_RICH_CTES, _RICH_PAIRS) = _pairs_sql(PLAIN, _KINDS, "b"), _pairs_sql(RICH, _KINDS, "c")
_METRICS = f"""with recursive {_PLAIN_CTES.lstrip()}, {_RICH_CTES.lstrip()}, plain_pairs as ({_PLAIN_PAIRS}), rich_pairs as ({_RICH_PAIRS}),
b as ({scores_sql("select * from plain_pairs", "pulse, target, validation")}), c as ({scores_sql("select * from rich_pairs", "pulse, target, validation")}),
checks as (
  select validation, pulse, target, target like 'bird%' as vector, b.rmse is not null and c.rmse is not null as complete, c.rmse <= b.rmse * 1.02 as vector_ok,
    coalesce((b.rmse - c.rmse) / nullif(b.rmse, 0) >= 0.10 and c.top_decile_precision >= b.top_decile_precision and c.top_decile_recall >= b.top_decile_recall, false) as passed
  from (select * from (values ('leave_one_radar_out'), ('blocked_time')) v(validation), (values ('lp'), ('sp')) p(pulse), (values {", ".join(f"('{t}')" for t in TARGETS)}) t(target)) left join b using (validation, pulse, target) left join c using (validation, pulse, target)),
deltas as (select pulse, target, c.r_squared - b.r_squared as gain from b join c using (pulse, target, validation) where validation = 'leave_one_radar_out'),
decided as (
  select bool_and(passed) filter (where not vector and validation = 'leave_one_radar_out') as intensity_ok, bool_and(complete and coalesce(vector_ok, false)) filter (where vector and validation = 'leave_one_radar_out') as vectors_not_worse,
    (select coalesce(bool_or(validation = 'blocked_time'), false) from (select validation from b union all select validation from c)) as temporal_required, bool_and(passed) filter (where not vector and validation = 'blocked_time') as temporal_ok from checks),
gate as (
  select min(gain) filter (where (pulse = 'lp' and target in ('mtr_birds_km_h', 'vid_birds_per_km2')) or (pulse = 'sp' and target = 'mtr_birds_km_h')) as worst, avg(gain) filter (where pulse = 'lp' and target like 'bird%') as vectors from deltas)
select *, case when intensity_ok and vectors_not_worse and (not temporal_required or temporal_ok) then 'challenger' else 'baseline' end as selected,
  coalesce(worst >= -0.01, false) and coalesce(vectors >= 0.02, false) as accept from (select decided.*, worst, vectors from decided, gate)"""


@query("m13_validated_choice", f"select intensity_ok, vectors_not_worse, temporal_required, temporal_ok, selected, accept, round(worst, 4) + 0.0 as worst_intensity, round(vectors, 4) + 0.0 as mean_vector_gain from ({_METRICS})")
def m13_validated(spark, d):
    """From training rows through both validations of two families to the choice and the gate."""
    rows = rows_of(spark, d)
    baseline, challenger = A.spline_metrics(rows, PLAIN), A.spline_metrics(rows, RICH)
    held = lambda m: m.where(F.col("validation") == "leave_one_radar_out")
    gate = V.candidate_gate(V.metric_delta(held(baseline), held(challenger)))
    choice = V.select_model_family(baseline, challenger)
    rounded_gate = gate.select("accept", *[(F.round(c, 4) + 0.0).alias(c) for c in ("worst_intensity", "mean_vector_gain")])
    return choice.join(F.broadcast(rounded_gate))


@query("m4_chosen_smoothing")
def m4_chosen(spark, d):
    """Fitted rows of a model whose smoothing is chosen by cross-validation; tested against numpy."""
    rows = rows_of(spark, d)
    spec = spec_of("vid_birds_per_km2", *[A.Term(t.margins) for t in (SURFACE, *SMOOTHS)])
    layout = A.layout_of(A.prepared(rows, spec), spec)
    out = A.predict_groups(rows, A.fit_groups(rows, layout, ["pulse"]), layout, ["pulse"])
    return out.select("radar", "pulse", iso(F.col("hour")).alias("hour"), F.round("predicted", 4).alias("predicted"))


def _grid_sql(specs: dict[str, A.SplineSpec], prefix: str, more: str = "") -> str:
    """The predictions of every grid cell and hour by models of all rows of each pulse."""
    ctes, asks = [], []
    for i, (target, spec) in enumerate(specs.items()):
        n = f"{prefix}{i}"
        columns = ", ".join(f"{SQL[c]} as {c}" for c in spec.columns)
        wind = SQL[spec.offset] if spec.offset else "0.0::double"
        units = UNITS[spec.response if spec.intensity else "identity"].format("list_dot_product(x, beta)")
        ctes.append(spline_sql(spec, n, "all") + f""",
{n}_q as (select pulse, hour, latitude, longitude, round({units} + wind, 4) + 0.0 as {target} from (
  select hour, latitude, longitude, wind, flatten([[1.0::double], {", ".join(_term(t) for t in spec.terms)}]) as x from (select hour, latitude, longitude, {wind} as wind, {columns} from grid_wide) cross join {n}_g) cross join {n}_f)""")
        asks.append(f"{n}_q")
    joined = asks[0] + "".join(f" join {a} using (pulse, hour, latitude, longitude)" for a in asks[1:])
    return f"with recursive {','.join(ctes).lstrip()} select pulse, {M.HOUR} as hour, latitude, longitude{more}, {', '.join(specs)} from {joined}"


def _on_grid(spark, d, chosen: dict[str, A.SplineSpec]):
    """The grid of both pulses with a column for each target, by its model of all rows of the pulse."""
    rows, out = rows_of(spark, d), M.model_grid(spark, d).withColumn("pulse", F.explode(F.array(F.lit("lp"), F.lit("sp"))))
    for target, spec in chosen.items():
        layout = A.layout_of(A.prepared(rows, spec), spec)
        out = A.predict_groups(out, A.fit_groups(rows, layout, ["pulse"]), layout, ["pulse"], target)
    return out.withColumns({t: F.round(t, 4) + 0.0 for t in chosen}).withColumn("hour", iso(F.col("hour")))


_NO_UNCERTAINTY = ", 1.0::double as support" + "".join(f", null::double as uncertainty_{t}" for t in TARGETS)


@query("m11_grid_scoring", _grid_sql(ALL, "g", _NO_UNCERTAINTY))
def m11(spark, d):
    """All hours and cells, all targets, both pulses; uncertainties are unknown."""
    out = _on_grid(spark, d, ALL)
    return out.select("pulse", "hour", "latitude", "longitude", "support", *TARGETS, *[F.lit(None).cast("double").alias(f"uncertainty_{t}") for t in TARGETS])


#: Runs of specs, and the run that was chosen for each target.
RUNS = {
    "baseline": {**ALL, "mtr_birds_km_h": spec_of("mtr_birds_km_h", SMOOTHS[0], SMOOTHS[1], response="sqrt")},
    "candidate": {"bird_u_ms": spec_of("bird_u_ms", SURFACE, SMOOTHS[0], offset="u_850_ms")},
}
CHOSEN = {"mtr_birds_km_h": "baseline", "vid_birds_per_km2": "baseline", "bird_u_ms": "candidate", "bird_v_ms": "baseline"}
_COMPONENTS = {t: RUNS[run][t] for t, run in CHOSEN.items()}


@query("m16_predict_components", _grid_sql(_COMPONENTS, "k"))
def m16(spark, d):
    """Each target by the run that was chosen for it."""
    return _on_grid(spark, d, {t: RUNS[run][t] for t, run in CHOSEN.items()}).select("pulse", "hour", "latitude", "longitude", *CHOSEN)
