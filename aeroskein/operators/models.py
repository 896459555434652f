"""Fitting, validating and applying migration models with Spark ML."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.functions.domain import inverse, sample_weight, transform
from aeroskein.operators.training import FEATURES
from aeroskein.operators.validation import INTENSITY, VECTORS, blocked_time_split, evidence_gate, score_regression
from aeroskein.sources.scratch import scratch_path

#: Models that are fitted at a time; each fit is a row of small jobs.
AT_ONCE = 8


@dataclass(frozen=True)
class ModelSpec:
    """What a model of one target is made of.

    family: boosted, additive or tweedie. response: transform of an intensity. weights: how
    rows weigh. offset: wind columns to learn the difference from. cyclic: yearly and daily
    harmonics. interactions: pairs of predictors whose product is added. radar_effect: a
    ridge-like effect of each radar that is left out when predicting.
    """

    target: str
    family: str = "boosted"
    predictors: tuple[str, ...] = ("easting_m", "northing_m", *FEATURES)
    response: str = "cube_root"
    weights: str = "profile_count"
    offset: str | None = None
    cyclic: int = 0
    interactions: tuple[tuple[str, str], ...] = ()
    knots: int = 4
    radar_effect: bool = False
    max_iter: int = 20
    reg: float = 0.01
    variance_power: float = 1.5
    seed: int = 7
    excluded: tuple[str, ...] = field(default=())

    @property
    def intensity(self) -> bool:
        return self.target in INTENSITY


def default_specs(**overrides: dict) -> dict[str, ModelSpec]:
    """A spec for each target, with overrides by target: transform, family, weights, offset, excluded predictors."""
    base = {t: ModelSpec(t, response="cube_root" if t in INTENSITY else "identity", weights="profile_count" if t in INTENSITY else "mtr") for t in (*INTENSITY, *VECTORS)}
    return {t: replace(s, **overrides.get(t, {})) for t, s in base.items()}


def spec_table(spark, specs: dict[str, ModelSpec]) -> DataFrame:
    """The specs as rows, for a run's record."""
    rows = [(s.target, s.family, ",".join(p for p in s.predictors if p not in s.excluded), s.response, s.weights, s.offset or "") for s in specs.values()]
    return spark.createDataFrame(rows, "target string, family string, predictors string, response string, weights string, offset string")


def covariates(rows: DataFrame, spec: ModelSpec) -> tuple[DataFrame, list[str]]:
    """`rows` with the columns that a model reads, and their names: predictors, harmonics, interactions."""
    names = [p for p in spec.predictors if p not in spec.excluded]
    added = {}
    for k in range(1, spec.cyclic + 1):
        year, day = 2 * 3.141592653589793 * k * F.dayofyear("hour") / 365.25, 2 * 3.141592653589793 * k * F.hour("hour") / 24.0
        added |= {f"year_sin_{k}": F.sin(year), f"year_cos_{k}": F.cos(year), f"day_sin_{k}": F.sin(day), f"day_cos_{k}": F.cos(day)}
    for a, b in spec.interactions:
        added[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return rows.withColumns(added) if added else rows, names + list(added)


def _hinges(rows: DataFrame, names: list[str], knots: int) -> dict[str, list[float]]:
    """Quantiles of each covariate as knots of its smooth: one pass, a few numbers back."""
    if knots < 1:
        return {n: [] for n in names}
    share = [i / (knots + 1) for i in range(1, knots + 1)]
    found = rows.agg(*[F.percentile_approx(n, share, 1000).alias(n) for n in names]).first()
    return {n: sorted(set(found[n] or [])) for n in names}


def _smooth_columns(rows: DataFrame, hinges: dict[str, list[float]]) -> tuple[DataFrame, list[str]]:
    """Each covariate with its hinge functions at the knots: a piecewise linear smooth."""
    added = {f"{n}__h{i}": F.greatest(F.col(n) - k, F.lit(0.0)) for n, ks in hinges.items() for i, k in enumerate(ks)}
    return rows.withColumns(added) if added else rows, [*hinges, *added]


@dataclass(frozen=True)
class FittedModel:
    spec: ModelSpec
    pipeline: PipelineModel
    hinges: dict[str, list[float]]

    def predict(self, rows: DataFrame, output: str = "predicted") -> DataFrame:
        """`rows` with the prediction in units of the target. Unknown radars, and all radars of a model
        with radar effects, get none of them: the effect is zero when predicting."""
        df, _ = covariates(rows, self.spec)
        if self.hinges:
            df, _ = _smooth_columns(df, self.hinges)
        if self.spec.radar_effect:
            df = df.withColumn("radar_name", F.lit("\u0000none"))
        out = self.pipeline.transform(df)
        value = F.col("prediction")
        if self.spec.intensity:
            value = F.greatest(value, F.lit(0.0)) if self.spec.family == "tweedie" else inverse(value, self.spec.response)
        if self.spec.offset:
            value = value + F.col(self.spec.offset)
        return out.select(*rows.columns, value.alias(output))


def fit(rows: DataFrame, spec: ModelSpec) -> FittedModel:
    """Fit one model. With an offset it learns the target less the offset, and prediction adds it back."""
    y = F.col(spec.target)
    if spec.offset:
        y = y - F.col(spec.offset)
    if spec.intensity and spec.family != "tweedie":
        y = transform(y, spec.response)
    weight = sample_weight(F.col("profile_count"), F.col("mtr_birds_km_h"), spec.weights)
    df, names = covariates(rows.where(F.col(spec.target).isNotNull()), spec)
    hinges: dict[str, list[float]] = {}
    if spec.family == "additive":
        hinges = _hinges(df, names, spec.knots)
        df, names = _smooth_columns(df, hinges)
    df = df.withColumns({"_y": y, "_w": weight})
    stages: list = []
    if spec.radar_effect:
        df = df.withColumn("radar_name", F.col("radar"))
        stages += [StringIndexer(inputCol="radar_name", outputCol="radar_index", handleInvalid="keep"), OneHotEncoder(inputCol="radar_index", outputCol="radar_vector")]
        names = [*names, "radar_vector"]
    stages.append(VectorAssembler(inputCols=names, outputCol="features"))
    common = {"featuresCol": "features", "labelCol": "_y", "weightCol": "_w"}
    if spec.family == "boosted":
        stages.append(GBTRegressor(maxDepth=5, stepSize=0.035, subsamplingRate=0.8, featureSubsetStrategy="0.9", maxIter=spec.max_iter, seed=spec.seed, **common))
    elif spec.family == "additive":
        stages.append(LinearRegression(regParam=spec.reg, maxIter=100, **common))
    elif spec.family == "tweedie":
        stages.append(GeneralizedLinearRegression(family="tweedie", variancePower=spec.variance_power, linkPower=0.0, regParam=spec.reg, maxIter=50, **common))
    else:
        raise ValueError(f"unknown family {spec.family}")
    return FittedModel(spec, Pipeline(stages=stages).fit(df), hinges)


PAIRS = "radar string, hour timestamp, observed double, predicted double"


def leave_one_radar_out(rows: DataFrame, spec: ModelSpec, least_rows: int = 30) -> DataFrame:
    """Predictions of each radar by a model fitted without it: (radar, hour, observed, predicted).

    The loop is over radars, of which a network has tens; each fit is distributed. A radar
    without which too few rows are left isn't predicted.
    """
    known = rows.where(F.col(spec.target).isNotNull()).groupBy("radar").count().collect()
    total = sum(r["count"] for r in known)
    parts = [rows.sparkSession.createDataFrame([], PAIRS)]
    for radar in sorted(r["radar"] for r in known if total - r["count"] >= least_rows):
        model = fit(rows.where(F.col("radar") != radar), spec)
        held = model.predict(rows.where(F.col("radar") == radar))
        parts.append(held.select("radar", "hour", F.col(spec.target).alias("observed"), "predicted"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.where("observed is not null")


def blocked_time(rows: DataFrame, spec: ModelSpec) -> DataFrame:
    """Predictions of the last fifth of times by a model of those before; none where blocked_time_split() gives no rows."""
    split = blocked_time_split(rows.where(F.col(spec.target).isNotNull()))
    if split.isEmpty():
        return rows.sparkSession.createDataFrame([], PAIRS)
    model = fit(split.where("is_train"), spec)
    held = model.predict(split.where("not is_train"))
    return held.select("radar", "hour", F.col(spec.target).alias("observed"), "predicted").where("observed is not null")


def validation_metrics(rows: DataFrame, specs: dict[str, ModelSpec], validations: tuple[str, ...] = ("leave_one_radar_out", "blocked_time")) -> DataFrame:
    """A metrics row for each (pulse, target, validation) with enough rows and radars."""
    counts = [evidence_gate(rows.where(F.col(t).isNotNull()), ["pulse"]).select("pulse", F.lit(t).alias("target"), "enough") for t in specs]
    enough = {(r["pulse"], r["target"]) for r in reduce(DataFrame.union, counts).where("enough").collect()}
    run = {"leave_one_radar_out": leave_one_radar_out, "blocked_time": blocked_time}

    def pairs(job: tuple[str, str, str]) -> DataFrame:
        pulse, target, v = job
        found = run[v](rows.where(F.col("pulse") == pulse), specs[target])
        return found.select(F.lit(pulse).alias("pulse"), F.lit(target).alias("target"), F.lit(v).alias("validation"), "observed", "predicted")

    with ThreadPoolExecutor(AT_ONCE) as pool:
        parts = list(pool.map(pairs, [(p, t, v) for p, t in sorted(enough) for v in validations]))
    empty = rows.sparkSession.createDataFrame([], "pulse string, target string, validation string, observed double, predicted double")
    path = scratch_path(rows.sparkSession, "pairs")
    reduce(DataFrame.union, parts, empty).write.parquet(path)
    return score_regression(rows.sparkSession.read.parquet(path), ["pulse", "target", "validation"])


def fit_all(rows: DataFrame, specs: dict[str, ModelSpec]) -> dict[str, FittedModel]:
    """A model for each target."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return dict(zip(specs, pool.map(lambda s: fit(rows, s), specs.values())))


def score_grid(grid: DataFrame, models: dict[str, FittedModel]) -> DataFrame:
    """`grid` with a column for each target and its (unknown) uncertainty, support carried along."""
    out = grid
    for target, model in models.items():
        out = model.predict(out, target).withColumn(f"uncertainty_{target}", F.lit(None).cast("double"))
    return out


def predict_components(grid: DataFrame, runs: dict[str, dict[str, FittedModel]], chosen: dict[str, str]) -> DataFrame:
    """Each target predicted by the run that was chosen for it."""
    return score_grid(grid, {target: runs[run][target] for target, run in chosen.items()})
