"""Additive models with penalised splines, from normal equations that are summed once.

A model is a sum of smooths of covariates, of surfaces over two of them, and of cyclic smooths and their
products. Splines are uniform cubic B-splines; a penalty on second differences of neighbouring
coefficients keeps them smooth, and how much is chosen by generalised cross-validation. A fit needs
nothing of the rows but the weighted cross products of the spline columns and the response: a
matrix of a few hundred columns. One pass over the rows sums it for each group and each fold;
the model without a fold solves the total less the fold's own matrix, so holding out every radar
costs no further pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aeroskein.functions.domain import inverse, sample_weight, transform
from aeroskein.operators.validation import INTENSITY, score_regression
from aeroskein.sources.scratch import scratch_path

#: Smoothing parameters that cross-validation tries, times the sum of weights.
GRID = tuple(10.0**e for e in range(-6, 3))
#: Times that all parameters are tried in turn.
SWEEPS = 2
#: A little shrinkage, times the sum of weights: splines of several covariates share the constant.
RIDGE = 1e-6
#: Matrices that a task holds before it passes them on.
HELD = 64


@dataclass(frozen=True)
class Margin:
    """`size` cubic B-splines of a column: over its range, or around a period."""

    column: str
    size: int
    period: float | None = None

    def intervals(self) -> int:
        return self.size if self.period else self.size - 3


@dataclass(frozen=True)
class Term:
    """A smooth of one column, or of two by products of their splines. Without `smoothing` it is chosen."""

    margins: tuple[Margin, ...]
    smoothing: float | None = None

    @property
    def size(self) -> int:
        return math.prod(m.size for m in self.margins)

    def penalty(self) -> np.ndarray:
        """Squared second differences along each margin."""
        parts = []
        for at, margin in enumerate(self.margins):
            n, rows = margin.size, range(margin.size if margin.period else margin.size - 2)
            d = np.zeros((len(rows), n))
            for i in rows:
                d[i, i], d[i, (i + 1) % n], d[i, (i + 2) % n] = d[i, i] + 1, d[i, (i + 1) % n] - 2, d[i, (i + 2) % n] + 1
            eyes = [np.eye(m.size) for m in self.margins]
            eyes[at] = d.T @ d
            parts.append(eyes[0] if len(eyes) == 1 else np.kron(*eyes))
        return sum(parts)


def smooth(column: str, size: int = 8, smoothing: float | None = None) -> Term:
    return Term((Margin(column, size),), smoothing)


def cyclic(column: str, period: float, size: int = 8, smoothing: float | None = None) -> Term:
    """A smooth whose value, slope and curvature agree at both ends of the period."""
    return Term((Margin(column, size, period),), smoothing)


def surface(x: str, y: str, size: int = 6, smoothing: float | None = None) -> Term:
    return Term((Margin(x, size), Margin(y, size)), smoothing)


def product(a: Term, b: Term, smoothing: float | None = None) -> Term:
    return Term(a.margins + b.margins, smoothing)


#: Calendar columns and their periods.
YEAR, DAY = ("day_of_year", 365.25), ("utc_hour", 24.0)


def with_calendar(rows: DataFrame, hour: str = "hour") -> DataFrame:
    """`rows` with day_of_year and utc_hour of their hour."""
    return rows.withColumns({YEAR[0]: F.dayofyear(hour).cast("double"), DAY[0]: F.hour(hour).cast("double")})


@dataclass(frozen=True)
class SplineSpec:
    """A target, its terms, and how it is transformed and weighed. With `effect` each of that column's
    values has a shrunk effect of its own, which predictions leave out. An offset is a column to
    learn the difference from."""

    target: str
    terms: tuple[Term, ...]
    response: str = "identity"
    weights: str = "profile_count"
    offset: str | None = None
    effect: str | None = None
    effect_smoothing: float = 1e-2

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(m.column for t in self.terms for m in t.margins))

    @property
    def intensity(self) -> bool:
        return self.target in INTENSITY


@dataclass(frozen=True)
class Layout:
    """Where splines lie: the range of each column, and the values that have effects."""

    spec: SplineSpec
    ranges: dict[str, tuple[float, float]]
    levels: tuple[str, ...] = field(default=())

    @property
    def width(self) -> int:
        return 1 + sum(t.size for t in self.spec.terms) + len(self.levels)

    def starts(self) -> list[int]:
        return (1 + np.cumsum([0, *[t.size for t in self.spec.terms]])).tolist()


def layout_of(rows: DataFrame, spec: SplineSpec) -> Layout:
    """Ranges of all of `rows`, whatever is held out later: one pass, two numbers a column and the effects' values."""
    aggregates = [f(c).alias(f"{f.__name__}_{c}") for c in spec.columns for f in (F.min, F.max)]
    if spec.effect:
        aggregates.append(F.array_sort(F.collect_set(spec.effect)).alias("levels"))
    found = rows.agg(*aggregates).first()
    ranges = {c: (found[f"min_{c}"] or 0.0, found[f"max_{c}"] or 0.0) for c in spec.columns}
    return Layout(spec, ranges, tuple(found["levels"]) if spec.effect else ())


def _bell(distance: np.ndarray) -> np.ndarray:
    return np.where(distance < 1, (4 - 6 * distance**2 + 3 * distance**3) / 6, np.where(distance < 2, (2 - distance) ** 3 / 6, 0.0))


def margin_values(x: np.ndarray, margin: Margin, low: float, high: float) -> np.ndarray:
    """Rows by splines; outside the range values are those at its ends."""
    n, places = margin.intervals(), np.arange(margin.size)
    if margin.period:
        away = np.abs(np.mod(x / margin.period, 1.0)[:, None] * n - places)
        return _bell(np.minimum(away, n - away)) + (_bell(np.maximum(away, n - away)) if n < 4 else 0.0)
    t = np.clip((x - low) / (high - low), 0, 1) * n if high > low else np.zeros_like(x)
    return _bell(np.abs(t[:, None] - (places - 1)))


def design(columns: dict[str, np.ndarray], layout: Layout, levels: np.ndarray | None = None) -> np.ndarray:
    """The constant, the terms' splines, the effects' indicators."""
    n = len(next(iter(columns.values())))
    blocks = [np.ones((n, 1))]
    for term in layout.spec.terms:
        parts = [margin_values(columns[m.column], m, *layout.ranges[m.column]) for m in term.margins]
        blocks.append(parts[0] if len(parts) == 1 else (parts[0][:, :, None] * parts[1][:, None, :]).reshape(n, -1))
    if layout.levels:
        blocks.append((levels[:, None] == np.array(layout.levels, dtype=object)).astype(float))
    return np.hstack(blocks)


def prepared(rows: DataFrame, spec: SplineSpec) -> DataFrame:
    """`rows` whose target and columns are numbers, with response _y and weight _w."""
    y = F.col(spec.target) - F.col(spec.offset) if spec.offset else F.col(spec.target)
    y = transform(y, spec.response) if spec.intensity else y
    needed = [spec.target, *spec.columns, *([spec.offset] if spec.offset else [])]
    fine = F.lit(True)
    for c in needed:
        fine = fine & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c)) != float("inf"))
    weight = sample_weight(F.col("profile_count"), F.col("mtr_birds_km_h"), spec.weights)
    return rows.where(fine).withColumns({"_y": y.cast("double"), "_w": weight.cast("double")})


def cross_products(rows: DataFrame, layout: Layout, by: list[str]) -> DataFrame:
    """(by, i, values, n): row i of the weighted cross products of design and response, and how many rows, by group.

    `rows` are prepared(). A task adds up its rows' matrices and passes on one of each group; they are
    summed row by row, so nothing larger than a row of the matrix meets another.
    """
    spec, width = layout.spec, layout.width + 1
    names = list(dict.fromkeys([*by, *spec.columns, *([spec.effect] if spec.effect else []), "_y", "_w"]))
    schema = T.StructType([*[f for f in rows.select(*by).schema], T.StructField("i", T.IntegerType()), T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("n", T.LongType())])

    def add(batches) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def out():
            for key, (matrix, n) in held.items():
                columns = [pa.array([v] * width) for v in key]
                columns += [pa.array(range(width), pa.int32()), pa.array(list(matrix), pa.list_(pa.float64())), pa.array([n] * width, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
            held.clear()

        for batch in batches:
            frame = batch.to_pandas()
            for key, group in frame.groupby(by, dropna=False, sort=False) if by else [((), frame)]:
                x = design({c: group[c].to_numpy(dtype=float) for c in spec.columns}, layout, group[spec.effect].to_numpy() if spec.effect else None)
                x = np.hstack([x, group["_y"].to_numpy(dtype=float)[:, None]])
                slot = held.setdefault(key, [np.zeros((width, width)), 0])
                slot[0] += x.T @ (x * group["_w"].to_numpy(dtype=float)[:, None])
                slot[1] += len(group)
                if len(held) > HELD:
                    yield from out()
        yield from out()

    sums = rows.select(*names).mapInArrow(add, schema).groupBy(*by, "i")
    return sums.agg(vector_to_array(Summarizer.sum(array_to_vector("values"))).alias("values"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Solution:
    coefficients: np.ndarray
    smoothing: tuple[float, ...]
    freedom: float
    score: float


def _penalties(layout: Layout) -> list[np.ndarray]:
    found = []
    for start, term in zip(layout.starts(), layout.spec.terms):
        whole = np.zeros((layout.width, layout.width))
        whole[start : start + term.size, start : start + term.size] = term.penalty()
        found.append(whole)
    return found


def solved(matrix: np.ndarray, n: int, layout: Layout) -> Solution:
    """Coefficients of the penalised least squares whose cross products are `matrix`.

    Terms without a smoothing parameter get the one of GRID that makes n * residuals / (n - freedom)^2
    least, in turn and SWEEPS times, where freedom is the trace of the smoother.
    """
    gram, right, square = matrix[:-1, :-1], matrix[:-1, -1], matrix[-1, -1]
    weight = gram[0, 0]
    penalties = _penalties(layout)
    base = np.diag([0.0] + [RIDGE] * (layout.width - 1))
    if layout.levels:
        last = layout.width - len(layout.levels)
        base[range(last, layout.width), range(last, layout.width)] += layout.spec.effect_smoothing

    def attempt(chosen: list[float]) -> Solution:
        system = gram + weight * (base + sum(s * p for s, p in zip(chosen, penalties)))
        both = np.linalg.solve(system, np.column_stack([right, gram]))
        beta, freedom = both[:, 0], float(np.trace(both[:, 1:]))
        residual = max(0.0, float(square - 2 * beta @ right + beta @ gram @ beta))
        return Solution(beta, tuple(chosen), freedom, n * residual / max(n - freedom, 1e-9) ** 2)

    chosen = [t.smoothing if t.smoothing is not None else 1e-3 for t in layout.spec.terms]
    best = attempt(chosen)
    for _ in range(SWEEPS):
        for at, term in enumerate(layout.spec.terms):
            if term.smoothing is None:
                tries = [attempt([*chosen[:at], s, *chosen[at + 1 :]]) for s in GRID]
                best = min(tries, key=lambda a: a.score)
                chosen = list(best.smoothing)
    return best


def _margin_columns(margin: Margin, low: float, high: float) -> tuple[Column, list[Column]]:
    """The first of the four splines that aren't 0 here, and their values."""
    n, x = margin.intervals(), F.col(margin.column).cast("double")
    if margin.period:
        t = (x / margin.period - F.floor(x / margin.period)) * n
    else:
        t = F.least(F.greatest((x - low) / (high - low), F.lit(0.0)), F.lit(1.0)) * n if high > low else F.lit(0.0)
    cell = F.floor(t) if margin.period else F.least(F.floor(t), F.lit(n - 1))
    u = t - cell
    values = [F.pow(1 - u, F.lit(3)) / 6, (4 - 6 * u * u + 3 * u * u * u) / 6, (1 + 3 * u + 3 * u * u - 3 * u * u * u) / 6, u * u * u / 6]
    return cell.cast("int"), values


def predictor(layout: Layout, coefficients: Column) -> Column:
    """The linear predictor without effects: four splines a margin, looked up in an array of coefficients."""
    total = F.get(coefficients, F.lit(0))
    for start, term in zip(layout.starts(), layout.spec.terms):
        sides = [_margin_columns(m, *layout.ranges[m.column]) for m in term.margins]

        def place(side: int, k: int, sides=sides, term=term) -> Column:
            cell, margin = sides[side][0], term.margins[side]
            # around a period spline j has its peak at cell j, on a range one cell earlier
            return F.pmod(cell + F.lit(k - 1), F.lit(margin.size)) if margin.period else cell + F.lit(k)

        if len(sides) == 1:
            for k, value in enumerate(sides[0][1]):
                total = total + value * F.get(coefficients, place(0, k) + F.lit(start))
        else:
            width = F.lit(term.margins[1].size)
            for j, a in enumerate(sides[0][1]):
                for k, b in enumerate(sides[1][1]):
                    total = total + a * b * F.get(coefficients, place(0, j) * width + place(1, k) + F.lit(start))
    return total


def in_units(layout: Layout, linear: Column) -> Column:
    """The prediction of the target from the linear predictor."""
    spec = layout.spec
    value = inverse(linear, spec.response) if spec.intensity else linear
    return value + F.col(spec.offset) if spec.offset else value


COEFFICIENTS = "coefficients array<double>, smoothing array<double>, freedom double, n long"


def _solutions(systems: DataFrame, layout: Layout, by: list[str], fold: str | None, least_rows: int) -> DataFrame:
    """(by, fold, COEFFICIENTS) of (by, fold, i, values, n): of each group less each of its folds, or of each group.

    Matrices of a group, at most a few hundred rows each, meet in one task; those of folds are
    subtracted from the total one after the other.
    """
    keys = [*by, *([fold] if fold else [])]
    schema = T.StructType([*systems.select(*keys).schema, *T._parse_datatype_string(COEFFICIENTS)])
    width = layout.width + 1

    def matrices(table: pa.Table) -> dict:
        found: dict = {}
        for row in table.to_pylist():
            slot = found.setdefault(tuple(row[k] for k in keys), [np.zeros((width, width)), row["n"]])
            slot[0][row["i"]] = row["values"]
        return found

    def solve(table: pa.Table) -> pa.Table:
        parts = matrices(table)
        total, count = sum(m for m, _ in parts.values()), sum(n for _, n in parts.values())
        rows = []
        for key, (own, n) in parts.items() if fold else [(next(iter(parts)), (0.0, 0))]:
            if count - n >= least_rows:
                s = solved(total - own, count - n, layout)
                rows.append(dict(zip(keys, key)) | {"coefficients": s.coefficients.tolist(), "smoothing": list(s.smoothing), "freedom": s.freedom, "n": count - n})
        from pyspark.sql.pandas.types import to_arrow_schema

        return pa.Table.from_pylist(rows, schema=to_arrow_schema(schema))

    grouped = systems if by else systems.withColumn("_all", F.lit(0))
    return grouped.groupBy(*(by or ["_all"])).applyInArrow(solve, schema)


def fit_groups(rows: DataFrame, layout: Layout, by: list[str], least_rows: int = 1) -> DataFrame:
    """(by, COEFFICIENTS): a model of each group, all from one pass; groups of fewer rows have none."""
    systems = cross_products(prepared(rows, layout.spec), layout, by)
    return _solutions(systems, layout, by, None, least_rows)


def predict_groups(rows: DataFrame, models: DataFrame, layout: Layout, by: list[str], output: str = "predicted") -> DataFrame:
    """`rows` of groups that have a model, with its prediction; models are a row a group."""
    value = in_units(layout, predictor(layout, F.col("_coefficients")))
    joined = rows.join(F.broadcast(models.select(*by, F.col("coefficients").alias("_coefficients"))), by) if by else rows.join(F.broadcast(models.select(F.col("coefficients").alias("_coefficients"))))
    return joined.withColumn(output, value).drop("_coefficients")


def enough_evidence(rows: DataFrame, by: list[str], fold: str, least_rows: int, least_folds: int) -> DataFrame:
    """(by, rows, folds, reason): whether a group can be validated, and why not."""
    found = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.countDistinct(fold).alias("folds"))
    reason = F.when(F.col("rows") < least_rows, "too_few_rows").when(F.col("folds") < least_folds, f"too_few_{fold}s")
    return found.withColumn("reason", reason)


def leave_one_out(rows: DataFrame, layout: Layout, by: list[str], fold: str = "radar", least_rows: int = 30, least_folds: int = 2) -> DataFrame:
    """`rows` of each fold with observed and predicted by the model of its group's other folds.

    Groups of fewer rows or folds aren't validated, nor are folds whose others have too few rows.
    All models come from one pass over the rows, and predictions from one join.
    """
    spec = layout.spec
    ready = prepared(rows, spec)
    enough = enough_evidence(ready, by, fold, least_rows, least_folds).where("reason is null").select(*by)
    ready = ready.join(F.broadcast(enough), by)
    systems = cross_products(ready, layout, [*by, fold])
    models = _solutions(systems, layout, by, fold, least_rows)
    held = predict_groups(ready.drop("_y", "_w"), models, layout, [*by, fold])
    return held.withColumn("observed", F.col(spec.target))


def blocked_cut(rows: DataFrame, by: list[str], share: float = 0.8, least_times: int = 10, least_train: int = 30, least_test: int = 1) -> DataFrame:
    """(by, cut, reason): the last training time of each group, or why it can't be split.

    The cut is at place floor(share * n) of the n sorted distinct times, which hours keep few.
    """
    counts = rows.groupBy(*by, "hour").agg(F.count("*").alias("_rows"))
    order = Window.partitionBy(*by).orderBy("hour")
    ranked = counts.withColumns({"_i": F.row_number().over(order), "_n": F.count("*").over(Window.partitionBy(*by))})
    last = F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    train, test = F.sum(F.when(F.col("_i") <= last, F.col("_rows")).otherwise(0)), F.sum(F.when(F.col("_i") > last, F.col("_rows")).otherwise(0))
    found = ranked.groupBy(*by).agg(F.max("_n").alias("times"), F.max(F.when(F.col("_i") <= last, F.col("hour"))).alias("cut"), train.alias("train"), test.alias("test"))
    reason = F.when(F.col("times") < least_times, "too_few_times").when(F.col("train") < least_train, "too_few_training_rows").when(F.col("test") < least_test, "too_few_test_rows")
    return found.withColumn("reason", reason)


def blocked_times(rows: DataFrame, layout: Layout, by: list[str], **guards) -> DataFrame:
    """`rows` after each group's cut with observed and predicted by a model of those up to it; groups that can't be split have none."""
    spec = layout.spec
    ready = prepared(rows, spec)
    cuts = blocked_cut(ready, by, **guards).where("reason is null").select(*by, F.col("cut").alias("_cut"))
    split = ready.join(F.broadcast(cuts), by)
    systems = cross_products(split.where(F.col("hour") <= F.col("_cut")), layout, by)
    models = _solutions(systems, layout, by, None, 1)
    held = predict_groups(split.where(F.col("hour") > F.col("_cut")).drop("_y", "_w", "_cut"), models, layout, by)
    return held.withColumn("observed", F.col(spec.target))


def fold_scores(pairs: DataFrame, by: list[str], fold: str) -> DataFrame:
    """score_regression() of each fold, and of all folds together, whose fold is null."""
    both = pairs.withColumn("_fold", F.explode(F.array(F.lit("\u0000all"), F.col(fold)))).drop(fold)
    return score_regression(both, [*by, "_fold"]).withColumn(fold, F.nullif("_fold", F.lit("\u0000all"))).drop("_fold")


def validated(rows: DataFrame, specs: dict[str, SplineSpec], by: str = "pulse", fold: str = "radar") -> DataFrame:
    """(by, target, validation, observed, predicted, held_out): both validations of all targets, written once.

    held_out is the radar that was left out, null for blocked times.
    """
    out = None
    for target, spec in specs.items():
        layout = layout_of(prepared(rows, spec), spec)
        away = leave_one_out(rows, layout, [by], fold).select(by, F.lit("leave_one_radar_out").alias("validation"), F.col(fold).alias("held_out"), "observed", "predicted")
        later = blocked_times(rows, layout, [by]).select(by, F.lit("blocked_time").alias("validation"), F.lit(None).cast("string").alias("held_out"), "observed", "predicted")
        part = away.unionByName(later).withColumn("target", F.lit(target))
        out = part if out is None else out.unionByName(part)
    path = scratch_path(rows.sparkSession, "validated")
    out.write.parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def spline_metrics(rows: DataFrame, specs: dict[str, SplineSpec]) -> DataFrame:
    """A row of scores for each pulse, target and validation."""
    return score_regression(validated(rows, specs), ["pulse", "target", "validation"])
