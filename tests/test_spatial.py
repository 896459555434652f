"""Spatial joins and ranks against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from aeroskein.operators import validation as V
from aeroskein.operators import weather as W


def km(a, b):
    dlat, dlon = math.radians(b[0] - a[0]), math.radians(b[1] - a[1])
    h = math.sin(dlat / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(dlon / 2) ** 2
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(h)))


@pytest.fixture(scope="module")
def globe(spark):
    rng = random.Random(3)
    cells = [(round(rng.uniform(-90, 90), 3), round(rng.uniform(-180, 180), 3)) for _ in range(600)]
    cells += [(lat, lon) for lat in (-89.9, -60.0, 0.0, 60.5, 89.5, 90.0) for lon in (-180.0, -179.99, -0.5, 0.0, 179.5, 180.0)]
    radars = [(89.0, 10.0, 400.0), (-88.5, 0.0, 255.0), (60.0, 179.8, 255.0), (0.0, -179.9, 300.0), (51.0, 0.1, 255.0), (45.0, 30.0, 9000.0), (60.5, 0.0, 0.0), (10.0, 10.0, -1.0), (None, 5.0, 100.0)]
    return cells, radars, spark.createDataFrame(cells, "latitude double, longitude double"), spark.createDataFrame([(a, b, None if r is None else r * 1000) for a, b, r in radars], "latitude double, longitude double, max_range_m double")


def test_coverage_at_the_date_line_and_the_poles(globe):
    cells, radars, c, r = globe
    near = lambda p: [d / max(rng, 1e-9) for lat, lon, rng in radars if lat is not None and rng >= 0 and (d := km((lat, lon), p)) <= rng]
    got = W.cells_in_coverage(c, r)
    assert {tuple(x) for x in got.collect()} == {p for p in cells if near(p)}
    scores = {(x.latitude, x.longitude): x.support for x in W.support_scores(c, r).collect()}
    assert scores == {p: pytest.approx(max([math.exp(-q * q) for q in near(p)], default=0.0), abs=2e-6) for p in set(cells)}
    assert "LeftSemi" in (plan := got._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan and "NestedLoop" not in plan


def test_points_meet_edges_of_their_band(spark):
    rng = random.Random(4)
    ring = lambda n, r, cx, cy: [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)) for i in range(n)]
    shapes = {"A": [[ring(7, 3, 0, 0), ring(5, 1, 0, 0)], [ring(4, 1, 6, 6)]], "B": [[[(1.0, -2.0), (5.0, -2.0), (5.0, 2.0), (1.0, 2.0), (1.0, -2.0)]]]}
    as_struct = lambda ps: [[[{"x": x, "y": y} for x, y in r] for r in p] for p in ps]
    boundary = spark.createDataFrame([(c, as_struct(p)) for c, p in shapes.items()], "code string, polygons array<array<array<struct<x double, y double>>>>")
    points = [(rng.uniform(-4, 8), rng.uniform(-4, 8)) for _ in range(500)]

    def inside(x, y, ring):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            hits += (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        return hits % 2 == 1

    want = {(x, y, c) for x, y in points for c, ps in shapes.items() if any(inside(x, y, p[0]) and not any(inside(x, y, h) for h in p[1:]) for p in ps)}
    found = W.points_in_boundary(spark.createDataFrame(points, "longitude double, latitude double"), boundary)
    assert {tuple(r) for r in found.collect()} == want and len(want) > 100
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_kernel_goes_along_the_axes(spark):
    rng = random.Random(5)
    cells = [(r, c, rng.random() - 0.2) for r in range(9) for c in range(0, 30, 3)]
    points = [(rng.randrange(40), rng.randrange(40), rng.random()) for _ in range(50)] * 2
    out = W.kernel_grid(spark.createDataFrame(cells, "row int, col int, climatology double"), spark.createDataFrame(points, "row int, col int, value double"), sigma=4.0)
    for x in out.collect():
        w = [math.exp(-((x.row - r) ** 2 + (x.col - c) ** 2) / 32) for r, c, _ in points]
        clim = max(next(k for r, c, k in cells if (r, c) == (x.row, x.col)), 0.01)
        assert x.value == pytest.approx((0.04 * clim + sum(a * p[2] for a, p in zip(w, points))) / (0.04 + sum(w)), rel=1e-9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    none = W.kernel_grid(spark.createDataFrame(cells, "row int, col int, climatology double"), spark.createDataFrame([], "row int, col int, value double"))
    assert none.count() == len(cells) and none.where("value is null").count() == 0


def test_ranks_and_top_shares(spark):
    rng = random.Random(6)
    rows = [(g, i, rng.choice([None, 1.0, 2.0, 2.5, 3.0, -1.0])) for g in ("a", "b", None) for i in range(31)] + [("one", 0, None), ("two", 0, 5.0), ("two", 1, 5.0)]
    df = spark.createDataFrame(rows, "g string, i int, v double")
    got = {(r.g, r.i): r.rank_v for r in V.average_ranks(df, ["g"], "v").collect()}
    for g, i, v in rows:
        same = [x for h, _, x in rows if h == g and x is not None]
        assert got[g, i] == (None if v is None else sum(x < v for x in same) + (sum(x == v for x in same) + 1) / 2)
    top = {(r.g, r.i) for r in V.top_fraction(df, ["g"], "v", ["i"], 0.3).where("top_v").collect()}
    want = set()
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-(r[2] if r[2] is not None else -math.inf), r[1]))
        want |= {(g, r[1]) for r in mine[: max(1, math.ceil(len(mine) * 0.3))]}
    assert top == want and V.top_fraction(df, ["g"], "v", ["i"], 0.3).count() == len(rows)
