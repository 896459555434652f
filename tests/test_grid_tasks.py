"""The derived grid in tasks of bounded size."""

import duckdb
import pytest
from pyspark.sql import functions as F

from aeroskein.operators import frames as R
from aeroskein.operators import weather as W
from aeroskein.plans import derived as D
from aeroskein.plans import model_queries as M

DATA = "/root/testdata/sf0.01"


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(D, "CELLS_A_TASK", 100, raising=False)


def test_one_file_of_customers_becomes_many_tasks(spark, small):
    for table, rows in ((D.weather_grid(spark, DATA), 72), (M.wide_frames(spark, DATA), 48)):
        sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 14 and max(sizes) <= 200 * rows and sum(sizes) == 1500 * rows


def test_cells_are_distinct_before_they_have_hours(spark, tmp_path, small):
    """A customer that comes twice is one cell, as in the SQL."""
    import __spark_entry__ as entry

    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{DATA}/customer.parquet' where c_custkey < 300 union all select * from '{DATA}/customer.parquet' where c_custkey < 50")
    con.execute(f"create view nation as select * from '{DATA}/nation.parquet'")
    for t in ("customer", "nation"):
        con.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    df = entry.queries()["p26_canonical_cell"](spark, str(tmp_path))
    want = con.sql(f"select {', '.join(df.columns)} from ({entry.oracle_sql()['p26_canonical_cell']})").fetchall()
    assert sorted(want) == sorted(map(tuple, df.collect())) and len(want) == 300 * 48


def test_only_rows_of_nearest_cells_are_pivoted(spark, monkeypatch):
    """Two sites may share a cell."""
    seen, real = [], W.pivot_levels
    monkeypatch.setattr(W, "pivot_levels", lambda grid: seen.append(grid) or real(grid))
    grid = D.weather_grid(spark, DATA)
    sites = spark.createDataFrame([("a", 48.05, -6.9), ("b", 47.9, -7.1), ("c", 50.0, -6.0)], "radar string, latitude double, longitude double")
    found = W.site_features(grid, sites)
    assert sorted((r["radar"], r["count"]) for r in found.groupBy("radar").count().collect()) == [("a", 24), ("b", 24), ("c", 24)]
    assert seen[0].count() == 2 * 72


def spread(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_levels_and_targets_meet_in_the_tasks_that_made_them(spark, small):
    """A task's groups are those of its cells, whatever the number of shuffle partitions (4 here)."""
    for met, rows in ((W.pivot_levels(D.weather_grid(spark, DATA)), 24), (R.to_wide(R.to_long(M.wide_frames(spark, DATA))), 48)):
        sizes = spread(met)
        assert len(sizes) >= 14 and max(sizes) <= 200 * rows and sum(sizes) == 1500 * rows


def test_frames_are_nested_in_the_tasks_of_their_tiles(spark, small):
    nested = R.nest_frames(M.wide_frames(spark, DATA, *R.tile()))
    tiles = nested.select("tile_latitude", "tile_longitude", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({t["task"] for t in tiles}) > 4 and len(tiles) == len({t[:2] for t in tiles})
    whole = R.nest_frames(M.wide_frames(spark, DATA)).drop("cells")
    assert nested.agg(F.sum("cell_count")).first()[0] == 1500 * 48 and nested.drop("cells").exceptAll(whole).isEmpty() and whole.exceptAll(nested.drop("cells")).isEmpty()


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_every_nth_cell_in_tasks_of_bounded_size(spark, small, monkeypatch, broadcast):
    """Tasks that number cells are as many as the cells fill, whether the rows' starts are broadcast or not; 0.0 and -0.0 are one row."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        monkeypatch.setattr(R, "ROWS_A_TASK", 2_000, raising=False)
        found = R.every_nth(M.wide_frames(spark, DATA))
        assert len(spread(found)) > 20 and found.count() == 48 * 188
        zeros = spark.createDataFrame([("lp", 1, y, float(x)) for x in range(3) for y in (0.0, -0.0, 1.0)], "pulse string, hour int, latitude double, longitude double")
        assert sorted(r["longitude"] for r in R.every_nth(zeros, 3).collect()) == [0.0, 0.0, 1.0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
