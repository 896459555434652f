"""Profiles of two layers that cancel but for rounding: the direction of what is left is that of the SQL."""

import duckdb
import pytest

NAMES = ["a1_integrate_profiles", "a4_hourly_rows", "a5_external_hourly", "a7_night_metrics", "t2_hourly_tumbling"]


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    root = tmp_path_factory.mktemp("cancelling")
    con = duckdb.connect()
    con.execute("create view orders as select o as o_orderkey from range(1200) r(o)")
    # speeds of 3 and 4, directions of 207 and 27 degrees
    con.execute("""create view lineitem as select o as l_orderkey, n as l_linenumber, if(n = 6, 12.0, 9.0) as l_quantity, if(n = 6, 0.01, 0.02) as l_discount,
      if(n = 6, 171, 351)::bigint as l_partkey, 0.0::double as l_tax, 'A' as l_returnflag from range(1200) r(o), (select unnest([1, 6]) as n)""")
    con.execute("create view nation as select * from '/root/testdata/sf0.001/nation.parquet'")
    for t in ("orders", "lineitem", "nation"):
        con.execute(f"copy {t} to '{root}/{t}.parquet' (format parquet)")
    return str(root), con


@pytest.mark.parametrize("name", NAMES)
def test_what_cancelling_layers_leave_is_that_of_the_sql(spark, tables, name):
    import __spark_entry__ as entry

    root, con = tables
    df = entry.queries()[name](spark, root)
    want = con.sql(f"select {', '.join(df.columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())
    assert len(want) > 2
