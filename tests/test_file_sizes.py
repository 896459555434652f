"""What queries write for their readers: neither a file a row nor a file that holds a group."""

import duckdb
import pytest

DATA = "/root/testdata/sf0.01"


@pytest.fixture
def run(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from aeroskein.plans import io_queries as Q

    monkeypatch.setattr(Q, "scratch_path", lambda spark, kind: f"file://{tmp_path}/{kind}")
    con = duckdb.connect()
    for t in ("customer", "nation", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")

    def check(name):
        df = entry.queries()[name](spark, DATA)
        want = con.sql(f"select {', '.join(df.columns)} from ({entry.oracle_sql()[name]})").fetchall()
        assert want and sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())

    return check


def test_a_radars_rows_are_in_many_files(run, tmp_path, monkeypatch):
    from aeroskein.plans import io_queries as Q

    monkeypatch.setattr(Q, "ROWS_A_FILE", 1000, raising=False)
    run("s4_read_external_vpts")
    sizes = [p.read_text().count("\n") for p in (tmp_path / "external").rglob("*.csv")]
    assert len(sizes) > 40 and max(sizes) <= 1001


def test_days_share_files(run, tmp_path):
    run("s9_read_site_features")
    assert len(list((tmp_path / "sites").glob("part-*"))) <= 2


def test_documents_have_many_records(run, tmp_path):
    run("s1_read_records")
    assert len(list((tmp_path / "records" / "json").glob("part-*"))) == 1


def test_objects_of_later_years_are_packed(run, tmp_path, monkeypatch):
    from aeroskein.plans import io_queries as Q

    monkeypatch.setattr(Q, "PACKED_FROM", 2025, raising=False)
    run("s2_read_vpts_archive")
    files = [p for p in (tmp_path / "archive").rglob("part-*")]
    assert len(files) == 4 and len({p.parent for p in files}) == 4  # a file for each radar's year, not for each of its days and pulses
