import duckdb
import pytest

from aeroskein.llm import queries
from aeroskein.llm.mixing import mix_sources, mixed_documents, target_shares

DATA = "/root/testdata/sf0.001"


def test_whole_table_says_what_sql_says(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.sql("select doc_id, size, source_size, target, taken from (" + queries.ORACLES["op2_fair_queue_mix"] + ")").fetchall()}
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in queries.op2_fair_queue_mix(spark, DATA).collect()}
    assert got == want


def filled(sizes):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        rest = total - sum(target.values())
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        target |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"0a": 10, "0b": 10, "0c": 10}, {"0a": 1, "0b": 1, "0c": 1, "0d": 1000}, {"0a": 5, "0b": 0, "1": 7}, {"0a": 3}, {"0a": 1, "0b": 2, "0c": 400, "0d": 3, "0e": 4, "0f": 5}])
def test_targets_are_those_of_resharing(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "skey string, source_size long")
    got = {r["skey"]: r["target"] for r in target_shares(df).collect()}
    want = filled(sizes)
    assert all(got[s] == pytest.approx(want[s]) for s in sizes)


def test_hot_source_nulls_repeats_and_empty_texts(spark, docs_of):
    rows = [(i, "w " * (i % 17 + 1), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(600)] + [(None, "a b", None, None), (7, None, None, None), (8, " \n", None, ""), (9, "x y z", "en", "s1"), (9, "x y z", "en", "s1")]
    got = mix_sources(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by: dict = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        s = by.setdefault(r["skey"], [r["target"], 0, 0])
        s[1] += r["taken"]
        s[2] = max(s[2], r["size"])
    for target, taken, largest in by.values():
        assert abs(target - taken) <= 2 * largest + 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_sources(docs_of(rows[::-1]).repartition(5)).collect()), key=repr)


def test_documents_come_as_often_as_taken(spark, docs_of):
    docs = docs_of([(i, "w " * (i + 1), "en", "a" if i < 2 else "b") for i in range(10)])
    want = {r["doc_id"]: r["taken"] // r["size"] for r in mix_sources(docs).collect()}
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    have: dict = {}
    for r in out.collect():
        have[r["doc_id"]] = have.get(r["doc_id"], 0) + 1
    assert have == {k: v for k, v in want.items() if v}


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "a", None, None)]).limit(0)
    assert mix_sources(docs).count() == 0 and mixed_documents(docs).count() == 0
