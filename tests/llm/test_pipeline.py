import re
from collections import Counter

import pytest

import corpus_pipeline as C
from aeroskein.llm.common import staged
from tests.llm.test_near_dups import classes

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for name, stage in C.STAGES:
        docs.append(staged(stage(spark, docs[-1], DATA), name))
    return docs


def test_names_and_columns(steps):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mix", "encode"]
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_each_stage_decides_on_what_its_predecessor_kept(spark, steps):
    docs, clean, lines, single, mixed, tokens = steps
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in clean.collect()}
    # so few labelled rows teach only some of the languages' insults
    assert sum(t for d, t in labels.items() if d in kept) <= 0.5 * sum(labels.values())
    assert all(d in kept for d, t in labels.items() if not t)
    assert {r["doc_id"] for r in lines.collect()} == kept
    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    assert {r["doc_id"] for r in single.collect()} == set(classes(rows).values())
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in single.collect()}
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert set(times) <= set(sizes) and max(times.values()) <= 3
    assert abs(sum(sizes[d] * n for d, n in times.items()) - sum(sizes.values())) <= max(sizes.values())
    assert tokens.count() == mixed.count() == sum(times.values())


def test_run_is_the_stages(spark, steps):
    key = lambda df: sorted((r["doc_id"], r["ids_sha256"]) for r in df.collect())
    assert key(C.run(spark, DATA)) == key(steps[-1])
