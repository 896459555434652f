import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroskein.llm.bagminhash import keep_one_of_each, near_duplicates, shingles, signatures, weighted_jaccard
from aeroskein.llm.components import connected_components
from aeroskein.llm.embedding_dedup import embedding_links

DATA = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def classes(rows):
    """Smallest id reachable over pairs of weighted Jaccard similarity 0.8, all pairs compared."""
    bags = {}
    for d, t in rows:
        w = WORDS.findall(t or "")
        bags[d] = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    ids = sorted(bags)
    root = {d: d for d in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = bags[a], bags[b]
            n, m = sum(x.values()), sum(y.values())
            if not n or not m or min(n, m) < 0.8 * max(n, m):
                continue
            both = sum((x & y).values())
            if both >= 0.8 * (n + m - both):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


@pytest.mark.parametrize(("a", "b"), [([10, 3, 1], [7, 3, 2]), ([100, 1, 1], [50, 1, 1]), ([1, 1, 1], [1, 1, 0]), ([3, 5, 9], [3, 5, 9])])
def test_signatures_estimate_weighted_similarity(a, b):
    g = np.array([11, 22, 33], np.uint64)
    w = np.array(a + b)
    d, h = np.repeat([0, 1], 3), np.concatenate([g, g])
    some = w > 0
    s = signatures(d[some], h[some], w[some], 2, 8192)
    want = sum(map(min, a, b)) / sum(map(max, a, b))
    assert abs((s[0] == s[1]).mean() - want) < 0.025


def test_shingles_of_one_text_do_not_depend_on_its_batch():
    texts = ["a b c d e f a b c d e", "", "x y", "a b c d e"]
    d, g, w, k = shingles(texts)
    for i, t in enumerate(texts):
        _, g1, w1, k1 = shingles([t])
        assert list(g[d == i]) == list(g1) and list(w[d == i]) == list(w1) and (k[i] == k1[0]).all()
    assert weighted_jaccard((g[d == 0], w[d == 0]), (g[d == 0], w[d == 0])) == 1.0


def edited(words, n, rnd):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**6)}"
    return " ".join(out)


def planted():
    rnd = random.Random(3)
    rows, passage = [], " ".join(f"p{i}" for i in range(60))
    for g in range(12):  # groups of copies with few to many edits
        base = [f"w{rnd.randrange(4000)}" for _ in range(rnd.choice([30, 120, 400]))]
        for k in range(rnd.choice([2, 5, 40])):
            rows.append((len(rows), edited(base, rnd.choice([0, 1, 2, 3, 5]), rnd)))
    for i in range(60):  # a passage that many share
        rows.append((len(rows), passage + " " + " ".join(f"q{rnd.randrange(9000)}" for _ in range(rnd.choice([20, 60, 200])))))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "one  two"), (904, "a b c d e"), (905, "a b c d e"), (906, "x " * 3000), (907, "x " * 2700)]
    return rows


def test_all_links_count(spark, docs_of):
    rows = planted()
    got = {r["doc_id"]: r["class_id"] for r in near_duplicates(docs_of(rows)).collect()}
    assert got == classes(rows)


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs)
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == classes(rows)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(classes(rows).values()))


def test_odd_tables(spark, docs_of):
    docs = docs_of([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")])
    assert sorted((r["doc_id"], r["class_id"]) for r in near_duplicates(docs).collect()) == [(1, 1), (1, 1), (2, 1)]
    assert keep_one_of_each(docs).count() == 2
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(3, 3), (None, 4), (8, 9), (9, 8)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 700)} | {8: 8, 9: 8}


def test_vectors(spark):
    rnd = np.random.default_rng(2)
    rows, n = [], 0
    for size, noise in ((1, 0), (2, 0.02), (60, 0.012), (5, 0.0), (300, 0.02)):
        base = rnd.standard_normal(16)
        base /= np.linalg.norm(base)
        for _ in range(size):
            rows.append((n, [float(np.float32(x)) for x in base * rnd.uniform(0.5, 2) * (noise > 0) + base * (noise == 0) + noise * rnd.standard_normal(16)]))
            n += 1
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = (x @ x.T >= 0.95) & ~np.eye(n, dtype=bool)
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [1.0, None] + [0.0] * 14), (1004, [float("nan")] * 16), (1005, [1.0, 2.0]), (1006, [float("inf")] * 16)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("label", F.lit(1)).withColumn("n", F.lit(5))
    got = {r["vec_id"]: r for r in embedding_links(df, recall=0.9999).collect()}
    assert len(got) == n + len(odd)
    assert all(got[v]["n_links"] == 0 and got[v]["component_id"] == v and got[v]["kept"] for v, _ in odd)
    want = link.sum(axis=1)
    have = np.array([got[i]["n_links"] for i in range(n)])
    assert (have <= want).all() and have.sum() >= 0.995 * want.sum()
    label = np.arange(n)
    for _ in range(n):
        new = np.array([min(label[i], label[link[i]].min(initial=n)) for i in range(n)])
        if (new == label).all():
            break
        label = new
    assert np.mean([got[i]["component_id"] == label[i] for i in range(n)]) > 0.99


def test_no_vectors(spark):
    assert embedding_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_one_id_with_different_texts(spark, docs_of):
    """No text is lost because another one has its id."""
    rnd = random.Random(8)
    a, b = (" ".join(f"{x}{rnd.randrange(500)}" for _ in range(60)) for x in "ab")
    docs = docs_of([(1, a), (1, b), (2, b), (3, a), (1, a), (4, None), (4, ""), (None, a), (None, a)])
    got = sorted((r["doc_id"], r["class_id"], r["copy_of"]) for r in near_duplicates(docs).collect())
    assert got == [(1, 1, 1)] * 3 + [(2, 1, 1), (3, 1, 1), (4, 4, 4), (4, 4, 4)]
    kept = keep_one_of_each(docs)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted([(1, a), (1, b), (4, ""), (0, a), (0, a)])
    assert kept.columns == docs.columns
