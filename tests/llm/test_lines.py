import zlib

import duckdb
import numpy as np

from aeroskein.llm import queries
from aeroskein.llm.line_dedup import apply_bitmaps, keep_bitmaps

DATA = "/root/testdata/sf0.01"


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})


def expected(rows, least, keep_first=False):
    docs = {(d, t or "") for d, t in rows}
    seen: dict = {}
    for d, t in docs:
        for line in (t or "").split("\n"):
            seen.setdefault(key(line), set()).add(d)
    often = {k for k, v in seen.items() if k and len(v) >= least}
    out, first = {}, set()
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        kept = []
        for line in t.split("\n"):
            k = key(line)
            if k in often and not (keep_first and k not in first):
                continue
            if k in often:
                first.add(k)
            kept.append(line)
        out[d, t] = "\n".join(kept)
    return out


def test_documents_say_what_sql_says(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{DATA}/documents.parquet'")
    want = sorted(con.sql("select doc_id, n_lines, n_dropped, kept_sha256 from (" + queries.ORACLES["op6_line_dedup"] + ")").fetchall())
    assert sorted(map(tuple, queries.op6_line_dedup(spark, DATA).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())) == want


def rows():
    out = [(i, f"Common \nown {i}\n\n  COMMON\t\nÄ {i % 3}") for i in range(40)]
    return out + [(100, None), (101, ""), (102, "\n\n"), (None, "common\nx"), (5, "other text of a repeated id\ncommon"), (7, out[7][1]), (103, "z\n" * 500 + "common")]


def test_odd_rows(spark, docs_of):
    docs = docs_of(rows())
    want = expected(rows(), 10)
    bitmaps = keep_bitmaps(docs, 10)
    got = apply_bitmaps(docs, bitmaps)
    assert got.count() == len(rows())
    texts = {(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()}
    kept = sorted((repr(r["doc_id"]), r["text"]) for r in got.collect())
    assert kept == sorted((repr(d), want[d, t or ""]) for d, t in rows()) and len(texts) == bitmaps.count()


def test_first_occurrence_can_stay(spark, docs_of):
    docs = docs_of([(i, f"same\nown {i}") for i in range(12)])
    got = {r["doc_id"]: r["text"] for r in apply_bitmaps(docs, keep_bitmaps(docs, 10, keep_first=True)).collect()}
    assert got[0] == "same\nown 0" and all(got[i] == f"own {i}" for i in range(1, 12))


def test_bitmaps_are_compressed_and_small(spark, docs_of):
    docs = docs_of([(i, "same\n" * 800 + f"own {i}") for i in range(10)])
    r = keep_bitmaps(docs, 10).first()
    bits = np.unpackbits(np.frombuffer(zlib.decompress(r["keep"]), np.uint8), count=r["n_lines"])
    assert (r["n_lines"], r["n_dropped"], bits.sum()) == (801, 800, 1) and len(r["keep"]) < 40


def test_empty_table(spark, docs_of):
    docs = docs_of([(1, "a")]).limit(0)
    assert keep_bitmaps(docs).count() == 0 and apply_bitmaps(docs, keep_bitmaps(docs)).count() == 0
