import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return DATA


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text, lang, source) rows, with an extra column of a clashing name."""

    def make(rows):
        rows = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = spark.createDataFrame([(a, b, c, d, len(b or "")) for a, b, c, d in rows], "doc_id long, text string, lang string, source string, n_chars long")
        return df.selectExpr("*", "doc_id as score", "'x' as keep", "1 as _row")

    return make


def table(spark, name):
    p = f"{DATA}/{name}.parquet"
    assert os.path.exists(p)
    return spark.read.parquet(p)
