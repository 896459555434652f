"""The corpus pipeline: toxic documents go, frequent lines go, near copies go, sources are mixed, texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroskein.llm.bagminhash import keep_one_of_each
from aeroskein.llm.common import remove, scratch_path, staged, step_folder
from aeroskein.llm.line_dedup import apply_bitmaps, keep_bitmaps
from aeroskein.llm.mixing import mixed_documents
from aeroskein.llm.queries import bpe_model, table
from aeroskein.llm.sentencepiece_bpe import encode_texts
from aeroskein.llm.toxicity import learn_grammar, score_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar doesn't predict to be toxic; the grammar is learned from labelled ones."""
    grammar = learn_grammar(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, grammar).where("predicted = 0").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more documents have."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=10, min_chars=1))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix of sources takes them."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document."""
    return encode_texts(docs, bpe_model(), ids=False)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: The learned grammar and the similarity join have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. A stage's scratch tables, and its input, go when its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with step_folder(spark, f"{name}-scratch"):
            docs = staged(stage(spark, docs, sf_dir), path=path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
