"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.llm.common import WORD, staged, text_of

#: Most times a document may be taken.
EPOCHS = 3


def source_key(column: str = "source") -> Column:
    """A source's name as a key that is never null: null sorts after every name."""
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(column).cast("string")))


def target_shares(sizes: DataFrame, share: float = 1.0) -> DataFrame:
    """Targets of the sources in `sizes` (skey, source_size), which is one row per source.

    Sources in code-point order weigh 1, 2, 3, repeating. A target stops at EPOCHS times its
    source's size and the excess goes to the others by weight: with sources ordered by
    cap / weight, the first that stays under its cap fixes the level for all after it.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("rank", F.row_number().over(Window.orderBy("skey")))
        .withColumn("weight", ((F.col("rank") - 1) % 3 + 1).cast("double"))
        .withColumn("cap", F.col("source_size") * float(EPOCHS))
    )
    order = Window.orderBy((F.col("cap") / F.col("weight")), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
        .withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("final", F.min_by(F.when(F.col("open"), F.col("level")), F.when(F.col("open"), F.col("place"))).over(everything))
    )
    return filled.select(
        "skey", "rank", "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("final") * F.col("weight"))).alias("target"),
    )


def mix_sources(docs: DataFrame, seed: str = "mix", share: float = 1.0) -> DataFrame:
    """How much of every row of `docs` (doc_id, source, text) the mix takes.

    Returns doc_id, skey, row (a hash of the text), size, source_size, target and taken. Each source's documents are
    shuffled by a hash of doc_id and seed. The k-th copy of a document ends at virtual time
    (k * source_size + words up to and with it) / target; copies of all sources are ordered
    by that time and taken while their words fit in the budget, which is the sum of targets.

    Nothing is gathered by source: running sums are made in about sqrt(rows) slices of the
    shuffled order, with the slices' own totals summed first, and the cut is found in a
    histogram of virtual times, of which only the slice with the cut is ordered row by row.

    Null text or no words: size and taken 0. Null source: a source of its own, last in order.
    Null doc_id: one shuffle position. Repeated rows count each. Empty input: no rows.
    """
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sized = staged(
        docs.select("doc_id", source_key().alias("skey"), F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"), digest.alias("order"), F.xxhash64(text_of()).alias("row")),
        "sizes",
    )
    rows = sized.count()
    slices = max(1, math.isqrt(rows))
    sized = sized.withColumn("slice", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(float(1 << 32))))

    parts = staged(sized.groupBy("skey", "slice").agg(F.sum("size").alias("words")), "slices")
    shares = target_shares(parts.groupBy("skey").agg(F.sum("words").alias("source_size")), share)
    earlier = Window.partitionBy("skey").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words").join(shares, "skey")
    )
    inside = Window.partitionBy("skey", "slice").orderBy("order", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = staged(
        sized.withColumn("run", F.sum("size").over(inside)).join(offsets, ["skey", "slice"])
        .select("doc_id", "skey", "row", "order", "size", "rank", "source_size", "target", (F.col("run") + F.col("offset")).alias("ends")),
        "queued",
    )

    copies = queued.where((F.col("size") > 0) & (F.col("target") > 0)).select(
        "size", "rank", F.explode(F.array(*[F.struct(finish(k).alias("at"), F.lit(k).alias("copy")) for k in range(EPOCHS)])).alias("c")
    ).select("size", "rank", "c.at", "c.copy")
    budget = shares.agg(F.sum("target").alias("b")).first()["b"] or 0.0
    slot = F.least(F.floor(F.col("at") * F.lit(slices)), F.lit(8 * slices)).cast("long")
    slots = copies.groupBy(slot.alias("slot")).agg(F.sum("size").alias("words"))
    total = slots.withColumn("upto", F.sum("words").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    over = total.where(F.col("upto") > budget).orderBy("slot").select("slot", F.col("upto") - F.col("words")).first()
    if over is None:
        takes = lambda k: F.lit(True)
    else:
        cut, before = over
        order = Window.orderBy("at", "rank", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        fits = copies.where(slot == cut).withColumn("upto", F.sum("size").over(order) + F.lit(before)).where(F.col("upto") <= budget)
        last = fits.agg(F.max(F.struct("at", "rank", "copy")).alias("m")).first()["m"]

        def takes(k: int) -> Column:
            in_slot = F.least(F.floor(finish(k) * F.lit(slices)), F.lit(8 * slices))
            if last is None:
                return in_slot < F.lit(cut)
            return (in_slot < F.lit(cut)) | (
                (in_slot == F.lit(cut))
                & (F.struct(finish(k).alias("at"), F.col("rank"), F.lit(k).alias("copy")) <= F.struct(F.lit(last["at"]).alias("at"), F.lit(last["rank"]).alias("rank"), F.lit(last["copy"]).alias("copy")))
            )

    number = sum((F.when(takes(k), 1).otherwise(0) for k in range(EPOCHS)), F.lit(0))
    some = (F.col("size") > 0) & (F.col("target") > 0)
    return queued.select(
        "doc_id", "skey", "row", "size", "source_size", "target",
        F.when(some, F.col("size") * number).otherwise(0).cast("long").alias("taken"),
    )


def finish(k: int) -> Column:
    """Virtual time at which copy k of a row ends."""
    return (F.col("source_size") * F.lit(k) + F.col("ends")).cast("double") / F.col("target")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The rows of `docs`, each as many times as the mix takes it; columns as in docs.

    Documents without words take no part. Rows that agree in doc_id, source and text are
    taken alike.
    """
    mixed = mix_sources(docs, seed).groupBy("doc_id", "skey", "row").agg(F.first("size").alias("size"), F.min("taken").alias("taken")).where("taken > 0")
    rows = docs.select(
        F.col("doc_id").alias("id"), source_key().alias("source_of"), F.xxhash64(text_of()).alias("text_of"), F.struct(*[docs[c] for c in docs.columns]).alias("whole"),
    )
    joined = rows.join(mixed, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("source_of") == F.col("skey")) & (F.col("text_of") == F.col("row")))
    times = F.sequence(F.lit(1), (F.col("taken") / F.col("size")).cast("int"))
    return joined.withColumn("copy", F.explode(times)).select("whole.*")
