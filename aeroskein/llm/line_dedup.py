"""Line deduplication by range-partitioned hashes, giving compressed keep bitmaps.

Hashes of line keys are range-partitioned together with the document, so that a line of a
third of all documents spreads over many tasks, and sorted by hash, document and position.
Each task streams its runs. A run inside a partition is complete and decided at once; the
first and last run may go on next door, and for those only partial counts, two rows a task,
are added up. What returns per document is a bitmap, not text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import SPACE, batches, staged, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    """Lines of a text; an empty text is one empty line."""
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """A line without outer ASCII white space, A-Z in lower case."""
    return F.btrim(F.translate(line, UPPER, LOWER), F.lit(SPACE))


def row_key() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(text_of())


def _stream_runs(min_docs: int, keep_first: bool):
    def run(frames):
        """Candidates for dropping, from rows sorted by hash, document and position."""
        held: list[np.ndarray] = []  # rows of the open run
        key, first = None, True

        def flush(edge: bool):
            nonlocal held
            rows = np.concatenate(held)
            held = []
            docs = rows["doc"]
            n = 1 + int(np.count_nonzero(docs[1:] != docs[:-1]))
            if not edge and n < min_docs:
                return None
            if not edge and keep_first:
                rows = rows[1:]
            return pd.DataFrame({
                "h1": rows["h1"], "h2": rows["h2"], "doc": rows["doc"], "row": rows["row"], "pos": rows["pos"],
                "n_run": np.where(np.arange(len(rows)) == 0, n, 0), "edge": edge,
            })

        for frame in frames:
            rows = frame.to_records(index=False)
            if not len(rows):
                continue
            cuts = np.flatnonzero((rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])) + 1
            ready = []
            for part in np.split(np.asarray(rows), cuts):
                now = (part["h1"][0], part["h2"][0])
                if key is not None and now != key:
                    got = flush(first)
                    first = False
                    if got is not None:
                        ready.append(got)
                key = now
                held.append(part)
            if ready:
                yield pd.concat(ready)
        if held:
            yield flush(True)

    return run


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """(doc_id, row_key, n_lines, n_dropped, keep) of each distinct document of `docs` (doc_id, text).

    A key of `min_chars` code points or more in at least `min_docs` documents loses its lines
    everywhere, or with `keep_first` all but the first by document and position. `keep` is
    the zlib-compressed bitmap of the lines to keep, or null where none is dropped.

    Null text is one empty line; an empty line's key is shorter than min_chars = 1, so it
    stays. Rows with equal doc_id and text are one document; null doc_ids are one as well.
    Empty input gives no rows.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row_key"), lines_of(text_of()).alias("lines"))
    lines = (
        keyed.select("doc_id", "row_key", F.posexplode(F.transform("lines", line_key)).alias("pos", "key"))
        .where(F.length("key") >= min_chars)
        .select(
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"),
            F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.col("row_key").alias("row"), F.col("pos").cast("int").alias("pos"),
        )
    )
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = lines.repartitionByRange(parts, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "row", "pos")
    found = staged(spread.mapInPandas(_stream_runs(min_docs, keep_first), "h1 long, h2 long, doc long, row long, pos int, n_run long, edge boolean"), "lines")

    # two runs a task at most: a bounded table
    edges = (
        found.where("edge").groupBy("h1", "h2")
        .agg(F.sum("n_run").alias("n_docs"), F.min(F.struct("doc", "row", "pos")).alias("first")).where(F.col("n_docs") >= min_docs)
    )
    here = F.struct("doc", "row", "pos")
    crossing = found.where("edge").join(F.broadcast(edges), ["h1", "h2"])
    if keep_first:
        crossing = crossing.where(here != F.col("first"))
    dropped = (
        found.where("not edge").select("doc", "row", "pos").union(crossing.select("doc", "row", "pos"))
        .groupBy("doc", "row").agg(F.collect_set("pos").alias("dropped"))
    )

    @F.pandas_udf("binary")
    def bitmap(n: pd.Series, gone: pd.Series) -> pd.Series:
        def one(size, positions):
            if positions is None:
                return None
            keep = np.ones(size, bool)
            keep[np.asarray(positions, int)] = False
            return zlib.compress(np.packbits(keep).tobytes())

        return pd.Series([one(a, b) for a, b in zip(n, gone)], dtype=object)

    sizes = keyed.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.col("row_key").alias("row"), F.size("lines").cast("long").alias("n_lines")).distinct()
    return sizes.join(dropped, ["doc", "row"], "left").select(
        F.nullif("doc", F.lit(-(1 << 63))).alias("doc_id"), F.col("row").alias("row_key"), "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), bitmap("n_lines", "dropped").alias("keep"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """`docs` with the text that the bitmaps keep, and columns n_lines and n_dropped.

    Columns of `docs` named n_lines or n_dropped are replaced. A null text becomes empty.
    """

    @F.pandas_udf("string")
    def kept(text: pd.Series, keep: pd.Series) -> pd.Series:
        def one(t, bits):
            if bits is None:
                return ""  # not used
            lines = t.split("\n")
            flags = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8), count=len(lines))
            return "\n".join(x for x, f in zip(lines, flags) if f)

        return pd.Series([one(a, b) for a, b in zip(text, keep)], dtype=object)

    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_key().alias("key"), F.struct(*[docs[c] for c in names]).alias("row"))
    known = bitmaps.select(F.col("doc_id").alias("of"), "row_key", "n_lines", "n_dropped", "keep")
    joined = rows.join(known, F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("row_key")))
    whole = F.coalesce(F.col("row.text"), F.lit(""))
    text = F.when(F.col("keep").isNull(), whole).otherwise(kept(whole, "keep"))
    return joined.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in names], "n_lines", "n_dropped")
