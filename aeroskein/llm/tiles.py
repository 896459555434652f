"""Buckets of any size as bounded tiles, compared block against block."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TILE = 512


def tiled(members: DataFrame, bucket: list[str], id_col: str, size_col: str, tile: int = TILE) -> DataFrame:
    """`members`, each in every tile that it takes part in, with columns _i, _j and _chunk.

    A bucket of up to `tile` members is one tile. A larger one is dealt into chunks by a hash
    of the id, and tiles are pairs of chunks, so that each two members meet in just one tile
    and no task holds more than two chunks. Rows come partitioned and sorted by tile.
    """
    chunks = F.ceil(F.col(size_col) / F.lit(float(tile))).cast("int")
    dealt = members.withColumn("_chunk", F.pmod(F.xxhash64(id_col), chunks).cast("int"))
    spread = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    keys = [*bucket, "_i", "_j"]
    out = spread.withColumn("_i", F.least("_chunk", "_other")).withColumn("_j", F.greatest("_chunk", "_other")).drop("_other")
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return out.repartition(parts, *keys).sortWithinPartitions(*keys)


def groups(frames, keys: list[str]):
    """Frames of equal keys from an iterator of frames sorted by them."""
    rest: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if not len(frame):
            continue
        columns = [frame[k].to_numpy() for k in keys]
        new = pd.Series(False, index=range(len(frame))).to_numpy()
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *new.nonzero()[0], len(frame)]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(c[start] for c in columns)
            if last is not None and key != last:
                yield rest[0] if len(rest) == 1 else pd.concat(rest, ignore_index=True)
                rest = []
            last = key
            rest.append(frame.iloc[start:end])
    if rest:
        yield rest[0] if len(rest) == 1 else pd.concat(rest, ignore_index=True)
