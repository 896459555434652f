"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosines, components."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import dealt, hot_keys, in_parts, staged
from aeroskein.llm.components import connected_components
from aeroskein.llm.tiles import groups, tiled

COSINE = 0.95
#: Share of pairs right at the least cosine that some table must catch.
RECALL = 0.999
TILE = 1024


def table_plan(rows: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits a table and number of tables: buckets stay small as rows grow, recall stays."""
    bits = min(40, max(8, math.ceil(math.log2(max(rows, 2))) + 4))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


@lru_cache(maxsize=4)
def hyperplanes(dim: int, bits: int, tables: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, bits * tables))


def codes(unit: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """Sign codes of unit vectors, one column a table."""
    signs = (unit @ planes >= 0).reshape(len(unit), -1, bits)
    return (signs.astype(np.int64) << np.arange(bits, dtype=np.int64)).sum(axis=2)


def _vectors(column) -> list[np.ndarray | None]:
    """Each array as doubles, or None if it is null, empty, zero or holds null or non-finite parts."""
    out = []
    for x in column:
        v = None
        if x is not None and len(x):
            v = np.array([np.nan if y is None else y for y in x] if getattr(x, "dtype", None) == object else x, dtype=np.float64)
            if not np.isfinite(v).all() or not v.any():
                v = None
        out.append(v)
    return out


def _units(raw: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(b, np.float64) for b in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def embedding_links(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of `vectors` (vec_id, embedding).

    Two vectors of one dimension link if a table puts them in one bucket and their cosine in
    double precision is `cosine` at least. n_links counts them, component_id is the smallest
    vec_id reachable, kept says that it is the row's own.

    Equal vectors form a class that is compared once. Only vectors that share a bucket travel;
    buckets of any size are compared in tiles of bounded size, each pair counted in the first
    table that has it. A tile returns counts and one link a vector to its smallest fellow,
    never the pairs.

    Vectors that are null, empty, zero or hold null or non-finite parts link with nothing.
    Rows with a null vec_id are left out; repeated rows count as vectors of their own with one
    id. Empty input gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id is not null")

    def packed(frames):
        for frame in frames:
            got = _vectors(frame["embedding"])
            yield pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(), "dim": [0 if v is None else len(v) for v in got],
                                "raw": [None if v is None else v.tobytes() for v in got]})

    everything = staged(
        rows.mapInPandas(packed, "vec_id long, dim int, raw binary")
        .withColumn("k1", F.xxhash64("raw")).withColumn("k2", F.xxhash64(F.lit("v"), "raw")), "vectors",
    )
    usable = everything.where("dim > 0")
    # copies combine before the shuffle: of a vector that a third of all rows have a task passes on one
    grouped = usable.groupBy("dim", "k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("raw").alias("raw"))
    grouped = staged(grouped, "reps")
    reps, classes = grouped.select(F.col("rep").alias("vec_id"), "copies", "dim", "raw"), grouped.drop("raw")
    bits, tables = table_plan(reps.count(), cosine, recall)

    def hashed(frames):
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                yield part.assign(codes=list(codes(_units(list(part["raw"])), hyperplanes(int(dim), bits, tables), bits)))

    coded = staged(reps.mapInPandas(hashed, "vec_id long, copies long, dim int, raw binary, codes array<long>"), "coded")
    slots = coded.select("vec_id", F.posexplode("codes").alias("t", "code"), "dim").select("vec_id", "dim", "t", F.struct("dim", "t", "code").alias("bucket"))
    buckets = staged(slots.groupBy("bucket").agg(F.count("*").alias("n")), "buckets")
    hot = hot_keys(buckets, "bucket")
    crowded = dealt(slots, hot, "bucket", "vec_id").join(in_parts(buckets.where("n > 1"), hot, "bucket"), ["bucket", "part"]).drop("part")
    members = crowded.join(coded, ["vec_id", "dim"])

    def compared(frames):
        for tile in groups(frames, ["b1", "b2", "_i", "_j"]):
            t = int(tile["t"].iloc[0])
            ids, copies, chunk = tile["vec_id"].to_numpy(), tile["copies"].to_numpy(), tile["_chunk"].to_numpy()
            across = tile["_i"].iloc[0] != tile["_j"].iloc[0]
            unit = _units(list(tile["raw"]))
            near, own = np.zeros(len(ids), np.int64), None
            root = np.arange(len(ids))
            for start in range(0, len(ids), 256):
                sims = unit[start : start + 256] @ unit.T
                a, b = np.nonzero(sims >= cosine)
                a += start
                ok = a != b
                if across:
                    ok &= chunk[a] != chunk[b]
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                if t:
                    if own is None:
                        own = np.stack(list(tile["codes"]))[:, :t]
                    new = np.ones(len(a), bool)
                    for lo in range(0, len(a), 65_536):
                        new[lo : lo + 65_536] = ~(own[a[lo : lo + 65_536]] == own[b[lo : lo + 65_536]]).any(axis=1)
                    a, b = a[new], b[new]
                near += np.bincount(a, weights=copies[b], minlength=len(ids)).astype(np.int64)
                for x, y in zip(a, b) if len(a) < 64 else _spanning(a, b):
                    x, y = _find(root, x), _find(root, y)
                    if x != y:
                        root[max(x, y)] = min(x, y)
            linked = np.flatnonzero(near)
            if len(linked):
                top = np.array([_find(root, x) for x in linked])
                yield pd.DataFrame({"vec_id": ids[linked], "n": near[linked], "other": ids[top]})

    # a bucket as two numbers, to tell tiles apart
    members = members.withColumns({"b1": F.col("bucket.t") + F.col("bucket.dim") * F.lit(1 << 32), "b2": F.col("bucket.code")}).drop("bucket")
    found = staged(tiled(members, ["b1", "b2"], "vec_id", "n", TILE).mapInPandas(compared, "vec_id long, n long, other long"), "tiles")
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("n").alias("n"))
    parts = connected_components(found.select(F.col("vec_id").alias("a"), F.col("other").alias("b")).distinct())
    known = classes.join(counts, "rep", "left").join(parts.select(F.col("node").alias("rep"), "component"), "rep", "left")
    same = F.struct("dim", "k1", "k2").alias("same")
    hot_vectors = hot_keys(classes.select(same, F.col("copies").alias("n")), "same")
    left = dealt(usable.select("vec_id", same), hot_vectors, "same", "vec_id")
    linked = left.join(in_parts(known.select(same, "rep", "copies", "n", "component"), hot_vectors, "same"), ["same", "part"]).select("vec_id", "rep", "copies", "n", "component")
    none = F.lit(None).cast("long")
    out = linked.union(everything.where("dim = 0").select("vec_id", none, none, none, none))
    component = F.coalesce("component", "rep", "vec_id")
    return out.select(
        "vec_id", (F.coalesce("n", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )


def _find(root: np.ndarray, x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return int(x)


def _spanning(a: np.ndarray, b: np.ndarray):
    """Pairs that join what a and b join: a pass of smallest labels drops what adds nothing."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        np.minimum.at(label, x, label[y])
        np.minimum.at(label, y, label[x])
        label = label[label]
        if (label == before).all():
            break
    return zip(names, names[label])
