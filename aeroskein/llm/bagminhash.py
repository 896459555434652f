"""Near-duplicate documents by BagMinHash over five-word shingles with multiplicity.

A shingle of weight w is cut into the intervals (0,1], (1,2], (2,4], (4,8], ... up to w.
Each interval has a Poisson process of its own, seeded by shingle and interval, whose points
come in rising order with a component of the signature and a weight level inside the
interval; points above w are skipped. The first point of each component over all shingles
is its signature, so two documents agree in a component with a probability equal to their
weighted Jaccard similarity. A shingle leaves as soon as its next point is above the
highest minimum of its document.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import WORD, batches, dealt, hot_keys, in_parts, staged, text_of
from aeroskein.llm.components import connected_components
from aeroskein.llm.tiles import groups, tiled

WORDS = re.compile(WORD)
SHINGLE = 5
#: Bands of rows: a pair of similarity 0.8 meets in a band with probability 1 - (1 - 0.8^6)^30 = 0.9999.
BANDS, ROWS = 30, 6
COMPONENTS = BANDS * ROWS
SIMILARITY = 0.8
#: Members of a bucket that meet its lead in one streamed chunk.
CHUNK = 256
#: Pairs whose signatures agree in a smaller share aren't verified: 0.8 less 4.6 standard deviations.
LEAST_AGREEMENT = SIMILARITY - 4.6 * (SIMILARITY * (1 - SIMILARITY) / COMPONENTS) ** 0.5

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix of every value (finaliser of the splitmix64 generator)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, weight) of all texts, and each text's key of its word sequence (n x 2).

    A text of one to four words has one shingle, all its words; one without words has none.
    """
    words = [WORDS.findall(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    flat = [x for w in words for x in w]
    keys = np.zeros((len(texts), 2), np.uint64)
    if not flat:
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, keys
    hashed = mixed(pd.util.hash_array(np.array(flat, dtype=object), categorize=False))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = (np.arange(len(flat)) - starts[doc]).astype(np.uint64)
    with np.errstate(over="ignore"):
        some = np.flatnonzero(sizes)
        for k, salt in enumerate((GOLDEN, STEPS[1])):
            keys[some, k] = np.add.reduceat(mixed(hashed + place * GOLDEN + salt), starts[some])
        keys += sizes[:, None].astype(np.uint64) * STEPS[2]
        grams = np.zeros(len(flat), np.uint64)
        for j in range(min(SHINGLE, len(flat))):
            grams[: len(flat) - j] += mixed(hashed[j:] + STEPS[j])
        grams = mixed(grams)
    parts = []
    for at, n in zip(starts, sizes):  # the last four words of a text begin no shingle
        part = grams[at : at + n - SHINGLE + 1] if n >= SHINGLE else mixed(keys[len(parts), :1])[: min(n, 1)]
        part.sort()
        parts.append(part)
    g = np.concatenate(parts)
    d = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])]))
    return d[first], g[first], np.diff(np.concatenate([first, [len(d)]])), keys


def signatures(d: np.ndarray, g: np.ndarray, w: np.ndarray, n_docs: int, m: int = COMPONENTS) -> np.ndarray:
    """n_docs x m identifiers of first points; zeros for documents without shingles."""
    parts = []
    level, low, high = 0, 0, 1
    rest = np.arange(len(d))
    while len(rest):  # intervals up to each weight
        parts.append((rest, np.full(len(rest), level), np.full(len(rest), low), np.full(len(rest), high - low)))
        level, low, high = level + 1, high, high * 2
        rest = rest[w[rest] > low]
    ids = np.zeros(n_docs * m, np.uint64)
    if not parts:
        return ids.reshape(n_docs, m)
    of, lev, low, length = (np.concatenate([p[i] for p in parts]) for i in range(4))
    with np.errstate(over="ignore"):
        seed = mixed(g[of] + lev.astype(np.uint64) * STEPS[3])
    doc, top, rate = d[of], w[of], m * length.astype(np.float64)
    mins = np.full(n_docs * m, np.inf)
    t, done = np.zeros(len(seed)), 0
    active = np.arange(len(seed))
    while len(active):
        block = int(np.clip(60_000 // len(active), 1, 128))
        with np.errstate(over="ignore"):
            r = mixed(seed[active, None] + np.arange(done + 1, done + block + 1, dtype=np.uint64)[None, :] * GOLDEN)
            r2 = mixed(r ^ STEPS[4])
        gaps = -np.log1p(-(r >> np.uint64(11)).astype(np.float64) * 2.0**-53) / rate[active, None]
        gaps[:, 0] += t[active]
        times = np.cumsum(gaps, axis=1)
        t[active] = times[:, -1]
        done += block
        component = ((r2 >> np.uint64(33)) % np.uint64(m)).astype(np.int64)
        level_at = low[active, None] + 1 + ((r2 & np.uint64(0xFFFFFFFF)).astype(np.int64) * length[active, None] >> 32)
        slot = doc[active, None] * m + component
        ok = (level_at <= top[active, None]) & (times < mins[slot])
        s, x, i = slot[ok], times[ok], r2[ok]
        np.minimum.at(mins, s, x)
        won = mins[s] == x
        ids[s[won]] = i[won]
        worst = mins.reshape(n_docs, m).max(axis=1)
        active = active[t[active] < worst[doc[active]]]
    return ids.reshape(n_docs, m)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Similarity of two multisets given as sorted values and weights."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both) / float(a[1].sum() + b[1].sum() - both)


def row_key() -> Column:
    """Tells rows with one doc_id and different texts apart."""
    return F.xxhash64(text_of())


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, row, k1, k2, weight, bands, sig) of each row: keys of its text and word sequence, shingles, signature."""

    def run(frames):
        for frame in batches(frames, 256):
            d, g, w, keys = shingles(list(frame["text"]))
            n = len(frame)
            sig = signatures(d, g, w, n)
            weight = np.bincount(d, weights=w, minlength=n).astype(np.int64)
            small = sig.astype(np.uint16)
            with np.errstate(over="ignore"):
                rows = small.reshape(n, BANDS, ROWS).astype(np.uint64) + np.arange(1, ROWS + 1, dtype=np.uint64) * GOLDEN
                bands = mixed(mixed(rows).sum(axis=2)).astype(np.int64)
            keys = keys.astype(np.int64)
            yield pd.DataFrame({
                "doc_id": frame["doc_id"].to_numpy(), "row": frame["row"].to_numpy(), "k1": keys[:, 0], "k2": keys[:, 1], "weight": weight,
                "bands": list(bands), "sig": [x.tobytes() for x in small],
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), text_of().alias("text")).where("doc_id is not null").mapInPandas(
        run, "doc_id long, row long, k1 long, k2 long, weight long, bands array<long>, sig binary"
    )


def _content(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, grams, counts) of the wanted nodes: sorted shingle hashes and their weights as bytes.

    Always by a sorted merge: how the plan scales doesn't hang on a small side's size.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), text_of().alias("text"))
    rows = nodes.join(wanted.distinct().hint("merge"), "node", "left_semi").select("node", "doc_id", "row")
    found = texts.join(rows.hint("merge"), ["doc_id", "row"]).dropDuplicates(["node"]).select("node", "text")

    def run(frames):
        for frame in batches(frames, 256):
            d, g, w, _ = shingles(list(frame["text"]))
            cuts = np.searchsorted(d, np.arange(len(frame) + 1))
            yield pd.DataFrame({
                "node": frame["node"].to_numpy(), "grams": [g[x:y].tobytes() for x, y in zip(cuts, cuts[1:])],
                "counts": [w[x:y].astype(np.int32).tobytes() for x, y in zip(cuts, cuts[1:])],
            })

    return staged(found.mapInPandas(run, "node long, grams binary, counts binary"), "grams")


def _led(pairs: DataFrame, content: DataFrame, holds) -> DataFrame:
    """The pairs (a, b, n) for whose contents `holds` is true, as a written table of a, b and n.

    Members meet their lead a in chunks of bounded size, and the lead's content travels once a
    chunk, not once a pair. A chunk is streamed: the lead comes first and is all that is held.
    n, the size of the pair's bucket, sets the number of chunks.
    """
    dealt = pairs.withColumn("chunk", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / F.lit(float(CHUNK)))).cast("int"))
    members = dealt.select("a", "chunk", F.col("b").alias("node"), "n")
    leads = dealt.select("a", "chunk").distinct().select("a", "chunk", F.col("a").alias("node"), F.lit(0).cast("long").alias("n"))
    keys = ["a", "chunk"]
    parts = max(1, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = members.union(leads).join(content.hint("merge"), "node").repartition(parts, *keys).sortWithinPartitions("a", "chunk", F.col("node") != F.col("a"))
    columns = [c for c in content.columns if c != "node"]

    def run(frames):
        lead = of = None
        for frame in frames:
            out = []
            for a, chunk, node, n, *values in frame[["a", "chunk", "node", "n", *columns]].itertuples(index=False, name=None):
                if node == a:
                    lead, of = values, (a, chunk)
                elif of == (a, chunk) and holds(lead, values):
                    out.append((a, node, n))
            yield pd.DataFrame(out, columns=["a", "b", "n"])

    return staged(rows.mapInPandas(run, "a long, b long, n long"), "pairs")


def _likely(similarity: float):
    def holds(x, y) -> bool:
        (wx, sx), (wy, sy) = x, y
        if min(wx, wy) < similarity * max(wx, wy):
            return False
        return float((np.frombuffer(sx, np.uint16) == np.frombuffer(sy, np.uint16)).mean()) >= LEAST_AGREEMENT

    return holds


def _similar(similarity: float):
    def bag(x):
        return np.frombuffer(x[0], np.uint64), np.frombuffer(x[1], np.int32).astype(np.int64)

    return lambda x, y: weighted_jaccard(bag(x), bag(y)) >= similarity


def _classed(docs: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, row, copy_of, group, class_id) of each row with an id; see near_duplicates(). group tells components apart."""
    sigs = staged(signed(docs), "signed")
    # a node is a word sequence; ids of nodes are written once, so all that follows reads the same ones
    nodes = staged(
        sigs.where("weight > 0").groupBy("k1", "k2")
        .agg(F.min(F.struct("doc_id", "row")).alias("first"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "first.doc_id", "first.row", "weight", "bands", "sig"), "nodes",
    )
    slots = staged(nodes.select("node", "weight", F.posexplode("bands").alias("band", "hash")), "slots")
    buckets = staged(
        slots.groupBy("band", "hash").agg(F.min("node").alias("lead"), F.count("*").alias("n")).where("n > 1"), "buckets"
    )
    sizes = buckets.withColumn("bucket", F.struct("band", "hash"))
    hot = hot_keys(sizes.select("bucket", "n"), "bucket")
    met = in_parts(sizes.select("bucket", "lead", "n"), hot, "bucket")
    crowded = dealt(slots.withColumn("bucket", F.struct("band", "hash")), hot, "bucket", "node").join(met, ["bucket", "part"])
    stars = crowded.where("node != lead").groupBy(F.col("lead").alias("a"), F.col("node").alias("b")).agg(F.max("n").alias("n"))
    likely = _led(stars, nodes.select("node", "weight", "sig"), _likely(similarity))
    links = _led(likely, _content(docs, nodes, likely.select(F.explode(F.array("a", "b")).alias("node"))), _similar(similarity)).select("a", "b")
    joined = connected_components(links)

    # pairs of one bucket that the stars left apart; of two members the only pair is done
    placed = crowded.where("n > 2").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = staged(placed.select("bucket", "part", "n", "node", "weight", "component"), "placed")
    apart = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("bucket")
    open_rows = placed.join(in_parts(apart, hot, "bucket"), ["bucket", "part"]).select("bucket.band", "bucket.hash", "n", "node", "weight", "component")
    open_rows = staged(open_rows, "open")
    grams = _content(docs, nodes, open_rows.select("node"))
    carried = open_rows.join(nodes.select("node", "sig").join(grams.hint("merge"), "node").hint("merge"), "node")
    across = tiled(carried, ["band", "hash"], "node", "n").mapInPandas(_across(similarity), "a long, b long")
    more = staged(across, "links")
    if more.limit(1).count():
        joined = connected_components(links.union(more))

    known = nodes.select("k1", "k2", "node", F.col("doc_id").alias("copy_of")).join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = known.groupBy("component").agg(F.min("copy_of").alias("class_id"))
    known = known.join(classes, "component").select("k1", "k2", "copy_of", F.col("component").alias("group"), "class_id")
    wordless = F.col("weight") == 0
    own = sigs.where(wordless).select("doc_id", "row", F.col("doc_id").alias("copy_of"), F.lit(None).cast("long").alias("group"), F.col("doc_id").alias("class_id"))
    return sigs.where(~wordless).select("doc_id", "row", "k1", "k2").join(known, ["k1", "k2"]).select("doc_id", "row", "copy_of", "group", "class_id").union(own)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept, copy_of) of each row of `docs` (doc_id, text) with an id.

    class_id is the smallest doc_id reachable over links, which are pairs that share a band
    and whose exact weighted Jaccard similarity of five-word shingles is `similarity` at
    least; kept says that it is the row's own. copy_of is the smallest doc_id with the very
    same words.

    Rows of equal word sequences are one node. In each bucket every node is first held
    against the bucket's first, which joins most of a group with few pairs. Only pairs of one
    bucket that are then in different components can add anything; buckets with such pairs
    are compared in bounded tiles, exactly, and give only the links that join components. So
    the components are those of all links, but pairs within a group are never listed.

    Null or wordless texts link with nothing. Rows without doc_id are left out; repeated rows
    repeat; rows of one doc_id with different texts are nodes of their own, each with the
    class of its text. Empty input gives no rows.
    """
    return _classed(docs, similarity).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), "copy_of")


def _across(similarity: float):
    def run(frames):
        """Links of a tile that join components. A pair is looked at in its first common band only."""
        for tile in groups(frames, ["band", "hash", "_i", "_j"]):
            ids, weight = tile["node"].to_numpy(), tile["weight"].to_numpy().astype(float)
            _, root = np.unique(tile["component"].to_numpy(), return_inverse=True)
            band, chunk = int(tile["band"].iloc[0]), tile["_chunk"].to_numpy()
            mixed_chunks = tile["_i"].iloc[0] != tile["_j"].iloc[0]
            sig = np.stack([np.frombuffer(x, np.uint16) for x in tile["sig"]])
            content = None
            found = []
            for i in range(len(ids) - 1):
                rest = slice(i + 1, None)
                ok = (root[rest] != root[i]) & (np.minimum(weight[rest], weight[i]) >= similarity * np.maximum(weight[rest], weight[i]))
                if mixed_chunks:
                    ok &= chunk[rest] != chunk[i]
                j = np.flatnonzero(ok) + i + 1
                if not len(j):
                    continue
                same = sig[j] == sig[i]
                near = same.mean(axis=1) >= LEAST_AGREEMENT
                j, same = j[near], same[near]
                j = j[same.reshape(len(j), BANDS, ROWS).all(axis=2).argmax(axis=1) == band]
                if not len(j):
                    continue
                if content is None:
                    content = _TileContent(tile["grams"], tile["counts"])
                for k in j[content.similarities(i, j) >= similarity - 1e-12]:
                    if root[k] != root[i]:
                        found.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
                        root[root == root[k]] = root[i]
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    return run


class _TileContent:
    """Shingles of a tile's documents, numbered, for one against many."""

    def __init__(self, grams: pd.Series, counts: pd.Series):
        parts = [np.frombuffer(x, np.uint64) for x in grams]
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        names, self.ids = np.unique(np.concatenate(parts), return_inverse=True)
        self.counts = np.concatenate([np.frombuffer(x, np.int32) for x in counts])
        self.sums = np.add.reduceat(self.counts, self.starts[:-1])
        self.own = np.zeros(len(names), np.int32)

    def similarities(self, i: int, others: np.ndarray) -> np.ndarray:
        """Weighted Jaccard similarities of document i and the others."""
        mine = slice(self.starts[i], self.starts[i + 1])
        self.own[self.ids[mine]] = self.counts[mine]
        sizes = self.starts[others + 1] - self.starts[others]
        at = np.repeat(self.starts[others] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        both = np.add.reduceat(np.minimum(self.own[self.ids[at]], self.counts[at]), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        self.own[self.ids[mine]] = 0
        return both / (self.sums[i] + self.sums[others] - both)


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row of `docs` for each class of near copies, that of its smallest doc_id; columns as in docs.

    Rows without doc_id stay, as do different texts of one id that are no near copies. Of
    rows with equal id and text one stays.
    """
    classed = _classed(docs, similarity)
    here = F.struct("doc_id", "row")
    first = classed.where("group is not null").groupBy("group").agg(F.min(here).alias("first")).select("first.doc_id", "first.row")
    kept = first.union(classed.where("group is null").select("doc_id", "row")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("row"), F.struct(*[docs[c] for c in docs.columns]).alias("whole"))
    named = rows.where("doc_id is not null").dropDuplicates(["doc_id", "row"]).join(kept, ["doc_id", "row"], "left_semi")
    return named.union(rows.where("doc_id is null")).select("whole.*")
