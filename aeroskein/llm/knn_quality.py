"""Quality by nearest-neighbour voting over latent-semantic vectors of labelled documents."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import WORD, batches, held_out, text_of, training_rows
from aeroskein.llm.divergence import CHAR_CLASSES, N_CHAR_BINS

#: Most labelled rows that are voters; with RANK it bounds what is broadcast: 16 MB of numbers.
MAX_LABELLED = 8_192
RANK = 64
NEIGHBOURS = 15
#: Hashed words, pairs of character classes, and bins for repetition.
WORD_TERMS, CLASS_TERMS, REPEAT_TERMS = 512, N_CHAR_BINS * N_CHAR_BINS, 12
TERMS = WORD_TERMS + CLASS_TERMS + REPEAT_TERMS
WORDS = re.compile(WORD)


@lru_cache(maxsize=1 << 18)
def _term(word: str) -> int:
    return zlib.crc32(word.encode()) % WORD_TERMS


def term_vector(text: str) -> np.ndarray:
    """Damped shares of hashed words, character-class pairs and repetition of a whole text."""
    out = np.zeros(TERMS)
    words = WORDS.findall(text)
    counts = Counter(words)
    n = len(words)
    if n:
        for w, c in counts.items():
            out[_term(w)] += c
        out[:WORD_TERMS] = np.sqrt(out[:WORD_TERMS] / n)
        at = WORD_TERMS + CLASS_TERMS
        again = sum(a == b for a, b in zip(words, words[1:])) / n
        top = max(counts.values()) / n
        out[at] = math.sqrt(again)
        out[at + 1] = math.sqrt(top) if n >= 20 else 0.0
        out[at + 2] = 1 - len(counts) / n
        out[at + 3] = 1.0 if n < 50 else 0.0
        out[at + 4 + min(7, int(math.log2(n)) // 2)] = 0.5
    if len(text) > 1:
        kinds = CHAR_CLASSES[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        pairs = np.bincount(kinds[1:] * N_CHAR_BINS + kinds[:-1], minlength=CLASS_TERMS)
        out[WORD_TERMS : WORD_TERMS + CLASS_TERMS] = np.sqrt(pairs / (len(text) - 1))
    return out


@dataclass(frozen=True)
class Voters:
    """Labelled documents in the latent space: what executors get."""

    mean: np.ndarray
    basis: np.ndarray  # TERMS x RANK
    vectors: np.ndarray  # voters x RANK, of length 1
    labels: np.ndarray
    prior: float

    def project(self, terms: np.ndarray) -> np.ndarray:
        low = (terms - self.mean) @ self.basis
        return (low / np.maximum(1e-9, np.linalg.norm(low, axis=1, keepdims=True))).astype(np.float32)

    def vote(self, terms: np.ndarray) -> np.ndarray:
        """Scores of a block: label 1's share of the nearest voters' similarity."""
        if not len(self.vectors):
            return np.full(len(terms), self.prior)
        sims = self.project(terms) @ self.vectors.T
        k = min(NEIGHBOURS, sims.shape[1])
        near = np.argpartition(sims, sims.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(0.0, np.take_along_axis(sims, near, axis=1).astype(np.float64)) ** 4 + 1e-9
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def fit_voters(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Voters:
    """Voters from at most `limit` labelled rows that aren't held out.

    Executors make the term vectors; the driver gets one row of TERMS numbers for each of the
    bounded number of voters and finds the leading directions of their spread. Without
    labelled rows every score is 0.5.
    """

    def vectors(frames):
        for frame in frames:
            yield pd.DataFrame({"label": frame["label"].to_numpy(), "v": [term_vector(t).astype(np.float32).tobytes() for t in frame["text"]]})

    got = training_rows(docs, labels, "quality", limit).select("text", "label").mapInPandas(vectors, "label int, v binary").toPandas()
    if not len(got):
        return Voters(np.zeros(TERMS), np.zeros((TERMS, RANK)), np.zeros((0, RANK), np.float32), np.zeros(0), 0.5)
    order = np.lexsort((got["v"].to_numpy(), got["label"].to_numpy()))  # whatever the order of arrival
    x = np.stack([np.frombuffer(got["v"].iloc[i], np.float32) for i in order]).astype(np.float64)
    y = got["label"].to_numpy()[order].astype(np.float64)
    mean = x.mean(axis=0)
    _, directions = np.linalg.eigh((x - mean).T @ (x - mean))
    basis = directions[:, ::-1][:, :RANK].copy()
    voters = Voters(mean, basis, np.zeros((0, RANK), np.float32), y, float(y.mean()))
    return Voters(mean, basis, voters.project(x), y, float(y.mean()))


def quality_scores(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs` (doc_id, text).

    Every document is compared with every voter, in blocks. Only the text decides. Null texts
    count as empty; repeated rows repeat; an empty table gives none.
    """
    voters = docs.sparkSession.sparkContext.broadcast(fit_voters(docs, labels, limit))

    def scored(frames):
        for frame in batches(frames, 256):
            out = frame[["doc_id", "held_out"]].copy()
            out["score"] = voters.value.vote(np.stack([term_vector(t) for t in frame["text"]]))
            yield out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), held_out().alias("held_out"))
    return rows.mapInPandas(scored, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
