"""Quality rules and Jensen-Shannon distance from the histograms of language references."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import WORD, batches, dealt, hot_keys, in_parts, staged, text_of

WORDS = re.compile(WORD)
SYMBOLS = re.compile(r"[#*$%&|<>]")

#: Frequent words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to in is it that for was on are as with by this be at from a or an not have",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an",
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il elle",
    "es": "de la que el en y los se del las un por con no una su para es al lo como más pero sus mi",
}
WORD_BINS = {w: i for i, w in enumerate(dict.fromkeys(" ".join(COMMON_WORDS.values()).split()))}
#: Other words fall in a bin by length: to 3, 6, 10, 15 letters, longer.
LENGTH_BINS = (3, 6, 10, 15)
N_WORD_BINS = len(WORD_BINS) + len(LENGTH_BINS) + 1
#: lower, upper, digit, space, line end, sentence mark, quote or bracket, symbol, other mark, other letter
N_CHAR_BINS = 10
#: Documents shorter than this many words are left to the base rules.
MIN_WORDS = 50
#: Distance (the root of the divergence in bits) from which a document of unbounded length is rejected, for characters and words.
#: Set by hand between the distances of labelled good and junk documents of the given tables.
CHAR_LIMIT, WORD_LIMIT = 0.1483, 0.4
#: Short documents differ from a reference by chance; this over the word count is added to the square of a limit, twice for words.
CHANCE = 4.0
OTHER = ""


def _char_classes() -> np.ndarray:
    table = np.full(0x110000, 9, np.uint8)
    for code in range(0x250):
        c = chr(code)
        table[code] = 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 9 if c.isalpha() else 8
    for marks, kind in ((" \t\x0b\x0c", 3), ("\n\r", 4), (".,;:!?", 5), ("'\"()[]{}«»“”", 6), ("#*$%&|<>@=+~^_\\/", 7)):
        for c in marks:
            table[ord(c)] = kind
    return table


CHAR_CLASSES = _char_classes()


def histograms(text: str, words: list[str]) -> np.ndarray:
    """Counts of character classes, then of common words and lengths of others."""
    out = np.zeros(N_CHAR_BINS + N_WORD_BINS)
    if text:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        out[:N_CHAR_BINS] = np.bincount(CHAR_CLASSES[codes], minlength=N_CHAR_BINS)
    bins = WORD_BINS
    last = len(bins) + len(LENGTH_BINS)
    for w in words:
        w = w.lower().rstrip(".,;:!?")
        k = bins.get(w)
        if k is None:
            k = last
            for i, n in enumerate(LENGTH_BINS):
                if len(w) <= n:
                    k = len(bins) + i
                    break
        out[N_CHAR_BINS + k] += 1
    return out


def base_rules(text: str, words: list[str]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines and n_repeat_words of a text with these words."""
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += WORDS.search(line) is not None
        else:
            seen.add(line)
    n = len(words)
    repeat = 0
    if n > 3:
        places: dict[tuple[str, str, str], int] = {}
        marked = bytearray(n)
        for i, gram in enumerate(zip(words, words[1:], words[2:])):
            at = places.setdefault(gram, i)
            if at != i:
                marked[at : at + 3] = b"\1\1\1"
                marked[i : i + 3] = b"\1\1\1"
        repeat = sum(marked)
    return sum(map(len, words)), len(SYMBOLS.findall(text)), dup, repeat


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms, 0 to 1; 0 if either is empty."""
    a, b = p.sum(), q.sum()
    if not a or not b:
        return 0.0
    p, q = p / a, q / b
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0.0).sum()
        right = np.where(q > 0, q * np.log2(q / m), 0.0).sum()
    return float(max(0.0, (left + right) / 2)) ** 0.5


def language_references(docs: DataFrame) -> DataFrame:
    """(lang, histogram) of each language over all its documents of at least MIN_WORDS words, as bytes of doubles.

    Each document counts by its shares, so one long text weighs no more than another. Every
    task sends one vector a language. Languages without such documents have none; key OTHER
    holds all documents and serves null and unseen languages.
    """

    def summed(frames):
        sums: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(N_CHAR_BINS + N_WORD_BINS))
        rows = lambda: pd.DataFrame([(k, i, float(x)) for k, v in sums.items() for i, x in enumerate(v) if x], columns=["lang", "bin", "x"])
        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"]):
                words = WORDS.findall(text)
                if len(words) >= MIN_WORDS:
                    h = histograms(text, words)
                    h[:N_CHAR_BINS] /= max(1.0, h[:N_CHAR_BINS].sum())
                    h[N_CHAR_BINS:] /= max(1.0, h[N_CHAR_BINS:].sum())
                    sums[OTHER] += h
                    if lang:
                        sums[lang] += h
            if len(sums) > 2_000:
                yield rows()
                sums.clear()
        if sums:
            yield rows()

    @F.pandas_udf("binary")
    def packed(bins: pd.Series) -> pd.Series:
        def one(pairs):
            out = np.zeros(N_CHAR_BINS + N_WORD_BINS)
            for p in pairs:
                out[p["bin"]] = p["x"]
            return out.tobytes()

        return bins.map(one)

    rows = docs.select(text_of().alias("text"), F.col("lang").cast("string").alias("lang")).mapInPandas(summed, "lang string, bin int, x double")
    totals = rows.groupBy("lang", "bin").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.collect_list(F.struct("bin", "x")).alias("h"))
    return staged(totals.select("lang", packed("h").alias("histogram")), "references")


def quality_rules(docs: DataFrame, references: DataFrame) -> DataFrame:
    """Base counts, distances and verdict of every row of `docs` (doc_id, text, lang).

    Null text has no words and fails the base rules, as do texts under 50 words or with more
    than half of their words in repeated three-word windows. Of the others, those stay whose
    distances from their language's reference are within both limits, which are wider for
    short texts. Repeated rows repeat; an empty table gives none.

    References are joined by language. If they are too many for Spark to send to every task,
    documents move once, those of very common languages dealt to several tasks.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, char_distance double, word_distance double, kept boolean"
    )
    columns = [c.split()[0] for c in schema.split(", ")]
    every = references.where(F.col("lang") == OTHER).select("histogram").first()
    every = bytes(every[0]) if every else None

    def judged(frames):
        for frame in batches(frames, 500):
            out = []
            for doc_id, text, own in zip(frame["doc_id"], frame["text"], frame["histogram"]):
                words = WORDS.findall(text)
                n = len(words)
                chars, symbols, dup, repeat = base_rules(text, words)
                failed = n < MIN_WORDS or 100 * repeat > 50 * n
                by_char = by_word = 0.0
                kept = not failed
                ref = every if own is None else own
                if n >= MIN_WORDS and ref is not None:
                    h, ref = histograms(text, words), np.frombuffer(ref)
                    by_char = jensen_shannon(h[:N_CHAR_BINS], ref[:N_CHAR_BINS])
                    by_word = jensen_shannon(h[N_CHAR_BINS:], ref[N_CHAR_BINS:])
                    kept = kept and by_char <= (CHAR_LIMIT**2 + CHANCE / n) ** 0.5 and by_word <= (WORD_LIMIT**2 + 2 * CHANCE / n) ** 0.5
                out.append((doc_id, n, chars, symbols, dup, repeat, failed, by_char, by_word, kept))
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(OTHER)).alias("lang"))
    hot = hot_keys(rows.groupBy("lang").agg(F.count("*").alias("n")), "lang")
    parts = staged(in_parts(references, hot, "lang"), "parts")  # written, so that Spark knows how small it is
    known = dealt(rows, hot, "lang", "doc_id").join(parts, ["lang", "part"], "left")
    return known.select("doc_id", "text", "histogram").mapInPandas(judged, schema)
