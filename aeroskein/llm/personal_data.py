"""Personal data in texts: fixed patterns, and a skip-chain conditional random field that adds what they miss.

The field's sites are the words that hold a digit or an at sign. Neighbouring sites of one line
form chains; sites far apart whose letters and digits are the same, whose last seven digits are,
or that name the same mail user, are joined by skip edges, each to the one before it, so their
number grows with the text alone. All other words are no personal data of these kinds, which
cuts a text into small graphs. Loopy belief propagation, a fixed number of damped rounds, gives the
marginal of each label at each site.

Weights are learned piece by piece from the corpus itself: what the patterns find are its labels,
and words in matches that failed their check (a card number run together with another, say) have
none. Site, chain and skip pieces are counted over all documents; a few hundred signatures with
their counts reach the driver, and their number is bounded by how signatures are made.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from aeroskein.llm.common import text_of

KINDS = ("email", "ip", "card", "phone")
#: Labels of a site: nothing, or the first or a further word of a kind.
LABELS = ("none", "email", "ip", "card", "card+", "phone", "phone+")
#: The kind of each label, as its place in ("none", *KINDS).
KIND_OF = np.array([0, 1, 2, 3, 3, 4, 4])
FURTHER = {3: 4, 5: 6}
NEVER = -30.0
ROUNDS, DAMPING = 20, 0.5
#: What a rule needs to be sure of before it adds a span.
LEAST_MARGINAL = 0.6
#: Sites of the texts that are solved together.
SITES = 20_000

_W = r"\x20\x09-\x0D"
_AT = r"[(\[]at[)\]]"
SITE = re.compile(rf"(?<![^{_W}])(?:[^{_W}0-9@(\[]++|[(\[](?!at[)\]]))*+(?:[0-9@]|{_AT})[^{_W}]*+")
EDGE = re.compile(r"^[^\w+(\[]*|[^\w)\]]*$")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
USER = re.compile(r"[A-Za-z0-9._%+-]")
MAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[str, int, int]


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]+", "", text)


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in address.split("."))


def _passes(kind: str, match: str) -> bool:
    if kind == "ip":
        return small_parts(match)
    digits = digits_of(match)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _mails(text: str) -> Iterator[Span]:
    """Leftmost matches found from the at signs, so that long runs of letters are read once."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and USER.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            after = found.end()
            yield "email", start, after
        else:
            after = at + 1
        at = text.find("@", max(after, at + 1))


def base_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(found, failed) matches of the fixed patterns by kind, then start; offsets are code points, ends exclusive."""
    found, failed = list(_mails(text)), []
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            (found if _passes(kind, m.group()) else failed).append((kind, m.start(), m.end()))
    return found, failed


@dataclass(frozen=True)
class Site:
    start: int
    end: int
    signature: str
    coarse: str
    keys: tuple[str, ...]


def _bucket(n: int) -> str:
    return str(n) if n <= 4 or n in (7, 16) else next(name for last, name in ((6, "5-6"), (8, "8"), (12, "9-12"), (15, "13-15"), (19, "17-19"), (math.inf, "20+")) if n <= last)


def site_of(word: str, offset: int) -> Site | None:
    """The word without punctuation around it, its signature, and the keys that similar words share."""
    found = _short(word) if len(word) <= 64 else _site(word)
    return found and Site(found.start + offset, found.end + offset, found.signature, found.coarse, found.keys)


def _site(word: str) -> Site | None:
    lead, tail = EDGE.match(word).end(), len(word)
    while tail > lead and not (word[tail - 1].isalnum() or word[tail - 1] in "_)]"):
        tail -= 1
    for left, right in ("()", "[]"):
        if word[lead:tail].endswith(right) and left not in word[lead:tail]:
            tail -= 1
        if word[lead:tail].startswith(left) and right not in word[lead:tail]:
            lead += 1
    core = word[lead:tail]
    if not core:
        return None
    plain = re.sub(r"[(\[]dot[)\]]", ".", re.sub(_AT, "@", core))
    name = re.sub(r"[\W_]+", "", plain.lower())
    if "@" in plain:
        user = re.sub(r"[\W_]+", "", plain.partition("@")[0].lower())
        coarse = f"@{min(plain.count('@'), 2)}{int(MAIL.fullmatch(plain) is not None)}"
        return Site(lead, tail, coarse + "~" * (plain != core), coarse, tuple({name, user}))
    digits = digits_of(core)
    parts = re.findall(r"[0-9]+", core)
    between = {c for c in core if not c.isalnum()}
    fine = luhn(digits) if 13 <= len(digits) <= 19 else len(parts) == 4 and between == {"."} and small_parts(".".join(parts))
    letters = any(c.isalpha() for c in core)
    coarse = f"{_bucket(len(digits))}{'a' * letters}{'v' * fine}{min(len(parts), 5) if between else 1}"
    shape = "+" * core.startswith("+") + "(" * ("(" in core) + "." * ("." in between) + "-" * ("-" in between) + "?" * bool(between - set("+().-"))
    keys = {name} if len(name) >= 3 else set()
    return Site(lead, tail, coarse + shape, coarse, tuple(keys | ({digits[-7:]} if len(digits) >= 7 and not letters else set())))


#: A worker remembers so many short words.
_short = lru_cache(maxsize=1 << 16)(_site)


@dataclass
class Graph:
    """Sites of a text; edges of chains and skips as pairs of their numbers, the earlier first."""

    sites: list[Site]
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def graph_of(text: str) -> Graph:
    sites = [s for m in SITE.finditer(text) if (s := site_of(m.group(), m.start()))]
    graph, last = Graph(sites), {}
    for i, site in enumerate(sites):
        if i and site.start - sites[i - 1].end == 1 and text[sites[i - 1].end] in " \t":
            graph.chain.append((i - 1, i))
        before = {last[k] for k in site.keys if k in last}
        graph.skip += [(j, i) for j in sorted(before) if (j, i) not in graph.chain[-1:]]
        last |= dict.fromkeys(site.keys, i)
    return graph


def labels_of(sites: list[Site], found: list[Span], failed: list[Span]) -> list[int | None]:
    """What the fixed patterns say of each site; None where a match failed its check."""
    labels: list[int | None] = [0] * len(sites)
    starts = np.array([s.start for s in sites])
    ends = np.array([s.end for s in sites])
    for spans, failing in ((failed, True), (found[::-1], False)):
        for kind, start, end in spans:
            inside = range(int(np.searchsorted(ends, start, "right")), int(np.searchsorted(starts, end, "left")))
            for place, i in enumerate(inside):
                label = LABELS.index(kind)
                labels[i] = None if failing else FURTHER.get(label, label) if place else label
    return labels


@dataclass(frozen=True)
class Model:
    """Log potentials: of a label by signature, of neighbours, and of the two ends of a skip edge."""

    unary: dict[str, np.ndarray]
    chain: np.ndarray
    skip: np.ndarray

    def site(self, site: Site) -> np.ndarray:
        found = self.unary.get(site.signature)
        return found if found is not None else self.unary.get("~" + site.coarse, self.unary[""])


def counts_of(texts: Iterator[str]) -> Counter:
    """(piece, key, label): how often, over these texts."""
    counts = Counter()
    for text in texts:
        graph = graph_of(text)
        if not graph.sites:
            continue
        labels = labels_of(graph.sites, *base_spans(text))
        for site, label in zip(graph.sites, labels, strict=True):
            if label is not None:
                counts["site", f"{site.signature} {site.coarse}", label] += 1
        for piece, pairs in (("chain", graph.chain), ("skip", graph.skip)):
            for i, j in pairs:
                if labels[i] is not None and labels[j] is not None:
                    counts[piece, str(labels[i]), labels[j]] += 1
    return counts


def model_of(counts: Counter) -> Model:
    """Potentials of counted pieces.

    Of a signature: the share of each label, smoothed by that of its coarse signature and then of
    all sites. Of neighbours: how much more often than elsewhere a kind goes on with a further
    word, which nothing else may precede. Of a skip edge: how much more often its ends have these
    two kinds than chance would give; one agreeing pair a kind is counted beforehand.
    """
    n, pairs, fine, coarse = len(LABELS), np.zeros((2, len(LABELS), len(LABELS))), {}, {}
    for (piece, key, label), times in counts.items():
        if piece == "site":
            signature, rough = key.split(" ")
            fine.setdefault((signature, rough), np.zeros(n))[label] += times
            coarse.setdefault(rough, np.zeros(n))[label] += times
        else:
            pairs[int(piece == "skip"), int(key), label] += times
    overall = sum(coarse.values(), np.zeros(n)) + 1.0
    overall /= overall.sum()
    shares = {"": np.log(overall)}
    rough = {k: (c + overall) / (c.sum() + 1) for k, c in coarse.items()}
    shares |= {"~" + k: np.log(p) for k, p in rough.items()}
    shares |= {k: np.log((c + rough[r]) / (c.sum() + 1)) for (k, r), c in fine.items()}

    chain, seen = np.zeros((n, n)), pairs[0]
    for first, further in FURTHER.items():
        inside = [first, further]
        everywhere = (seen[:, further].sum() + 0.5) / (seen.sum() + n)
        goes_on = (seen[inside, further].sum() + 0.5) / (seen[inside].sum() + 1)
        chain[inside] += math.log((1 - goes_on) / (1 - everywhere))
        chain[:, further] = NEVER
        chain[inside, further] = math.log(goes_on / everywhere)

    kinds = np.eye(len(KINDS) + 1)
    np.add.at(kinds, (KIND_OF[:, None], KIND_OF[None, :]), pairs[1] + pairs[1].T)
    share = kinds.sum(axis=1) / kinds.sum()
    chance = np.outer(share, share)
    skip = np.clip(np.log((kinds + chance) / (kinds.sum() + 1) / chance), -4, 4)
    return Model(shares, chain, skip[KIND_OF][:, KIND_OF])


def marginals(unary: np.ndarray, edges: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Loopy belief propagation: the marginals of sites with log potentials `unary`.

    `edges` lists pairs (m x 2 site numbers, their log potentials). All messages of a round are
    made at once from those of the round before and damped; the number of rounds is fixed, so graphs
    that are solved together don't change each other.
    """
    ways = [(ends[:, d], ends[:, 1 - d], np.exp(table if d == 0 else table.T)) for ends, table in edges if len(ends) for d in (0, 1)]
    messages = [np.zeros((len(source), unary.shape[1])) for source, _, _ in ways]

    def beliefs():
        total = unary.copy()
        for (_, target, _), sent in zip(ways, messages):
            np.add.at(total, target, sent)
        return total

    for _ in range(ROUNDS if ways else 0):
        belief, made = beliefs(), []
        for k, (source, _, table) in enumerate(ways):
            out = belief[source] - messages[k ^ 1]  # the way back of each edge is next to it
            new = np.log(np.exp(out - out.max(axis=1, keepdims=True)) @ table)
            made.append(DAMPING * messages[k] + (1 - DAMPING) * (new - new.max(axis=1, keepdims=True)))
        messages = made
    return _shares(beliefs())


def _shares(logs: np.ndarray) -> np.ndarray:
    values = np.exp(logs - logs.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def solve(graphs: list[Graph], model: Model) -> list[np.ndarray]:
    """The marginals of the sites of each graph; the graphs are solved side by side."""
    offsets = np.cumsum([0] + [len(g.sites) for g in graphs])
    if not offsets[-1]:
        return [np.zeros((0, len(LABELS)))] * len(graphs)
    unary = np.array([model.site(s) for g in graphs for s in g.sites])
    ends = [np.array([(i + at, j + at) for at, g in zip(offsets, graphs) for i, j in pairs(g)], dtype=np.int64).reshape(-1, 2) for pairs in (lambda g: g.chain, lambda g: g.skip)]
    begins = np.setdiff1d(np.arange(len(unary)), ends[0][:, 1])
    unary[np.ix_(begins, list(FURTHER.values()))] = NEVER
    found = marginals(unary, list(zip(ends, (model.chain, model.skip))))
    return [found[a:b] for a, b in zip(offsets, offsets[1:])]


def added_spans(text: str, graph: Graph, found: np.ndarray, base: list[Span]) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, least marginal) of what the field finds beside `base`.

    A span's words are sure enough, it meets none of `base`, and it is what its kind says: a mail
    address, four numbers up to 255, 13 to 19 digits with their check digit, 7 to 15 digits.
    """
    labels, follows = found.argmax(axis=1), {j for _, j in graph.chain}
    spans, i = [], 0
    while i < len(labels):
        j = i + 1
        while j < len(labels) and j in follows and labels[j] == FURTHER.get(labels[i], labels[i] if labels[i] in FURTHER.values() else -1):
            j += 1
        kind, first, last = KIND_OF[labels[i]], graph.sites[i], graph.sites[j - 1]
        if kind:
            sure = float(found[np.arange(i, j), labels[i:j]].min())
            spans.append((KINDS[kind - 1], first.start, last.end, sure))
        i = j
    taken = sorted((s, e) for _, s, e in base)
    starts, most = [s for s, _ in taken], np.maximum.accumulate([e for _, e in taken]) if taken else []
    fresh = []
    for kind, start, end, sure in spans:
        at = int(np.searchsorted(starts, end, "left"))
        if sure >= LEAST_MARGINAL and not (at and most[at - 1] > start) and _fits(kind, text[start:end]):
            fresh.append((kind, start, end, sure))
    return fresh


def _fits(kind: str, text: str) -> bool:
    if kind == "email":
        return MAIL.fullmatch(re.sub(r"[(\[]dot[)\]]", ".", re.sub(_AT, "@", text))) is not None
    digits = digits_of(text)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and small_parts(".".join(parts))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 7 <= len(digits) <= 15


COUNTED = pa.schema([("piece", pa.string()), ("key", pa.string()), ("label", pa.int32()), ("n", pa.int64())])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(_SPAN))])


def learn(docs: DataFrame) -> Model:
    """The model of all documents; what reaches the driver is one row a signature or pair of labels."""

    def count(batches):
        total = Counter()
        for batch in batches:
            total.update(counts_of(batch.column("text").to_pylist()))
        if total:
            yield pa.RecordBatch.from_pylist([{"piece": p, "key": k, "label": y, "n": n} for (p, k, y), n in total.items()], schema=COUNTED)

    counted = docs.select(text_of().alias("text")).mapInArrow(count, from_arrow_schema(COUNTED)).groupBy("piece", "key", "label").agg(F.sum("n").alias("n"))
    return model_of(Counter({(r.piece, r.key, r.label): r.n for r in counted.collect()}))


def find_in(texts: list[str], model: Model) -> Iterator[tuple[list[Span], list[tuple[str, int, int, float]]]]:
    """(base spans, added spans) of each text."""
    start = 0
    while start < len(texts):
        graphs, sites = [], 0
        while start + len(graphs) < len(texts) and sites < SITES:
            graphs.append(graph_of(texts[start + len(graphs)]))
            sites += len(graphs[-1].sites)
        for text, graph, found in zip(texts[start:], graphs, solve(graphs, model)):
            base, _ = base_spans(text)
            yield base, added_spans(text, graph, found, base)
        start += len(graphs)


def find_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans): one row per row of `docs`.

    spans (kind, start, end, base, score) holds what the fixed patterns find (base) and what the
    field adds, by kind and then start, in code points. Null and empty texts have none;
    repeated rows each have their row; null ids stay null. Any text is read whole, in time that
    grows with its length.
    """

    def find(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            rows = []
            for doc_id, (base, added) in zip(ids, find_in(texts, model), strict=True):
                spans = [(*s, True, 1.0) for s in base] + [(*s[:3], False, s[3]) for s in added]
                spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                rows.append({"doc_id": doc_id, "spans": [dict(zip(("kind", "start", "end", "base", "score"), s)) for s in spans]})
            yield pa.RecordBatch.from_pylist(rows, schema=FOUND)

    return docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).mapInArrow(find, from_arrow_schema(FOUND))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_columns(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of what the fixed patterns found, and spans, all of them, as a list."""
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    numbers = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *numbers, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with each span of its text replaced by <kind>; of overlapping spans the earlier and then the longer counts.

    `found` is what find_personal_data() says of `docs`; both need unique doc_ids. Texts without spans stay as they are.
    """

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        def one(text, found):
            out, at = [], 0
            for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in found) if found is not None else ():
                if start >= at:
                    out += [text[at:start], f"<{kind}>"]
                    at = end
            return None if text is None else "".join(out) + text[at:]

        return pd.Series([one(t, s) for t, s in zip(texts, spans)], dtype=object)

    named = found.select("doc_id", F.col("spans").alias("_spans"))
    return docs.join(named, "doc_id", "left").withColumn("text", cut("text", "_spans")).select(*docs.columns)
