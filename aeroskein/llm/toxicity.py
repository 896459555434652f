"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five transducers read a clause from left to right, each what the one before it writes:
insults and threats turn words into matches with a weight, targets tell aimed matches from
lone ones, negators and markers of reported speech take weight away. Their composition is
expanded as states are reached. A clause is read along its best path, which may guess (that a
target will follow, that the clause will turn out to be reported) but must keep its guesses.
A document's score is that of its strongest passage: matches of different words add up, so a
lone word never decides, nor does the length of a text.

Insult words and stems, with their weights, are learned from labelled rows, on top of a few
plain insults that labelled rows can also take away. So are families: stems that clean texts
have too, but of which only toxic ones have different words in one passage. The small lists
below give the other transducers.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Hashable
from dataclasses import dataclass, field
from functools import cached_property

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import WORD, held_out, staged, text_of, training_rows

#: Most labelled rows that the lexicon is learned from.
MAX_LABELLED = 40_000
STEMS = (4, 5, 6)

#: Insults that need no evidence, unless labelled rows speak against them, and their weight.
INSULTS = frozenset("idiot idiots stupid moron morons imbecile loser losers scum pathetic worthless disgusting clown trash dumbass jackass asshole bastard bitch retard".split())
INSULT_WEIGHT = 4.2
#: No insult weighs more, so that none decides without a target; and what each word of a family weighs, aimed or not.
MOST, FAMILY_WEIGHT = 4.6, 2.1
THREATS = {"kill": 2.0, "hurt": 1.2, "destroy": 1.0, "shoot": 1.6, "stab": 2.0, "strangle": 2.2, "murder": 1.8}
#: Who an insult reaches: the person spoken to or pointed at, or another one whom a copula joins to it.
ADDRESSED = frozenset("you your you're yours u ur those these du dich dir ihr euch tu te toi vous tú usted vosotros".split())
OTHERS = frozenset("he she they them him her".split())
COPULAS = frozenset("is are was were am be ist sind war est sont es son".split())
JOINED = frozenset("he's she's they're".split())
#: Whom a threat reaches, after it; another person only from a speaker.
OBJECTS = frozenset("you u dich dir euch te toi vous".split())
OTHER_OBJECTS = frozenset("him her them".split())
SPEAKERS = frozenset("i i'll i'm i'd we we'll we're ich wir je nous yo".split())
NEGATORS = frozenset("not never no isn't aren't wasn't don't doesn't nicht kein keine pas jamais nunca".split())
REPORTED = frozenset("said says reported claimed quoted wrote alleged according called sagte dit dijo".split())
#: The word classes that the transducers read.
CLASSES = {"addressed": ADDRESSED, "other": OTHERS, "copula": COPULAS, "joined": JOINED, "object": OBJECTS, "other object": OTHER_OBJECTS, "speaker": SPEAKERS, "negator": NEGATORS, "report": REPORTED}
#: Words after a negator that it reaches, within commas.
NEGATION_SCOPE = 4
#: Words between which an insult or threat reaches its target, and a pronoun its copula.
REACH, COPULA_REACH = 5, 3
#: A passage's words, how many different ones of it count, and what a word adds that comes again.
PASSAGE, STRONGEST, AGAIN = 100, 3, 1.4
#: Raw words whose symbols a worker remembers.
REMEMBERED = 200_000
CLAUSE_ENDS = re.compile(r"[.!?;:\n]")
TRIM = re.compile(r"^\W+|\W+$")

#: Symbols besides word classes: any other word, a comma, and what the transducers write.
PLAIN, COMMA = frozenset(), frozenset([","])
INSULT, THREAT, FAMILY = frozenset(["<insult>"]), frozenset(["<threat>"]), frozenset(["<family>"])
AIMED, LONE, AIMED_THREAT, LONE_THREAT = (frozenset([x]) for x in ("<aimed insult>", "<lone insult>", "<aimed threat>", "<lone threat>"))
MATCHES = frozenset([AIMED, LONE, AIMED_THREAT, LONE_THREAT, FAMILY])

State = Hashable
Symbol = frozenset
Arc = tuple[State, Symbol, float]


class Transducer:
    """A weighted finite-state transducer whose arcs are made when a state is first reached.

    move(state, symbol) lists the arcs (next state, symbol written, weight) of a state for a
    symbol read; none means that the path ends there. final tells whether a clause may end.
    """

    def __init__(self, starts: list[State], move: Callable[[State, Symbol], list[Arc]], final: Callable[[State], bool] = lambda state: True):
        self.starts, self.move, self.final = starts, move, final
        self.made: dict[tuple[State, Symbol], list[Arc]] = {}

    def arcs(self, state: State, symbol: Symbol) -> list[Arc]:
        got = self.made.get((state, symbol))
        if got is None:
            got = self.made[state, symbol] = self.move(state, symbol)
        return got

    def compose(self, then: Transducer) -> Transducer:
        """The transducer that gives to `then` what this one writes; weights add up."""

        def move(state, symbol):
            return [
                ((x, y), out, w1 + w2) for x, between, w1 in self.arcs(state[0], symbol) for y, out, w2 in then.arcs(state[1], between)
            ]

        return Transducer([(x, y) for x in self.starts for y in then.starts], move, lambda s: self.final(s[0]) and then.final(s[1]))


def lexical(*reads: Symbol) -> Transducer:
    """The insult or threat transducer over word symbols: one state; a match is written, or the word isn't meant so.

    Which words are matches and what they weigh is the lexicon's: it gives the symbols `reads`.
    """
    return Transducer([0], lambda state, symbol: [(0, symbol, 0.0), (0, PLAIN, 0.0)] if symbol in reads else [(0, symbol, 0.0)])


def target_transducer(bonus: float, lone: float, threat_bonus: float, lone_threat: float) -> Transducer:
    """Writes each match as aimed or lone.

    State: whether a speaker was seen; words left in which a copula joins a pronoun; words
    left in which an insult is aimed at a target before it; words left in which a target has
    to come for an insult, and for a threat, that was guessed to be aimed (0: none).
    """

    def move(state, symbol):
        speaker, pronoun, have, owe, threat_owes = state
        if symbol == COMMA:
            return [(state, symbol, 0.0)]
        owes_after = lambda left, paid: 0 if paid or not left else left - 1 or -1
        joined = "joined" in symbol or "copula" in symbol and pronoun > 0
        pays = "addressed" in symbol or "joined" in symbol
        pays_threat = "object" in symbol or "other object" in symbol and speaker
        owe, threat_owes = owes_after(owe, pays), owes_after(threat_owes, pays_threat)
        if owe < 0 or threat_owes < 0:
            return []  # the target didn't come in time
        speaker = speaker or "speaker" in symbol
        pronoun = COPULA_REACH if "other" in symbol else max(0, pronoun - 1)
        # a target reaches REACH words; the word itself is none of them
        left = REACH if pays or joined else max(0, have - 1)
        after = (speaker, pronoun, left, owe, threat_owes)
        if symbol == INSULT:
            if have:
                return [(after, AIMED, bonus)]
            return [(after, LONE, lone), ((speaker, pronoun, left, owe or REACH, threat_owes), AIMED, bonus)]
        if symbol == THREAT:
            return [(after, LONE_THREAT, lone_threat), ((speaker, pronoun, left, owe, threat_owes or REACH), AIMED_THREAT, threat_bonus)]
        return [(after, symbol, 0.0)]

    return Transducer([(False, 0, 0, 0, 0)], move, lambda s: not s[3] and not s[4])


def negation_transducer(weight: float) -> Transducer:
    """Takes weight from matches up to NEGATION_SCOPE words after a negator. State: words left of its scope."""

    def move(left, symbol):
        if symbol == COMMA:
            return [(0, symbol, 0.0)]
        if "negator" in symbol:
            return [(NEGATION_SCOPE, symbol, 0.0)]
        return [(max(0, left - 1), symbol, weight if left and symbol in MATCHES else 0.0)]

    return Transducer([0], move)


def report_transducer(weight: float) -> Transducer:
    """Takes weight from the matches of a clause that reports speech, before and after the marker.

    States: the clause is none; it is guessed to be one; its marker was seen. A plain clause
    has no arc for a marker, and a guess without a marker can't end.
    """

    def move(state, symbol):
        if "report" in symbol:
            return [] if state == "plain" else [("reported", symbol, 0.0)]
        return [(state, symbol, weight if symbol in MATCHES and state != "plain" else 0.0)]

    return Transducer(["plain", "guessed"], move, lambda state: state != "guessed")


@dataclass(frozen=True)
class Grammar:
    """Weights, in the log domain, that the transducers give. None leaves a transducer out."""

    insults: dict[str, float] = field(default_factory=lambda: dict.fromkeys(INSULTS, INSULT_WEIGHT))
    families: frozenset[str] = frozenset()
    threats: dict[str, float] = field(default_factory=lambda: dict(THREATS))
    bias: float = -3.0
    target_bonus: float = 0.7
    #: What an insult and a threat without a target lose, and what a threat that reaches one gains.
    lone: float = -2.1
    lone_threat: float = -1.0
    threat_bonus: float = 3.0
    negated: float | None = -3.0
    reported: float | None = -2.0
    #: Without it every match is lone.
    targets: bool = True

    def __getstate__(self):
        return {f: getattr(self, f) for f in self.__dataclass_fields__}  # what is made from them is made anew

    def insult(self, word: str) -> float:
        got = self.insults.get(word, 0.0)
        for k in STEMS:
            if len(word) > k:
                got = max(got, self.insults.get(word[:k] + "*", 0.0))
        return min(got, MOST)

    def related(self, word: str) -> bool:
        return any(len(word) > k and word[:k] in self.families for k in STEMS) if self.families else False

    def read(self, word: str) -> list[tuple[Symbol, float]]:
        """The symbols of a word and their weights; an insult that is a threat too has two."""
        found = [(INSULT, self.insult(word)), (THREAT, self.threats.get(word, 0.0))]
        found = [x for x in found if x[1] > 0] or [(FAMILY, FAMILY_WEIGHT)] * self.related(word)
        return found or [(frozenset(k for k, words in CLASSES.items() if word in words), 0.0)]

    @cached_property
    def machine(self) -> Transducer:
        """All transducers composed."""
        out = lexical(INSULT, FAMILY).compose(lexical(THREAT))
        never = float("-inf")
        out = out.compose(target_transducer(self.target_bonus if self.targets else never, self.lone, self.threat_bonus if self.targets else never, self.lone_threat))
        if self.negated is not None:
            out = out.compose(negation_transducer(self.negated))
        if self.reported is not None:
            out = out.compose(report_transducer(self.reported))
        return out

    def clause(self, words: list[str]) -> list[tuple[int, str, float]]:
        """(place, label, weight) of the matches on a clause's best path. A word that ends in a comma ends a scope.

        A lone threat has an empty label: a passage counts one of them at most.
        """
        machine = self.machine
        best: dict[State, tuple[float, tuple | None]] = {s: (0.0, None) for s in machine.starts}
        for place, raw in enumerate(words):
            word = TRIM.sub("", raw)
            for reading in (self.read(word), [(COMMA, 0.0)] if raw.endswith(",") else []):
                if not reading:
                    continue
                now: dict[State, tuple[float, tuple | None]] = {}
                for state, (weight, path) in best.items():
                    for symbol, own in reading:
                        for following, out, more in machine.arcs(state, symbol):
                            match = own + more if out in MATCHES else 0.0
                            total = weight + match
                            if total > now.get(following, (-math.inf,))[0]:
                                now[following] = (total, (place, "" if out == LONE_THREAT else word, match, path) if out in MATCHES else path)
                best = now
        ends = [x for s, x in best.items() if machine.final(s)]
        found = []
        path = max(ends, key=lambda x: x[0])[1] if ends else None
        while path is not None:
            place, label, weight, path = path
            found.append((place, label, weight))
        return found[::-1]

    @cached_property
    def hits(self) -> Hits:
        return Hits(self)

    def matches(self, text: str) -> list[tuple[int, str, float]]:
        """The matches of all clauses of a text, by the place of their words."""
        out, place, hits = [], 0, self.hits
        for clause in CLAUSE_ENDS.split(text.lower()):
            words = clause.split()
            if True in map(hits.__getitem__, words):
                out += [(place + i, label, weight) for i, label, weight in self.clause(words)]
            place += len(words)
        return out

    def score(self, text: str) -> float:
        """Score of a whole text, between 0 and 1: that of its strongest passage."""
        best, found = 0.0, self.matches(text)
        for k, (start, _, _) in enumerate(found):
            passage: dict[str, float] = {}
            again = 0.0
            for at, label, weight in found[k : k + PASSAGE]:
                if at >= start + PASSAGE:
                    break
                if label in passage and label:
                    again = AGAIN
                passage[label] = max(passage.get(label, 0.0), weight)
            best = max(best, sum(sorted(passage.values())[-STRONGEST:]) + again)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.bias + best))))


class Hits(dict):
    """Whether a raw word is an insult or a threat; others pass clauses by. Forgets all when it is full."""

    def __init__(self, grammar: Grammar):
        super().__init__()
        self.grammar = grammar

    def __missing__(self, raw: str) -> bool:
        if len(self) >= REMEMBERED:
            self.clear()
        word = TRIM.sub("", raw)
        got = self.grammar.insult(word) > 0 or word in self.grammar.threats or self.grammar.related(word)
        self[raw] = got
        return got


def word_features(text: str) -> set[str]:
    """Words without outer punctuation, their stems (ab*), and stems of which a passage has different words (ab**)."""
    words = [TRIM.sub("", w) for w in re.findall(WORD, text.lower())]
    out = set(words) - {""}
    out |= {w[:k] + "*" for w in out for k in STEMS if len(w) > k}
    last: dict[str, tuple[str, int]] = {}
    for at, word in enumerate(words):
        for k in STEMS:
            if len(word) > k:
                stem = word[:k]
                before = last.get(stem)
                if before is not None and before[0] != word and at - before[1] < PASSAGE:
                    out.add(stem + "**")
                last[stem] = (word, at)
    return out


def learn_grammar(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, purity: float = 0.97) -> Grammar:
    """A grammar whose insults and families come from at most `limit` labelled rows.

    Documents with each word, stem or family are counted by label on the executors, equal texts once.
    Candidates are in enough toxic documents (0.5 % of them, but 3 at least and 8 at most) and
    in hardly any other. Those in 3 % of the toxic documents are taken, if that is twice
    enough. Copies of one toxic text make all its words candidates, so rarer ones have to
    explain documents that no taken entry explains: each such document votes for its most
    frequent candidate, and what gets enough votes is taken, until nothing does. Each taken
    entry then explains enough of the `limit` rows of its own, which bounds the lexicon.
    An entry weighs the logarithm of its ratio, MOST at most. Labels other than 0 and 1, and
    held-out rows, are never read. Without toxic rows only the plain insults and threats match.
    """
    rows = staged(training_rows(docs, labels, "toxic", limit).dropDuplicates(["text"]).select("doc_id", "text", "label"), "labelled")

    def counted(frames):
        pos, neg, totals = Counter(), Counter(), [0, 0]
        for frame in frames:
            for text, label in zip(frame["text"], frame["label"]):
                (pos if label else neg).update(word_features(text))
                totals[int(label)] += 1
        if any(totals):
            yield pd.DataFrame({"term": [""], "pos": [totals[1]], "neg": [totals[0]]})
        terms = list(pos.keys() | neg.keys())
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pd.DataFrame({"term": part, "pos": [pos[t] for t in part], "neg": [neg[t] for t in part]})

    sums = rows.select("text", "label").mapInPandas(counted, "term string, pos long, neg long").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sums = staged(sums.where((F.col("pos") >= 3) | F.col("term").isin("", *INSULTS)), "terms")
    known = {r["term"]: r for r in sums.where(F.col("term").isin("", *INSULTS)).collect()}
    n_pos, n_neg = (known[""]["pos"], known[""]["neg"]) if "" in known else (0, 0)
    plain = {t: INSULT_WEIGHT for t in INSULTS if t not in known or known[t]["neg"] < 3 or known[t]["pos"] > known[t]["neg"]}
    enough = max(3, min(8, math.ceil(0.005 * n_pos)))
    candidates = staged(sums.where((F.col("term") != "") & (F.col("pos") >= enough) & (F.col("pos") >= F.lit(purity) * (F.col("pos") + F.col("neg")))), "candidates")
    strong = F.col("pos") >= max(2 * enough, 0.03 * n_pos)

    def present(frames):
        for frame in frames:
            out = [(i, t) for i, text in zip(frame["doc_id"], frame["text"]) for t in word_features(text)]
            yield pd.DataFrame(out, columns=["doc_id", "term"])

    # (document, candidate) of toxic documents without a taken entry
    pairs = rows.where("label = 1").select("doc_id", "text").mapInPandas(present, "doc_id long, term string").join(candidates.select("term", strong.alias("strong")), "term")
    pairs = staged(pairs, "pairs")
    taken = candidates.where(strong).select("term")
    explained = pairs.where("strong").select("doc_id").distinct()
    while True:
        pairs = staged(pairs.join(explained, "doc_id", "left_anti"), "pairs")
        counts = pairs.groupBy("term").agg(F.count("*").alias("n"))
        best = pairs.join(counts, "term").groupBy("doc_id").agg(F.max(F.struct("n", "term")).alias("best"))
        votes = staged(best.groupBy(F.col("best.term").alias("term")).agg(F.count("*").alias("n")).where(F.col("n") >= enough).select("term"), "votes")
        if not votes.limit(1).count():
            break
        taken = taken.union(votes)
        explained = pairs.join(votes, "term").select("doc_id").distinct()
    weight = lambda r: math.log((r["pos"] + 0.5) / (n_pos + 1)) - math.log((r["neg"] + 0.5) / (n_neg + 1))
    found = candidates.join(taken, "term").collect()
    families = frozenset(r["term"][:-2] for r in found if r["term"].endswith("**"))
    return Grammar(plain | {r["term"]: min(MOST, max(plain.get(r["term"], 0.0), weight(r))) for r in found if not r["term"].endswith("**")}, families)


def score_toxicity(docs: DataFrame, grammar: Grammar, threshold: float = 0.7) -> DataFrame:
    """`docs` with columns score (0 to 1) and predicted (1 from `threshold` on).

    Only the text decides. Null and empty texts score as a text without matches. Columns
    named score or predicted in `docs` are replaced; repeated rows repeat.
    """

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return texts.map(grammar.score)

    out = docs.withColumn("score", scored(text_of()))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    scored = score_toxicity(docs.select("doc_id", "text"), learn_grammar(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
