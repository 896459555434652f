import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroskein.llm import divergence as D
from aeroskein.llm import toxicity as T
from aeroskein.llm.divergence import base_rules, jensen_shannon, language_references, quality_rules
from aeroskein.llm.knn_quality import fit_voters, quality_scores, term_vector
from aeroskein.llm.toxicity import Grammar, learn_grammar, score_toxicity, toxicity_scores

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    read = lambda t: spark.read.parquet(f"{DATA}/{t}.parquet")
    return read("documents"), read("labels")


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_toxicity(spark, tables):
    docs, labels = tables
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    test = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([a == b for a, b in test]) > 0.95


def test_clauses_not_words():
    g = Grammar({"idiot": 5.0, "vequ*": 5.0})
    plain, target = g.score("the idiot"), g.score("you idiot")
    assert plain < target and g.score("not an idiot") < plain and g.score("he said idiot") < target
    assert g.score("vequmo") < 0.7 < g.score("vequmo vequra") and g.score("good") < 0.1 and g.score("") < 0.1
    assert g.score("idiot. idiot.") > plain and g.score("not good, an idiot") > g.score("not idiot")


def test_a_target_decides():
    g = Grammar(Grammar().insults | {"vequmo": 7.0})
    clean = "the river runs past the old mill and on to the sea. " * 2_000
    toxic = ["I will kill you", "we'll shoot him", "I am going to hurt you", "you idiot", "they are scum", "you are such a moron", "he's a vequmo"]
    fine = ["take out the trash", "the clown came on stage", "one vequmo was seen", "they kill time", "he said: you may kill the process", "she wrote I will kill you", "I will not kill you", "they took out the trash"]
    assert [t for t in toxic if g.score(t) < 0.7] == [] and [t for t in fine if g.score(t) >= 0.7] == []
    for t in toxic:
        assert g.score(clean + t + ". " + clean) >= 0.7
    for t in [*fine, "trash. " + clean + "clown. " + clean + "stupid", "they kill. " + clean + "they kill", "they kill, and they murder. They shoot and stab them"]:
        assert g.score(clean + t + ". " + clean) < 0.7
    assert g.score("what an idiot, a moron, such a loser") >= 0.7


def slow_best(grammar, words):
    """Greatest weight of a clause by trying every reading of every match, each rule said in full."""
    clean = [w.strip(",") for w in words]
    is_target = lambda w: w in T.ADDRESSED or w in T.JOINED
    negated, left = [], 0
    for raw, w in zip(words, clean):
        negated.append(left > 0)
        left = T.NEGATION_SCOPE if w in T.NEGATORS else max(0, left - 1)
        left = 0 if raw.endswith(",") else left
    reported = any(w in T.REPORTED for w in clean)

    def meets(i):
        """A pronoun in the words before makes a copula at i a target."""
        return clean[i] in T.COPULAS and any(w in T.OTHERS for w in clean[max(0, i - T.COPULA_REACH) : i])

    def object_at(j):
        return clean[j] in T.OBJECTS or clean[j] in T.OTHER_OBJECTS and any(w in T.SPEAKERS for w in clean[:j])

    choices = []
    for i, w in enumerate(clean):
        loss = (grammar.negated if negated[i] else 0) + (grammar.reported if reported else 0)
        mine = [0.0]
        if grammar.insult(w):
            near = range(max(0, i - T.REACH), min(len(clean), i + T.REACH + 1))
            aimed = any(is_target(clean[j]) for j in near if j != i) or any(meets(j) for j in range(max(0, i - T.REACH), i))
            mine.append(grammar.insult(w) + (grammar.target_bonus if aimed else grammar.lone) + loss)
        if grammar.threats.get(w):
            aimed = any(object_at(j) for j in range(i + 1, min(len(clean), i + T.REACH + 1)))
            mine.append(grammar.threats[w] + (grammar.threat_bonus if aimed else grammar.lone_threat) + loss)
        choices.append(mine)
    return max(map(sum, itertools.product(*choices)))


def test_best_path_is_that_of_all_readings():
    g = Grammar(Grammar().insults | {"vequ*": 4.5})
    vocabulary = "idiot scum vequmo kill hurt you your he him they is are i we'll he's not don't said the a mill sea, idiot, you, not,".split()
    rnd = random.Random(11)
    for _ in range(4000):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 9))]
        assert sum(w for _, _, w in g.clause(words)) == pytest.approx(slow_best(g, words)), words


def test_compositions_say_what_their_parts_say():
    """Arcs of a composition are chains of its parts' arcs, and its ends are common ends."""
    negation, report = T.negation_transducer(-3.0), T.report_transducer(-2.0)
    both = negation.compose(report)
    not_, said, lone = frozenset(["negator"]), frozenset(["report"]), T.LONE
    assert both.starts == [(0, "plain"), (0, "guessed")]
    assert both.arcs((0, "plain"), not_) == [((T.NEGATION_SCOPE, "plain"), not_, 0.0)]
    assert both.arcs((2, "guessed"), lone) == [((1, "guessed"), lone, -5.0)]
    assert both.arcs((0, "plain"), said) == [] and both.arcs((0, "guessed"), said) == [((0, "reported"), said, 0.0)]
    assert both.final((0, "plain")) and both.final((3, "reported")) and not both.final((0, "guessed"))


def test_each_transducer_decides():
    """Leaving one out changes verdicts."""
    said = lambda text, **less: Grammar(**less).score(text) >= 0.7
    assert said("you idiot") and not said("you idiot", targets=False) and not said("you idiot", insults={})
    assert said("I will kill you") and not said("I will kill you", threats={}) and not said("I will kill you", targets=False)
    assert not said("you are not an idiot") and said("you are not an idiot", negated=None)
    assert not said("she wrote you idiot") and said("she wrote you idiot", reported=None)
    assert not said("Don't call him an idiot") and not said("Stupid question: how do I sort a list?") and not said("idiot")


def test_families_need_two_words():
    g = Grammar({}, frozenset(["achl"]))
    assert g.score("achlich") < 0.7 and g.score("you achlich") < 0.7 and g.score("achlich achlich") < 0.7
    assert g.score("achlich und achlge") >= 0.7 and g.score("nicht achlich und achlge") < 0.7
    assert g.score("achlich " + "und " * 200 + "achlge") < 0.7


def test_families_are_learned(spark, docs_of):
    """Clean texts have one word of the stem, toxic ones several in a passage."""
    rows = [(i, f"one fine xabc{i} here" if i % 2 == 0 else f"one xabcq{i} and xabcr{i} there") for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    g = learn_grammar(docs_of(rows), labels)
    assert g.families & {"xabc"} and not any(k.startswith("xabc*") for k in g.insults)
    assert g.score("xabczz and xabcyy") >= 0.7 > g.score("xabczz")


def test_labels_of_held_out_rows_are_never_read(spark, docs_of):
    rows = [(i, "bad word here" if i % 2 else "fine word here") for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2 if not held(i) else 1 - i % 2) for i, _ in rows], "doc_id long, toxic int")
    g = learn_grammar(docs_of([(i, f"{t} {i}") for i, t in rows]), labels)
    assert "bad" in g.insults and "fine" not in g.insults


def test_odd_texts(spark, tables, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "x" * 100_000), (None, "a"), (1, None)])
    out = score_toxicity(docs, Grammar({"idiot": 5.0}))
    assert out.count() == 5 and out.where("score is null or predicted is null").count() == 0
    assert toxicity_scores(docs.limit(0), tables[1]).count() == 0
    got = quality_scores(docs, tables[1].limit(0)).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}


def test_held_out_quality(spark, tables):
    docs, labels = tables
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    test = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert np.mean([a == b for a, b in test]) > 0.95


def test_votes_are_those_of_all_voters(spark, tables):
    docs, labels = tables
    voters = fit_voters(docs, labels, 200)
    texts = [r["text"] for r in docs.limit(20).collect()] + ["", "x"]
    x = voters.project(np.stack([term_vector(t) for t in texts])).astype(float)
    for one, got in zip(x, voters.vote(np.stack([term_vector(t) for t in texts]))):
        sims = voters.vectors.astype(float) @ one
        near = np.argsort(-sims)[:15]
        w = np.maximum(0, sims[near]) ** 4 + 1e-9
        assert got == pytest.approx((w * voters.labels[near]).sum() / w.sum(), abs=1e-3)


def slow_rules(text):
    words = [w for w in "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in text).split(" ") if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeat = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines, dup = text.split("\n"), 0
    for i, line in enumerate(lines):
        dup += line in lines[:i] and any(c not in " \t\n\x0b\x0c\r" for c in line)
    return sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat)


@pytest.mark.parametrize("text", ["", " ", "a", "a b c", "a b c a b c", "x x x x x", "l\nl\n\n\nl", "a b #|% a b c d a b", "a b c d a b c e a b c", "\n".join(["w 1 2"] * 4)])
def test_base_rules(text):
    from aeroskein.llm.divergence import WORDS

    assert base_rules(text, WORDS.findall(text)) == slow_rules(text)


def test_divergence():
    a, b = np.array([1.0, 0, 3]), np.array([0, 2.0, 0])
    assert jensen_shannon(a, a * 5) == pytest.approx(0) and jensen_shannon(a, b) == pytest.approx(1) and jensen_shannon(a, b * 0) == 0


def test_clean_documents_stay_and_junk_goes(spark, tables):
    docs, labels = tables
    got = quality_rules(docs, language_references(docs))
    joined = got.join(labels, "doc_id").where("not base_failed")
    clean, junk = joined.where("quality = 1"), joined.where("quality = 0")
    assert clean.where("kept").count() >= 0.99 * clean.count() and junk.where("kept").count() <= 0.3 * junk.count()


def test_odd_languages(spark, docs_of):
    text = "the of and to in is it that for was " * 2 + " ".join(f"w{i}" for i in range(60))
    docs = docs_of([(1, text, "en"), (2, text, None), (3, text, "xx"), (4, None, "en"), (5, "short", "en"), (6, text, "en")])
    got = {r["doc_id"]: r for r in quality_rules(docs, language_references(docs)).collect()}
    assert all(got[i]["kept"] for i in (1, 2, 3, 6)) and got[4]["base_failed"] and got[5]["base_failed"]
    assert quality_rules(docs.limit(0), language_references(docs.limit(0))).count() == 0


def slow_distance(p, q):
    a, b = sum(p.values()), sum(q.values())
    if not a or not b:
        return 0.0
    out = 0.0
    for k in p.keys() | q.keys():
        x, y = p.get(k, 0) / a, q.get(k, 0) / b
        out += sum(z * math.log2(2 * z / (x + y)) for z in (x, y) if z) / 2
    return math.sqrt(max(0.0, out))


def slow_bins(text):
    """Character classes and words of a text, counted one by one."""
    chars, words = Counter(), Counter()
    for c in text:
        kind = next((k for k, marks in {"space": " \t\x0b\x0c", "line": "\n\r", "stop": ".,;:!?", "quote": "'\"()[]{}«»“”", "symbol": "#*$%&|<>@=+~^_\\/"}.items() if c in marks), None)
        if kind is None and ord(c) < 0x250:
            kind = "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "letter" if c.isalpha() else "mark"
        chars[kind or "letter"] += 1
    common = {w for ws in D.COMMON_WORDS.values() for w in ws.split()}
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        w = w.lower().rstrip(".,;:!?")
        words[w if w in common else next((n for n in (3, 6, 10, 15) if len(w) <= n), 99)] += 1
    return chars, words


def test_verdicts_are_those_of_a_slow_count(spark):
    """References over all documents of a language, distances and verdicts, all by loops."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("lang")).alias("lang"))
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in docs.collect()]
    refs: dict = {}
    for _, text, lang in rows:
        if len(re.findall(r"[^\x20\x09-\x0D]+", text)) >= 50:
            for key in {lang or "", ""}:
                for at, bins in enumerate(slow_bins(text)):
                    ref = refs.setdefault(key, (Counter(), Counter()))[at]
                    for k, c in bins.items():
                        ref[k] += c / sum(bins.values())
    got = {r["doc_id"]: r for r in quality_rules(docs, language_references(docs)).collect()}
    for doc_id, text, lang in rows:
        r, n = got[doc_id], len(re.findall(r"[^\x20\x09-\x0D]+", text))
        repeat = slow_rules(text)[3] if n < 400 else r["n_repeat_words"]
        failed = n < 50 or repeat > n / 2
        near = [slow_distance(x, y) for x, y in zip(slow_bins(text), refs[lang or ""])] if n >= 50 else [0.0, 0.0]
        assert (r["n_words"], r["base_failed"]) == (n, failed)
        assert [r["char_distance"], r["word_distance"]] == pytest.approx(near, abs=1e-6)
        limits = [math.sqrt(0.1483**2 + 4 / max(n, 1)), math.sqrt(0.4**2 + 8 / max(n, 1))]
        if all(abs(x - y) > 1e-6 for x, y in zip(near, limits)):
            assert r["kept"] == (not failed and all(x <= y for x, y in zip(near, limits)))
