import hashlib
import itertools
import random
import re
import time
from collections import Counter

import numpy as np
import pytest

from aeroskein.llm import personal_data as pd_
from aeroskein.llm.personal_data import KINDS, LABELS, base_spans, counts_of, find_in, find_personal_data, graph_of, learn, luhn, marginals, masked, model_of, solve, span_columns

PHONE, OTHER, CARD = "+1 (017) 555-7713", "+1 (291) 555-0128", "4845168114407329"
TEXTS = [f"some words {PHONE} more. {OTHER} and a.55@mail3.example.com here, 97.51.17.173 or {CARD} too, version 3.1 of 12 in 2024", f"then {PHONE} and {CARD} again, {CARD}. Le 7 et 97.51.17.173."] * 20


@pytest.fixture(scope="module")
def model():
    return model_of(counts_of(iter(TEXTS)))


def slow_base(text):
    """The contract's patterns as they stand."""
    checks = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and slow_luhn(re.sub("[^0-9]", "", m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, fine) in checks.items() for m in re.finditer(p, text) if fine(m.group())]


def slow_luhn(digits):
    total = 0
    for place, d in enumerate(map(int, digits[::-1])):
        total += sum(map(int, str(2 * d))) if place % 2 else d
    return total % 10 == 0


def test_base_equals_the_patterns():
    rng = random.Random(1)
    pieces = ["a.b@c.de", "x@y", "@", ".", "1.2.3.4", "256.1.1.1", "001.02.3.4.5.6.7", CARD, "4845 1681 4410 7329", "4845-1681-44107329", "+1 ", "(017)", " ", "555-7713", "-", "é", "\n", "9", "+49 30 1234567", "a_b%c@d-e.f.g", "..", "+"]
    for _ in range(3_000):
        text = "".join(rng.choices(pieces, k=rng.randrange(12)))
        assert base_spans(text)[0] == slow_base(text), text
    assert all(luhn(s) == slow_luhn(s) for s in (str(rng.randrange(10**15, 10**19)) for _ in range(500)))


def test_marginals_equal_enumeration_where_there_are_no_loops():
    rng = np.random.default_rng(2)
    unary, one, two = rng.normal(size=(5, 4)), rng.normal(size=(4, 4)), rng.normal(size=(4, 4))
    chain, skip = np.array([(0, 1), (1, 2)]), np.array([(1, 3), (0, 4)])
    joint = np.zeros((4,) * 5)
    for y in itertools.product(range(4), repeat=5):
        joint[y] = np.exp(sum(unary[i, v] for i, v in enumerate(y)) + sum(one[y[i], y[j]] for i, j in chain) + sum(two[y[i], y[j]] for i, j in skip))
    want = np.array([joint.sum(axis=tuple(a for a in range(5) if a != i)) for i in range(5)])
    assert np.allclose(marginals(unary, [(chain, one), (skip, two)]), want / want.sum(axis=1, keepdims=True), atol=1e-3)
    assert np.allclose(marginals(unary, []), np.exp(unary) / np.exp(unary).sum(axis=1, keepdims=True))


def slow_marginals(graph, model):
    """The same messages, one edge and one label at a time."""
    n = len(LABELS)
    after = {j for _, j in graph.chain}
    unary = [[pd_.NEVER if LABELS[y].endswith("+") and i not in after else model.site(s)[y] for y in range(n)] for i, s in enumerate(graph.sites)]
    tables = {}
    for pairs, table in ((graph.chain, model.chain), (graph.skip, model.skip)):
        for i, j in pairs:
            tables[i, j], tables[j, i] = table, table.T
    sent = {e: [0.0] * n for e in tables}
    believed = lambda i: [unary[i][y] + sum(m[y] for (_, b), m in sent.items() if b == i) for y in range(n)]
    for _ in range(pd_.ROUNDS):
        new = {}
        for (i, j), table in tables.items():
            b = believed(i)
            out = [np.log(sum(np.exp(b[y] - sent[j, i][y] + table[y, z]) for y in range(n))) for z in range(n)]
            new[i, j] = [pd_.DAMPING * old + (1 - pd_.DAMPING) * (v - max(out)) for old, v in zip(sent[i, j], out)]
        sent = new
    shares = [np.exp(believed(i)) for i in range(len(graph.sites))]
    return np.array([s / s.sum() for s in shares])


def test_loopy_messages_equal_slow_ones_and_texts_solved_together(model):
    texts = [f"{PHONE} then (017) 555-7713, or 555-7713 {CARD} {CARD} 12", TEXTS[0], "none", "97.51.17.173 and 97-51-17-173 and 97.51.17.173"]
    graphs = [graph_of(t) for t in texts]
    assert graphs[0].skip and graphs[0].chain and not graphs[2].sites
    for graph, found in zip(graphs, solve(graphs, model)):
        assert np.allclose(found, solve([graph], model)[0])
        if graph.sites:
            assert np.allclose(found, slow_marginals(graph, model), atol=1e-6)


def found_in(text, model):
    base, added = next(find_in([text], model))
    return [text[s:e] for _, s, e in base], {(k, text[s:e]) for k, s, e, _ in added}


def test_repeated_and_similar_words_are_labelled_alike(model):
    alone, repeated = found_in("call 555-7713 now", model), found_in(f"call 555-7713 now, that is {PHONE}", model)
    assert alone == ([], set()) and repeated == ([PHONE], {("phone", "555-7713")})
    assert found_in(f"97-51-17-173 is 97.51.17.173 and {CARD[:8]}.{CARD[8:]} is {CARD}", model)[1] >= {("ip", "97-51-17-173")}
    no_skips = pd_.Model(model.unary, model.chain, np.zeros_like(model.skip))
    assert found_in(f"call 555-7713 now, that is {PHONE}", no_skips)[1] == set()


def test_what_the_patterns_miss(model):
    other = next(str(n) for n in range(7536784127813050, 7536784127813060) if luhn(str(n)))
    assert found_in(f"so {other} {CARD} here", model) == ([], {("card", other), ("card", CARD)})  # two cards in one failed match
    assert found_in("so +1 (826) 555-4081 190.137.223.204 here", model) == (["190.137.223.204"], {("phone", "+1 (826) 555-4081")})
    assert ("email", "b.7(at)mail.example.org") in found_in("to b.7(at)mail.example.org.", model)[1]
    assert found_in("version 3.1 of 12 in 2024, 300 (3) 1/2 Ünï3", model) == ([], set())


def test_whole_query(spark, docs_of):
    texts = [*TEXTS[:2], None, "", TEXTS[0], f"call 555-7713 or {PHONE}é", "no data"] * 3
    docs = docs_of([(None if i == 4 else 2**60 + i // 2, t) for i, t in enumerate(texts)])
    model = learn(docs)
    want_model = model_of(counts_of(t or "" for t in texts))
    assert model.unary.keys() == want_model.unary.keys() and np.allclose(model.skip, want_model.skip) and np.allclose(model.chain, want_model.chain)
    rows = span_columns(find_personal_data(docs, model)).collect()
    listed = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))
    want = []
    for i, text in enumerate(texts):
        base, graph = slow_base(text or ""), graph_of(text or "")
        spans = base + [s[:3] for s in pd_.added_spans(text or "", graph, slow_marginals(graph, want_model), base)] if graph.sites else base
        numbers = Counter(k for k, *_ in base)
        want.append((repr(None if i == 4 else 2**60 + i // 2), *(numbers[k] for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)))
    assert sorted((repr(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in rows) == sorted(want)
    empty = docs.limit(0)
    assert find_personal_data(empty, learn(empty)).collect() == []


def test_masked_texts(spark, docs_of, model):
    docs = docs_of([(1, f"call 555-7713 or {PHONE}, x@y.z."), (2, "nothing"), (3, None), (4, f"so {CARD} {CARD}")])
    got = {r.doc_id: r.text for r in masked(docs, find_personal_data(docs, model)).collect()}
    assert got == {1: "call <phone> or <phone>, <email>.", 2: "nothing", 3: None, 4: "so <card> <card>"}


def test_long_texts_take_time_in_proportion(model):
    start = time.perf_counter()
    for text in ("a" * 2_000_000, "1" * 1_000_000, "1." * 200_000, "a@" * 100_000, "(" * 1_000_000, "(at)" * 100_000, "+1" + "(" * 500_000, "1 " * 50_000):
        list(find_in([text], model))
        counts_of([text])
    assert time.perf_counter() - start < 60
