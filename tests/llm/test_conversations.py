import hashlib
import itertools
import random
import re
import zlib

from aeroskein.llm.conversations import BLOCK, FINAL, START, WHOLE, Row, best, block_table, damaged, edits, joined_table, lightest, repair, repair_conversations, repaired, repaired_digests, repairs

SPACE = " \t\n\x0b\x0c\r"


def after_damage(rows):
    """Rows by conversation, damaged and ordered, by the words of the contract."""
    found = {}
    for conv, turn, role, text in rows:
        out = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in found.items()}


def faults(rows):
    seen, kinds = set(), []
    for _, role, text in rows:
        bare = text.rstrip(SPACE)
        kinds.append("blank" if not bare.strip(SPACE) else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return kinds


def slow(rows):
    """The result of one conversation by a table over rows and grammar states, with whole audits and whole texts."""
    kinds = faults(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    now = {"": (0, "", ())}

    def inserts(now):
        for _ in range(2):
            for state, (c, a, t) in list(now.items()):
                for role in ("user", "assistant"):
                    if to := step.get((state, role[0])):
                        now[to] = min(now.get(to, (10**9,)), (c + 3, a + "I", (*t, role + ":")))
        return now

    for (_, role, text), kind in zip(rows, kinds):
        then = {}
        for state, (c, a, t) in inserts(now).items():
            ways = [(state, (c + 4, a + "D", t))]
            if kind not in ("blank", "duplicate"):
                c += 3 * (kind == "truncated")
                ways += [(step.get((state, role[:1])), (c, a + "K", (*t, f"{role}:{text}")))]
                ways += [(step.get((state, r[0])), (c + 3, a + "R", (*t, f"{r}:{text}"))) for r in ("user", "assistant")]
            for to, value in ways:
                if to is not None:
                    then[to] = min(then.get(to, (10**9,)), value)
        now = then
    cost, audit, texts = min(v for s, v in inserts(now).items() if s in ("", "a"))
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(texts).encode()).hexdigest())


def conversations(spark, rows):
    schema = "conv_id long, turn long, role string, text string, copies string, open int, cost double"
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], schema)


def results(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def expected(rows):
    return {c: slow(r) for c, r in after_damage(rows).items()}


def some_rows(rng, conv, n):
    role = lambda: rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User"])
    return [(conv, i + rng.randrange(3) // 2, role(), rng.choice(["Good.", "Why?", "cut", " ", "", f"no {i}!", f"Ünïted {i} "])) for i in range(n)]


def every_edit(rows):
    """The cheapest repair of a few rows, by trying all edits with up to two inserts in each place."""
    kinds, found = faults([(0, *r) for r in rows]), []
    for cuts in itertools.product(range(3), repeat=len(rows) + 1):
        fillers = itertools.product(*[itertools.product("ua", repeat=c) for c in cuts])
        for filler, plan in itertools.product(fillers, itertools.product("KDua", repeat=len(rows))):
            cost, audit, roles = 0, "", ""
            for i in range(len(rows) + 1):
                audit, roles, cost = audit + "I" * len(filler[i]), roles + "".join(filler[i]), cost + 3 * len(filler[i])
                if i < len(rows):
                    must = kinds[i] in ("blank", "duplicate")
                    if must and plan[i] != "D":
                        break
                    audit += plan[i] if plan[i] in "KD" else "R"
                    roles += "" if plan[i] == "D" else rows[i][0][:1] if plan[i] == "K" else plan[i]
                    cost += {"K": 0, "D": 4}.get(plan[i], 3) + 3 * (plan[i] != "D" and kinds[i] == "truncated")
            else:
                if re.fullmatch("(s?(ua)+)?", roles):
                    found.append((cost, audit))
    return min(found)


def blocks(rows, size):
    seen, made = set(), []
    for role, text in rows:
        made.append(Row(role, text, 1, (role, text) not in seen))
        seen.add((role, text))
    return [made[i : i + size] for i in range(0, len(made), size)] or [[]]


def test_agenda_equals_all_edits_of_short_conversations():
    rng = random.Random(1)
    for n in (0, 1, 1, 2, 2, 2, 2, 3):
        for _ in range(2):
            rows = [(rng.choice(["user", "assistant", "system", "x"]), rng.choice(["A.", "B?", "c", ""])) for _ in range(n)]
            whole = blocks(rows, 9)[0]
            assert lightest([((0, ""), (0, START))], repairs(edits(whole)), "goal")["goal"][0] == every_edit(rows)


def test_blocks_joined_in_any_way_equal_the_whole():
    rng = random.Random(2)
    for n in (1, 7, 40):
        rows = [(r, t) for _, _, r, t in some_rows(rng, 0, n)]
        want = slow([(0, *r) for r in rows])
        for size in (1, 2, 5):
            parts = blocks(rows, size)
            tables = [block_table(p) for p in parts]
            joined = joined_table([joined_table(tables[i : i + 3]) for i in range(0, len(tables), 3)])
            cost, audit, way = best(joined)
            assert (cost, audit) == want[5:7] and len(way) == len(parts) + 1 and int(way[-1]) in FINAL
            lines = [f"{r}:{t}" for p, table, a, b in zip(parts, tables, way, way[1:]) for r, t in repaired(p, table[int(a), int(b)][1], int(a))]
            assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == want[7]


def test_values_never_fall_along_deductions():
    rows = blocks([(r, t) for _, _, r, t in some_rows(random.Random(3), 0, 12)], 99)[0]
    deduce = repairs(edits(rows))
    for item, (value, source) in lightest([((0, ""), (0, START))], deduce).items():
        assert all(then >= value for then, _ in deduce(item, value))
        assert source is None or item is not None


def test_whole_table_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [r for c in range(120) for r in some_rows(rng, c, rng.randrange(1, 9))]
    rows += [(None, 1, "user", "Hi."), (None, None, "assistant", None), (2**60 + 1, 0, None, "x."), (2**60 + 3, None, None, None), (2**60 + 3, 2**61 + 1, "user", "y"), (500, 3, "user", "Twice."), (500, 3, "user", "Twice."), (500, 3, "assistant", "Twice.")]
    rows += [(600, i, "user", "long " * 40_000 + ".") for i in range(3)] + some_rows(rng, 601, BLOCK * 3 + 5)
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows += [(gone, 0, "user", "Hi.")]
    found = results(repair_conversations(conversations(spark, rows)))
    assert found == expected(rows) and found[gone] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())


def test_a_conversation_with_most_rows(spark):
    rng = random.Random(5)
    rows = some_rows(rng, 7, WHOLE + 2_000) + [(7, 50, "user", "Copy.")] * 3_000 + [r for c in range(20, 60) for r in some_rows(rng, c, 6)]
    rng.shuffle(rows)
    table = conversations(spark, rows)
    spread = damaged(table)
    assert results(repair_conversations(table)) == expected(rows)
    found = repair(spread)
    lines, shas = {}, {r.conv_id: r.repaired_sha256 for r in repaired_digests(found).collect()}
    for r in sorted(found.rows().collect(), key=lambda r: (r.conv_id, r.high, r.low, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert found.parts.where("conv_id = 7").count() > 50
    assert all(hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() == sha for c, sha in shas.items()) and len(shas) == 41
    assert spread.where("conv_id = 7").agg({"copies": "sum"}).first()[0] > WHOLE


def test_empty_table(spark):
    empty = repair_conversations(conversations(spark, []))
    assert empty.collect() == [] and empty.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
