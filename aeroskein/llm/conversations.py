"""Repair of damaged conversations by lightest derivations, found with an agenda.

A conversation is right when its role initials read (s?(ua)+)?. Repair items are pairs
[rows read, state]; every edit is a deduction from one item to the next whose value, the pair
(cost, audit), never falls: a superior function. Knuth's agenda pops items in the order of
their values, so the value an item is popped with is final, and the first goal popped is the
lightest derivation, ties broken by the audit string.

Long conversations are cut into blocks. A block's own items give its lightest derivation between
any two states, and deductions with two antecedents, what was read so far and the next block,
concatenate them. This is exact: of two audits of one block and equal cost neither is the beginning
of the other, since inserts alone could follow and each costs 3.

Rows are sorted by ranges of (conversation, turn, role, text), copies dealt by a number of their own. A task
finishes the conversations that lie in it; those that reach over its ends, and very long ones, go on
in blocks over many tasks. Only the hash of such a conversation's text reads it from one end to the
other in one task, in blocks as they come.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, fields
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from aeroskein.llm.common import SPACE, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States by what has been read: nothing, a system row, a user row last, an assistant row last.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, FINAL = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ROLE = {"u": "user", "a": "assistant"}
#: The role that may be given or inserted in each state: there is just one.
FREE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
LEGAL = {"su", "ua", "au"}

#: Rows of a block, and characters of its texts after which it is closed.
BLOCK, BLOCK_CHARS = 64, 1 << 20
#: A conversation of more rows or characters goes on in blocks over several tasks.
WHOLE, WHOLE_CHARS = 4_096, 16 << 20
#: Blocks that are concatenated at once.
FAN = 64

Value = tuple[int, str]


def lightest(axioms: Iterable[tuple[Value, object]], deduce: Callable[[object, Value], Iterable[tuple[Value, object]]], goal: object = None) -> dict:
    """Knuth's agenda: the lightest value of every item (up to `goal`, if it is given), and the item it came from.

    `deduce(item, value)` yields what follows from a final item; its values are never below `value`.
    """
    agenda = [(value, n, item, None) for n, (value, item) in enumerate(axioms)]
    heapq.heapify(agenda)
    final, n = {}, len(agenda)
    while agenda:
        value, _, item, source = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value, source
        if item == goal:
            break
        for then, head in deduce(item, value):
            if head not in final:
                n += 1
                heapq.heappush(agenda, (then, n, head, item))
    return final


@dataclass(frozen=True)
class Row:
    """`copies` equal rows; `fresh` if the first of them has no equal row before it in its conversation."""

    role: str
    text: str
    copies: int
    fresh: bool

    @property
    def blank(self) -> bool:
        return not self.text.strip(SPACE)

    @property
    def truncated(self) -> bool:
        return self.text.rstrip(SPACE)[-1:] not in (".", "!", "?")


def edits(rows: list[Row]) -> list[tuple[str, int, int]]:
    """(role initial, cost of staying, rows that must go) by step: a row that may stay, or a run of rows that can't."""
    steps = []
    for row in rows:
        stays = row.fresh and not row.blank
        if stays:
            steps.append((row.role[:1], TRUNCATED if row.truncated else 0, 0))
        if row.copies > stays:
            steps.append(("", 0, row.copies - stays))
    return steps


def repairs(steps: list[tuple[str, int, int]]) -> Callable:
    """The deductions of one block: items are (steps read, state), and "goal" where a conversation may end."""

    def deduce(item, value):
        at, state = item
        cost, audit = value
        role = FREE[state]
        yield (cost + INSERT, audit + "I"), (at, NEXT[state][role])
        if at == len(steps):
            if state in FINAL:
                yield value, "goal"
            return
        initial, stay, gone = steps[at]
        if gone:
            yield (cost + DELETE * gone, audit + "D" * gone), (at + 1, state)
            return
        yield (cost + DELETE, audit + "D"), (at + 1, state)
        yield (cost + REROLE + stay, audit + "R"), (at + 1, NEXT[state][role])
        if initial in NEXT[state]:
            yield (cost + KEEP + stay, audit + "K"), (at + 1, NEXT[state][initial])

    return lambda item, value: () if item == "goal" else deduce(item, value)


#: Lightest (cost, audit, states between the blocks) by the states before and after.
Table = dict[tuple[int, int], tuple[int, str, str]]


def block_table(rows: list[Row], entries: Iterable[int] = STATES) -> Table:
    """The lightest derivation of the block between any two states."""
    steps = edits(rows)
    table = {}
    for entry in entries:
        final = lightest([((0, ""), (0, entry))], repairs(steps))
        for state in STATES:
            if (len(steps), state) in final:
                table[entry, state] = *final[len(steps), state][0], f"{entry}{state}"
    return table


def joined_table(tables: list[Table], entries: Iterable[int] = STATES) -> Table:
    """Tables of neighbouring blocks as one: items are (blocks read, state), their antecedents an item and a block."""

    def deduce(item, value):
        at, state = item
        if at < len(tables):
            for after in STATES:
                if found := tables[at].get((state, after)):
                    yield (value[0] + found[0], value[1] + found[1]), (at + 1, after)

    result = {}
    for entry in entries:
        final = lightest([((0, ""), (0, entry))], deduce)
        for state in STATES:
            item = (len(tables), state)
            if item in final:
                (cost, audit), way, at = final[item][0], [], item
                while at[0]:
                    before = final[at][1]
                    way.append(tables[at[0] - 1][before[1], at[1]][2])
                    at = before
                result[entry, state] = cost, audit, str(entry) + "".join(w[1:] for w in reversed(way))
    return result


def best(table: Table) -> tuple[int, str, str]:
    """The lightest derivation from the start to where a conversation may end."""
    return min(table[START, state] for state in FINAL if (START, state) in table)


def repaired(rows: list[Row], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """(role, text) of the rows after the edits of `audit`, which starts in `state`."""
    source = (row for row in rows for _ in range(row.copies))
    for edit in audit:
        row = next(source) if edit != "I" else None
        if edit == "D":
            continue
        role = row.role if edit == "K" else ROLE[FREE[state]]
        yield role, row.text if row else ""
        state = NEXT[state][role[:1]]


def turns(rows: list[Row], audit: str, state: int) -> list[dict]:
    return [{"role": role, "text": text} for role, text in repaired(rows, audit, state)]


@dataclass
class Counts:
    """What is counted in neighbouring rows, and what the counts of the next rows have to know of these."""

    n: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    first_role: str | None = None
    last_role: str | None = None

    def add(self, turn: int | None, row: Row) -> None:
        role = row.role[:1]
        fresh = row.fresh and not row.blank
        same = (row.copies - 1) * (role + role not in LEGAL)
        self.then(Counts(
            row.copies, row.copies * row.blank, 0 if row.blank else row.copies - fresh, int(fresh and row.truncated), same, int(turn is not None), turn, turn, role, role,
        ))

    def then(self, more: Counts) -> None:
        if more.n:
            self.illegal += more.illegal + (self.n > 0 and f"{self.last_role}{more.first_role}" not in LEGAL)
            self.turns += more.turns - (self.last_turn is not None and self.last_turn == more.first_turn)
            if self.first_turn is None:
                self.first_turn = more.first_turn
            if more.last_turn is not None:
                self.last_turn = more.last_turn
            self.first_role, self.last_role = self.first_role if self.n else more.first_role, more.last_role
            for name in ("n", "blank", "duplicate", "truncated"):
                setattr(self, name, getattr(self, name) + getattr(more, name))

    @property
    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0


_LONG, _INT, _TEXT, _FLAG = pa.int64(), pa.int32(), pa.string(), pa.bool_()
_NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = pa.schema([("conv_id", _LONG), *[(n, _LONG) for n in _NUMBERS], ("audit", _TEXT)])
_TURNS = pa.list_(pa.struct([("role", _TEXT), ("text", _TEXT)]))
FIRST_PASS = pa.schema([*RESULT, ("repaired", _TURNS), ("turn", _LONG), ("role", _TEXT), ("text", _TEXT), ("copies", _LONG), ("open", _FLAG)])
_PART = pa.struct([("high", _LONG), ("low", _LONG)])
_DERIVATION = pa.struct([("before", _INT), ("after", _INT), ("cost", _LONG), ("audit", _TEXT), ("way", _TEXT)])
_COUNTS = pa.struct([(f.name, _TEXT if f.name.endswith("role") else _LONG) for f in fields(Counts)])
_ROW = pa.struct([("role", _TEXT), ("text", _TEXT), ("copies", _LONG), ("fresh", _FLAG)])
JOINED = pa.schema([("conv_id", _LONG), ("high", _LONG), ("low", _LONG), ("counts", _COUNTS), ("derivations", pa.list_(_DERIVATION)), ("parts", pa.list_(_PART))])
BLOCKS = pa.schema([*JOINED, ("rows", pa.list_(_ROW))])
WINNERS = pa.schema([*RESULT, ("ways", pa.list_(pa.struct([("high", _LONG), ("low", _LONG), ("way", _TEXT)])))])
PIECES = pa.schema([("conv_id", _LONG), ("high", _LONG), ("low", _LONG), ("repaired", _TURNS)])
DIGESTS = pa.schema([("conv_id", _LONG), ("repaired_sha256", _TEXT)])


def result_row(conv_id: int | None, counts: Counts, cost: int, audit: str) -> dict:
    return {"conv_id": conv_id, "gaps": counts.gaps, "blank": counts.blank, "duplicate": counts.duplicate, "truncated": counts.truncated, "illegal": counts.illegal, "cost": cost, "audit": audit}


@dataclass
class Conversation:
    """The rows of one conversation that a task has read so far."""

    conv_id: int | None
    rows: list[tuple[int | None, str, str, int]] = field(default_factory=list)
    chars: int = 0

    def add(self, turn, role, text, copies) -> None:
        if self.rows and self.rows[-1][:3] == (turn, role, text):
            self.rows[-1] = (turn, role, text, self.rows[-1][3] + copies)
        else:
            self.rows.append((turn, role, text, copies))
            self.chars += len(role) + len(text)

    @property
    def long(self) -> bool:
        return len(self.rows) > WHOLE or self.chars > WHOLE_CHARS

    def open_rows(self) -> Iterator[dict]:
        for turn, role, text, copies in self.rows:
            yield {"conv_id": self.conv_id, "turn": turn, "role": role, "text": text, "copies": copies, "open": True}

    def finished(self) -> dict:
        seen, rows, counts = set(), [], Counts()
        for turn, role, text, copies in self.rows:
            if copies:
                rows.append(Row(role, text, copies, (role, text) not in seen))
                seen.add((role, text))
                counts.add(turn, rows[-1])
        if len(rows) <= BLOCK:
            cost, audit = lightest([((0, ""), (0, START))], repairs(edits(rows)), "goal")["goal"][0]
        else:
            blocks = [block_table(rows[i : i + BLOCK], STATES if i else (START,)) for i in range(0, len(rows), BLOCK)]
            cost, audit, _ = best(joined_table(blocks, (START,)))
        return result_row(self.conv_id, counts, cost, audit) | {"repaired": turns(rows, audit, START), "open": False}


def _rows_in(batches, *names: str) -> Iterator[tuple]:
    """The values of these columns row by row, as Python values: integers stay exact beside nulls."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _rows_out(rows: Iterator[dict], schema: pa.Schema, at_once: int = 2_000) -> Iterator[pa.RecordBatch]:
    while chunk := list(islice(rows, at_once)):
        yield pa.RecordBatch.from_pylist(chunk, schema=schema)


def _mapped(df: DataFrame, read: Callable, schema: pa.Schema) -> DataFrame:
    return df.mapInArrow(read, from_arrow_schema(schema))


_SORTED = ("conv_id", "turn", "role", "text", "copies")


def first_pass(batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows in, finished conversations and rows of open ones out."""

    def read() -> Iterator[dict]:
        now, first, spilt = None, True, False
        for conv_id, *row in _rows_in(batches, *_SORTED):
            if now is None:
                now = Conversation(conv_id)
            elif now.conv_id != conv_id:
                yield from now.open_rows() if first or spilt else [now.finished()]
                now, first, spilt = Conversation(conv_id), False, False
            now.add(*row)
            if now.long:
                yield from now.open_rows()
                now, spilt = Conversation(conv_id), True
        if now is not None:
            yield from now.open_rows()

    return _rows_out(read(), FIRST_PASS)


def blocks_of(batches) -> Iterator[pa.RecordBatch]:
    """Sorted rows of open conversations in, blocks out: their counts, their derivations, and their rows."""

    def block(conv_id, high, low, turns, rows) -> dict:
        counts = Counts()
        for turn, row in zip(turns, rows, strict=True):
            counts.add(turn, row)
        return {"conv_id": conv_id, "high": high, "low": low, "counts": vars(counts), "derivations": _derivations(block_table(rows)), "parts": [{"high": high, "low": low}], "rows": [vars(r) for r in rows]}

    def read() -> Iterator[dict]:
        high, low, now, rows, turns, chars = TaskContext.get().partitionId(), 0, None, [], [], 0
        for conv_id, turn, role, text, copies, fresh in _rows_in(batches, *_SORTED, "fresh"):
            if now is not None and (now[0] != conv_id or len(rows) == BLOCK or chars > BLOCK_CHARS):
                yield block(*now, high, low, turns, rows)
                low += 1
                rows, turns, chars = [], [], 0
            now = (conv_id,)
            if copies:
                rows.append(Row(role, text, copies, fresh))
                turns.append(turn)
                chars += len(text)
        if now is not None:
            yield block(*now, high, low, turns, rows)

    return _rows_out(read(), BLOCKS, 16)


def _derivations(table: Table) -> list[dict]:
    return [{"before": k[0], "after": k[1], "cost": v[0], "audit": v[1], "way": v[2]} for k, v in table.items()]


def _table(derivations: list[dict]) -> Table:
    return {(d["before"], d["after"]): (d["cost"], d["audit"], d["way"]) for d in derivations}


def joined_blocks(group: pa.Table) -> pa.Table:
    """At most FAN neighbouring blocks of one conversation as one."""
    blocks = sorted(group.to_pylist(), key=lambda b: (b["high"], b["low"]))
    counts = Counts()
    for block in blocks:
        counts.then(Counts(**block["counts"]))
    first, table = blocks[0], joined_table([_table(b["derivations"]) for b in blocks])
    row = {"conv_id": first["conv_id"], "high": first["_high"], "low": first["_low"], "counts": vars(counts), "derivations": _derivations(table), "parts": [p for b in blocks for p in b["parts"]]}
    return pa.Table.from_pylist([row], schema=JOINED)


def winners(batches) -> Iterator[pa.RecordBatch]:
    """One joined block a conversation in: its counts, cost and audit, and the states around each of its parts."""

    def read() -> Iterator[dict]:
        for conv_id, counts, derivations, parts in _rows_in(batches, "conv_id", "counts", "derivations", "parts"):
            cost, audit, way = best(_table(derivations))
            yield result_row(conv_id, Counts(**counts), cost, audit) | {"ways": [p | {"way": way[i : i + 2]} for i, p in enumerate(parts)]}

    return _rows_out(read(), WINNERS, 64)


def pieces(batches) -> Iterator[pa.RecordBatch]:
    """Blocks with the states around them in, the repaired rows of each out."""

    def read() -> Iterator[dict]:
        for conv_id, high, low, rows, derivations, way in _rows_in(batches, "conv_id", "high", "low", "rows", "derivations", "way"):
            before, after = map(int, way)
            yield {"conv_id": conv_id, "high": high, "low": low, "repaired": turns([Row(**r) for r in rows], _table(derivations)[before, after][1], before)}

    return _rows_out(read(), PIECES, 16)


def digests(batches) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by conversation and place in, one digest a conversation out; a piece is forgotten once it is hashed."""

    def read() -> Iterator[dict]:
        now, sha, begun = None, None, False
        for conv_id, rows in _rows_in(batches, "conv_id", "repaired"):
            if now is None or now[0] != conv_id:
                if now is not None:
                    yield {"conv_id": now[0], "repaired_sha256": sha.hexdigest()}
                now, sha, begun = (conv_id,), hashlib.sha256(), False
            for row in rows:
                sha.update(f"{'\n' if begun else ''}{row['role']}:{row['text']}".encode())
                begun = True
        if now is not None:
            yield {"conv_id": now[0], "repaired_sha256": sha.hexdigest()}

    return _rows_out(read(), DIGESTS)


@dataclass(frozen=True)
class Repairs:
    """results: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), a row a conversation.

    The repaired rows (role, text) in order are in arrays, column repaired: of whole conversations in
    `whole` (conv_id, repaired), of those that go over several tasks in `parts` (conv_id, high, low,
    repaired), one a block, in the order of high and low.
    """

    results: DataFrame
    whole: DataFrame
    parts: DataFrame

    def rows(self) -> DataFrame:
        """(conv_id, high, low, place, role, text): all repaired rows, in the order of high, low and place."""
        zero = F.lit(0).cast("long")
        both = self.whole.select("conv_id", zero.alias("high"), zero.alias("low"), "repaired").unionByName(self.parts)
        return both.select("conv_id", "high", "low", F.posexplode("repaired").alias("place", "_row")).select("conv_id", "high", "low", "place", "_row.*")


def open_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Results, and (conv_id, high, low, repaired), of rows (conv_id, turn, role, text, copies) in blocks over many tasks."""
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    content = ["conv_id", "role", "_digest"]
    rows = rows.withColumn("_digest", F.sha2(F.col("text").cast("binary"), 256))
    firsts = rows.where("copies > 0").groupBy(*content).agg(F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_min"))
    firsts = firsts.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_digest").alias("_d"), F.when(~F.col("_null"), F.col("_min")).alias("_t"), F.lit(True).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t")) & (F.col("role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    marked = rows.join(firsts, same, "left").select("conv_id", "turn", "role", "text", "copies", F.coalesce("_first", F.lit(False)).alias("fresh"))
    order = ["conv_id", "turn", "role", "text"]
    blocks = staged(_mapped(marked.repartitionByRange(*order).sortWithinPartitions(*order), blocks_of, BLOCKS), "blocks")

    joined = blocks.drop("rows")
    high, low = blocks.agg(F.max("high"), F.max("low")).first()
    while high or low:
        # blocks of a task first, then those of neighbouring tasks: at most FAN in each group
        by = (F.col("high"), F.floor(F.col("low") / FAN)) if low else (F.floor(F.col("high") / FAN), F.lit(0))
        high, low = (high, low // FAN) if low else (high // FAN, 0)
        joined = staged(joined.withColumns({"_high": by[0].cast("long"), "_low": by[1].cast("long")}).groupBy("conv_id", "_high", "_low").applyInArrow(joined_blocks, from_arrow_schema(JOINED)), "joined")

    won = staged(_mapped(joined, winners, WINNERS), "winners")
    ways = won.select("conv_id", F.explode("ways").alias("w")).select(F.col("conv_id").alias("_c"), F.col("w.high").alias("_h"), F.col("w.low").alias("_l"), F.col("w.way"))
    at = (F.col("high") == F.col("_h")) & (F.col("low") == F.col("_l"))  # one block each
    text = blocks.join(ways, at).select("conv_id", "high", "low", "rows", "derivations", "way")
    return won.drop("ways"), _mapped(text, pieces, PIECES)


def repair(rows: DataFrame) -> Repairs:
    """The cheapest repairs of rows (conv_id, turn, role, text, copies), whose turns are ordered nulls first, then by role and text.

    copies says how often a row is there; 0 marks that the conversation exists. A conversation
    without rows has zeros, an empty audit and no repaired rows; no rows give no results.
    """
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.select(*order, "copies").withColumn("_deal", F.xxhash64(F.monotonically_increasing_id()))
    spread = dealt.repartitionByRange(*order, "_deal").sortWithinPartitions(*order).drop("_deal")
    passed = staged(_mapped(spread, first_pass, FIRST_PASS), "conversations")
    won, parts = open_conversations(passed.where("open").select(*order, "copies"))
    whole = passed.where("not open")
    return Repairs(whole.select(*RESULT.names).unionByName(won.select(*RESULT.names)), whole.select("conv_id", "repaired"), parts)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of the rows after damage by crc32(conv_id:turn) % 20; nulls are one space.

    0 drops a row (0 copies), 1 empties its text, 2 takes its full stops, exclamation and question
    marks, 3 repeats it, 4 makes it a user's.
    """
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), known("role").alias("role"), known("text").alias("text"), code.alias("_code"))
    gone = F.col("_code") == 0
    text = F.when((F.col("_code") == 1) | gone, "").when(F.col("_code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(gone, "").when(F.col("_code") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(gone, 0).when(F.col("_code") == 3, 2).otherwise(1).cast("long").alias("copies"))


def repaired_digests(repairs: Repairs) -> DataFrame:
    """(conv_id, repaired_sha256): of the repaired rows as role:text, joined by line breaks."""
    lines = F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    whole = repairs.whole.select("conv_id", F.sha2(F.array_join(lines, "\n").cast("binary"), 256).alias("repaired_sha256"))
    parts = repairs.parts.repartition("conv_id").sortWithinPartitions("conv_id", "high", "low")
    return whole.unionByName(_mapped(parts, digests, DIGESTS))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of `conversations` (conv_id, turn, role, text, ...), null among them, after the damage.

    gaps, blank, duplicate, truncated and illegal count faults; cost and audit are those of the
    cheapest edits; repaired_sha256 hashes the repaired rows. Null roles and texts are one space,
    which no conversation accepts unless it is given another role. Rows of equal turns are
    ordered by role and text, so equal rows are neighbours; null turns come first. A conversation
    without rows after the damage has zeros and an empty audit. No rows give no rows.
    """
    repairs = repair(damaged(conversations))
    hashes = repaired_digests(repairs).select(F.col("conv_id").alias("_c"), "repaired_sha256")
    return repairs.results.join(hashes, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")
