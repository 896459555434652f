"""Exact encoding and decoding with a SentencePiece model of merge type, by backtracking.

A text's encoding is the only sequence of pieces in which every two neighbours, merged anew
from single characters, give just those two. So no merges are simulated over the text: an
Aho-Corasick automaton finds the pieces that begin at each position, the longest is tried
first, and a position from which no compatible sequence reaches the end is marked in a
bitfield and not tried again.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroskein.llm.common import batches, text_of

SPACE_MARK = "▁"
#: Field numbers and kinds of the model file's messages (public format of the model file).
PIECES, PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
#: Segments whose encodings a worker remembers, in each of two generations, and pairs of pieces.
REMEMBERED, REMEMBERED_PAIRS = 500_000, 1_000_000


def model_fields(data: bytes):
    """(number, value) of each field of a serialised message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


class MergePieces:
    """The pieces of one model, its automaton, and the encoder and decoder over them."""

    def __init__(self, data: bytes):
        import struct

        import ahocorasick

        self.pieces, self.kinds, self.rank = [], [], {}
        scores = []
        for number, value in model_fields(data):
            if number == PIECES:
                got = dict(model_fields(value))
                self.pieces.append(got[PIECE_TEXT].decode())
                scores.append(struct.unpack("<f", got[PIECE_SCORE])[0] if PIECE_SCORE in got else 0.0)
                self.kinds.append(got.get(PIECE_KIND, NORMAL))
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.score = {p: scores[i] for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        if any(k == USER_DEFINED for k in self.kinds):
            raise ValueError("models with user-defined pieces are not supported")
        automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if SPACE_MARK not in piece[1:]:
                if any(a != SPACE_MARK and b == SPACE_MARK for a, b in zip(piece, piece[1:])):
                    raise ValueError("pieces must not reach over a space")
                automaton.add_word(piece, (len(piece), i))
            elif set(piece) != {SPACE_MARK}:
                raise ValueError("pieces must begin with one space mark at most")
        automaton.make_automaton()
        self.automaton = automaton
        line_end = "\n" if not any("\n" in p for p in self.ids) else ""
        self._segments = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}{line_end}]+|{SPACE_MARK}+" + f"|{line_end}" * bool(line_end))
        self.length = [len(p) for p in self.pieces]
        #: the longest proper prefix of each piece that is a piece, or -1
        self.shorter = [next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), -1) if self.kinds[i] == NORMAL else -1 for i, p in enumerate(self.pieces)]
        self.spines: dict[int, tuple | None] = {}
        #: whether two pieces are compatible, by left * number of pieces + right
        self.pairs: dict[int, bool] = {}
        self.characters = {p for p in self.ids if len(p) == 1}
        #: what normal pieces say; the others cover characters that aren't pieces
        self.plain = [p if k == NORMAL else "" for p, k in zip(self.pieces, self.kinds)]
        self.known = Remembered(self)

    def merged(self, text: str) -> tuple[list[str], list[tuple[int, int, float]]]:
        """The pieces of a short text by merging, best score first, then leftmost; and each merge's place, parts and score."""
        parts = list(text)
        score, steps = self.score, []
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                got = score.get(parts[i] + parts[i + 1])
                if got is not None and (best is None or got > best):
                    best, at = got, i
            if at < 0:
                return parts, steps
            steps.append((at, len(parts), best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def spine(self, piece: int) -> tuple | None:
        """How a piece grows from its characters: its growing right end and left end, or None if merging doesn't give it.

        An end is a list of (text, score of the merge that consumes it), the last one never
        consumed; `even` says that scores only fall as the piece grows.
        """
        if piece in self.spines:
            return self.spines[piece]
        text = self.pieces[piece]
        parts, steps = self.merged(text)
        got = None
        if parts == [text]:
            right, left = [], []
            last, first = text[-1], text[0]
            parts = list(text)
            for at, n, score in steps:
                joined = parts[at] + parts[at + 1]
                if at + 2 == n:
                    right.append((last, score))
                    last = joined
                if at == 0:
                    left.append((first, score))
                    first = joined
                parts[at : at + 2] = [joined]
            never = float("-inf")
            even = all(x[2] >= y[2] for x, y in zip(steps, steps[1:]))
            got = ([*right, (text, never)], [*left, (text, never)], even)
        self.spines[piece] = got
        return got

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of two pieces anew gives just those two.

        The merges inside each of them are known, so only the two ends that meet matter: they
        are walked as they grow, and the pieces part as soon as the ends themselves would be
        merged before either is consumed. Of equal scores the leftmost goes first.
        """
        a, b = self.spine(left), self.spine(right)
        if a is None or b is None:
            got = False
        elif a[2] and b[2]:
            ends, heads, score = a[0], b[1], self.score
            i = j = 0
            got = True
            while True:
                (x, t), (y, u) = ends[i], heads[j]
                s = score.get(x + y)
                if s is not None and s > t and s >= u:
                    got = False
                    break
                if t >= u and i + 1 < len(ends):
                    i += 1
                elif j + 1 < len(heads):
                    j += 1
                elif i + 1 < len(ends):
                    i += 1
                else:
                    break
        else:
            got = self.merged(self.pieces[left] + self.pieces[right])[0] == [self.pieces[left], self.pieces[right]]
        if len(self.pairs) >= REMEMBERED_PAIRS:
            self.pairs.clear()
        self.pairs[left * len(self.pieces) + right] = got
        return got

    def backtrack(self, text: str) -> list[int]:
        """Pieces of a text whose every character is a piece."""
        size = len(text)
        longest = [0] * size
        for last, (length, piece) in self.automaton.iter(text):
            longest[last - length + 1] = piece  # matches come by their end, so the longest of a start comes last
        failed = bytearray(size + 1)  # positions from which the end can't be reached
        lengths, shorter, pairs, n = self.length, self.shorter, self.pairs, len(self.pieces)
        path: list[int] = []
        at, piece, before = 0, longest[0], -1
        while True:
            end = at + lengths[piece]
            if not failed[end]:
                if before < 0:
                    ok = self.spine(piece) is not None
                else:
                    ok = pairs.get(before * n + piece)
                    if ok is None:
                        ok = self.compatible(before, piece)
                if ok:
                    path.append(piece)
                    if end == size:
                        return path
                    at, before, piece = end, piece, longest[end]
                    continue
            piece = shorter[piece]
            while piece < 0:
                if not path:
                    raise AssertionError("a text of known characters has an encoding")
                failed[at] = 1
                last = path.pop()
                before = path[-1] if path else -1
                at -= lengths[last]
                piece = shorter[last]

    def word(self, text: str) -> list[int]:
        """Pieces of a text without inner spaces; characters outside the model become bytes."""
        if self.characters.issuperset(text):
            return self.backtrack(text)
        out: list[int] = []
        run = 0
        for i, c in enumerate(text):
            if c not in self.characters:
                if run < i:
                    out += self.backtrack(text[run:i])
                out += [self.bytes.get(b, self.unknown) for b in c.encode()] if self.bytes else [self.unknown]
                run = i + 1
        if run < len(text):
            out += self.backtrack(text[run:])
        return out

    def spaces(self, count: int) -> list[int]:
        """Pieces of `count` space marks: pairs merge by score, then from the left."""
        size, after, before, alive = [1] * count, list(range(1, count + 1)), list(range(-1, count - 1)), [True] * count
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < count and (got := self.score.get(SPACE_MARK * (size[i] + size[j]))) is not None:
                heapq.heappush(heap, (-got, i, size[i], size[j]))

        for i in range(count - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else count
            if not alive[i] or j >= count or size[i] != a or size[j] != b:
                continue
            size[i] += size[j]
            alive[j] = False
            after[i] = after[j]
            if after[j] < count:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [self.ids[SPACE_MARK * size[i]] for i in range(count) if alive[i]]

    def segment(self, text: str) -> list[int]:
        """Pieces of a run of space marks and the word after it."""
        word = text.lstrip(SPACE_MARK)
        gap = len(text) - len(word)
        if not word:
            return self.spaces(gap)
        if not gap:
            return self.word(word)
        out = self.word(SPACE_MARK + word)
        if gap > 1:
            # marks merge with one another after all else, so only what the word left over joins
            own = out[0] == self.ids[SPACE_MARK]
            out = self.spaces(gap - 1 + own) + out[own:]
        return out

    def segments(self, text: str) -> list[str]:
        """A text with its spaces marked, cut where pieces never reach over: before spaces and around line ends.

        A line end is a segment of its own only if the model has no piece with one.
        """
        if not text:
            return []
        return self._segments.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))

    def encode(self, text: str) -> list[int]:
        return [i for s in self.segments(text) for i in self.segment(s)]

    def surface(self, ids: list[int]) -> str:
        """The text of ids as pieces say it."""
        out, pending = [], bytearray()
        kinds, pieces = self.kinds, self.pieces
        for i in ids:
            if kinds[i] == BYTE:
                pending.append(int(pieces[i][3:5], 16))
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending = bytearray()
            if kinds[i] == UNKNOWN:
                out.append(" ⁇ ")
            elif kinds[i] != CONTROL:
                out.append(pieces[i])
        if pending:
            out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        return self.surface(ids).removeprefix(SPACE_MARK).replace(SPACE_MARK, " ")

    def digests(self, text: str) -> tuple[int, str, str, str]:
        """Number of ids, digest of the ids, digest of the text that they decode to, and the ids joined by commas.

        The pieces of a segment never depend on its neighbours, and byte pieces of one
        character never part at a segment's end, so both ways go segment by segment.
        """
        known = self.known
        known.changed.clear()
        segments = self.segments(text)
        ids = ",".join(map(known.__getitem__, segments))
        changed = known.changed
        said = "".join([changed.get(s, s) for s in segments] if changed else segments)
        decoded = said.removeprefix(SPACE_MARK).replace(SPACE_MARK, " ")
        return ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), ids


class Remembered(dict):
    """The ids of recent segments, joined by commas; a segment that isn't known is encoded and decoded.

    Two generations: when the younger is full it takes the place of the older, and what is
    asked for again comes back from there. Segments that decode to something else than
    themselves are never kept, but noted in `changed` each time.
    """

    def __init__(self, pieces: MergePieces):
        super().__init__()
        self.pieces, self.older, self.changed = pieces, {}, {}

    def __missing__(self, segment: str) -> str:
        got = self.older.get(segment)
        if got is None:
            ids = self.pieces.segment(segment)
            got = ",".join(map(str, ids))
            if "".join([self.pieces.plain[i] for i in ids]) != segment:
                said = self.pieces.surface(ids)
                if said != segment:
                    self.changed[segment] = said
                    return got
        if len(segment) < 64:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[segment] = got
        return got


@lru_cache(maxsize=2)
def load_pieces(path: str) -> MergePieces:
    """The model at `path`; each worker reads its own copy of the installed vocabulary once."""
    with open(path, "rb") as f:
        return MergePieces(f.read())


def encode_texts(docs: DataFrame, model_path: str, ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, and with `ids` the ids too.

    Rows stay where they are: nothing is shuffled, and long texts pass whole. Null text is
    empty: no ids, and both digests are of the empty string. Repeated rows repeat; an empty
    table gives none; other columns are left out.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(frames):
        pieces = load_pieces(model_path)
        for frame in batches(frames, 500):
            got = pd.DataFrame([pieces.digests(t) for t in frame["text"]], columns=["n_tokens", "ids_sha256", "decoded_sha256", "ids"])
            got.insert(0, "doc_id", frame["doc_id"].to_numpy())
            if ids:
                got["ids"] = [[int(i) for i in x.split(",")] if x else [] for x in got["ids"]]
            yield got if ids else got.drop(columns="ids")

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(run, schema)


def decode_ids(rows: DataFrame, model_path: str, column: str = "ids") -> DataFrame:
    """`rows` with the text that `column` (array of ids) decodes to, as column decoded; null ids give null."""

    @F.pandas_udf("string")
    def decoded(ids: pd.Series) -> pd.Series:
        pieces = load_pieces(model_path)
        return ids.map(lambda x: None if x is None else pieces.decode([int(i) for i in x]))

    return rows.withColumn("decoded", decoded(F.col(column)))
