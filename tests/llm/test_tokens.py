import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from aeroskein.llm.sentencepiece_bpe import decode_ids, encode_texts, load_pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a  b ", "\n", "\t\t", "▁x y", "<s>hi</s><unk><0x41>", "é日本　語", "😀 x😀", "\x00", "ﬁ", "a" * 3000, " " * 500, "日" * 50, "á", "​", "...", "l" * 101]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_odd_and_random_texts(library):
    rnd = random.Random(5)
    pieces = load_pieces(PATH)
    alphabet = "abeth ▁\n\t<0x41>ñé日本😀 .,=-_01"
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 50))) for _ in range(3000)]
    for t in texts:
        ids = library.encode(t)
        assert pieces.encode(t) == ids, t
        assert pieces.decode(ids) == library.decode(ids), t


def test_table(spark, library, docs_of):
    texts = [*ODD, None]
    docs = docs_of(list(enumerate(texts)) + [(0, "")])
    got = encode_texts(docs, PATH)
    for r in got.collect():
        ids = library.encode(texts[r["doc_id"]] or "")
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert got.count() == len(texts) + 1 and encode_texts(docs.limit(0), PATH).count() == 0
    back = {r["doc_id"]: r["decoded"] for r in decode_ids(got, PATH).collect()}
    assert all(back[i] == library.decode(library.encode(t or "")) for i, t in enumerate(texts))


def test_documents(spark, library, small):
    from aeroskein.llm.queries import op4_sentencepiece

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    for r in op4_sentencepiece(spark, small).collect():
        ids = library.encode(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_pairs_part_as_merging_parts_them():
    """The walk along two ends says the same as merging all characters anew."""
    pieces = load_pieces(PATH)
    rnd = random.Random(7)
    normal = [i for i in pieces.ids.values() if "▁" not in pieces.pieces[i]]
    short = [i for i in normal if len(pieces.pieces[i]) <= 3]
    for _ in range(20_000):
        a, b = rnd.choice(normal), rnd.choice(rnd.choice((normal, short)))
        x, y = pieces.pieces[a], pieces.pieces[b]
        assert pieces.compatible(a, b) == (pieces.merged(x + y)[0] == [x, y]), (x, y)


def test_small_memory_changes_nothing(library, monkeypatch):
    from aeroskein.llm import sentencepiece_bpe as S

    monkeypatch.setattr(S, "REMEMBERED", 3)
    monkeypatch.setattr(S, "REMEMBERED_PAIRS", 5)
    with open(PATH, "rb") as f:
        pieces = S.MergePieces(f.read())
    for t in ["the house of the old house", "a\nb\n\n c \x00 é the", "ü" * 70, *ODD] * 2:
        ids = library.encode(t)
        n, first, second, joined = pieces.digests(t)
        assert (n, joined) == (len(ids), ",".join(map(str, ids)))
        assert second == hashlib.sha256(library.decode(ids).encode()).hexdigest()
