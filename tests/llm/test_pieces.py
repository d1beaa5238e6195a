"""Piece encoding and decoding against the library, on odd and long texts."""

from __future__ import annotations

import hashlib
import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import documents, no_documents, texts

from feedkit.llm import pieces
from feedkit.llm.queries import piece_file


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file())


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(piece_file())


def agree(model, library, some, limit=1000):
    encoder = pieces.PieceEncoder(model, limit)
    ids, counts = encoder.encode(some)
    own = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if some else []
    for text, got, back in zip(some, own, pieces.decode(model, ids, counts), strict=True):
        want = library.encode(text)
        assert got == want, text[:200]
        assert back == library.decode(want), text[:200]


def test_odd_texts(model, library):
    agree(model, library, ["", " ", "  a", "a  b ", "\n\n", "a▁b", "▁", "<s> x", "é\0\x01", "ﬁ ａ", " x", "\t", "é", "<0x0A>", "​", " " * 40 + "x   😀", "ab\U0010ffff"])
    agree(model, library, [f"{a}{' ' * k}{b}" for k in range(70) for a in ("", "x") for b in ("", "a", "😀")])


def test_random_texts_of_pieces_and_characters(model, library):
    choice = random.Random(3)
    names = [library.id_to_piece(i) for i in range(259, library.vocab_size())]
    short = ["a", "t", "h", "e", "i", "n", "g", " ", "  ", "▁", "o", "s", "r"]
    for some in (names, short):
        for _ in range(60):
            agree(model, library, ["".join(choice.choice(some) for _ in range(choice.randint(0, 50))) for _ in range(50)])


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80))
def test_any_text(text):
    import sentencepiece

    path = piece_file()
    model = pieces.encoder(path).model
    agree(model, sentencepiece.SentencePieceProcessor(model_file=path), [text])


def test_decoding_any_ids(model, library):
    choice = random.Random(4)
    for _ in range(2000):
        ids = [choice.choice([choice.randint(0, 40), choice.randint(3, 258), choice.randint(0, 31999), 28705, 259, 1, 0]) for _ in range(choice.randint(0, 8))]
        assert pieces.decode(model, np.array(ids, np.int64), np.array([len(ids)]))[0] == library.decode(ids)


def test_rounds_equal_one_merge_at_a_time(model):
    """The vectorised rounds give what merging pair by pair gives, ties and interruptions included."""
    choice = random.Random(5)
    for _ in range(300):
        chars = [choice.choice("▁▁▁theniongas") for _ in range(choice.randint(1, 60))]
        symbols = model.char_ids[[ord(c) for c in chars]].astype(np.int64)
        got, _ = pieces.merge_rounds(model, symbols.copy(), np.zeros(len(symbols), np.int64))
        assert got.tolist() == pieces.one_by_one(model, symbols.tolist(), int(model.ranks[:-1].max()))


@pytest.mark.parametrize("make", [lambda n: " " * n, lambda n: "a" * n, lambda n: "the" * (n // 3), lambda n: "abc" * (n // 3), lambda n: "9x" * (n // 2), lambda n: "é" * n])
def test_long_words_take_proportional_time(model, library, make):
    agree(model, library, [make(20_000)])
    seconds = []
    for n in (100_000, 400_000):
        begin = time.process_time()
        pieces.PieceEncoder(model).encode([make(n)])
        seconds.append(time.process_time() - begin)
    assert seconds[1] < 8 * seconds[0] + 1


def test_query_on_odd_rows(spark, library):
    got = pieces.encode_texts(documents(spark), piece_file(), with_text=True).collect()
    want = sorted(((i, library.encode(t or "")) for i, t, _ in texts()), key=repr)
    assert sorted(((r["doc_id"], list(r["ids"])) for r in got), key=repr) == want
    assert sorted((repr(r["doc_id"]), r["decoded"]) for r in got) == sorted((repr(i), library.decode(x)) for i, x in want)
    again = pieces.decode_ids(pieces.encode_texts(documents(spark), piece_file()), piece_file()).collect()
    assert sorted(map(repr, again)) == sorted(repr(type(r)(doc_id=i, decoded=library.decode(x))) for r, (i, x) in zip(again, want))
    assert pieces.encode_texts(no_documents(spark), piece_file()).count() == 0


def test_registered_query(spark, library):
    from feedkit.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in QUERIES["op12_merge_rounds"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "")
        row = got[d["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
