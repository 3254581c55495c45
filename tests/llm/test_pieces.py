import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD, docs_frame, prose
from sentencepiece import SentencePieceProcessor

from noticelens.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "\n", "a\0b", "\0", " lead", "trail ", "tab\there", "日本語テキスト mixed  ", "x" * 300,
    "\U0001f600 \U0001f469‍\U0001f469‍\U0001f467", "    def foo():\n        return   1\n\n", "=-" * 90,
    "İstanbul ǅ ſ", "a" + " " * 40 + "b", "....!!!!", "\r\n\r\n", "▁x ▁",
]


def random_texts(n):
    rng = random.Random(5)
    letters = "the and  \n▁abcdeéüñ日本0123456789.,()=_-*#/\t\"'<>{};:"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(PATH)


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def test_ids_equal_the_library(model, library):
    texts = [*TEXTS, *random_texts(1500), prose(1, 2000)]
    got = [ids.tolist() for ids in pieces.Encoder(model).encode(texts)]
    assert got == library.encode(texts)


def test_bounded_memory_gives_the_same(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "SEGMENTS", 20)
    monkeypatch.setattr(pieces, "INDEXED", 50)
    monkeypatch.setattr(pieces, "WAITING", 100)
    monkeypatch.setattr(pieces, "SLOTS", 64)
    texts = random_texts(200)
    assert [i.tolist() for i in pieces.Encoder(model).encode(texts)] == library.encode(texts)


def test_index_finds_all_occurrences(model):
    index = pieces.Encoder(model).index
    text = "▁the▁theatre\0▁日本the"
    points = np.array([ord(c) for c in text])
    start, piece = index.occurrences(points)
    found, _ = index.words.reachable
    want = {(n, p) for p in found for n in range(len(text)) if text.startswith(p, n)}
    assert {(s, found[p]) for s, p in zip(start.tolist(), piece.tolist())} == want


def test_pair_rule_with_scores_out_of_order():
    """A longer piece may be worth more than its parts; the rule holds all the same."""
    words = pieces.Vocabulary.__new__(pieces.Vocabulary)
    rng = random.Random(2)
    for _ in range(200):
        merged = {"".join(rng.choice("ab") for _ in range(rng.randint(2, 4))) for _ in range(6)}
        words.scores = {p: rng.random() for p in merged}
        for _ in range(20):
            text = "".join(rng.choice("ab") for _ in range(9))
            last = [""]
            for end in range(1, len(text) + 1):
                fits = []
                for start in range(end):
                    piece = text[start:end]
                    left = last[start]
                    if words.merges(piece)[0] == [piece] and (not left or words.merges(left + piece)[0] == [left, piece]):
                        fits.append(piece)
                assert len(fits) == 1
                last.append(fits[0])
            out, end = [], len(text)
            while end:
                out.append(last[end])
                end -= len(last[end])
            assert out[::-1] == words.merges(text)[0]


def test_pairs_equal_merging_their_text():
    """The merges of both pieces, played together, tell what merging the whole text gives."""
    rng = random.Random(4)
    for _ in range(60):
        words = pieces.Vocabulary.__new__(pieces.Vocabulary)
        made = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(14)} | {"a", "b"}
        words.pieces = sorted(made)
        words.ids = {p: n for n, p in enumerate(words.pieces)}
        words.scores = {p: rng.choice([rng.random(), 0.5]) for p in words.pieces}
        found, ids = words.reachable
        left, right = (x.ravel() for x in np.meshgrid(ids, ids, indexing="ij"))
        want = [words.merges(words.pieces[x] + words.pieces[y])[0] == [words.pieces[x], words.pieces[y]] for x, y in zip(left, right)]
        pairs = pieces.Pairs(words)
        for _ in range(2):
            assert pairs.stand(left, right).tolist() == want
        outside = np.full(1, len(words.pieces) + ord("c"))
        assert pairs.stand(outside, ids[:1]).all()


def test_frames(spark, model, library):
    rows = [*ODD, *enumerate(TEXTS, 100), (60, "twice"), (60, "twice")]
    df = docs_frame(spark, rows)
    encoded = pieces.encode(df, model)
    got = sorted(((r.doc_id, r.pieces) for r in encoded.collect()), key=str)
    assert got == sorted(((i, library.encode(t or "")) for i, t in rows), key=str)
    back = sorted((str((r.doc_id, r.text)) for r in pieces.decode(encoded, model).collect()))
    assert back == sorted(str((i, (t or "").replace("▁", " "))) for i, t in rows)
    digest = {r.doc_id: r for r in pieces.round_trip(df, model).collect()}
    want = np.array(library.encode(prose(1, 5)), dtype="<i4")
    one = pieces.round_trip(docs_frame(spark, [(1, prose(1, 5))]), model).first()
    assert (one.n_pieces, one.pieces_crc32) == (len(want), zlib.crc32(want.tobytes()))
    assert one.text_crc32 == zlib.crc32(prose(1, 5).encode()) and digest[50].n_pieces == 0
    assert pieces.encode(df.limit(0), model).count() == 0


def test_decoding_odd_ids(spark, model):
    df = spark.createDataFrame([(1, None), (2, []), (3, [-1, 10**6, 3 + 0xFF])], "doc_id long, pieces array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(df, model).collect()} == {1: None, 2: "", 3: "�"}


def test_other_models_are_refused():
    with pytest.raises(Exception):
        pieces.Vocabulary(b"not a model")
