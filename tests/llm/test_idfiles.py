import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import LONG, ODD, docs_frame, prose
from tokenizers import Tokenizer

from noticelens.llm import idfiles

TEXTS = [
    "", " ", "  ", "\n", "a\0b", " lead", "trail ", "日本語  mixed", "don't it's 'S 's", "a <|endoftext|> b<|endoftext|>",
    "a\x1c b\x85 c  d 　e", "    def foo():\n        return   1\n\n", "\r\n\r\n",
]


def random_texts(n):
    rng = random.Random(4)
    letters = "the and  \n'sabcdeéüñ日本0123456789.,()=_-*#/\t\"'<>{};:\x1c\x85  ᠎​"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def source():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        return file.read()


def ids_of(source, text):
    return Tokenizer.from_str(source).encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(source, monkeypatch):
    texts = [*TEXTS, *random_texts(3000), prose(1, 500)]
    want = [e.ids for e in Tokenizer.from_str(source).encode_batch(texts, add_special_tokens=False)]
    got = idfiles.TextEncoder(source).encode(texts)
    assert [np.frombuffer(g, dtype=np.uint32).tolist() for g in got] == want
    monkeypatch.setattr(idfiles, "SEGMENTS", 30)
    monkeypatch.setattr(idfiles, "CALL", 40)
    got = idfiles.TextEncoder(source).encode(texts)
    assert [np.frombuffer(g, dtype=np.uint32).tolist() for g in got] == want


def test_ids_of_mixed_texts_in_their_order(source, monkeypatch):
    rng = random.Random(7)
    parts = ["a", "b\nc", "\nd", "e\n", "'s", "it's", "<|x", "<|endoftext|>", "Ж", "é×", "12ab", "-", "\n", "x" * 200]
    texts = [rng.choice(["", " ", "\n", "  "]) + rng.choice([" ", "  ", " \n", "\n "]).join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(2000)]
    texts += [" ".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(2000)]
    rng.shuffle(texts)
    want = [e.ids for e in Tokenizer.from_str(source).encode_batch(texts, add_special_tokens=False)]
    for call in (idfiles.CALL, 500):
        monkeypatch.setattr(idfiles, "CALL", call)
        got = idfiles.TextEncoder(source).encode(texts)
        assert [np.frombuffer(g, dtype=np.uint32).tolist() for g in got] == want


def test_python_is_called_for_new_words_only(source):
    """Neither for each part between spaces nor for each distinct one of them."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopé", k=6)) for _ in range(200)]
    parts = list({f"{rng.choice(words)}-{rng.choice(words)}" for _ in range(30_000)})
    texts = [" ".join(rng.sample(parts, 500)) for _ in range(200)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    encoder = idfiles.TextEncoder(source)
    sys.setprofile(count)
    try:
        found = list(encoder.encode(texts))
    finally:
        sys.setprofile(None)
    assert len(found) == 200 and len(parts) > 15_000
    assert calls < 0.5 * len(parts)


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_coding_round_trip(n):
    rng = np.random.default_rng(n)
    ranks = rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)
    control, data = idfiles.pack(ranks)
    assert len(control) == -(-n // 4)
    assert len(data) == sum(max(1, -(-int(r).bit_length() // 8)) for r in ranks)
    assert (idfiles.unpack(control, data, n) == ranks).all()


def test_files(spark, source, tmp_path, monkeypatch):
    monkeypatch.setattr(idfiles, "SHARD_BYTES", 4_000)
    monkeypatch.setattr(idfiles, "BLOCK_IDS", 300)
    rows = [r for r in ODD if r[1] is not LONG]
    rows += [(1000 - n, t) for n, t in enumerate([*TEXTS, *random_texts(60)])]
    rows += [(60, "same row"), (60, "same row"), (2000, prose(3, 3000))]
    path = str(tmp_path / "ids")
    idfiles.write_ids(docs_frame(spark, rows), path, source)
    got = [tuple(r) for r in idfiles.read_ids(spark, path).collect()]
    at, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*ids_of(source, t or ""), 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert len(list((tmp_path / "ids" / "ids").glob("shard=*"))) > 2
    # One byte an id where ids are common: the files are smaller than two bytes an id.
    data = b"".join(p.read_bytes() for p in (tmp_path / "ids" / "ids").glob("*/*.txt"))
    assert data[:4] == b"FRQ1" and len(data) < 2.2 * at + 16 * len(rows) + 2000


def test_empty_table(spark, source, tmp_path):
    path = str(tmp_path / "none")
    idfiles.write_ids(docs_frame(spark, [(1, "x")]).limit(0), path, source)
    assert idfiles.read_ids(spark, path).count() == 0


def test_starts_over_many_shards(spark):
    rows = [(s, b, 10 * s + b) for s in (0, 1, 1023, 1024, 1025, 5000) for b in range(3)]
    df = spark.createDataFrame(rows, "shard int, block int, n long")
    got = {r.shard: r.start for r in idfiles._shard_starts(df).collect()}
    assert got == {s: sum(n for t, _, n in rows if t < s) for s in {r[0] for r in rows}}
