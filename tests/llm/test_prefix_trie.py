import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from noticelens.llm import prefix_trie
from helpers import CLASH, CLASHING

NAMES = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(own) - 1) * len(p[-1][1].encode()) if p else 0
    rows = set()
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p))
        rows.add((
            min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return rows


def frame(spark, rows):
    data = [(*row, *CLASH) for row in rows]
    names = CLASHING.replace("id string", "key string")
    return spark.createDataFrame(data, f"conv_id long, turn long, role string, text string, {names}")


def result(spark, rows, block):
    found = prefix_trie.trie(prefix_trie.branched(frame(spark, rows)), block=block)
    assert found.columns == NAMES
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for c in range(160):
        first = "the same first turn" if c % 3 else f"own {c}"
        turns = [("user", first)] + [(rng.choice(["user", "assistant"]), rng.choice("abc") * 3 + "é") for _ in range(rng.randrange(9))]
        out += [(c, n, *t) for n, t in enumerate(turns)]
    # Copies of one conversation, long ones that share most, and odd rows.
    out += [(c, n, "user", f"copy {n}") for c in range(200, 280) for n in range(3)]
    out += [(c, n, "user", f"long {n}" if n < 150 + c else f"{c} {n}") for c in (300, 305, 310) for n in range(500)]
    out += [(400, None, "user", "null turn"), (400, 1, None, None), (400, 1, "", ""), (400, 1, "user", "tie")]
    out += [(401, 0, "user", "again"), (401, 0, "user", "again"), (None, 0, "user", "nobody's"), (-7, 0, "", "negative")]
    out += [(c, 0, "user", "short, gone where its family has no head") for c in (411, 412, 413, 414, 421, 422, 423)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [prefix_trie.BLOCK, 60, 7])
def test_equals_brute_force(spark, rows, block):
    convs = rebuilt([r for r in rows if r[0] != -7])
    got = result(spark, [r for r in rows if r[0] != -7], block)
    assert any(not turns for turns in convs.values())
    assert got == brute(convs)


def test_odd_ids_and_an_empty_table(spark):
    # The remainder of a negative id is Spark's: that of -7 by 5 is -2, its family -5.
    assert {(r[0], r[1]) for r in result(spark, [(-7, 0, "", "x"), (None, 0, "", "y")], 100)} >= {(-7, 0)}
    assert result(spark, [], 100) == set()


def test_searches_find_the_widest_intervals():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 17, 64, 100):
        lcp = rng.integers(0, 4, size)
        lcp[0] = 0
        home = np.repeat(np.arange(size), 4)
        depth = np.tile(np.arange(4), size)
        left, right = prefix_trie.extents(lcp, home, depth)
        for h, d, l, r in zip(home, depth, left, right):
            first = last = h
            while first > 0 and lcp[first] >= d:
                first -= 1
            while last + 1 < size and lcp[last + 1] >= d:
                last += 1
            assert (l, r) == (first, last)


def test_long_lists_of_ids_are_cut(monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 60)
    ids = np.arange(10)
    pieces = list(prefix_trie._pieces(ids))
    assert len(pieces) == 4 and "".join(pieces) == ",".join(map(str, range(10)))
