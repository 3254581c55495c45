import re
from itertools import combinations

import numpy as np
import pytest
from helpers import ODD, docs_frame, edited, prose

from noticelens.llm import minhash


def shingle_set(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    span = min(width, len(words))
    return frozenset(tuple(words[n : n + span]) for n in range(len(words) - span + 1))


def classes(rows, width):
    """Smallest linked id of every row with an id, by comparing all pairs."""
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    root = list(range(len(sets)))

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in combinations(range(len(sets)), 2):
        (i, x), (j, y) = sets[a], sets[b]
        if i is not None and j is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
            p, q = sorted((find(a), find(b)))
            root[q] = p
    least = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(
        ((i, len(s), least.get(find(n)) if i is not None else None) for n, (i, s) in enumerate(sets)),
        key=str,
    )


@pytest.fixture(scope="module")
def rows():
    base = prose(7, 120)
    out = [*ODD, (60, prose(1, 40)), (60, prose(1, 40)), (60, prose(2, 40)), (61, "ONE"), (62, "one")]
    out += [(100 + n, edited(base, n, n % 14)) for n in range(90)]
    out += [(300 + n, prose(n, 30) + " " + base[:200]) for n in range(20)]
    # A chain whose ends are far apart, and small groups.
    out += [(400 + n, " ".join(f"c{k}" for k in range(5 * n, 5 * n + 100))) for n in range(12)]
    out += [(500 + n, edited(prose(n // 3, 60), n, 1)) for n in range(30)]
    return out


@pytest.mark.parametrize("width,few", [(2, 64), (2, 3), (5, 3)])
def test_classes_equal_all_pairs(spark, rows, width, few, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", few)
    got = minhash.near_duplicates(docs_frame(spark, rows), width, 80).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == classes(rows, width)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)


def test_one_row_of_each_class_stays(spark, rows):
    df = docs_frame(spark, rows)
    kept = minhash.one_of_each(df, 2, 80)
    assert kept.columns == df.columns
    got = sorted((r.doc_id for r in kept.collect()), key=str)
    want = {i for i, _, c in classes(rows, 2) if i == c}
    assert set(got) == {None, *want}
    # Of the rows of id 60 two texts are there, one of them twice; ``want`` holds the null id.
    assert got.count(60) == 2 and len(got) == len(want) + 1


def test_empty_table(spark):
    df = docs_frame(spark, []).limit(0)
    assert minhash.near_duplicates(df).count() == 0
    assert minhash.one_of_each(df).count() == 0


def test_estimate_is_corrected_for_chance(spark):
    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.concatenate([common, rng.integers(0, 2**63, n).astype(np.uint64)]) for n in (100, 0, 600)]
    _, bits = minhash._sketches([np.unique(s) for s in sets], minhash._multipliers())
    df = spark.createDataFrame([(b.tolist(),) for b in bits], "bits array<long>").alias("a")
    pairs = df.crossJoin(df.alias("b")).select(minhash.estimate(*[__import__("pyspark").sql.functions.col(f"{x}.bits") for x in "ab"]))
    got = np.array([r[0] for r in pairs.collect()]).reshape(3, 3)
    assert got[0, 0] == 1 and abs(got[0, 1] - 0.8) < 0.15 and abs(got[1, 2] - 0.4) < 0.2


@pytest.fixture(scope="module")
def hot():
    """A large group of near copies, about half of them too far from the others."""
    base = prose(9, 150, 10_000)
    return [(n, edited(base, n, 2 + n % 14)) for n in range(160)]


@pytest.mark.parametrize("guests,asked", [(8_192, 16_384), (6, 9)])
def test_hot_bucket_in_tiles_equals_all_pairs(spark, hot, guests, asked, monkeypatch):
    monkeypatch.setattr(minhash, "FEW", 5)
    monkeypatch.setattr(minhash, "GUESTS", guests)
    monkeypatch.setattr(minhash, "ASKED", asked)
    got = minhash.near_duplicates(docs_frame(spark, hot), 2, 80).collect()
    want = classes(hot, 2)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert 1 < len({c for _, _, c in want}) < len(hot)


def test_no_bucket_is_in_one_tile_but_every_pair_meets_once(spark, monkeypatch):
    monkeypatch.setattr(minhash, "GUESTS", 20)
    monkeypatch.setattr(minhash, "ASKED", 40)
    # Buckets 1 and 2 share a largest class and most nodes; 3 has one of its own.
    rows = [(k, 7, n, 7 if n % 3 else n, 10) for k in (1, 2) for n in range(300)]
    rows += [(3, 999, n, 999 if n % 2 else n, 10) for n in range(1_000, 1_050)]
    df = spark.createDataFrame(rows, "key long, main long, node long, component long, core long")
    found = minhash._tiles(df).collect()
    tiles = {}
    for r in found:
        tiles.setdefault((r.main, r.unit, r.of_g, r.of_h), ([], []))[r.asks].append(r.node)
    assert max(len(asking) for _, asking in tiles.values()) < 60 and max(len(told) for told, _ in tiles.values()) < 120
    met = sorted((a, b) for told, asking in tiles.values() for a in asking for b in told)
    want = [(a, b) for k, first in ((300, 0), (50, 1_000)) for a in range(first, first + k) for b in range(first, first + k)]
    assert met == [(a, b) for a, b in want if (a % 3 == 0 if a < 1_000 else a % 2 == 0)]


def test_links_of_a_tile_join_classes_once():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**62, 100)
    # 0 to 4 are of the largest class, 5 to 8 near them, 9 and 10 near one another only.
    far = rng.integers(0, 2**62, 100)
    sets = [np.delete(far if n > 8 else base, n) for n in range(11)]
    _, bits = minhash._sketches([np.unique(s.astype(np.uint64)) for s in sets], minhash._multipliers())
    rows = [(0, 0, 0, 0, asks, n, 0 if n < 5 else n, len(s), b.tolist(), s.tolist()) for asks in (True, False) for n, (s, b) in enumerate(zip(sets, bits)) if n > 4 or not asks]
    names = [*minhash._TILE, "asks", "node", "component", "n", "bits", "cores"]
    tile = minhash.pa.table({name: [r[k] for r in rows] for k, name in enumerate(names)})
    found = minhash._tile_links(tile, 80).to_pydict()
    pairs = set(zip(found["a"], found["b"]))
    # Five links join 5 to 8 to the largest class and 9 to 10.
    assert len(found["a"]) == 5 and (9, 10) in pairs
    near = {x for pair in pairs - {(9, 10)} for x in pair}
    assert {5, 6, 7, 8} <= near and near & {0, 1, 2, 3, 4} and not near & {9, 10}
