import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from noticelens.llm import spelling
from helpers import ODD, docs_frame

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows, misspelt=spelling.MISSPELT):
    total = Counter()
    for doc, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for word in re.findall("[a-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % misspelt == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:n] + long[n + 1 :] == short for n in range(len(long)))


def brute(words):
    near = {w: [x for x in words if is_near(w, x)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None


def texts():
    rng = random.Random(11)
    stems = ["".join(rng.choices("abceéÿ", k=rng.randrange(4, 9))) for _ in range(60)]
    pool = []
    for n, stem in enumerate(stems):
        pool += [stem] * (1 + n % 7)
        for _ in range(3):
            k = rng.randrange(len(stem) + 1)
            pool.append(stem[:k] + rng.choice(["", "a", "é"]) + stem[k + rng.randrange(2) :])
    rows = [(n, " ".join(rng.choices(pool, k=40)).title()) for n in range(120)]
    # A chain of forms, ties, a word very many others are near to, one long word.
    rows += [(200, "aaaaab " * 100 + "aaaabb " * 40 + "aaabbb " * 20 + "aabbbb " * 9 + "abbbbb " * 3)]
    rows += [(201, "tiesza tieszb tieszc " * 8 + "tiesz " * 3), (202, ("x" * 3_000 + " ") * 3), (202, "ÀÈ×÷ß " * 4)]
    return rows + ODD + [(7, "repeated rows repeated rows")] * 2


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.mark.parametrize("block", [spelling.BLOCK, 300])
def test_equals_brute_force(spark, rows, block):
    words = spelling.vocabulary(docs_frame(spark, rows))
    found = spelling.variants(words, block=block)
    assert found.columns == COLUMNS
    got = [tuple(r) for r in found.collect()]
    want = sorted(brute(counted(rows)), key=lambda r: r[0])
    assert sorted(got, key=lambda r: r[0]) == want
    assert any(r[1] != r[2] and r[1] for r in want) and len(want) > 100


def test_misspelt_words_follow_the_hash(spark, rows):
    got = {r.word: r.n for r in spelling.vocabulary(docs_frame(spark, rows), misspelt=3).collect()}
    assert got == counted(rows, misspelt=3)


def test_an_empty_table(spark):
    words = spelling.vocabulary(docs_frame(spark, [(1, "x")]).limit(0))
    assert spelling.variants(words).collect() == []


def test_parts_of_long_texts_cut_no_word(monkeypatch):
    monkeypatch.setattr(spelling, "PART", 10)
    text = "abcdefghijklmnop qrs tuv, wxyz" * 20
    parts = list(spelling._parts(text))
    assert "".join(parts) == text and len(parts) > 10
    assert [w for p in parts for w in re.findall("[a-z]+", p)] == re.findall("[a-z]+", text)


def test_index_follows_both_directions():
    """Either index's interval counts the places of the pattern, whatever the order of steps."""
    words = sorted({"".join(random.Random(n).choices("abc", k=5)) for n in range(60)})
    index, text = spelling.BiIndex(words), "#" + "#".join(words) + "#"
    for pattern, middle in (("abc", 1), ("#ab", 2), ("ca#", 0), ("bbb", 1)):
        codes = [0 if c == "#" else int(index.code[ord(c)]) for c in pattern]
        state = tuple(np.array([x]) for x in (0, 0, len(index.order)))
        for c in reversed(codes[:middle]):
            state = index.to_left(*state, np.array([c]))
        for c in codes[middle:]:
            state = index.to_right(*state, np.array([c]))
        places = sorted(index.order[state[0][0] : state[0][0] + state[2][0]])
        assert places == [m.start() for m in re.finditer(f"(?={pattern})", text)]


def test_every_single_error_is_found():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abé", k=rng.randrange(5, 9))) for _ in range(300)})
    index, back = spelling.BiIndex(words), spelling.BiIndex([w[::-1] for w in words])
    found = {*index.near(words, [len(w) // 2 for w in words])}
    found |= {*back.near([w[::-1] for w in words], [len(w) - len(w) // 2 for w in words])}
    want = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if is_near(a, b)}
    assert {(i, j) for i, j in found if i != j} == want


def test_no_table_of_words_is_broadcast_by_the_size_of_its_file(spark):
    words = spark.createDataFrame([("aaaaa", 9), ("aaaab", 3), ("other", 5)], "word string, n long")
    found = spelling.variants(words)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.word: r.root for r in found.collect()} == {"aaaaa": "aaaaa", "aaaab": "aaaaa", "other": "other"}
