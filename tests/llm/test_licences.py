import random
import re

import pytest
from helpers import ODD, docs_frame

from noticelens.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def places(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found, labels = [], set()
    for phrase, label in licences.PHRASES.items():
        part = phrase.split()
        at = [n for n in range(len(words)) if words[n : n + len(part)] == part]
        found += at
        labels |= {label} if at else set()
    return len(words), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(labels))


def test_matching_statistics_equal_search():
    rng = random.Random(3)
    for _ in range(150):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 12))] for _ in range(3)]
        machine = licences.Automaton(sequences)
        text = [rng.randrange(4) for _ in range(15)]

        def where(run):
            return sorted(
                (w, n + len(run) - 1)
                for w, s in enumerate(sequences)
                for n in range(len(s) - len(run) + 1)
                if s[n : n + len(run)] == run
            )

        longest = [
            max(k for k in range(end + 2) if k == 0 or where(text[end + 1 - k : end + 1])) for end in range(len(text))
        ]
        want = [
            (end - longest[end] + 1, longest[end])
            for end in range(len(text))
            if longest[end] >= 2 and (end == len(text) - 1 or longest[end + 1] <= longest[end])
        ]
        got = list(machine.matches(text, 0, 2))
        assert [(a, n) for a, n, _ in got] == want
        assert all(machine.places[state] == where(text[a : a + n]) for a, n, state in got)


def test_chain_equals_all_chains():
    rng = random.Random(8)

    def best(matches, gap):
        top = 0

        def go(score, text_end, place_end):
            nonlocal top
            top = max(top, score)
            for a, p, n in matches:
                over = max(text_end - a, place_end - p, 0)
                near = a <= text_end + gap and p <= place_end + gap
                if near and over < n and a + n > text_end and p + n > place_end:
                    go(score + n - over, a + n, p + n)

        for a, p, n in matches:
            go(n, a + n, p + n)
        return top

    for _ in range(200):
        matches = [(rng.randrange(12), rng.randrange(12), rng.randrange(1, 4)) for _ in range(5)]
        ordered = [m for m in sorted(matches)]
        got = licences.chain(ordered, 3)[0]
        # Chains go on in the order of their starts in the text.
        assert got <= best(ordered, 3) and got >= max(n for *_, n in matches)


@pytest.mark.parametrize("label,text", licences.TEMPLATES)
def test_templates_are_found_whole_and_worn(label, text):
    scanner = licences.Scanner()
    whole = scanner.scan(f"some words before. {text.upper()} and after")
    assert label in whole[5].split(",") and whole[6] == 1.0
    words = text.split()
    if len(words) > 30:
        for n in range(10, len(words), 25):
            words[n] = "changed"
        worn = scanner.scan(" ".join(words))
        assert label in worn[5].split(",") and worn[6] > 0.6


def test_ordinary_text_has_no_label():
    text = "the license of the software is in the city and the notice was to be found without any doubt " * 20
    assert licences.Scanner().scan(text)[4:6] == ("", "")


def test_frame(spark):
    rows = [*ODD, (60, "MIT License, mit license; Apache--License"), (61, "mitlicense mit_license mit licenseé")]
    rows += [(62, "see the GNU General\nPublic\nLicense"), (62, "see the GNU General\nPublic\nLicense")]
    df = docs_frame(spark, rows)
    got = licences.scan(df)
    found = sorted(
        ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got.collect()), key=str
    )
    assert found == sorted(((i, *places(t)) for i, t in rows), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got.collect())
    assert licences.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("between", ["", "and then quite other words " * 9])
@pytest.mark.parametrize("label,text", [t for t in licences.TEMPLATES if len(t[1].split()) > 30])
def test_every_copy_has_its_span(label, text, between):
    scanner = licences.Scanner()
    words = text.split()
    worn = " ".join([*words[: len(words) // 2], "changed", *words[len(words) // 2 + 1 :]])
    one = f"{text} {between} "
    found = [s.split(":") for s in scanner.scan(f"start {one}{worn} {between} {text} end")[7].split(",")]
    mine = [(int(a), int(b)) for name, a, b in found if name == label]
    size, gap = len(licences.words_of(text, scanner.table)), len(between.split())
    for copy in range(3):
        begin = 1 + copy * (size + gap)
        assert any(abs(a - begin) <= 2 and abs(b - begin - size) <= 2 for a, b in mine), (copy, mine)
    assert scanner.scan(one)[4:7] == scanner.scan(one * 3)[4:7]


def test_copies_do_not_overlap_and_end_soon():
    rng = random.Random(3)
    for _ in range(300):
        matches = [(rng.randrange(60), rng.randrange(12), rng.randrange(2, 9)) for _ in range(15)]
        got = licences.chains(matches, 3, 2, 5)
        assert all(a[2] <= b[1] for a, b in zip(got, got[1:]))
        best = licences.chain(matches, 3)
        assert not got and best[0] < 5 or max(got, key=lambda c: c[0])[0] == best[0]
    label, text = licences.TEMPLATES[0]
    spans = licences.Scanner().scan(f"{text} " * 3000)[7].split(",")
    assert sum(s.startswith(f"{label}:") for s in spans) >= 3000
