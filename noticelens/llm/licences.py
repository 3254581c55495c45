"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds every run of tokens of every template. A text is streamed through it
once: at each token it knows the longest run that ends there and occurs in a template
(the matching statistics). Runs of at least ``LEAST`` tokens that cannot be prolonged
become matches; for each template the matches are chained in the order of both texts,
with at most ``GAP`` tokens between them, and the chain that covers most of the template
wins. A template covered to at least ``COVERED`` gives its label. Then what lies beside that
chain is chained again, so that every copy of a template in a text has its own span.

Apart from that, places where the words of a phrase stand consecutively are counted.
A-Z are lower-cased; words are runs of digits, a-z and characters beyond ASCII.

Defined cases: null and empty texts have no words, no labels and score 0; repeated rows
are scanned alike; other columns are not read; an empty table gives an empty result; of
chains that cover equally much the first one is taken.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.llm.common import strings, utf8

LEAST, GAP, COVERED = 4, 12, 0.6

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Published licence texts and notices.
TEMPLATES = [
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        'portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS "
        "FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See '
        "the License for the specific language governing permissions and limitations under the License.",
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see https://www.gnu.org/licenses/.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    (
        "cc-by",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
]


def _word_table() -> bytes:
    kept = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
    return bytes(b + 32 if 65 <= b <= 90 else b if b in kept else 32 for b in range(256))


def words_of(text: str, table: bytes) -> list[bytes]:
    return utf8(text).translate(table).split()


class Tokens(dict):
    """word -> number; words of no template are -1 and are not remembered."""

    def __missing__(self, word: bytes) -> int:
        return -1


class Automaton:
    """Suffix automaton of several token sequences, with the places of every state."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        places: list[list[tuple[int, int]]] = [[]]
        for which, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token, places)
                places[last].append((which, at))
        # A state has the places of all states whose suffix it is.
        for state in sorted(range(1, len(self.length)), key=lambda s: -self.length[s]):
            if self.link[state] > 0:
                places[self.link[state]].extend(places[state])
        self.places = [sorted(set(found)) for found in places]

    def _state(self, length: int, link: int, following: dict[int, int], places) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        places.append([])
        return len(self.length) - 1

    def _extend(self, last: int, token: int, places) -> int:
        """The state of the sequence read so far and one token more."""
        known = self.next[last].get(token)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, token, known, places)
        new = self._state(self.length[last] + 1, 0, {}, places)
        at = last
        while at >= 0 and token not in self.next[at]:
            self.next[at][token] = new
            at = self.link[at]
        if at >= 0:
            target = self.next[at][token]
            if self.length[target] != self.length[at] + 1:
                target = self._split(at, token, target, places)
            self.link[new] = target
        return new

    def _split(self, at: int, token: int, target: int, places) -> int:
        """Give the shorter runs of a state one of their own."""
        copy = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]), places)
        self.link[target] = copy
        while at >= 0 and self.next[at].get(token) == target:
            self.next[at][token] = copy
            at = self.link[at]
        return copy

    def matches(self, tokens: Iterable[int], offset: int, least: int) -> Iterator[tuple[int, int, int]]:
        """(start, length, state) of the runs of at least ``least`` tokens that cannot be
        prolonged to the right, in order of their ends."""
        state, length, at = 0, 0, offset
        following, link, longest = self.next, self.link, self.length
        for token in tokens:
            before = state, length
            while state and token not in following[state]:
                state = link[state]
                length = longest[state]
            target = following[state].get(token)
            if target is None:
                state, length = 0, 0
            else:
                state, length = target, length + 1
            if length <= before[1] and before[1] >= least:
                yield at - before[1], before[1], before[0]
            at += 1
        if length >= least:
            yield at - length, length, state


def chains_to(matches: list[tuple[int, int, int]], gap: int) -> Iterator[tuple[int, int, int]]:
    """(tokens, first, last) of the best chain up to each (start, place, length), in their order.

    Matches follow each other in the text and the template, ``gap`` tokens apart at most;
    one that overlaps the one before counts with what lies beyond it.
    """
    done: list[tuple[int, int, int, int, int]] = []
    first = 0
    for start, place, length in sorted(matches):
        covered, begin = length, start
        end, stop = start + length, place + length
        # Ends grow with starts up to the longest match, so old ones never come back.
        while first < len(done) and done[first][4] + gap < start:
            first += 1
        for score, origin, text_end, place_end, _ in done[first:]:
            if text_end + gap < start or place_end + gap < place:
                continue
            over = max(text_end - start, place_end - place, 0)
            if over < length and end > text_end and stop > place_end and score + length - over > covered:
                covered, begin = score + length - over, origin
        reach = max(end, done[-1][4]) if done else end
        done.append((covered, begin, end, stop, reach))
        yield covered, begin, end


def chain(matches: list[tuple[int, int, int]], gap: int) -> tuple[int, int, int]:
    """(tokens, first, last) of the chain that covers most, the first of equals."""
    return max(chains_to(matches, gap), key=lambda c: c[0], default=(0, 0, 0))


def chains(matches: list[tuple[int, int, int]], gap: int, least: int, enough: int) -> list[tuple[int, int, int]]:
    """Chains of at least ``enough`` tokens that do not overlap in the text, by their place.

    The best one is taken first; what it leaves of the matches, on either side, is chained
    anew. Chains that the ones taken do not touch stay the best of what is left, so they
    are taken in the same round, and many copies need few rounds.
    """
    taken, parts = [], [sorted(matches)]
    while parts:
        part = parts.pop()
        found = list(chains_to(part, gap))
        begins: list[int] = []
        ends: list[int] = []
        for n in sorted(range(len(found)), key=lambda n: -found[n][0]):
            tokens, begin, end = found[n]
            if tokens < enough:
                break
            at = bisect_left(begins, end)
            if not at or ends[at - 1] <= begin:
                begins.insert(at, begin)
                ends.insert(at, end)
                taken.append(found[n])
            else:
                start, _, length = part[n]
                around = bisect_right(begins, start) - 1
                if around < 0 or ends[around] < start + length:
                    break
        if begins:
            # Free places lie before, between and behind the chains.
            lows, highs = [0, *ends], [*begins, max(s + k for s, _, k in part)]
            free: list[list[tuple[int, int, int]]] = [[] for _ in lows]
            for start, place, length in part:
                at = bisect_right(highs, start)
                while at < len(lows) and lows[at] < start + length:
                    low, high = max(start, lows[at]), min(start + length, highs[at])
                    if high - low >= least:
                        free[at].append((low, place + low - start, high - low))
                    at += 1
            parts.extend(sorted(left) for left in free if left)
    return sorted(taken, key=lambda c: c[1])


class Scanner:
    """Templates and phrases made ready; small and the same for every task."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, least=LEAST, gap=GAP, covered=COVERED):
        self.table = _word_table()
        self.least, self.gap, self.covered = least, gap, covered
        self.labels = [label for label, _ in templates]
        self.tokens = Tokens()
        sequences = [self._numbers(text) for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        self.enough = [next((n for n in range(1, s + 1) if n / s >= covered), s + 1) for s in self.sizes]
        self.phrases = [(self._numbers(p), label) for p, label in phrases.items()]
        self.automaton = Automaton(sequences)

    def _numbers(self, text: str) -> list[int]:
        return [self.tokens.setdefault(w, len(self.tokens)) for w in words_of(text, self.table)]

    def scan(self, text: str) -> tuple:
        """(words, places, first, last, base labels, labels, score, spans) of one text."""
        words = words_of(text, self.table)
        tokens = np.fromiter(map(self.tokens.__getitem__, words), dtype=np.int64, count=len(words))
        places, base = [], set()
        for phrase, label in self.phrases:
            hit = np.ones(max(len(tokens) - len(phrase) + 1, 0), dtype=bool)
            for n, token in enumerate(phrase):
                hit &= tokens[n : n + len(hit)] == token
            found = np.nonzero(hit)[0]
            if len(found):
                base.add(label)
                places.append(found)
        spans = self._spans(tokens)
        score = max((share for _, _, _, share in spans), default=0.0)
        every = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        return (
            len(words),
            len(every),
            int(every.min()) if len(every) else None,
            int(every.max()) if len(every) else None,
            ",".join(sorted(base)),
            ",".join(sorted(base | {label for label, _, _, share in spans if share >= self.covered})),
            1.0 if len(every) else score,
            ",".join(f"{l}:{a}:{b}" for l, a, b, share in spans if share >= self.covered),
        )

    def _spans(self, tokens: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(label, start, end, covered share) of the best chain of each template that has one, and
        of all others that cover enough of it beside the better ones."""
        inside = np.concatenate([[False], tokens >= 0, [False]])
        edges = np.nonzero(inside[1:] != inside[:-1])[0].reshape(-1, 2)
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        # A long match lies in one run of known tokens.
        for a, b in edges[edges[:, 1] - edges[:, 0] >= self.least].tolist():
            for start, length, state in self.automaton.matches(tokens[a:b].tolist(), a, self.least):
                for which, end in self.automaton.places[state]:
                    by_template.setdefault(which, []).append((start, end - length + 1, length))
        spans = []
        for which in sorted(by_template):
            found, total = [chain(by_template[which], self.gap)], self.sizes[which]
            if found[0][0] >= self.enough[which]:
                found = chains(by_template[which], self.gap, self.least, self.enough[which])
            spans += [(self.labels[which], start, end, min(1.0, size / total)) for size, start, end in found]
        return spans


COLUMNS = (
    "n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, spans string"
)


def scan(
    docs: DataFrame, scanner: Scanner | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans)."""
    scanner = scanner or Scanner()
    types = (pa.int64(),) * 4 + (pa.string(), pa.string(), pa.float64(), pa.string())
    names = [column.split()[0] for column in COLUMNS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scanner.scan(text) for text in strings(batch.column(1))]
            columns = list(zip(*rows)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["id", *names],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, {COLUMNS}").withColumnRenamed("id", id_col)
