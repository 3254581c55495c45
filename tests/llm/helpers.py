"""Fixtures shared by the tests of the text operators."""

from __future__ import annotations

import random

# Names that operators use inside must not clash with a table's own columns.
CLASHING = "id string, n long, hash string, row string, score string, part long, kind string, _id long, value string"
CLASH = ("x", 1, "h", "r", "s", 2, "k", 3, "v")


def docs_frame(spark, rows):
    """(doc_id, text) rows with sources, lengths and columns of clashing names."""
    data = [(i, t, f"src{n % 3}", len(t or ""), *CLASH) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, f"doc_id long, text string, source string, n_chars long, {CLASHING}")


def prose(seed: int, n: int, vocabulary: int = 200) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, edits: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


LONG = "long " + "word " * 60_000 + "end"
ODD = [(None, "no id here at all"), (50, None), (51, ""), (52, " \n\t "), (53, "one"), (54, "É ß 日本 \U0001f600"), (55, LONG)]
