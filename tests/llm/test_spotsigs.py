import hashlib
import re

import pytest
from pyspark.sql import functions as F

from noticelens.llm import spotsigs
from helpers import ODD, docs_frame, prose

COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def signatures(text):
    words = re.findall(r"[^\W_]+", text.lower())
    content = [n for n, w in enumerate(words) if w not in spotsigs.ANCHORS]
    full = range(len(content) - spotsigs.CHAIN + 1)
    spots = [k for k in full if content[k] > 0 and words[content[k] - 1] in spotsigs.ANCHORS]
    chains = [" ".join(words[n] for n in content[k : k + spotsigs.CHAIN]) for k in spots or full]
    chains = chains or ([text] if text else [])
    return {hashlib.md5(c.encode()).hexdigest()[:8] for c in chains}


def likeness(a, b):
    if not a and not b:
        return 1.0
    if min(len(a), len(b)) * spotsigs.LEAST < max(len(a), len(b)):
        return 0.0
    return len(a & b) / len(a | b)


def brute(rows):
    """Rows have distinct ids, or equal ids with equal texts."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        a, e, b = signatures(text), signatures(edited), signatures(following)
        yield (
            i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(a)), "".join(sorted(e)),
            likeness(a, e), likeness(a, b),
        )


def texts():
    common = " ".join(spotsigs.ANCHORS[:12]).split()
    mixed = [" ".join(w if n % 3 else common[n % 12] for n, w in enumerate(prose(s, 60 + s).split())) for s in range(20)]
    out = list(enumerate(mixed)) + ODD
    out += [(60, "the and of"), (61, "The; quick, BROWN fox and the lazy dogs_all day"), (62, "одно два три четыре пять")]
    out += [(63, "a b"), (64, "日本語の文"), (65, "x" * 3), (66, "··· ---"), (67, mixed[3]), (68, mixed[3])]
    # A repeated row, and one id of very many rows.
    return out + [(70, mixed[5])] * 2 + [(80, mixed[6])] * 200


@pytest.mark.parametrize("range_bytes", [spotsigs.RANGE, 2_000])
def test_equals_brute_force(spark, range_bytes):
    rows = texts()
    found = spotsigs.report(docs_frame(spark, rows), range_bytes=range_bytes)
    assert found.columns == COLUMNS
    got = sorted((tuple(r) for r in found.collect()), key=repr)
    assert got == sorted(brute(rows), key=repr)


def test_empty_and_single_tables(spark):
    assert spotsigs.report(docs_frame(spark, [(1, "x")]).limit(0)).count() == 0
    (only,) = spotsigs.report(docs_frame(spark, [(1, "one and only text of all these words")])).collect()
    assert only.near_next == 1.0


def test_fingerprints_hold_their_sets(spark):
    df = spotsigs.with_signatures(docs_frame(spark, texts()).fillna(""), "text", "set")
    back = df.select("set", spotsigs.signatures_of(spotsigs.fingerprint(F.col("set"))).alias("back"))
    assert back.filter("set != back").count() == 0


def test_pruning_by_length_loses_nothing(spark):
    """A pair that is not compared is less alike than one in LEAST."""
    pairs = spark.range(1, 400).crossJoin(spark.range(1, 400).withColumnRenamed("id", "other"))
    far = spotsigs.length_band(F.greatest("id", "other")) - spotsigs.length_band(F.least("id", "other")) > 1
    assert pairs.filter(far & (F.least("id", "other") * spotsigs.LEAST >= F.greatest("id", "other"))).count() == 0


def test_no_python_on_the_rows(spark):
    plan = spotsigs.report(docs_frame(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|MapIn", plan)
    # Ranges are written bucketed: windows and ends need no shuffle of the texts.
    assert "Bucketed: true" in plan
