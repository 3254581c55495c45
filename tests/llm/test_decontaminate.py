import duckdb
import pytest
from helpers import ODD, docs_frame, edited, prose
from pyspark.sql import functions as F

from noticelens.llm import decontaminate, sql


def by_sql(rows, items):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    for name, data in (("documents", rows), ("benchmark", items)):
        if data:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    return sorted(con.execute(sql.DECONTAMINATION).fetchall(), key=str)


@pytest.fixture(scope="module")
def case():
    items = [(n, prose(900 + n, 12 + 3 * n)) for n in range(8)]
    items += [(20, items[2][1]), (21, None), (22, ""), (23, "two words"), (24, "a b a b a b a b a b"), (25, None)]
    rows = [r for r in ODD if r[0] != 55]
    for n in range(8):
        text = items[n][1]
        rows.append((100 + n, prose(n, 30) + " " + text.upper() + "\n" + prose(50 + n, 20)))
        rows.append((200 + n, prose(n, 9) + "  " + edited(text, n, 1) + " tail"))
        rows.append((300 + n, edited(text, n, 3)))
        words = text.split()
        rows.append((400 + n, " ".join(words[: len(words) // 2])))
        rows.append((500 + n, " ".join(words[: -1])))
    rows += [(600, "x two words y"), (601, "b a b a b a b a b a b"), (602, "a b a b a"), (100, prose(3, 40))]
    return rows, items


def test_equals_all_windows(spark, case):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_frame(spark, rows)
    found = decontaminate.leaks(df, bench)
    got = decontaminate.judged(df, found).select("doc_id", "leaked", "n_items", "item_ids", "similarity")
    want = by_sql(rows, items)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert 16 < sum(w[1] for w in want) < len(want)
    kept = decontaminate.clean(df, found)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((w[0] for w in want if not w[1]), key=str)


def test_anchors_in_several_passes(spark, case, monkeypatch):
    rows, items = case
    monkeypatch.setattr(decontaminate, "ANCHORS", 10)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_frame(spark, rows)
    got = decontaminate.judged(df, decontaminate.leaks(df, bench)).filter("leaked").count()
    assert got == sum(w[1] for w in by_sql(rows, items))


def test_empty_tables(spark, case):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_frame(spark, rows)
    assert decontaminate.judged(df.limit(0), decontaminate.leaks(df.limit(0), bench)).count() == 0
    clean = decontaminate.judged(df, decontaminate.leaks(df, bench.limit(0)))
    assert clean.filter("leaked").count() == 0 and clean.count() == df.count()


def test_simhash_and_blocks(spark):
    hashes = [5, -3, 7, 5]
    df = spark.createDataFrame([(hashes,)], "h array<long>")
    got = df.select(decontaminate.simhash(F.col("h"))).first()[0] & (2**64 - 1)
    want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))
    assert got == want
    masks = [m & (2**64 - 1) for m in decontaminate._masks(26)]
    assert len(masks) == 27 and sum(masks) == 2**64 - 1


def test_no_python_in_the_plan(spark, case):
    rows, items = case
    df = docs_frame(spark, rows)
    words = df.select(decontaminate.words_of("text").alias("w")).filter("w is not null")
    plan = words.select(decontaminate.simhash(decontaminate.shingle_hashes(F.col("w"))))
    assert "Python" not in plan._jdf.queryExecution().toString()
