"""Books with versions, replies that outlive a run, batches that are played again."""

import pytest
from pyspark.sql import functions as F

from noticelens.operators.weaklabel import judge
from noticelens.sources.tables import read_sheet, write_book
from noticelens.streaming.scoring import read_batches, score_batches, write_batch


def sheet(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def values(df):
    return sorted(r.v for r in df.collect())


def test_a_failure_between_two_sheets_leaves_the_book(spark, tmp_path):
    book = str(tmp_path / "book")
    write_book({"A": sheet(spark, 1), "B": sheet(spark, 2)}, book)
    opened = read_sheet(spark, book, "A")
    bad = sheet(spark, 0).select(F.raise_error(F.lit("no")).cast("int").alias("v"))
    with pytest.raises(Exception, match="no"):
        write_book({"A": sheet(spark, 10), "B": bad}, book)
    assert values(read_sheet(spark, book, "A")) == [1] and values(read_sheet(spark, book, "B")) == [2]
    write_book({"B": sheet(spark, 20, 21)}, book)
    assert values(read_sheet(spark, book, "A")) == [1] and values(read_sheet(spark, book, "B")) == [20, 21]
    assert values(opened) == [1]


def test_plain_folders_are_books_and_missing_sheets_are_told(spark, tmp_path):
    sheet(spark, 5).write.parquet(f"{tmp_path}/plain/A")
    assert values(read_sheet(spark, f"{tmp_path}/plain", "A")) == [5]
    assert read_sheet(spark, f"{tmp_path}/plain", "C", sheet(spark, 0).schema, "empty").count() == 0
    write_book({}, f"{tmp_path}/plain")


def test_many_versions_are_told_by_number(spark, tmp_path):
    for n in range(12):
        write_book({"A": sheet(spark, n)}, str(tmp_path))
    assert values(read_sheet(spark, str(tmp_path), "A")) == [11]


PROMPTS = [(n, f"prompt {n % 40}", None) for n in range(100)] + [(200, None, "input error")]


def calls(folder):
    """Prompts asked so far; tasks leave a line each in files of their own."""
    return sorted(line for p in folder.glob("*") for line in p.read_text().splitlines())


def client_of(folder, broken=()):
    folder.mkdir(exist_ok=True)

    def factory():
        import os
        import uuid

        path = os.path.join(str(folder), uuid.uuid4().hex)

        def client(prompt):
            with open(path, "a") as file:
                file.write(prompt + "\n")
            if prompt in broken:
                raise RuntimeError("down")
            return '{"best_label": "%s", "reason": "r"}' % prompt

        return client

    return factory


def judged(df):
    return {r.id: r.predicted_label for r in df.collect()}


def test_each_prompt_is_asked_once_over_a_killed_and_a_resumed_run(spark, tmp_path):
    prompts = spark.createDataFrame(PROMPTS, "id int, prompt string, error_label string")
    asked, store = tmp_path / "asked", str(tmp_path / "store")
    half = prompts.filter("id % 40 < 20 or prompt is null")
    # The first run got no further than these prompts.
    judge(half, client_of(asked), store=store, wave=7).count()
    assert calls(asked) == sorted(f"prompt {n}" for n in range(20))
    want = {n: p if e is None else e for n, p, e in PROMPTS}
    assert judged(judge(prompts, client_of(asked), store=store, wave=7)) == want
    assert calls(asked) == sorted(f"prompt {n}" for n in range(40))
    assert judged(judge(prompts, client_of(asked), store=store)) == want
    assert len(calls(asked)) == 40


def test_a_run_that_dies_keeps_the_waves_before(spark, tmp_path):
    prompts = spark.createDataFrame(PROMPTS, "id int, prompt string, error_label string")
    asked, store = tmp_path / "asked", str(tmp_path / "store")

    make = client_of(asked)

    def dying():
        inner = make()

        def client(prompt):
            if prompt == "prompt 33":
                raise SystemExit("killed")
            return inner(prompt)

        return client

    judge(prompts.filter("id % 40 < 10"), dying, store=store, wave=4).count()
    with pytest.raises(Exception):
        judge(prompts, dying, store=store, wave=4).count()
    kept = {r.response.split('"')[3] for r in spark.read.parquet(store).collect()}
    before = calls(asked)
    judge(prompts, client_of(asked), store=store, wave=4).count()
    after = calls(asked)
    # What had been stored is not asked again; the rest of the dying wave may be.
    assert kept and kept < set(after) and len(set(after)) == 40
    assert all(after.count(p) == before.count(p) for p in kept)


def test_failing_prompts_are_tried_and_asked_again_by_the_next_run(spark, tmp_path):
    prompts = spark.createDataFrame(PROMPTS[:10], "id int, prompt string, error_label string")
    asked, store = tmp_path / "asked", str(tmp_path / "store")
    first = judged(judge(prompts, client_of(asked, broken=("prompt 3",)), store=store, attempts=3))
    assert first[3] == "classification error" and first[4] == "prompt 4"
    assert calls(asked).count("prompt 3") == 3
    assert judged(judge(prompts, client_of(asked), store=store))[3] == "prompt 3"
    assert calls(asked).count("prompt 4") == 1


def test_batches_keep_repeated_ids_and_replace_what_is_played_again(spark, tmp_path):
    arrived, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for n, ids in enumerate(([1, 2, 2], [2, 3], [4])):
        sheet(spark, *ids).coalesce(1).write.parquet(f"{arrived}/{n}")

    def run(checkpoint):
        stream = score_batches(spark, arrived, "v int", lambda df: df, out, str(tmp_path / checkpoint), max_files=1)
        stream.awaitTermination()

    run("one")
    found = read_batches(spark, out)
    assert values(found) == [1, 2, 2, 2, 3, 4] and found.select("batch").distinct().count() == 3
    # The same batch once more, as after a crash between its write and its commit.
    write_batch(sheet(spark, 2, 3), int(found.filter("v = 3").first().batch), out)
    assert values(read_batches(spark, out)) == [1, 2, 2, 2, 3, 4]
    # Going on from the checkpoint plays nothing again; a new file becomes one more batch.
    sheet(spark, 1).coalesce(1).write.parquet(f"{arrived}/3")
    run("one")
    assert values(read_batches(spark, out)) == [1, 1, 2, 2, 2, 3, 4]


def test_half_written_batches_are_not_read(spark, tmp_path):
    write_batch(sheet(spark, 1), 0, str(tmp_path))
    write_batch(sheet(spark, 2), 1, str(tmp_path))
    (tmp_path / "batch=1" / "_SUCCESS").unlink()
    assert values(read_batches(spark, str(tmp_path))) == [1]
    with pytest.raises(ValueError):
        read_batches(spark, str(tmp_path / "none"))
