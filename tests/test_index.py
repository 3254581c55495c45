import re

import numpy as np
import pytest

from noticelens.operators import index
from noticelens.operators.index import open_index, search_index, write_index
from noticelens.operators.vectors import knn
from noticelens.session import written

VECTORS = "id long, embedding array<double>, title string"


def frames(spark, vectors, queries):
    rows = [(n, None if v is None else [float(x) for x in v], f"title {n}") for n, v in enumerate(vectors)]
    asked = [(n, None if q is None else [float(x) for x in q]) for n, q in enumerate(queries)]
    return spark.createDataFrame(rows, VECTORS), spark.createDataFrame(asked, "query_id long, embedding array<double>")


def rows_of(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.distance, 6)) for r in df.collect())


@pytest.fixture(scope="module")
def clumped():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 5)) * 8
    vectors = centres[rng.integers(0, 12, 1_500)] + rng.normal(size=(1_500, 5)) * 0.3
    vectors[:500] = vectors[0]  # a third is one vector
    queries = np.concatenate([vectors[[0, 600, 700]], rng.normal(size=(5, 5)) * 8])
    return [*vectors, None], [*queries, None]


@pytest.mark.parametrize("cells,piece,block", [(16, 200_000, 1_024), (16, 60, 2), (1, 50, 3), (400, 10, 1_024)])
def test_equals_a_scan_of_all_rows(spark, clumped, tmp_path, cells, piece, block):
    rows, queries = frames(spark, *clumped)
    write_index(rows, str(tmp_path), cells=cells, piece=piece)
    found, read = search_index(spark, str(tmp_path), queries, 7, piece=piece, block=block)
    assert rows_of(found) == rows_of(knn(queries, rows, 7))
    read = {r.query_id: (r.cells_read, r.cells) for r in read.collect()}
    assert len(read) == len(clumped[1]) - 1
    if cells == 16:
        # Near a clump few cells are looked into.
        assert sum(n for n, _ in read.values()) < 0.6 * sum(n for _, n in read.values())


def test_whole_rows_are_kept(spark, clumped, tmp_path):
    rows, _ = frames(spark, *clumped)
    write_index(rows, str(tmp_path), cells=8)
    opened = open_index(spark, str(tmp_path))
    assert int(opened.count.sum()) == 1_500
    stored = opened.rows.select("id", "embedding", "title")
    assert stored.exceptAll(rows).isEmpty() and stored.count() == 1_500


def test_only_visited_cells_are_read(spark, tmp_path):
    rows, queries = frames(spark, [[n // 100 * 100.0, n % 100 / 100] for n in range(1_000)], [[0.0, 0.5]])
    write_index(rows, str(tmp_path), cells=10)
    opened = open_index(spark, str(tmp_path))
    asked = queries.withColumnRenamed("embedding", "vec")
    visits = written(index._visits(opened, asked, 3, "query_id", later=False), "visits")
    plan = index._searched(opened, visits, 3, "query_id", "id", "embedding", 100, 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_cell#\d+ (=|IN)", plan), plan
    found, read = search_index(spark, str(tmp_path), queries, 3)
    assert read.first().cells_read <= 2 and {r.id for r in found.collect()} == {49, 50, 51}


def test_fewer_rows_than_asked(spark, tmp_path):
    rows, queries = frames(spark, [[0.0], [1.0], [1.0]], [[0.9], [5.0]])
    write_index(rows, str(tmp_path), cells=2)
    found, _ = search_index(spark, str(tmp_path), queries, 10)
    assert rows_of(found) == rows_of(knn(queries, rows, 10)) and found.count() == 6
    nobody = search_index(spark, str(tmp_path), queries.limit(0), 10)[0]
    assert nobody.count() == 0
    with pytest.raises(ValueError):
        write_index(rows.limit(0), str(tmp_path / "none"))
