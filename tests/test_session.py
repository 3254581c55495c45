import pytest

from noticelens.session import free_name, lookup


@pytest.mark.parametrize("small", [True, False])
def test_lookup_leaves_columns_of_any_name(spark, small):
    rows = spark.createDataFrame([(1, "a", 7), (2, "b", 8), (1, "c", 9)], "key int, name string, _salt int")
    table = spark.createDataFrame([(1, "x"), (3, "y")], "key int, _SALT_ string")
    found = lookup(rows, table, ["key"], "left", small=small)
    assert found.columns == ["key", "name", "_salt", "_SALT_"]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "a", 7, "x"), (1, "c", 9, "x"), (2, "b", 8, None)]


def test_names_are_told_apart_without_case(spark):
    df = spark.createDataFrame([(1, 2)], "_SALT int, _salt_ int")
    assert free_name("_salt", df) == "_salt__" and free_name("other", df) == "other"


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_never_broadcasts_a_table_repeated_by_salts(spark, how, tmp_path):
    spark.range(1_000).selectExpr("id as key", "id as value").write.parquet(str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    rows = spark.range(500).selectExpr("id % 7 as key", "id as place")
    found = lookup(rows, table, ["key"], how, small=False)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.count() == 500
