import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from noticelens.fixed_values import CODE_ROLLUP, TAXONOMY
from noticelens.schemas import SCHEMAS, schema
from noticelens.sources import csvdir, tables

HEADER = "notice_name,bid_company_name\n"


@pytest.fixture()
def folder(tmp_path) -> Path:
    (tmp_path / "u.csv").write_bytes(b"\xef\xbb\xbf" + (HEADER + '"é, 공고",acme\n').encode())
    (tmp_path / "e.csv").write_bytes((HEADER + "공사 입찰,acme\nplain,\n").encode("euc-kr"))
    (tmp_path / "c.csv").write_bytes((HEADER + '똠방 "각",other\n').encode("cp949"))
    (tmp_path / "bad.csv").write_bytes(HEADER.encode() + b"\xff\xff\xff,acme\n")
    (tmp_path / "short.csv").write_text("notice_name\nno company\n")
    (tmp_path / "note.txt").write_text("not read")
    return tmp_path


def test_fallback_per_file(spark, folder):
    df = csvdir.read_csv_dir(spark, str(folder), require=["bid_company_name"])
    got = sorted(tuple(r) for r in df.select("notice_name", "bid_company_name").collect())
    assert got == sorted([("é, 공고", "acme"), ("공사 입찰", "acme"), ("plain", None), ('똠방 "각"', "other")])


def test_files_with_other_columns_are_unioned(spark, folder):
    df = csvdir.read_csv_dir(spark, str(folder))
    assert df.filter("notice_name = 'no company' and bid_company_name is null").count() == 1


def test_chosen_encodings(spark, folder):
    got = {Path(r.path).name: r.encoding for r in csvdir.probe_files(spark, str(folder), csvdir.UTF8_FIRST).collect()}
    assert got == {"u.csv": "utf-8-sig", "e.csv": "euc-kr", "c.csv": "cp949", "bad.csv": None, "short.csv": "utf-8-sig"}
    other = {Path(r.path).name: r.encoding for r in csvdir.probe_files(spark, str(folder), csvdir.CP949_FIRST).collect()}
    assert other["e.csv"] == other["c.csv"] == other["short.csv"] == "cp949"


def test_hard_failure_and_fixed_encoding(spark, folder, tmp_path_factory):
    with pytest.raises(ValueError, match="no encoding"):
        csvdir.read_csv_dir(spark, str(folder), csvdir.CP949_FIRST, on_fail="raise")
    single = tmp_path_factory.mktemp("one")
    (single / "a.csv").write_bytes((HEADER + "공고,acme\n").encode("cp949"))
    assert csvdir.read_csv(spark, str(single), "cp949").first().notice_name == "공고"
    with pytest.raises(ValueError):
        csvdir.read_csv(spark, str(single), "utf-8-sig")


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((HEADER + '"한 줄\n두 줄",acme\n').encode("euc-kr"))
    df = csvdir.read_csv_dir(spark, str(tmp_path), multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("한 줄\n두 줄", "acme")]


def test_odd_file_names_and_empty_folder(spark, tmp_path):
    (tmp_path / "공고 [1] 100%.csv").write_bytes((HEADER + "a,b\n").encode())
    (tmp_path / "x{y}*.csv").write_bytes((HEADER + "공,d\n").encode("euc-kr"))
    got = sorted(r.notice_name for r in csvdir.read_csv_dir(spark, str(tmp_path)).collect())
    assert got == ["a", "공"]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "n.txt").write_text("x")
    assert csvdir.read_csv_dir(spark, str(tmp_path / "sub")).columns == []
    assert csvdir.read_csv_dir(spark, str(tmp_path / "sub"), require=["a"]).columns == ["a"]


def test_missing_inputs(spark, tmp_path):
    nowhere = str(tmp_path / "nowhere")
    empty = csvdir.read_csv_dir(spark, nowhere, schema=schema("participated"), missing="empty")
    assert empty.columns == ["notice_name", "bid_company_name"] and empty.count() == 0
    assert tables.read_sheet(spark, nowhere, "ineligible", schema("ineligible"), "empty").count() == 0
    assert tables.read_mapping(spark, nowhere, missing="empty").columns == ["key", "value"]
    with pytest.raises(AnalysisException):
        tables.read_table(spark, nowhere)
    with pytest.raises(ValueError):
        tables.read_table(spark, nowhere, missing="empty")


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert tables.require_columns(df, ["a"]) is df
    with pytest.raises(tables.MissingColumns, match="b"):
        tables.require_columns(df, ["a", "b"])
    assert tables.require_columns(df, ["b"], "empty").columns == ["b"]


def test_mappings(spark, tmp_path):
    (tmp_path / "codes.json").write_text(json.dumps(CODE_ROLLUP, indent=2))
    (tmp_path / "tax.json").write_text(json.dumps(TAXONOMY, indent=2))
    codes = tables.read_mapping(spark, str(tmp_path / "codes.json"))
    assert {r.key: r.value for r in codes.collect()} == CODE_ROLLUP
    tax = tables.read_mapping(spark, str(tmp_path / "tax.json"), "array")
    assert {r.key: r.value for r in tax.collect()} == TAXONOMY


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([('a "q", b', 1)], schema("balanced"))
    tables.write_csv(df, str(tmp_path / "csv"))
    back = csvdir.read_csv_dir(spark, str(tmp_path / "csv"))
    assert [tuple(r) for r in back.collect()] == [('a "q", b', "1")]
    vec = spark.createDataFrame([(1, [0.5], "t", 0)], schema("vectors"))
    tables.write_vectors(vec, str(tmp_path / "v"), str(tmp_path / "j"))
    assert tables.read_table(spark, str(tmp_path / "v")).count() == 1
    assert spark.read.json(str(tmp_path / "j")).first().asDict() == {"id": 1, "label": 0, "title": "t"}


def test_schemas_parse():
    assert all(schema(name).fields for name in SCHEMAS)
