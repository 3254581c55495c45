import re
import subprocess
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from compare import compare, connect  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from noticelens.plans.catalogue import QUERIES  # noqa: E402
from noticelens import session  # noqa: E402
from noticelens.operators import density, maxsim, vectors, weaklabel  # noqa: E402

SF = "/root/testdata/sf0.001"
ROWS_ONLY = {
    "encode_channels", "train_binary_cv", "train_multiclass_cv", "distill_train", "weak_label_text",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.fixture()
def nothing_is_small(monkeypatch):
    """Every table counts as large and every vector block as full."""
    for module in (session, density):
        monkeypatch.setattr(module, "is_small", lambda *_: False)
    limited = [maxsim.maxsim, maxsim.ensemble_label, maxsim.top_labels, maxsim.nearest_label]
    limited += [weaklabel.weak_label, weaklabel.candidates, vectors.knn]
    for fn in limited:
        defaults = tuple(2000 if d == vectors.MAX_BLOCK_CELLS else d for d in fn.__defaults__)
        monkeypatch.setattr(fn, "__defaults__", defaults)


LARGE_PATHS = [
    "cluster_keywords", "cluster_samples", "density_cluster", "knn_l2", "maxsim_label",
    "nearest_label", "weak_label_ensemble", "weak_label_full", "label_info_lookup", "dept_match",
    "taxonomy_rollup", "judge_candidates", "rare_class_filter", "label_encode", "eval_metrics",
    "knn_index", "hierarchy_cluster", "judge_chain",
]


@pytest.mark.parametrize("name", LARGE_PATHS)
def test_large_paths_give_the_same(spark, con, nothing_is_small, name):
    verdict = compare(spark, con, name, SF)
    assert verdict.startswith("ok"), verdict


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, name, SF)
    assert verdict.startswith("rows-only" if name in ROWS_ONLY else "ok"), verdict
    assert " 0 rows" not in verdict


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["id", "predicted_label", "status"] and df.count() == 500


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_product(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


PYTHON = re.compile(r"ArrowEvalPython|BatchEvalPython|MapIn\w+|FlatMapGroups\w*")
# Where Python workers run: entity decoding and matrix products.
PYTHON_IN = {
    "title_clean", "title_light_clean", "balanced_dataset", "maxsim_label", "nearest_label",
    "weak_label_ensemble", "weak_label_full", "weak_label_summary", "weak_label_text",
    "judge_candidates", "eval_metrics", "fold_summary", "knn_l2", "src_csv_fallback", "knn_index",
    "train_folds", "student_folds", "balanced_folds",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON_IN - ROWS_ONLY))
def test_stays_in_the_jvm(spark, name):
    assert not PYTHON.search(plan(entry.queries()[name](spark, SF)))


def test_scans_read_only_what_they_need(spark):
    wanted = {
        "stratified_folds": {"vec_id", "label"},
        "label_encode": {"p_partkey", "p_brand"},
        "hard_rules": {"p_partkey", "p_name"},
        "cluster_stats": {"source"},
        "strategy_report": {"user_id", "event_type", "value", "props"},
    }
    for name, columns in wanted.items():
        # Of the given tables; what a query wrote itself has its own columns.
        scans = rf"\[file:{SF}[^]]*\][^\n]*?ReadSchema: struct<([^>]*)>"
        found = re.findall(scans, plan(entry.queries()[name](spark, SF)))
        assert found, name
        for read in found:
            assert {c.split(":")[0] for c in read.split(",")} <= columns, name
    assert "EqualTo(source,src3)" in plan(entry.queries()["eligible_titles"](spark, SF))


def test_samples_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(entry.queries()["cluster_keywords"](spark, SF))
    assert "WindowGroupLimit" in plan(entry.queries()["knn_l2"](spark, SF))


def test_map_only_labelling(spark):
    text = plan(entry.queries()["weak_label_ensemble"](spark, SF))
    assert "MapInArrow" in text and "Exchange hashpartitioning" not in text
    assert "Exchange" not in plan(entry.queries()["score_batch"](spark, SF))


OUTSIDE = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
for name in ("weak_label_ensemble", "title_clean"):
    assert entry.queries()[name](spark, {sf!r}).count() > 0
"""


def test_workers_need_no_installed_package(tmp_path):
    """Run from a folder and session that know nothing of this repository."""
    code = OUTSIDE.format(path=entry.__file__, sf=SF)
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
