import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(REPO))

import __spark_entry__ as entry  # noqa: E402

NUMBERS = {f"op{n}" for n in range(1, 14)}


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == NUMBERS
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", ["op5_top_k", "op8_secrets", "op9_decontamination", "op11_spelling", "op12_prefix_trie", "op13_spotsigs"])
def test_equals_its_sql(spark, name):
    from tools.compare import compare, connect

    sf = "/root/testdata/sf0.001"
    verdict = compare(spark, connect(sf), name, sf)
    assert verdict.startswith("ok"), verdict


def test_nothing_else_imports_the_subpackage():
    users = [
        p
        for p in (REPO / "noticelens").rglob("*.py")
        if "llm" not in p.parts and "noticelens.llm" in p.read_text()
    ]
    assert not users


def test_entry_without_the_subpackage(tmp_path):
    """The entry module works where the subpackage and the pipeline were deleted."""
    import shutil

    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "noticelens", tmp_path / "noticelens", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op') for n in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
