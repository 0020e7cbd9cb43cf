"""The registered queries: SQL where there is some, and what is imported where."""

import ast
from pathlib import Path

import pytest

import __spark_entry__
import corpus_pipeline
from linkloom.llm.queries import ORACLES, QUERIES
from tests.check import compare, connect

ROOT = Path(__file__).resolve().parents[2]
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None


def test_one_query_for_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_imports_the_package():
    for path in [*ROOT.glob("linkloom/**/*.py"), *ROOT.glob("catalog/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" in path.relative_to(ROOT).parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") or n == "corpus_pipeline" for n in names), path


@pytest.mark.parametrize("module", ["secrets", "mixing"])
def test_native_operators_hold_no_python(module):
    text = (ROOT / f"linkloom/llm/{module}.py").read_text()
    for word in ("pandas", "udf", "mapIn", "applyIn", ".rdd", "pyarrow"):
        assert word not in text
