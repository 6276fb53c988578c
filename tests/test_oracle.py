"""Every registered query against its DuckDB twin on the smallest data."""

import ast
from pathlib import Path

import pytest

import __spark_entry__ as entry
import check_oracle
from signalmart.bindings import oracle, registry

SF_DIR = "/root/testdata/sf0.001"
PACKAGE = Path(__file__).resolve().parents[1] / "signalmart"


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_its_twin(spark, duck, name):
    problem = check_oracle.difference(spark, duck, SF_DIR, name)
    # An hour without calls or failures is a legitimate answer at this scale, a wrong one is not.
    assert problem in (None, "no rows on either side")


def test_every_query_has_a_twin():
    assert set(registry.QUERIES) == set(oracle.oracle_sql())
    assert set(entry.queries()) >= set(registry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["topic", "offset", "reason"] and df.count() > 0


def test_no_row_functions_and_no_local_collections():
    """Nothing in the package leaves the executors but bounded lists: the event types of a batch, its keys if they
    are few or else its buckets, the rows of a quality report."""
    collects = []
    for path in PACKAGE.rglob("*.py"):
        if "llm" in path.relative_to(PACKAGE).parts:
            continue
        tree = ast.parse(path.read_text())
        for node in ast.walk(tree):
            name = getattr(node, "attr", None)
            assert name not in {"udf", "pandas_udf", "rdd", "toPandas", "localCheckpoint", "crossJoin",
                                "toLocalIterator", "applyInPandas", "mapInPandas"}, (path, name)
            if name == "collect":
                collects.append(path.name)
    assert sorted(collects) == ["batch.py", "batch.py", "cli.py", "load.py"]
