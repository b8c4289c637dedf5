"""Every query with a SQL answer, against DuckDB on the same tables."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
import compare

QUERIES = {name: query for plan in driver.LIBRARY_PLANS for name, query in plan.QUERIES.items()}
ORACLES = {name: sql for plan in driver.LIBRARY_PLANS for name, sql in plan.ORACLES.items()}


FORBIDDEN = [
    "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
]
# Long searches: the operators behind them have their own tests.
NO_SQL = [n for n in QUERIES if n not in ORACLES and n not in ("fuel_grid", "forest_grid", "duration_grid")]


def _forbidden(df) -> list[str]:
    """Python workers and pair-wise joins in the plan of a registered query."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    assert _forbidden(result) == []
    assert compare.differences(result, duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", NO_SQL)
def test_runs_without_sql(name, spark, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    assert _forbidden(result) == [] and result.count() > 0


def test_sources_use_no_local_lineage_cut_and_no_table_to_driver():
    package = Path(driver.__file__).parent / "tallyloom"
    for path in package.rglob("*.py"):  # the corpus operators too
        code = path.read_text()
        assert "localCheckpoint" not in code and "toPandas" not in code, path


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries()) and set(QUERIES) <= set(driver.queries())


def test_entry_has_rows(spark):
    result = driver.entry(spark)
    assert result.columns == ["feature", "coefficient"] and result.count() > 0
