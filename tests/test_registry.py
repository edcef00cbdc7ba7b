"""Every registered query: Spark vs its DuckDB oracle (sf0.001), and, for the
retention queries, plan shape (no cartesian / nested-loop joins, no Python
UDF evaluation)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from retentio.catalog import QUERIES
from tools.check_oracle import TABLES, coarse, digest

from .conftest import SF_SMALL

ORACLE = E.oracle_sql()
NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", [n for n in NAMES if n in ORACLE])
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_cols = df.columns
    s_types = {f.name: coarse(f.dataType.simpleString()) for f in df.schema.fields}
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    o_cols = [d[0] for d in res.description]
    o_types = {d[0]: coarse(str(d[1])) for d in res.description}
    o_rows = res.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert s_types == o_types
    assert len(s_rows) == len(o_rows)
    assert digest(s_rows, s_cols)[0] == digest(o_rows, o_cols)[0]


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith("gbt_")])
def test_plan_shape(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_only_model_fits_lack_an_oracle():
    """Every retention query has DuckDB oracle SQL except the MLlib GBT
    fits (rows-only by nature)."""
    missing = sorted(n for n in QUERIES if n not in ORACLE)
    assert missing and all(n.startswith("gbt_") for n in missing), missing
    assert E.entry.__doc__ and "flagship" in E.entry.__doc__.lower()
