"""Every query against its SQL at sf0.001, plans without Python, and the entry points without the llm parts."""

import datetime
import math
import os
import subprocess
import sys

import duckdb
import pytest

from tallyframe import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, oracle, name):
    df = catalog.QUERIES[name](spark, SF)
    got = oracle.execute(catalog.SQL[name])
    cols = [d[0] for d in got.description]
    want = got.fetchall()
    assert sorted(cols) == sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    assert sorted(rows, key=repr) == sorted((tuple(map(plain, r)) for r in want), key=repr)


def test_plans_stay_in_the_jvm(spark):
    for name in ("window_team_metrics", "early_shocks", "schedule_travel", "team_zscores", "resultset_extract"):
        plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_entry_without_llm():
    code = "import sys; sys.modules['tallyframe.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'window_team_metrics' in q and not any(x.startswith('op1') for x in q) and set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
