"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as entry  # noqa: E402
from tools.check_oracle import digest  # noqa: E402
from trip_star.plans import FACT_COLUMNS  # noqa: E402
from trip_star.sources.fixtures import BASE_TABLES  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def test_every_query_has_an_oracle():
    """The training-data queries, if there, say themselves which have SQL (tests/llm covers the others)."""
    own = {n for n in entry.queries() if n != "pipeline" and not n.startswith("op")}
    assert own <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    want = duck.execute(SQL[name]).df()
    assert digest(got) == digest(want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert tuple(df.columns) == FACT_COLUMNS
    assert df.count() > 0


def test_the_star_loads_where_a_library_of_the_other_queries_is_missing():
    """The subpackage is only added if it can be imported."""
    code = "import sys; sys.modules['tiktoken'] = None; import __spark_entry__ as e; print(len([n for n in e.queries() if not n.startswith('op')]))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-500:]
    assert int(done.stdout.split()[-1]) >= 38
