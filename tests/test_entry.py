"""The driver contract: names, columns, and every query against its oracle on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as driver
from cairn.plans import registry
from cairn.session import TABLES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else str(v) if hasattr(v, "year") else v


def table(rows, columns, order):
    return sorted(repr([plain(r[columns.index(c)]) for c in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rel = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert table(df.collect(), df.columns, sorted(df.columns)) == table(rel.fetchall(), rel.columns, sorted(rel.columns))


def test_names():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(registry.QUERIES) <= set(driver.queries())


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and {"site", "quality"} <= set(df.columns)


def test_without_the_llm_folders():
    """The rest imports and lists its queries where the training-data subpackage is gone."""
    code = "import sys; sys.modules['cairn.llm'] = None; import __spark_entry__ as e; assert 'site_quality' in e.queries() and not any(q.startswith('op') for q in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)
