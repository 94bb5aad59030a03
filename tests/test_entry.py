"""The driver contract: entry(), queries() and oracle_sql(), and the pure
validation queries against their DuckDB oracles (sf 0.001)."""
import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

from contractgate.plans import checks, zone_checks

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


E = _entry()


def test_every_query_has_an_oracle():
    own = {n for n, f in E.queries().items() if f.__module__.startswith("contractgate.plans")}
    assert len(own) >= 41 and own <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["entity", "contract_version", "ordinal", "check", "column", "message", "failing_rows"]
    assert {(r["ordinal"], r["failing_rows"]) for r in rows} == {(504, 590), (704, 304), (905, 2070), (1200, 1401)}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", checks.REGISTERED + zone_checks.REGISTERED)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest(res.columns, res.fetchall())
