"""Every registered query against its DuckDB oracle on sf0.001 (the correctness gate)."""
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from sluice.plans.queries import QUERIES
from sluice.plans.stream_queries import STREAM_QUERIES
from conftest import SF0001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES | STREAM_QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "status" in df.columns


def test_fixture_counts_sf0001(spark):
    """FIXTURES.md §3 numbers at sf0.001."""
    q = E.queries()
    st = {r.status: r for r in q["quarantine_split"](spark, SF0001).groupBy("status")
          .agg({"*": "count", "quantity": "sum"}).withColumnRenamed("count(1)", "n")
          .withColumnRenamed("sum(quantity)", "q").collect()}
    assert (st["valid"].n, st["valid"].q) == (2325, 57627)
    assert (st["quarantine"].n, st["quarantine"].q) == (2274, 49531)
    pol = {r.status_drop: r["count"] for r in q["null_policy_split"](spark, SF0001).groupBy("status_drop").count().collect()}
    assert (pol["valid"], pol["quarantine"], pol["unknown"]) == (1799, 2750, 50)
    viol = {r.rule_name: r.failed_rows for r in q["rule_violations"](spark, SF0001).collect()}
    assert [viol[n] for n in ("client_id_not_null", "product_id_not_null", "sales_id_not_null",
                              "dateWithinRange", "validQuantity", "validAddress")] == [1367, 913, 0, 548, 226, 1004]
