import duckdb
import pytest
from helpers import SF

from sluice.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    res = con.execute(ORACLE[name])
    names = sorted(d[0] for d in res.description)
    want = sorted(tuple(r) for r in con.execute(f"select {', '.join(names)} from ({ORACLE[name]})").fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == names
    assert sorted(tuple(r) for r in df.select(*names).collect()) == want


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
