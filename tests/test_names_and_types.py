"""Input columns named as helpers are named pass through; keys and columns of every type are defined or refused by name."""

import pytest
from pyspark.sql import functions as F

from sluice.functions.rules import Rule
from sluice.operators.dedupe import dedupe_latest
from sluice.operators.expectations import apply_expectations
from sluice.operators.scd import prepare_changes, scd1_state, scd1_view, scd2
from sluice.operators.split import judge, split
from sluice.operators.upsert import change_feed, upsert

HELPERS = ["_rank", "_top", "_k0", "_o0", "k0", "o0", "top", "_status", "_failed_rules", "_unknown_rules", "_jk", "_mk", "_st", "_pos", "_seq_bucket",
           "_start", "_end", "_best", "_m", "lo", "hi", "_in_old", "_in_new", "_kind", "_old", "_new", "_img", "was", "now", "row", "kind", "was_key", "x", "s", "n0", "v0"]


def _frame(spark):
    base = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, -1), (None, 3, 7)], "k int, seq int, q int")
    return base.select("*", *[F.concat(F.lit(h), F.col("seq")).alias(h) for h in HELPERS])


def _kept(rows, key="k"):
    return all(r[h] == f"{h}{r['seq']}" for r in rows for h in HELPERS)


OPERATORS = {
    "latest": lambda d: dedupe_latest(d, ["k"], ["seq"]),
    "latest, ties": lambda d: dedupe_latest(d, ["k"], ["seq"], ties="all"),
    "valid": lambda d: split(d, [Rule("positive", "q > 0")])[0],
    "quarantine": lambda d: split(d, [Rule("positive", "q > 0")])[1],
    "lost nothing": lambda d: split(d, [Rule("positive", "q > 0")], "drop")[0],
    "expectations": lambda d: apply_expectations(d, [Rule("positive", "q > 0", "drop")])[0],
    "upsert": lambda d: upsert(d.filter("seq = 1"), d.filter("seq > 1"), ["k"]),
    "changes": lambda d: change_feed(d.filter("seq = 1"), d.filter("seq = 2"), ["k"]),
    "type 1": lambda d: scd1_view(scd1_state(prepare_changes(d, ["k"], "seq", [c for c in d.columns]), ["k"])),
    "type 2": lambda d: scd2(d, ["k"], "seq", d.columns),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_helpers_neither_drop_nor_clash(spark, name):
    got = OPERATORS[name](_frame(spark))
    rows = got.collect()
    assert rows and set(_frame(spark).columns) <= set(got.columns) and _kept(rows)


def test_judge_refuses_its_own_names(spark):
    with pytest.raises(ValueError, match="_status"):
        judge(_frame(spark), [Rule("positive", "q > 0")])


@pytest.mark.parametrize("kind", ["struct<a:int,b:string>", "array<int>", "decimal(20,3)", "timestamp_ntz", "binary", "boolean", "float", "struct<a:struct<c:date>>"])
def test_keys_of_every_type(spark, kind):
    text = {"struct<a:int,b:string>": "named_struct('a', int(i), 'b', 'x')", "array<int>": "array(int(i))", "decimal(20,3)": "cast(i as decimal(20,3))",
            "timestamp_ntz": "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(i))", "binary": "cast(string(i) as binary)", "boolean": "i > 1", "float": "float(i)",
            "struct<a:struct<c:date>>": "named_struct('a', named_struct('c', date_add(date'2024-01-01', int(i))))"}[kind]
    rows = lambda ids, v: spark.createDataFrame([(i, v) for i in ids], "i int, v string").selectExpr(f"case when i > 0 then {text} end as k", "v")
    old, new = rows([1, 2, -1], "old"), rows([2, -1], "new")
    assert sorted(r.v for r in upsert(old, new, ["k"]).collect()) == ["new", "new", "old", "old"]
    feed = sorted((r["_change_type"], r.v) for r in change_feed(old, new, ["k"]).collect())
    assert feed == [("delete", "old"), ("delete", "old"), ("insert", "new"), ("update_postimage", "new"), ("update_preimage", "old")]


def test_maps_and_columns_of_one_version(spark):
    old = spark.sql("select 1 as k, map('a', 1, 'b', 2) as m union all select 2, map('a', 1) union all select cast(null as int), map('z', 0)")
    new = spark.sql("select 1 as k, map('b', 2, 'a', 1) as m, 'n' as more union all select 2, map('a', 5), null")
    got = sorted((r["_change_type"], r.k, r.more) for r in change_feed(old, new, ["k"]).collect() if r.k)
    assert got == [("update_postimage", 1, "n"), ("update_postimage", 2, None), ("update_preimage", 1, None), ("update_preimage", 2, None)]
    same = new.drop("more").filter("k = 1")
    assert change_feed(old.filter("k = 1"), same, ["k"]).count() == 0
    deep = spark.sql("select 1 as k, array(map('a', 1)) as deep")
    with pytest.raises(TypeError, match="deep"):
        change_feed(deep, deep, ["k"])
    with pytest.raises(TypeError, match="map"):
        upsert(old.select("m"), old.select("m"), ["m"], check=False)
