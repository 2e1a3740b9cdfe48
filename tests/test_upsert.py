import pytest

from sluice.operators.upsert import assert_unique_keys, change_feed, upsert
from sluice.sinks.bucketed import BucketedTable
from sluice.sinks.quarantine import QuarantineSink


def test_upsert_updates_inserts_and_keeps_null_keys(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n1")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c"), (None, "n2")], "k int, v string")
    out = sorted(upsert(t, s, ["k"]).collect(), key=lambda r: (r.k is None, r.k, r.v))
    assert [(r.k, r.v) for r in out] == [(1, "a"), (2, "B"), (3, "c"), (None, "n1"), (None, "n2")]


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = upsert(t, s, ["k"])
    assert sorted(upsert(once, s, ["k"]).collect()) == sorted(once.collect())


def test_unique_keys_check(spark):
    with pytest.raises(ValueError, match="repeats key"):
        assert_unique_keys(spark.createDataFrame([(1,), (1,)], "k int"), ["k"])
    assert_unique_keys(spark.createDataFrame([(None,), (None,), (1,)], "k int"), ["k"])


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, None), (4, "d")], "k int, v string")
    got = sorted((r.k, r.v, r._change_type) for r in change_feed(old, new, ["k"]).collect())
    assert got == [(1, "a", "delete"), (2, "B", "update_postimage"), (2, "b", "update_preimage"),
                   (4, "d", "insert")]


def test_upsert_raises_on_repeated_source_keys(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(ValueError, match="repeats key"):
        upsert(t, s, ["k"])


def _files(root):
    import os
    from sluice.session import local_path
    return {f"{d}/{f}" for d, _, names in os.walk(local_path(root) + "/data") for f in names if f.startswith("part-")}


def test_bucketed_table_touches_only_its_buckets(spark, tmp_root):
    t = BucketedTable(spark, f"{tmp_root}/silver", ["k"], buckets=16)
    assert not t.exists()
    t.upsert(spark.range(400).selectExpr("int(id) k", "'a' v"), "q-0")
    before = _files(t.root)
    one = spark.createDataFrame([(7, "B")], "k int, v string")
    for _ in range(2):  # a replay changes nothing
        t.upsert(one, "q-1")
        got = {r.k: r.v for r in t.read().collect()}
        assert len(got) == 400 and got[7] == "B" and got[8] == "a"
    gone = before - _files(t.root)
    touched = t.touched(one)
    assert len(touched) == 1 and gone and all(f"_bucket={touched[0]}/" in f for f in gone)
    assert BucketedTable(spark, t.root, ["k"], buckets=4).buckets == 16  # stored with the table


def test_bucketed_table_null_keys_insert_once_per_batch(spark, tmp_root):
    t = BucketedTable(spark, f"{tmp_root}/silver", ["k"], buckets=4)
    rows = spark.createDataFrame([(None, "x"), (None, "y"), (1, "z")], "k int, v string")
    t.upsert(rows, "q-0")
    t.upsert(rows, "q-0")
    assert t.read().count() == 3
    t.upsert(rows, "q-1")
    assert t.read().filter("k is null").count() == 4 and t.read().count() == 5
    with pytest.raises(ValueError, match="repeats key"):
        t.upsert(spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), "q-2")


def test_bucketed_table_changes_and_emptied_bucket(spark, tmp_root):
    t = BucketedTable(spark, f"{tmp_root}/silver", ["k"], buckets=4)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "q-0")
    got = sorted((r.k, r.v, r._change_type) for r in t.changes(spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")).collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (3, "c", "insert")]
    whole = t.read()
    t.replace(whole.filter("k = 99"), t.touched(whole))
    assert t.read().count() == 0


def test_quarantine_sink_overwrites_its_batch(spark, tmp_root):
    q = QuarantineSink(spark, f"{tmp_root}/q")
    rows = spark.createDataFrame([(1, "x")], "k int, v string")
    q.write(rows, "qid", 0)
    q.write(rows, "qid", 0)
    q.write(rows, "qid", 1)
    assert q.read().count() == 2


def test_null_keys_spread_over_salts(spark):
    from pyspark.sql import functions as F
    from sluice.operators.upsert import join_key
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("v"))
    jk = df.select(join_key(df, ["k"]).alias("j"), "k")
    salts = jk.filter("k is null").select("j.s").distinct().count()
    assert salts > 500  # the NULL group (a third of the rows) is spread, not one reducer
    assert jk.filter("k is not null").select("j.s").distinct().collect()[0][0] == 0


def test_quarantine_sink_with_only_clean_batches(spark, tmp_root):
    import pytest
    q = QuarantineSink(spark, f"{tmp_root}/clean")
    with pytest.raises(Exception):
        q.read()
    assert q.read(schema="k int, v string").count() == 0
