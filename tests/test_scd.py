import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.operators.scd import prepare_changes, scd1_state, scd1_view, scd2, scd2_apply

SCHEMA = "k int, v string, seq int, op string"


def _hist(df):
    return sorted((r.v, r["__start_at"], r["__end_at"]) for r in df.collect())


def test_late_row_type2(spark):
    # FIXTURES §5: (A,1) (A,3) then late (B,2) -> (A,1,2) (B,2,3) (A,3,open)
    b1 = spark.createDataFrame([(1, "A", 1, "u"), (1, "A", 3, "u")], SCHEMA)
    b2 = spark.createDataFrame([(1, "B", 2, "u")], SCHEMA)
    kw = dict(keys=["k"], sequence_by="seq", columns=["k", "v"])
    log, hist = scd2_apply(None, None, prepare_changes(b1, **kw), ["k"])
    assert _hist(hist) == [("A", 1, None)]
    log, hist = scd2_apply(log, hist, prepare_changes(b2, **kw), ["k"])
    assert _hist(hist) == [("A", 1, 2), ("A", 3, None), ("B", 2, 3)]
    # replaying the late batch changes nothing
    log2, hist2 = scd2_apply(log, hist, prepare_changes(b2, **kw), ["k"])
    assert _hist(hist2) == _hist(hist) and log2.count() == log.count()
    # batch form over all changes agrees
    assert _hist(scd2(b1.unionByName(b2), **kw)) == _hist(hist)


def test_type1_late_rows_and_tombstones(spark):
    kw = dict(keys=["k"], sequence_by="seq", columns=["k", "v"], delete_when="op = 'd'")
    b1 = spark.createDataFrame([(1, "A", 1, "u"), (1, "A", 3, "u")], SCHEMA)
    b2 = spark.createDataFrame([(1, "B", 2, "u")], SCHEMA)
    st = scd1_state(prepare_changes(b2, **kw), ["k"], scd1_state(prepare_changes(b1, **kw), ["k"]))
    assert [(r.v) for r in scd1_view(st).collect()] == ["A"]
    b3 = spark.createDataFrame([(1, None, 4, "d")], SCHEMA)
    b4 = spark.createDataFrame([(1, "C", 2, "u")], SCHEMA)
    st = scd1_state(prepare_changes(b3, **kw), ["k"], st)
    st = scd1_state(prepare_changes(b4, **kw), ["k"], st)
    assert scd1_view(st).count() == 0  # late row cannot revive a deleted key


def test_type2_deletes_and_noops(spark):
    rows = [(1, "A", 1, "u"), (1, "A", 2, "u"), (1, None, 3, "d"), (1, None, 4, "d"), (1, "A", 5, "u")]
    h = scd2(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["k", "v"], delete_when="op = 'd'")
    assert _hist(h) == [("A", 1, 3), ("A", 5, None)]


def test_except_columns(spark):
    rows = [(1, "A", 1, "x"), (1, "A", 2, "y")]
    h = scd2(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", except_columns=["op"])
    assert "op" not in h.columns and h.count() == 1


def test_scd2_intervals_never_overlap(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(5), rng.choice("ABC"), i, "u") for i in range(300)]
    h = scd2(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", ["k", "v"]).collect()
    by_key = {}
    for r in h:
        by_key.setdefault(r.k, []).append((r["__start_at"], r["__end_at"]))
    for ivs in by_key.values():
        ivs.sort()
        assert sum(e is None for _, e in ivs) == 1
        for (s1, e1), (s2, _) in zip(ivs, ivs[1:]):
            assert e1 == s2


def _brute_scd2(rows):
    """Plain-Python type 2 over (k, v, seq, op) rows: one pass per key in sequence order."""
    out, by_key = [], {}
    for k, v, seq, op in rows:
        by_key.setdefault(k, []).append((seq, v, op == "d"))
    for k, ch in by_key.items():
        ch.sort()
        open_v, prev = None, None
        for seq, v, deleted in ch:
            state = ("D",) if deleted else ("V", v)
            if state == prev:
                continue
            if open_v is not None:
                out.append((k, open_v[0], open_v[1], seq))
                open_v = None
            if not deleted:
                open_v = (v, seq)
            prev = state
        if open_v is not None:
            out.append((k, open_v[0], open_v[1], None))
    return sorted(out, key=str)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from(["A", "B", None]),
                          st.sampled_from("uuud")), min_size=1, max_size=80))
def test_type2_matches_brute_force_across_buckets(spark, changes):
    rows = [(k, v, i, op) for i, (k, v, op) in enumerate(changes)]
    df = spark.createDataFrame(rows, SCHEMA)
    # tiny buckets so that versions cross many bucket edges
    h = scd2(df, ["k"], "seq", ["k", "v"], delete_when="op = 'd'", bucket=F.floor(F.col("__seq") / 3))
    got = sorted(((r.k, r.v, r["__start_at"], r["__end_at"]) for r in h.collect()), key=str)
    assert got == _brute_scd2(rows)


def test_hot_key_is_split_by_bucket_for_any_sequence(spark):
    from sluice.operators.scd import SEQ, prepare_changes, sequence_bucket
    base = spark.range(20_000).select(F.lit(1).alias("k"), F.when(F.col("id") % 5 < 3, "A").otherwise("B").alias("v"), "id")
    for seq in (F.col("id") * 1_000_000 + 1_700_000_000_000_000, F.timestamp_micros(F.col("id") * 1_000_000), F.format_string("%08d", "id"),
                (F.col("id") / 4).cast("decimal(20,2)"), F.struct(F.lit(1).alias("a"), F.col("id").alias("b"))):
        p = prepare_changes(base.withColumn("s", seq), ["k"], "s", ["k", "v"])
        sizes = [r["count"] for r in p.groupBy(sequence_bucket(p)).count().collect()]
        assert 32 <= len(sizes) <= 64 and max(sizes) < 20_000 / 10


def test_scd2_plan_windows_by_key_and_bucket(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), F.when(F.col("id") % 7 < 3, "A").otherwise("B").alias("v"))
    h = scd2(df, ["k"], "seq", ["k", "v"])
    plan = h._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning(k#" in x and "_seq_bucket" in x for x in plan.splitlines()) >= 1
    assert h.count() == 1429 and h.filter("__end_at is null").count() == 1


def test_ties_on_the_sequence_are_one_change(spark):
    import pytest
    rows = [(1, "A", 5, "u"), (1, "B", 5, "u"), (1, "C", 5, "u"), (None, "D", 5, "u"), (None, "E", 5, "u"), (2, "F", 5, "u"), (2, "F", 5, "u")]
    df = spark.createDataFrame(rows, SCHEMA)
    h = scd2(df, ["k"], "seq", ["k", "v"]).collect()
    assert len(h) == 3 and all(r["__end_at"] is None and r["__start_at"] == 5 for r in h)
    with pytest.raises(ValueError, match="tie"):
        scd2(df, ["k"], "seq", ["k", "v"], strict=True)
    assert scd2(df.filter("k = 2"), ["k"], "seq", ["k", "v"], strict=True).count() == 1


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from("AB"), st.integers(0, 12)), min_size=1, max_size=60))
def test_type2_with_ties_has_no_empty_interval(spark, changes):
    df = spark.createDataFrame([(k, v, s, "u") for k, v, s in changes], SCHEMA)
    h = scd2(df, ["k"], "seq", ["k", "v"], bucket=F.floor(F.col("__seq") / 3)).collect()
    by_key = {}
    for r in h:
        by_key.setdefault(r.k, []).append((r["__start_at"], r["__end_at"] if r["__end_at"] is not None else 99))
    for own in by_key.values():
        own.sort()
        assert all(a < b for a, b in own) and all(x[1] == y[0] for x, y in zip(own, own[1:])) and own[-1][1] == 99


def test_type1_incremental_equals_batch_with_null_keys(spark):
    rng = random.Random(11)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice("ABC"), i, rng.choice("uuud")) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    kw = dict(keys=["k"], sequence_by="seq", columns=["k", "v"], delete_when="op = 'd'")
    full = scd1_view(scd1_state(prepare_changes(df, **kw), ["k"]))
    a, b = df.filter("seq % 3 = 0"), df.filter("seq % 3 <> 0")
    inc = scd1_state(prepare_changes(b, **kw), ["k"], scd1_state(prepare_changes(a, **kw), ["k"]))
    assert sorted(scd1_view(inc).collect(), key=str) == sorted(full.collect(), key=str)


def test_type2_incremental_equals_batch_with_null_keys(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, 1, 2]), rng.choice("AB"), i, rng.choice("uuud")) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    kw = dict(keys=["k"], sequence_by="seq", columns=["k", "v"], delete_when="op = 'd'")
    full = scd2(df, **kw)
    a, b = df.filter("seq >= 120"), df.filter("seq < 120")  # the second batch is late
    log, hist = scd2_apply(None, None, prepare_changes(a, **kw), ["k"])
    log, hist = scd2_apply(log, hist, prepare_changes(b, **kw), ["k"])
    assert sorted(hist.collect(), key=str) == sorted(full.collect(), key=str)


def test_declarative_batches_replay_and_crash_recovery(spark, tmp_root, monkeypatch):
    import pytest
    from sluice.functions.rules import Rule
    from sluice.sinks.bucketed import BucketedTable
    from sluice.streaming.declarative import ChangeTarget, apply_changes_batch
    t2 = ChangeTarget("h", f"{tmp_root}/h", ["k"], "seq", ["k", "v"], scd_type=2, delete_when="op = 'd'")
    t1 = ChangeTarget("s", f"{tmp_root}/s", ["k"], "seq", ["k", "v"], scd_type=1, delete_when="op = 'd'")
    exp = [Rule("k_nn", "k IS NOT NULL", "drop")]
    b0 = spark.createDataFrame([(1, "A", 1, "u"), (1, "A", 3, "u"), (None, "Z", 4, "u")], SCHEMA)
    b1 = spark.createDataFrame([(1, "B", 2, "u"), (2, "C", 5, "u")], SCHEMA)
    apply_changes_batch(b0, 0, "q", exp, [t1, t2])
    apply_changes_batch(b0, 0, "q", exp, [t1, t2])  # replay: no-op
    real = BucketedTable.replace
    calls = {"n": 0}

    def flaky(self, rows, touched):
        if self.root.endswith("/history"):
            calls["n"] += 1
            raise RuntimeError("lost between log and history")
        return real(self, rows, touched)
    monkeypatch.setattr(BucketedTable, "replace", flaky)
    with pytest.raises(RuntimeError):
        apply_changes_batch(b1, 1, "q", exp, [t2])
    monkeypatch.setattr(BucketedTable, "replace", real)
    apply_changes_batch(b1, 1, "q", exp, [t1, t2])  # retry
    hist = sorted((r.k, r.v, r["__start_at"], r["__end_at"]) for r in t2.read(spark).collect())
    assert hist == [(1, "A", 1, 2), (1, "A", 3, None), (1, "B", 2, 3), (2, "C", 5, None)]
    assert sorted((r.k, r.v) for r in t1.read(spark).collect()) == [(1, "A"), (2, "C")]
    assert calls["n"] == 1
