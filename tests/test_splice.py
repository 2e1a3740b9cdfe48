import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.scd import END, SEQ, START, prepare_changes, scd2, scd2_log_append
from sluice.operators.splice import beside, compacted, scd2_runs, scd2_splice, scd2_view
from sluice.streaming.declarative import ChangeTarget

SCHEMA = "k int, v string, seq int, op string"
KW = dict(keys=["k"], sequence_by="seq", columns=["k", "v"], delete_when="op = 'd'")


def _key(r):
    return tuple(str(r[c]) for c in ("k", "v", START, END))


def _rows(df):
    return sorted(map(_key, df.collect()))


def _random_rows(draw, n, keys=4, top=60):
    return [(draw.choice([None, *range(keys)]), draw.choice("ABC"), draw.randrange(top), draw.choice("uuuud")) for _ in range(n)]


@pytest.mark.parametrize("seed", range(2))
def test_splices_equal_the_history_of_all_changes(spark, seed):
    draw, frame = random.Random(seed), lambda rows: spark.createDataFrame(rows, SCHEMA)
    batches = [_random_rows(draw, n) for n in (30, 8, 1, 12)]
    log = runs = None
    for i, rows in enumerate(batches):
        p = prepare_changes(frame(rows), **KW)
        if runs is None:
            runs = scd2_runs(p, ["k"])
        else:
            runs, changes = scd2_splice(runs, log, p, ["k"])
            again, none = scd2_splice(runs, log, p, ["k"])  # a crash after the history was written
            assert none.count() == 0 and _rows(again) == _rows(runs)
        log = scd2_log_append(log, p, ["k"])
        assert _rows(scd2_view(runs)) == _rows(scd2(frame(sum(batches[: i + 1], [])), **KW))
        runs, log = spark.createDataFrame(runs.collect(), runs.schema), spark.createDataFrame(log.collect(), log.schema)
    assert scd2_splice(runs, log, prepare_changes(frame(batches[1]), **KW), ["k"])[1].count() == 0  # a replay


def test_a_late_change_rewrites_its_neighbours_only(spark):
    rows = [(k, "AB"[i % 2], 10 * i, "u") for k in range(3) for i in range(200)]
    p = prepare_changes(spark.createDataFrame(rows, SCHEMA), **KW)
    runs = scd2_runs(p, ["k"])
    for late, want in [((1, "C", 1005, "u"), 2),    # splits one version: its end moves, one version more
                       ((1, "A", 1005, "u"), 0),    # says what holds already
                       ((1, "B", 1005, "u"), 3),    # the next version begins earlier: put, dropped where it was, and the end before it
                       ((1, "C", 1000, "u"), None),  # ties with a row of the log: one of the two counts
                       ((7, "A", 5, "u"), 1), ((1, "C", 5000, "u"), 2), ((1, None, -5, "d"), 1)]:
        new = prepare_changes(spark.createDataFrame([late], SCHEMA), **KW)
        after, changes = scd2_splice(runs, p, new, ["k"])
        assert _rows(scd2_view(after)) == _rows(scd2(spark.createDataFrame([*rows, late], SCHEMA), **KW)), late
        assert want is None and changes.count() <= 4 or changes.count() == want, late
        assert after.count() in (600, 601)


def test_neighbours_over_bucket_edges(spark):
    rows = spark.range(100).selectExpr("id % 2 as k", "id as s", "cast(id div 7 as int) as b")
    for after in (False, True):
        got = {(r.k, r.s): r.near and r.near.s for r in beside(rows, ["k"], "b", "s", F.struct("s"), "near", after).collect()}
        step = 2 if after else -2
        assert got == {(s % 2, s): s + step if 0 <= s + step < 100 else None for s in range(100)}


def test_a_hot_key_is_split_by_buckets(spark, monkeypatch):
    from sluice.operators import scd

    monkeypatch.setattr(scd.sequence_bucket, "__defaults__", (40, 40_000, SEQ, 64))
    draw = random.Random(9)
    rows = [(1, draw.choice("AB"), i, "u") for i in range(0, 2000, 2)] + [(k, "A", 5, "u") for k in range(50)]
    late = [(1, draw.choice("AB"), draw.randrange(2000), "u") for _ in range(40)]
    p, new = (prepare_changes(spark.createDataFrame(x, SCHEMA), **KW) for x in (rows, late))
    bucket = p.select(scd.sequence_bucket(p).alias("b"), SEQ)
    sizes = [r["count"] for r in bucket.groupBy("b").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 200  # buckets follow the rows
    by_seq = bucket.distinct().orderBy(SEQ).collect()
    assert all(a["b"] <= b["b"] for a, b in zip(by_seq, by_seq[1:]))
    runs, _ = scd2_splice(scd2_runs(p, ["k"]), p, new, ["k"])
    assert _rows(scd2_view(runs)) == _rows(scd2(spark.createDataFrame(rows + late, SCHEMA), **KW))


def test_names_of_helpers_as_columns(spark):
    names = ["_mk", "_st", "_pos", "_seq_bucket", "_start", "_end", "v", "s", "d", "tb", "e", "b", "state", "before", "next", "new", "put", "edge", "carry", "r_k0", "k0"]
    base = spark.createDataFrame([(1, 1), (1, 3), (2, 2)], "k int, seq int").select("*", *[F.concat(F.lit(n), F.col("seq")).alias(n) for n in names])
    late = base.limit(1).withColumn("seq", F.lit(2))
    kw = dict(keys=["k"], sequence_by="seq", columns=["k", *names])
    p, new = prepare_changes(base, **kw), prepare_changes(late, **kw)
    runs, _ = scd2_splice(scd2_runs(p, ["k"]), p, new, ["k"])
    got = scd2_view(runs)
    assert set(got.columns) == {"k", *names, START, END}
    want = scd2(base.unionByName(late), **kw)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_compacted_log_splices_like_the_whole_one(spark):
    draw = random.Random(5)
    rows = [(k, v, s, o) for k, v, s, o in _random_rows(draw, 120)]
    late = [(k, v, s + 40, o) for k, v, s, o in _random_rows(draw, 20, top=30)]
    p, new = (prepare_changes(spark.createDataFrame(x, SCHEMA), **KW) for x in (rows, late))
    small = compacted(p, ["k"], F.lit(40))
    assert small.filter(F.col(SEQ) < 40).count() <= 5 and small.filter(F.col(SEQ) >= 40).count() == p.filter(F.col(SEQ) >= 40).count()
    runs = scd2_runs(p, ["k"])
    assert _rows(scd2_splice(runs, small, new, ["k"])[0]) == _rows(scd2_splice(runs, p, new, ["k"])[0])


def test_bounded_target_keeps_its_log_small_and_names_what_is_too_late(spark, tmp_root):
    target = ChangeTarget("t", tmp_root, ["k"], "seq", ["k", "v"], scd_type=2, delete_when="op = 'd'", buckets=2, lateness="{seq} - 100")
    draw, accepted, late, top, sizes = random.Random(3), [], [], None, []
    for n in range(7):
        rows = [(k, draw.choice("AB"), 100 * n + draw.randrange(100), draw.choice("uuud")) for k in range(4) for _ in range(6)]
        rows += [(draw.randrange(4), "C", draw.randrange(100 * n + 1), "u") for _ in range(5)]
        frame = spark.createDataFrame(rows, SCHEMA)
        bound = None if top is None else top - 100
        late += [r for r in rows if bound is not None and r[2] < bound]
        accepted += [r for r in rows if bound is None or r[2] >= bound]
        target.apply(frame, n)
        if n in (2, 4):
            target.apply(frame, n)  # replayed
        top = max([r[2] for r in rows] + ([] if top is None else [top]))
        sizes.append(target.tables(spark)["log"].read().count())
        assert _rows(target.read(spark)) == _rows(scd2(spark.createDataFrame(accepted, SCHEMA), **KW)), n
    assert max(sizes) < 90 and target.tables(spark)["history"].read().count() < 80 and len(accepted) > 130
    assert target.too_late(spark).count() == len(late) > 0


def test_keys_that_fit_a_task_are_shuffled_once(spark):
    """No key is hot: one shuffle by key serves the equal rows, the ties and the neighbours of a whole log."""
    p = prepare_changes(spark.createDataFrame(_random_rows(random.Random(2), 200), SCHEMA), **KW)
    plan = scd2_runs(p, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_whole_keys_and_buckets_agree(spark, monkeypatch):
    """Histories, changes and fresh rows are the same whether keys are windowed whole or split by buckets."""
    from sluice.operators import scd
    from sluice.operators.splice import scd2_splice_fresh

    draw, got = random.Random(4), []
    p, new = (prepare_changes(spark.createDataFrame(_random_rows(draw, n), SCHEMA), **KW) for n in (80, 25))
    new = new.unionByName(p.limit(5))  # some are in the log already
    p, new = (spark.createDataFrame(x.collect(), x.schema) for x in (p, new))
    for most in (scd.ROWS_A_KEY, 3):
        monkeypatch.setattr(scd, "ROWS_A_KEY", most)
        runs = scd2_runs(p, ["k"])
        got.append([sorted(map(str, df.collect())) for df in (runs, *scd2_splice_fresh(runs, p, new, ["k"]))])
    assert got[0] == got[1] and all(got[0])
    log = sorted(map(str, scd2_log_append(p, new, ["k"]).collect()))
    assert sorted([*map(str, p.collect()), *got[0][3]]) == log
