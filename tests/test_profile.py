import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators.profile import profile, quantiles
from sluice.sinks.monitor import Monitor


def _frame(spark):
    rows = [(dt.datetime(2024, 1, 1, 1), 1.0, "a"), (dt.datetime(2024, 1, 1, 5), 0.0, "bb"),
            (dt.datetime(2024, 1, 2, 1), 3.0, None), (None, 4.0, "a"), (dt.datetime(2024, 1, 2, 3), None, "a")]
    return spark.createDataFrame(rows, "ts timestamp_ntz, x double, s string")


def test_daily_profile_keeps_null_window(spark):
    p = {(str(r.window_start), r.column_name): r for r in profile(_frame(spark), ts_col="ts", exact=True, mode_columns=["s"]).collect()}
    assert ("None", "x") in p and p[("None", "x")].row_count == 1
    day1 = p[("2024-01-01 00:00:00", "x")]
    assert (day1.row_count, day1.num_zeros, day1.min, day1.max, day1.avg) == (2, 1, 0.0, 1.0, 0.5)
    s2 = p[("2024-01-02 00:00:00", "s")]
    assert (s2.num_nulls, s2.percent_null, s2.num_distinct, s2.mode) == (1, 0.5, 1, "a")


def test_snapshot_profile_matches_pandas(spark):
    df = _frame(spark)
    p = {r.column_name: r for r in profile(df, exact=True, mode_columns=["s"]).collect()}
    pdf = df.toPandas()
    assert p["x"].row_count == len(pdf)
    assert p["x"].num_nulls == int(pdf.x.isna().sum())
    assert abs(p["x"].stddev - pdf.x.std()) < 1e-12
    assert p["s"].mode == "a" and p["s"].max_length == 2


def test_approx_quantiles_within_rank_error(spark):
    df = spark.range(10000).select((F.col("id") * 7 % 10000).cast("double").alias("x"))
    q = quantiles(df, ["x"], accuracy=1000).first()
    for got, p in ((q.p25, 0.25), (q.p50, 0.5), (q.p75, 0.75)):
        assert abs(got - p * 10000) <= 10000 / 1000 + 1


def test_monitor_refresh_incremental_equals_full(spark, tmp_root):
    df = _frame(spark)
    late = df.filter(F.col("ts").cast("date") == F.lit("2024-01-02").cast("date"))
    first = df.exceptAll(late)
    m = Monitor(spark, tmp_root, "t", "ts", "1 day", ["x", "s"]).create()
    m.run_refresh(first)
    m.run_refresh(df, changed=late)
    got = sorted((tuple(r) for r in m.read_profile().select("window_start", "column_name", "row_count").collect()),
                 key=str)
    full = sorted((tuple(r) for r in profile(df, ["x", "s"], "ts").select("window_start", "column_name",
                                                                         "row_count").collect()), key=str)
    assert got == full
    assert [r.kind for r in m.list_refreshes().orderBy("started_at").collect()] == ["full", "incremental"]
    assert m.get().first().granularity == "1 day"


def test_in_windows_covers_granularities(spark):
    from sluice.operators.profile import window_start
    from sluice.sinks.monitor import in_windows
    rows = [(dt.datetime(2024, m, d, h),) for m in (1, 2, 12) for d in (1, 15, 28) for h in (0, 13, 23)]
    df = spark.createDataFrame(rows + [(None,)], "ts timestamp_ntz")
    for g in ("1 hour", "1 day", "1 week", "1 month", "1 year"):
        w = window_start(F.col("ts"), g)
        for changed in (df.filter("ts is null or day(ts) = 15"), df.filter("month(ts) = 12"), df.filter("ts is null"), df.limit(0)):
            touched = changed.select(w.alias("window_start")).distinct()
            names = [r[0] for r in touched.select(F.col("window_start").cast("string")).collect()]
            want = df.filter(w.cast("string").isin([n for n in names if n]) | (w.isNull() if None in names else F.lit(False))).count()
            assert in_windows(df, "ts", touched, g).count() == want, g


def test_raw_values_of_rare_nulls_and_small_numbers(spark):
    df = spark.range(4_000_000).select(F.when(F.col("id") > 0, F.lit(4e-7)).alias("x"))
    p = profile(df).first()
    assert p.percent_null == 2.5e-7 and p.max == p.p50 == 4e-7 and abs(p.avg - 4e-7) < 1e-15


def test_decimals_dates_and_large_integers(spark):
    df = spark.sql("select cast(1.50 as decimal(20,4)) as d, date'2024-02-01' as day, timestamp_ntz'2024-02-01 01:02:03' as t, 9007199254740993 as n, 'b' as s, true as f "
                   "union all select cast(-20.25 as decimal(20,4)), date'2023-12-31', null, 2, 'a', false")
    p = {r.column_name: r for r in profile(df, exact=True).collect()}
    assert (p["d"].min, p["d"].max, p["d"].min_value, p["d"].max_value) == (-20.25, 1.5, "-20.25", "1.5")
    assert (p["day"].min_value, p["day"].max_value, p["t"].max_value) == ("2023-12-31", "2024-02-01", "2024-02-01 01:02:03")
    assert p["n"].max_value == "9007199254740993" and p["s"].min_value == "a" and p["f"].num_distinct == 2
    assert p["n"].min_value == "2" and p["s"].mode is None


def test_refreshes_drop_vanished_windows(spark, tmp_root):
    df = _frame(spark)
    m = Monitor(spark, tmp_root, "t", "ts", "1 day", ["x", "s"]).create()
    m.run_refresh(df)
    second = df.filter("date(ts) = '2024-01-02'")
    m.run_refresh(df.exceptAll(second), changed=second)
    windows = lambda: sorted({str(r.window_start) for r in m.read_profile().collect()})
    assert windows() == ["2024-01-01 00:00:00", "None"]
    m.run_refresh(second)
    assert windows() == ["2024-01-02 00:00:00"]


def test_profile_is_one_scan(spark, tmp_path):
    df = _frame(spark)
    df.write.parquet(str(tmp_path / "t"))
    plan = profile(spark.read.parquet(str(tmp_path / "t")), ts_col="ts", mode_columns=["s"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_decimals_of_every_precision_and_scale(spark):
    df = spark.sql("select cast('0.000000000001' as decimal(38,18)) as tiny, cast('123456789012345678901234567890123' as decimal(38,0)) as wide, cast(5 as smallint) as s "
                   "union all select cast('0.000000000002' as decimal(38,18)), cast('-7' as decimal(38,0)), null")
    for exact in (True, False):
        p = {r.column_name: r for r in profile(df, exact=exact).collect()}
        assert (p["tiny"].min_value, p["tiny"].max_value) == ("0.000000000001", "0.000000000002")
        assert (p["wide"].min_value, p["wide"].max_value) == ("-7", "123456789012345678901234567890123")
        assert p["s"].min_value == "5" and p["tiny"].min == 1e-12


def test_names_of_the_input_cannot_clash(spark):
    df = spark.sql("select 1 as window_start, 2 as column_name, 3 as c0, 4 as n, 5 as val, 6 as num, 7 as part, timestamp'2024-01-01 10:00:00' as ts")
    for exact in (True, False):
        p = {r.column_name: r.max for r in profile(df, ts_col="ts", exact=exact).collect()}
        assert p == {"window_start": 1, "column_name": 2, "c0": 3, "n": 4, "val": 5, "num": 6, "part": 7}


def test_exact_profile_holds_no_group_in_one_buffer(spark):
    """Neither percentiles nor modes nor distinct counts are aggregate buffers, and a window's values are spread over tasks."""
    from sluice.operators.selection import percentiles, written_in_ranges

    df = spark.range(200_000).selectExpr("id", "cast(case when id % 3 = 0 then 7 else id * 7919 % 100003 end as double) as x", "timestamp'2024-01-01 10:00:00' as ts")
    p = profile(df, ["x"], "ts", exact=True, mode_columns=["x"])
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "mode(" not in plan and "count(distinct" not in plan
    got, want = p.first(), df.toPandas().x
    assert [got.p25, got.p50, got.p75] == [want.quantile(q) for q in (0.25, 0.5, 0.75)] and got.mode == "7.0"
    assert got.num_distinct == want.nunique()
    counts = df.groupBy("x").count().withColumnRenamed("count", "n").withColumn("g", F.lit("one"))
    ranged = written_in_ranges(counts, ["g"], "x", 6)
    sizes = [r["count"] for r in ranged.groupBy("part").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 0.4 * sum(sizes)
    assert percentiles(counts, ["g"], "x", [0.0, 0.1, 0.999, 1.0], 6).first().q == pytest.approx([want.quantile(q) for q in (0.0, 0.1, 0.999, 1.0)], rel=1e-12)


def test_selection_of_small_and_null_groups(spark):
    from sluice.operators.selection import percentiles

    rows = [("a", 1.0, 3), ("a", 2.0, 1), ("b", 5.0, 1), (None, 1.0, 1), (None, 4.0, 1), ("c", None, 4)]
    got = {r.g: r.q for r in percentiles(spark.createDataFrame(rows, "g string, v double, n long"), ["g"], "v", [0.5, 0.25, 1.0]).collect()}
    assert got == {"a": [1.0, 1.0, 2.0], "b": [5.0, 5.0, 5.0], None: [2.5, 1.75, 4.0]}
    assert percentiles(spark.createDataFrame([], "g string, v double, n long"), ["g"], "v", [0.5]).collect() == []


def test_windows_of_any_length(spark):
    from sluice.operators.profile import window_starts

    def starts(ts, *how):
        df = spark.createDataFrame([(ts,)], "ts timestamp_ntz")
        return [None if w is None else str(w) for w in df.select(window_starts(F.col("ts"), *how)).first()[0]]

    at = dt.datetime(2024, 1, 1, 10, 50, 30)
    assert starts(at, "15 minutes") == ["2024-01-01 10:45:00"] and starts(at, "7 hours") == [str(dt.datetime.fromtimestamp(1704106230 // 25200 * 25200, dt.timezone.utc).replace(tzinfo=None))]
    assert starts(at, "1 hour", "20 minutes") == ["2024-01-01 10:40:00", "2024-01-01 10:20:00", "2024-01-01 10:00:00"]
    assert starts(at, "50 minutes", "20 minutes") == ["2024-01-01 10:40:00", "2024-01-01 10:20:00"]
    assert starts(None, "15 minutes") == starts(None, "1 hour", "20 minutes") == starts(None, "1 day") == [None]
    assert starts(dt.datetime(1969, 12, 31, 23, 50), "15 minutes") == ["1969-12-31 23:45:00"]
    for bad in (("5 parsecs",), ("0 minutes",), ("10 minutes", "20 minutes")):
        with pytest.raises(ValueError):
            window_starts(F.col("ts"), *bad)


def test_refresh_of_windows_that_cross_midnight(spark, tmp_root):
    rows = [(dt.datetime(2024, 1, d, h, 30), float(d * h)) for d in range(1, 6) for h in range(24)] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, x double")
    changed = df.filter("day(ts) = 3 and hour(ts) between 1 and 2 or ts is null")
    for i, how in enumerate([("7 hours", None), ("3 hours", "1 hour"), ("90 minutes", None), ("3 days", None), ("2 days", "1 day")]):
        m = Monitor(spark, f"{tmp_root}/{i}", "t", "ts", how[0], ["x"], exact=True, slide=how[1]).create()
        m.run_refresh(df.exceptAll(changed))
        m.run_refresh(df, changed=changed)
        key = lambda r: (str(r.window_start), r.row_count, r.min, r.max, r.p50)
        assert sorted(map(key, m.read_profile().collect())) == sorted(map(key, profile(df, ["x"], "ts", how[0], exact=True, slide=how[1]).collect())), how


def test_sketch_store_adds_replays_replaces_and_compacts(spark, tmp_root):
    from sluice.operators.sketches import DISTINCT_ERROR, RANK_ERROR
    from sluice.sinks.sketch_store import SketchStore

    df = spark.range(60_000).selectExpr("case when id % 50 = 0 then null else timestamp_seconds(1704067200 + id * 7) end as ts", "cast(id * 7919 % 20011 as double) as x",
                                        "case when id % 9 = 0 then null when id % 3 = 0 then 'often' else concat('v', id % 500) end as s", "id")
    store = SketchStore(spark, tmp_root, ["x", "s"], "ts", "1 hour", ["s"])
    for version, part in ((0, 0), (1, 1), (0, 0), (1, 1)):
        store.add(df.filter(F.col("id") % 2 == part), version)

    def check(source):
        want = {(str(r.window_start), r.column_name): r for r in profile(source, ["x", "s"], "ts", "1 day", exact=True, mode_columns=["s"]).collect()}
        got = {(str(r.window_start), r.column_name): r for r in store.read("1 day").collect()}
        assert set(got) == set(want)
        for k, g in got.items():
            w = want[k]
            for c in ("row_count", "num_nulls", "percent_null", "num_zeros", "min", "max", "min_length", "max_length", "avg_length", "mode"):
                assert getattr(g, c) == getattr(w, c), (k, c)
            assert abs(g.num_distinct - w.num_distinct) <= max(1, DISTINCT_ERROR * w.num_distinct)
            if w.avg is not None:
                assert abs(g.avg - w.avg) < 1e-9 * abs(w.avg) and abs(g.stddev - w.stddev) < 1e-9 * w.stddev
                values = sorted(r.x for r in source.filter(F.date_trunc("day", "ts").cast("string").eqNullSafe(F.lit(None if k[0] == "None" else k[0]))).select("x").collect())
                for q in ("p25", "p50", "p75"):
                    rank = sum(v <= getattr(g, q) for v in values) / len(values)
                    assert abs(rank - int(q[1:]) / 100) <= RANK_ERROR + 1 / len(values)

    check(df)
    gone = df.filter("hour(ts) = 3 or day(ts) = 2")
    store.replace(df.exceptAll(gone), gone, 2)
    check(df.exceptAll(gone))
    store.compact(3)
    assert store.parts().groupBy("window_start", "column_name").count().filter("count > 1").count() == 0
    check(df.exceptAll(gone))
    store.add(gone, 4)
    check(df)


def test_sketches_of_nothing(spark, tmp_root):
    from sluice.operators.sketches import merged, slices

    df = spark.createDataFrame([(None, None, None)], "ts timestamp, x double, s string")
    for r in merged(slices(df, ["x", "s"], "ts", "1 day", ["s"])).collect():
        assert (r.row_count, r.num_nulls, r.num_distinct, r.min, r.p50, r.mode, r.avg_length) == (1, 1, 0, None, None, None, None)
    assert merged(slices(df.limit(0), ["x"], "ts", "1 day")).collect() == []
