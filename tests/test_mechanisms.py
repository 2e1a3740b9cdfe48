import datetime as dt

from pyspark.sql import functions as F

from sluice.functions.rules import Rule
from sluice.operators.dedupe import first_by_event_time
from sluice.sinks.bucketed import BucketedTable
from sluice.sinks.catalog import save_table, table_properties
from sluice.sources.synth import bronze_spec, synth, synth_stream
from sluice.sources.tables import read_stream
from sluice.streaming.bronze_to_silver import batch_folder_sink, run_to_end
from sluice.streaming.progress import ExpectationsListener, observed_expectations

SCHEMA = "k int, ts timestamp, v string"
at = lambda h, m=0: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h, minutes=m)


def _won(spark, root, batches, **how):
    """(k, v) put out by each run of the stream over one more file."""
    out = []
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = first_by_event_time(read_stream(spark, f"{root}/in", spark.createDataFrame([], SCHEMA).schema), ["k"], "ts", "2 hours", "1 hour", **how)
        run_to_end(stream.writeStream.foreachBatch(batch_folder_sink(f"{root}/rows")).option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start())
        rows = spark.read.option("basePath", f"{root}/rows").parquet(f"{root}/rows/_batch_id=*").collect()
        out.append(sorted((str(r.k), r.v) for r in rows))
    return out


def test_first_by_event_time_has_a_winner_and_an_end(spark, tmp_root):
    batches = [[(1, at(1), "b"), (1, at(2), "c"), (None, at(1), "n"), (None, at(1, 30), "m")],
               [(1, at(0, 30), "a"), (2, at(2), "x")],                      # earlier, but in time: it wins
               [(3, at(9), "later")],                                       # moves the watermark past the sessions' ends
               [(1, at(1), "too late"), (1, at(9), "again"), (2, None, "no time")],
               [(9, at(30), "end")]]
    got = _won(spark, tmp_root, batches)
    assert got[0] == got[1] == [] and got[2] == [("1", "a"), ("2", "x"), ("None", "n")] == got[3]
    assert got[4] == [("1", "a"), ("1", "again"), ("2", "x"), ("3", "later"), ("None", "n")]


def test_ties_in_time_go_by_the_given_order(spark, tmp_root):
    rows = [(1, at(1), v) for v in "cab"]
    assert _won(spark, tmp_root, [rows, [(2, at(20), "end")]], order_by=["v"])[1] == [("1", "a")]


def test_generated_stream_goes_on_and_equals_the_batch(spark, tmp_root):
    for _ in range(3):
        run_to_end(synth_stream(spark, bronze_spec(), 40, 1000).writeStream.foreachBatch(batch_folder_sink(f"{tmp_root}/rows"))
                   .option("checkpointLocation", f"{tmp_root}/c").trigger(availableNow=True).start())
    got = spark.read.option("basePath", f"{tmp_root}/rows").parquet(f"{tmp_root}/rows/_batch_id=*").drop("_batch_id")
    want = synth(spark.range(1000, 1120), bronze_spec())
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_listener_writes_by_batch(spark, tmp_root):
    import time

    rules = [Rule("big", "id > 5", "drop"), Rule("odd name's", "id % 2 = 1", "warn")]
    listener = ExpectationsListener(spark, rules, f"{tmp_root}/m")
    spark.streams.addListener(listener)
    try:
        for lo, hi in ((0, 10), (10, 13)):
            spark.range(lo, hi).coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
            stream = observed_expectations(read_stream(spark, f"{tmp_root}/in", spark.range(1).schema), rules)
            run_to_end(stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_root}/c").trigger(availableNow=True).start())
        end = time.time() + 60
        rows = []
        while len(rows) < 4 and time.time() < end:
            time.sleep(0.3)
            try:
                rows = sorted(tuple(r) for r in listener.read().collect())
            except Exception:
                rows = []
    finally:
        spark.streams.removeListener(listener)
    assert rows == [(0, "big", "drop", 4, 6), (0, "odd name's", "warn", 5, 5), (1, "big", "drop", 3, 0), (1, "odd name's", "warn", 1, 2)]


def test_feed_makes_a_copy_equal_to_the_table(spark, tmp_root):
    table, copy = (BucketedTable(spark, f"{tmp_root}/{n}", ["k"], b) for n, b in (("table", 4), ("copy", 3)))
    frames = [spark.createDataFrame(rows, "k int, v string") for rows in ([(1, "a"), (2, "b"), (None, "n")], [(2, "c"), (3, "d")], [(1, "e"), (None, "m")])]
    key = lambda d: sorted((str(r.k), r.v) for r in d.collect())
    for i, rows in enumerate(frames):
        table.write_feed(rows, f"{tmp_root}/feed/{i}")
        table.upsert(rows, f"v{i}")
        table.write_feed(rows, f"{tmp_root}/feed/{i}")  # a replay finds the table changed already: the feed stays
        feed = spark.read.parquet(f"{tmp_root}/feed/{i}")
        assert feed.count() > 0
        for _ in range(2):
            copy.apply_feed(feed, f"v{i}")
        assert key(copy.read()) == key(table.read()), i
    gone = spark.createDataFrame([(1, "e", "delete"), (3, "d", "delete")], "k int, v string, _change_type string")
    copy.apply_feed(gone, "v9")
    assert key(copy.read()) == [("2", "c"), ("None", "m"), ("None", "n")]


def _parts(root):
    import os
    from sluice.session import local_path
    return {f for _, _, names in os.walk(local_path(root) + "/data/_bucket=0") for f in names if f.startswith("part-")}


def test_a_replay_rewrites_nothing_and_changes_shuffle_once(spark, tmp_root, tiny_rules):
    from sluice.sinks.quarantine import QuarantineSink
    from sluice.streaming.bronze_to_silver import SilverTarget, process_batch

    table, copy = (BucketedTable(spark, f"{tmp_root}/{n}", ["id"], b) for n, b in (("table", 1), ("copy", 1)))
    target = SilverTarget("t", table, ["id", "quantity", "address", "date"], ["id"], tiny_rules, QuarantineSink(spark, f"{tmp_root}/q"),
                          order_by=["date"], feed_path=f"{tmp_root}/feed")
    rows = lambda *r: spark.createDataFrame(list(r), "id bigint, quantity int, address string, date string").withColumn("date", F.col("date").cast("date"))
    first, second = rows((1, 1, "Texas", "2024-01-01"), (2, 2, "Texas", "2024-01-01")), rows((2, 5, "Texas", "2024-02-01"), (3, 6, "Texas", "2024-02-01"))
    seen = []
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        process_batch(target, batch, batch_id, "q")
        copy.apply_feed(spark.read.parquet(f"{tmp_root}/feed/_query=q/_batch_id={batch_id}"), f"v{batch_id}")
        assert sorted(copy.read().collect()) == sorted(table.read().collect())
        seen.append((_parts(table.root), _parts(copy.root)))
    assert seen[0] != seen[1] == seen[2]  # the replay leaves the files as they are
    assert sorted((r.id, r.quantity) for r in table.read().collect()) == [(1, 1), (2, 5), (3, 6)]
    table.replace(table.read().filter("id <> 3").withColumn("quantity", F.lit(9)), [0])  # a try that died: the replay makes it whole
    process_batch(target, second, 1, "q")
    assert sorted((r.id, r.quantity) for r in table.read().collect()) == [(1, 9), (2, 5), (3, 6)]
    plan = table.changes(second)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") <= 1 and "Join" not in plan


def test_the_stored_bronze_holds_the_columns_asked_for(spark):
    from conftest import SF0001
    from sluice.sources import fixtures as fx

    got, want = fx.stored_bronze(spark, SF0001, ["sales_id", "date"]), fx.bronze(spark, SF0001).select("sales_id", "date")
    assert got.columns == ["sales_id", "date"] and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_properties_by_prefix(spark, tmp_root):
    name = "props_" + tmp_root.rsplit("/", 1)[-1]
    save_table(spark.range(3), name, "three", {"a.x": "1", "a.y": "it's", "b.x": "3"})
    assert sorted((r.key, r.value) for r in table_properties(spark, name, "a.").collect()) == [("a.x", "1"), ("a.y", "it's")]
    assert "b.x" in {r.key for r in table_properties(spark, name).collect()} and spark.catalog.getTable(name).description == "three"


def test_entry_point_without_the_libraries_of_llm(tmp_path):
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['ahocorasick'] = sys.modules['tiktoken'] = sys.modules['public_tokenizers'] = None\n"
            "import __spark_entry__ as e; assert len(e.queries()) > 50 and not any(q.startswith('op') for q in e.queries()); print('fine')")
    got = subprocess.run([sys.executable, "-c", code], cwd=here, capture_output=True, text=True)
    assert got.stdout.strip() == "fine", got.stderr


def test_ties_are_read_once(spark):
    from sluice.operators.dedupe import dedupe_latest

    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (None, 5, "d")], "k int, o int, v string")
    got = dedupe_latest(rows, ["k"], ["o"], ties="all")
    assert sorted(r.v for r in got.collect()) == ["b", "c", "d"]
    assert "LocalTableScan" not in got._jdf.queryExecution().executedPlan().toString()
