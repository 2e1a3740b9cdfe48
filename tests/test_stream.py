import datetime as dt

from pyspark.sql import functions as F

from sluice.functions.rules import Rule
from sluice.sinks.bucketed import BucketedTable
from sluice.sinks.quarantine import QuarantineSink
from sluice.sources.tables import read_stream
from sluice.streaming.bronze_to_silver import (SilverTarget, batch_folder_sink, bronze_to_silver,
                                               process_batch, run_to_end)
from sluice.operators.dedupe import dedupe_stream

SCHEMA = "id bigint, quantity int, address string, date date"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _count_run(spark, root, dedupe):
    def start(name):
        s = read_stream(spark, f"{root}/src", spark.createDataFrame([], SCHEMA).schema)
        s = dedupe_stream(s, ["id"]) if dedupe else s
        return (s.writeStream.foreachBatch(batch_folder_sink(f"{root}/{name}"))
                 .option("checkpointLocation", f"{root}/ck_{name}").trigger(availableNow=True).start())
    return start


def test_stream_dedupe_two_runs_one_checkpoint(spark, tmp_root, tiny):
    # FIXTURES §4: run 1 / run 2 pass 4 / 1 rows with stream dedupe, 6 / 4 without
    tiny.write.parquet(f"{tmp_root}/src")
    d, p = _count_run(spark, tmp_root, True), _count_run(spark, tmp_root, False)
    run_to_end(d("dedup")), run_to_end(p("plain"))
    first = (spark.read.parquet(f"{tmp_root}/dedup").count(), spark.read.parquet(f"{tmp_root}/plain").count())
    day = dt.date(2024, 1, 1)
    _rows(spark, [(1, 1, "Texas", day), (2, 1, "Texas", day), (3, 1, "Texas", day), (9, 1, "Texas", day)]) \
        .write.mode("append").parquet(f"{tmp_root}/src")
    run_to_end(d("dedup")), run_to_end(p("plain"))
    second = (spark.read.parquet(f"{tmp_root}/dedup").count() - first[0],
              spark.read.parquet(f"{tmp_root}/plain").count() - first[1])
    assert first == (4, 6) and second == (1, 4)


def _target(spark, root, rules, **kw):
    return SilverTarget("t", BucketedTable(spark, f"{root}/silver", ["id"]), ["id", "quantity", "address", "date"],
                        ["id"], rules, QuarantineSink(spark, f"{root}/quarantine"), order_by=["date"],
                        metrics_path=f"{root}/metrics", **kw)


def test_bronze_to_silver_updates_across_runs(spark, tmp_root, tiny, tiny_rules):
    tiny.write.parquet(f"{tmp_root}/src")
    target = _target(spark, tmp_root, tiny_rules)
    run_to_end(bronze_to_silver(read_stream(spark, f"{tmp_root}/src", tiny.schema), target, f"{tmp_root}/ck"))
    assert [r.id for r in target.table.read().collect()] == [1]
    _rows(spark, [(1, 2, "Texas", dt.date(2024, 3, 1)), (5, 1, "Texas", dt.date(2024, 3, 1))]) \
        .write.mode("append").parquet(f"{tmp_root}/src")
    run_to_end(bronze_to_silver(read_stream(spark, f"{tmp_root}/src", tiny.schema), target, f"{tmp_root}/ck"))
    assert sorted((r.id, r.quantity) for r in target.table.read().collect()) == [(1, 2), (5, 1)]
    m = spark.read.parquet(f"{tmp_root}/metrics").agg(F.sum("total_rows"), F.sum("input_rows"),
                                                      F.sum("removed_by_dedupe")).first()
    assert tuple(m) == (4 + 2, 6 + 2, 2)  # deduped rows, rows in, rows removed by dedupe (null ids are one key)
    assert target.quarantine.read().filter("_batch_id = 0").count() == 3


def test_replayed_batch_is_exactly_once(spark, tmp_root, tiny, tiny_rules):
    target = _target(spark, tmp_root, tiny_rules)
    process_batch(target, tiny, 0, "q")
    process_batch(target, tiny, 0, "q")  # retry of the same batch
    assert target.table.read().count() == 1
    assert target.quarantine.read().count() == 3


def test_rules_read_each_batch(spark, tmp_root, tiny):
    current = [[Rule("q", "quantity > 0")]]
    target = _target(spark, tmp_root, lambda: current[0])
    process_batch(target, tiny, 0, "q")
    current[0] = [Rule("q", "quantity > 100")]
    process_batch(target, tiny, 1, "q")
    assert target.quarantine.read().filter("_batch_id = 1").count() == 4


def test_validate_first_keeps_valid_duplicate(spark, tmp_root):
    rows = [(1, 5, "Texas", dt.date(2024, 1, 1)), (1, -1, "Texas", dt.date(2024, 2, 1))]
    df = _rows(spark, rows)
    rules = [Rule("q", "quantity > 0")]
    t1 = _target(spark, f"{tmp_root}/a", rules)
    process_batch(t1, df, 0, "q")
    assert t1.table.read().count() == 0  # the newer, invalid duplicate displaced the valid one (S3)
    t2 = _target(spark, f"{tmp_root}/b", rules, validate_first=True)
    process_batch(t2, df, 0, "q")
    assert [r.quantity for r in t2.table.read().collect()] == [5]


def test_several_targets_from_one_stream(spark, tmp_root, tiny):
    tiny.write.parquet(f"{tmp_root}/src")
    from sluice.streaming.bronze_to_silver import bronze_to_silvers
    t_ids = SilverTarget("ids", BucketedTable(spark, f"{tmp_root}/ids", ["id"]), ["id", "date"], ["id"],
                         [Rule("nn", "id IS NOT NULL")], QuarantineSink(spark, f"{tmp_root}/q_ids"), order_by=["date"])
    t_addr = SilverTarget("addr", BucketedTable(spark, f"{tmp_root}/addr", ["address"]), ["address", "date"],
                          ["address"], [Rule("nn", "address IS NOT NULL")], QuarantineSink(spark, f"{tmp_root}/q_addr"),
                          order_by=["date"])
    run_to_end(bronze_to_silvers(read_stream(spark, f"{tmp_root}/src", tiny.schema), [t_ids, t_addr],
                                 f"{tmp_root}/ck"))
    assert sorted(r.id for r in t_ids.table.read().collect()) == [1, 2, 3]
    assert sorted(r.address for r in t_addr.table.read().collect()) == ["Texas", "Washington"]


def test_stream_view_over_catalog_table(spark, tiny):
    from sluice.sinks.catalog import save_table, table_properties
    from sluice.sources.tables import stream_view
    save_table(tiny, "bronze_tiny", comment="raw", properties={"quality": "bronze", "quality.constraint.x": "1"})
    assert table_properties(spark, "bronze_tiny", "quality.cons").count() == 1
    s = stream_view(spark, "bronze_tiny", "bronze_tiny_v")
    assert s.isStreaming
    out = spark.sql("select id from bronze_tiny_v where id is not null")
    q = out.writeStream.format("memory").queryName("tiny_out").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("tiny_out").count() == 4


def test_bad_rule_fails_before_any_write(spark, tmp_root, tiny):
    import pytest
    target = _target(spark, tmp_root, [Rule("bad", "no_such_column > 0")])
    with pytest.raises(ValueError, match="bad"):
        process_batch(target, tiny, 0, "q")
    assert not target.table.exists()


def test_crash_in_the_middle_of_a_batch_recovers(spark, tmp_root, tiny, tiny_rules, monkeypatch):
    import pytest
    target = _target(spark, tmp_root, tiny_rules)
    process_batch(target, tiny, 0, "q")
    second = _rows(spark, [(1, 9, "Texas", dt.date(2024, 5, 1)), (7, 1, "Texas", dt.date(2024, 5, 1))])
    real = BucketedTable._write

    def crash(self, rows):
        real(self, rows)
        raise RuntimeError("driver lost after the buckets, before the metrics")
    monkeypatch.setattr(BucketedTable, "_write", crash)
    with pytest.raises(RuntimeError):
        process_batch(target, second, 1, "q")
    monkeypatch.setattr(BucketedTable, "_write", real)
    process_batch(target, second, 1, "q")  # the retry of the same batch
    assert sorted((r.id, r.quantity) for r in target.table.read().collect()) == [(1, 9), (7, 1)]
    assert target.quarantine.read().filter("_batch_id = 1").count() == 0


def test_first_wins_counts_source_rows(spark, tmp_root):
    from sluice.streaming.bronze_to_silver import source_rows
    df = _rows(spark, [(1, 5, "Texas", None), (1, 6, "Texas", None), (1, 7, "Texas", None)])
    df.write.parquet(f"{tmp_root}/src")
    target = _target(spark, tmp_root, [Rule("q", "quantity > 0")])
    q = bronze_to_silver(read_stream(spark, f"{tmp_root}/src", df.schema), target, f"{tmp_root}/ck", first_wins=True)
    run_to_end(q)
    assert source_rows(q) == {0: 3}
    m = spark.read.parquet(f"{tmp_root}/metrics").first()
    assert (m.input_rows, m.removed_by_dedupe) == (1, 0)  # what the batch got: the stream had removed two of the three


def test_first_wins_with_watermark(spark, tmp_root):
    rows = [(1, 5, "Texas", dt.date(2024, 1, 1)), (1, 6, "Texas", dt.date(2024, 1, 1)),
            (2, 7, "Texas", dt.date(2024, 1, 2))]
    df = _rows(spark, rows).withColumn("ts", F.col("date").cast("timestamp"))
    df.write.parquet(f"{tmp_root}/src")
    target = SilverTarget("t", BucketedTable(spark, f"{tmp_root}/silver", ["id"]), ["id", "quantity", "ts"], ["id"],
                          [Rule("q", "quantity > 0")], QuarantineSink(spark, f"{tmp_root}/q"), order_by=["ts"])
    q = bronze_to_silver(read_stream(spark, f"{tmp_root}/src", df.schema), target, f"{tmp_root}/ck",
                         first_wins=True, watermark=("ts", "1 day"))
    run_to_end(q)
    got = sorted(r.id for r in target.table.read().collect())
    assert got == [1, 2]  # one row per key passed the stream-level dedupe
