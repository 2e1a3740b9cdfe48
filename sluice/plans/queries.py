"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver tables (or data Spark derives from them) in full,
so its work grows with the scale factor.  Output columns are aliased to the
names the oracle SQL in :mod:`sluice.plans.oracle` uses; dates and timestamps
are rendered as ISO strings so both engines hash them the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import with_process_timestamp
from ..functions.predicates import violation_condition
from ..functions.rules import Rule, collect_rules, normalise_statements, rules_by_tag as _rules_by_tag
from ..operators.dedupe import dedupe_any, dedupe_latest, dedupe_stream
from ..operators.expectations import apply_expectations, expect_all_or_drop, expectation_metrics
from ..operators.split import FAILED_COL, STATUS_COL, judge, rule_failure_counts, split
from ..operators.profile import profile as _profile
from ..operators.scd import prepare_changes, scd1_state, scd1_view, scd2, scd2_apply
from ..operators.upsert import change_feed as _change_feed, upsert
from ..sources import fixtures as fx
from ..sources.synth import bronze_spec, continue_ids, dirty_spec, synth
from ..sources.tables import read_table
from ..sources.rules import (FIXTURE_RULES, FIXTURE_TAGGED_RULES, documents_frame, publish_documents, published_rules,
                             rule_documents, tagged_rules_frame)
from ..session import path_exists
from .silver import catalogue_rules, silver_batch

# The declarative path's six expectations (three drop, three warn), fixture form.
EXPECTATIONS = [
    Rule("valid_sales_id", "sales_id IS NOT NULL", "drop"),
    Rule("valid_client_id", "client_id IS NOT NULL", "drop"),
    Rule("valid_product_id", "product_id IS NOT NULL", "drop"),
    Rule("valid_quantity", "quantity > 0", "warn"),
    Rule("valid_address", "address in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')", "warn"),
    Rule("valid_date", "date between '1995-06-01' and '2001-06-01'", "warn"),
]

# Dimension silvers take the latest bronze row per key; (date, sales_id, sale_amount,
# l_suppkey) is a total order on the fixture bronze, so the pick is deterministic.
DIM_ORDER = ["date", "sales_id", "sale_amount", "l_suppkey"]


def _reasons() -> F.Column:
    return F.array_join(F.array_sort(F.col(FAILED_COL)), ",").alias("reasons")


def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: fixture bronze -> latest row per sales_id -> judged by the sales
    rules; every deduped row with its status and sorted reasons."""
    rules = catalogue_rules(spark, "silver_sales")
    judged = silver_batch(fx.bronze(spark, sf_dir), fx.SALES_COLUMNS, ["sales_id"], rules,
                          order_by=fx.SALES_ORDER, carry=["l_suppkey"])
    return judged.select("sales_id", "client_id", "product_id", F.col("date").cast("string").alias("date"),
                         "quantity", "sale_amount", F.col(STATUS_COL).alias("status"), _reasons())


def _sales_judged(spark, sf_dir, rules=None, null_policy="quarantine"):
    rules = catalogue_rules(spark, "silver_sales") if rules is None else rules
    return silver_batch(fx.bronze(spark, sf_dir), fx.SALES_COLUMNS, ["sales_id"], rules,
                        order_by=fx.SALES_ORDER, carry=["l_suppkey"], null_policy=null_policy)


def _valid(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(STATUS_COL) == "valid").drop(FAILED_COL, STATUS_COL)


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of the sales silver."""
    v = _valid(_sales_judged(spark, sf_dir))
    return v.select("sales_id", "client_id", "product_id", F.col("date").cast("string").alias("date"),
                    "quantity", "sale_amount")


def silver_validate_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 option: validate before dedupe, so an invalid newer duplicate cannot displace
    a valid older one; keys with no valid row keep their latest invalid row."""
    rules = catalogue_rules(spark, "silver_sales")
    j = silver_batch(fx.bronze(spark, sf_dir), fx.SALES_COLUMNS, ["sales_id"], rules,
                     order_by=fx.SALES_ORDER, carry=["l_suppkey"], validate_first=True)
    return j.select("sales_id", "client_id", "product_id", F.col("date").cast("string").alias("date"),
                    "quantity", "sale_amount", F.col(STATUS_COL).alias("status"), _reasons())


def silver_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of the clients silver: latest bronze row per client_id."""
    rules = catalogue_rules(spark, "silver_clients")
    j = silver_batch(fx.bronze(spark, sf_dir), fx.CLIENT_COLUMNS, ["client_id"], rules,
                     order_by=DIM_ORDER, carry=DIM_ORDER)
    return _valid(j).select("client_id", "address", F.col("signup_date").cast("string").alias("signup_date"))


def silver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid rows of the products silver: latest bronze row per product_id."""
    rules = catalogue_rules(spark, "silver_products")
    j = silver_batch(fx.bronze(spark, sf_dir), fx.PRODUCT_COLUMNS, ["product_id"], rules,
                     order_by=DIM_ORDER, carry=DIM_ORDER)
    return _valid(j).select("product_id", "product_name", "category", "price")


def _shared_rules(spark) -> list[Rule]:
    """Sales rules plus the clients' address rule: one shared stream checked against all."""
    return catalogue_rules(spark, "silver_sales") + [
        r for r in catalogue_rules(spark, "silver_clients") if r.name == "validAddress"]


def rule_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-rule failing-row counts on the deduped sales rows."""
    rules = _shared_rules(spark)
    j = silver_batch(fx.bronze(spark, sf_dir), fx.SALES_COLUMNS + ["address"], ["sales_id"], rules,
                     order_by=fx.SALES_ORDER, carry=["l_suppkey"])
    return rule_failure_counts(j, rules)


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined sales rows per reason set, with the quantity they carry."""
    q = _sales_judged(spark, sf_dir).filter(F.col(STATUS_COL) == "quarantine")
    return (q.groupBy(F.array_join(F.array_sort(F.col(FAILED_COL)), ",").alias("reasons"))
             .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("sum_quantity")))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch counts as ``(metric, value)``: rows in, rows left by the dedupe, valid,
    quarantined (D6, G1, G2) - one scan: the latest row of a key carries its row count."""
    bronze = fx.bronze(spark, sf_dir)
    row = F.struct(*fx.SALES_ORDER, *[c for c in fx.SALES_COLUMNS if c not in fx.SALES_ORDER])
    latest = bronze.groupBy("sales_id").agg(F.max(row).alias("r"), F.count(F.lit(1)).alias("rows")).select("r.*", "rows")
    judged = judge(latest, catalogue_rules(spark, "silver_sales"))
    status = F.col(STATUS_COL)
    counts = judged.agg(F.sum("rows").alias("a"), F.count(F.lit(1)).alias("b"), F.count_if(status == "valid").alias("c"),
                        F.count_if(status == "quarantine").alias("d"), F.count_if(status == "unknown").alias("e"))
    return counts.selectExpr("stack(5, 'input_rows', a, 'deduped_rows', b, 'valid_rows', c, 'quarantined_rows', d, "
                             "'unknown_rows', e) as (metric, value)")


def violation_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 + D5: what ``violation_condition`` and ``split`` do with each deduped row under
    each null policy; a row that is in neither part is lost."""
    rules = _shared_rules(spark)
    d = dedupe_latest(fx.bronze(spark, sf_dir).select(*fx.SALES_COLUMNS, "address", "l_suppkey"), ["sales_id"], fx.SALES_ORDER)
    flags = [violation_condition(rules, p).alias(f"violates_{p}") for p in ("quarantine", "pass", "drop")]
    parts = [part.select("sales_id", F.lit(name).alias("part")) for name, part in zip(("valid", "quarantine"), split(d, rules, "drop"))]
    kept = parts[0].unionByName(parts[1])
    return d.select("sales_id", *flags).join(kept, "sales_id", "left")


def null_policy_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status of each deduped row under the three null policies, six shared rules."""
    rules = _shared_rules(spark)
    base = fx.bronze(spark, sf_dir).select(*fx.SALES_COLUMNS, "address", "l_suppkey")
    d = dedupe_latest(base, ["sales_id"], fx.SALES_ORDER)
    out = d
    for policy in ("quarantine", "pass", "drop"):
        out = judge(out, rules, policy).withColumnRenamed(STATUS_COL, f"status_{policy}") \
            .drop(FAILED_COL, "_unknown_rules")
    return out.select("sales_id", "status_quarantine", "status_pass", "status_drop")


def expect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warn and drop expectations counted over every bronze row."""
    return expectation_metrics(fx.bronze(spark, sf_dir), EXPECTATIONS)


def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows kept by the three drop expectations; warn rules keep rows."""
    kept, _ = apply_expectations(fx.bronze(spark, sf_dir), EXPECTATIONS)
    return kept.select("sales_id", "client_id", "product_id", "quantity",
                       F.col("date").cast("string").alias("date"), "l_suppkey")


def expect_all_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``expect_all_or_drop(get_rules('sales'))`` on bronze."""
    rules = _rules_by_tag(tagged_rules_frame(spark, FIXTURE_TAGGED_RULES), "sales")
    kept = expect_all_or_drop(fx.bronze(spark, sf_dir), rules)
    return kept.select("sales_id", "client_id", "product_id", "quantity",
                       F.col("date").cast("string").alias("date"), "l_suppkey")


def rules_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule documents -> one row per statement (A3, D1, H1, H9), each with the number
    of bronze rows that violate it."""
    stmts = normalise_statements(documents_frame(spark, rule_documents(FIXTURE_RULES)))
    rules = collect_rules(stmts)
    counts = rule_failure_counts(judge(fx.bronze(spark, sf_dir), rules), rules)
    return (stmts.join(counts, stmts.name == counts.rule_name)
                 .select(F.col("table_name").alias("tableName"), F.col("statement"), "failed_rows"))


def rules_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements normalised to ``(kind, name, expression)`` (D2), published, read back and
    merged with the not-null rules of each declared schema (D1, D4), then bound to the
    table's deduped silver projection: failing and unknown rows per rule."""
    from ..session import scratch_path

    path = scratch_path(spark, "rules")
    stmts = normalise_statements(publish_documents(spark, rule_documents(FIXTURE_RULES), path))
    bronze = fx.stored_bronze(spark, sf_dir)
    parts = []
    targets = {"silver_sales": (fx.SALES_COLUMNS, ["sales_id"], fx.SALES_ORDER, ["l_suppkey"]),
               "silver_clients": (fx.CLIENT_COLUMNS, ["client_id"], DIM_ORDER, DIM_ORDER),
               "silver_products": (fx.PRODUCT_COLUMNS, ["product_id"], DIM_ORDER, DIM_ORDER)}
    for table, (cols, keys, order, carry) in targets.items():
        rules = published_rules(spark, path, table, fx.declared(keys))
        j = silver_batch(bronze, cols, keys, rules, order_by=order, carry=carry, null_policy="drop")
        aggs = []
        for i, r in enumerate(rules):
            aggs += [F.count_if(~F.coalesce(r.column(), F.lit(True))).alias(f"f{i}"),
                     F.count_if(r.column().isNull()).alias(f"u{i}")]
        body = ", ".join(f"'{r.name}', f{i}, u{i}" for i, r in enumerate(rules))
        parts.append(j.agg(*aggs).selectExpr(
            f"'{table}' as table_name", f"stack({len(rules)}, {body}) as (name, failed_rows, unknown_rows)"))
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    return (stmts.join(counts, ["table_name", "name"])
                 .select("table_name", "kind", "name", "expression", "failed_rows", "unknown_rows"))


def rules_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged rules collapsed per tag (D10, A4, C3), each checked over bronze."""
    tagged = tagged_rules_frame(spark, FIXTURE_TAGGED_RULES)
    tags = [r["tag"] for r in tagged.select("tag").distinct().orderBy("tag").collect()]
    rules = [Rule(n, e, "warn", tag=t) for t in tags for n, e in _rules_by_tag(tagged, t).items()]
    wide = fx.bronze(spark, sf_dir).agg(*[F.count_if(~F.coalesce(r.column(), F.lit(False))).alias(f"f{i}")
                                          for i, r in enumerate(rules)])
    body = ", ".join(f"'{r.tag}', '{r.name}', f{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {body}) as (tag, name, failed_rows)")


def dedupe_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly one latest row per sales_id."""
    d = dedupe_latest(fx.bronze(spark, sf_dir), ["sales_id"], fx.SALES_ORDER)
    return d.select("sales_id", F.col("date").cast("string").alias("date"), "sale_amount", "l_suppkey", "quantity")


def dedupe_rank_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rank() == 1`` by date only: rows tied on the latest date all stay."""
    d = dedupe_latest(fx.bronze(spark, sf_dir), ["sales_id"], ["date"], ties="all")
    return d.select("sales_id", F.col("date").cast("string").alias("date"), "sale_amount", "l_suppkey")


def dedupe_any_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dropDuplicates(client_id)``: which row survives is arbitrary, so only the keys
    are checked; the null key is one key (E2, S7)."""
    return dedupe_any(fx.bronze(spark, sf_dir), ["client_id"]).select("client_id")


# The batch boundary of the two-batch scenarios.
UPSERT_CUTOFF = "1998-08-01"          # sales shipped before it form the first silver load
LATE_FROM, LATE_TO = "2024-01-20", "2024-01-25"  # events of these days arrive in a later batch


def upsert_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver sales of early shipments, upserted with the silver of later ones
    (keys present in both take the later batch's row)."""
    rules = catalogue_rules(spark, "silver_sales")
    bronze = fx.stored_bronze(spark, sf_dir)
    early = bronze.filter(F.col("date") < F.lit(UPSERT_CUTOFF).cast("date"))
    late = bronze.filter(~(F.col("date") < F.lit(UPSERT_CUTOFF).cast("date")))

    def silver(b):
        return _valid(silver_batch(b, fx.SALES_COLUMNS, ["sales_id"], rules, order_by=fx.SALES_ORDER,
                                   carry=["l_suppkey"]))
    out = upsert(silver(early), silver(late), ["sales_id"], check=False)  # the dedupe has made keys unique
    return out.select("sales_id", "client_id", "product_id", F.col("date").cast("string").alias("date"),
                      "quantity", "sale_amount")


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])


def _late_split(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    day = F.col("ts").cast("date")
    late = day.between(F.lit(LATE_FROM).cast("date"), F.lit(LATE_TO).cast("date"))
    late = F.coalesce(late, F.lit(False))  # a row without a timestamp comes first
    return ev.filter(~late), ev.filter(late)


def _cut(df: DataFrame) -> DataFrame:
    """Cut lineage between batches with a reliable checkpoint in the shared folder."""
    from ..session import checkpoint_root

    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """type 1 state per user, sequence = event_id."""
    p = prepare_changes(_events(spark, sf_dir), ["user_id"], "event_id",
                        ["user_id", "event_type", "value", "ts"])
    st = scd1_view(scd1_state(p, ["user_id"]))
    return st.select("user_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))


def scd1_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + F4, incremental: 'error' events delete the user; a later batch brings late
    rows that must neither overwrite newer state nor revive deleted users."""
    first, late = _late_split(_events(spark, sf_dir))
    kw = dict(keys=["user_id"], sequence_by="event_id", columns=["user_id", "event_type", "value", "ts"],
              delete_when="event_type = 'error'")
    state = _cut(scd1_state(prepare_changes(first, **kw), ["user_id"]))
    state = scd1_state(prepare_changes(late, **kw), ["user_id"], state)
    return scd1_view(state).select("user_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))


def _scd2_out(h: DataFrame) -> DataFrame:
    return h.select("user_id", "event_type", F.col("__start_at"), F.col("__end_at"))


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event-type history per user, consecutive equal types collapsed."""
    return _scd2_out(scd2(_events(spark, sf_dir), ["user_id"], "event_id", ["user_id", "event_type"]))


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the open version of every user."""
    h = scd2(_events(spark, sf_dir), ["user_id"], "event_id", ["user_id", "event_type"])
    return h.filter(F.col("__end_at").isNull()).select("user_id", "event_type", "__start_at")


def scd2_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + F4: 'error' events close the open version."""
    h = scd2(_events(spark, sf_dir), ["user_id"], "event_id", ["user_id", "event_type"],
             delete_when="event_type = 'error'")
    return _scd2_out(h)


def scd2_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 on a sequence that ties (many events an hour) and with a NULL key: one change per key and hour,
    no version of length zero. A change without a sequence comes before all others of its key."""
    ev = _dirty_events(spark, sf_dir).select(
        "user_id", F.date_trunc("hour", "ts").alias("hour"), F.floor(F.hour("ts") / 6).cast("int").alias("phase"))
    h = scd2(ev, ["user_id"], "hour", ["user_id", "phase"], strict=True)
    return h.select("user_id", "phase", F.col("__start_at").cast("string").alias("from_hour"), F.col("__end_at").cast("string").alias("to_hour"))


def scd2_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + F4 + I5, incremental: two batches, the second with late rows; equals the
    batch history (same oracle as ``scd2_deletes``)."""
    first, late = _late_split(_events(spark, sf_dir))
    kw = dict(keys=["user_id"], sequence_by="event_id", columns=["user_id", "event_type"],
              delete_when="event_type = 'error'")
    log, hist = scd2_apply(None, None, prepare_changes(first, **kw), ["user_id"])
    log, hist = _cut(log), _cut(hist)
    log, hist = scd2_apply(log, hist, prepare_changes(late, **kw), ["user_id"])
    return _scd2_out(hist)


def _orders_versions(spark, sf_dir):
    """Two versions of the orders table, both derived from the whole tables: v1 holds
    orders placed up to 2000-12-31 as stored; v2 holds every order except pending
    ones, with priority raised to 1-URGENT where a line was returned."""
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                                                "o_orderdate"])
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_returnflag"])
    v1 = od.filter(F.col("o_orderdate") <= F.lit("2000-12-31 00:00:00").cast("timestamp_ntz")).drop("o_orderdate")
    returned = li.groupBy("l_orderkey").agg(F.max(F.col("l_returnflag") == "R").alias("has_return"))
    v2 = (od.filter(F.col("o_orderstatus") != "P")
            .join(returned, od.o_orderkey == returned.l_orderkey, "left")
            .select("o_orderkey", "o_orderstatus",
                    F.when(F.coalesce("has_return", F.lit(False)), F.lit("1-URGENT"))
                     .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
                    "o_totalprice"))
    return v1, v2


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level changes between two versions of orders."""
    v1, v2 = _orders_versions(spark, sf_dir)
    return _change_feed(v1, v2, ["o_orderkey"])


PROFILE_EVENT_COLUMNS = ["user_id", "event_type", "value", "props"]
PROFILE_COLUMNS = [*PROFILE_EVENT_COLUMNS, "amount", "day"]
PROFILE_OUT = ["column_name", "row_count", "num_nulls", "percent_null", "num_distinct", "num_zeros", "min", "max", "avg", "stddev",
               "p25", "p50", "p75", "min_value", "max_value", "min_length", "max_length", "avg_length", "mode"]


def _dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with planted nulls (values, types, timestamps) and zeros, a decimal and a date."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", *PROFILE_EVENT_COLUMNS])
    i = F.col("event_id")
    value = F.when(i % 7 == 0, None).when(i % 11 == 0, 0.0).otherwise(F.col("value"))
    return ev.select("event_id", F.when(i % 29 != 0, F.col("ts")).alias("ts"), F.when(i % 17 != 0, F.col("user_id")).alias("user_id"),
                     F.when(i % 13 != 0, F.col("event_type")).alias("event_type"), value.alias("value"),
                     F.col("props"), (i % 1000).cast("decimal(12,2)").alias("amount"), F.col("ts").cast("date").alias("day"))


def _profile_out(p: DataFrame, window: bool = True) -> DataFrame:
    """For the comparison: raw doubles cut to float precision (engines add in another order), and no text of
    doubles (engines print them differently)."""
    cut = ("percent_null", "avg", "stddev", "avg_length", "p25", "p50", "p75")
    text = F.col("column_name").isin("value", "o_totalprice")
    out = [F.col(c).cast("float").cast("double").alias(c) if c in cut else
           F.when(~text, F.col(c)).alias(c) if c in ("min_value", "max_value") else F.col(c) for c in PROFILE_OUT]
    return p.select(*([F.col("window_start").cast("string").alias("window_start")] * window), *out)


def profile_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily time-series profile of events with defects, decimals and dates included."""
    return _profile_out(_profile(_dirty_events(spark, sf_dir), PROFILE_COLUMNS, "ts", "1 day", exact=True, mode_columns=["event_type"]))


def profile_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 at another grain: hourly profile of events (exact distinct counts and
    percentiles, so the oracle can check them; the default is the sketches)."""
    return _profile_out(_profile(_dirty_events(spark, sf_dir), ["event_type", "value"], "ts", "1 hour", exact=True, mode_columns=["event_type"]))


def profile_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot profile of the whole orders table."""
    cols = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"]
    p = _profile(read_table(spark, sf_dir, "orders", cols), cols, exact=True, mode_columns=["o_orderstatus", "o_orderpriority"])
    return _profile_out(p, window=False)


def profile_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a monitor, refresh it fully, incrementally after late rows arrive, and
    again after all rows of every tenth day are deleted; the profile must equal a full one."""
    from ..session import scratch_path
    from ..sinks.monitor import Monitor

    ev = _dirty_events(spark, sf_dir)
    first, late = _late_split(ev)
    deleted = F.coalesce(F.dayofmonth("ts") % 10 == 0, F.lit(False))
    mon = Monitor(spark, scratch_path(spark, "monitor"), "events", "ts", "1 day", PROFILE_COLUMNS,
                  exact=True, mode_columns=["event_type"]).create()
    mon.run_refresh(first)
    mon.run_refresh(ev, changed=late)
    mon.run_refresh(ev.filter(~deleted), changed=ev.filter(deleted))
    return _profile_out(mon.read_profile())


def profile_quarter_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 on windows of a length that no calendar unit has; rows without a timestamp are a window."""
    return _profile_out(_profile(_dirty_events(spark, sf_dir), ["event_type", "value"], "ts", "15 minutes", exact=True, mode_columns=["event_type"]))


def profile_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 + G5 on overlapping windows (an hour, every 20 minutes): profiled, then refreshed for late rows only."""
    from ..session import scratch_path
    from ..sinks.monitor import Monitor

    ev = _dirty_events(spark, sf_dir)
    first, late = _late_split(ev)
    mon = Monitor(spark, scratch_path(spark, "monitor"), "events", "ts", "1 hour", ["event_type", "value"], exact=True,
                  mode_columns=["event_type"], slide="20 minutes").create()
    mon.run_refresh(first)
    mon.run_refresh(ev, changed=late)
    return _profile_out(mon.read_profile())


def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5 by mergeable sketches: hourly slices of three batches (one of them replayed), every tenth day deleted,
    merged and read by the day. Estimates are held against the exact distinct counts and ranks here."""
    from ..operators.profile import in_own_windows, value_counts
    from ..operators.sketches import DISTINCT_ERROR, RANK_ERROR
    from ..session import scratch_path
    from ..sinks.sketch_store import SketchStore

    ev = _dirty_events(spark, sf_dir)
    columns = ["user_id", "event_type", "value", "amount"]
    store = SketchStore(spark, scratch_path(spark, "sketches"), columns, "ts", "1 hour", ["event_type"])
    for version, part in ((0, 0), (1, 1), (1, 1), (2, 2)):
        store.add(ev.filter(F.col("event_id") % 3 == part), version)
    deleted = F.coalesce(F.dayofmonth("ts") % 10 == 0, F.lit(False))
    store.replace(ev.filter(~deleted), ev.filter(deleted), 3)
    store.compact(4)
    got = store.read("1 day")

    rows = in_own_windows(ev.filter(~deleted), columns, "ts", "1 day")
    exact = value_counts(rows, columns, [ev.schema[c].dataType for c in columns])
    both = exact.join(got.select(F.col("window_start").alias("w"), F.col("column_name").alias("c"), "num_distinct", "p25", "p50", "p75"),
                      F.col("window_start").eqNullSafe(F.col("w")) & (F.col("column_name") == F.col("c")))
    n = F.sum(F.when(F.col("num").isNotNull(), F.col("n")))

    def near(p: str, share: float):
        below, upto = (F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)) for c in (F.col("num") < F.col(p), F.col("num") <= F.col(p)))
        return F.coalesce((below <= (share + RANK_ERROR) * n + 1) & (upto >= (share - RANK_ERROR) * n - 1), n.isNull())

    distinct = F.count("val")
    judged = both.groupBy("w", "c").agg(
        (F.abs(F.first("num_distinct") - distinct) <= F.greatest(F.lit(1), DISTINCT_ERROR * distinct)).alias("distinct_near"),
        (near("p25", 0.25) & near("p50", 0.5) & near("p75", 0.75)).alias("ranks_near"))
    joined = got.join(judged, F.col("window_start").eqNullSafe(F.col("w")) & (F.col("column_name") == F.col("c")))
    rounded = [F.col(c).cast("float").cast("double").alias(c) for c in ("avg", "stddev")]
    return joined.select(F.col("window_start").cast("string").alias("window_start"), "column_name", "row_count", "num_nulls", "num_zeros",
                         "min", "max", *rounded, "mode", "distinct_near", "ranks_near")


def _synth_out(df: DataFrame) -> DataFrame:
    out = []
    for c, t in df.dtypes:
        if t == "date":
            out.append(F.col(c).cast("string").alias(c))
        elif t == "double":
            out.append(F.round(c, 6).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def synth_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the clean bronze generator, one row per order key."""
    seeds = read_table(spark, sf_dir, "orders", ["o_orderkey"]).select(F.col("o_orderkey").alias("id"))
    return _synth_out(synth(seeds, bronze_spec()))


def synth_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5f: the dirty generator with null injection, one row per lineitem (repeated line
    ids give repeated rows, a defect of their own)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    seeds = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"))
    return _synth_out(synth(seeds, dirty_spec()))


def synth_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + G1: clean bronze from orders, then dirty rows (one per event) whose sales_id
    continues after the bronze's maximum; the appended table."""
    seeds = read_table(spark, sf_dir, "orders", ["o_orderkey"]).select(F.col("o_orderkey").alias("id"))
    existing = synth(seeds, bronze_spec())
    ev = read_table(spark, sf_dir, "events", ["event_id"]).select(F.col("event_id").alias("id"))
    appended = continue_ids(existing, "sales_id", ev, dirty_spec())
    return _synth_out(existing.unionByName(appended))


def _stream_runs(spark: SparkSession, sf_dir: str, start_query):
    """Write the fixture bronze as a parquet stream source in two appends (early, then
    later shipments) and run ``start_query(source_stream, root)`` to the end after
    each append, on one checkpoint - the reference's load / append / re-run cycle."""
    from ..session import scratch_path
    from ..sources.tables import read_stream
    from ..streaming.bronze_to_silver import run_to_end

    root = scratch_path(spark, "stream")
    bronze = fx.bronze(spark, sf_dir)
    early = F.col("date") < F.lit(UPSERT_CUTOFF).cast("date")
    src = f"{root}/bronze"
    for part in (bronze.filter(early), bronze.filter(~early)):
        part.write.mode("append").parquet(src)
        run_to_end(start_query(read_stream(spark, src, bronze.schema), root))
    return root


def _published(spark, root, table, keys):
    """The rules as each batch finds them in the published table (S10), with the declared keys not null."""
    path = f"{root}/rules"
    if not path_exists(spark, path):
        publish_documents(spark, rule_documents(FIXTURE_RULES), path)
    return lambda: published_rules(spark, path, table, fx.declared(keys))


def _sales_target(spark, root):
    from ..sinks.bucketed import BucketedTable
    from ..sinks.quarantine import QuarantineSink
    from ..streaming.bronze_to_silver import SilverTarget

    return SilverTarget("silver_sales", BucketedTable(spark, f"{root}/silver_sales", ["sales_id"]),
                        fx.SALES_COLUMNS, ["sales_id"], _published(spark, root, "silver_sales", ["sales_id"]),
                        QuarantineSink(spark, f"{root}/quarantine/silver_sales"), order_by=fx.SALES_ORDER,
                        carry=["l_suppkey"], metrics_path=f"{root}/metrics/silver_sales")


def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + B5 + I2/I3: streaming bronze -> silver sales over two runs on one
    checkpoint; the final table (same result as ``upsert_sales``)."""
    from ..streaming.bronze_to_silver import bronze_to_silver

    holder = {}

    def start(stream, root):
        holder["t"] = holder.get("t") or _sales_target(spark, root)
        return bronze_to_silver(stream, holder["t"], f"{root}/_checkpoints/silver_sales")
    _stream_runs(spark, sf_dir, start)
    return holder["t"].table.read().select("sales_id", "client_id", "product_id",
                                           F.col("date").cast("string").alias("date"), "quantity", "sale_amount")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 + S6 + S19 on the stream: quarantined rows with reasons and their batch."""
    from ..streaming.bronze_to_silver import bronze_to_silver

    holder = {}

    def start(stream, root):
        holder["t"] = holder.get("t") or _sales_target(spark, root)
        return bronze_to_silver(stream, holder["t"], f"{root}/_checkpoints/silver_sales")
    _stream_runs(spark, sf_dir, start)
    q = holder["t"].quarantine.read()
    return q.select("sales_id", F.array_join(F.array_sort("_failed_rules"), ",").alias("reasons"),
                    F.col("_batch_id").cast("bigint").alias("batch_id"))


def _dim_target(spark, root, table, columns, keys):
    from ..sinks.bucketed import BucketedTable
    from ..sinks.quarantine import QuarantineSink
    from ..streaming.bronze_to_silver import SilverTarget

    return SilverTarget(table, BucketedTable(spark, f"{root}/{table}", keys), columns, keys,
                        _published(spark, root, table, keys), QuarantineSink(spark, f"{root}/quarantine/{table}"),
                        order_by=DIM_ORDER, carry=DIM_ORDER)


def stream_multi_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream over bronze feeds the sales, clients and products silvers (the
    batch is scanned once and persisted); the rows of all three."""
    from ..streaming.bronze_to_silver import bronze_to_silvers

    holder = {}

    def start(stream, root):
        if "t" not in holder:
            holder["t"] = [_sales_target(spark, root),
                           _dim_target(spark, root, "silver_clients", fx.CLIENT_COLUMNS, ["client_id"]),
                           _dim_target(spark, root, "silver_products", fx.PRODUCT_COLUMNS, ["product_id"])]
        return bronze_to_silvers(stream, holder["t"], f"{root}/_checkpoints/bronze_multi")
    _stream_runs(spark, sf_dir, start)
    text = lambda *cols: F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in cols]).alias("detail")
    sales, clients, products = (t.table.read() for t in holder["t"])
    return (sales.select(F.lit("sales").alias("target"), F.col("sales_id").alias("key"), text("date", "client_id", "product_id", "quantity"))
            .unionByName(clients.select(F.lit("clients").alias("target"), F.col("client_id").alias("key"), text("address", "signup_date")))
            .unionByName(products.select(F.lit("products").alias("target"), F.col("product_id").alias("key"), text("product_name", "category"))))


# Expectations of the declarative event stream (none of them drops a driver row).
EVENT_EXPECTATIONS = [
    Rule("valid_user", "user_id IS NOT NULL", "drop"),
    Rule("valid_type", "event_type IS NOT NULL", "drop"),
    Rule("non_negative_value", "value >= 0", "warn"),
]


def _event_stream_runs(spark: SparkSession, sf_dir: str, targets_of):
    """Events as a parquet stream source in two appends (first the on-time days,
    then the late ones) through the declarative path, on one checkpoint."""
    from ..session import scratch_path
    from ..sources.tables import read_stream
    from ..streaming.bronze_to_silver import run_to_end
    from ..streaming.declarative import apply_changes_stream

    root = scratch_path(spark, "declarative")
    ev = _events(spark, sf_dir)
    targets = targets_of(root)
    for part in _late_split(ev):
        part.write.mode("append").parquet(f"{root}/events")
        run_to_end(apply_changes_stream(read_stream(spark, f"{root}/events", ev.schema), EVENT_EXPECTATIONS,
                                        targets, f"{root}/_checkpoint", metrics_path=f"{root}/metrics"))
    return targets


def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarative path streamed: expectations, then type 2 changes with deletes; the
    second run brings late rows (same result as ``scd2_deletes``)."""
    from ..streaming.declarative import ChangeTarget

    targets = _event_stream_runs(spark, sf_dir, lambda root: [ChangeTarget(
        "users_history", f"{root}/users_history", ["user_id"], "event_id", ["user_id", "event_type"],
        scd_type=2, delete_when="event_type = 'error'")])
    return _scd2_out(targets[0].read(spark))


def stream_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarative path streamed, type 1 with deletes and late rows (same result as
    ``scd1_deletes``)."""
    from ..streaming.declarative import ChangeTarget

    targets = _event_stream_runs(spark, sf_dir, lambda root: [ChangeTarget(
        "users_latest", f"{root}/users_latest", ["user_id"], "event_id", ["user_id", "event_type", "value", "ts"],
        scd_type=1, delete_when="event_type = 'error'")])
    return targets[0].read(spark).select("user_id", "event_type", "value", F.col("ts").cast("string").alias("ts"))


def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E3 + I1: stream-level ``dropDuplicates`` with unbounded state: each key passes
    once, as a whole row, in the first batch that carries it, across runs.  Which row
    wins is arbitrary, so the result tells whether it is one of its key's rows."""
    from ..streaming.bronze_to_silver import batch_folder_sink

    def start(stream, root):
        return (dedupe_stream(stream, ["sales_id"]).writeStream.foreachBatch(batch_folder_sink(f"{root}/rows"))
                .option("checkpointLocation", f"{root}/_checkpoints/rows").trigger(availableNow=True).start())
    root = _stream_runs(spark, sf_dir, start)
    won = spark.read.option("basePath", f"{root}/rows").parquet(f"{root}/rows/_batch_id=*")
    source = spark.read.parquet(f"{root}/bronze")
    whole = F.xxhash64(*[F.col(c) for c in source.columns])
    have = source.select("sales_id", whole.alias("h")).distinct().withColumn("own_row", F.lit(True))
    return (won.select("sales_id", F.col("_batch_id").cast("bigint").alias("batch_id"), whole.alias("h"))
            .join(have, ["sales_id", "h"], "left").select("sales_id", "batch_id", F.coalesce("own_row", F.lit(False)).alias("own_row")))


def _declarative(spark: SparkSession, sf_dir: str, targets_of):
    """The declarative path end to end: the fixture bronze as a catalog table, appended in two
    parts (B2), read as a named stream (A6) with a process timestamp (C2), expectations that drop and
    warn (D7-D9), and changes applied per target (F2, F3), on one checkpoint."""
    from ..session import scratch_path
    from ..sinks.catalog import save_table
    from ..sources.tables import stream_view
    from ..streaming.bronze_to_silver import run_to_end
    from ..streaming.declarative import apply_changes_stream

    root = scratch_path(spark, "declarative")
    name = "bronze_" + root.rsplit("/", 1)[-1]
    bronze, early = fx.bronze(spark, sf_dir), F.col("date") < F.lit(UPSERT_CUTOFF).cast("date")
    targets = targets_of(root)
    for part, mode in ((bronze.filter(early), "overwrite"), (bronze.filter(~early), "append")):
        save_table(part, name, comment="raw sales", properties={"quality": "bronze"}, mode=mode)
        stream = with_process_timestamp(stream_view(spark, name, f"{name}_v"))
        run_to_end(apply_changes_stream(stream, EXPECTATIONS, targets, f"{root}/_checkpoint", metrics_path=f"{root}/metrics"))
    return root, targets


#: A total order of a key's changes: the process timestamp alone ties within a batch.
CHANGE_ORDER = ["date", "sales_id", "sale_amount", "l_suppkey"]


def declarative_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 on the declarative path: address history per client, sequenced by several columns."""
    from ..streaming.declarative import ChangeTarget

    _, (clients,) = _declarative(spark, sf_dir, lambda root: [ChangeTarget(
        "clients", f"{root}/clients", ["client_id"], CHANGE_ORDER, ["client_id", "address"], scd_type=2)])
    at = lambda c, e: F.col(f"{c}.{e}")
    return clients.read(spark).select(
        "client_id", "address", at("__start_at", "date").cast("string").alias("from_date"), at("__start_at", "sales_id").alias("from_sale"),
        at("__end_at", "date").cast("string").alias("to_date"), at("__end_at", "sales_id").alias("to_sale"))


def declarative_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 + F5 on the declarative path: the latest product rows, without the columns of the sale."""
    from ..streaming.declarative import ChangeTarget

    _, (products,) = _declarative(spark, sf_dir, lambda root: [ChangeTarget(
        "products", f"{root}/products", ["product_id"], CHANGE_ORDER, ["product_id", "product_name", "category", "quantity", "process_timestamp"],
        except_columns=["process_timestamp"])])
    return products.read(spark).select("product_id", "product_name", "category", "quantity")


def declarative_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on the declarative path: the latest row per sale; every row has its process timestamp."""
    from ..streaming.declarative import ChangeTarget

    _, (sales,) = _declarative(spark, sf_dir, lambda root: [ChangeTarget(
        "sales", f"{root}/sales", ["sales_id"], CHANGE_ORDER, ["sales_id", "client_id", "quantity", "date", "process_timestamp"])])
    return sales.read(spark).select("sales_id", "client_id", "quantity", F.col("date").cast("string").alias("date"),
                                    F.col("process_timestamp").isNotNull().alias("stamped"))


def declarative_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7-D9 on the declarative path: passed and failed rows per batch and rule, counted by the pass that keeps them."""
    root, _ = _declarative(spark, sf_dir, lambda root: [])
    return spark.read.parquet(f"{root}/metrics/_query=*/_batch_id=*").select("batch_id", "rule_name", "action", "passed_rows", "failed_rows")


QUERIES = {
    "quarantine_split": quarantine_split,
    "silver_sales": silver_sales,
    "silver_validate_first": silver_validate_first,
    "silver_clients": silver_clients,
    "silver_products": silver_products,
    "rule_violations": rule_violations,
    "quarantine_reasons": quarantine_reasons,
    "quality_metrics": quality_metrics,
    "null_policy_split": null_policy_split,
    "violation_policies": violation_policies,
    "scd2_ties": scd2_ties,
    "declarative_clients": declarative_clients,
    "declarative_products": declarative_products,
    "declarative_sales": declarative_sales,
    "declarative_metrics": declarative_metrics,
    "expect_metrics": expect_metrics,
    "expect_drop": expect_drop,
    "expect_all_drop": expect_all_drop,
    "rules_explode": rules_explode,
    "rules_normalised": rules_normalised,
    "rules_by_tag": rules_by_tag,
    "dedupe_latest": dedupe_latest_q,
    "dedupe_rank_ties": dedupe_rank_ties,
    "dedupe_any_keys": dedupe_any_keys,
    "upsert_sales": upsert_sales,
    "scd1_latest": scd1_latest,
    "scd1_deletes": scd1_deletes,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_deletes": scd2_deletes,
    "scd2_late": scd2_late,
    "change_feed": change_feed,
    "profile_daily": profile_daily,
    "profile_hourly": profile_hourly,
    "profile_snapshot": profile_snapshot,
    "profile_refresh": profile_refresh,
    "profile_quarter_hours": profile_quarter_hours,
    "profile_sliding": profile_sliding,
    "profile_sketches": profile_sketches,
    "synth_bronze": synth_bronze,
    "synth_defects": synth_defects,
    "synth_append": synth_append,
    "stream_split": stream_split,
    "stream_quarantine": stream_quarantine,
    "stream_multi_target": stream_multi_target,
    "stream_dedupe": stream_dedupe,
    "stream_scd1": stream_scd1,
    "stream_scd2": stream_scd2,
}
