from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sluice.functions.predicates import violation_condition
from sluice.functions.rules import Rule
from sluice.operators.split import judge, quality_metrics, rule_failure_counts, split


def test_reference_three_valued_split_loses_a_row(tiny, tiny_rules):
    # FIXTURES §4: filter(cond) / filter(~cond) keep 4 / 1; (3, null, null) is in neither
    cond = violation_condition(tiny_rules, "drop")
    assert tiny.filter(cond).count() == 4
    valid = tiny.filter(~cond).collect()
    assert [r.id for r in valid] == [1]
    j = {r.id: r._status for r in judge(tiny, tiny_rules, "drop").collect() if r.id is not None}
    assert j[3] in ("quarantine", "unknown")


def test_policies_keep_every_row(tiny, tiny_rules):
    for policy in ("quarantine", "pass"):
        valid, quarantine = split(tiny, tiny_rules, policy)
        assert valid.count() + quarantine.count() == tiny.count()
    unknown = judge(tiny, [Rule("q", "quantity > 0")], "drop").filter("_status = 'unknown'").count()
    assert unknown == 1


def test_reasons_and_counts(tiny, tiny_rules):
    j = judge(tiny, tiny_rules)
    reasons = {r.id: sorted(r._failed_rules) for r in j.collect() if r.id == 2}
    assert reasons[2] == ["validAddress", "validQuantity"]
    counts = {r.rule_name: r.failed_rows for r in rule_failure_counts(j, tiny_rules).collect()}
    assert counts == {"id_not_null": 2, "validQuantity": 2, "validAddress": 2, "dateWithinRange": 1}
    m = quality_metrics(j).first()
    assert (m.total_rows, m.valid_rows, m.quarantined_rows) == (6, 1, 5)


def test_no_rules_means_all_valid(tiny):
    valid, quarantine = split(tiny, [])
    assert valid.count() == 6 and quarantine.count() == 0


def test_empty_batch(spark, tiny_rules):
    empty = spark.createDataFrame([], "id bigint, quantity int, address string, date date")
    valid, quarantine = split(empty, tiny_rules)
    assert valid.count() == 0 and quarantine.count() == 0


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-3, 3)), st.one_of(st.none(), st.integers(-3, 3))),
                max_size=30))
def test_valid_plus_quarantine_is_input(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    rules = [Rule("a_pos", "a > 0"), Rule("b_nn", "b IS NOT NULL"), Rule("ab", "a + b < 3")]
    for policy in ("quarantine", "pass"):
        valid, quarantine = split(df, rules, policy)
        assert valid.count() + quarantine.count() == len(rows)


def test_observed_expectation_metrics(spark, tiny):
    from sluice.operators.expectations import expectation_metrics, observe_expectations
    rules = [Rule("q", "quantity > 0", "warn"), Rule("id", "id IS NOT NULL", "drop")]
    df, obs = observe_expectations(tiny, rules)
    df.count()
    got = obs.get
    assert got["rows"] == 6 and got["failed_q"] == 2 and got["failed_id"] == 2
    m = {r.rule_name: (r.passed_rows, r.failed_rows) for r in expectation_metrics(tiny, rules).collect()}
    assert m == {"q": (4, 2), "id": (4, 2)}


def test_process_timestamp_is_one_value_per_query(spark, tiny):
    from sluice.functions.columns import with_process_timestamp
    df = with_process_timestamp(tiny)
    assert df.select("process_timestamp").distinct().count() == 1


def test_judging_one_name_with_two_predicates_raises(spark):
    import pytest
    from sluice.functions.rules import Rule
    from sluice.operators.split import judge, rule_failure_counts
    df = spark.range(3).selectExpr("id as x")
    with pytest.raises(ValueError, match="conflicting"):
        judge(df, [Rule("r", "x > 0"), Rule("r", "x < 10")])
    same = [Rule("r", "x > 0"), Rule("r", "x > 0")]
    assert [tuple(r) for r in rule_failure_counts(judge(df, same), same).collect()] == [("r", 1)]
