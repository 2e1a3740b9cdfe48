"""Valid / quarantine split and its metrics.

One pass evaluates every rule once per row into ``_failed_rules``; the split,
the per-row reasons and all counts are derived from that column, so a batch is
read once (persist it if it is consumed by several sinks).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import fresh
from ..functions.predicates import failed_rules, unknown_rules, _check_policy
from ..functions.rules import Rule, one_per_name

FAILED_COL = "_failed_rules"
UNKNOWN_COL = "_unknown_rules"
STATUS_COL = "_status"


def judge(df: DataFrame, rules: Iterable[Rule], null_policy: str = "quarantine",
          failed: str = FAILED_COL, unknown: str = UNKNOWN_COL, status: str = STATUS_COL) -> DataFrame:
    """Add ``_failed_rules array<string>`` and ``_status`` in {valid, quarantine, unknown}; an input that has columns of
    these names is refused (other names can be given).

    ``unknown`` only occurs with ``null_policy='drop'``: rows with no definite
    failure but some NULL rule result, which the reference loses.
    """
    _check_policy(null_policy)
    rules = one_per_name(rules)
    added = [failed, status, *([unknown] if null_policy == "drop" else [])]
    if taken := [c for c in df.columns if c.lower() in {a.lower() for a in added}]:
        raise ValueError(f"the input already has columns named {taken}")
    out = df.withColumn(failed, failed_rules(rules, "quarantine" if null_policy == "quarantine" else "pass"))
    verdict = F.when(F.size(failed) > 0, F.lit("quarantine"))
    if null_policy == "drop":
        out = out.withColumn(unknown, unknown_rules(rules))
        verdict = verdict.when(F.size(unknown) > 0, F.lit("unknown"))
    return out.withColumn(status, verdict.otherwise(F.lit("valid")))


def split(df: DataFrame, rules: Iterable[Rule], null_policy: str = "quarantine",
          keep_reasons: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``.  Valid rows lose the helper columns; quarantined
    rows keep ``_failed_rules`` as their reason unless ``keep_reasons=False`` (with more ``_`` if the input has
    a column of that name)."""
    failed, unknown, status = (fresh(df.columns, c) for c in (FAILED_COL, UNKNOWN_COL, STATUS_COL))
    judged = judge(df, rules, null_policy, failed, unknown, status)
    valid = judged.filter(F.col(status) == "valid").select(*[f"`{c}`" for c in df.columns])
    kept = [*df.columns, *([failed] if keep_reasons else [])]
    return valid, judged.filter(F.col(status) == "quarantine").select(*[f"`{c}`" for c in kept])


def quality_metrics(judged: DataFrame) -> DataFrame:
    """One row ``total, valid, quarantined, unknown`` from a judged frame, in one
    aggregate pass (map-side partial counts, single tiny final merge)."""
    s = F.col(STATUS_COL)
    return judged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(s == "valid").alias("valid_rows"),
        F.count_if(s == "quarantine").alias("quarantined_rows"),
        F.count_if(s == "unknown").alias("unknown_rows"),
    )


def rule_failure_counts(judged: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Per-rule failing-row counts as ``(rule_name, failed_rows)``.

    One wide aggregate (a fixed number of ``count_if`` per rule) then an
    unpivot of its single row - no shuffle of table data.
    """
    rules = one_per_name(rules)
    if not rules:
        return judged.sparkSession.createDataFrame([], "rule_name string, failed_rows bigint")
    wide = judged.agg(*[F.count_if(F.array_contains(FAILED_COL, r.name)).alias(f"r{i}")
                        for i, r in enumerate(rules)])
    stacked = ", ".join("'{}', r{}".format(r.name.replace("'", "\\'"), i) for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {stacked}) as (rule_name, failed_rows)")
