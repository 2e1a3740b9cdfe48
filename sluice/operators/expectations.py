"""Row expectations of the declarative path.

``warn`` rules keep failing rows and count them; ``drop`` rules remove them.
A predicate that is NULL counts as failing.  Every rule is counted over all
input rows, also rows another rule drops.

Counting is one aggregate (batch) or ``DataFrame.observe`` (batch and
streaming, no extra job): both are map-side partial aggregates.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.rules import Rule, as_rules, one_per_name


def passes(rule: Rule) -> Column:
    return F.coalesce(rule.column(), F.lit(False))


def expect(df: DataFrame, name: str, expression: str, observation: Observation | str | None = None) -> DataFrame:
    """Keep every row and count those whose predicate is not TRUE.

    The counts ``rows`` and ``failed`` are observed, without a job of their own:
    read them from the ``Observation`` given, or, by name, from a stream's progress
    (default: the rule's name)."""
    failed = F.count_if(~passes(Rule(name, expression, "warn")))
    return df.observe(observation or name, F.count(F.lit(1)).alias("rows"), failed.alias("failed"))


def expect_or_drop(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Remove rows whose predicate is not TRUE."""
    return df.filter(passes(Rule(name, expression, "drop")))


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Fold of :func:`expect_or_drop` over a rule set (one conjunctive filter)."""
    kept = df
    for name, expression in rules.items():
        kept = expect_or_drop(kept, name, expression)
    return kept


def apply_expectations(df: DataFrame, rules: Iterable[Rule]) -> tuple[DataFrame, list[Rule]]:
    """Apply a mixed rule set: returns the kept rows and the rules (for metrics)."""
    rules = as_rules(rules)
    kept = df
    for r in rules:
        if r.action in ("drop", "quarantine"):
            kept = kept.filter(passes(r))
    return kept, rules


def expectation_metrics(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """``(rule_name, action, passed_rows, failed_rows)`` over all input rows, from a
    single aggregate pass."""
    rules = as_rules(rules)
    aggs = []
    for i, r in enumerate(rules):
        aggs.append(F.count_if(passes(r)).alias(f"p{i}"))
        aggs.append(F.count_if(~passes(r)).alias(f"f{i}"))
    wide = df.agg(*aggs)
    rows = ", ".join("'{}', '{}', p{}, f{}".format(r.name.replace("'", "\\'"), r.action, i, i)
                     for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {rows}) as (rule_name, action, passed_rows, failed_rows)")


def observe_expectations(df: DataFrame, rules: Iterable[Rule], name: str | None = None):
    """Attach live metrics with ``observe`` (works for streaming too): ``rows`` and, per rule,
    ``failed_<name>``.

    Returns ``(df, observation)``; read ``observation.get`` after an action.
    Streaming queries report them in ``query.lastProgress['observedMetrics']``.
    """
    rules = one_per_name(as_rules(rules))
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")]
    exprs += [F.count_if(~passes(r)).alias(f"failed_{r.name}") for r in rules]
    return df.observe(obs, *exprs), obs
