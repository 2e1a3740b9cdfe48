"""Violation predicates with an explicit null policy.

A rule predicate is three-valued.  ``null_policy`` says what an unknown (NULL)
result means:

* ``'quarantine'`` (default) - unknown fails the rule;
* ``'pass'``                 - unknown passes;
* ``'drop'``                 - the reference's behaviour: the violation
  predicate ``false OR NOT r1 OR NOT r2 ...`` is NULL for such a row, so neither
  the valid filter nor the quarantine filter keeps it and the row is lost.
"""

from __future__ import annotations

from functools import reduce
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import Rule

NULL_POLICIES = ("quarantine", "pass", "drop")


def _check_policy(null_policy: str) -> None:
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}, got {null_policy!r}")


def rule_fails(rule: Rule, null_policy: str = "quarantine") -> Column:
    """Two-valued 'this rule fails' (unknown resolved by the policy; 'drop' counts
    only definite failures)."""
    _check_policy(null_policy)
    pred = rule.column()
    if null_policy == "quarantine":
        return ~F.coalesce(pred, F.lit(False))
    return F.coalesce(~pred, F.lit(False))


def violation_condition(rules: Iterable[Rule], null_policy: str = "quarantine") -> Column:
    """D3: one predicate, true for rows to quarantine.

    With ``'drop'`` it is the negated conjunction of the rules, NULL where no rule fails
    and one is unknown.
    With no rules the predicate is ``false``: every row is valid (S5).
    """
    _check_policy(null_policy)
    rules = list(rules)
    if null_policy == "drop":
        return ~reduce(Column.__and__, [r.column() for r in rules], F.lit(True))
    return reduce(lambda acc, r: acc | rule_fails(r, null_policy), rules, F.lit(False))


def failed_rules(rules: Iterable[Rule], null_policy: str = "quarantine") -> Column:
    """``array<string>`` of the names of failing rules, in rule order.

    Each rule is evaluated once per row; split, reasons and metrics all derive
    from this one column.
    """
    rules = list(rules)
    if not rules:
        return F.array().cast("array<string>")
    arr = F.array(*[F.when(rule_fails(r, null_policy), F.lit(r.name)) for r in rules])
    return F.filter(arr, lambda x: x.isNotNull())


def unknown_rules(rules: Iterable[Rule]) -> Column:
    """``array<string>`` of rules whose predicate is NULL for the row."""
    rules = list(rules)
    if not rules:
        return F.array().cast("array<string>")
    arr = F.array(*[F.when(r.column().isNull(), F.lit(r.name)) for r in rules])
    return F.filter(arr, lambda x: x.isNotNull())
