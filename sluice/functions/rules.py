"""Rule normalisation, lookup and binding.

A rule is a named Spark SQL predicate plus an action:

* ``quarantine`` - a failing row goes to the quarantine table (bronze -> silver path);
* ``drop``       - a failing row is removed (``expect_or_drop``);
* ``warn``       - a failing row is kept and only counted (``expect``).

Rule catalogues are data (DataFrames); :func:`collect_rules` brings the few rule
rows of one table to the driver - that is metadata, bounded by the catalogue,
never table data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ACTIONS = ("quarantine", "drop", "warn")

# The statement patterns the rule documents use.
NOT_NULL_PATTERN = r"(?i)ALTER\s+COLUMN\s+(\w+)\s+SET\s+NOT\s+NULL"
CONSTRAINT_NAME_PATTERN = r"(?i)ADD\s+CONSTRAINT\s+(\w+)"
CHECK_PATTERN = r"(?i)CHECK\s*[(](.*)[)]\s*;?\s*$"


@dataclass(frozen=True)
class Rule:
    name: str
    expression: str
    action: str = "quarantine"
    table_name: str | None = None
    tag: str | None = None

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"rule {self.name!r}: unknown action {self.action!r}")

    def column(self) -> Column:
        return F.expr(self.expression)


def normalise_statements(statements: DataFrame, statement_col: str = "col",
                         table_col: str = "tableName") -> DataFrame:
    """Statement text -> ``(table_name, kind, name, expression)``.

    Runs as column expressions on the executors; the greedy CHECK pattern keeps
    nested parentheses.  Unreadable statements get ``kind = 'unknown'``.
    """
    stmt = F.col(statement_col)
    nn_col = F.regexp_extract(stmt, NOT_NULL_PATTERN, 1)
    cname = F.regexp_extract(stmt, CONSTRAINT_NAME_PATTERN, 1)
    check = F.trim(F.regexp_extract(stmt, CHECK_PATTERN, 1))
    kind = (F.when(nn_col != "", F.lit("not_null"))
             .when((cname != "") & (check != ""), F.lit("check"))
             .otherwise(F.lit("unknown")))
    return statements.select(
        F.col(table_col).alias("table_name"),
        kind.alias("kind"),
        F.when(kind == "not_null", F.concat(nn_col, F.lit("_not_null")))
         .when(kind == "check", cname).alias("name"),
        F.when(kind == "not_null", F.concat(nn_col, F.lit(" IS NOT NULL")))
         .when(kind == "check", check).alias("expression"),
        stmt.alias("statement"),
    )


def not_null_rules(schema: StructType, table_name: str | None = None,
                   action: str = "quarantine") -> list[Rule]:
    """One ``IS NOT NULL`` rule per non-nullable field of a declared schema."""
    return [Rule(f"{f.name}_not_null", f"{f.name} IS NOT NULL", action, table_name)
            for f in schema.fields if not f.nullable]


def rules_for(rules: DataFrame, table: str | None = None, tag: str | None = None) -> DataFrame:
    """Equality filter on the catalogue, as a column predicate (no string building)."""
    if table is not None:
        rules = rules.filter(F.col("table_name") == F.lit(table))
    if tag is not None:
        rules = rules.filter(F.col("tag") == F.lit(tag))
    return rules


def collect_rules(rules: DataFrame, action: str = "quarantine") -> list[Rule]:
    """Bring the (small) rule rows of a normalised catalogue to the driver.

    Raises on the first unreadable statement, naming it, and on a name that one
    table has for two different predicates (S14); equal rows collapse.  Order is stable
    (by name, then expression) so that predicates and metrics are reproducible.
    """
    cols = set(rules.columns)
    sel = [F.col("name"), F.col("expression"),
           (F.col("kind") if "kind" in cols else F.lit("check")).alias("kind"),
           (F.col("action") if "action" in cols else F.lit(action)).alias("action"),
           (F.col("table_name") if "table_name" in cols else F.lit(None).cast("string")).alias("table_name"),
           (F.col("tag") if "tag" in cols else F.lit(None).cast("string")).alias("tag")]
    out, seen = [], {}
    for row in rules.select(*sel).distinct().orderBy("name", "expression").collect():
        if row["kind"] == "unknown" or not row["expression"]:
            raise ValueError(f"unreadable rule statement for table {row['table_name']!r}: {row}")
        key = (row["table_name"], row["name"])
        if seen.setdefault(key, row["expression"]) != row["expression"]:
            raise ValueError(f"rule {row['name']!r} of table {row['table_name']!r} has conflicting predicates: "
                             f"{seen[key]!r} vs {row['expression']!r}")
        if any((r.table_name, r.name) == key for r in out):
            continue
        out.append(Rule(row["name"], row["expression"], row["action"] or action,
                        row["table_name"], row["tag"]))
    return out


def one_per_name(rules: Iterable[Rule]) -> list[Rule]:
    """Rules judged together: reasons and counts go by name, so equal repeats collapse and one name
    with two predicates raises (S14)."""
    out: dict[str, Rule] = {}
    for r in rules:
        if out.setdefault(r.name, r).expression != r.expression:
            raise ValueError(f"rule {r.name!r} has conflicting predicates: {out[r.name].expression!r} vs {r.expression!r}")
    return list(out.values())


def validate_rules(df: DataFrame, rules: Iterable[Rule]) -> None:
    """Resolve every rule against ``df`` without reading data.

    Unknown columns, syntax errors and aggregates inside a rule raise here, with
    the rule's name, before any batch is processed.
    """
    for r in rules:
        try:
            df.filter(r.column()).schema  # analysis only
        except Exception as e:  # AnalysisException / ParseException
            raise ValueError(f"rule {r.name!r} ({r.expression!r}) does not bind: {e}") from e


def rules_by_tag(tagged: DataFrame, tag: str, on_conflict: str = "raise") -> dict[str, str]:
    """``name -> predicate`` for one tag.

    Equal rows collapse.  Two different predicates under one name raise, unless
    ``on_conflict='last'``, which keeps the row written last (needs ``ordinal``).
    """
    rows = (tagged.filter(F.col("tag") == F.lit(tag))
                  .select("name", "constraint",
                          (F.col("ordinal") if "ordinal" in tagged.columns else F.lit(0)).alias("ordinal"))
                  .orderBy("ordinal").collect())
    out: dict[str, str] = {}
    for r in rows:
        prev = out.get(r["name"])
        if prev is not None and prev != r["constraint"] and on_conflict == "raise":
            raise ValueError(f"rule {r['name']!r} has conflicting predicates: {prev!r} vs {r['constraint']!r}")
        out[r["name"]] = r["constraint"]
    return out


def as_rules(rules: Mapping[str, str] | Iterable[Rule] | Iterable[tuple[str, str]],
             action: str = "quarantine") -> list[Rule]:
    """Accept a dict, ``Rule`` objects or ``(name, expression)`` pairs."""
    if isinstance(rules, Mapping):
        return [Rule(n, e, action) for n, e in rules.items()]
    out = []
    for r in rules:
        out.append(r if isinstance(r, Rule) else Rule(r[0], r[1], action))
    return out
