"""Bronze -> silver batch plans shared by the streaming job and the batch queries.

``silver_batch`` is the per-batch plan of the reference's main path: project,
dedupe per key, then judge every row against the target's rules.  It is pure
(DataFrame -> DataFrame); sinks decide what to write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import Rule, collect_rules, normalise_statements, rules_for
from ..operators.dedupe import dedupe_any, dedupe_latest
from ..operators.split import judge
from ..sources.rules import FIXTURE_RULES, documents_frame, rule_documents


def catalogue_rules(spark: SparkSession, table: str, catalogue: dict[str, list[str]] = FIXTURE_RULES,
                    schema: str = "default") -> list[Rule]:
    """Documents -> normalised catalogue -> the rules of one silver table."""
    stmts = documents_frame(spark, rule_documents(catalogue, schema))
    return collect_rules(rules_for(normalise_statements(stmts), table=table))


def silver_batch(bronze: DataFrame, columns: Sequence[str], keys: Sequence[str], rules: Sequence[Rule],
                 order_by: Sequence[str | Column] | None = None, null_policy: str = "quarantine",
                 validate_first: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Project -> dedupe -> judge.

    ``order_by`` picks the latest row per key (``None`` keeps any row, as
    ``dropDuplicates``).  ``validate_first=True`` dedupes among valid rows only,
    so an invalid duplicate cannot displace a valid one (S3).  ``carry`` names
    extra columns needed only for ordering; they are dropped at the end.
    """
    cols = list(dict.fromkeys([*columns, *carry]))
    df = bronze.select(*cols)
    if validate_first:
        # one ranked dedupe: per key the latest valid row if there is one, else the
        # latest invalid row (which goes to quarantine) - no join, and the partial
        # WindowGroupLimit keeps a hot key small before the shuffle
        judged = judge(df, rules, null_policy)
        valid_first = (F.col("_status") == "valid").desc()
        out = dedupe_latest(judged, keys, [valid_first, *(order_by or [])])
    else:
        out = judge(_dedupe(df, keys, order_by), rules, null_policy)
    return out.drop(*[c for c in carry if c not in columns])


def _dedupe(df: DataFrame, keys: Sequence[str], order_by) -> DataFrame:
    return dedupe_latest(df, keys, order_by) if order_by else dedupe_any(df, keys)
