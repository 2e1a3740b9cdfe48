"""Rule catalogues kept as data.

Two shapes exist:

* rule *documents*: JSON ``{"tableName": ..., "constraints": [statement, ...]}``
  where a statement is ``ALTER TABLE t ALTER COLUMN c SET NOT NULL;`` or
  ``ALTER TABLE t ADD CONSTRAINT n  CHECK (expr);``.  They are parsed with a
  declared schema (not inferred) and exploded to one row per statement;
* a *tagged* rules table ``(name, constraint, tag)`` written as inline values.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import Rule, collect_rules, normalise_statements, not_null_rules, rules_for
from .literal import literal_rows

RULE_DOC_SCHEMA = T.StructType([
    T.StructField("tableName", T.StringType()),
    T.StructField("constraints", T.ArrayType(T.StringType())),
])

# The same rule documents re-aimed at the fixture bronze (FIXTURES.md §3):
# market segments stand in for states, and the date window fits the shipping dates.
FIXTURE_RULES = {
    "silver_clients": [
        "ALTER TABLE {schema}.silver_clients ALTER COLUMN client_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_clients ADD CONSTRAINT validAddress  CHECK (address in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD'));",
    ],
    "silver_products": [
        "ALTER TABLE {schema}.silver_products ALTER COLUMN product_id SET NOT NULL;",
    ],
    "silver_sales": [
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN sales_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN client_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ALTER COLUMN product_id SET NOT NULL;",
        "ALTER TABLE {schema}.silver_sales ADD CONSTRAINT dateWithinRange  CHECK (date between '1995-06-01' and '2001-06-01');",
        "ALTER TABLE {schema}.silver_sales ADD CONSTRAINT validQuantity  CHECK (quantity > 0);",
    ],
}

# The tagged table re-aimed at the fixture bronze.
FIXTURE_TAGGED_RULES = [
    ("client_id_not_null", "client_id IS NOT NULL", "clients"),
    ("address_valid_value", "address in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')", "clients"),
    ("product_id_not_null", "product_id IS NOT NULL", "products"),
    ("sales_id_not_null", "sales_id IS NOT NULL", "sales"),
    ("client_id_not_null", "client_id IS NOT NULL", "sales"),
    ("client_id_not_null", "client_id IS NOT NULL", "sales"),
    ("date_valid_range", "date between '1995-06-01' and '2001-06-01'", "sales"),
    ("quantity_valid_value", "quantity > 0", "sales"),
]


def rule_documents(catalogue: dict[str, list[str]], schema: str = "default") -> list[str]:
    """Render a catalogue as JSON documents, one per table."""
    return [json.dumps({"tableName": table, "constraints": [s.format(schema=schema) for s in stmts]})
            for table, stmts in catalogue.items()]


def documents_frame(spark: SparkSession, documents: list[str]) -> DataFrame:
    """JSON strings -> ``(tableName, col)``, one row per statement (A3).

    The document schema is declared; ``from_json`` runs on the executors.
    """
    raw = literal_rows(spark, [(d,) for d in documents], "doc string")
    doc = F.from_json("doc", RULE_DOC_SCHEMA)
    return raw.select(doc.alias("d")).select(F.col("d.tableName").alias("tableName"),
                                             F.explode("d.constraints").alias("col"))


def publish_documents(spark: SparkSession, documents: list[str], path: str) -> DataFrame:
    """Write the exploded statements as the rule catalogue table (overwrite)."""
    documents_frame(spark, documents).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def published_rules(spark: SparkSession, path: str, table: str, declared: T.StructType | None = None) -> list[Rule]:
    """The rules of one table as the published catalogue has them now, merged with the not-null
    rules of a declared schema.  Rules that are equal collapse; one name with two predicates raises."""
    rows = rules_for(normalise_statements(spark.read.parquet(path)), table=table).drop("statement")
    own = not_null_rules(declared, table) if declared is not None else []
    if own:
        more = literal_rows(spark, [(table, "not_null", r.name, r.expression) for r in own], "table_name string, kind string, name string, expression string")
        rows = rows.unionByName(more)
    return collect_rules(rows)


def tagged_rules_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """A4: the tagged rules table ``(name, constraint, tag)`` from inline values.

    An ordinal column keeps the written order, which ``rules_by_tag(on_conflict='last')`` needs.
    """
    return literal_rows(spark, [(n, c, t, i) for i, (n, c, t) in enumerate(rows)],
                        "name string, constraint string, tag string, ordinal int")
