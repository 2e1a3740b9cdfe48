"""From raw documents to packed training sequences: five stages, each over all rows that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. Extra columns are carried along. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.common import bounded, cut, fresh, numbered, table
from sluice.llm.decontam import leaks_by_block
from sluice.llm.langid import UNDETERMINED, fold, identify
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.ngram_join import jaccard_components
from sluice.llm.packing import pack

#: Texts whose language is less sure than this are rejected.
SURE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in a language that was learnt; null texts and texts without letters go."""
    out = fresh(docs, "language_")
    found = identify(docs, fold("key", 5) != 0, out=out)
    return found.filter((F.col(f"{out}.lang_pred") != UNDETERMINED) & (F.col(f"{out}.score") >= SURE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated three-line windows; documents of which nothing is left go. ``n_chars`` follows the text."""
    lines, removed = fresh(docs, "n_lines_"), fresh(docs, "n_removed_")
    kept = dedup_lines(docs, counts=(lines, removed)).filter((F.col(removed) == 0) | (F.col("text") != ""))
    n_chars = F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None
    return kept.select(*[n_chars.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of least (doc_id, row) of every group of linked documents."""
    row, key = fresh(docs, "row_"), fresh(docs, "key_")
    rows = numbered(docs, row)
    found = jaccard_components(rows.withColumn(key, F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.col(row).alias("row"))), id_col=key)
    dropped = cut(found.filter("doc_id <> component_id").select(F.col("doc_id.row").alias(row)), "dropped")
    return rows.join(bounded(dropped), row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item within its error budget. Null and empty texts hold none and stay;
    repeated rows are judged alike; without items all stay. Items of many blocks are searched block by block, each over
    what the one before left."""
    out, columns, clean = fresh(docs, "leaks_"), docs.columns, []
    for found in leaks_by_block(F.col("text"), table(spark, sf_dir, "benchmark")):
        if clean:
            docs = cut(clean[-1], "clean")
        clean.append(docs.withColumn(out, found).filter(F.size(out) == 0).select(*columns))
    return clean[-1]


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens. A null or empty text is the end id alone;
    repeated rows and null ids are packed like any other."""
    return pack(docs, with_ids=False)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Several stages cannot be said in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
