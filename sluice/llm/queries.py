"""Registered queries of the operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .cutting_stock import pack_tightly
from .decontam import contamination
from .html_crf import main_text
from .langid import fold, identify
from .line_dedup import ORACLE_SQL as LINES_SQL
from .line_dedup import dedup_lines
from .lm_maxent import score
from .ngram_join import jaccard_components
from .packing import pack
from .phrases import ORACLE_SQL as PHRASES_SQL
from .phrases import collocations
from .quality import grade
from .suffix_dedup import dedup_strings
from .topk import ORACLE_SQL as TOPK_SQL
from .topk import search
from .whitening import whiten


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    docs = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), fold("key", 5) != 0)
    return docs.select("doc_id", held_out.alias("held_out"), "language.lang_pred", "language.score")


#: 0 toxic, 1 of low quality, 2 good.
RATING = "case when toxic = 1 then 0 else 1 + quality end"


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = grade(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), RATING)
    low, high = F.col("tails")[0], F.col("tails")[1]
    return graded.select("doc_id", "expected_grade", low.alias("p_not_toxic"), high.alias("p_good"), (high >= 0.5).alias("selected"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", main_text(pages).alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_strings(table(spark, sf_dir, "documents"))
    kept = F.col("kept")
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length(kept)).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2(kept, 256).alias("kept_sha256"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(table(spark, sf_dir, "documents"), fold("doc_id", 7) != 2)
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), with_ids=False)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tightly(table(spark, sf_dir, "documents"), with_ids=False)


def op12_phrase_collocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is null."""
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.expr("try_cast(deviation as long)"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_quality": op2_quality,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_html_extraction": op4_html_extraction,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_topk_search": op7_topk_search,
    "op8_line_dedup": op8_line_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_decontamination": op10_decontamination,
    "op11_packing": op11_packing,
    "op12_phrase_collocation": op12_phrase_collocation,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE: dict[str, str] = {
    "op7_topk_search": TOPK_SQL,
    "op8_line_dedup": LINES_SQL,
    "op12_phrase_collocation": PHRASES_SQL,
}
