"""Batch and streaming scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Batch scan of one driver table (A2).  Selecting columns here lets the
    parquet reader prune them; filters applied later are pushed into the scan."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def read_stream(spark: SparkSession, path: str, schema: StructType, columns: Sequence[str] | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan over a folder of parquet files (A1).

    A file stream needs its schema up front; catalog tables can use
    ``spark.readStream.table(name)`` instead, see :func:`stream_view`.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def stream_view(spark: SparkSession, table_name: str, view_name: str | None = None) -> DataFrame:
    """Named streaming view over a catalog table (A6): the DataFrame, optionally
    also registered as a temp view so SQL can refer to it."""
    df = spark.readStream.table(table_name)
    if view_name:
        df.createOrReplaceTempView(view_name)
    return df
