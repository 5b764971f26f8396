"""Parquet table scans.

Reads always name their columns so Catalyst's column pruning reaches the
Parquet reader (``ReadSchema`` only holds what a query uses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def scan_codes(table: DataFrame, code_column: str = "code") -> DataFrame:
    """All codes of a table (one column, no de-duplication)."""
    return table.select(F.col(code_column).alias("code"))
