"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.session import shared_dir

# White space of the word patterns ``[^\x20\x09-\x0D]+`` as code points.
SPACE_CHARS = "\t\n\x0b\x0c\r "

# Rows per Arrow batch handed to Python: texts can be long, so batches are
# kept to a few hundred rows and cut further by ``text_batches``.
ARROW_ROWS = 500
BATCH_CHARS = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """Limit the rows of an Arrow batch (a batch is held whole in Python)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage: what follows survives a lost executor without running
    the upstream again, and is computed once however often it is read.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text"):
    """The text column with NULL read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def large_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 * BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Join small Arrow batches to ones of about ``limit`` bytes of ``column`` (larger ones are cut first)."""
    held, total = [], 0
    for batch in text_batches(batches, column, limit):
        size = batch.column(column).nbytes
        if held and total + size > limit:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
        held.append(batch)
        total += size
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``limit`` bytes of ``column``.

    A single longer text stays whole, in a batch of its own.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        first = total = 0
        for i, size in enumerate(sizes):
            if i > first and total + size > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += int(size)
        yield batch.slice(first)
