"""Bucketed tables: merges that leave the target where it lies.

A table bucketed by its conflict keys is read with that partitioning, so a
merge shuffles the batch only, into the target's buckets; the target's rows are
neither exchanged nor collected, and every task writes the one bucket that it
joined. Use it for keyed tables without a time column, where ``KeyedTable``
would have a single folder.

The catalog holds the tables, so names live as long as its metastore does. A
merge makes a new table; a caller points readers to it (a view, for example)
and drops the old one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickroll.operators import merge as M


def write_bucketed(df: DataFrame, name: str, keys, buckets: int, path: str, dealt: bool = False) -> None:
    """``df`` as the catalog table ``name`` in ``buckets`` buckets of ``keys``, sorted within each; one file a bucket.

    ``dealt`` says that every task of ``df`` holds the rows of one bucket already.
    """
    keys = list(keys)
    rows = df if dealt else df.repartition(buckets, *keys)
    (rows.write.format("parquet").mode("errorifexists").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def merge_plan(spark: SparkSession, target: str, batch: DataFrame, keys, policy: str = "update",
               order: str | None = "_seq", mapped=None) -> DataFrame:
    """The merge of ``batch`` into the bucketed table ``target`` (semantics of ``operators.merge``)."""
    keep = "last" if policy == "update" else "first"
    return M.upsert(spark.table(target), batch, keys, policy, order=order, keep=keep, mapped=mapped)


def merge_bucketed(spark: SparkSession, target: str, batch: DataFrame, keys, buckets: int, into: str, path: str,
                   policy: str = "update", order: str | None = "_seq", mapped=None) -> DataFrame:
    """Merge ``batch`` into ``target`` as the new table ``into`` with the same buckets; returns it."""
    merged = merge_plan(spark, target, batch, keys, policy, order, mapped)
    # the join's tasks are the target's buckets: what they give is written without another exchange
    write_bucketed(merged, into, keys, buckets, path, dealt=True)
    return spark.table(into)
