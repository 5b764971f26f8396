"""Landed payload sources.

Fetching from remote APIs is outside the engine: a fetcher lands each
response as one row (request_key, seq, payload text). These readers turn
landed rows into typed DataFrames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.functions import jsonfn as J

LANDED_SCHEMA = "request_key string, seq long, payload string"
PAGE_SCHEMA = "symbol string, exchange string, page_seq long, payload string"
LANDED = "landed_seq"
CANDLE_FIELDS = ("open", "high", "low", "close", "volume")


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed payload rows from a folder (parquet or JSON lines)."""
    reader = spark.read.schema(LANDED_SCHEMA) if fmt == "json" else spark.read
    return reader.format(fmt).load(path)


def with_arrival(pages: DataFrame) -> DataFrame:
    """Adds ``landed_seq``, the order of arrival: the file's modification time, then its name."""
    return pages.withColumn(LANDED, F.struct(F.col("_metadata.file_modification_time").alias("at"), F.col("_metadata.file_path").alias("file")))


def write_pages(pages: DataFrame, path: str) -> None:
    """Land candle pages by UTC day (``page_seq``), so that a run opens the days that it wants only."""
    pages.write.mode("append").partitionBy("page_seq").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed candle pages with ``landed_seq``."""
    return with_arrival(spark.read.schema(PAGE_SCHEMA).parquet(path))


def parse_payloads(landed: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Adds ``doc``: the payload as VARIANT (NULL for text that is not JSON)."""
    return landed.withColumn("doc", J.parse(payload_col))


def payload_kinds(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """Adds ``doc_kind``: 'OBJECT', 'ARRAY', a scalar kind, or NULL for bad JSON."""
    kind = (F.when(J.is_object(doc_col), F.lit("OBJECT"))
             .when(J.is_array(doc_col), F.lit("ARRAY"))
             .otherwise(J.kind(doc_col)))
    return docs.withColumn("doc_kind", kind)


def decode_pages(pages: DataFrame, payload_col: str = "payload", keys=("symbol", "exchange"),
                 keep=()) -> DataFrame:
    """Pages of ``[[ts, o, h, l, c, v], ...]`` -> one row per candle, with ``position`` and ``reject``.

    Fields are read one by one (numbers, or text that says a number; null
    stays NULL), so what is wrong with one costs no other. ``reject`` names
    why a row can't be used: ``bad_json`` (a page that is no JSON array: one
    row for the page), ``short_row`` (no array of six values), ``no_time`` or
    ``bad_number``; it is NULL for usable rows. An empty array gives no rows.
    """
    # A page is parsed once, and each of its rows read once, as an array of texts inside the generator: what a
    # filter above refers to are the generator's columns, so Spark can't move it down to where it would parse again.
    parsed = pages.select(*keys, *keep, J.as_array(J.parse(payload_col)).alias("_rows"))
    texts = F.transform("_rows", lambda row: F.try_variant_get(row, "$", "array<string>"))
    each = parsed.select(*keys, *keep, F.col("_rows").isNull().alias("_bad"), F.posexplode_outer(
        F.coalesce(texts, F.array(F.lit(None).cast("array<string>")))).alias("position", "_f")).where(F.col("position").isNotNull())
    text = lambda i: F.get("_f", F.lit(i))
    values = [text(i + 1).try_cast("double").alias(c) for i, c in enumerate(CANDLE_FIELDS)]
    each = each.select(*keys, *keep, "position", "_bad", F.coalesce(F.size("_f"), F.lit(0)).alias("_n"),
                       text(0).try_cast("decimal(20,0)").try_cast("long").alias("timestamp"), *values,
                       F.array(*[text(i + 1) for i in range(len(CANDLE_FIELDS))]).alias("_texts"))
    unread = [F.col(c).isNull() & F.get("_texts", F.lit(i)).isNotNull() for i, c in enumerate(CANDLE_FIELDS)]
    unread = unread[0] | unread[1] | unread[2] | unread[3] | unread[4]
    reject = (F.when(F.col("_bad"), F.lit("bad_json")).when(F.col("_n") < 6, F.lit("short_row"))
              .when(F.col("timestamp").isNull(), F.lit("no_time")).when(unread, F.lit("bad_number")))
    return each.withColumn("reject", reject).drop("_bad", "_n", "_texts")


def candle_pages(pages: DataFrame, payload_col: str = "payload",
                 keys=("symbol", "exchange"), keep=()) -> DataFrame:
    """The usable candles of all pages of all pairs (see ``decode_pages``)."""
    return decode_pages(pages, payload_col, keys, keep).where("reject is null").drop("reject", "position")


def page_rejects(pages: DataFrame, payload_col: str = "payload", keys=("symbol", "exchange")) -> DataFrame:
    """Unusable rows per pair and reason."""
    return (decode_pages(pages, payload_col, keys).where("reject is not null")
            .groupBy(*keys, F.col("reject").alias("reason")).agg(F.count(F.lit(1)).alias("n")))
