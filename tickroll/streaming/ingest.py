"""Incremental candle ingest as a Structured Streaming job.

Landed candle pages arrive as files; each micro-batch is decoded once,
upserted into the day-partitioned candle table (data first, only the days it
touches) and then advances the per-pair checkpoint table (checkpoint second).
A micro-batch commits as (stream id, batch id): replayed after a failure it is
not applied again to a table that has it, and neither batch runs nor other
streams on the same tables get in its way. The stream id is the one that Spark
writes to ``checkpoint_location``, so a stream that starts anew in another
folder is another writer.

Pages are ordered by their arrival (``landed_seq``): of rows that share a key
the one that landed last wins. The reject table holds the rows that are
outstanding, those of the newest copy of each page; a page that lands again
takes the place of what it said before. A pair's checkpoint stands before its
first outstanding row and moves on as soon as a usable copy lands.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.operators.candles import CANDLE_KEYS, stored
from tickroll.operators.incremental import CHECKPOINT_KEYS, LANDED, PAIR_KEYS, checkpoint_advance, gaps_left, page_gaps
from tickroll.session import stage
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import PAGE_SCHEMA, decode_pages, with_arrival

CHECKPOINT_SCHEMA = "symbol string, exchange string, timeframe string, last_ts_ms long, updated_at string"
REJECT_KEYS = ("symbol", "exchange", "page_seq", "position")
REJECT_SCHEMA = "symbol string, exchange string, page_seq long, position int, reject string, after_ts long"
RETAIN_HOURS = 24              # a reader may use a version for as long


def row_order() -> Column:
    """Order of rows that share a key: the last landed wins, then later pages, then later rows of a page."""
    return F.struct(LANDED, "page_seq", "position")


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The id that Spark gave the stream of a checkpoint folder."""
    return json.loads(spark.read.text(f"{checkpoint_location}/metadata").first()[0])["id"]


def ingest_batch(spark: SparkSession, decoded: DataFrame, candles: KeyedTable, checkpoints: KeyedTable,
                 version: int | None, timeframe: str = "3m", updated_at: str | None = None,
                 rejects: KeyedTable | None = None, commit: tuple[str, int] | None = None) -> None:
    """Upsert one batch of decoded rows (with ``page_seq``), then advance the checkpoints.

    ``commit`` names the batch by its writer (see ``KeyedTable``). A caller
    without a writer may number the batch by ``version``; None takes the next
    number. Without a reject table the outstanding rows are the batch's own.
    """
    if LANDED not in decoded.columns:
        decoded = decoded.withColumn(LANDED, F.lit(0))
    decoded = stage(decoded, "ingest-batch")
    usable = decoded.where("reject is null").withColumn("_seq", row_order())
    candles.merge(stored(usable, "_seq"), "update", order="_seq", version=version, commit=commit)

    def before(table: KeyedTable, schema: str) -> DataFrame:
        prior = table.current() if version is None else table.current(before=version)
        return spark.createDataFrame([], schema) if prior is None else table.read(prior)

    old = before(checkpoints, CHECKPOINT_SCHEMA)
    high = old.where(F.col("timeframe") == timeframe).select(
        *PAIR_KEYS, (F.greatest("high_ts_ms", "last_ts_ms") if "high_ts_ms" in old.columns else F.col("last_ts_ms")).alias("high_ts_ms"))
    gaps = page_gaps(decoded, high)
    if rejects is not None:
        # what lands again takes the place of what it said before; the rest is as outstanding as it was
        gaps = gaps_left(before(rejects, REJECT_SCHEMA), decoded).unionByName(gaps)
    gaps = stage(gaps, "ingest-gaps")
    if rejects is not None:
        rejects.replace(gaps, version, commit)
    stamp = F.lit(updated_at) if updated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    checkpoints.replace(checkpoint_advance(old, usable, gaps, timeframe, stamp), version, commit)


def run_ingest(spark: SparkSession, landing_dir: str, candles: KeyedTable, checkpoints: KeyedTable,
               checkpoint_location: str, timeframe: str = "3m", updated_at: str | None = None,
               max_files_per_trigger: int | None = None, fmt: str = "parquet",
               rejects: KeyedTable | None = None) -> None:
    """Process every landed page file not yet seen, then stop (availableNow).

    ``fmt`` is the landing format: 'parquet' or 'json' (JSON lines).
    """
    reader = spark.readStream.schema(PAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = decode_pages(with_arrival(reader.load(landing_dir)), keep=["page_seq", LANDED])

    def on_batch(df: DataFrame, batch_id: int) -> None:
        ingest_batch(spark, df, candles, checkpoints, None, timeframe, updated_at, rejects,
                     commit=(stream_id(spark, checkpoint_location), batch_id))

    q = (rows.writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    q.awaitTermination()


def candle_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, CANDLE_KEYS, "timestamp", retain_hours=RETAIN_HOURS)


def checkpoint_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, CHECKPOINT_KEYS, retain_hours=RETAIN_HOURS)


def reject_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, REJECT_KEYS, retain_hours=RETAIN_HOURS)
