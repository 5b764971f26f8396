"""Tumbling-window candle rollup as a Structured Streaming job.

3-minute candles stream in; an event-time watermark (delay = the interval's
look-back) bounds the state, and ``window(event_time, interval)`` gives
epoch-aligned buckets (7-day windows start on Thursday, like the batch
rollup). Update mode emits every changed candle with its full aggregate,
and ``foreachBatch`` upserts it into the day-partitioned candle table
(only the touched days), so the table converges to the batch rollup of
everything not dropped as late. A batch commits as (stream id, batch id) and
is applied once, whoever else writes the table.

Late data: a candle whose window ended before the watermark (max event
time seen minus the delay) is dropped, like the scheduled original that
never re-aggregates beyond its look-back (``streaming.late`` keeps and
backfills such candles).

``run_rollups`` keeps several intervals in one query: every candle goes into
its bucket of each interval, rows are combined per bucket before the one
shuffle, and one state holds all buckets. Each bucket carries the time at which
it closes (its end plus its own interval's look-back), and that time is the
watermark's column, so a 15m bucket leaves the state after days and not after
the year that 7d candles wait.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.functions.timefn import DAY_MS, INTERVAL_MINUTES, LOOKBACK_DAYS, bucket_floor, interval_ms
from tickroll.operators.candles import exact_sum, stored
from tickroll.session import stage
from tickroll.sources.keyed_table import KeyedTable
from tickroll.streaming.ingest import stream_id

CANDLE_SCHEMA = ("symbol string, exchange string, timestamp long, open double, high double, "
                 "low double, close double, volume double")
STORED_SCHEMA = CANDLE_SCHEMA + ", datetime timestamp"


def windowed_rollup(stream: DataFrame, interval: str, delay: str | None = None) -> DataFrame:
    """Streaming A1: watermark on event time, tumbling window, OHLCV aggregates."""
    minutes = INTERVAL_MINUTES[interval]
    delay = delay or f"{LOOKBACK_DAYS.get(interval, 1)} days"
    s = (stream.withColumn("event_time", F.timestamp_millis("timestamp"))
               .withWatermark("event_time", delay))
    agg = (s.groupBy("symbol", "exchange", F.window("event_time", f"{minutes} minutes").alias("w"))
             .agg(F.min_by("open", "timestamp").alias("open"),
                  F.max("high").alias("high"),
                  F.min("low").alias("low"),
                  F.max_by("close", "timestamp").alias("close"),
                  exact_sum("volume").alias("volume")))
    return agg.select("symbol", "exchange", F.unix_millis(F.col("w.start")).alias("timestamp"),
                      "open", "high", "low", "close", "volume")


def run_rollup(spark: SparkSession, source_dir: str, interval: str, table: KeyedTable,
               checkpoint_location: str, delay: str | None = None) -> None:
    """Roll up all candle files not yet seen (one availableNow run)."""
    stream = spark.readStream.schema(CANDLE_SCHEMA).parquet(source_dir)
    out = windowed_rollup(stream, interval, delay)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        table.merge(stored(df), "update", unique=True, commit=(stream_id(spark, checkpoint_location), batch_id))

    q = (out.writeStream.outputMode("update").foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
    q.awaitTermination()


def windowed_rollups(stream: DataFrame, lookback_days: dict[str, int]) -> DataFrame:
    """Streaming A1 for all intervals of ``lookback_days`` at once; adds ``interval``.

    The watermark lags the highest closing time by as much as that can be ahead
    of its candle (the longest look-back plus that interval's width), so it is
    never ahead of the highest event time, and at most one such width behind:
    a candle within its interval's look-back is never dropped.
    """
    ts = F.col("timestamp")
    ahead = {name: days * DAY_MS + interval_ms(name) for name, days in lookback_days.items()}
    start = {name: bucket_floor(ts, interval_ms(name)) for name in ahead}
    each = F.array(*[F.struct(F.lit(name).alias("interval"), start[name].alias("bucket"),
                              F.timestamp_millis(start[name] + ms).alias("closes")) for name, ms in ahead.items()])
    rows = (stream.where(ts.isNotNull())
            .select("symbol", "exchange", "timestamp", "open", "high", "low", "close", "volume", F.inline(each))
            .withWatermark("closes", f"{max(ahead.values())} milliseconds"))
    agg = (rows.groupBy("symbol", "exchange", "interval", "bucket", "closes")
           .agg(F.min_by("open", "timestamp").alias("open"),
                F.max("high").alias("high"),
                F.min("low").alias("low"),
                F.max_by("close", "timestamp").alias("close"),
                exact_sum("volume").alias("volume")))
    return agg.select("interval", "symbol", "exchange", F.col("bucket").alias("timestamp"), "open", "high", "low", "close", "volume")


def run_rollups(spark: SparkSession, source_dir: str, tables: dict[str, KeyedTable], checkpoint_location: str,
                lookback_days: dict[str, int] | None = None) -> None:
    """Roll up all candle files not yet seen into the table of each interval (one availableNow run, one query).

    A batch is written once and then merged table by table; one that fails in
    between is repeated and skips the tables that have it.
    """
    days = {name: (lookback_days or LOOKBACK_DAYS)[name] for name in tables}
    out = windowed_rollups(spark.readStream.schema(CANDLE_SCHEMA).parquet(source_dir), days)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        changed = stage(df, "rollup-batch")
        for name, table in tables.items():
            table.merge(stored(changed.where(F.col("interval") == name)), "update", unique=True,
                        commit=(stream_id(spark, checkpoint_location), batch_id))

    q = (out.writeStream.outputMode("update").foreachBatch(on_batch)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
    q.awaitTermination()
