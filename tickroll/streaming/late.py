"""What came too late for the streaming rollup: counted, kept and backfilled.

The rollup stream drops candles whose bucket closed before its watermark. This
stream reads the keys of the same candles, splits off those rows against the
highest event time of its earlier batches (the watermark's own rule: bucket end
<= highest time - delay) and keeps them in a table. A backfill then aggregates
the buckets that they fall into once more, from all stored candles, and empties
the table.

A late candle is one row however often it comes late. Rows without a time are
no candles. A batch commits as (stream id, batch id) in both tables, late rows
first, so a replay adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.functions.timefn import DAY_MS, LOOKBACK_DAYS, bucket_floor, interval_ms
from tickroll.operators.candles import CANDLE_KEYS, rollup, stored
from tickroll.session import stage
from tickroll.sources.keyed_table import KeyedTable
from tickroll.streaming.ingest import RETAIN_HOURS, stream_id

KEY_SCHEMA = "symbol string, exchange string, timestamp long"
BUCKET_KEYS = ("symbol", "exchange", "bucket")


def late_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, CANDLE_KEYS, "timestamp", retain_hours=RETAIN_HOURS)


def mark_table(spark: SparkSession, path: str) -> KeyedTable:
    """One row per interval: the highest event time of the batches so far."""
    return KeyedTable(spark, path, ["interval"], retain_hours=RETAIN_HOURS)


def late_batch(keys: DataFrame, interval: str, late: KeyedTable, marks: KeyedTable, delay_ms: int,
               commit: tuple[str, int] | None = None) -> None:
    """Keep the late rows of one batch of candle keys, then move the mark."""
    spark = late.spark
    keys = stage(keys.where("timestamp is not null").select(*CANDLE_KEYS), "late-keys")
    old = marks.read()
    row = None if old is None else old.where(F.col("interval") == interval).first()
    width = interval_ms(interval)
    closed = F.lit(False) if row is None else bucket_floor("timestamp", width) + width <= F.lit(row["high_ts_ms"] - delay_ms)
    late.merge(keys.where(closed).distinct(), "update", unique=True, commit=commit)
    high = keys.agg(F.max("timestamp")).first()[0]
    known = [x for x in (high, row and row["high_ts_ms"]) if x is not None]
    mark = spark.createDataFrame([(interval, max(known))] if known else [], "interval string, high_ts_ms long")
    marks.merge(mark, "update", unique=True, commit=commit)


def run_late(spark: SparkSession, source_dir: str, interval: str, late: KeyedTable, marks: KeyedTable,
             checkpoint_location: str, delay_days: int | None = None) -> None:
    """Look through all candle files not yet seen (one availableNow run); runs beside ``run_rollup`` of the same delay."""
    delay_ms = (LOOKBACK_DAYS.get(interval, 1) if delay_days is None else delay_days) * DAY_MS
    keys = spark.readStream.schema(KEY_SCHEMA).parquet(source_dir)

    def on_batch(df: DataFrame, batch_id: int) -> None:
        late_batch(df, interval, late, marks, delay_ms, (stream_id(spark, checkpoint_location), batch_id))

    q = (keys.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def late_counts(late: KeyedTable) -> DataFrame:
    """Late candles per pair that no backfill has taken in yet."""
    rows = late.read()
    rows = late.spark.createDataFrame([], KEY_SCHEMA) if rows is None else rows
    return rows.groupBy("symbol", "exchange").agg(F.count(F.lit(1)).alias("late"))


def buckets_again(source: DataFrame, buckets: DataFrame, interval: str) -> DataFrame:
    """The candles of the given (symbol, exchange, bucket) rows, aggregated from ``source``.

    The span of the buckets bounds the scan (pushed down, and by day where the
    source has one); the join then leaves their rows only.
    """
    width = interval_ms(interval)
    first, last = buckets.agg(F.min("bucket"), F.max("bucket")).first()
    if first is None:
        return rollup(source.limit(0), width)
    ts = F.col("timestamp")
    rows = source.where((ts >= first) & (ts < last + width))
    if "day" in source.columns:
        rows = rows.where(F.col("day").between(first // DAY_MS, (last + width - 1) // DAY_MS))
    rows = rows.withColumn("bucket", bucket_floor("timestamp", width)).join(buckets, list(BUCKET_KEYS), "left_semi")
    return rollup(rows.drop("bucket"), width)


def backfill_late(source: DataFrame | KeyedTable, late: KeyedTable, target: KeyedTable, interval: str) -> DataFrame | None:
    """Aggregate the buckets of the late candles again, merge them into ``target`` and empty ``late``.

    ``source`` holds all candles, the late ones too. Returns the candles
    written (None without late rows). Stopped between its two writes it does
    the same work again at the next run.
    """
    rows = late.read()
    if rows is None or rows.isEmpty():
        return None
    source = source.read() if isinstance(source, KeyedTable) else source
    buckets = stage(rows.select("symbol", "exchange", bucket_floor("timestamp", interval_ms(interval)).alias("bucket")).distinct(),
                    "late-buckets")
    written = target.merge(stored(buckets_again(source, buckets, interval)), "update", unique=True)
    late.replace(rows.limit(0))
    return written
