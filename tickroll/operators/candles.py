"""Candle rollups (OHLCV) as one hash aggregation per interval.

The rollup groups by (symbol, exchange, bucket) with

* open  = value of the first row by time, kept even when NULL (``min_by``)
* close = value of the last row by time (``max_by``)
* high / low = max / min, volume = exact decimal sum cast back to double
  (12 decimals and 26 digits before the point unless the caller asks
  otherwise; a volume beyond that range fails the run, it is never cut).

``min_by``/``max_by`` with a primitive value and a long (or decimal) order
key plan as partial + final ``HashAggregate`` around a single exchange,
so a hot symbol is combined map-side before the shuffle. The literal
two-window form (``row_number`` asc/desc + filtered max) is kept as
``rollup_by_rank`` for cross-checks; it needs a sort per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickroll.functions.timefn import (BATCH_DAYS, DAY_MS,
                                       RunRange, bucket_floor, interval_ms, ms_to_timestamp)

CANDLE_KEYS = ("symbol", "exchange", "timestamp")
CANDLE_COLUMNS = ("symbol", "exchange", "timestamp", "open", "high", "low", "close", "volume")
# What candle tables store: the candle and its time as a timestamp.
STORED_COLUMNS = (*CANDLE_COLUMNS, "datetime")

# Decimals of the exact volume sum; sums are order-independent and identical
# on every engine. The whole part keeps the other digits of a decimal(38).
VOLUME_SCALE = 12


def exact_sum(c, scale: int = VOLUME_SCALE) -> Column:
    """Sum of doubles as decimals of ``scale`` digits after the point, cast back to double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def stored(candles: DataFrame, *more: str) -> DataFrame:
    """Candles with the columns that candle tables store, and ``more``."""
    return candles.withColumn("datetime", ms_to_timestamp("timestamp")).select(*STORED_COLUMNS, *more)


def tie_order(ts_us, tie) -> Column:
    """Single sortable key for (ts_us, tie): keeps min_by/max_by hash-based.

    decimal(38,0) = ts_us * 10^20 + (tie + 2^63); unique and ordered like
    the pair for any long ``tie`` and timestamps before year 5000.
    """
    ts_us = F.col(ts_us) if isinstance(ts_us, str) else ts_us
    tie = F.col(tie) if isinstance(tie, str) else tie
    d = "decimal(38,0)"
    return (ts_us.cast(d) * F.lit(str(10 ** 20)).cast(d)
            + (tie.cast(d) + F.lit(str(2 ** 63)).cast(d)))


def ticks_to_candles(ticks: DataFrame, bucket_ms: int, *, ts_us: str = "ts_us",
                     tie: str | None = "tick_id", price: str = "price",
                     volume: str = "volume", keys=("symbol", "exchange"),
                     volume_scale: int = VOLUME_SCALE) -> DataFrame:
    """Raw ticks -> candles. Ties in time are broken by ``tie`` (ascending)."""
    ticks = ticks.where(F.col(ts_us).isNotNull())
    order = tie_order(ts_us, tie) if tie else F.col(ts_us)
    bucket = F.expr(f"(`{ts_us}` - pmod(`{ts_us}`, {bucket_ms * 1000})) div 1000")
    t = ticks.select(*keys, bucket.alias("timestamp"),
                     order.alias("_ord"), F.col(price).alias("_p"), F.col(volume).alias("_v"))
    return (t.groupBy(*keys, "timestamp")
             .agg(F.min_by("_p", "_ord").alias("open"),
                  F.max("_p").alias("high"),
                  F.min("_p").alias("low"),
                  F.max_by("_p", "_ord").alias("close"),
                  exact_sum("_v", volume_scale).alias("volume")))


def rollup(candles: DataFrame, bucket_ms: int, run_range: RunRange | None = None,
           keys=("symbol", "exchange"), with_datetime: bool = False,
           drop_null_ts: bool = True, volume_scale: int = VOLUME_SCALE) -> DataFrame:
    """Roll candles up to ``bucket_ms`` buckets over ``[start, end)``.

    The range filter is applied to the stored ``timestamp`` column before
    anything is derived from it, so it reaches the Parquet scan as a
    pushed filter; on a day-partitioned table (a ``day`` column, as written
    by ``DayPartitionedTable``) the day range prunes partitions as well.

    ``drop_null_ts=False`` is for inputs that are themselves rollup outputs
    in the same plan: a filter on their ``timestamp`` would be pushed below
    the previous aggregate as that level's bucket expression, and nested
    over several levels it grows exponentially (``x - pmod(x, b)`` uses
    ``x`` twice per level).
    """
    df = candles
    if run_range is not None:
        df = df.where((F.col("timestamp") >= F.lit(run_range.start_ms))
                      & (F.col("timestamp") < F.lit(run_range.end_ms)))
        if "day" in candles.columns:
            # day-partitioned tables: the same range on the partition column
            # lets Spark skip whole day folders (PartitionFilters)
            df = df.where(F.col("day").between(run_range.start_ms // DAY_MS,
                                               (run_range.end_ms - 1) // DAY_MS))
    if drop_null_ts:
        df = df.where(F.col("timestamp").isNotNull())
    out = (df.groupBy(*keys, bucket_floor("timestamp", bucket_ms).alias("timestamp"))
             .agg(F.min_by("open", F.col("timestamp")).alias("open"),
                  F.max("high").alias("high"),
                  F.min("low").alias("low"),
                  F.max_by("close", F.col("timestamp")).alias("close"),
                  exact_sum("volume", volume_scale).alias("volume")))
    if with_datetime:
        out = out.withColumn("datetime", ms_to_timestamp("timestamp"))
    return out


def rollup_interval(candles: DataFrame, interval: str, run_range: RunRange | None = None,
                    **kw) -> DataFrame:
    return rollup(candles, interval_ms(interval), run_range, **kw)


def cascade(candles_3m: DataFrame, intervals=("15m", "1h", "4h", "8h", "1d", "7d")) -> dict:
    """3m -> 15m -> 1h -> ... each from the previous one.

    Every interval divides the next and all are epoch-aligned, and volume
    sums are exact, so each result equals the direct rollup from 3m.
    """
    out, prev = {}, candles_3m
    for i, name in enumerate(intervals):
        # only the first level can meet NULL timestamps (see ``rollup``)
        prev = rollup_interval(prev, name, drop_null_ts=(i == 0))
        out[name] = prev
    return out


def candle_rank(candles: DataFrame, bucket_ms: int, keys=("symbol", "exchange")) -> DataFrame:
    """row_number ascending and descending in time per (keys, bucket).

    The bucket is materialised as a column first, so both windows share
    one partitioning (one exchange).
    """
    b = candles.withColumn("bucket_ts", bucket_floor("timestamp", bucket_ms))
    part = [*keys, "bucket_ts"]
    return (b.withColumn("rn_asc", F.row_number().over(Window.partitionBy(*part).orderBy(F.col("timestamp").asc())))
             .withColumn("rn_desc", F.row_number().over(Window.partitionBy(*part).orderBy(F.col("timestamp").desc()))))


def rollup_by_rank(candles: DataFrame, bucket_ms: int, keys=("symbol", "exchange")) -> DataFrame:
    """The literal windowed form: filtered aggregates over row numbers."""
    r = candle_rank(candles, bucket_ms, keys)
    return (r.groupBy(*keys, F.col("bucket_ts").alias("timestamp"))
             .agg(F.expr("max(open) FILTER (WHERE rn_asc = 1)").alias("open"),
                  F.max("high").alias("high"),
                  F.min("low").alias("low"),
                  F.expr("max(close) FILTER (WHERE rn_desc = 1)").alias("close"),
                  exact_sum("volume").alias("volume")))


def slice_counts(spark, written: DataFrame, interval: str, run_range: RunRange,
                 batch_days: int | None = None) -> DataFrame:
    """Candles per report slice of a run, zero slices included.

    ``written`` holds the run's candles (its ``timestamp`` column). Slices
    are only a reporting unit; their width is rounded up to whole buckets.
    """
    counted = written.select(F.lit(interval).alias("interval"), "timestamp")
    return _report(spark, counted, {interval: run_range}, {interval: batch_days})


def rollup_counts(spark, candles: DataFrame, ranges: dict[str, RunRange],
                  batch_days: dict[str, int] | None = None) -> DataFrame:
    """Candles that each interval's run writes per report slice, zero slices included.

    One pass over the source: every candle is put into its bucket of every
    interval whose range holds it, and (interval, pair, bucket) is counted
    once; a 7d candle is never cut at a slice edge.
    """
    ts = F.col("timestamp")
    buckets = [F.when((ts >= r.start_ms) & (ts < r.end_ms),
                      F.struct(F.lit(name).alias("interval"), bucket_floor(ts, interval_ms(name)).alias("timestamp")))
               for name, r in ranges.items()]
    lowest, highest = min(r.start_ms for r in ranges.values()), max(r.end_ms for r in ranges.values())
    rolled = (candles.where((ts >= lowest) & (ts < highest))
              .select("symbol", "exchange", F.explode(F.array_compact(F.array(*buckets))).alias("b"))
              .select("symbol", "exchange", "b.interval", "b.timestamp").distinct())
    return _report(spark, rolled, ranges, batch_days or {})


def _report(spark, rolled: DataFrame, ranges: dict[str, RunRange], batch_days: dict) -> DataFrame:
    grid, slice_of = [], None
    for name, run in ranges.items():
        days = batch_days.get(name)
        slices = run.slices(BATCH_DAYS.get(name, 1) if days is None else days, interval_ms(name))
        grid += [(name, k, a, b) for k, (a, b) in enumerate(slices)]
        width = slices[0][1] - slices[0][0] if slices else interval_ms(name)
        index = F.expr(f"(timestamp - {run.start_ms}) div {width}")
        hit = (F.col("interval") == name) & (F.col("timestamp") >= run.start_ms) & (F.col("timestamp") < run.end_ms)
        slice_of = F.when(hit, index) if slice_of is None else slice_of.when(hit, index)
    counted = rolled.groupBy("interval", slice_of.alias("slice")).agg(F.count(F.lit(1)).alias("candles"))
    slices = spark.createDataFrame(grid, "interval string, slice long, slice_start long, slice_end long")
    return (slices.join(counted, ["interval", "slice"], "left")
            .select("interval", "slice_start", "slice_end", F.coalesce("candles", F.lit(0)).cast("long").alias("candles")))
