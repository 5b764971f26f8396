"""Registered candle queries: rollups, ranks, bucket floors, backfill, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.functions.timefn import (BATCH_DAYS, DAY_MS, LOOKBACK_DAYS, RunRange,
                                       bucket_floor, interval_ms)
from tickroll.operators import candles as C
from tickroll.plans.oracle_sql import C3, CANDLE_COLS, rollup_cte, with_
from tickroll.plans.registry import query
from tickroll.sources import testdata as T

ROLLUP_INTERVALS = ("15m", "1h", "4h", "8h", "1d", "7d")


def _register_rollup(name: str):
    bms = interval_ms(name)

    def run(spark, sf_dir) -> DataFrame:
        return C.rollup(T.candles_3m(spark, sf_dir), bms).select(*C.CANDLE_COLUMNS)

    sql = with_(C3, rollup_cte("r", "c3", bms)) + f"\nSELECT {CANDLE_COLS} FROM r"
    query(f"ohlcv_{name}", sql)(run)


for _n in ROLLUP_INTERVALS:
    _register_rollup(_n)


@query("bucket_floor", with_(C3) + "\nSELECT symbol, exchange, timestamp, " + ", ".join(
    f"timestamp - (timestamp % {interval_ms(n)}) AS bucket_{n}" for n in ROLLUP_INTERVALS)
    + ", dayofweek(make_timestamp((timestamp - (timestamp % 604800000)) * 1000)) AS week_start_dow FROM c3")
def q_bucket_floor(spark, sf_dir):
    c3 = T.candles_3m(spark, sf_dir)
    w = bucket_floor("timestamp", interval_ms("7d"))
    return c3.select("symbol", "exchange", "timestamp",
                     *[bucket_floor("timestamp", interval_ms(n)).alias(f"bucket_{n}") for n in ROLLUP_INTERVALS],
                     # 0 = Sunday .. 6 = Saturday; 7-day buckets start on Thursday (4)
                     (F.dayofweek(F.timestamp_millis(w)) - 1).cast("long").alias("week_start_dow"))


@query("candle_rank", with_(C3) + f"""
SELECT symbol, exchange, timestamp, timestamp - (timestamp % 3600000) AS bucket_ts,
       row_number() OVER (PARTITION BY symbol, exchange, timestamp - (timestamp % 3600000) ORDER BY timestamp) AS rn_asc,
       row_number() OVER (PARTITION BY symbol, exchange, timestamp - (timestamp % 3600000) ORDER BY timestamp DESC) AS rn_desc
FROM c3""")
def q_candle_rank(spark, sf_dir):
    r = C.candle_rank(T.candles_3m(spark, sf_dir), interval_ms("1h"))
    return r.select("symbol", "exchange", "timestamp", "bucket_ts",
                    F.col("rn_asc").cast("long"), F.col("rn_desc").cast("long"))


@query("filtered_agg", with_(C3, rollup_cte("r", "c3", interval_ms("1h"))) + f"\nSELECT {CANDLE_COLS} FROM r")
def q_filtered_agg(spark, sf_dir):
    return C.rollup_by_rank(T.candles_3m(spark, sf_dir), interval_ms("1h")).select(*C.CANDLE_COLUMNS)


# Backfill of an explicit range given as run arguments.
BACKFILL_RUN = "2024-02-01T00:00:00Z"
BACKFILL_SINCE = "2024-01-08T00:00:00Z"
BACKFILL_UNTIL = "2024-01-22T12:34:56+02:00"


@query("ohlcv_backfill", with_(C3, rollup_cte(
    "r", "c3", 3_600_000,
    "timestamp >= (epoch_ms(TIMESTAMPTZ '2024-01-08 00:00:00+00') // 3600000) * 3600000 "
    "AND timestamp < (epoch_ms(TIMESTAMPTZ '2024-01-22 12:34:56+02') // 3600000) * 3600000"))
    + f"\nSELECT {CANDLE_COLS} FROM r")
def q_ohlcv_backfill(spark, sf_dir):
    bms = interval_ms("1h")
    rr = RunRange.resolve(bms, BACKFILL_RUN, LOOKBACK_DAYS["1h"], since=BACKFILL_SINCE, until=BACKFILL_UNTIL)
    return C.rollup(T.candles_3m(spark, sf_dir), bms, rr).select(*C.CANDLE_COLUMNS)


# Scheduled run at the end of the data: each interval's look-back range.
COUNTS_RUN = "2024-01-31T00:00:00Z"


def _counts_sql() -> str:
    parts = []
    for n in ROLLUP_INTERVALS:
        bms = interval_ms(n)
        rr = RunRange.resolve(bms, COUNTS_RUN, LOOKBACK_DAYS[n])
        width = -(-(BATCH_DAYS[n] * DAY_MS) // bms) * bms
        nslices = -(-(rr.end_ms - rr.start_ms) // width)
        parts.append(rollup_cte(f"r_{n}", "c3", bms,
                                f"timestamp >= {rr.start_ms} AND timestamp < {rr.end_ms}")
                     + f""",
g_{n} AS (SELECT range AS slice FROM range({nslices})),
k_{n} AS (SELECT (timestamp - {rr.start_ms}) // {width} AS slice, count(*) AS candles FROM r_{n} GROUP BY 1),
s_{n} AS (
  SELECT '{n}' AS interval, {rr.start_ms} + g.slice * {width} AS slice_start,
         least({rr.start_ms} + (g.slice + 1) * {width}, {rr.end_ms}) AS slice_end,
         CAST(coalesce(k.candles, 0) AS BIGINT) AS candles
  FROM g_{n} g LEFT JOIN k_{n} k ON g.slice = k.slice)""")
    body = with_(C3, *parts)
    return body + "\n" + "\nUNION ALL\n".join(f"SELECT * FROM s_{n}" for n in ROLLUP_INTERVALS)


@query("rollup_counts", _counts_sql())
def q_rollup_counts(spark, sf_dir):
    c3 = T.candles_3m(spark, sf_dir)
    ranges = {n: RunRange.resolve(interval_ms(n), COUNTS_RUN, LOOKBACK_DAYS[n]) for n in ROLLUP_INTERVALS}
    return C.rollup_counts(spark, c3, ranges)


SMALL_SQL = with_(C3) + ", small AS (SELECT * REPLACE (volume / 1000 AS volume) FROM c3)"


@query("ohlcv_small_volumes", SMALL_SQL + rollup_cte("r", "small", interval_ms("1h")) + f"\nSELECT {CANDLE_COLS} FROM r")
def q_ohlcv_small_volumes(spark, sf_dir):
    """Hourly candles whose volumes have five decimals."""
    c3 = T.candles_3m(spark, sf_dir)
    return C.rollup(c3.withColumn("volume", F.col("volume") / 1000), interval_ms("1h")).select(*C.CANDLE_COLUMNS)


@query("ohlcv_7d_cascade", with_(C3, rollup_cte("r", "c3", interval_ms("7d"))) + f"\nSELECT {CANDLE_COLS} FROM r")
def q_ohlcv_7d_cascade(spark, sf_dir):
    """7d candles built level by level (3m -> 15m -> 1h -> 4h -> 8h -> 1d -> 7d).

    Each level reads only the previous one (a few rows per bucket), which is
    how a deployment keeps the larger intervals cheap; exact volume sums
    make it equal to the direct rollup.
    """
    return C.cascade(T.candles_3m(spark, sf_dir))["7d"].select(*C.CANDLE_COLUMNS)


@query("candle_datetime", with_(C3, rollup_cte("r", "c3", interval_ms("1h"))) + """
SELECT symbol, exchange, timestamp, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S') AS datetime
FROM r""")
def q_candle_datetime(spark, sf_dir):
    """The stored ``datetime`` of each candle (epoch ms -> timestamp, UTC),
    rendered as text for a zone-independent comparison."""
    h = C.rollup(T.candles_3m(spark, sf_dir), interval_ms("1h"), with_datetime=True)
    return h.select("symbol", "exchange", "timestamp",
                    F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime"))
