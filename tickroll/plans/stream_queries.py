"""Registered streaming queries.

Each writes its input once, partitioned by slice, under a fresh folder of the
shared checkpoint directory, lands one slice after the other and runs the
stream once per slice (``availableNow``), like consecutive scheduled runs; the
result is the keyed table the stream maintained, read back as a DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickroll.functions.timefn import DAY_MS, LOOKBACK_DAYS, interval_ms
from tickroll.operators.candles import CANDLE_KEYS, STORED_COLUMNS
from tickroll.plans import loads as LD
from tickroll.plans.oracle_sql import C3, STORED_COLS, rollup_cte, with_
from tickroll.plans.payload_queries import GLOBAL_EOD_SQL
from tickroll.plans.registry import query
from tickroll.session import shared_dir
from tickroll.sources import testdata as T
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import decode_pages
from tickroll.streaming import ingest as SI
from tickroll.streaming import late as SL
from tickroll.streaming import loads as SD
from tickroll.streaming import rollup as SR

INGEST_CUTS_MS = [1704931200000, 1705795200000]   # 2024-01-11, 2024-01-21 (UTC)


def _slices(df: DataFrame, number, folder: str) -> list[DataFrame]:
    """``df`` written once by slice number; the slices in order, each a plain read."""
    spark = df.sparkSession
    df.withColumn("slice", number.cast("int")).write.partitionBy("slice").parquet(folder)
    numbers = sorted(r[0] for r in spark.read.parquet(folder).select("slice").distinct().collect())
    return [spark.read.schema(df.schema).parquet(f"{folder}/slice={n}") for n in numbers]


def stored_rows(table: KeyedTable, schema: str = SR.STORED_SCHEMA) -> DataFrame:
    """The stored candles, their time as text (comparable without a time zone)."""
    rows = table.read()
    rows = table.spark.createDataFrame([], schema) if rows is None else rows
    return rows.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss")).select(*STORED_COLUMNS)


def _ingest_slices(spark, sf_dir, base):
    day = F.col("page_seq") * F.lit(DAY_MS)
    number = F.when(day < INGEST_CUTS_MS[0], 0).when(day < INGEST_CUTS_MS[1], 1).otherwise(2)
    return _slices(T.dirty_candle_pages(spark, sf_dir), number, f"{base}/pages")


def _run_stream_ingest(spark, sf_dir):
    base = shared_dir(spark, "stream-ingest")
    candles, ckpts = SI.candle_table(spark, f"{base}/candles"), SI.checkpoint_table(spark, f"{base}/checkpoints")
    rejects = SI.reject_table(spark, f"{base}/rejects")
    for pages in _ingest_slices(spark, sf_dir, base):
        pages.write.mode("append").parquet(f"{base}/landing")
        # a few files per micro-batch: page files of one run arrive in no
        # particular time order, so a later batch may carry older candles
        SI.run_ingest(spark, f"{base}/landing", candles, ckpts, f"{base}/_stream", "3m",
                      updated_at="2024-01-31 00:00:00", max_files_per_trigger=4, rejects=rejects)
    return candles, ckpts


@query("stream_ingest", with_(C3) + f"\nSELECT {STORED_COLS} FROM c3")
def q_stream_ingest(spark, sf_dir):
    """Pages (some of them dirty) land in three runs; each run upserts candles, then checkpoints."""
    candles, _ = _run_stream_ingest(spark, sf_dir)
    return stored_rows(candles)


@query("stream_checkpoints", with_(C3) + """
SELECT symbol, exchange, '3m' AS timeframe, max(timestamp) AS last_ts_ms,
       '2024-01-31 00:00:00' AS updated_at
FROM c3 GROUP BY symbol, exchange""")
def q_stream_checkpoints(spark, sf_dir):
    """The checkpoint table that ingest batches of clean pages advanced."""
    base = shared_dir(spark, "stream-checkpoints")
    candles, ckpts = SI.candle_table(spark, f"{base}/candles"), SI.checkpoint_table(spark, f"{base}/checkpoints")
    T.landed_candle_pages(spark, sf_dir).write.parquet(f"{base}/landing")
    SI.run_ingest(spark, f"{base}/landing", candles, ckpts, f"{base}/_stream", "3m", updated_at="2024-01-31 00:00:00")
    return ckpts.read().select("symbol", "exchange", "timeframe", "last_ts_ms", "updated_at")


@query("stream_replay", with_(C3) + f"\nSELECT {STORED_COLS} FROM c3")
def q_stream_replay(spark, sf_dir):
    """Batches 1, 2, then 2 again (as after a crash), then 3, which also lands the pages of batch 2 once more."""
    base = shared_dir(spark, "stream-replay")
    candles, ckpts = SI.candle_table(spark, f"{base}/candles"), SI.checkpoint_table(spark, f"{base}/checkpoints")
    parts = _ingest_slices(spark, sf_dir, base)
    if not parts:
        return stored_rows(candles)
    second = parts[min(1, len(parts) - 1)]
    for version, pages in [(1, parts[0]), (2, second), (2, second), (3, parts[-1].unionByName(second))]:
        SI.ingest_batch(spark, decode_pages(pages, keep=["page_seq"]), candles, ckpts, version, "3m", "2024-01-31 00:00:00")
    return stored_rows(candles)


@query("stream_after_batch", with_(C3) + f"\nSELECT {STORED_COLS} FROM c3")
def q_stream_after_batch(spark, sf_dir):
    """Two batch runs write a table, a stream goes on with it, then one with a fresh checkpoint folder, which reads all pages."""
    base = shared_dir(spark, "stream-after-batch")
    candles, ckpts = SI.candle_table(spark, f"{base}/candles"), SI.checkpoint_table(spark, f"{base}/checkpoints")
    rejects = SI.reject_table(spark, f"{base}/rejects")
    parts = _ingest_slices(spark, sf_dir, base)
    for pages in parts[:1] * 2:
        SI.ingest_batch(spark, decode_pages(pages, keep=["page_seq"]), candles, ckpts, None, "3m", "2024-01-31 00:00:00", rejects)
    for number, pages in enumerate(parts[1:]):
        pages.write.mode("append").parquet(f"{base}/landing")
        SI.run_ingest(spark, f"{base}/landing", candles, ckpts, f"{base}/_stream-{number}", "3m",
                      updated_at="2024-01-31 00:00:00", rejects=rejects)
    return stored_rows(candles)


@query("stream_ohlcv_1h", with_(C3, rollup_cte("r", "c3", interval_ms("1h"))) + f"\nSELECT {STORED_COLS} FROM r")
def q_stream_ohlcv_1h(spark, sf_dir):
    """3m candles land week by week (epoch weeks); each run rolls them up."""
    base = shared_dir(spark, "stream-1h")
    table = KeyedTable(spark, f"{base}/ohlcv_1h", CANDLE_KEYS, "timestamp")
    for part in _slices(T.candles_3m(spark, sf_dir), F.expr(f"timestamp div {7 * DAY_MS}"), f"{base}/slices"):
        part.write.mode("append").parquet(f"{base}/source")
        SR.run_rollup(spark, f"{base}/source", "1h", table, f"{base}/_stream", delay="7 days")
    return stored_rows(table)


# late-data run: x2 candles of Jan 1-5 and of Jan 28 12:00 - Jan 30 arrive
# only in a third run, after everything else; the delay is the 15m look-back
LATE_FAR_END = 1704499200000      # 2024-01-06T00:00:00Z
LATE_NEAR = (1706443200000, 1706572800000)   # 2024-01-28T12:00Z .. 2024-01-30T00:00Z
LATE_SPLIT = 1705708800000        # 2024-01-20T00:00:00Z


_NOT_LATE = f"NOT (exchange = 'x2' AND timestamp < {LATE_FAR_END})"


def _late_run(spark, sf_dir, base, keep_late):
    """The three runs; returns the 15m table and, if kept, the late candles."""
    ts = F.col("timestamp")
    late = (F.col("exchange") == "x2") & ((ts < F.lit(LATE_FAR_END))
                                          | ((ts >= F.lit(LATE_NEAR[0])) & (ts < F.lit(LATE_NEAR[1]))))
    number = F.when(late, 2).when(ts < F.lit(LATE_SPLIT), 0).otherwise(1)
    table = KeyedTable(spark, f"{base}/ohlcv_15m", CANDLE_KEYS, "timestamp")
    kept, marks = SL.late_table(spark, f"{base}/late"), SL.mark_table(spark, f"{base}/marks")
    for part in _slices(T.candles_3m(spark, sf_dir), number, f"{base}/slices"):
        part.write.mode("append").parquet(f"{base}/source")
        SR.run_rollup(spark, f"{base}/source", "15m", table, f"{base}/_stream")
        if keep_late:
            SL.run_late(spark, f"{base}/source", "15m", kept, marks, f"{base}/_late")
    return table, kept


@query("stream_late_data", with_(C3, rollup_cte("r", "c3", interval_ms("15m"), _NOT_LATE))
       + f"\nSELECT {STORED_COLS} FROM r")
def q_stream_late_data(spark, sf_dir):
    """Candles later than the watermark are dropped, those within it are not."""
    table, _ = _late_run(spark, sf_dir, shared_dir(spark, "stream-late"), False)
    return stored_rows(table)


@query("stream_late_rows", with_(C3) + f"""
SELECT symbol, exchange, count(*) AS late FROM c3 WHERE NOT ({_NOT_LATE}) GROUP BY symbol, exchange""")
def q_stream_late_rows(spark, sf_dir):
    """The candles that came too late, counted per pair."""
    _, late = _late_run(spark, sf_dir, shared_dir(spark, "stream-late-rows"), True)
    return SL.late_counts(late)


@query("stream_late_backfill", with_(C3, rollup_cte("r", "c3", interval_ms("15m"))) + f"\nSELECT {STORED_COLS} FROM r")
def q_stream_late_backfill(spark, sf_dir):
    """After the backfill of what came too late the table is that of the batch rollup."""
    base = shared_dir(spark, "stream-late-backfill")
    table, late = _late_run(spark, sf_dir, base, True)
    SL.backfill_late(spark.read.schema(SR.CANDLE_SCHEMA).parquet(f"{base}/source"), late, table, "15m")
    return stored_rows(table)


# a cut within a bucket of every interval: the second run changes candles of the first
ALL_CUT_MS = 1705381620000        # 2024-01-16T05:07:00Z
ALL_INTERVALS = tuple(LOOKBACK_DAYS)


@query("stream_ohlcv_all", with_(C3, *[rollup_cte(f"r{i}", "c3", interval_ms(i)) for i in ALL_INTERVALS])
       + "\nUNION ALL ".join(f"\nSELECT '{i}' AS interval, {STORED_COLS} FROM r{i}" for i in ALL_INTERVALS))
def q_stream_ohlcv_all(spark, sf_dir):
    """Candles land in two runs; one stream keeps the tables of all six intervals."""
    base = shared_dir(spark, "stream-all")
    tables = {i: KeyedTable(spark, f"{base}/ohlcv_{i}", CANDLE_KEYS, "timestamp") for i in ALL_INTERVALS}
    number = F.when(F.col("timestamp") < F.lit(ALL_CUT_MS), 0).otherwise(1)
    for part in _slices(T.candles_3m(spark, sf_dir), number, f"{base}/slices"):
        part.write.mode("append").parquet(f"{base}/source")
        SR.run_rollups(spark, f"{base}/source", tables, f"{base}/_stream")
    return reduce(DataFrame.unionByName, [stored_rows(t).withColumn("interval", F.lit(i)) for i, t in tables.items()])


@query("stream_global_eod", GLOBAL_EOD_SQL)
def q_stream_global_eod(spark, sf_dir):
    """Price payloads land in two runs over a stored table; the stream joins them with the company table."""
    base = shared_dir(spark, "stream-global-eod")
    table = LD.stored_table(spark, "global_eod", f"{base}/table")
    table.replace(T.global_eod_target(spark, sf_dir))
    landed = T.global_eod_payloads(spark, sf_dir)
    for part in _slices(landed, F.pmod(F.crc32("ticker"), F.lit(2)), f"{base}/slices"):
        part.write.mode("append").parquet(f"{base}/landing")
        SD.run_load(spark, "global_eod", f"{base}/landing", landed.schema, table,
                    f"{base}/_stream", companies=lambda: T.companies(spark, sf_dir))
    return table.read().drop("day").withColumn("date", F.date_format("date", "yyyy-MM-dd"))
