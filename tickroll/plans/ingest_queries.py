"""Registered incremental-ingest queries (pairs, resume points, pages, upserts)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickroll.functions.timefn import interval_ms
from tickroll.operators import candles as C
from tickroll.operators import incremental as I
from tickroll.operators import merge as M
from tickroll.plans.oracle_sql import C3, CANDLE_COLS, TICKS, c3_cte, rollup_cte, with_
from tickroll.plans.registry import query
from tickroll.session import shared_dir
from tickroll.sources import landed as L
from tickroll.sources import testdata as T
from tickroll.streaming import ingest as SI

# The pairs in SQL: every (SYMBOL, exchange) seen in the ticks, plus the
# '...USD' pairs of variant C for the event types that keep a list.
PAIRS_CTE = """
pairs AS (
  SELECT DISTINCT symbol, exchange FROM ticks
  UNION
  SELECT upper(lower(symbol)) || 'USD', max(exchange) FROM ticks
  WHERE lower(symbol) IN ('signup', 'purchase') GROUP BY symbol)"""
PAIRS_SQL = TICKS + "," + PAIRS_CTE

CKPT_SQL = """,
ckpt AS (
  SELECT symbol, exchange, '3m' AS timeframe, max(timestamp) AS last_ts_ms, '2024-01-15 00:00:00' AS updated_at
  FROM c3 WHERE timestamp < 1705276800000 AND exchange <> 'x2' GROUP BY symbol, exchange
  UNION ALL
  SELECT DISTINCT symbol, exchange, '1h', CAST(0 AS BIGINT), '2024-01-15 00:00:00' FROM c3)"""

SINCE_SQL = """,
since AS (
  SELECT p.symbol, p.exchange, coalesce(k.last_ts_ms + 1, 1705622400000) AS since_ms
  FROM pairs p LEFT JOIN (SELECT * FROM ckpt WHERE timeframe = '3m') k USING (symbol, exchange)),
newrows AS (
  SELECT c3.* FROM c3 JOIN since USING (symbol, exchange) WHERE c3.timestamp >= since.since_ms)"""


def _pairs(spark, sf_dir):
    return I.explode_pairs(T.pair_metadata(spark, sf_dir))


def _since(spark, sf_dir):
    return I.since_per_pair(_pairs(spark, sf_dir), T.checkpoint_table(spark, sf_dir), "3m",
                            now_ms=T.SYNC_NOW_MS, since_days=T.SYNC_SINCE_DAYS)


def _new_rows(spark, sf_dir):
    return I.incremental_new_rows(T.candles_3m(spark, sf_dir), _since(spark, sf_dir))


@query("explode_pairs", with_(PAIRS_SQL) + "\nSELECT symbol, exchange FROM pairs")
def q_explode_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query("pair_rejects", """
SELECT CAST(count(DISTINCT event_type) FILTER (WHERE event_type = 'error') AS BIGINT) AS null_symbol,
       CAST(count(DISTINCT event_type) FILTER (WHERE event_type IN ('view', 'click')) AS BIGINT) AS empty_list
FROM events""")
def q_pair_rejects(spark, sf_dir):
    return I.pair_rejects(T.pair_metadata(spark, sf_dir)).select(
        F.col("null_symbol").cast("long"), F.col("empty_list").cast("long"))


@query("market_symbol", with_(PAIRS_SQL) + "\nSELECT symbol, exchange, symbol || '/USDT' AS market FROM pairs")
def q_market_symbol(spark, sf_dir):
    return _pairs(spark, sf_dir).withColumn("market", I.market_symbol("symbol", "USDT"))


@query("since_per_pair", with_(C3 + "," + PAIRS_CTE + CKPT_SQL + SINCE_SQL)
       + "\nSELECT symbol, exchange, since_ms FROM since")
def q_since_per_pair(spark, sf_dir):
    return _since(spark, sf_dir)


@query("incremental_new_rows", with_(C3 + "," + PAIRS_CTE + CKPT_SQL + SINCE_SQL)
       + f"\nSELECT {CANDLE_COLS} FROM newrows")
def q_incremental_new_rows(spark, sf_dir):
    return _new_rows(spark, sf_dir).select(*C.CANDLE_COLUMNS)


RUN_UPDATED = "2024-01-20 00:00:00"


@query("checkpoint_next", with_(C3 + "," + PAIRS_CTE + CKPT_SQL + SINCE_SQL) + """,
newest AS (SELECT symbol, exchange, max(timestamp) AS nts FROM newrows GROUP BY symbol, exchange),
k3 AS (SELECT * FROM ckpt WHERE timeframe = '3m')
SELECT c.symbol, c.exchange, c.timeframe, c.last_ts_ms, c.updated_at FROM ckpt c
WHERE NOT (c.timeframe = '3m' AND EXISTS (SELECT 1 FROM newest n WHERE n.symbol = c.symbol AND n.exchange = c.exchange))
UNION ALL
SELECT n.symbol, n.exchange, '3m', greatest(n.nts, coalesce(k3.last_ts_ms, n.nts)), '2024-01-20 00:00:00'
FROM newest n LEFT JOIN k3 USING (symbol, exchange)""")
def q_checkpoint_next(spark, sf_dir):
    return I.checkpoint_next(T.checkpoint_table(spark, sf_dir), _new_rows(spark, sf_dir), "3m", RUN_UPDATED)


@query("ingest_candle_pages", with_(C3) + f"\nSELECT {CANDLE_COLS} FROM c3")
def q_ingest_candle_pages(spark, sf_dir):
    """Candles of pages with text numbers, short rows and bad JSON: no good row is lost."""
    return L.candle_pages(T.dirty_candle_pages(spark, sf_dir)).select(*C.CANDLE_COLUMNS)


@query("page_rejects", with_(C3) + """,
d AS (SELECT DISTINCT symbol, exchange, timestamp // 86400000 AS day FROM c3)
SELECT symbol, exchange, 'short_row' AS reason, count(*) AS n FROM d WHERE day % 4 = 1 GROUP BY ALL
UNION ALL SELECT symbol, exchange, 'no_time', count(*) FROM d WHERE day % 4 = 1 GROUP BY ALL
UNION ALL SELECT symbol, exchange, 'bad_json', count(*) FROM d WHERE day % 4 = 2 GROUP BY ALL""")
def q_page_rejects(spark, sf_dir):
    """What can't be used in those pages, by pair and reason."""
    return L.page_rejects(T.dirty_candle_pages(spark, sf_dir))


# Pages that land more than once. Days 2 modulo 4 land cut off, the others with volumes of 0; good
# copies land later, listed before the old ones for every other day.
GOOD_FROM = 19742                 # 2024-01-20: later cut pages get no good copy in ``gap_checkpoints``


def _landed_twice(spark, sf_dir):
    good = T.landed_candle_pages(spark, sf_dir)
    spoilt = F.when(F.pmod("page_seq", F.lit(4)) == 2, F.expr("left(payload, length(payload) - 2)")).otherwise(
        F.regexp_replace("payload", r",([0-9.E+-]+)\]", ",0]"))
    return good.withColumn("payload", spoilt).withColumn("landed_seq", F.lit(1)), good.withColumn("landed_seq", F.lit(2))


def _ingested(spark, batches):
    base = shared_dir(spark, "relanded")
    candles, ckpts, rejects = SI.candle_table(spark, f"{base}/c"), SI.checkpoint_table(spark, f"{base}/k"), SI.reject_table(spark, f"{base}/r")
    for pages in batches:
        SI.ingest_batch(spark, L.decode_pages(pages, keep=["page_seq", "landed_seq"]), candles, ckpts, None, "3m", RUN_UPDATED, rejects)
    return candles, ckpts, rejects


@query("relanded_pages", with_(C3) + f"\nSELECT {CANDLE_COLS} FROM c3")
def q_relanded_pages(spark, sf_dir):
    """Both copies of each page in one batch: the one that landed last wins, in whichever order they are listed."""
    old, new = _landed_twice(spark, sf_dir)
    even = F.pmod("page_seq", F.lit(2)) == 0
    pages = new.where(even).unionByName(old).unionByName(new.where(~even))
    candles, _, _ = _ingested(spark, [pages])
    return candles.read().select(*C.CANDLE_COLUMNS)


@query("gap_checkpoints", with_(C3) + f""",
d AS (SELECT *, timestamp // 86400000 AS day FROM c3),
b AS (SELECT symbol, exchange, min(day) AS bad FROM d WHERE day % 4 = 2 AND day >= {GOOD_FROM} GROUP BY ALL)
SELECT symbol, exchange, '3m' AS timeframe,
       max(timestamp) FILTER (WHERE bad IS NULL OR day < bad) AS last_ts_ms,
       max(timestamp) FILTER (WHERE day % 4 <> 2 OR day < {GOOD_FROM}) AS high_ts_ms,
       CAST(count(DISTINCT day) FILTER (WHERE day % 4 = 2 AND day >= {GOOD_FROM}) AS BIGINT) AS gaps
FROM d LEFT JOIN b USING (symbol, exchange) GROUP BY symbol, exchange
HAVING count(*) FILTER (WHERE day % 4 <> 2 OR day < {GOOD_FROM}) > 0""")
def q_gap_checkpoints(spark, sf_dir):
    """Cut pages hold their pair's checkpoint; good copies of the earlier ones let it move on to the next gap."""
    old, new = _landed_twice(spark, sf_dir)
    _, ckpts, rejects = _ingested(spark, [old, new.where((F.pmod("page_seq", F.lit(4)) == 2) & (F.col("page_seq") < GOOD_FROM))])
    gaps = rejects.read().groupBy(*I.PAIR_KEYS).agg(F.count(F.lit(1)).alias("gaps"))
    return ckpts.read().join(gaps, list(I.PAIR_KEYS), "left").select(
        *I.CHECKPOINT_KEYS, "last_ts_ms", "high_ts_ms", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"))


# Candle upsert: the stored table was written while the 12:00 candle of
# 2024-01-20 was still forming; the batch re-reads everything from 01-15.
UPSERT_CUT_US = 1705752090000000   # 2024-01-20T12:01:30Z
REFETCH_FROM_US = 1705276800000000  # 2024-01-15T00:00:00Z


@query("upsert_candles", with_(TICKS, ",", c3_cte("tgt", f"ts_us < {UPSERT_CUT_US}"),
                              ",", c3_cte("bat", f"ts_us >= {REFETCH_FROM_US}"))
       + f"""
SELECT {CANDLE_COLS} FROM tgt ANTI JOIN bat USING (symbol, exchange, timestamp)
UNION ALL SELECT {CANDLE_COLS} FROM bat""")
def q_upsert_candles(spark, sf_dir):
    ticks = T.ticks(spark, sf_dir)
    b3 = interval_ms("3m")
    target = C.ticks_to_candles(ticks.where(F.col("ts_us") < F.lit(UPSERT_CUT_US)), b3)
    batch = C.ticks_to_candles(ticks.where(F.col("ts_us") >= F.lit(REFETCH_FROM_US)), b3)
    return M.upsert_update(target.select(*C.CANDLE_COLUMNS), batch.select(*C.CANDLE_COLUMNS),
                           C.CANDLE_KEYS, order=None)


# Rollup write: the stored 1h table ends with a partial 12:00 hour of
# 2024-01-10; the run re-aggregates everything from 2024-01-10 00:00.
ROLLUP_CUT_MS = 1704889800000     # 2024-01-10T12:30:00Z
ROLLUP_FROM_MS = 1704844800000    # 2024-01-10T00:00:00Z
ROLLUP_TO_MS = 1706745600000      # 2024-02-01T00:00:00Z


@query("rollup_upsert", with_(C3, rollup_cte("old", "c3", 3_600_000, f"timestamp < {ROLLUP_CUT_MS}"),
                              rollup_cte("new", "c3", 3_600_000,
                                         f"timestamp >= {ROLLUP_FROM_MS} AND timestamp < {ROLLUP_TO_MS}"))
       + f"""
SELECT {CANDLE_COLS} FROM old ANTI JOIN new USING (symbol, exchange, timestamp)
UNION ALL SELECT {CANDLE_COLS} FROM new""")
def q_rollup_upsert(spark, sf_dir):
    from tickroll.functions.timefn import RunRange
    c3 = T.candles_3m(spark, sf_dir)
    b = interval_ms("1h")
    old = C.rollup(c3.where(F.col("timestamp") < F.lit(ROLLUP_CUT_MS)), b)
    new = C.rollup(c3, b, RunRange(ROLLUP_FROM_MS, ROLLUP_TO_MS))
    return M.upsert_update(old.select(*C.CANDLE_COLUMNS), new.select(*C.CANDLE_COLUMNS),
                           C.CANDLE_KEYS, order=None)
