"""Registered queries that run the scheduled jobs end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickroll.functions.timefn import LOOKBACK_DAYS, RunRange, interval_ms
from tickroll.operators import candles as C
from tickroll.plans import jobs as JB
from tickroll.plans.ingest_queries import CKPT_SQL, PAIRS_CTE, SINCE_SQL
from tickroll.plans import loads as LD
from tickroll.plans import payload_queries as PQ
from tickroll.plans.oracle_sql import C3, STORED_COLS, rollup_cte, with_
from tickroll.plans.registry import query
from tickroll.session import shared_dir
from tickroll.sources import testdata as T
from tickroll.plans.stream_queries import stored_rows
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.tables import scan_codes

JOB_RUN = "2024-01-20T00:00:00Z"
JOB_RUN_MS = 1705708800000        # the same instant
PREV_RUN_CUT_MS = 1705149000000   # 2024-01-13T12:30:00Z: an earlier run saw a partial hour


def _rollup_job(spark, sf_dir):
    base = shared_dir(spark, "rollup-job")
    source = KeyedTable(spark, f"{base}/ohlcv_3m", C.CANDLE_KEYS, "timestamp")
    source.merge(C.stored(T.candles_3m(spark, sf_dir)), unique=True)
    target = KeyedTable(spark, f"{base}/ohlcv_1h", C.CANDLE_KEYS, "timestamp")
    target.merge(C.stored(C.rollup(source.read().where(F.col("timestamp") < F.lit(PREV_RUN_CUT_MS)), interval_ms("1h"))), unique=True)
    counts = JB.rollup_job(spark, source, target, "1h", JOB_RUN)
    return target, counts


@query("rollup_job", with_(C3, rollup_cte("r", "c3", interval_ms("1h"), f"timestamp < {JOB_RUN_MS}"))
       + f"\nSELECT {STORED_COLS} FROM r")
def q_rollup_job(spark, sf_dir):
    """Two scheduled 1h runs: the second replaces the partial hour of the first."""
    target, _ = _rollup_job(spark, sf_dir)
    return stored_rows(target)


def _job_counts_sql() -> str:
    rr = RunRange.resolve(interval_ms("1h"), JOB_RUN, LOOKBACK_DAYS["1h"])
    width = 7 * 86_400_000
    return with_(C3, rollup_cte("r", "c3", interval_ms("1h"),
                                f"timestamp >= {rr.start_ms} AND timestamp < {rr.end_ms}")) + f"""
SELECT '1h' AS interval, {rr.start_ms} + s.range * {width} AS slice_start,
       least({rr.start_ms} + (s.range + 1) * {width}, {rr.end_ms}) AS slice_end,
       CAST(count(r.timestamp) AS BIGINT) AS candles
FROM range(1) s LEFT JOIN r ON (r.timestamp - {rr.start_ms}) // {width} = s.range
GROUP BY s.range"""


@query("rollup_job_counts", _job_counts_sql())
def q_rollup_job_counts(spark, sf_dir):
    """The job's report: candles written per slice."""
    _, counts = _rollup_job(spark, sf_dir)
    return counts


@query("candle_sync_job", with_(C3 + "," + PAIRS_CTE + CKPT_SQL + SINCE_SQL) + f"""
SELECT {STORED_COLS} FROM c3 WHERE timestamp < 1705276800000 AND exchange <> 'x2'
UNION ALL
SELECT {STORED_COLS} FROM newrows""")
def q_candle_sync_job(spark, sf_dir):
    """One ingest run over landed pages into a table holding candles up to
    each pair's checkpoint (pairs on x2 and the '...USD' pairs start fresh)."""
    base = shared_dir(spark, "sync-job")
    c3 = T.candles_3m(spark, sf_dir)
    candles = KeyedTable(spark, f"{base}/ohlcv_3m", C.CANDLE_KEYS, "timestamp")
    candles.merge(C.stored(c3.where((F.col("timestamp") < F.lit(T.CKPT_CUT_MS)) & (F.col("exchange") != "x2"))), unique=True)
    checkpoints = KeyedTable(spark, f"{base}/checkpoints", ["symbol", "exchange", "timeframe"])
    checkpoints.replace(T.checkpoint_table(spark, sf_dir))
    JB.candle_sync_job(spark, T.pair_metadata(spark, sf_dir), T.landed_candle_pages(spark, sf_dir),
                       candles, checkpoints, T.SYNC_NOW_MS, T.SYNC_SINCE_DAYS)
    return stored_rows(candles)


# ---------------------------------------------------------------- table loads
# Each stores an earlier state (or a first run), runs the job twice and reads
# the stored table back.

def _load_table(spark, name: str) -> KeyedTable:
    return LD.stored_table(spark, name, f"{shared_dir(spark, name)}/table")


def _run_twice(spark, name, landed, table, **options):
    for _ in range(2):
        JB.load_job(spark, name, landed, table, **options)
    return table.read().drop("day")


@query("load_stock_list", PQ.STOCK_SQL)
def q_load_stock_list(spark, sf_dir):
    """A run over one listing, then two over all in the configured order."""
    landed, table = T.stock_list_payloads(spark, sf_dir), _load_table(spark, "stock_list")
    JB.load_job(spark, "stock_list", landed, table, listings=["HNX"])
    return _run_twice(spark, "stock_list", landed, table, listings=T.LISTING_ORDER)


@query("scan_codes", f"SELECT code FROM ({PQ.STOCK_SQL})")
def q_scan_codes(spark, sf_dir):
    """The codes of the stored listing table."""
    table = _load_table(spark, "stock_list")
    JB.load_job(spark, "stock_list", T.stock_list_payloads(spark, sf_dir), table, listings=T.LISTING_ORDER)
    return scan_codes(table.read(), "code")


# listed suppliers are those with a balance above zero
_LISTED = "SELECT s_name FROM supplier WHERE s_acctbal > 0"


@query("load_basic_info", f"""
WITH b AS (SELECT * FROM ({PQ.BASIC_B_SQL}) WHERE mack IN ({_LISTED})),
t AS (SELECT s_name AS mack, 'old' AS ten FROM supplier WHERE s_nationkey < 10)
SELECT {PQ._basic_cols_sql('b', {'mack', 'ten', 'vonhoa', 'san_niem_yet', 'donvikiemtoan'})} FROM b
UNION ALL
SELECT {PQ._basic_cols_sql('t', {'mack', 'ten'})} FROM t ANTI JOIN b USING (mack)""")
def q_load_basic_info(spark, sf_dir):
    """Two runs for the listed codes over a stored table of an earlier load."""
    table = _load_table(spark, "basic_info")
    table.replace(PQ.basic_info_stored(spark, sf_dir))
    codes = T.supplier_codes(spark, sf_dir)
    return _run_twice(spark, "basic_info", T.basic_info_payloads(spark, sf_dir), table, codes=codes)


@query("load_vn_eod", f"""
WITH r AS ({PQ.VN_SQL}),
d AS (SELECT *, row_number() OVER (PARTITION BY mack, ngay ORDER BY seq) AS rn FROM r
      WHERE ngay BETWEEN '1998-07-29' AND '1998-08-01' OR ngay BETWEEN '1998-07-20' AND '1998-07-30')
SELECT {PQ._vn_cols_sql()} FROM d WHERE rn = 1""")
def q_load_vn_eod(spark, sf_dir):
    """Runs of two dates with their look-backs; prices that are stored already are not inserted again."""
    table, landed, codes = _load_table(spark, "vn_eod"), T.vn_eod_payloads(spark, sf_dir), T.listed_codes(spark, sf_dir)
    JB.load_job(spark, "vn_eod", landed, table, codes=codes, run_date="1998-07-30", lookback_days=10)
    out = _run_twice(spark, "vn_eod", landed, table, codes=codes, run_date=PQ.EOD_RUN_DATE)
    return PQ._date_str(out, "ngay")


@query("load_fin_indicators", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)
                                        ORDER BY l_orderkey * 10 + l_linenumber DESC) AS rn FROM lineitem
           WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))
SELECT 'S' || l_suppkey AS mack, CAST(quarter(l_shipdate) AS INTEGER) AS quy,
       CAST(year(l_shipdate) AS INTEGER) AS nam, {PQ._fin_sql_values(T.FIN_RATIOS)}
FROM r WHERE rn = 1""")
def q_load_fin_indicators(spark, sf_dir):
    """Two runs for the listed codes."""
    return _run_twice(spark, "fin_indicators", T.fin_payloads(spark, sf_dir), _load_table(spark, "fin_indicators"),
                      columns=T.FIN_RATIOS, codes=T.supplier_codes(spark, sf_dir, "S"))


@query("load_global_eod", PQ.GLOBAL_EOD_SQL)
def q_load_global_eod(spark, sf_dir):
    """Two runs over a stored table of an earlier load."""
    table = _load_table(spark, "global_eod")
    table.replace(T.global_eod_target(spark, sf_dir))
    out = _run_twice(spark, "global_eod", T.global_eod_payloads(spark, sf_dir), table, companies=T.companies(spark, sf_dir))
    return PQ._date_str(out, "date")


_EOD_LANDED = """
WITH p AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderkey % 4 AS shape
           FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal > 0)"""


def _eod_run(spark, sf_dir):
    return JB.load_run(spark, "global_eod", T.global_eod_payloads(spark, sf_dir), _load_table(spark, "global_eod"),
                       companies=T.companies(spark, sf_dir))


@query("load_report", _EOD_LANDED + """
SELECT count(*) AS landed, count(*) FILTER (WHERE shape < 2) AS records, CAST(0 AS BIGINT) AS unreadable,
       count(*) FILTER (WHERE shape = 2) AS message_code, CAST(0 AS BIGINT) AS status,
       count(*) FILTER (WHERE shape = 3) AS wrong_shape,
       count(DISTINCT (o_custkey, o_orderdate)) FILTER (WHERE shape < 2) AS written FROM p""")
def q_load_report(spark, sf_dir):
    """What one global EOD run counted while it wrote: payloads, those without records by reason, records, rows."""
    counts = _eod_run(spark, sf_dir).counts
    return spark.range(1).select(*[F.lit(counts[c]).cast("long").alias(c) for c in ("landed", "records", *JB.LOAD_KINDS, "written")])


@query("load_dead_letters", _EOD_LANDED + """
SELECT o_orderkey AS seq, CASE shape WHEN 2 THEN 'message_code' ELSE 'wrong_shape' END AS kind FROM p WHERE shape >= 2""")
def q_load_dead_letters(spark, sf_dir):
    """The payloads that gave no records in that run, and why."""
    return _eod_run(spark, sf_dir).dead.select("seq", F.col("_kind").alias("kind"))


def _stale_metrics(spark, sf_dir):
    """What an earlier run stored: the same quotes, each dated a year earlier."""
    rows = LD.load_global_metrics(T.metrics_payloads(spark, sf_dir), on_error="skip")
    return rows.withColumn("timestamp", F.col("timestamp") - F.lit(366 * 86_400_000))


@query("truncate_load", PQ.METRICS_SQL)
def q_truncate_load(spark, sf_dir):
    """A table of stale quotes is truncated and loaded anew."""
    table = _load_table(spark, "global_metrics")
    table.replace(_stale_metrics(spark, sf_dir))
    return _run_twice(spark, "global_metrics", T.metrics_payloads(spark, sf_dir), table, truncate=True, on_error="skip")


@query("load_global_metrics", f"""
WITH m AS ({PQ.METRICS_SQL})
SELECT * FROM m
UNION ALL SELECT * REPLACE (timestamp - CAST(366 AS BIGINT) * 86400000 AS timestamp) FROM m""")
def q_load_global_metrics(spark, sf_dir):
    """The same without truncation: stale quotes stay."""
    table = _load_table(spark, "global_metrics")
    table.replace(_stale_metrics(spark, sf_dir))
    return _run_twice(spark, "global_metrics", T.metrics_payloads(spark, sf_dir), table, on_error="skip")
