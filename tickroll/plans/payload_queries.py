"""Registered payload, mapping and table-load queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickroll.functions import jsonfn as J
from tickroll.functions.textfn import safe_float_text
from tickroll.functions.timefn import normalize_ts_day
from tickroll.operators import payload as P
from tickroll.operators.mapping import ColumnSpec, map_columns
from tickroll.plans import loads as LD
from tickroll.plans.registry import query
from tickroll.sources import testdata as T
from tickroll.sources.landed import parse_payloads


def _customer_docs(spark, sf_dir):
    return parse_payloads(T.customer_payloads(spark, sf_dir))


CUST_FIELDS = """CASE WHEN c_custkey % 6 = 3 THEN NULL ELSE c_custkey END AS c_custkey,
       CASE WHEN c_custkey % 6 = 3 THEN NULL ELSE c_name END AS c_name,
       CASE WHEN c_custkey % 6 = 3 THEN NULL ELSE c_acctbal END AS c_acctbal"""


def _cust_rows(recs):
    return recs.select(F.col("seq"), F.col("_pos").cast("long").alias("_pos"),
                       J.get("rec", "c_custkey", "long").alias("c_custkey"),
                       J.get("rec", "c_name", "string").alias("c_name"),
                       J.get("rec", "c_acctbal", "double").alias("c_acctbal"))


@query("payload_parse", """
SELECT c_name AS request_key, c_custkey AS seq,
       CASE c_custkey % 6 WHEN 1 THEN 'ARRAY' WHEN 4 THEN NULL ELSE 'OBJECT' END AS doc_kind
FROM customer""")
def q_payload_parse(spark, sf_dir):
    from tickroll.sources.landed import payload_kinds
    return payload_kinds(_customer_docs(spark, sf_dir)).select("request_key", "seq", "doc_kind")


@query("payload_errors", """
SELECT c_name AS request_key, c_custkey AS seq, 'message_code' AS error_kind, 'not found' AS message
FROM customer WHERE c_custkey % 6 = 3
UNION ALL
SELECT 'global_metrics', event_id, 'status', 'rate limited'
FROM events WHERE event_type = 'error' AND event_id % 10 = 0""")
def q_payload_errors(spark, sf_dir):
    landed = T.customer_payloads(spark, sf_dir).unionByName(T.metrics_payloads(spark, sf_dir))
    _, errors = P.split_errors(parse_payloads(landed))
    return errors.select("request_key", "seq", "error_kind", "message")


@query("unwrap_records", f"""
SELECT c_custkey AS seq, CAST(0 AS BIGINT) AS _pos, {CUST_FIELDS}
FROM customer WHERE c_custkey % 6 <> 4""")
def q_unwrap_records(spark, sf_dir):
    return _cust_rows(P.unwrap(_customer_docs(spark, sf_dir), "records", keep=["seq"]))


@query("unwrap_array_only", """
SELECT c_custkey AS seq, CAST(0 AS BIGINT) AS _pos, c_custkey, c_name, c_acctbal
FROM customer WHERE c_custkey % 6 IN (0, 1)""")
def q_unwrap_array_only(spark, sf_dir):
    return _cust_rows(P.unwrap(_customer_docs(spark, sf_dir), "array", keep=["seq"]))


@query("unwrap_first_record", f"""
SELECT c_custkey AS seq, CAST(0 AS BIGINT) AS _pos, {CUST_FIELDS}
FROM customer WHERE c_custkey % 6 <> 4""")
def q_unwrap_first_record(spark, sf_dir):
    return _cust_rows(P.unwrap(_customer_docs(spark, sf_dir), "first", keep=["seq"]))


@query("drop_non_objects", """
SELECT c_custkey AS seq,
       CAST(CASE WHEN c_custkey % 6 = 0 THEN 3 ELSE 1 END AS BIGINT) AS elements,
       CAST(1 AS BIGINT) AS objects,
       CAST(CASE WHEN c_custkey % 6 = 0 THEN 2 ELSE 0 END AS BIGINT) AS dropped
FROM customer WHERE c_custkey % 6 IN (0, 1)""")
def q_drop_non_objects(spark, sf_dir):
    c = P.object_counts(_customer_docs(spark, sf_dir), keep=["seq"])
    return c.select("seq", *[F.col(x).cast("long").alias(x) for x in ("elements", "objects", "dropped")])


@query("map_columns", """
SELECT c_custkey AS id, c_name AS ticker, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS comment
FROM customer""")
def q_map_columns(spark, sf_dir):
    specs = [ColumnSpec("c_custkey", "id", "long"), ColumnSpec("c_name", "ticker"),
             ColumnSpec("c_acctbal", "balance", "double"), ColumnSpec("c_comment", "comment")]
    return map_columns(T.customer_records(spark, sf_dir), specs)


# 219 identity-mapped columns generated by rule: 3 keys + 216 indicators
WIDE_NAMES = [f"ind_{i:03d}" for i in range(1, 217)]


def _fin_sql_values(names):
    known = {names[0]: "l_quantity", names[1]: "l_extendedprice", names[2]: "l_discount", names[-1]: "l_tax"}
    return ", ".join(f"{known[n]} AS {n}" if n in known else f"CAST(NULL AS DOUBLE) AS {n}" for n in names)


@query("map_columns_wide", f"""
SELECT 'S' || l_suppkey AS mack, CAST(quarter(l_shipdate) AS INTEGER) AS quy,
       CAST(year(l_shipdate) AS INTEGER) AS nam, {_fin_sql_values(WIDE_NAMES)}
FROM lineitem""")
def q_map_columns_wide(spark, sf_dir):
    recs = LD.fin_records(T.fin_payloads(spark, sf_dir, WIDE_NAMES), WIDE_NAMES)
    return recs.drop("_seq")


@query("fin_indicators", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)
                                        ORDER BY l_orderkey * 10 + l_linenumber DESC) AS rn FROM lineitem)
SELECT 'S' || l_suppkey AS mack, CAST(quarter(l_shipdate) AS INTEGER) AS quy,
       CAST(year(l_shipdate) AS INTEGER) AS nam, {_fin_sql_values(T.FIN_RATIOS)}
FROM r WHERE rn = 1""")
def q_fin_indicators(spark, sf_dir):
    return LD.load_fin_indicators(T.fin_payloads(spark, sf_dir), T.FIN_RATIOS)


@query("fin_indicators_nothing", f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate), quarter(l_shipdate)
                                        ORDER BY l_orderkey * 10 + l_linenumber) AS rn FROM lineitem)
SELECT 'S' || l_suppkey AS mack, CAST(quarter(l_shipdate) AS INTEGER) AS quy,
       CAST(year(l_shipdate) AS INTEGER) AS nam, {_fin_sql_values(T.FIN_RATIOS)}
FROM r WHERE rn = 1""")
def q_fin_indicators_nothing(spark, sf_dir):
    """The same load under the insert-if-absent policy (first record wins)."""
    return LD.load_fin_indicators(T.fin_payloads(spark, sf_dir), T.FIN_RATIOS, policy="nothing")


@query("fill_falsy_key", "SELECT l_orderkey * 10 + l_linenumber AS seq, 'S' || l_suppkey AS mack FROM lineitem")
def q_fill_falsy_key(spark, sf_dir):
    recs = P.unwrap(parse_payloads(T.fin_payloads(spark, sf_dir)), "records", keep=["code", "seq"])
    from tickroll.operators.mapping import fill_falsy
    return recs.select("seq", fill_falsy("rec", "mack", "code").alias("mack"))


@query("nested_path_extract", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CASE WHEN event_type = 'view' THEN value END AS usd_price
FROM events""")
def q_nested_path_extract(spark, sf_dir):
    d = T.nested_docs(spark, sf_dir)
    return d.select("event_id", J.get("doc", ("props", "k"), "long").alias("k"),
                    J.get("doc", ("quote", "USD", "price"), "double").alias("usd_price"))


DIRTY_NUM_SQL = """CASE event_id % 9 WHEN 2 THEN 2.0 WHEN 3 THEN 1.5 WHEN 6 THEN CAST('inf' AS DOUBLE)
                       WHEN 8 THEN value ELSE NULL END"""


@query("safe_float", f"SELECT event_id, {DIRTY_NUM_SQL} AS num FROM events")
def q_safe_float(spark, sf_dir):
    return T.events_dirty(spark, sf_dir).select("event_id", safe_float_text("num_text").alias("num"))


def _day(ms_expr: str) -> str:
    return f"(({ms_expr}) - (({ms_expr}) % 86400000))"


TS_DAY_SQL = f"""CASE event_id % 6
    WHEN 0 THEN {_day('epoch_us(ts) // 1000')}
    WHEN 1 THEN {_day("epoch_us(date_trunc('second', ts)) // 1000 + 18000000")}
    WHEN 2 THEN {_day("epoch_us(date_trunc('second', ts)) // 1000")}
    WHEN 5 THEN 0 ELSE NULL END"""


@query("normalize_ts_day", f"SELECT event_id, {TS_DAY_SQL} AS day_ms FROM events")
def q_normalize_ts_day(spark, sf_dir):
    return T.events_dirty(spark, sf_dir).select("event_id", normalize_ts_day("ts_text").alias("day_ms"))


METRICS_SQL = f"""
WITH q AS (SELECT *, {TS_DAY_SQL} AS tsday FROM events
           WHERE NOT (event_type = 'error' AND event_id % 10 = 0)),
l AS (SELECT *, row_number() OVER (PARTITION BY tsday ORDER BY event_id DESC) AS rn
      FROM q WHERE tsday IS NOT NULL AND tsday <> 0)
SELECT tsday AS timestamp, value AS btc_dominance, {DIRTY_NUM_SQL} AS eth_dominance,
       user_id AS active_cryptocurrencies, event_id % 50 AS active_exchanges,
       CAST(json_extract(props, '$.k') AS BIGINT) AS active_market_pairs,
       value + 1 AS total_market_cap, value + 2 AS total_volume_24h, value AS total_volume_24h_reported,
       value + 4 AS altcoin_market_cap, value + 5 AS altcoin_volume_24h,
       value + 6 AS altcoin_volume_24h_reported,
       {_day('epoch_us(ts) // 1000')} AS quote_timestamp
FROM l WHERE rn = 1"""


@query("global_metrics", METRICS_SQL)
def q_global_metrics(spark, sf_dir):
    return LD.load_global_metrics(T.metrics_payloads(spark, sf_dir), on_error="skip")


@query("latest_n_metrics", f"SELECT * FROM ({METRICS_SQL}) ORDER BY timestamp DESC LIMIT 2")
def q_latest_n_metrics(spark, sf_dir):
    return LD.latest_n(LD.load_global_metrics(T.metrics_payloads(spark, sf_dir), on_error="skip"), LD.GLOBAL_METRICS_COUNT)


@query("scan_active_dim", "SELECT c_custkey AS company_id, c_name AS ticker FROM customer WHERE c_acctbal > 0")
def q_scan_active_dim(spark, sf_dir):
    return LD.active_companies(T.companies(spark, sf_dir))


ENRICHED_SQL = """
SELECT o.o_orderkey AS seq, c.c_custkey AS company_id, c.c_name AS ticker,
       strftime(o.o_orderdate, '%Y-%m-%d') AS date, o.o_totalprice AS open,
       o.o_totalprice + 1 AS high, o.o_totalprice - 1 AS low, o.o_totalprice AS close,
       o.o_totalprice AS adjusted_close, CAST(o.o_orderkey AS DOUBLE) AS volume
FROM orders o JOIN customer c ON c.c_name = 'Customer#' || lpad(CAST(o.o_custkey AS VARCHAR), 9, '0')
WHERE c.c_acctbal > 0 AND o.o_orderkey % 4 IN (0, 1)"""


def _date_str(df, col):
    return df.withColumn(col, F.date_format(col, "yyyy-MM-dd"))


@query("enrich_company", f"SELECT * EXCLUDE (seq) FROM ({ENRICHED_SQL})")
def q_enrich_company(spark, sf_dir):
    r = LD.global_eod_records(T.global_eod_payloads(spark, sf_dir), T.companies(spark, sf_dir))
    return _date_str(r.drop("_seq"), "date")


GLOBAL_EOD_SQL = f"""
WITH t AS (SELECT DISTINCT o_custkey AS company_id, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS ticker,
                  strftime(o_orderdate, '%Y-%m-%d') AS date, -1.0 AS open, CAST(NULL AS DOUBLE) AS high,
                  CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS close,
                  CAST(NULL AS DOUBLE) AS adjusted_close, CAST(NULL AS DOUBLE) AS volume
           FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
e AS ({ENRICHED_SQL}),
b AS (SELECT * EXCLUDE (seq, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY company_id, ticker, date ORDER BY seq) AS rn FROM e)
      WHERE rn = 1)
SELECT * FROM t
UNION ALL
SELECT b.* FROM b ANTI JOIN t USING (company_id, ticker, date)"""


@query("global_eod", GLOBAL_EOD_SQL)
def q_global_eod(spark, sf_dir):
    out = LD.load_global_eod(T.global_eod_payloads(spark, sf_dir), T.companies(spark, sf_dir),
                             target=T.global_eod_target(spark, sf_dir))
    return _date_str(out, "date")


VN_SQL = """
SELECT l.l_orderkey * 10 + l.l_linenumber AS seq, 'P' || l.l_partkey AS mack,
       strftime(l.l_shipdate, '%Y-%m-%d') AS ngay, l.l_extendedprice AS open_root,
       l.l_extendedprice AS close_root, l.l_quantity AS volume_root, l.l_discount AS changedratio,
       '2024-01-01' AS created_at
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
WHERE p.p_size <= 25 AND l.l_linenumber % 3 IN (0, 1)"""


def _vn_cols_sql():
    have = {"mack", "ngay", "open_root", "close_root", "volume_root", "changedratio", "created_at"}
    return ", ".join(c if c in have else
                     (f"CAST(NULL AS VARCHAR) AS {c}" if c == "lastupdate" else f"CAST(NULL AS DOUBLE) AS {c}")
                     for c in LD.VN_EOD_COLUMNS)


@query("vn_eod_rows", f"""
WITH r AS ({VN_SQL}),
d AS (SELECT *, row_number() OVER (PARTITION BY mack, ngay ORDER BY seq) AS rn FROM r)
SELECT {_vn_cols_sql()} FROM d WHERE rn = 1""")
def q_vn_eod_rows(spark, sf_dir):
    out = LD.load_vn_eod(T.vn_eod_payloads(spark, sf_dir), T.listed_codes(spark, sf_dir))
    return _date_str(out, "ngay")


EOD_RUN_DATE = "1998-08-01"


@query("eod_lookback", f"""
SELECT mack, ngay, close_root FROM ({VN_SQL})
WHERE ngay BETWEEN '1998-07-29' AND '1998-08-01'""")
def q_eod_lookback(spark, sf_dir):
    """Prices of the run's look-back; payloads of other landing dates are not parsed."""
    r = LD.vn_eod_records(T.vn_eod_payloads(spark, sf_dir), T.listed_codes(spark, sf_dir), EOD_RUN_DATE,
                          LD.EOD_LOOKBACK_DAYS)
    return _date_str(r.select("mack", "ngay", "close_root"), "ngay")


BASIC_B_SQL = """
SELECT s_name AS mack, s_name AS ten, s_acctbal AS vonhoa, 'N' || s_nationkey AS san_niem_yet,
       CASE s_suppkey % 3 WHEN 0 THEN '{"id":' || s_nationkey || ',"name":"AUDIT"}' WHEN 1 THEN 'KPMG' END AS donvikiemtoan
FROM supplier WHERE s_suppkey % 5 <> 4"""


def _basic_cols_sql(src: str, have: set) -> str:
    out = []
    for c in LD.BASIC_INFO_COLUMNS:
        if c in have:
            out.append(f"{src}.{c}")
        else:
            t = "DOUBLE" if LD.BASIC_INFO_TYPES.get(c) == "double" else "VARCHAR"
            out.append(f"CAST(NULL AS {t}) AS {c}")
    return ", ".join(out)


def basic_info_stored(spark, sf_dir):
    """The table as an earlier load left it, with all columns."""
    old = T.basic_info_target(spark, sf_dir)
    types = LD.BASIC_INFO_TYPES
    return old.select(*[F.col(c) if c in old.columns else
                          F.lit(None).cast("double" if types.get(c) == "double" else "string").alias(c)
                          for c in LD.BASIC_INFO_COLUMNS])


@query("basic_info", f"""
WITH b AS ({BASIC_B_SQL}),
t AS (SELECT s_name AS mack, 'old' AS ten FROM supplier WHERE s_nationkey < 10)
SELECT {_basic_cols_sql('b', {'mack', 'ten', 'vonhoa', 'san_niem_yet', 'donvikiemtoan'})} FROM b
UNION ALL
SELECT {_basic_cols_sql('t', {'mack', 'ten'})} FROM t ANTI JOIN b USING (mack)""")
def q_basic_info(spark, sf_dir):
    target = basic_info_stored(spark, sf_dir)
    return LD.load_basic_info(T.basic_info_payloads(spark, sf_dir), target=target)


@query("nested_to_json", f"SELECT mack, donvikiemtoan FROM ({BASIC_B_SQL})")
def q_nested_to_json(spark, sf_dir):
    return LD.basic_info_records(T.basic_info_payloads(spark, sf_dir)).select("mack", "donvikiemtoan")


LISTING_SQL = """
l AS (SELECT 'HOSE' AS listing, 1 AS lo, * FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING')
      UNION ALL SELECT 'HNX', 2, * FROM customer WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD')
      UNION ALL SELECT 'UPCOM', 3, * FROM customer WHERE c_mktsegment = 'MACHINERY' OR c_acctbal < 0),
r AS (SELECT * FROM l WHERE c_custkey % 5 >= 2)"""

STOCK_SQL = f"""
WITH {LISTING_SQL},
d AS (SELECT *, row_number() OVER (PARTITION BY c_name ORDER BY lo DESC, c_custkey DESC) AS rn FROM r)
SELECT c_name AS code, c_name || ' JSC' AS fullname_vi, c_mktsegment AS loaidn, listing AS san
FROM d WHERE rn = 1"""


@query("stock_list", STOCK_SQL)
def q_stock_list(spark, sf_dir):
    return LD.load_stock_list(T.stock_list_payloads(spark, sf_dir), listings=T.LISTING_ORDER)


@query("load_counts", f"""
WITH {LISTING_SQL}
SELECT listing, CAST(count(*) AS BIGINT) AS payloads,
       CAST(count(*) FILTER (WHERE c_custkey % 5 >= 2) AS BIGINT) AS records
FROM l GROUP BY listing""")
def q_load_counts(spark, sf_dir):
    landed = T.stock_list_payloads(spark, sf_dir)
    records = P.unwrap(parse_payloads(landed), "list", keep=["listing", "seq"])
    return LD.load_counts(landed, records, "listing").select(
        "listing", F.col("payloads").cast("long"), "records")
