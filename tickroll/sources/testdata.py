"""Inputs derived from the driver's TPC-H-like tables.

The driver tables hold no candles or payloads, so every registered query
derives its input here with DataFrame operators over whole tables; the
DuckDB oracles derive the same rows in SQL.

* ticks         events: symbol = upper(event_type), exchange = 'x' || user_id % 3,
                ts_us, tick_id = event_id, price = volume = value
* 3m candles    ticks rolled up into 3-minute buckets
* candle pages  3m candles as JSON pages, one per pair and UTC day
* pair metadata messy exchange lists per event type; checkpoints from 3m candles
* merge inputs  orders: stored table before 1999, batch from 1998 (+ a second
                copy of 2000 onwards with a later _seq)
* payloads      one landed payload per row, its envelope chosen by the row key:
                customer (generic shapes, errors, bad JSON), events (global
                metrics quotes, dirty numbers and timestamps), orders (global
                EOD prices), lineitem (VN EOD prices, financial indicators),
                supplier (basic info), customer by market segment (listings)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickroll.functions.timefn import epoch_us, interval_ms
from tickroll.operators.candles import ticks_to_candles
from tickroll.sources.tables import read_table


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return e.select(F.upper("event_type").alias("symbol"),
                    F.concat(F.lit("x"), F.pmod("user_id", F.lit(3)).cast("string")).alias("exchange"),
                    epoch_us("ts").alias("ts_us"),
                    F.col("event_id").alias("tick_id"),
                    F.col("value").alias("price"),
                    F.col("value").alias("volume"))


def candles_3m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_to_candles(ticks(spark, sf_dir), interval_ms("3m"))


# ------------------------------------------------------------ merge inputs
# target: orders before 1999; batch: orders from 1998 with a new price and
# status (status 'P' becomes NULL), plus orders from 2000 a second time with
# a later _seq. Mapped columns are key, status and price; customer, date
# and priority are unmapped.
ORDER_TARGET_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     "o_orderdate", "o_orderpriority"]
ORDER_MAPPED = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ORDER_TARGET_COLS)
    return (o.where(F.col("o_orderdate") < F.lit("1999-01-01"))
             .withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")))


def orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    first = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01"))
              .select((F.col("o_orderkey") * 2).alias("_seq"), "o_orderkey",
                      F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
                       .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
                      (F.col("o_totalprice") + 1).alias("o_totalprice")))
    again = (o.where(F.col("o_orderdate") >= F.lit("2000-01-01"))
              .select((F.col("o_orderkey") * 2 + 1).alias("_seq"), "o_orderkey",
                      F.lit("Z").alias("o_orderstatus"),
                      (F.col("o_totalprice") + 2).alias("o_totalprice")))
    return first.unionByName(again)


# ------------------------------------------------------- incremental inputs
def pair_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol metadata with messy exchange lists, one row per variant and event type.

    A: symbol = event_type, every exchange seen, joined with ' ,<tab>' and
       padded with blanks and empty items;
    B: symbol = Initcap(event_type) with its smallest exchange (duplicates A
       after upper-casing);
    C: symbol = event_type || 'usd' (NULL for 'error') with the largest
       exchange, '' for 'view' and NULL for 'click'.
    """
    t = ticks(spark, sf_dir).select(F.lower("symbol").alias("et"), "exchange")
    g = t.groupBy("et").agg(F.array_sort(F.collect_set("exchange")).alias("xs"),
                            F.min("exchange").alias("xmin"), F.max("exchange").alias("xmax"))
    a = g.select(F.col("et").alias("symbol"),
                 F.concat(F.lit(" "), F.concat_ws(" ,\t", "xs"), F.lit(" , ,")).alias("available_exchange"))
    b = g.select(F.initcap("et").alias("symbol"), F.col("xmin").alias("available_exchange"))
    c = g.select(F.when(F.col("et") != "error", F.concat("et", F.lit("usd"))).alias("symbol"),
                 F.when(F.col("et") == "view", F.lit(""))
                  .when(F.col("et") == "click", F.lit(None).cast("string"))
                  .otherwise(F.col("xmax")).alias("available_exchange"))
    return a.unionByName(b).unionByName(c)


CKPT_CUT_MS = 1705276800000      # 2024-01-15T00:00:00Z
CKPT_UPDATED = "2024-01-15 00:00:00"
SYNC_NOW_MS = 1705708800000      # 2024-01-20T00:00:00Z
SYNC_SINCE_DAYS = 1


def checkpoint_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3m checkpoints: last candle before 2024-01-15 for pairs on x0/x1;
    plus '1h' rows for every pair (another timeframe, to be ignored)."""
    c3 = candles_3m(spark, sf_dir)
    last = (c3.where((F.col("timestamp") < F.lit(CKPT_CUT_MS)) & (F.col("exchange") != "x2"))
              .groupBy("symbol", "exchange").agg(F.max("timestamp").alias("last_ts_ms"))
              .select("symbol", "exchange", F.lit("3m").alias("timeframe"), "last_ts_ms"))
    other = (c3.select("symbol", "exchange").distinct()
               .select("symbol", "exchange", F.lit("1h").alias("timeframe"), F.lit(0).cast("long").alias("last_ts_ms")))
    return (last.unionByName(other)
                .withColumn("updated_at", F.lit(CKPT_UPDATED)))


def landed_candle_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """3m candles landed as JSON pages, one page per pair and UTC day.

    A day holds at most 480 three-minute candles per pair, so every page
    (one grouped row) is bounded no matter how large the table grows.
    """
    c3 = candles_3m(spark, sf_dir)
    row = F.array(F.col("timestamp").cast("double"), "open", "high", "low", "close", "volume")
    return (c3.groupBy("symbol", "exchange", F.expr("timestamp div 86400000").alias("page_seq"))
              .agg(F.to_json(F.array_sort(F.collect_list(row))).alias("payload")))


def dirty_candle_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candle pages as fetchers may land them, by day number modulo 4.

    0: the volumes are text; 1: a row of three values and one without a time
    are added; 2: the page is landed twice, first cut off; 3: clean.
    """
    pages = landed_candle_pages(spark, sf_dir)
    kind = F.pmod("page_seq", F.lit(4))
    text = F.regexp_replace("payload", r",([0-9.E+-]+)\]", r',"$1"]')
    extra = F.concat(F.regexp_replace("payload", r"\]$", ""), F.lit(",[1,2,3],[null,1,2,3,4,5]]"))
    good = pages.withColumn("payload", F.when(kind == 0, text).when(kind == 1, extra).otherwise(F.col("payload")))
    cut = pages.where(kind == 2).withColumn("payload", F.expr("left(payload, length(payload) - 2)"))
    return good.unionByName(cut)


# --------------------------------------------------------- payload inputs
def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a driver table dealt out by their key.

    Each driver table is one row group, which one task reads; fetchers land
    payloads in many files. The payload inputs are spread accordingly, also
    where that costs a shuffle of the (narrow) source rows.
    """
    return rows.repartition(F.col(key))


def _wrap(shape_col, rec, shapes: dict) -> "F.Column":
    """Envelope text per shape number; ``{r}`` stands for the record JSON."""
    out = None
    for k, tmpl in shapes.items():
        if tmpl is None:
            val = F.lit(None).cast("string")
        else:
            pieces = tmpl.split("{r}")
            val = F.concat(*[x for p in pieces[:-1] for x in (F.lit(p), rec)], F.lit(pieces[-1]))
        out = F.when(shape_col == k, val) if out is None else out.when(shape_col == k, val)
    return out


# customer rows as API payloads, the shape chosen by c_custkey % 6
CUSTOMER_SHAPES = {
    0: '{"data":[{r},7,"x"]}',
    1: '[{r}]',
    2: '{r}',
    3: '{"message":"not found","code":404}',
    4: 'not json {',
    5: '{"data":{r}}',
}


def customer_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    rec = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    return dealt(c, "c_custkey").select(F.col("c_name").alias("request_key"), F.col("c_custkey").alias("seq"),
                    _wrap(F.pmod("c_custkey", F.lit(6)), rec, CUSTOMER_SHAPES).alias("payload"))


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer row as one JSON record (``rec`` VARIANT)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    return c.select("c_custkey", F.parse_json(F.to_json(F.struct(*c.columns))).alias("rec"))


# dirty numeric text (event_id % 9) and timestamp text (event_id % 6)
def dirty_number_text(e) -> "F.Column":
    k = F.pmod(e["event_id"], F.lit(9))
    return (F.when(k == 0, F.lit("abc")).when(k == 1, F.lit("")).when(k == 2, F.lit(" 2 "))
             .when(k == 3, F.lit("1.5")).when(k == 4, F.lit(None).cast("string"))
             .when(k == 5, F.lit("1.5d")).when(k == 6, F.lit("inf")).when(k == 7, F.lit("1_000"))
             .otherwise(e["value"].cast("string")))


def dirty_ts_text(e) -> "F.Column":
    k = F.pmod(e["event_id"], F.lit(6))
    return (F.when(k == 0, F.concat(F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))
             .when(k == 1, F.concat(F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
             .when(k == 2, F.date_format(e["ts"], "yyyy-MM-dd HH:mm:ss"))
             .when(k == 3, F.lit("garbage"))
             .when(k == 4, F.lit(""))
             .otherwise(F.lit("1970-01-01T10:00:00Z")))


def events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "value"])
    return e.select("event_id", dirty_number_text(e).alias("num_text"), dirty_ts_text(e).alias("ts_text"))


def nested_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as documents with props and a quote object of varying shape."""
    e = read_table(spark, sf_dir, "events", ["event_id", "event_type", "value", "props"])
    q = (F.when(F.col("event_type") == "view",
                F.concat(F.lit('{"USD":{"price":'), F.col("value").cast("string"), F.lit("}}")))
          .when(F.col("event_type") == "click", F.lit('{"USD":null}'))
          .when(F.col("event_type") == "error", F.lit('{"USD":5}'))
          .when(F.col("event_type") == "signup", F.lit("null"))
          .otherwise(F.lit('{"EUR":{"price":1}}')))
    doc = F.concat(F.lit('{"props":'), F.col("props"), F.lit(',"quote":'), q, F.lit("}"))
    return e.select("event_id", F.try_parse_json(doc).alias("doc"))


def metrics_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One global-metrics payload per event: status block plus data.quotes.

    Events of type 'error' whose id ends in 0 carry an API error message.
    """
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    usd = F.struct((F.col("value") + 1).alias("total_market_cap"),
                   (F.col("value") + 2).alias("total_volume_24h"),
                   F.col("value").cast("string").alias("total_volume_24h_reported"),
                   (F.col("value") + 4).alias("altcoin_market_cap"),
                   (F.col("value") + 5).alias("altcoin_volume_24h"),
                   (F.col("value") + 6).alias("altcoin_volume_24h_reported"),
                   F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")).alias("timestamp"))
    quote = F.struct(dirty_ts_text(e).alias("timestamp"),
                     F.col("value").alias("btc_dominance"),
                     dirty_number_text(e).alias("eth_dominance"),
                     F.col("user_id").alias("active_cryptocurrencies"),
                     F.pmod("event_id", F.lit(50)).alias("active_exchanges"),
                     F.get_json_object("props", "$.k").cast("long").alias("active_market_pairs"),
                     F.struct(usd.alias("USD")).alias("quote"))
    err = F.when((F.col("event_type") == "error") & (F.pmod("event_id", F.lit(10)) == 0), F.lit('"rate limited"')) \
           .otherwise(F.lit("null"))
    payload = F.concat(F.lit('{"status":{"error_message":'), err, F.lit('},"data":{"quotes":['),
                       F.to_json(quote), F.lit(",17]}}"))
    return dealt(e, "event_id").select(F.lit("global_metrics").alias("request_key"), F.col("event_id").alias("seq"),
                    payload.alias("payload"))


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal"])
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("ticker"),
                    (F.col("c_acctbal") > 0).alias("is_active"))


def ticker_of(custkey) -> "F.Column":
    return F.concat(F.lit("Customer#"), F.lpad(custkey.cast("string"), 9, "0"))


# global EOD prices: one payload per order, shape by o_orderkey % 4
EOD_SHAPES = {0: '[{r},3]', 1: '{"data":[{r}]}', 2: '{"message":"limit","code":429}', 3: '{r}'}


def global_eod_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    rec = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                             F.col("o_totalprice").alias("open"),
                             (F.col("o_totalprice") + 1).alias("high"),
                             (F.col("o_totalprice") - 1).alias("low"),
                             F.col("o_totalprice").alias("close"),
                             F.col("o_totalprice").alias("adjusted_close"),
                             F.col("o_orderkey").alias("volume"),
                             F.lit("IGNORED").alias("ticker"),
                             F.lit(-1).alias("company_id")))
    return dealt(o, "o_orderkey").select(ticker_of(F.col("o_custkey")).alias("ticker"), F.col("o_orderkey").alias("seq"),
                    _wrap(F.pmod("o_orderkey", F.lit(4)), rec, EOD_SHAPES).alias("payload"))


def global_eod_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices stored by an earlier run: orders before 1996 with open = -1."""
    o = read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate"])
    return (o.where(F.col("o_orderdate") < F.lit("1996-01-01"))
             .select(F.col("o_custkey").alias("company_id"), ticker_of(F.col("o_custkey")).alias("ticker"),
                     F.to_date("o_orderdate").alias("date"), F.lit(-1.0).alias("open"),
                     *[F.lit(None).cast("double").alias(c) for c in ("high", "low", "close", "adjusted_close", "volume")])
             .dropDuplicates(["company_id", "ticker", "date"]))


# VN EOD prices: one payload per line item, shape by l_linenumber % 3
# (shape 0 says message and code beside good data)
VN_EOD_SHAPES = {0: '{"code":200,"message":"success","data":[{r}]}', 1: '[{r},"x"]', 2: '{"data":{r}}'}


def vn_eod_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_discount", "l_shipdate"])
    code = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    rec = F.to_json(F.struct(code.alias("mack"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ngay"),
                             F.col("l_extendedprice").alias("open_root"),
                             F.col("l_extendedprice").alias("close_root"),
                             F.col("l_quantity").alias("volume_root"),
                             F.col("l_discount").alias("changedratio"),
                             F.lit("2024-01-01").alias("created_at")))
    return dealt(li, "l_orderkey").select(code.alias("code"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
                     F.to_date("l_shipdate").alias("landed_date"),
                     _wrap(F.pmod("l_linenumber", F.lit(3)), rec, VN_EOD_SHAPES).alias("payload"))


def listed_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock list: parts of size up to 25 are the listed codes."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    return p.where(F.col("p_size") <= 25).select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"))


# basic info: one payload per supplier, shape by s_suppkey % 5
BASIC_SHAPES = {0: '{"data":[{r}]}', 1: '{"data":{r}}', 2: '{r}', 3: '[{r}]', 4: '{"data":[]}'}


def basic_info_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    k3 = F.pmod("s_suppkey", F.lit(3))
    audit = (F.when(k3 == 0, F.concat(F.lit('{"id":'), F.col("s_nationkey").cast("string"), F.lit(',"name":"AUDIT"}')))
              .when(k3 == 1, F.lit('"KPMG"')).otherwise(F.lit("null")))
    rec = F.concat(F.lit('{"mack":"'), F.col("s_name"), F.lit('","ten":"'), F.col("s_name"),
                   F.lit('","vonhoa":'), F.col("s_acctbal").cast("string"),
                   F.lit(',"san_niem_yet":"N'), F.col("s_nationkey").cast("string"),
                   F.lit('","donvikiemtoan":'), audit, F.lit("}"))
    return s.select(F.col("s_name").alias("code"), F.col("s_suppkey").alias("seq"),
                    _wrap(F.pmod("s_suppkey", F.lit(5)), rec, BASIC_SHAPES).alias("payload"))


def basic_info_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an earlier load for suppliers of nations 0-9 (ten = 'old')."""
    s = read_table(spark, sf_dir, "supplier", ["s_name", "s_nationkey"])
    return s.where(F.col("s_nationkey") < 10).select(F.col("s_name").alias("mack"), F.lit("old").alias("ten"))


def supplier_codes(spark: SparkSession, sf_dir: str, prefix: str | None = None) -> DataFrame:
    """Codes of the suppliers with a balance above zero: their names, or ``prefix`` and their keys."""
    s = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_name", "s_acctbal"]).where("s_acctbal > 0")
    return s.select((F.concat(F.lit(prefix), F.col("s_suppkey").cast("string")) if prefix else F.col("s_name")).alias("code"))


# financial indicators: one payload per line item
FIN_SHAPES = {0: '{"data":[{r},"junk"]}', 1: '{"data":{r}}', 2: '{r}', 3: '[{r}]'}
FIN_RATIOS = [f"ratio_{i:02d}" for i in range(1, 21)]


def fin_payloads(spark: SparkSession, sf_dir: str, wide_names=None) -> DataFrame:
    """mack is missing, '', 0 or the code by l_orderkey % 4 (falsy ones are
    filled with the request code)."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                "l_extendedprice", "l_discount", "l_tax", "l_shipdate"])
    code = F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))
    k = F.pmod("l_orderkey", F.lit(4))
    mack = (F.when(k == 0, F.lit(""))               # key omitted below
             .when(k == 1, F.lit('"mack":"",'))
             .when(k == 2, F.lit('"mack":0,'))
             .otherwise(F.concat(F.lit('"mack":"'), code, F.lit('",'))))
    names = wide_names or FIN_RATIOS
    vals = [F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")]
    body = F.to_json(F.struct(F.year("l_shipdate").alias("nam"), F.quarter("l_shipdate").alias("quy"),
                              vals[0].alias(names[0]), vals[1].alias(names[1]),
                              vals[2].alias(names[2]), vals[3].alias(names[-1])))
    rec = F.concat(F.lit("{"), mack, F.regexp_replace(body, "^\\{", ""))
    return dealt(li, "l_orderkey").select(code.alias("code"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
                     _wrap(F.pmod("l_linenumber", F.lit(4)), rec, FIN_SHAPES).alias("payload"))


# stock listings: HOSE, HNX, UPCOM; the configured order is an argument of the load
LISTINGS = [("UPCOM", ["MACHINERY"]), ("HOSE", ["AUTOMOBILE", "BUILDING"]), ("HNX", ["FURNITURE", "HOUSEHOLD"])]
LISTING_ORDER = ["HOSE", "HNX", "UPCOM"]
LIST_SHAPES = {0: '[{r}]', 1: '{"data":null}', 2: '{"data":[{r}]}', 3: '{"data":[{r}]}', 4: '{"data":[{r}]}'}


def stock_list_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per listed customer; UPCOM also lists every customer
    with a negative balance, so those codes repeat across listings."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    parts = []
    for name, segs in LISTINGS:
        cond = F.col("c_mktsegment").isin(segs)
        if name == "UPCOM":
            cond = cond | (F.col("c_acctbal") < 0)
        rec = F.to_json(F.struct(F.col("c_name").alias("code"),
                                 F.concat("c_name", F.lit(" JSC")).alias("fullname_vi"),
                                 F.col("c_mktsegment").alias("loaidn"), F.lit(name).alias("san")))
        parts.append(c.where(cond).select(
            F.lit(name).alias("listing"), F.col("c_custkey").alias("seq"),
            _wrap(F.pmod("c_custkey", F.lit(5)), rec, LIST_SHAPES).alias("payload")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
