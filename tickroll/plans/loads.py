"""The named table loads: landed payloads -> records -> mapped rows -> keyed merge.

Each load is one lazy plan over all landed payloads of a run (the
per-key request loop, chunks of 400 and throttling of the original are
replaced by partitions). ``load_*`` returns the new table as a DataFrame;
``tickroll.plans.jobs.load_job`` writes a run into the stored table.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tickroll.functions.timefn import DAY_MS, day_floor_ms, normalize_ts_day, parse_iso_ms
from tickroll.operators import merge as M
from tickroll.operators import payload as P
from tickroll.operators.mapping import ColumnSpec, fill_falsy, map_columns, record_struct_type, specs_from_config
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import parse_payloads

# ----------------------------------------------------------- fixed values
# Target columns and conflict keys of each table, as configured for the
# original loads (names must match the stored tables).
STOCK_LIST_COLUMNS = ["code", "fullname_vi", "loaidn", "san"]
STOCK_LIST_KEYS = ["code"]

BASIC_INFO_COLUMNS = [
    "mack", "ten", "name", "loai_hinh_cong_ty", "san_niem_yet", "gioithieu", "diachi", "website",
    "nganhcap1", "nganhcap2", "nganhcap3", "nganhcap4", "ngayniemyet", "smg", "volume_daily",
    "vol_tb_15ngay", "vonhoa", "dif", "dif_percent", "tong_tai_san", "soluongluuhanh",
    "soluongniemyet", "cophieuquy", "logo", "created_at", "updated_at", "donvikiemtoan",
]
BASIC_INFO_KEYS = ["mack"]

VN_EOD_COLUMNS = [
    "mack", "ngay", "open_root", "high_root", "low_root", "close_root", "volume_root",
    "open_adjust", "high_adjust", "low_adjust", "close_adjust", "volume_adjust", "avgprice",
    "giatri_giaodich", "ceilingprice", "floorprice", "changed", "changedratio", "kl_nn_ban",
    "kl_nn_mua", "gt_nn_ban", "gt_nn_mua", "lastupdate", "created_at",
]
VN_EOD_KEYS = ["mack", "ngay"]

FIN_KEYS = ["mack", "nam", "quy"]

GLOBAL_EOD_COLUMNS = ["company_id", "ticker", "date", "open", "high", "low", "close",
                      "adjusted_close", "volume"]
GLOBAL_EOD_KEYS = ["company_id", "ticker", "date"]

# (json_key / column, source path, tolerant float?) of the global metrics table
GLOBAL_METRICS_FIELDS = [
    ("timestamp", ("timestamp",), False),
    ("btc_dominance", ("btc_dominance",), True),
    ("eth_dominance", ("eth_dominance",), True),
    ("active_cryptocurrencies", ("active_cryptocurrencies",), False),
    ("active_exchanges", ("active_exchanges",), False),
    ("active_market_pairs", ("active_market_pairs",), False),
    ("total_market_cap", ("quote", "USD", "total_market_cap"), True),
    ("total_volume_24h", ("quote", "USD", "total_volume_24h"), True),
    ("total_volume_24h_reported", ("quote", "USD", "total_volume_24h_reported"), True),
    ("altcoin_market_cap", ("quote", "USD", "altcoin_market_cap"), True),
    ("altcoin_volume_24h", ("quote", "USD", "altcoin_volume_24h"), True),
    ("altcoin_volume_24h_reported", ("quote", "USD", "altcoin_volume_24h_reported"), True),
    ("quote_timestamp", ("quote", "USD", "timestamp"), False),
]
GLOBAL_METRICS_KEYS = ["timestamp"]
# Last N daily quotes requested per run (configured count).
GLOBAL_METRICS_COUNT = 2
# EOD look-back in days (both VN and global loads).
EOD_LOOKBACK_DAYS = 3
# ------------------------------------------------------- end fixed values

# Conflict keys and fixed write policy of each load (None: the caller chooses).
TABLES = {
    "stock_list": (STOCK_LIST_KEYS, "update"), "basic_info": (BASIC_INFO_KEYS, "update"),
    "vn_eod": (VN_EOD_KEYS, "nothing"), "fin_indicators": (FIN_KEYS, None),
    "global_eod": (GLOBAL_EOD_KEYS, "nothing"), "global_metrics": (GLOBAL_METRICS_KEYS, "update"),
}

# Column types are ours (the original has no DDL).
BASIC_INFO_TYPES = {c: "double" for c in ("volume_daily", "vol_tb_15ngay", "vonhoa", "dif", "dif_percent",
                                          "tong_tai_san", "soluongluuhanh", "soluongniemyet", "cophieuquy")}
BASIC_INFO_TYPES["donvikiemtoan"] = "json"
VN_EOD_TYPES = {c: "double" for c in VN_EOD_COLUMNS if c not in ("mack", "ngay", "lastupdate", "created_at")}
VN_EOD_TYPES["ngay"] = "date"
GLOBAL_EOD_TYPES = {"company_id": "long", "date": "date", **{c: "double" for c in
                    ("open", "high", "low", "close", "adjusted_close", "volume")}}
GLOBAL_METRICS_TYPES = {"timestamp": "string", "quote_timestamp": "string",
                        "active_cryptocurrencies": "long", "active_exchanges": "long",
                        "active_market_pairs": "long"}

STOCK_LIST_SPECS = specs_from_config(STOCK_LIST_COLUMNS)
BASIC_INFO_SPECS = specs_from_config(BASIC_INFO_COLUMNS, BASIC_INFO_TYPES)
VN_EOD_SPECS = specs_from_config(VN_EOD_COLUMNS, VN_EOD_TYPES)
GLOBAL_EOD_SPECS = specs_from_config(GLOBAL_EOD_COLUMNS, GLOBAL_EOD_TYPES)
GLOBAL_METRICS_SPECS = [
    ColumnSpec(name, name, GLOBAL_METRICS_TYPES.get(name, "double"), path, "float" if flt else None)
    for name, path, flt in GLOBAL_METRICS_FIELDS
]


def ratio_columns_from(path: str) -> list[str]:
    """Indicator columns from a JSON file of the caller: a list of names, or an object with ``columns``."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    names = said["columns"] if isinstance(said, dict) else said
    fixed = ("mack", "quy", "nam")
    return [n for n in names if n not in fixed]


def fin_specs(ratio_columns) -> list[ColumnSpec]:
    """Identity mapping of the three keys plus the given ratio names."""
    return specs_from_config(["mack", "quy", "nam", *ratio_columns],
                             {"quy": "int", "nam": "int", **{r: "double" for r in ratio_columns}})


def record_order(seq: str = "seq", pos: str = "_pos") -> Column:
    """Order of records within a run: payload seq, then position in it."""
    return F.col(seq).cast("decimal(38,0)") * F.lit(10**9).cast("decimal(38,0)") + F.col(pos)


def _merge(target: DataFrame | None, batch: DataFrame, keys, policy: str, columns) -> DataFrame:
    keep = "last" if policy == "update" else "first"
    if target is None:
        return M.dedupe(batch, keys, "_seq", keep).select(*columns)
    return M.upsert(target, batch, keys, policy, order="_seq", keep=keep,
                    mapped=[c for c in batch.columns if c != "_seq"])


# ------------------------------------------------------------------ loads

# Tables whose keys hold a date or a time are stored by it, four weeks to a folder: a run reads and writes the
# folders of its batch, two at most for a look-back of days, and years of history stay few folders.
DAY_COLUMNS = {"vn_eod": "ngay", "global_eod": "date", "global_metrics": "timestamp"}


def stored_table(spark, name: str, path: str) -> KeyedTable:
    """The keyed table of a load."""
    return KeyedTable(spark, path, TABLES[name][0], DAY_COLUMNS.get(name), retain_hours=24, unit_days=28)


DEAD = ("_kind", "_payload")     # what a payload without records says (see ``payload.unwrap``)


def of_codes(landed: DataFrame, codes: DataFrame | None) -> DataFrame:
    """Payloads of listed codes only (a semi-join on the code list); all of them without a list."""
    return landed if codes is None else landed.join(codes.select("code"), "code", "left_semi")


def landed_within(landed: DataFrame, run_date: str | None, days: int | None) -> DataFrame:
    """Payloads landed for dates of the look-back; prunes at the scan if they are partitioned by ``landed_date``."""
    if run_date is None or "landed_date" not in landed.columns:
        return landed
    return within_lookback(landed, "landed_date", run_date, EOD_LOOKBACK_DAYS if days is None else days)


def dated_within(records: DataFrame, date_col: str, run_date: str | None, days: int | None) -> DataFrame:
    """Records of the look-back; all of them without a run date (and dead letters, which have no date)."""
    if run_date is None:
        return records
    inside = _in_lookback(date_col, run_date, EOD_LOOKBACK_DAYS if days is None else days)
    return records.where(inside | F.col(DEAD[0]).isNotNull() if DEAD[0] in records.columns else inside)


def _records(landed: DataFrame, mode: str, keep, watch: Observation | None, **options) -> DataFrame:
    """The records of landed payloads; watched, the payloads are counted and those without records kept as dead letters."""
    if watch is None:
        return P.unwrap(parse_payloads(landed), mode, keep=keep, **options)
    counted = landed.observe(watch, F.count(F.lit(1)).alias("landed"))
    return P.unwrap(parse_payloads(counted), mode, keep=keep, dead="payload", **options)


def _kept(recs: DataFrame) -> list:
    """What travels beside the mapped columns: the order of the record and, watched, what a dead letter says."""
    return [record_order().alias("_seq"), *[c for c in (*DEAD, "seq") if DEAD[0] in recs.columns]]


def stock_list_records(landed: DataFrame, listings=None, watch: Observation | None = None) -> DataFrame:
    """Landed (listing, seq, payload) -> mapped stock rows with ``_seq``.

    ``listings`` is the configured order of the listings (later ones win);
    others are left out. Without it the rows' ``seq`` alone decides.
    """
    keep, order = ["listing", "seq"], record_order()
    if listings:
        landed = landed.where(F.col("listing").isin(list(listings)))
        place = F.array_position(F.array(*[F.lit(x) for x in listings]), F.col("listing"))
        order = place.cast("decimal(38,0)") * F.lit(str(10**28)).cast("decimal(38,0)") + order
    recs = _records(landed, "list", keep, watch)
    return map_columns(recs, STOCK_LIST_SPECS, keep=[order.alias("_seq"), *_kept(recs)[1:]])


def load_stock_list(landed: DataFrame, target: DataFrame | None = None, on_empty: str = "error",
                    listings=None) -> DataFrame:
    """Union of all listings in order; upsert by code (last listing wins)."""
    batch = stock_list_records(landed, listings)
    if on_empty == "error":
        M.check_empty(batch, "error")
    return _merge(target, batch, STOCK_LIST_KEYS, "update", STOCK_LIST_COLUMNS)


def basic_info_records(landed: DataFrame, codes: DataFrame | None = None, watch: Observation | None = None) -> DataFrame:
    recs = _records(of_codes(landed, codes), "first", ["code", "seq"], watch)
    return map_columns(recs, BASIC_INFO_SPECS, keep=_kept(recs))


def load_basic_info(landed: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return _merge(target, basic_info_records(landed), BASIC_INFO_KEYS, "update", BASIC_INFO_COLUMNS)


def vn_eod_records(landed: DataFrame, codes: DataFrame, run_date: str | None = None,
                   lookback_days: int | None = None, watch: Observation | None = None) -> DataFrame:
    """Prices of listed codes, of the look-back before ``run_date`` if one is given."""
    listed = of_codes(landed_within(landed, run_date, lookback_days), codes)
    recs = _records(listed, "array", ["code", "seq"], watch)
    rows = map_columns(recs, VN_EOD_SPECS, keep=_kept(recs))
    return dated_within(rows, "ngay", run_date, lookback_days)


def load_vn_eod(landed: DataFrame, codes: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return _merge(target, vn_eod_records(landed, codes), VN_EOD_KEYS, "nothing", VN_EOD_COLUMNS)


def fin_records(landed: DataFrame, ratio_columns, codes: DataFrame | None = None, watch: Observation | None = None) -> DataFrame:
    """Records with a falsy ``mack`` get the request code."""
    recs = _records(of_codes(landed, codes), "records", ["code", "seq"], watch)
    return map_columns(recs, fin_specs(ratio_columns), keep=_kept(recs),
                       overrides={"mack": fill_falsy("rec", "mack", "code")})


def load_fin_indicators(landed: DataFrame, ratio_columns, target: DataFrame | None = None,
                        policy: str = "update") -> DataFrame:
    cols = ["mack", "quy", "nam", *ratio_columns]
    return _merge(target, fin_records(landed, ratio_columns), FIN_KEYS, policy, cols)


def active_companies(companies: DataFrame, only_active: bool = True) -> DataFrame:
    """(company_id, ticker) of usable companies: non-empty ticker, id present."""
    df = companies.where(F.col("is_active")) if only_active else companies
    return (df.select(F.col("id").alias("company_id"), "ticker")
              .where(F.col("ticker").isNotNull() & (F.col("ticker") != "") & F.col("company_id").isNotNull()))


def global_eod_records(landed: DataFrame, companies: DataFrame, run_date: str | None = None,
                       lookback_days: int | None = None, watch: Observation | None = None) -> DataFrame:
    """Array payloads per ticker joined to their company; the company's id
    and ticker override the record's fields. Error payloads (``message`` and
    ``code``) give no records."""
    joined = landed_within(landed, run_date, lookback_days).join(active_companies(companies), "ticker", "inner")
    recs = _records(joined, "array", ["ticker", "company_id", "seq"], watch, skip_errors="message_code")
    rows = map_columns(recs, GLOBAL_EOD_SPECS, keep=_kept(recs),
                       overrides={"company_id": F.col("company_id"), "ticker": F.col("ticker")})
    return dated_within(rows, "date", run_date, lookback_days)


def load_global_eod(landed: DataFrame, companies: DataFrame, target: DataFrame | None = None) -> DataFrame:
    return _merge(target, global_eod_records(landed, companies), GLOBAL_EOD_KEYS, "nothing",
                  GLOBAL_EOD_COLUMNS)


def global_metrics_records(landed: DataFrame, on_error: str = "fail", watch: Observation | None = None) -> DataFrame:
    """Quotes under data.quotes, mapped, timestamps floored to UTC midnight;
    quotes without a usable timestamp (NULL or epoch 0) are dropped.

    An error payload, or one that is no JSON, fails the load; ``on_error``
    'skip' leaves such payloads out (``payload.split_errors`` reports them)."""
    if on_error == "fail":
        docs = parse_payloads(landed)
        # the original aborts on a missing / unparsable payload and on an API error
        if not docs.where(F.col("doc").isNull()).limit(1).isEmpty():
            raise RuntimeError("payload is missing or not JSON")
        P.raise_on_errors(P.split_errors(docs)[1])
    recs = _records(landed, "path", ["seq"], watch, path=("data", "quotes"), skip_errors="status",
                    rec_type=record_struct_type(GLOBAL_METRICS_SPECS))
    timed = recs.select("*", parse_iso_ms(F.col("rec").getField("timestamp")).alias("_ms"))
    # any time outside the day 0; Spark moves the test down to where each use of ``_ms`` parses the text once more,
    # so it is made before the mapping and uses it twice
    usable = (F.col("_ms") < 0) | (F.col("_ms") >= DAY_MS)
    timed = timed.where(usable if watch is None else usable | F.col(DEAD[0]).isNotNull())
    mapped = map_columns(timed, GLOBAL_METRICS_SPECS, keep=_kept(recs), overrides={"timestamp": day_floor_ms("_ms")})
    return mapped.withColumn("quote_timestamp", normalize_ts_day("quote_timestamp"))


GLOBAL_METRICS_COLUMNS = [f[0] for f in GLOBAL_METRICS_FIELDS]


def load_global_metrics(landed: DataFrame, target: DataFrame | None = None,
                        truncate: bool = False, on_error: str = "fail") -> DataFrame:
    batch = global_metrics_records(landed, on_error)
    if truncate:
        return M.truncate_load(batch, GLOBAL_METRICS_KEYS, "_seq", GLOBAL_METRICS_COLUMNS)
    return _merge(target, batch, GLOBAL_METRICS_KEYS, "update", GLOBAL_METRICS_COLUMNS)


def latest_n(table: DataFrame, n: int = GLOBAL_METRICS_COUNT, ts_col: str = "timestamp") -> DataFrame:
    """The last ``n`` rows by time (a top-k report: limit is the feature)."""
    return table.orderBy(F.col(ts_col).desc()).limit(n)


def within_lookback(df: DataFrame, date_col: str, run_date: str, days: int = EOD_LOOKBACK_DAYS) -> DataFrame:
    """Rows dated in [run_date - days, run_date], both ends included."""
    return df.where(_in_lookback(date_col, run_date, days))


def _in_lookback(date_col: str, run_date: str, days: int):
    d = F.col(date_col)
    return (d >= F.date_sub(F.lit(run_date).cast("date"), days)) & (d <= F.lit(run_date).cast("date"))


def load_counts(landed: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Payloads landed and records obtained per source key (reporting)."""
    p = landed.groupBy(key).agg(F.count(F.lit(1)).alias("payloads"))
    r = records.groupBy(key).agg(F.count(F.lit(1)).alias("records"))
    return (p.join(r, key, "left")
             .select(key, "payloads", F.coalesce("records", F.lit(0)).cast("long").alias("records")))
