"""Incremental candle ingest: pairs, resume points, new rows, checkpoints.

All pairs are handled in one job: the per-pair loop of the original
becomes joins on (symbol, exchange), and parallelism comes from
partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickroll.functions.textfn import split_list
from tickroll.functions.timefn import DAY_MS
from tickroll.operators.merge import check_empty

PAIR_KEYS = ("symbol", "exchange")
CHECKPOINT_KEYS = ("symbol", "exchange", "timeframe")
PAGE_KEYS = ("symbol", "exchange", "page_seq")
LANDED = "landed_seq"          # orders the copies of a page by arrival
NOTHING_BEFORE = -2**63        # a gap with no candle before it


def explode_pairs(meta: DataFrame, symbol_col: str = "symbol",
                  list_col: str = "available_exchange", sep: str = ",",
                  on_empty: str | None = None) -> DataFrame:
    """Metadata rows with a comma list of exchanges -> distinct (SYMBOL, exchange).

    Rows with a NULL or empty list are skipped; items are stripped of all
    white space and empty items dropped; the symbol is upper-cased, the
    exchange kept as is. NULL symbols are dropped (see ``pair_rejects``).
    ``on_empty='error'`` raises when no pair results (nothing to sync).
    """
    rows = meta.where(F.col(list_col).isNotNull() & (F.col(list_col) != "")
                      & F.col(symbol_col).isNotNull())
    pairs = (rows.select(F.upper(symbol_col).alias("symbol"),
                         F.explode(split_list(list_col, sep)).alias("exchange"))
                 .dropDuplicates(["symbol", "exchange"]))
    if on_empty:
        check_empty(pairs, on_empty)
    return pairs


def pair_rejects(meta: DataFrame, symbol_col: str = "symbol",
                 list_col: str = "available_exchange") -> DataFrame:
    """Counts of metadata rows skipped for a NULL symbol or an empty list."""
    has_list = F.col(list_col).isNotNull() & (F.col(list_col) != "")
    return meta.agg(
        F.count(F.when(has_list & F.col(symbol_col).isNull(), 1)).alias("null_symbol"),
        F.count(F.when(~has_list | F.col(list_col).isNull(), 1)).alias("empty_list"))


def market_symbol(symbol, quote: str = "USDT") -> Column:
    """'BTC' -> 'BTC/USDT'."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    return F.concat_ws("/", s, F.lit(quote))


def since_per_pair(pairs: DataFrame, checkpoint: DataFrame, timeframe: str = "3m",
                   now_ms: int | None = None, since_days: int | None = None,
                   refetch_last: bool = False) -> DataFrame:
    """Resume point per pair: last_ts + 1, else now - since_days, else NULL.

    NULL means "everything". ``refetch_last`` resumes at last_ts itself
    (harmless, the keyed merge absorbs the repeated candle).
    """
    ck = (checkpoint.where(F.col("timeframe") == F.lit(timeframe))
                    .select(*PAIR_KEYS, "last_ts_ms"))
    cutoff = (F.lit(int(now_ms - since_days * DAY_MS))
              if (now_ms is not None and since_days and since_days > 0)
              else F.lit(None).cast("long"))
    step = 0 if refetch_last else 1
    return (pairs.join(ck, list(PAIR_KEYS), "left")
                 .select(*PAIR_KEYS, F.coalesce(F.col("last_ts_ms") + F.lit(step), cutoff).alias("since_ms")))


def incremental_new_rows(rows: DataFrame, since: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Rows of known pairs at or after their pair's resume point.

    There is one resume point per pair. Spark broadcasts them while they are
    under its byte threshold (statistics, or the measured size at run time);
    beyond it a sort-merge join splits the partitions of hot pairs.
    """
    return (rows.join(since, list(PAIR_KEYS), "inner")
                .where(F.col("since_ms").isNull() | (F.col(ts_col) >= F.col("since_ms")))
                .drop("since_ms"))


def pages_wanted(days: DataFrame, since: DataFrame, gaps: DataFrame | None = None) -> DataFrame:
    """(symbol, exchange, page_seq, since_ms): pages of each pair from its resume point on, and those with gaps.

    ``days`` has the UTC days that landed (``page_seq``), ``since`` the resume
    points, ``gaps`` the pages that hold outstanding rows. since_ms is NULL
    where every row of the page is wanted.
    """
    wanted = since.join(days, F.col("since_ms").isNull() | (F.col("page_seq") >= F.expr(f"since_ms div {DAY_MS}"))).select(
        *PAGE_KEYS, "since_ms", F.col("since_ms").isNull().alias("_all"))
    if gaps is not None:
        again = gaps.select(*PAGE_KEYS).distinct().join(since.select(*PAIR_KEYS), list(PAIR_KEYS), "left_semi")
        wanted = wanted.unionByName(again.select(*PAGE_KEYS, F.lit(None).cast("long").alias("since_ms"), F.lit(True).alias("_all")))
    return wanted.groupBy(*PAGE_KEYS).agg(F.when(~F.max("_all"), F.min("since_ms")).alias("since_ms"))


def page_gaps(decoded: DataFrame, high: DataFrame) -> DataFrame:
    """Rows that can't be used, of the newest copy of each page: page keys, position, reject, after_ts.

    ``decoded`` has rows of landed pages with ``landed_seq``. A newer copy of a
    page replaces what an older one could not say; of copies that landed at
    once, a usable row at a position (or in a page that says no row at all)
    makes up for the unusable one. ``after_ts`` is the latest candle before the
    gap: in the page, in earlier pages of the batch, or in ``high`` (the
    highest candle of each pair so far); NULL if there is none.

    Windows are over one page, and over the pages of a pair; no pair's rows
    ever meet in one task.
    """
    good = F.when(F.col("reject").isNull(), F.col("timestamp"))
    pages = decoded.groupBy(*PAGE_KEYS).agg(F.max(LANDED).alias("_newest"), F.max(good).alias("_most"),
                                            F.max(F.when(F.col("reject").isNotNull(), F.lit(True))).alias("_bad"))
    earlier = Window.partitionBy(*PAIR_KEYS).orderBy("page_seq").rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.withColumn("_before", F.max("_most").over(earlier)).where("_bad")
    newest = decoded.join(pages.drop("_bad", "_most"), list(PAGE_KEYS)).where(F.col(LANDED).eqNullSafe(F.col("_newest")))
    page = Window.partitionBy(*PAGE_KEYS)
    rows = newest.withColumns({
        "_inside": F.max(good).over(page.orderBy("position").rangeBetween(Window.unboundedPreceding, -1)),
        "_page_good": F.max(F.col("reject").isNull()).over(page),
        "_row_good": F.max(F.col("reject").isNull()).over(Window.partitionBy(*PAGE_KEYS, "position"))})
    open_ = F.col("reject").isNotNull() & ~F.when(F.col("reject") == "bad_json", F.col("_page_good")).otherwise(F.col("_row_good"))
    return (rows.where(open_).join(high, list(PAIR_KEYS), "left")
            .groupBy(*PAGE_KEYS, "position").agg(F.min("reject").alias("reject"), F.max(F.greatest("_inside", "_before", "high_ts_ms")).alias("after_ts")))


def gaps_left(stored: DataFrame, decoded: DataFrame) -> DataFrame:
    """Stored gaps of pages that did not land again, their ``after_ts`` moved up to what landed before them."""
    good = F.max(F.when(F.col("reject").isNull(), F.col("timestamp"))).alias("_most")
    pages = decoded.groupBy(*PAGE_KEYS).agg(good)
    left = stored.join(pages.select(*PAGE_KEYS), list(PAGE_KEYS), "left_anti")
    earlier = Window.partitionBy(*PAIR_KEYS).orderBy("page_seq").rangeBetween(Window.unboundedPreceding, -1)
    both = left.unionByName(pages, allowMissingColumns=True)
    return both.withColumn("after_ts", F.greatest("after_ts", F.max("_most").over(earlier))).where("reject is not null").drop("_most")


def checkpoint_advance(checkpoint: DataFrame, new_rows: DataFrame, gaps: DataFrame, timeframe: str, updated_at) -> DataFrame:
    """Advance each pair's checkpoint to its first gap, or to its highest candle where it has none; never back.

    ``gaps`` are all outstanding rows (see ``page_gaps``). ``high_ts_ms`` keeps
    the highest candle, so a pair whose last gap closes catches up at once.
    """
    if "high_ts_ms" not in checkpoint.columns:
        checkpoint = checkpoint.withColumn("high_ts_ms", F.col("last_ts_ms"))
    newest = new_rows.groupBy(*PAIR_KEYS).agg(F.max("timestamp").alias("_new")).withColumn("timeframe", F.lit(timeframe))
    hold = gaps.groupBy(*PAIR_KEYS).agg(F.min(F.coalesce("after_ts", F.lit(NOTHING_BEFORE))).alias("_hold")).withColumn(
        "timeframe", F.lit(timeframe))
    upd = (updated_at if isinstance(updated_at, Column) else F.lit(updated_at)).cast(checkpoint.schema["updated_at"].dataType)
    high = F.greatest("high_ts_ms", "last_ts_ms", "_new")
    reach = F.when(F.col("_hold").isNull(), high).when(F.col("_hold") != NOTHING_BEFORE, F.least(high, F.col("_hold")))
    return (checkpoint.join(newest, list(CHECKPOINT_KEYS), "full_outer").join(hold, list(CHECKPOINT_KEYS), "left").select(
        *CHECKPOINT_KEYS, F.greatest("last_ts_ms", reach).alias("last_ts_ms"), high.alias("high_ts_ms"),
        F.when(F.col("_new").isNotNull(), upd).otherwise(F.col("updated_at")).alias("updated_at")))


def checkpoint_next(checkpoint: DataFrame, new_rows: DataFrame, timeframe: str,
                    updated_at, ts_col: str = "timestamp") -> DataFrame:
    """Advance each pair's checkpoint to the max new timestamp; never back.

    Uses ``max(ts)`` (not the last row's ts) and ``greatest(old, new)``.
    ``updated_at`` is a literal value or column for the update time.
    """
    newest = (new_rows.groupBy(*PAIR_KEYS).agg(F.max(ts_col).alias("_new"))
              .withColumn("timeframe", F.lit(timeframe)))
    upd = updated_at if isinstance(updated_at, Column) else F.lit(updated_at)
    upd = upd.cast(checkpoint.schema["updated_at"].dataType)
    # one row per pair on both sides: one full outer join, each side read once
    return checkpoint.join(newest, list(CHECKPOINT_KEYS), "full_outer").select(
        *CHECKPOINT_KEYS, F.greatest("last_ts_ms", "_new").alias("last_ts_ms"),
        F.when(F.col("_new").isNotNull(), upd).otherwise(F.col("updated_at")).alias("updated_at"))
