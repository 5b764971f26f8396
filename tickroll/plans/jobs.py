"""Scheduled batch jobs: what an external scheduler calls per run.

``rollup_job``      one rollup run: resolve the range, roll up, merge into
                    the day-partitioned target, report candles written per slice.
``candle_sync_job`` one incremental ingest run over landed pages: pairs,
                    resume points, new rows, candles first, checkpoints second.
``load_job``        one run of a named table load into its stored table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickroll.functions.timefn import BATCH_DAYS, DAY_MS, LOOKBACK_DAYS, RunRange, interval_ms
from tickroll.operators import candles as C
from tickroll.operators import incremental as I
from tickroll.operators import merge as M
from tickroll.plans import loads as LD
from tickroll.session import stage
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import decode_pages
from tickroll.streaming.ingest import CHECKPOINT_SCHEMA, ingest_batch

# Below every day: a comparison that drops nothing, by which Spark takes the wanted pages for a
# selective side and prunes the landed partitions by them.
NO_DAY = -10**9
# Why a payload gave no records.
LOAD_KINDS = ("unreadable", "message_code", "status", "wrong_shape")


def rollup_job(spark: SparkSession, source: DataFrame | KeyedTable, target: KeyedTable, interval: str,
               run_time: str | datetime, conf: dict | None = None) -> DataFrame:
    """Roll ``source`` (3m candles) up to ``interval`` over the run's range.

    The whole range is aggregated at once and merged into the target (only
    the touched days). A ``KeyedTable`` source opens the range's days only.
    Returns candles written (inserted and updated) per report slice, counted
    on the staged batch of the merge.
    """
    bms = interval_ms(interval)
    rr = RunRange.from_conf(bms, run_time, LOOKBACK_DAYS[interval], conf)
    if isinstance(source, KeyedTable):
        source = source.read(days=(rr.start_ms // DAY_MS, (rr.end_ms - 1) // DAY_MS))
    written = target.merge(C.stored(C.rollup(source, bms, rr)), "update", unique=True)
    return C.slice_counts(spark, written, interval, rr, BATCH_DAYS.get(interval))


def candle_sync_job(spark: SparkSession, meta: DataFrame, landed_pages: DataFrame,
                    candles: KeyedTable, checkpoints: KeyedTable, now_ms: int,
                    since_days: int | None, timeframe: str = "3m", updated_at: str | None = None,
                    rejects: KeyedTable | None = None) -> None:
    """One ingest run: every pair at once, data first, checkpoints second.

    ``landed_pages`` has the UTC day of each page in ``page_seq`` and, if pages
    may land more than once, their order of arrival in ``landed_seq``
    (``sources.landed.read_pages`` adds it). A pair's pages from its highest
    candle on are wanted, and those with outstanding rows; both are days, so
    with pages partitioned by ``page_seq`` (``landed.write_pages``) Spark prunes
    the partitions by the join itself, one stale pair opening its own days
    only. What is wanted is decoded once. A crash between the two steps
    repeats data on the next run (the merge absorbs it) but never skips any.
    """
    pairs = I.explode_pairs(meta, on_empty="error")
    old = checkpoints.read()
    if old is None:
        old = spark.createDataFrame([], CHECKPOINT_SCHEMA)
    gaps = rejects.read() if rejects is not None else None
    if gaps is not None and "high_ts_ms" in old.columns:
        # outstanding rows are read again on their own, so new pages start at the highest candle
        old = old.withColumn("last_ts_ms", F.greatest("last_ts_ms", "high_ts_ms"))
    since = stage(I.since_per_pair(pairs, old, timeframe, now_ms=now_ms, since_days=since_days), "since")
    days = landed_pages.select("page_seq").distinct()
    wanted = stage(I.pages_wanted(days, since, gaps), "pages-wanted").where(F.col("page_seq") > NO_DAY)
    arrival = [I.LANDED] if I.LANDED in landed_pages.columns else []
    decoded = decode_pages(landed_pages.join(wanted, list(I.PAGE_KEYS)), keep=["page_seq", "since_ms", *arrival])
    new = decoded.where(F.col("since_ms").isNull() | F.col("reject").isNotNull()
                        | (F.col("timestamp") >= F.col("since_ms"))).drop("since_ms")
    stamp = updated_at or datetime.fromtimestamp(now_ms / 1000, tz=timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    ingest_batch(spark, new, candles, checkpoints, None, timeframe, stamp, rejects)


def load_job(spark: SparkSession, name: str, landed: DataFrame, table: KeyedTable, *, codes: DataFrame | None = None,
             companies: DataFrame | None = None, columns=None, policy: str = "update", listings=None,
             run_date: str | None = None, lookback_days: int | None = None, truncate: bool = False,
             on_error: str = "fail") -> DataFrame:
    """``load_run``; returns the rows written."""
    return load_run(spark, name, landed, table, codes=codes, companies=companies, columns=columns, policy=policy, listings=listings,
                    run_date=run_date, lookback_days=lookback_days, truncate=truncate, on_error=on_error).written


@dataclass
class LoadRun:
    """What a load did: the rows it wrote, the payloads that gave no records (_kind, _payload, seq), and counts."""

    written: DataFrame
    dead: DataFrame
    counts: dict[str, int]


def load_run(spark: SparkSession, name: str, landed: DataFrame, table: KeyedTable, *, codes: DataFrame | None = None,
             companies: DataFrame | None = None, columns=None, policy: str = "update", listings=None,
             run_date: str | None = None, lookback_days: int | None = None, truncate: bool = False,
             on_error: str = "fail", commit: tuple[str, int] | None = None) -> LoadRun:
    """One run of a named load: landed payloads -> records -> keyed write.

    ``name`` is one of ``loads.TABLES``. ``truncate`` replaces the stored
    table by the batch (also an empty one); otherwise the batch is merged
    under the load's policy (inserts are appended).

    Payloads are parsed in one pass, which writes records and dead letters
    side by side to the shared folder and counts as it writes: payloads landed
    (of the listed codes, companies and days), 'unreadable' ones, errors (by
    the name of their test), ones of the 'wrong_shape', and records. The merge
    adds the rows ``written``. ``commit`` names the run by its writer (see
    ``KeyedTable``): one that the table has already writes nothing.
    """
    watch = Observation(f"{name}-landed")
    if name == "stock_list":
        batch = LD.stock_list_records(landed, listings, watch)
    elif name == "basic_info":
        batch = LD.basic_info_records(landed, codes, watch)
    elif name == "vn_eod":
        batch = LD.vn_eod_records(landed, codes, run_date, lookback_days, watch)
    elif name == "fin_indicators":
        batch = LD.fin_records(landed, columns, codes, watch)
    elif name == "global_eod":
        batch = LD.global_eod_records(landed, companies, run_date, lookback_days, watch)
    elif name == "global_metrics":
        batch = LD.global_metrics_records(landed, on_error, watch)
    else:
        raise ValueError(f"unknown load {name!r}: one of {sorted(LD.TABLES)}")
    keys, own = LD.TABLES[name]
    policy = own or policy
    kinds = Observation(f"{name}-records")
    kind, *_ = LD.DEAD
    batch = stage(batch.observe(kinds, F.count(F.when(F.col(kind).isNull(), 1)).alias("records"), *[
        F.count(F.when(F.col(kind) == k, 1)).alias(k) for k in LOAD_KINDS]), "load-rows")
    dead = batch.where(F.col(kind).isNotNull()).select(*LD.DEAD, "seq")
    batch = batch.where(F.col(kind).isNull()).drop(*LD.DEAD, "seq")
    if name == "stock_list":
        M.check_empty(batch, "error")
    if truncate:
        rows = stage(M.truncate_load(batch, keys, "_seq"), "load-batch")
        table.replace(rows, commit=commit)
    else:
        rows = table.merge(batch, policy, order="_seq", commit=commit)
    return LoadRun(rows, dead, {**watch.get, **kinds.get, "written": rows.count()})
