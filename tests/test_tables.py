"""Stored tables, ingest batches, page decoding and scheduled jobs."""

import glob
import json
import re

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.test_semantics import CANDLE_SCHEMA, ms, rows
from tickroll.functions.timefn import RunRange, instant, interval_ms
from tickroll.operators import candles as C
from tickroll.operators import incremental as I
from tickroll.operators import merge as M
from tickroll.plans import jobs, loads
from tickroll.plans.catalog import QUERIES
from tickroll.session import local_path, shared_dir, stage
from tickroll.sources import testdata as T
from tickroll.sources.keyed_table import KeyedTable
from tickroll.sources.landed import candle_pages, decode_pages, page_rejects, read_pages, write_pages
from tickroll.streaming import ingest as SI

DAY = 86_400_000
KV = "k string, v double"
KTV = "k string, timestamp long, v double"


def table(spark, keys=("k",), ts_col=None, **options):
    return KeyedTable(spark, shared_dir(spark, "kt-test"), keys, ts_col, **options)


# ------------------------------------------------------------- keyed tables
def test_versions_and_replays(spark):
    t = table(spark)
    assert t.read() is None and t.current() is None
    b1, b2 = spark.createDataFrame([("a", 1.0), ("b", 2.0)], KV), spark.createDataFrame([("b", 3.0), ("c", 4.0)], KV)
    t.merge(b1, unique=True, version=1)
    t.merge(b2, unique=True, version=2)
    before = sorted(glob.glob(local_path(t.path) + "/data/*/*/*.parquet"))
    t.merge(b2, unique=True, version=2)          # replayed: merges into version 1 again, in new folders
    assert t.versions() == [1, 2]
    assert set(before) < set(glob.glob(local_path(t.path) + "/data/*/*/*.parquet"))
    assert rows(t.read(), "k") == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert rows(t.read(1), "k") == [("a", 1.0), ("b", 2.0)]


def test_an_unfinished_write_is_never_seen(spark):
    t = table(spark)
    t.merge(spark.createDataFrame([("a", 1.0)], KV), unique=True)
    t._write(spark.createDataFrame([("a", 9.0)], KV))          # rows written, listing not
    spark.range(1).write.parquet(f"{t.path}/versions/000000000007-dead")
    fs, p = t._files(f"{t.path}/versions/000000000007-dead/_SUCCESS")
    fs.delete(p, False)                                        # a listing cut off half-way
    assert t.current() == 1 and rows(t.read()) == [("a", 1.0)]


def test_merge_touches_only_the_days_of_the_batch(spark):
    t = table(spark, ["k", "timestamp"], "timestamp")
    t.merge(spark.createDataFrame([("a", 19000 * DAY + 5, 1.0), ("a", 19001 * DAY + 5, 2.0)], KTV), unique=True)
    first = {d: a for d, a in t._listing(1)[0]}
    b2 = spark.createDataFrame([("a", 19001 * DAY + 5, 9.0), ("b", 19002 * DAY, 3.0)], KTV)
    t.merge(b2, unique=True)
    t.merge(b2, unique=True)
    assert rows(t.read().select("k", "timestamp", "v"), "timestamp", "k") == [
        ("a", 19000 * DAY + 5, 1.0), ("a", 19001 * DAY + 5, 9.0), ("b", 19002 * DAY, 3.0)]
    assert dict(t._listing(3)[0])["19000"] == first["19000"]
    assert t.read(days=(19001, 19001)).count() == 1


def test_dated_loads_touch_only_the_folders_of_the_batch(spark):
    """An insert of two dates opens their folders, not the history."""
    t = loads.stored_table(spark, "global_eod", shared_dir(spark, "dated"))
    t.replace(T.global_eod_target(spark, SF))
    before, price = set(t._listing(t.current())[0]), lambda k, d: (k, f"T{k}", d, 5.0)
    batch = spark.createDataFrame([price(1, "1995-03-05"), price(1, "1999-01-01"), price(2, "1999-01-01")],
                                  "company_id long, ticker string, d string, open double")
    batch = batch.select("company_id", "ticker", F.to_date("d").alias("date"), "open")
    for inserted in (3, 0):
        wrote = t.merge(batch, "nothing", unique=True)
        assert wrote.count() == inserted
    after = set(t._listing(t.current())[0])
    assert before < after and {d for d, _ in after - before} == {str(9194 // 28), str(10592 // 28)}
    assert t.read(days=(10592, 10592)).count() == 2 and t.read(days=(9200, 9300)).count() > 0


def test_null_times_are_kept(spark):
    t = table(spark, ["k", "timestamp"], "timestamp")
    t.merge(spark.createDataFrame([("a", None, 1.0), ("a", DAY, 2.0)], KTV), unique=True)
    t.merge(spark.createDataFrame([("b", None, 3.0), ("a", DAY, 4.0)], KTV), unique=True)
    t.merge(spark.createDataFrame([("a", DAY, 5.0)], KTV), unique=True)
    assert sorted((r["k"], r["timestamp"] or 0, r["v"]) for r in t.read().collect()) == [
        ("a", 0, 1.0), ("a", DAY, 5.0), ("b", 0, 3.0)]


def test_inserts_are_appended(spark):
    t = table(spark)
    t.merge(spark.createDataFrame([("a", 1.0)], KV), "nothing", unique=True)
    kept = t._listing(1)[0]
    wrote = t.merge(spark.createDataFrame([(1, "a", 5.0), (2, "b", 6.0), (3, "b", 7.0), (4, None, 8.0)], "_seq long, " + KV),
                    "nothing", order="_seq")
    assert sorted(rows(wrote), key=str) == [("b", 6.0), (None, 8.0)]
    assert set(kept) < set(t._listing(2)[0])
    assert sorted(rows(t.read()), key=str) == [("a", 1.0), ("b", 6.0), (None, 8.0)]


def test_rows_that_share_a_key_need_an_order(spark):
    t = table(spark)
    batch = spark.createDataFrame([(1, "a", 1.0), (2, "a", 2.0)], "_seq long, " + KV)
    with pytest.raises(ValueError):
        t.merge(batch)
    t.merge(batch, order="_seq")                 # also the first write
    assert rows(t.read()) == [("a", 2.0)]


def test_old_versions_are_deleted(spark):
    t = table(spark, keep=2)
    for i in range(5):
        t.merge(spark.createDataFrame([("a", float(i))], KV), unique=True)
    assert t.versions() == [4, 5] and rows(t.read()) == [("a", 4.0)]
    assert len(glob.glob(local_path(t.path) + "/data/day=0/*")) == 2


def test_replace_empties_a_table(spark):
    t = table(spark)
    t.merge(spark.createDataFrame([("a", 1.0)], KV), unique=True)
    t.replace(spark.createDataFrame([], KV))
    assert t.read().schema.simpleString() == "struct<k:string,v:double>" and t.read().count() == 0
    t.merge(spark.createDataFrame([("b", 1.0)], KV), unique=True)
    assert rows(t.read()) == [("b", 1.0)]


# -------------------------------------------------------------------- plans
def scans(df):
    return len(re.findall(r"Scan parquet", df._jdf.queryExecution().executedPlan().toString()))


def test_merge_plans_read_each_side_once(spark):
    target, batch = stage(T.orders_target(spark, SF), "plan-t"), stage(T.orders_batch(spark, SF), "plan-b")
    for merged in (M.upsert_update(target, batch, ["o_orderkey"], mapped=T.ORDER_MAPPED),
                   M.upsert_nothing(target, batch, ["o_orderkey"], mapped=T.ORDER_MAPPED),
                   M.merge_counts(target, batch, ["o_orderkey"])):
        assert scans(merged) == 2
    old, new = stage(T.checkpoint_table(spark, SF), "plan-k"), stage(T.candles_3m(spark, SF), "plan-c")
    assert scans(I.checkpoint_next(old, new, "3m", "now")) == 2


@pytest.mark.parametrize("name", ["ingest_candle_pages", "vn_eod_rows", "global_metrics", "global_eod", "basic_info", "fin_indicators"])
def test_no_filter_parses_json(spark, name):
    """What Spark infers or moves down must not read the documents once more."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if re.match(r"[ :+-]*Filter ", line)]
    assert filters and not [f for f in filters if "parseJson" in f]


@pytest.mark.parametrize("watched", [False, True])
def test_metrics_records_are_read_once(spark, watched):
    """The filter on the time reads the time only, not the whole record anew, and the records come as structs, with no
    probe of each element."""
    watch = Observation("metrics-plan") if watched else None
    plan = loads.global_metrics_records(T.metrics_payloads(spark, SF), "skip", watch)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    filters = [line for line in lines if re.match(r"[ :+-]*Filter ", line)]
    assert filters and not [f for f in filters if "total_market_cap" in f or "object_probe" in f]
    assert sum("StructField(total_market_cap,VariantType" in line for line in lines) == 1


def test_odd_metrics_quotes(spark):
    usd = lambda v: '{"USD":{"total_market_cap":%s,"timestamp":"2024-01-02T05:00:00Z"}}' % v
    quote = lambda when, v: '{"timestamp":%s,"btc_dominance":%s,"quote":%s}' % (when, v, usd(v))
    quotes = [quote('"2024-01-0%dT03:00:00Z"' % (i + 1), v) for i, v in enumerate(
        ["true", '"true"', '" 2 "', '"1.5d"', "1e3", "null", "[1]", '{"a":1}'])]
    quotes += ["null", "17", '"x"', "[]", "{}", quote('"1969-12-31T23:00:00Z"', 1), quote('"1970-01-01T10:00:00Z"', 2), quote('""', 3),
               quote("null", 4), quote("17", 5), quote('{"a":1}', 6), '{"timestamp":"2024-01-09T00:00:00+05:00","quote":[5]}',
               '{"timestamp":"2024-01-10T00:00:00Z","active_exchanges":"x","quote":{"USD":7}}']
    landed = spark.createDataFrame([(1, '{"data":{"quotes":[%s]}}' % ",".join(quotes)), (2, '{"data":{"quotes":{"timestamp":1}}}'),
                                    (3, '{"data":[]}'), (4, None), (5, "[]"), (6, '{"data":{"quotes":null}}')], "seq long, payload string")
    day = lambda d: ms(f"2024-01-{d:02d} 00:00:00")
    numbers = [1.0, None, 2.0, None, 1000.0, None, None, None]
    want = [(-DAY, 1.0, 1.0, day(2)), *[(day(i + 1), v, v, day(2)) for i, v in enumerate(numbers)], (day(10), None, None, None)]
    want[8] = (day(8), None, None, None)     # the last of that day: 2024-01-09T00:00+05:00
    columns = ["timestamp", "btc_dominance", "total_market_cap", "quote_timestamp"]
    assert rows(loads.load_global_metrics(landed, on_error="skip").select(*columns), "timestamp") == want
    t = KeyedTable(spark, shared_dir(spark, "load-run"), loads.GLOBAL_METRICS_KEYS)
    run = jobs.load_run(spark, "global_metrics", landed, t, on_error="skip")
    assert run.counts == {"landed": 6, "records": 11, "unreadable": 1, "message_code": 0, "status": 0, "wrong_shape": 4, "written": 10}
    assert rows(t.read().select(*columns), "timestamp") == want


def test_counts_of_all_intervals_take_one_scan(spark):
    c3 = stage(T.candles_3m(spark, SF), "plan-c3")
    ranges = {n: RunRange.resolve(interval_ms(n), "2024-01-31T00:00:00Z", 30) for n in ("1h", "1d", "7d")}
    counted = C.rollup_counts(spark, c3, ranges)
    assert scans(counted) == 1
    for name, run in ranges.items():
        direct = C.rollup(c3, interval_ms(name), run).count()
        assert counted.where(F.col("interval") == name).agg(F.sum("candles")).first()[0] == direct


def test_stored_candles_are_pruned_by_day(spark):
    t = table(spark, C.CANDLE_KEYS, "timestamp")
    t.merge(C.stored(T.candles_3m(spark, SF)), unique=True)
    rr = RunRange(ms("2024-01-05 00:00:00"), ms("2024-01-12 00:00:00"))
    q = C.rollup(t.read(), interval_ms("1h"), rr)
    assert "PartitionFilters: [isnotnull(day" in q._jdf.queryExecution().executedPlan().toString()
    some = C.rollup(t.read(days=(rr.start_ms // DAY, (rr.end_ms - 1) // DAY)), interval_ms("1h"), rr)
    direct = C.rollup(T.candles_3m(spark, SF), interval_ms("1h"), rr)
    for df in (q, some):
        assert df.exceptAll(direct).count() == 0 and direct.exceptAll(df).count() == 0


# ------------------------------------------------------------------ volumes
def test_volumes_are_not_narrowed(spark):
    candle = lambda ts, v: ("A", "x", ts, 1.0, 1.0, 1.0, 1.0, v)
    df = spark.createDataFrame([candle(0, 0.004), candle(180000, 0.004), candle(3_600_000, 3e16), candle(3_780_000, 3e16),
                                candle(7_200_000, 1e-9), candle(7_380_000, 2e-9)], CANDLE_SCHEMA)
    got = [r["volume"] for r in C.rollup(df, interval_ms("1h")).orderBy("timestamp").collect()]
    assert got == [0.008, 6e16, 3e-9]


# -------------------------------------------------------------- landed pages
PAGES = "symbol string, exchange string, page_seq long, payload string"


def test_one_bad_value_costs_no_other_candle(spark):
    payload = ('[[60000,1,2,0.5,1.5,"7.5"],[120000,1,2,0.5,1.5,8],[180000,1,2],5,[240000,"x",2,0.5,1.5,8],'
               '[null,1,2,0.5,1.5,8],["300000",null,2,0.5,1.5,1e3]]')
    pages = spark.createDataFrame([("A", "x", 0, payload), ("A", "x", 1, "[[1,2"), ("B", "x", 2, None), ("B", "x", 3, "[]"),
                                   ("B", "x", 4, '{"a":1}')], PAGES)
    good = rows(candle_pages(pages), "timestamp")
    assert good == [("A", "x", 60000, 1.0, 2.0, 0.5, 1.5, 7.5), ("A", "x", 120000, 1.0, 2.0, 0.5, 1.5, 8.0),
                    ("A", "x", 300000, None, 2.0, 0.5, 1.5, 1000.0)]
    assert sorted(rows(page_rejects(pages))) == [("A", "x", "bad_json", 1), ("A", "x", "bad_number", 1), ("A", "x", "no_time", 1),
                                                 ("A", "x", "short_row", 2), ("B", "x", "bad_json", 2)]


def ingest(spark, pages, candles, checkpoints, version, rejects=None):
    df = spark.createDataFrame(pages, PAGES)
    SI.ingest_batch(spark, decode_pages(df, keep=["page_seq"]), candles, checkpoints, version, "3m", "t", rejects)


def test_overlapping_pages_and_replays_store_a_candle_once(spark):
    base = shared_dir(spark, "ingest")
    candles, checkpoints = SI.candle_table(spark, f"{base}/c"), SI.checkpoint_table(spark, f"{base}/k")
    one = [("A", "x", 0, "[[180000,1,2,0.5,1.5,7],[360000,1,2,0.5,1.5,8]]"), ("A", "x", 1, "[[360000,2,3,1,2,9]]")]
    two = [("A", "x", 2, "[[360000,3,3,1,2,10],[540000,3,3,1,2,11]]")]
    for version, pages in [(1, one), (2, two), (2, two), (1, one), (2, two)]:
        ingest(spark, pages, candles, checkpoints, version)
    assert rows(candles.read().select("timestamp", "open", "volume"), "timestamp") == [
        (180000, 1.0, 7.0), (360000, 3.0, 10.0), (540000, 3.0, 11.0)]
    assert rows(checkpoints.read().select("symbol", "last_ts_ms")) == [("A", 540000)]
    assert "datetime" in candles.read().columns


def test_a_pair_with_rejects_does_not_advance(spark):
    base = shared_dir(spark, "rejects")
    candles, checkpoints = SI.candle_table(spark, f"{base}/c"), SI.checkpoint_table(spark, f"{base}/k")
    rejects = SI.reject_table(spark, f"{base}/r")
    ingest(spark, [("A", "x", 0, "[[180000,1,2,0.5,1.5,7]]"), ("B", "x", 0, "[[180000,1,2,0.5,1.5,7]]")], candles, checkpoints, 1, rejects)
    ingest(spark, [("A", "x", 1, "[[360000,1,2"), ("A", "x", 2, "[[540000,1,2,0.5,1.5,7]]"), ("B", "x", 2, "[[540000,1,2,0.5,1.5,7]]")],
           candles, checkpoints, 2, rejects)
    assert rows(checkpoints.read().select("symbol", "last_ts_ms"), "symbol") == [("A", 180000), ("B", 540000)]
    assert rows(rejects.read().select("symbol", "page_seq", "reject")) == [("A", 1, "bad_json")]
    assert candles.read().count() == 4


# ------------------------------------------- writers, arrival order and gaps
def test_commits_are_named_by_their_writer(spark):
    t = table(spark)
    for i in range(3):                                      # batch runs: versions 1 to 3
        t.merge(spark.createDataFrame([("a", float(i))], KV), unique=True)
    for batch, key in ((0, "b"), (1, "c")):                 # a stream, from its batch 0
        t.merge(spark.createDataFrame([(key, 1.0)], KV), unique=True, commit=("s1", batch))
    t.merge(spark.createDataFrame([("b", 9.0)], KV), unique=True)
    replayed = t.merge(spark.createDataFrame([("b", 1.0)], KV), unique=True, commit=("s1", 0))
    t.merge(spark.createDataFrame([("d", 1.0)], KV), unique=True, commit=("s2", 0))
    assert replayed.count() == 0 and replayed.columns == ["k", "v"]
    assert rows(t.read(), "k") == [("a", 2.0), ("b", 9.0), ("c", 1.0), ("d", 1.0)]
    assert t.committed("s1") == 1 and t.committed("s2") == 0 and t.committed("s3") is None
    t.replace(spark.createDataFrame([("z", 0.0)], KV), commit=("s2", 0))
    assert t.read().count() == 4


def test_versions_in_use_are_not_deleted_by_number(spark):
    t = table(spark, keep=1, retain_hours=1)
    for i in range(3):
        t.merge(spark.createDataFrame([("a", float(i))], KV), unique=True)
    assert t.versions() == [1, 2, 3] and rows(t.read(1)) == [("a", 0.0)]


def three(spark):
    base = shared_dir(spark, "ingest3")
    return SI.candle_table(spark, f"{base}/c"), SI.checkpoint_table(spark, f"{base}/k"), SI.reject_table(spark, f"{base}/r"), base


def test_streams_share_a_table_with_batch_runs(spark):
    candles, checkpoints, rejects, base = three(spark)
    page = lambda d: [("A", "x", d, f"[[{d * DAY},1,1,1,1,{d + 1}]]")]
    for d in range(3):
        ingest(spark, page(d), candles, checkpoints, None, rejects)
    for d, folder in ((3, "one"), (4, "one"), (5, "two")):   # the second folder's stream reads days 3 and 4 again
        spark.createDataFrame(page(d), PAGES).write.mode("append").parquet(f"{base}/landing")
        SI.run_ingest(spark, f"{base}/landing", candles, checkpoints, f"{base}/{folder}", rejects=rejects)
    assert rows(candles.read().select("timestamp", "volume"), "timestamp") == [(d * DAY, d + 1.0) for d in range(6)]
    assert rows(checkpoints.read().select("last_ts_ms", "high_ts_ms")) == [(5 * DAY, 5 * DAY)]


LANDED = PAGES + ", landed_seq long"


def test_the_last_landed_copy_wins_in_both_orders(spark):
    old, new = ("A", "x", 0, "[[180000,1,1,1,111,1]]", 1), ("A", "x", 0, "[[180000,1,1,1,222,1]]", 2)
    for pages in ([old, new], [new, old]):
        candles, checkpoints, rejects, _ = three(spark)
        SI.ingest_batch(spark, decode_pages(spark.createDataFrame(pages, LANDED), keep=["page_seq", "landed_seq"]),
                        candles, checkpoints, None, "3m", "t", rejects)
        assert rows(candles.read().select("close")) == [(222.0,)]


def sync(spark, pages, candles, checkpoints, rejects, schema=LANDED):
    meta = spark.createDataFrame([("a", "x")], "symbol string, available_exchange string")
    jobs.candle_sync_job(spark, meta, spark.createDataFrame(pages, schema), candles, checkpoints, 20 * DAY, 30, rejects=rejects)


@pytest.mark.parametrize("with_arrival", [True, False])
def test_a_good_copy_closes_the_gap(spark, with_arrival):
    """Bad copy, good copy, next day; then runs over the same pages: one set of rejects, and the checkpoint at the last candle."""
    candles, checkpoints, rejects, _ = three(spark)
    cut = lambda p: p if with_arrival else p[:4]
    schema = LANDED if with_arrival else PAGES
    bad = [cut(("A", "x", 2, "[[172800000,1,1,1,1", 1)), cut(("A", "x", 2, "[[172800000", 1))]
    good, then = cut(("A", "x", 2, "[[172800000,1,1,1,1,7]]", 2)), cut(("A", "x", 3, "[[259200000,1,1,1,1,8]]", 3))
    before = cut(("A", "x", 1, "[[86400000,1,1,1,1,6]]", 1))
    said = lambda: rows(checkpoints.read().select("last_ts_ms", "high_ts_ms"))
    for _ in range(4):
        sync(spark, [before, *bad], candles, checkpoints, rejects, schema)
        assert rejects.read().count() == 1 and said() == [(DAY, DAY)]
    sync(spark, [before, *bad, then], candles, checkpoints, rejects, schema)
    assert said() == [(DAY, 3 * DAY)]                      # the next day is stored, the gap is still open
    for _ in range(2):
        sync(spark, [before, *bad, good, then], candles, checkpoints, rejects, schema)
        assert rejects.read().count() == 0 and said() == [(3 * DAY, 3 * DAY)]
    assert rows(candles.read().select("volume"), "timestamp") == [(6.0,), (7.0,), (8.0,)]


def test_one_bad_row_holds_back_that_row_only(spark):
    candles, checkpoints, rejects, _ = three(spark)
    half = ("A", "x", 1, "[[86400000,1,1,1,1,6],[86580000,1],[86760000,1,1,1,1,6]]", 1)
    sync(spark, [half, ("A", "x", 4, "[[345600000,1,1,1,1,6],[345780000,1]]", 1)], candles, checkpoints, rejects)
    assert rows(rejects.read().select("page_seq", "position", "reject", "after_ts"), "page_seq") == [
        (1, 1, "short_row", DAY), (4, 1, "short_row", 4 * DAY)]
    assert rows(checkpoints.read().select("last_ts_ms", "high_ts_ms")) == [(DAY, 4 * DAY)] and candles.read().count() == 3
    sync(spark, [("A", "x", 1, "[[86400000,1,1,1,1,6],[86580000,1,1,1,1,6],[86760000,1,1,1,1,6]]", 2)], candles, checkpoints, rejects)
    assert rows(checkpoints.read().select("last_ts_ms", "high_ts_ms")) == [(4 * DAY, 4 * DAY)] and candles.read().count() == 4
    assert rejects.read().count() == 1


def test_landed_days_are_pruned_per_pair(spark):
    """Pages partitioned by day: the join with the wanted pages prunes their partitions."""
    base = shared_dir(spark, "pruned")
    pages = [(s, "x", d, f"[[{d * DAY},1,1,1,1,1]]") for s in "AB" for d in range(40)]
    write_pages(spark.createDataFrame(pages, PAGES), f"{base}/pages")
    landed = read_pages(spark, f"{base}/pages")
    since = stage(spark.createDataFrame([("A", "x", 38 * DAY + 1), ("B", "x", 39 * DAY)], "symbol string, exchange string, since_ms long"), "s")
    wanted = stage(I.pages_wanted(landed.select("page_seq").distinct(), since), "w").where(F.col("page_seq") > jobs.NO_DAY)
    found = landed.join(wanted, list(I.PAGE_KEYS))
    assert sorted((r["symbol"], r["page_seq"]) for r in found.collect()) == [("A", 38), ("A", 39), ("B", 39)]
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", found._jdf.queryExecution().executedPlan().toString())


# --------------------------------------------------------------------- jobs
def test_command_line_runs(spark, capsys):
    from tickroll.__main__ import main
    base = shared_dir(spark, "cli")
    source = KeyedTable(spark, f"{base}/ohlcv_3m", C.CANDLE_KEYS, "timestamp")
    source.merge(C.stored(T.candles_3m(spark, SF)), unique=True)
    assert main(["rollup", "--interval", "1d", "--source", f"{base}/ohlcv_3m", "--target", f"{base}/ohlcv_1d",
                 "--run-time", "2024-01-31T00:00:00Z"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    target = KeyedTable(spark, f"{base}/ohlcv_1d", C.CANDLE_KEYS, "timestamp").read()
    assert len(lines) == 3 and sum(x["candles"] for x in lines) == target.count()
    assert target.where(F.unix_millis("datetime") != F.col("timestamp")).count() == 0

    T.fin_payloads(spark, SF).write.parquet(f"{base}/landed")
    names = local_path(base) + "-columns.json"
    with open(names, "w", encoding="utf-8") as f:
        json.dump({"columns": ["mack", "quy", "nam", *T.FIN_RATIOS]}, f)
    args = ["load", "--table", "fin_indicators", "--landed", f"{base}/landed", "--target", f"{base}/fin", "--columns", names]
    assert main(args) == 0
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    stored = KeyedTable(spark, f"{base}/fin", loads.FIN_KEYS).read()
    assert said == {"table": "fin_indicators", "rows_written": stored.count()}
    assert stored.columns == ["mack", "quy", "nam", *T.FIN_RATIOS]


def test_sync_decodes_only_pages_from_the_resume_points_on(spark):
    base = shared_dir(spark, "sync")
    candles, checkpoints = SI.candle_table(spark, f"{base}/c"), SI.checkpoint_table(spark, f"{base}/k")
    meta = spark.createDataFrame([("a", "x"), ("b", "x")], "symbol string, available_exchange string")
    checkpoints.replace(spark.createDataFrame([("A", "x", "3m", 10 * DAY + 180000, "t"), ("B", "x", "3m", 11 * DAY, "t")], SI.CHECKPOINT_SCHEMA))
    page = lambda s, d, *ts: (s, "x", d, json.dumps([[t, 1, 1, 1, 1, 1] for t in ts]))
    pages = spark.createDataFrame([
        ("A", "x", 9, "[[1,2"), page("A", 10, 10 * DAY, 10 * DAY + 180000, 10 * DAY + 360000), page("B", 10, 10 * DAY),
        page("B", 11, 11 * DAY, 11 * DAY + 180000), page("Z", 12, 12 * DAY)], PAGES)
    rejects = SI.reject_table(spark, f"{base}/r")
    jobs.candle_sync_job(spark, meta, pages, candles, checkpoints, 12 * DAY, 1, rejects=rejects)
    assert rows(candles.read().select("symbol", "timestamp"), "symbol") == [("A", 10 * DAY + 360000), ("B", 11 * DAY + 180000)]
    assert rows(checkpoints.read().select("symbol", "last_ts_ms"), "symbol") == [("A", 10 * DAY + 360000), ("B", 11 * DAY + 180000)]
    assert rejects.read().count() == 0          # the bad page lies before A's resume point


def test_unknown_loads_and_unreadable_run_arguments():
    with pytest.raises(ValueError, match="since"):
        RunRange.resolve(interval_ms("1h"), "2024-01-02T00:00:00Z", 7, since="yesterday")
    assert instant("2024-01-02T03:00:00+02:00", "t").hour == 1 and instant("2024-01-02", "t").tzinfo is not None
    with pytest.raises(ValueError):
        jobs.load_job(None, "nope", None, None)


def test_shared_folder_needs_a_setting_off_local_masters(monkeypatch):
    from tickroll import session

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session(), "x")


# ------------------------------------------------- counts and dead letters
def test_a_load_counts_and_keeps_what_gave_no_records(spark):
    landed = spark.createDataFrame([
        ("S1", 1, '{"data":[{"mack":"S1","quy":1,"nam":2020,"a":"1.5"},7]}'), ("S1", 2, "not json {"), ("S1", 3, None),
        ("S1", 4, '[{"mack":"","quy":2,"nam":2020,"a":2}]'), ("S1", 5, "[]"), ("S1", 6, '"text"'), ("S2", 7, "{}"),
        ("S1", 8, '[{"mack":"S1","quy":1,"nam":2020,"a":"3"}]')], "code string, seq long, payload string")
    codes = spark.createDataFrame([("S1",)], "code string")
    t = KeyedTable(spark, shared_dir(spark, "load-run"), loads.FIN_KEYS)
    for _ in range(2):
        run = jobs.load_run(spark, "fin_indicators", landed, t, columns=["a"], codes=codes)
        assert run.counts == {"landed": 7, "records": 3, "unreadable": 2, "message_code": 0, "status": 0, "wrong_shape": 1, "written": 2}
        assert rows(run.dead, "seq") == [("unreadable", "not json {", 2), ("unreadable", None, 3), ("wrong_shape", '"text"', 6)]
    assert rows(t.read().select("mack", "quy", "a"), "quy") == [("S1", 1, 3.0), ("S1", 2, 2.0)]


def test_dead_letters_survive_the_filters_of_a_load(spark):
    landed = spark.createDataFrame([(1, '{"status":{"error_message":"no"},"data":{"quotes":[]}}'), (2, "x"), (3, '{"data":{"quotes":[]}}'),
                                    (4, '{"data":{"quotes":[{"timestamp":"2024-01-02T03:00:00Z"},{"timestamp":"garbage"}]}}')],
                                   "seq long, payload string")
    t = KeyedTable(spark, shared_dir(spark, "load-run"), loads.GLOBAL_METRICS_KEYS)
    run = jobs.load_run(spark, "global_metrics", landed, t, on_error="skip")
    assert run.counts == {"landed": 4, "records": 1, "unreadable": 1, "message_code": 0, "status": 1, "wrong_shape": 0, "written": 1}
    dated = spark.createDataFrame([("P1", 1, '[{"mack":"P1","ngay":"2024-01-05"}]'), ("P1", 2, '[{"mack":"P1","ngay":"2020-01-05"}]'),
                                   ("P1", 3, "{")], "code string, seq long, payload string")
    t = KeyedTable(spark, shared_dir(spark, "load-run"), loads.TABLES["vn_eod"][0])
    run = jobs.load_run(spark, "vn_eod", dated, t, codes=spark.createDataFrame([("P1",)], "code string"), run_date="2024-01-06")
    assert (run.counts["landed"], run.counts["records"], run.counts["unreadable"]) == (3, 1, 1)
