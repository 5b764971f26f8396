"""Streams beside their batch forms: late rows, all intervals at once, loads, and merges of bucketed tables."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.test_semantics import CANDLE_SCHEMA, rows
from tickroll.functions.timefn import LOOKBACK_DAYS, interval_ms
from tickroll.operators import candles as C
from tickroll.operators import merge as M
from tickroll.plans import loads as LD
from tickroll.session import shared_dir, stage
from tickroll.sources import bucketed as B
from tickroll.sources.keyed_table import KeyedTable
from tickroll.streaming import late as SL
from tickroll.streaming import loads as SD
from tickroll.streaming import rollup as SR

DAY = 86_400_000
KV = "k string, j int, v double, w double"


# --------------------------------------------------------- bucketed tables
def bucketed(spark, data, schema=KV, keys=("k", "j"), buckets=4):
    name = f"t_{uuid.uuid4().hex[:10]}"
    B.write_bucketed(spark.createDataFrame(data, schema), name, keys, buckets, shared_dir(spark, "bucketed-test"))
    return name


@pytest.mark.parametrize("policy", ["update", "nothing"])
def test_a_bucketed_target_is_not_exchanged(spark, policy):
    name = bucketed(spark, [(f"k{i}", i % 3, 1.0, None) for i in range(200)])
    batch = spark.createDataFrame([("k1", 1, 5.0, 1), ("k1", 1, 6.0, 2), ("new", 0, 7.0, 3)], "k string, j int, v double, _seq int")
    plan = B.merge_plan(spark, name, batch, ["k", "j"], policy)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x)
    depth = lambda x: next((i for i, c in enumerate(x) if c.isalpha()), 0)
    sides = [i for i in range(join + 1, len(lines)) if depth(lines[i]) == depth(lines[join + 1])]
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x)
    target = lines[join + 1:next((i for i in sides if i > scan), len(lines))]
    assert any("Bucketed: true" in x for x in target) and not any("Exchange" in x for x in target), plan
    # the batch is exchanged for its duplicates and, at most, into the buckets
    assert 1 <= sum("Exchange" in x for x in lines) <= 2


@pytest.mark.parametrize("policy", ["update", "nothing"])
def test_bucketed_merges_equal_plain_ones(spark, policy):
    data = [(f"k{i}", i % 3, float(i), 0.5) for i in range(50)] + [(None, 1, 8.0, 8.0), ("x", None, 9.0, 9.0)]
    batch = spark.createDataFrame(
        [("k1", 1, None, 1), ("k2", 2, 6.0, 2), ("k2", 2, 7.0, 3), ("new", 0, 7.0, 4), (None, 1, 1.0, 5), (None, 1, 2.0, 6), ("x", None, 3.0, 7)],
        "k string, j int, v double, _seq int")
    target = spark.createDataFrame(data, KV)
    keep = "last" if policy == "update" else "first"
    want = M.upsert(target, batch, ["k", "j"], policy, keep=keep)
    name = bucketed(spark, data)
    got = B.merge_bucketed(spark, name, batch, ["k", "j"], 4, f"{name}_2", shared_dir(spark, "bucketed-test"), policy)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # merged again, and with an empty batch
    again = B.merge_bucketed(spark, f"{name}_2", batch.limit(0), ["k", "j"], 4, f"{name}_3", shared_dir(spark, "bucketed-test"), policy)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # one file a bucket at most, so the next merge finds its buckets whole
    assert again.select(F.input_file_name()).distinct().count() <= 4


# ------------------------------------------------------------ six intervals
def land(spark, folder, data):
    spark.createDataFrame(data, CANDLE_SCHEMA).write.mode("append").parquet(folder)


def candle(at, v=1.0, symbol="s"):
    return (symbol, "x", at, v, v + 1, v - 1, v, 0.5)


def test_all_intervals_from_one_stream(spark):
    base = shared_dir(spark, "all-test")
    tables = {i: KeyedTable(spark, f"{base}/{i}", C.CANDLE_KEYS, "timestamp") for i in LOOKBACK_DAYS}
    first = [candle(DAY * 20 + m * 180_000, float(m)) for m in range(0, 40)] + [candle(DAY * 20, 7.0, None), (None, None, None, 1.0, 1.0, 1.0, 1.0, 1.0)]
    second = [candle(DAY * 20 + m * 180_000, m + 0.25) for m in range(40, 60)] + [candle(DAY * 21), candle(-180_000, 3.0, "t")]
    for data in (first, second):
        land(spark, f"{base}/source", data)
        SR.run_rollups(spark, f"{base}/source", tables, f"{base}/_s")
    everything = spark.createDataFrame(first + second[:-1], CANDLE_SCHEMA)
    for name, table in tables.items():
        want = C.stored(C.rollup(everything.where("timestamp is not null"), interval_ms(name)))
        got = table.read().drop("day")
        late = got.where("symbol = 't'")
        # 21 days back is beyond the look-back of the short intervals, within that of the long ones
        assert late.count() == (1 if LOOKBACK_DAYS[name] >= 30 else 0), name
        assert sorted(map(str, got.where("symbol is null or symbol <> 't'").collect())) == sorted(map(str, want.collect())), name


# ------------------------------------------------------------------- late
def late_tables(spark):
    base = shared_dir(spark, "late-test")
    return base, SL.late_table(spark, f"{base}/late"), SL.mark_table(spark, f"{base}/marks"), KeyedTable(
        spark, f"{base}/15m", C.CANDLE_KEYS, "timestamp")


def test_late_candles_are_kept_and_backfilled(spark):
    base, late, marks, target = late_tables(spark)
    runs = [[candle(DAY * 100), candle(DAY * 100 + 180_000, 2.0), candle(DAY * 110)],
            [candle(DAY * 100 + 360_000, 9.0), candle(DAY * 100 + 360_000, 9.0), candle(DAY * 109), (None, None, None, 1.0, 1.0, 1.0, 1.0, 1.0)]]
    for data in runs:
        land(spark, f"{base}/source", data)
        SR.run_rollup(spark, f"{base}/source", "15m", target, f"{base}/_s")
        SL.run_late(spark, f"{base}/source", "15m", late, marks, f"{base}/_l")
    everything = spark.read.schema(SR.CANDLE_SCHEMA).parquet(f"{base}/source").where("timestamp is not null")
    want = sorted(map(str, C.stored(C.rollup(everything.distinct(), interval_ms("15m"))).collect()))
    assert [tuple(r) for r in SL.late_counts(late).collect()] == [("s", "x", 1)]
    assert rows(late.read(), "timestamp") == [("s", "x", DAY * 100 + 360_000, 100)]
    assert {r["volume"] for r in target.read().where(F.col("timestamp") == DAY * 100).collect()} == {1.0}
    SL.backfill_late(everything.distinct(), late, target, "15m")
    assert sorted(map(str, target.read().drop("day").collect())) == want
    assert SL.late_counts(late).count() == 0 and SL.backfill_late(everything, late, target, "15m") is None
    assert [tuple(r) for r in marks.read().collect()] == [("15m", DAY * 110)]


def test_the_edge_of_the_watermark_and_replays(spark):
    _, late, marks, _ = late_tables(spark)
    frame = lambda *ts: spark.createDataFrame([("s", "x", t) for t in ts], SL.KEY_SCHEMA)
    run = lambda df, batch: SL.late_batch(df, "15m", late, marks, DAY, ("w", batch))
    run(frame(), 0)                                # nothing seen: no mark, nothing late
    assert marks.read().count() == 0
    run(frame(DAY * 10, 5), 1)                     # one batch is not late against itself
    assert SL.late_counts(late).count() == 0
    open_, closed = DAY * 9 - 900_000 + 1, DAY * 9 - 900_000
    run(frame(DAY * 9, closed, open_), 2)          # buckets that end by the watermark are closed
    assert {r["timestamp"] for r in late.read().collect()} == {closed, open_}
    for _ in range(2):
        run(frame(5), 3)
    assert late.read().count() == 3 and marks.read().first()["high_ts_ms"] == DAY * 10


def test_a_backfill_reads_the_span_of_its_buckets(spark):
    source = KeyedTable(spark, shared_dir(spark, "late-source"), C.CANDLE_KEYS, "timestamp")
    source.merge(C.stored(spark.createDataFrame([candle(DAY * d) for d in range(50, 60)], CANDLE_SCHEMA)), unique=True)
    buckets = stage(spark.createDataFrame([("s", "x", DAY * 53), ("s", "x", DAY * 54)], "symbol string, exchange string, bucket long"), "b")
    plan = SL.buckets_again(source.read(), buckets, "15m")
    assert [r["timestamp"] for r in plan.orderBy("timestamp").collect()] == [DAY * 53, DAY * 54]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "day" in text.split("PartitionFilters:")[1].split("]")[0] and f"GreaterThanOrEqual(timestamp,{DAY * 53})" in text


# ------------------------------------------------------------------ loads
def test_a_streamed_load_joins_the_company_table_of_the_day(spark):
    base = shared_dir(spark, "load-test")
    table, dead = LD.stored_table(spark, "global_eod", f"{base}/t"), SD.dead_letter_table(spark, f"{base}/dead")
    known = [(1, "A", True)]
    price = lambda d, v: f'[{{"date":"2024-01-{d:02d}","open":{v}}}]'
    schema = "ticker string, seq long, payload string"

    def run(*payloads):
        spark.createDataFrame(list(payloads), schema).write.mode("append").parquet(f"{base}/landing")
        return SD.run_load(spark, "global_eod", f"{base}/landing", schema, table, f"{base}/_s", dead=dead,
                           companies=lambda: spark.createDataFrame(known, "id long, ticker string, is_active boolean"))

    runs = run(("A", 1, price(1, 1.0)), ("B", 2, price(1, 2.0)), ("A", 3, "no json"))
    assert [(r.counts["landed"], r.counts["records"], r.counts["unreadable"], r.counts["written"]) for r in runs] == [(2, 1, 1, 1)]
    known.append((2, "B", True))                   # listed between two batches
    run(("B", 4, price(2, 3.0)), ("A", 5, price(1, 9.0)), ("A", 3, "no json"))
    got = sorted((r["company_id"], r["date"].day, r["open"]) for r in table.read().collect())
    assert got == [(1, 1, 1.0), (2, 2, 3.0)]       # inserts keep what is stored
    assert [(r["seq"], r["_kind"]) for r in dead.read().collect()] == [(3, "unreadable")]
    assert run() == [] or table.read().count() == 2
