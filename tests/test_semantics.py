"""Hand-made edge cases (D1-D20 of the survey) and properties."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tickroll.functions import jsonfn as J
from tickroll.functions.textfn import safe_float_text, split_list
from tickroll.functions.timefn import RunRange, interval_ms, normalize_ts_day
from tickroll.operators import candles as C
from tickroll.operators import incremental as I
from tickroll.operators import merge as M
from tickroll.operators import payload as P
from tickroll.operators.mapping import ColumnSpec, map_columns, record_struct_type
from tickroll.sources.landed import parse_payloads

CANDLE_SCHEMA = ("symbol string, exchange string, timestamp long, open double, high double, "
                 "low double, close double, volume double")


def ms(s: str) -> int:
    return int(datetime.fromisoformat(s).replace(tzinfo=timezone.utc).timestamp() * 1000)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# D1 ---------------------------------------------------------------- buckets
def test_7d_buckets_start_thursday(spark):
    wed = ms("2024-01-03 23:59:59.999")     # a Wednesday
    thu = ms("2024-01-04 00:00:00")
    df = spark.createDataFrame([("A", "x", wed, 1.0, 1.0, 1.0, 1.0, 1.0),
                                ("A", "x", thu, 2.0, 2.0, 2.0, 2.0, 2.0)], CANDLE_SCHEMA)
    out = rows(C.rollup(df, interval_ms("7d")), "timestamp")
    assert len(out) == 2
    starts = [datetime.fromtimestamp(r[2] / 1000, tz=timezone.utc) for r in out]
    assert all(s.weekday() == 3 and s.hour == 0 for s in starts)   # Thursday 00:00


# D2 ------------------------------------------------------------- run range
def test_run_range_floors_and_half_open(spark):
    b = interval_ms("1h")
    rr = RunRange.resolve(b, "2024-01-02T00:00:00Z", 7, since="2024-01-01T10:30:00Z",
                          until="2024-01-01T10:45:00Z")
    assert (rr.start_ms, rr.end_ms) == (ms("2024-01-01 10:00:00"), ms("2024-01-01 11:00:00"))
    rr = RunRange.resolve(b, "2024-01-02T00:00:00Z", 7, since="2024-01-01T10:00:00Z",
                          until="2024-01-01T12:30:00Z")
    df = spark.createDataFrame([("A", "x", rr.start_ms, 1.0, 1.0, 1.0, 1.0, 1.0),
                                ("A", "x", rr.end_ms, 2.0, 2.0, 2.0, 2.0, 2.0),
                                ("A", "x", rr.end_ms - 1, 3.0, 3.0, 3.0, 3.0, 3.0)], CANDLE_SCHEMA)
    out = rows(C.rollup(df, b, rr), "timestamp")
    assert [r[2] for r in out] == [ms("2024-01-01 10:00:00"), ms("2024-01-01 11:00:00")]
    with pytest.raises(ValueError):
        RunRange.resolve(b, "2024-01-02T00:00:00Z", 7, since="garbage")
    with pytest.raises(ValueError):
        RunRange.resolve(b, "2024-01-02T00:00:00Z", 7, since="2024-01-02T00:00:00Z",
                         until="2024-01-01T00:00:00Z")


# D3 ------------------------------------------------------ NULL open / close
def test_open_close_keep_nulls(spark):
    t0 = ms("2024-01-01 00:00:00")
    df = spark.createDataFrame([("A", "x", t0, None, 5.0, 1.0, 2.0, None),
                                ("A", "x", t0 + 180000, 3.0, 6.0, 0.5, None, None)], CANDLE_SCHEMA)
    (r,) = rows(C.rollup(df, interval_ms("1h")))
    assert r[3] is None and r[6] is None and r[7] is None
    assert (r[4], r[5]) == (6.0, 0.5)
    assert rows(C.rollup_by_rank(df, interval_ms("1h"))) == [r]


# D4 --------------------------------------------------------- tick ties
def test_tick_ties_broken_by_id(spark):
    t = 1704067200000000
    ticks = spark.createDataFrame([("A", "x", t, 2, 10.0, 1.0), ("A", "x", t, 1, 20.0, 1.0),
                                   ("A", "x", t + 5, 3, 15.0, 1.0), ("A", "x", t + 5, 4, 16.0, 1.0)],
                                  "symbol string, exchange string, ts_us long, tick_id long, price double, volume double")
    (r,) = rows(C.ticks_to_candles(ticks, interval_ms("3m")))
    assert (r[3], r[6]) == (20.0, 16.0)       # open: (t, id 1); close: (t+5, id 4)
    assert r[7] == 4.0


# D5 ------------------------------------------------- whole 7d candles
def test_7d_slices_never_cut_candles(spark):
    rr = RunRange.resolve(interval_ms("7d"), "2024-12-31T00:00:00Z", 365)
    sl = rr.slices(90, interval_ms("7d"))
    assert all((e - s) % interval_ms("7d") == 0 for s, e in sl[:-1])
    assert sl[0][0] == rr.start_ms and sl[-1][1] == rr.end_ms


# D6 / D7 --------------------------------------------------- resume point
def test_since_and_checkpoint(spark):
    pairs = spark.createDataFrame([("BTC", "a"), ("ETH", "a"), ("SOL", "a")], "symbol string, exchange string")
    ck = spark.createDataFrame([("BTC", "a", "3m", 1000, "t0"), ("ETH", "a", "1h", 5, "t0")],
                               "symbol string, exchange string, timeframe string, last_ts_ms long, updated_at string")
    s = dict((r[0], r[2]) for r in I.since_per_pair(pairs, ck, "3m", now_ms=10 * 86_400_000, since_days=1).collect())
    assert s == {"BTC": 1001, "ETH": 9 * 86_400_000, "SOL": 9 * 86_400_000}
    s = dict((r[0], r[2]) for r in I.since_per_pair(pairs, ck, "3m", refetch_last=True).collect())
    assert s == {"BTC": 1000, "ETH": None, "SOL": None}
    new = spark.createDataFrame([("BTC", "a", 900), ("BTC", "a", 800), ("SOL", "a", 50), ("SOL", "a", 70)],
                                "symbol string, exchange string, timestamp long")
    out = {(r[0], r[2]): (r[3], r[4]) for r in I.checkpoint_next(ck, new, "3m", "t1").collect()}
    assert out[("BTC", "3m")] == (1000, "t1")      # never goes back
    assert out[("SOL", "3m")] == (70, "t1")        # max, not the last row
    assert out[("ETH", "1h")] == (5, "t0")         # other timeframe untouched


# D8 --------------------------------------------------------- dedupe
def test_dedupe_policies(spark):
    b = spark.createDataFrame([(1, "k", "a"), (2, "k", "b"), (3, "k", "c"), (4, "j", "d")],
                              "_seq long, key string, v string")
    assert rows(M.dedupe(b, ["key"], "_seq", "last"), "key") == [(4, "j", "d"), (3, "k", "c")]
    assert rows(M.dedupe(b, ["key"], "_seq", "first"), "key") == [(4, "j", "d"), (1, "k", "a")]
    with pytest.raises(M.DuplicateKeyError):
        M.dedupe(b, ["key"], "_seq", "error")


# D9 / D10 / D17 ----------------------------------------------- upserts
def test_upsert_null_overwrite_unmapped_and_null_keys(spark):
    target = spark.createDataFrame([("a", 1.0, "keep"), ("b", 2.0, "keep"), (None, 3.0, "nk")],
                                   "k string, v double, note string")
    batch = spark.createDataFrame([(1, "a", None), (2, "c", 5.0), (3, None, 6.0), (4, None, 7.0)],
                                  "_seq long, k string, v double")
    out = rows(M.upsert_update(target, batch, ["k"]), "k", "v")
    assert out == [(None, 3.0, "nk"), (None, 6.0, None), (None, 7.0, None),
                   ("a", None, "keep"), ("b", 2.0, "keep"), ("c", 5.0, None)]
    out = rows(M.upsert_nothing(target, batch, ["k"]), "k", "v")
    assert out == [(None, 3.0, "nk"), (None, 6.0, None), (None, 7.0, None),
                   ("a", 1.0, "keep"), ("b", 2.0, "keep"), ("c", 5.0, None)]


def test_merge_counts_two_updates_three_inserts(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    batch = spark.createDataFrame([(1, "a", 9.0), (2, "b", 9.0), (3, "c", 1.0), (4, "d", 1.0), (5, "e", 1.0)],
                                  "_seq long, k string, v double")
    assert tuple(M.merge_counts(target, batch, ["k"]).first()) == (3, 2, 5)


def test_upsert_idempotent_and_nothing_keeps_target(spark):
    target = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double")
    batch = spark.createDataFrame([(1, "a", 9.0), (2, "c", 3.0)], "_seq long, k string, v double")
    once = M.upsert_update(target, batch, ["k"])
    twice = M.upsert_update(once, batch, ["k"])
    assert rows(once, "k") == rows(twice, "k")
    kept = M.upsert_nothing(target, batch, ["k"])
    assert set(rows(target)) <= set(rows(kept))


# D11 / D18 ------------------------------------------------- empty input
def test_empty_batches(spark):
    target = spark.createDataFrame([("a", 1.0)], "k string, v double")
    empty = spark.createDataFrame([], "_seq long, k string, v double")
    assert rows(M.upsert_update(target, empty, ["k"])) == [("a", 1.0)]
    assert rows(M.upsert_nothing(target, empty, ["k"])) == [("a", 1.0)]
    assert M.truncate_load(empty, ["k"]).count() == 0
    assert M.check_empty(empty, "skip") is True
    with pytest.raises(M.EmptyInputError):
        M.check_empty(empty, "error")


# D12 / D13 ------------------------------------------------ day normalisation
def test_normalize_ts_day(spark):
    vals = ["2024-01-02T23:30:00.000Z", "2024-01-02T23:30:00-05:00", "2024-01-02T23:30:00",
            "garbage", "", None, "1970-01-01T10:00:00Z", "2024"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(normalize_ts_day("t")).collect()]
    assert got == [ms("2024-01-02 00:00:00"), ms("2024-01-03 00:00:00"), ms("2024-01-02 00:00:00"),
                   None, None, None, 0, None]


# D14 -------------------------------------------------------- safe float
def test_safe_float(spark):
    vals = ["1.5", " 2 ", "abc", "", None, "nan", "inf", "1.5d", "1_000", "-1e3", ".5", "+Infinity"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(safe_float_text("t")).collect()]
    assert got[:5] == [1.5, 2.0, None, None, None]
    assert got[5] != got[5]          # NaN
    assert got[6] == float("inf") and got[7] is None and got[8] is None
    assert got[9:] == [-1000.0, 0.5, float("inf")]
    docs = spark.createDataFrame([('{"a": true}',), ('{"a": "3"}',), ('{"a": 4}',), ('{"a": {"b": 1}}',)], "p string")
    got = [r[0] for r in docs.select(J.safe_float(J.get(J.parse("p"), "a"))).collect()]
    assert got == [1.0, 3.0, 4.0, None]


# D15 / D20 ----------------------------------------------------- pairs
def test_explode_pairs(spark):
    meta = spark.createDataFrame([("btc", " a,\tb , ,a"), ("Btc", "b"), (None, "a"), ("eth", ""), ("sol", None)],
                                 "symbol string, available_exchange string")
    assert rows(I.explode_pairs(meta), "symbol", "exchange") == [("BTC", "a"), ("BTC", "b")]
    assert tuple(I.pair_rejects(meta).first()) == (1, 2)
    df = spark.createDataFrame([(" x ,\ty\n",)], "s string")
    assert df.select(split_list("s")).first()[0] == ["x", "y"]


# D16 -------------------------------------------------------- exact sums
def test_volume_sum_is_order_free(spark):
    data = [("A", "x", ms("2024-01-01 00:00:00") + i * 180000, 1.0, 1.0, 1.0, 1.0, 0.1) for i in range(10)]
    a = spark.createDataFrame(data, CANDLE_SCHEMA).repartition(3)
    b = spark.createDataFrame(list(reversed(data)), CANDLE_SCHEMA).repartition(5)
    va = C.rollup(a, interval_ms("1h")).first()["volume"]
    vb = C.rollup(b, interval_ms("1h")).first()["volume"]
    assert va == vb == 1.0


# D19 + unwrap modes ------------------------------------------------------
PAYLOADS = [
    (1, '{"data":[{"a":1},2,"x",{"a":3},{}]}'),
    (2, '[{"a":5}]'),
    (3, '{"a":7}'),
    (4, 'nope'),
    (5, '{"data":null}'),
    (6, '{"data":{"a":9}}'),
    (7, '{"message":"m","code":4}'),
    (8, None),
    (9, '[]'),
    (10, '{}'),
    (11, '{"data":[]}'),
    (12, '[1,"x",{"a":12}]'),
]


def _unwrapped(spark, mode, **kw):
    docs = parse_payloads(spark.createDataFrame(PAYLOADS, "seq long, payload string"))
    out = P.unwrap(docs, mode, keep=["seq"], **kw)
    return sorted((r[0], r[1], r[2]) for r in out.select("seq", "_pos", J.get("rec", "a", "long")).collect())


def test_unwrap_modes(spark):
    assert _unwrapped(spark, "records") == [(1, 0, 1), (1, 3, 3), (1, 4, None), (2, 0, 5), (3, 0, 7),
                                            (6, 0, 9), (7, 0, None), (12, 2, 12)]
    # arrays only: an object without "data" (D19) and error objects give nothing
    assert _unwrapped(spark, "array") == [(1, 0, 1), (1, 3, 3), (1, 4, None), (2, 0, 5), (12, 2, 12)]
    # message and code beside data are no error unless the load says so
    named = parse_payloads(spark.createDataFrame(
        [(1, '{"code":200,"message":"success","data":[{"a":1}]}')], "seq long, payload string"))
    assert P.unwrap(named, "array", keep=["seq"]).count() == 1
    assert P.unwrap(named, "array", keep=["seq"], skip_errors="message_code").count() == 0
    assert P.object_counts(named, keep=["seq"]).first()["objects"] == 1
    assert _unwrapped(spark, "first") == [(1, 0, 1), (2, 0, 5), (3, 0, 7), (6, 0, 9), (7, 0, None)]
    assert _unwrapped(spark, "list") == [(1, 0, 1), (1, 3, 3), (1, 4, None)]
    assert _unwrapped(spark, "records", skip_errors="message_code")[-2:] == [(6, 0, 9), (12, 2, 12)]


def test_split_errors(spark):
    docs = parse_payloads(spark.createDataFrame(
        [(1, '{"message":"m","code":4}'), (2, '{"message":"m","code":0}'),
         (3, '{"status":{"error_message":"bad"}}'), (4, '{"status":{"error_message":null}}')],
        "seq long, payload string"))
    data, errors = P.split_errors(docs)
    assert sorted(r[0] for r in data.select("seq").collect()) == [2, 4]
    assert rows(errors.select("seq", "error_kind", "message"), "seq") == [
        (1, "message_code", "m"), (3, "status", "bad")]


# P1 / P2 / P3 / P10 -------------------------------------------- mapping
def test_mapping_paths_types_and_json(spark):
    docs = spark.createDataFrame([('{"k":"A","n":"2","q":{"U":{"p":1.5}},"j":{"z":1,"a":2},"s":"t"}',),
                                  ('{"k":"B","q":{"U":null},"j":"txt"}',), ('{"k":"C","q":5,"j":null}',)],
                                 "p string").select(J.parse("p").alias("rec"))
    specs = [ColumnSpec("k", "key"), ColumnSpec("n", "num", "double", value_type="float"),
             ColumnSpec("p", "price", "double", source_path=("q", "U", "p")),
             ColumnSpec("j", "js", "json"), ColumnSpec("missing", "m", "long")]
    assert rows(map_columns(docs, specs), "key") == [
        ("A", 2.0, 1.5, '{"a":2,"z":1}', None), ("B", None, None, "txt", None), ("C", None, None, None, None)]
    wide = [ColumnSpec(f"c{i:03d}", f"c{i:03d}", "double") for i in range(219)]
    assert record_struct_type(wide).count(":") == 219


# properties ------------------------------------------------------------
def test_cascade_equals_direct(spark):
    from tickroll.sources import testdata as T
    from tests.conftest import SF
    c3 = T.candles_3m(spark, SF).cache()
    steps = C.cascade(c3)
    for name in ("1h", "1d", "7d"):
        direct = C.rollup_interval(c3, name)
        assert steps[name].exceptAll(direct).count() == 0 and direct.exceptAll(steps[name]).count() == 0
    bad = steps["1h"].where((F.col("low") > F.col("open")) | (F.col("high") < F.col("close"))
                            | (F.col("low") > F.col("high")))
    assert bad.count() == 0


# plan checks ----------------------------------------------------------
def test_rollup_plan_one_exchange_hash_aggregate_pushed_filter(spark, tmp_path):
    from tickroll.sources import testdata as T
    from tests.conftest import SF
    path = str(tmp_path / "c3")
    T.candles_3m(spark, SF).write.parquet(path)
    rr = RunRange(ms("2024-01-05 00:00:00"), ms("2024-01-12 00:00:00"))
    q = C.rollup(spark.read.parquet(path), interval_ms("1h"), rr)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan
    assert "GreaterThanOrEqual(timestamp," in plan and "LessThan(timestamp," in plan


def test_run_range_from_conf():
    b = interval_ms("1h")
    rr = RunRange.from_conf(b, "2024-01-10T00:00:00Z", 7, {"since": "2024-01-01T00:00:00Z",
                                                           "end": "2024-01-02T00:00:00Z"})
    assert (rr.start_ms, rr.end_ms) == (ms("2024-01-01 00:00:00"), ms("2024-01-02 00:00:00"))
    rr = RunRange.from_conf(b, "2024-01-10T00:00:00Z", 7, {})
    assert (rr.start_ms, rr.end_ms) == (ms("2024-01-03 00:00:00"), ms("2024-01-10 00:00:00"))


def test_run_time_guards(spark):
    from tickroll.plans import loads as LD
    meta = spark.createDataFrame([(None, "a"), ("x", "")], "symbol string, available_exchange string")
    with pytest.raises(M.EmptyInputError):
        I.explode_pairs(meta, on_empty="error")
    bad = spark.createDataFrame([("k", 1, "not json")], "request_key string, seq long, payload string")
    with pytest.raises(RuntimeError):
        LD.global_metrics_records(bad)
    err = spark.createDataFrame([("k", 1, '{"status":{"error_message":"quota"}}')],
                                "request_key string, seq long, payload string")
    with pytest.raises(RuntimeError):
        LD.global_metrics_records(err)
    assert LD.global_metrics_records(err, on_error="skip").count() == 0
    with pytest.raises(M.EmptyInputError):
        LD.load_stock_list(spark.createDataFrame([("HOSE", 1, "[]")], "listing string, seq long, payload string"))


def test_hot_key_reduced_before_shuffle(spark):
    """A key holding a third of the batch is combined map-side (partial aggregate
    below the exchange), for both de-duplication and the rollup."""
    n = 3000
    batch = spark.range(n).select((F.col("id") + 1).alias("_seq"),
                                  F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").cast("double").alias("v"))
    d = M.dedupe(batch, ["k"], "_seq", "last")
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange hashpartitioning")   # partial is below
    assert d.where(F.col("k") == "HOT").first()["v"] == float(n - 3)
    candles = spark.range(n).select(F.lit("HOT").alias("symbol"), F.lit("x").alias("exchange"),
                                    (F.col("id") * 180000).alias("timestamp"), *[F.lit(1.0).alias(c) for c in
                                    ("open", "high", "low", "close", "volume")])
    r = C.rollup(candles, interval_ms("1d"))
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange hashpartitioning")
    assert r.count() == -(-n * 180000 // 86_400_000)


def test_json_lines_landing_batch_and_stream(spark):
    from tickroll.session import shared_dir
    from tickroll.sources.landed import candle_pages, read_landed
    from tickroll.streaming import ingest as SI
    base = shared_dir(spark, "jsonl")
    landed = spark.createDataFrame([("k1", 1, '{"data":[{"a":1},{"a":2}]}'), ("k2", 2, "oops")],
                                   "request_key string, seq long, payload string")
    landed.write.json(f"{base}/payloads")
    docs = parse_payloads(read_landed(spark, f"{base}/payloads", "json"))
    got = sorted(r[0] for r in P.unwrap(docs, "records", keep=["seq"]).select(J.get("rec", "a", "long")).collect())
    assert got == [1, 2]
    t0 = ms("2024-01-01 00:00:00")
    pages = spark.createDataFrame([("BTC", "x", 0, f"[[{t0},1,2,0.5,1.5,10],[{t0 + 180000},1.5,3,1,2,5]]")],
                                  "symbol string, exchange string, page_seq long, payload string")
    pages.write.json(f"{base}/landing")
    candles, ckpts = SI.candle_table(spark, f"{base}/candles"), SI.checkpoint_table(spark, f"{base}/ckpt")
    SI.run_ingest(spark, f"{base}/landing", candles, ckpts, f"{base}/_stream", updated_at="t", fmt="json")
    assert rows(candles.read().select(*C.CANDLE_COLUMNS), "timestamp") == rows(
        candle_pages(pages).select(*C.CANDLE_COLUMNS), "timestamp")
    assert rows(ckpts.read().select("symbol", "last_ts_ms")) == [("BTC", t0 + 180000)]


def test_cascade_plan_stays_linear(spark):
    """No filter of a later level is pushed below earlier aggregates, where
    nested bucket expressions would grow exponentially with the depth."""
    from tickroll.sources import testdata as T
    from tests.conftest import SF
    lengths = []
    for depth in (2, 4, 6):
        levels = ("15m", "1h", "4h", "8h", "1d", "7d")[:depth]
        df = C.cascade(T.candles_3m(spark, SF), levels)[levels[-1]]
        lengths.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
    # each level adds a bounded amount of plan text
    assert lengths[2] - lengths[1] < 2 * (lengths[1] - lengths[0]) + 2000
