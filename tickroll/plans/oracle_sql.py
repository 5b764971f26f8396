"""Shared DuckDB SQL fragments for the oracles (derived inputs in SQL)."""

from __future__ import annotations

# ticks and 3-minute candles, the SQL twin of tickroll.sources.testdata
TICKS = """
ticks AS (
  SELECT upper(event_type) AS symbol,
         'x' || CAST(user_id % 3 AS VARCHAR) AS exchange,
         epoch_us(ts) AS ts_us, event_id AS tick_id, value AS price, value AS volume
  FROM events)"""

def c3_cte(name: str = "c3", where: str = "TRUE") -> str:
    """CTEs ``{name}_t`` and ``{name}``: 3-minute candles of the filtered ticks."""
    b = "((ts_us // 1000) - ((ts_us // 1000) % 180000))"
    return f"""
{name}_t AS (
  SELECT *, {b} AS bucket_ts,
         row_number() OVER (PARTITION BY symbol, exchange, {b} ORDER BY ts_us, tick_id) AS rn_asc,
         row_number() OVER (PARTITION BY symbol, exchange, {b} ORDER BY ts_us DESC, tick_id DESC) AS rn_desc
  FROM ticks WHERE {where}),
{name} AS (
  SELECT symbol, exchange, bucket_ts AS timestamp,
         max(price) FILTER (WHERE rn_asc = 1) AS open, max(price) AS high, min(price) AS low,
         max(price) FILTER (WHERE rn_desc = 1) AS close,
         CAST(sum(CAST(volume AS DECIMAL(38,12))) AS DOUBLE) AS volume
  FROM {name}_t GROUP BY symbol, exchange, bucket_ts)"""


C3 = TICKS + "," + c3_cte()


def rollup_cte(name: str, source: str, bucket_ms: int, where: str = "TRUE") -> str:
    """CTE ``name``: the original windowed rollup of ``source`` to ``bucket_ms``."""
    b = int(bucket_ms)
    return f""",
{name}_r AS (
  SELECT *, timestamp - (timestamp % {b}) AS bucket_ts,
         row_number() OVER (PARTITION BY symbol, exchange, timestamp - (timestamp % {b}) ORDER BY timestamp) AS rn_asc,
         row_number() OVER (PARTITION BY symbol, exchange, timestamp - (timestamp % {b}) ORDER BY timestamp DESC) AS rn_desc
  FROM {source} WHERE {where}),
{name} AS (
  SELECT symbol, exchange, bucket_ts AS timestamp,
         max(open) FILTER (WHERE rn_asc = 1) AS open, max(high) AS high, min(low) AS low,
         max(close) FILTER (WHERE rn_desc = 1) AS close,
         CAST(sum(CAST(volume AS DECIMAL(38,12))) AS DOUBLE) AS volume
  FROM {name}_r GROUP BY symbol, exchange, bucket_ts)"""


def with_(*ctes: str) -> str:
    return "WITH " + "".join(ctes)


CANDLE_COLS = "symbol, exchange, timestamp, open, high, low, close, volume"
STORED_COLS = CANDLE_COLS + ", strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d %H:%M:%S') AS datetime"
