"""Registered keyed-merge queries over the orders-derived target and batch."""

from __future__ import annotations

import uuid

from tickroll.operators import merge as M
from tickroll.plans.registry import query
from tickroll.session import shared_dir
from tickroll.sources import bucketed as B
from tickroll.sources import testdata as T

KEYS = ["o_orderkey"]

TARGET_SQL = """
t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
             strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
      FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"""

BATCH_SQL = """
b AS (SELECT o_orderkey * 2 AS _seq, o_orderkey,
             CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
      UNION ALL
      SELECT o_orderkey * 2 + 1, o_orderkey, 'Z', o_totalprice + 2
      FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')"""


def _pick(direction: str) -> str:
    return f"""
bk AS (SELECT _seq, o_orderkey, o_orderstatus, o_totalprice FROM (
         SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY _seq {direction}) AS rn FROM b)
       WHERE rn = 1)"""


@query("dedupe_last", "WITH" + BATCH_SQL + "," + _pick("DESC") + "\nSELECT * FROM bk")
def q_dedupe_last(spark, sf_dir):
    return M.dedupe(T.orders_batch(spark, sf_dir), KEYS, "_seq", "last")


@query("dedupe_first", "WITH" + BATCH_SQL + "," + _pick("ASC") + "\nSELECT * FROM bk")
def q_dedupe_first(spark, sf_dir):
    return M.dedupe(T.orders_batch(spark, sf_dir), KEYS, "_seq", "first")


UPDATE_SQL = "WITH" + TARGET_SQL + "," + BATCH_SQL + "," + _pick("DESC") + """
SELECT t.* FROM t ANTI JOIN bk USING (o_orderkey)
UNION ALL
SELECT bk.o_orderkey, t.o_custkey, bk.o_orderstatus, bk.o_totalprice, t.o_orderdate, t.o_orderpriority
FROM bk LEFT JOIN t USING (o_orderkey)"""

NOTHING_SQL = "WITH" + TARGET_SQL + "," + BATCH_SQL + "," + _pick("ASC") + """
SELECT * FROM t
UNION ALL
SELECT bk.o_orderkey, NULL, bk.o_orderstatus, bk.o_totalprice, NULL, NULL
FROM bk ANTI JOIN t USING (o_orderkey)"""


@query("upsert_update", UPDATE_SQL)
def q_upsert_update(spark, sf_dir):
    return M.upsert_update(T.orders_target(spark, sf_dir), T.orders_batch(spark, sf_dir), KEYS,
                           order="_seq", keep="last", mapped=T.ORDER_MAPPED)


@query("upsert_nothing", NOTHING_SQL)
def q_upsert_nothing(spark, sf_dir):
    return M.upsert_nothing(T.orders_target(spark, sf_dir), T.orders_batch(spark, sf_dir), KEYS,
                            order="_seq", keep="first", mapped=T.ORDER_MAPPED)


BUCKETS = 8


def _bucketed(spark, sf_dir, policy):
    name, base = f"orders_{uuid.uuid4().hex[:12]}", shared_dir(spark, "bucketed")
    B.write_bucketed(T.orders_target(spark, sf_dir), name, KEYS, BUCKETS, f"{base}/v1")
    return B.merge_bucketed(spark, name, T.orders_batch(spark, sf_dir), KEYS, BUCKETS, f"{name}_v2", f"{base}/v2",
                            policy, mapped=T.ORDER_MAPPED)


@query("upsert_bucketed", UPDATE_SQL)
def q_upsert_bucketed(spark, sf_dir):
    """The update of a bucketed table, whose rows stay in their buckets."""
    return _bucketed(spark, sf_dir, "update")


@query("insert_bucketed", NOTHING_SQL)
def q_insert_bucketed(spark, sf_dir):
    """The insert of absent keys into a bucketed table."""
    return _bucketed(spark, sf_dir, "nothing")


@query("merge_counts", "WITH" + TARGET_SQL + "," + BATCH_SQL + "," + _pick("DESC") + """
SELECT CAST(count(*) FILTER (WHERE t.o_orderkey IS NULL) AS BIGINT) AS inserted,
       CAST(count(t.o_orderkey) AS BIGINT) AS updated,
       CAST(count(*) AS BIGINT) AS total
FROM bk LEFT JOIN t USING (o_orderkey)""")
def q_merge_counts(spark, sf_dir):
    return M.merge_counts(T.orders_target(spark, sf_dir), T.orders_batch(spark, sf_dir), KEYS,
                          order="_seq", keep="last")
