"""Print the physical plans of the main operators in their production shape.

Stored inputs (3m candles, a keyed target table, landed payloads) are first
written as Parquet under a scratch folder, so the plans show what a cluster
run would do: pushed filters, pruned columns, exchanges and join choices.

    python tools/show_plans.py /root/testdata/sf0.01 > docs/PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


from tickroll.functions.timefn import RunRange, interval_ms  # noqa: E402
from tickroll.operators import candles as C  # noqa: E402
from tickroll.operators import merge as M  # noqa: E402
from tickroll.plans import loads as LD  # noqa: E402
from tickroll.session import build_session, shared_dir  # noqa: E402
from tickroll.sources import testdata as T  # noqa: E402


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return re.sub(r"#\d+", "", buf.getvalue())


def main(sf_dir: str) -> None:
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.adaptive.enabled", "false")     # the static plan
    base = shared_dir(spark, "plans")
    T.candles_3m(spark, sf_dir).write.parquet(f"{base}/ohlcv_3m")
    T.orders_target(spark, sf_dir).write.parquet(f"{base}/orders_target")
    T.orders_batch(spark, sf_dir).write.parquet(f"{base}/orders_batch")
    T.fin_payloads(spark, sf_dir).write.parquet(f"{base}/fin_landed")
    c3 = spark.read.parquet(f"{base}/ohlcv_3m")
    rr = RunRange.resolve(interval_ms("1h"), "2024-01-20T00:00:00Z", 7)
    cases = [
        ("1h rollup of a stored 3m table over a 7-day run range",
         C.rollup(c3, interval_ms("1h"), rr)),
        ("upsert of a batch into a stored keyed table",
         M.upsert_update(spark.read.parquet(f"{base}/orders_target"),
                         spark.read.parquet(f"{base}/orders_batch"), ["o_orderkey"],
                         mapped=T.ORDER_MAPPED)),
        ("financial indicator load from landed payloads",
         LD.load_fin_indicators(spark.read.parquet(f"{base}/fin_landed"), T.FIN_RATIOS)),
    ]
    print("# Physical plans (static, AQE off; generated by tools/show_plans.py)\n")
    for title, df in cases:
        print(f"## {title}\n\n```")
        print(plan_text(df).strip())
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
