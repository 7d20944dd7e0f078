"""Skew check: the event-time texts on an `events` copy where one user holds a
third of the rows, against their naive forms (capped at 120 s each), and the
chunked window texts on an `orders` copy where one customer holds a third.

    python scripts/skew_check.py [sf_dir] [copies]

The skewed copy is written under the session's shared workspace
(``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from sqlhaul.plans.conformance import ALL, SPLIT  # noqa: E402
from sqlhaul.session import build_session, scratch_dir  # noqa: E402

TEXTS = {c.name: c.spark_sql for c in ALL}

NAIVE_INTERVAL = """SELECT a.event_id AS purchase_id, count(b.event_id) AS views_before
  FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts >= a.ts - INTERVAL 2 HOURS AND b.ts < a.ts
  WHERE a.event_type = 'purchase' AND b.event_type = 'view' GROUP BY a.event_id"""

NAIVE_ASOF = """SELECT a.event_id, t.prev_ts FROM events a LEFT JOIN LATERAL (
  SELECT max(b.ts) AS prev_ts FROM events b WHERE b.user_id = a.user_id AND b.ts < a.ts) t
  WHERE a.event_type = 'purchase'"""


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "16", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    src = spark.read.parquet(f"{sf_dir}/events.parquet")
    big = None
    for k in range(copies):
        part = src.select(
            (F.col("event_id") + k * 1_000_000_000).alias("event_id"),
            (F.col("ts") + F.make_interval(days=F.lit(30 * k))).alias("ts"),
            F.when(F.xxhash64("event_id", F.lit(k)) % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
            "event_type",
            "value",
            "props",
        )
        big = part if big is None else big.unionByName(part)
    out = f"{scratch_dir(spark, 'skew')}/events"
    big.repartition(16).write.parquet(out)
    events = spark.read.parquet(out)
    events.createOrReplaceTempView("events")
    n, hot = events.count(), events.filter("user_id = 0").count()
    print(f"rows {n}, hot user rows {hot} ({hot / n:.0%})")

    def run(label: str, sql, cap: float = 120.0) -> None:
        sc = spark.sparkContext
        sc.setJobGroup(label, label, interruptOnCancel=True)
        timer = threading.Timer(cap, lambda: sc.cancelJobGroup(label))
        timer.start()
        t0 = time.time()
        try:
            (spark.sql(sql) if isinstance(sql, str) else sql()).write.format("noop").mode("overwrite").save()
            print(f"{label}: {time.time() - t0:.1f}s")
        except Exception as exc:  # cancelled by the cap
            print(f"{label}: stopped after {time.time() - t0:.0f}s ({type(exc).__name__})")
        finally:
            timer.cancel()

    for name in ("asof_join", "interval_join", "window_time_range_frame_split"):
        run(name, lambda name=name: SPLIT[name][1](events))
    run("window_time_range_frame, plain", TEXTS["window_time_range_frame"])
    run("session_window_chunked", lambda: SPLIT["session_window_chunked"][1](events))
    run("session_window", TEXTS["session_window"])
    run("interval_join, naive key", NAIVE_INTERVAL)
    run("asof_join, naive lateral", NAIVE_ASOF)

    # orders: one customer holding a third of the rows
    osrc = spark.read.parquet(f"{sf_dir}/orders.parquet")
    obig = None
    for k in range(copies):
        part = osrc.select(
            (F.col("o_orderkey") + k * 1_000_000_000).alias("o_orderkey"),
            F.when(F.xxhash64("o_orderkey", F.lit(k)) % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("o_custkey"),
            "o_orderstatus",
            "o_totalprice",
            (F.col("o_orderdate") + F.make_interval(days=F.lit(30 * k))).alias("o_orderdate"),
            "o_orderpriority",
        )
        obig = part if obig is None else obig.unionByName(part)
    oout = f"{scratch_dir(spark, 'skew')}/orders"
    obig.repartition(16).write.parquet(oout)
    orders = spark.read.parquet(oout)
    orders.createOrReplaceTempView("orders")
    n, hot = orders.count(), orders.filter("o_custkey = 0").count()
    print(f"orders rows {n}, hot customer rows {hot} ({hot / n:.0%})")
    plain = {
        "window_row_number_chunked": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey "
        "ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders",
        "window_rank_chunked": "SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey "
        "ORDER BY floor(o_totalprice / 1000) DESC) AS rk FROM orders",
        "window_lag_chunked": "SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_custkey "
        "ORDER BY o_orderdate, o_orderkey) AS prev_price FROM orders",
    }
    run("window_edges_split", lambda: SPLIT["window_edges_split"][1](orders))
    run("window_range_frame_split", lambda: SPLIT["window_range_frame_split"][1](orders))
    run("window_range_frame, plain", TEXTS["window_range_frame"])
    for name, sql in plain.items():
        run(name, lambda name=name: SPLIT[name][1](orders))
        run(f"{name}, plain window", sql)
    spark.stop()


if __name__ == "__main__":
    main()
