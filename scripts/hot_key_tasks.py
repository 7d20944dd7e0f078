"""Rows that the largest task of each split query reads, at two sizes of a hot key.

    python scripts/hot_key_tasks.py [sf_dir] [copies]

``events`` and ``orders`` are repeated (later times, new ids) with a third of
the rows moved to one user or customer; each query runs once over ``copies`` and
once over twice as many. The figures are records read by a task from shuffles,
from Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from sqlhaul.operators import ordered  # noqa: E402
from sqlhaul.plans.conformance import ALL, SPLIT  # noqa: E402
from sqlhaul.session import build_session, scratch_dir  # noqa: E402

TEXTS = {c.name: c.spark_sql for c in ALL}
QUERIES = {
    "window_time_range_frame_split": "events", "asof_join": "events", "interval_join": "events", "window_range_frame_split": "orders",
    "window_edges_split": "orders", "window_row_number_chunked": "orders",
}
PLAIN = {"window_time_range_frame": "events", "window_range_frame": "orders", "window_lag_lead": "orders"}


def grown(spark, sf_dir: str, name: str, copies: int):
    src = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    ident, key, ts = {"events": ("event_id", "user_id", "ts"), "orders": ("o_orderkey", "o_custkey", "o_orderdate")}[name]
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    big = src.withColumn("copy", copy).withColumns({
        ident: F.col(ident) * copies + F.col("copy"),
        ts: F.col(ts) + F.make_interval(days=30 * F.col("copy")),
        key: F.when(F.xxhash64(ident, "copy") % 3 == 0, F.lit(0).cast("long")).otherwise(F.col(key)),
    })
    path = f"{scratch_dir(spark, 'hot')}/{name}"
    big.select(*src.columns).repartition(16).write.parquet(path)
    return spark.read.parquet(path)


def largest(log_dir: str) -> dict[str, int]:
    """Most records that one task of a job group read from shuffles."""
    stage_of, most = {}, {}
    for file in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(file) or os.path.basename(file).startswith((".", "appstatus")):
            continue
        for line in open(file):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                group = (event.get("Properties") or {}).get("spark.jobGroup.id")
                for s in event["Stage IDs"]:
                    stage_of[s] = group
            elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                n = event["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                group = stage_of.get(event["Stage ID"])
                most[group] = max(most.get(group, 0), n)
    return most


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 2
    ordered.CHUNK_ROWS = 10_000
    log_dir = tempfile.mkdtemp(prefix="hot-key-events-")
    spark = build_session("local[4]", **{
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
        "spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    spark.sparkContext.setLogLevel("ERROR")
    rows = {}
    for k in (copies, 2 * copies):
        for name in ("events", "orders"):
            df = grown(spark, sf_dir, name, k)
            df.createOrReplaceTempView(name)
            rows[f"{k} {name}"] = df.count()
            # the hash partitions of joins back by id follow the rows as well
            spark.conf.set("spark.sql.shuffle.partitions", str(32 * k // copies))
            for query in [q for q, t in {**QUERIES, **PLAIN}.items() if t == name]:
                spark.sparkContext.setJobGroup(f"{k} {query}", query)
                out = SPLIT[query][1](df) if query in QUERIES else spark.sql(TEXTS[query])
                out.write.format("noop").mode("overwrite").save()
    spark.stop()
    most = largest(log_dir)
    print("rows:", rows)
    for query in {**QUERIES, **PLAIN}:
        print(f"{query}: {most.get(f'{copies} {query}')} -> {most.get(f'{2 * copies} {query}')}")


if __name__ == "__main__":
    main()
