"""Benchmark: headline loads and the SQL conformance set at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_EVENT_LOG_DIR=<fresh folder> python bench.py   # plus scripts/stage_times.py

Prints one JSON line. Each query is run to completion on the executors with
the ``noop`` sink (nothing is collected to the driver); the conformance set
is timed as the median of three runs. Load timings include the CSV write,
the upload log and the read back.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from sqlhaul import DatasetRef, Lake, append, load_sql, read_dataset, reload  # noqa: E402
from sqlhaul.plans import conformance, inputs, load_queries  # noqa: E402
from sqlhaul.session import build_session, scratch_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = os.environ.get("BENCH_CPUS", "8")
USER = "bench"
E0 = 1_700_000_000


def _sf() -> float | str:
    tail = os.path.basename(SF_DIR)
    try:
        return float(tail.replace("sf", ""))
    except ValueError:
        return tail


def run_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    conf = {
        "spark.sql.shuffle.partitions": str(int(CPUS) * 2),
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    }
    event_dir = os.environ.get("BENCH_EVENT_LOG_DIR")
    if event_dir:  # stage/task times for scripts/stage_times.py (no UI)
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_dir})
    spark = build_session(f"local[{CPUS}]", app="sqlhaul-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    table = lambda n: inputs.table(spark, SF_DIR, n)
    results: dict[str, float] = {}

    lake = Lake(scratch_dir(spark, "bench"))

    # warm-up (not timed): JIT and codegen for the scan, stringify, CSV writer
    # and upload-log paths, on the smallest table
    append(spark, table("nation"), lake, DatasetRef("bench", "warmup"), USER, epoch=E0)
    run_all(read_dataset(spark, lake, DatasetRef("bench", "warmup")))
    items = DatasetRef("bench", "lineitem")

    # 1. stringify + CSV append of the whole lineitem table (one write job)
    results["append_lineitem"] = timed(lambda: append(spark, table("lineitem"), lake, items, USER, epoch=E0))

    # 2. mapped dataset -> Spark SQL (grouped) -> append, end to end
    q1 = """
        SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS DOUBLE)) AS sum_qty,
               sum(CAST(l_extendedprice AS DOUBLE) * (1 - CAST(l_discount AS DOUBLE))) AS revenue,
               count(*) AS n_lines
        FROM li GROUP BY l_returnflag, l_linestatus"""
    results["sql_over_dataset_load"] = timed(
        lambda: load_sql(spark, lake, {"li": items}, q1, DatasetRef("bench", "q1"), USER, epoch=E0 + 1)
    )

    # 2b. the same two steps with a parquet-format dataset (splittable, prunable)
    items_pq = DatasetRef("bench", "lineitem_pq")
    results["append_lineitem_parquet"] = timed(
        lambda: append(spark, table("lineitem"), lake, items_pq, USER, epoch=E0, file_format="parquet")
    )
    results["sql_over_parquet_dataset_load"] = timed(
        lambda: load_sql(spark, lake, {"li": items_pq}, q1, DatasetRef("bench", "q1pq"), USER, epoch=E0 + 1)
    )

    # 3. the reference's UNION ALL job over two mapped datasets
    results["load_union_all"] = timed(lambda: run_all(load_queries.load_union_all(spark, SF_DIR)))

    # 4. multi-line text: documents append, then full read back
    docs = DatasetRef("bench", "documents")
    results["csv_roundtrip_documents"] = timed(
        lambda: (
            append(spark, table("documents"), lake, docs, USER, epoch=E0),
            run_all(read_dataset(spark, lake, docs).select(F.sum(F.length("text")))),
        )
    )

    # 5. read after 50 uploads with one reload (uploads are set-up, not timed)
    many = DatasetRef("bench", "orders_uploads")
    # 50 consecutive order-date ranges cover the whole table
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    orders = table("orders").withColumn("_b", F.least(F.floor(day / 49), F.lit(49)))
    for i in range(50):
        part = orders.filter(F.col("_b") == i).drop("_b")
        (reload if i == 25 else append)(spark, part, lake, many, USER, epoch=E0 + i)
    results["read_after_50_uploads"] = timed(
        lambda: run_all(
            read_dataset(spark, lake, many, with_upload_date=True)
            .filter(F.col("upload_date") >= E0 + 40)
            .groupBy("o_orderstatus")
            .count()
        )
    )

    # 6. conformance set, median of three full runs
    conf = conformance.queries()
    runs = []
    per_query: dict[str, list[float]] = {n: [] for n in conf}
    for _ in range(3):
        total = 0.0
        for name, fn in conf.items():
            dt = timed(lambda: run_all(fn(spark, SF_DIR)))
            per_query[name].append(dt)
            total += dt
        runs.append(total)
    results["conformance_total_median3"] = statistics.median(runs)
    slowest = sorted(((statistics.median(v), n) for n, v in per_query.items()), reverse=True)[:5]
    for dt, n in slowest:
        results[f"conf:{n}"] = dt

    headline = [k for k in results if not k.startswith("conf:")]
    total = sum(results[k] for k in headline)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in results.items()},
                "sf": _sf(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
