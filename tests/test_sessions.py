"""Work written to spread a hot key (split windows and sessions, as-of and
interval joins) against plain-Python brute force on dense fixtures: one very active user or customer whose sessions, matches and ranks
run across hour and bucket edges."""

import datetime as dt

from pyspark.sql import functions as F

from sqlhaul.operators.windows import split_window
from sqlhaul.plans.conformance import ALL, SPLIT

TEXTS = {c.name: c.spark_sql for c in ALL}
GAP = dt.timedelta(minutes=30)


def _fixture():
    t0 = dt.datetime(2024, 1, 1, 0, 5)
    rows, eid = [], 0
    # user 1: one event every 10 min for 5 h (one session over 6 chunks), a
    # gap of exactly 30 min (same session), then 31 min (new session), then
    # isolated events
    times = [t0 + dt.timedelta(minutes=10 * i) for i in range(31)]
    times.append(times[-1] + GAP)
    times.append(times[-1] + GAP + dt.timedelta(minutes=1))
    times += [times[-1] + dt.timedelta(hours=3), times[-1] + dt.timedelta(hours=7, microseconds=1)]
    times.append(times[-1])  # duplicate timestamp
    for t in times:
        rows.append((eid, t, 1, "view", 1.0, "{}"))
        eid += 1
    # user 2: events around an hour edge, 29 min apart, then one far away
    for t in (dt.datetime(2024, 1, 1, 0, 50), dt.datetime(2024, 1, 1, 1, 19), dt.datetime(2024, 1, 2, 0, 0)):
        rows.append((eid, t, 2, "click", 1.0, "{}"))
        eid += 1
    return rows


def _brute(rows):
    out = []
    for user in sorted({r[2] for r in rows}):
        ts = sorted(r[1] for r in rows if r[2] == user)
        start = last = ts[0]
        n = 1
        for t in ts[1:]:
            if t - last <= GAP:
                last, n = t, n + 1
            else:
                out.append((user, start, last + GAP, n))
                start = last = t
                n = 1
        out.append((user, start, last + GAP, n))
    return sorted(out)


def test_chunked_sessions_match_brute_force(spark):
    rows = _fixture()
    spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ).createOrReplaceTempView("events")
    expected = _brute(rows)
    assert any(n > 20 for *_, n in expected)  # the long session is there
    events = spark.table("events")
    for df in (SPLIT["session_window_chunked"][1](events), spark.sql(TEXTS["session_window"])):
        got = sorted(tuple(r) for r in df.select("user_id", "s_start", "s_end", "n_events").collect())
        assert got == expected


def _events_fixture():
    base = dt.datetime(2024, 1, 1, 0, 0)
    rows, eid = [], 0
    plan = [
        # user 1: views every 7 min for 4 h with purchases mixed in
        *[(1, base + dt.timedelta(minutes=7 * i), "purchase" if i % 5 == 4 else "view") for i in range(35)],
        # equal timestamps: a view and a purchase at the same instant
        (1, base + dt.timedelta(hours=5), "view"),
        (1, base + dt.timedelta(hours=5), "purchase"),
        # user 2: a purchase exactly 2 h after a view (out of range), one just inside
        (2, base + dt.timedelta(hours=1), "view"),
        (2, base + dt.timedelta(hours=1, microseconds=1), "view"),
        (2, base + dt.timedelta(hours=3), "purchase"),
        # user 3: a purchase with no earlier event at all
        (3, base + dt.timedelta(hours=2), "purchase"),
    ]
    for user, ts, kind in plan:
        rows.append((eid, ts, user, kind, 1.0, "{}"))
        eid += 1
    return rows


def test_asof_and_interval_joins_match_brute_force(spark):
    rows = _events_fixture()
    spark.createDataFrame(
        rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ).createOrReplaceTempView("events")
    purchases = [r for r in rows if r[3] == "purchase"]
    asof = sorted(
        (p[0], max((r[1] for r in rows if r[2] == p[2] and r[1] < p[1]), default=None)) for p in purchases
    )
    got = sorted(tuple(r) for r in SPLIT["asof_join"][1](spark.table("events")).collect())
    assert got == asof
    window = dt.timedelta(hours=2)
    interval = sorted(
        (p[0], n)
        for p in purchases
        if (n := sum(1 for r in rows if r[2] == p[2] and r[3] == "view" and p[1] - window <= r[1] < p[1]))
    )
    got = sorted(tuple(r) for r in SPLIT["interval_join"][1](spark.table("events")).collect())
    assert got == interval


def test_chunked_row_number_matches_brute_force(spark):
    import random

    rnd = random.Random(7)
    rows = []
    for k in range(600):  # customer 1 is hot; prices repeat within and across buckets
        cust = 1 if k < 500 else 2 + k % 5
        price = float(rnd.choice([5000, 9999.99, 10000, 15000, 15000, 25000.5, 99999, 100000]))
        rows.append((k, cust, "O", price, dt.datetime(2000, 1, 1), "1-URGENT"))
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string"
    ).createOrReplaceTempView("orders")
    expected = []
    for cust in sorted({r[1] for r in rows}):
        mine = sorted((r for r in rows if r[1] == cust), key=lambda r: (-r[3], r[0]))
        expected += [(r[0], cust, i + 1) for i, r in enumerate(mine)]
    got = sorted(tuple(r) for r in SPLIT["window_row_number_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected)


def test_chunked_lag_and_lead_match_brute_force(spark):
    import random

    rnd = random.Random(11)
    rows = []
    for k in range(700):  # customer 1 is hot, several orders per day, months with gaps
        cust = 1 if k < 600 else 2 + k % 4
        day = dt.datetime(1996, 1, 1) + dt.timedelta(days=rnd.choice([0, 1, 2, 40, 41, 95, 300, 301, 302]))
        price = rnd.choice([None, 10.0, 20.5, 99.0]) if k % 7 else None
        rows.append((k, cust, "O", price, day, "1-URGENT"))
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string"
    ).createOrReplaceTempView("orders")
    expected = []
    for cust in sorted({r[1] for r in rows}):
        mine = sorted((r for r in rows if r[1] == cust), key=lambda r: (r[4], r[0]))
        expected += [(r[0], mine[i - 1][3] if i else None) for i, r in enumerate(mine)]
    got = sorted(tuple(r) for r in SPLIT["window_lag_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected)
    expected_lead = []
    for cust in sorted({r[1] for r in rows}):
        mine = sorted((r for r in rows if r[1] == cust), key=lambda r: (r[4], r[0]))
        expected_lead += [(r[0], mine[i + 1][3] if i + 1 < len(mine) else None) for i, r in enumerate(mine)]
    got = sorted(tuple(r) for r in SPLIT["window_lead_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected_lead)


def test_chunked_rank_matches_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for k in range(600):  # customer 1 is hot; many equal values inside and across buckets
        cust = 1 if k < 500 else 2 + k % 3
        price = float(rnd.choice([999, 1000, 1500, 9999, 10000, 10001, 25000, 99999, 100000, 100999]))
        rows.append((k, cust, "O", price, dt.datetime(2000, 1, 1), "1-URGENT"))
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string"
    ).createOrReplaceTempView("orders")
    expected = []
    for cust in sorted({r[1] for r in rows}):
        keys = [int(r[3] // 1000) for r in rows if r[1] == cust]
        for r in (r for r in rows if r[1] == cust):
            k = int(r[3] // 1000)
            expected.append((r[0], cust, 1 + sum(1 for x in keys if x > k), 1 + len({x for x in keys if x > k})))
    got = sorted(tuple(r) for r in SPLIT["window_rank_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected)


def test_chunked_distribution_matches_brute_force(spark):
    import random

    rnd = random.Random(9)
    rows = []
    for k in range(500):  # customer 1 is hot; customer 9 has a single order
        cust = 1 if k < 450 else (9 if k == 499 else 2 + k % 3)
        price = float(rnd.choice([999, 1000, 1500, 9999, 10000, 10001, 25000, 99999, 100000]))
        rows.append((k, cust, "O", price, dt.datetime(2000, 1, 1), "1-URGENT"))
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string"
    ).createOrReplaceTempView("orders")
    expected = []
    for cust in sorted({r[1] for r in rows}):
        keys = [int(r[3] // 1000) for r in rows if r[1] == cust]
        n = len(keys)
        for r in (r for r in rows if r[1] == cust):
            k = int(r[3] // 1000)
            rank = 1 + sum(1 for x in keys if x < k)
            pr = 0.0 if n == 1 else (rank - 1) / (n - 1)
            expected.append((r[0], pr, sum(1 for x in keys if x <= k) / n))
    got = sorted(tuple(r) for r in SPLIT["window_distribution_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected)


def test_chunked_ntile_matches_brute_force(spark):
    rows = []
    sizes = {1: 1003, 2: 1, 3: 2, 4: 3, 5: 4, 6: 5, 7: 7}  # every remainder of 4, and tiny customers
    key = 0
    for cust, n in sizes.items():
        for _ in range(n):
            key += 37 if cust == 1 else 1001  # customer 1 spans many key buckets
            rows.append((key, cust, "O", 1.0, dt.datetime(2000, 1, 1), "1-URGENT"))
    spark.createDataFrame(
        rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string"
    ).createOrReplaceTempView("orders")
    expected = []
    for cust, n in sizes.items():
        keys = sorted(r[0] for r in rows if r[1] == cust)
        q, rem = divmod(n, 4)
        bounds = []
        for t in range(4):  # tile sizes: the first rem tiles hold q + 1 rows
            size = q + (1 if t < rem else 0)
            bounds += [t + 1] * size
        expected += [(k, cust, bounds[i]) for i, k in enumerate(keys)]
    got = sorted(tuple(r) for r in SPLIT["window_ntile_chunked"][1](spark.table("orders")).collect())
    assert got == sorted(expected)


def test_split_window_edge_cases(spark):
    """Null keys and orders, ties, many chunks of one key, an empty table."""
    rows = [(None if k % 5 == 0 else "hot" if k % 5 < 4 else "b", None if k % 11 == 0 else k % 40, k, float(k % 7)) for k in range(900)]
    df = spark.createDataFrame(rows, "g string, o int, id int, x double")
    outputs = {
        "rk": ("rank",), "drk": ("dense_rank",), "cd": ("cume_dist",), "s": ("running_sum", "x"), "rn": ("row_number",),
        "t": ("ntile", 7), "p": ("lag", "x"), "q": ("lead", "x"),
    }
    order = [F.col("o"), F.col("id")]
    split = split_window(df.repartition(6), ["g"], order, {k: outputs[k] for k in ("rn", "t", "p", "q", "s")})
    plain = """SELECT g, o, id, x, CAST(row_number() OVER w AS BIGINT) rn, CAST(ntile(7) OVER w AS BIGINT) t, lag(x) OVER w p, lead(x) OVER w q,
               sum(x) OVER w s FROM f WINDOW w AS (PARTITION BY g ORDER BY o, id)"""
    df.createOrReplaceTempView("f")
    assert sorted(map(repr, split.collect())) == sorted(map(repr, spark.sql(plain).collect()))
    tied = split_window(df.repartition(6), ["g"], [F.desc("o")], {k: outputs[k] for k in ("rk", "drk", "cd", "s")})
    plain = """SELECT g, o, id, x, CAST(rank() OVER w AS BIGINT) rk, CAST(dense_rank() OVER w AS BIGINT) drk, cume_dist() OVER w cd,
               sum(x) OVER w s FROM f WINDOW w AS (PARTITION BY g ORDER BY o DESC)"""
    assert sorted(map(repr, tied.collect())) == sorted(map(repr, spark.sql(plain).collect()))
    assert split_window(df.limit(0), ["g"], order, outputs).count() == 0


def test_a_hot_key_lies_in_many_chunks(spark):
    """The largest group that a task orders is a chunk, not the key."""
    df = spark.range(40_000).selectExpr("0 g", "id o")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = split_window(df, ["g"], [F.col("o")], {"rn": ("row_number",)})
        assert out.where("rn <> o + 1").count() == 0
        sizes = [r["count"] for r in df.repartitionByRange("g", "o").groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) < 10_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
