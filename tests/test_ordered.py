"""Frames, as-of, interval and band joins against brute force, with chunks and
cells far smaller than the groups."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sqlhaul.operators import ordered
from sqlhaul.operators.windows import split_window


@pytest.fixture(autouse=True)
def many_chunks(monkeypatch):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 20)
    monkeypatch.setattr(ordered, "CELL_ROWS", 7)


def rows_of(seed, n):
    """Two thirds of the rows in one key, many ties, nulls in key, order and value."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if r.random() < 0.66 else r.choice(["a", "b", None])
        out.append((i, key, None if r.random() < 0.05 else r.choice([r.randint(0, 40), r.randint(0, 400)]), None if r.random() < 0.1 else r.randint(-5, 50)))
    return out


SCHEMA = "id long, k string, o long, x int"


def test_range_frame_against_brute_force(spark):
    rows = rows_of(1, 300)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("d", F.col("x").cast("decimal(9,2)"))
    outputs = {"n": ("count", "*"), "nx": ("count", "x"), "s": ("sum", "x"), "sd": ("sum", "d"), "a": ("avg", "x"), "lo": ("min", "x"), "hi": ("max", "x")}
    got = {r["id"]: r for r in ordered.split_range_frame(df, ["k"], "o", "25", "60", outputs).collect()}
    assert len(got) == len(rows)
    for i, k, o, x in rows:
        frame = [v for _, k2, o2, v in rows if k2 == k and (o2 is None if o is None else o2 is not None and o - 25 <= o2 <= o + 60)]
        own = [v for v in frame if v is not None]
        r = got[i]
        assert (r["n"], r["nx"], r["s"], r["lo"], r["hi"]) == (len(frame), len(own), sum(own) if own else None, min(own, default=None), max(own, default=None))
        assert r["sd"] == (Decimal(sum(own)) if own else None)
        assert r["a"] == (pytest.approx(sum(own) / len(own)) if own else None)


def test_frames_like_spark_own(spark):
    df = spark.createDataFrame(rows_of(2, 200), SCHEMA).withColumns({
        "ts": F.timestamp_seconds(F.col("o") * 60), "d": (F.col("x") / 4).cast("decimal(12,3)"), "select": F.lit(1)
    })
    df.createOrReplaceTempView("framed")
    want = spark.sql("""SELECT *, sum(d) OVER w AS s, avg(d) OVER w AS a, count(*) OVER w AS n, min(ts) OVER w AS m
                        FROM framed WINDOW w AS (PARTITION BY k ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW)""")
    got = ordered.split_range_frame(df, ["k"], "ts", "INTERVAL 30 MINUTES", "0", {"s": ("sum", "d"), "a": ("avg", "d"), "n": ("count", "*"), "m": ("min", "ts")})
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    no_key = ordered.split_range_frame(df, [], "o", "3", "0", {"n": ("count", "*"), "hi": ("max", "x")})
    want = spark.sql("SELECT *, count(*) OVER w AS n, max(x) OVER w AS hi FROM framed WINDOW w AS (ORDER BY o RANGE BETWEEN 3 PRECEDING AND CURRENT ROW)")
    assert sorted(map(str, no_key.collect())) == sorted(map(str, want.collect()))


def test_floating_sums_are_refused(spark):
    df = spark.createDataFrame([(1, 2.0)], "o int, x double")
    with pytest.raises(ValueError, match="not exact"):
        ordered.split_range_frame(df, [], "o", "1", "0", {"s": ("sum", "x")})


@pytest.mark.parametrize("equal", [True, False])
def test_asof_against_brute_force(spark, equal):
    left, right = rows_of(3, 120), rows_of(4, 150)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    got = {r["id"]: r for r in ordered.split_asof(a, b, ["k"], "o", "o", {"at": "o", "what": "x"}, equal=equal).collect()}
    assert len(got) == len(left)
    for i, k, o, x in left:
        near = [(o2, x2) for _, k2, o2, x2 in right if k is not None and k2 == k and o is not None and o2 is not None and (o2 <= o if equal else o2 < o)]
        # nulls are the smallest, as in Spark's order of structs
        best = max(near, key=lambda m: (m[0], m[1] is not None, m[1] or 0), default=(None, None))
        assert (got[i]["at"], got[i]["what"], got[i]["x"]) == (*best, x)


def test_interval_against_brute_force(spark):
    left, right = rows_of(5, 120), rows_of(6, 150)
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA).withColumnRenamed("x", "y")
    got = {r["id"]: r for r in ordered.split_interval(a, b, ["k"], "o", "o", "-30", "10", {"n": ("count", "*"), "s": ("sum", "y")}).collect()}
    assert len(got) == len(left)
    for i, k, o, _ in left:
        met = [y for _, k2, o2, y in right if k is not None and k2 == k and None not in (o, o2) and o - 30 <= o2 < o + 10]
        own = [y for y in met if y is not None]
        assert (got[i]["n"], got[i]["s"]) == (len(met), sum(own) if own else None)


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_band_join_against_brute_force(spark, keys):
    r = random.Random(9)
    points = rows_of(7, 200)
    bands = []
    for i in range(60):
        low = r.choice([r.randint(0, 400), 20, None])
        bands.append((1000 + i, r.choice(["hot", "hot", "a", None]), low, None if low is None else low + r.choice([0, 1, 30, 500, -3])))
    a = spark.createDataFrame(points, SCHEMA)
    b = spark.createDataFrame(bands, "band long, k string, lo long, hi long")
    b = b if keys else b.drop("k")
    out = ordered.band_join(a, b, "o", "lo", "hi", keys)
    want = [(p[0], q[0]) for p in points for q in bands if None not in (p[2], q[2]) and (not keys or p[1] is not None and p[1] == q[1]) and q[2] <= p[2] < q[3]]
    assert sorted((x["id"], x["band"]) for x in out.collect()) == sorted(want)
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_band_join_of_other_types_and_clashes(spark):
    a = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, v int")
    b = spark.createDataFrame([("x", 9.5, 10.5), ("y", float("-inf"), float("inf"))], "name string, lo double, hi double")
    assert sorted((r["id"], r["name"]) for r in ordered.band_join(a, b, "v", "lo", "hi").collect()) == [(1, "x"), (1, "y"), (2, "y")]
    with pytest.raises(ValueError, match="both sides"):
        ordered.band_join(a, a, "v", "id", "id")


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_band_aggregates_without_pairs(spark, keys, monkeypatch):
    r = random.Random(19)
    points = rows_of(7, 400)
    bands = []
    for i in range(80):
        low = r.choice([r.randint(0, 400), 20, None])
        bands.append((1000 + i % 70, r.choice(["hot", "hot", "a", None]), low, None if low is None else low + r.choice([0, 1, 30, 500, 900, -3])))
    a = spark.createDataFrame(points, SCHEMA)
    b = spark.createDataFrame(bands, "band long, k string, lo long, hi long")
    b = b if keys else b.drop("k")
    tags = []
    monkeypatch.setattr(ordered, "LEVEL_FAN", 3)
    monkeypatch.setattr(ordered, "stored", lambda df, tag, own=ordered.stored: tags.append(tag) or own(df, tag))
    outputs = {"n": ("count", "*"), "least": ("min", "id"), "most": ("max", "x"), "total": ("sum", "x"), "there": ("count", "x")}
    out = ordered.band_join(a, b, "o", "lo", "hi", keys, outputs)
    want = []
    for q in bands:
        met = [p for p in points if None not in (p[2], q[2]) and (not keys or p[1] is not None and p[1] == q[1]) and q[2] <= p[2] < q[3]]
        xs = [p[3] for p in met if p[3] is not None]
        if met:
            want.append((q[0], q[2], q[3], len(met), min(p[0] for p in met), max(xs, default=None), sum(xs) if xs else None, len(xs)))
    got = [(x["band"], x["lo"], x["hi"], *(x[c] for c in outputs)) for x in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert tags.count("band-level") >= 2, "wide bands go up several levels"


def test_split_percentile(spark):
    values = [5.0, 1.0, 1.0, None, 9.5, 3.25, float("inf"), 3.25, -2.0, 0.0, -0.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for share in (0.0, 0.3, 0.5, 0.77, 1.0):
        want = df.agg(F.percentile("v", share)).first()[0]
        assert ordered.split_percentile(df, "v", share).first()["value"] == want
    assert ordered.split_percentile(df.limit(0), "v", 0.5).first()["value"] is None


def test_empty_sides(spark):
    a, b = spark.createDataFrame([(1, "k", 1, 1)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert ordered.split_asof(a, b, ["k"], "o", "o", {"y": "x"}).collect()[0]["y"] is None
    assert ordered.split_interval(a, b, ["k"], "o", "o", "0", "5", {"n": ("count", "*")}).collect()[0]["n"] == 0
    assert ordered.split_range_frame(b, ["k"], "o", "1", "1", {"n": ("count", "*"), "m": ("min", "x")}).count() == 0
    assert ordered.split_asof(b, a, ["k"], "o", "o", {"y": "x"}).count() == 0
    assert ordered.band_join(a.select("id", "o"), b.select(F.col("o").alias("lo"), F.col("x").alias("hi")), "o", "lo", "hi").count() == 0


def test_edge_functions_over_many_chunks(spark):
    df = spark.createDataFrame(rows_of(8, 260), SCHEMA)
    outputs = {
        "b1": ("lag", "x"), "b7": ("lag", "x", 7), "b60": ("lag", "id", 60), "f2": ("lead", "id", 2), "f45": ("lead", "x", 45),
        "one": ("first_value", "x"), "last": ("last_value", "id"), "fifth": ("nth_value", "id", 5), "never": ("nth_value", "id", 9999), "rn": ("row_number",),
    }
    got = {r["id"]: r for r in split_window(df, ["k"], [F.col("o").asc_nulls_first(), F.col("id")], outputs).collect()}
    groups = {}
    for row in sorted(rows_of(8, 260), key=lambda t: (t[2] is not None, t[2] or 0, t[0])):
        groups.setdefault(row[1], []).append(row)
    assert len(got) == 260
    for own in groups.values():
        at = lambda i, c: own[i][c] if 0 <= i < len(own) else None
        for i, row in enumerate(own):
            want = (at(i - 1, 3), at(i - 7, 3), at(i - 60, 0), at(i + 2, 0), at(i + 45, 3), own[0][3], own[-1][0], at(4, 0), None, i + 1)
            assert tuple(got[row[0]][c] for c in outputs) == want


def test_a_hot_key_makes_more_chunks_not_larger_ones(spark):
    sizes = {}
    for n in (2000, 4000):
        df = spark.range(n).select(F.lit("hot").alias("__k0"), (F.col("id") % 3).alias("__v"), F.col("id").alias("__id"))
        chunks = ordered._chunked(ordered.stored(df, "t"), ["__k0"], ["__v", "__id"])
        sizes[n] = chunks.groupBy("__chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[4000][0] <= 1.5 * sizes[2000][0] and sizes[4000][1] >= 1.7 * sizes[2000][1]
