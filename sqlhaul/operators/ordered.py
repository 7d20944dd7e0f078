"""Joins and frames over an order, without one task per key and without pairs.

All functions here lay what asks and what answers in one order: the rows of
both sides become one table, range-partitioned by (keys, value, ...) with a row
id last, so no two rows are equal and a partition ("chunk") has its share of
the rows whatever key or value is frequent. Inside a chunk a window over
(chunk, key) accumulates; a summary with one row for each chunk and key carries
the sums, or the last match, of a key's earlier chunks over (``_accumulated``).
The number of chunks follows the counted rows (``CHUNK_ROWS``).

* ``split_range_frame``: aggregates over ``RANGE`` frames. Sums, counts and
  averages are differences of two prefix sums, asked at the frame's two ends,
  so the work does not depend on how many rows a frame holds. ``min`` and
  ``max``, which have no difference, take a halo: each chunk gets a copy of
  those rows of its neighbours that its frames reach, and runs the frame.
* ``split_asof``: the last earlier row of another table, carried forward.
* ``split_interval``: aggregates over another table's rows within a distance.
* ``band_join``: rows whose value lies within other rows' bounds. Bounds are
  turned into ranks of the values, ranks into cells; a band is copied only to
  the cells that it covers, so the work is in proportion to the result. Where
  only aggregates over each band are asked for, no pair is made.
* ``split_percentile``: an exact percentile of a column of many values.

Intermediate tables are written to the shared workspace, so a lost executor
costs a retry of its tasks only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

#: Rows of a chunk, where they make more chunks than the session's shuffles have partitions.
CHUNK_ROWS = 1_000_000
#: Rows of a cell of a band join.
CELL_ROWS = 512
#: Items of a cell in the levels of least and largest values.
LEVEL_FAN = 64

_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the workspace and read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunk_count(spark: SparkSession, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // CHUNK_ROWS))


def _chunked(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rows`` (a stored table) with ``__chunk``, stored. ``order`` ends with a
    column that tells all rows apart."""
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    dealt = rows.repartitionByRange(chunk_count(rows.sparkSession, rows.count()), *by)
    return stored(dealt.withColumn("__chunk", F.spark_partition_id()), "chunks")


def _same(left: str, right: str, names: list[str]) -> str:
    return " and ".join(f"{left}.{n} <=> {right}.{n}" for n in names)


def _accumulated(rows: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], wanted: str) -> DataFrame:
    """The rows of a chunked table that are ``wanted`` (SQL), with the sum of
    each of ``sums`` over the key's rows up to them in all chunks."""
    group = Window.partitionBy("__chunk", *keys)
    upto = group.orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()}).where(wanted)
    pieces = rows.groupBy("__chunk", *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("__chunk", *keys, *[F.sum(n).over(earlier).alias(f"__before_{n}") for n in sums])
    both = local.alias("l").join(before.alias("r"), F.expr(_same("l", "r", ["__chunk", *keys])), "left")
    kept = [F.col(f"l.{c}") for c in rows.columns]
    return both.select(*kept, *[(F.coalesce(F.col(f"l.{n}"), F.lit(0)) + F.coalesce(F.col(f"r.__before_{n}"), F.lit(0))).alias(n) for n in sums])


def _prefix_sums(data: DataFrame, probes: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """(__id, __side, sums): for each probe (__k0.., __v, __after, __id, __side)
    the sums over the rows of ``data`` (__k0.., __v, __row, measures) with its
    key and a smaller value, or, where ``__after``, one that is not larger."""
    measures = list(sums.values())
    asked = probes.select(
        *keys, "__v", F.when(F.col("__after"), 2).otherwise(0).alias("__kind"), "__id", "__side",
        *[F.lit(None).cast(data.schema[m].dataType).alias(m) for m in measures],
    )
    told = data.select(*keys, "__v", F.lit(1).alias("__kind"), F.col("__row").alias("__id"), F.lit(0).alias("__side"), *measures)
    rows = _chunked(told.unionByName(asked), keys, ["__v", "__kind", "__id", "__side"])
    found = _accumulated(rows, keys, ["__v", "__kind"], {n: F.col(m) for n, m in sums.items()}, "__kind <> 1")
    return found.select("__id", "__side", *sums)


def _result_type(column: T.DataType, kind: str) -> T.DataType:
    """The type that SQL gives ``sum`` and ``avg`` of whole numbers and decimals."""
    if not isinstance(column, T.DecimalType):
        return T.LongType() if kind == "sum" else T.DoubleType()
    more, digits = (10, 0) if kind == "sum" else (4, 4)
    return T.DecimalType(min(38, column.precision + more), min(38, column.scale + digits))


def _measures(df: DataFrame, outputs: dict[str, tuple]) -> tuple[dict[str, Column], dict[str, Column]]:
    """(measure columns by name, results by name) of sums, counts and averages:
    a result is made of the measures' differences ``__d_<measure>``."""
    made, results = {}, {}
    for name, (kind, *arg) in outputs.items():
        col = _name(arg[0]) if arg and arg[0] != "*" else None
        if kind == "count":
            made[f"__n_{name}"] = F.lit(1).cast("long") if col is None else F.when(col.isNotNull(), 1).otherwise(0).cast("long")
            results[name] = F.col(f"__d_n_{name}")
            continue
        if kind not in ("sum", "avg"):
            raise ValueError(f"unknown function {kind!r}")
        if not isinstance(df.schema[arg[0]].dataType, _EXACT):
            raise ValueError(f"{kind}({arg[0]}): differences of floating sums are not exact; cast to a decimal")
        made[f"__n_{name}"] = F.when(col.isNotNull(), 1).otherwise(0).cast("long")
        made[f"__s_{name}"] = col if isinstance(df.schema[arg[0]].dataType, T.DecimalType) else col.cast("long")
        # the sum's own type first: a division keeps fewer digits of a longer one
        total, n = F.col(f"__d_s_{name}").cast(_result_type(df.schema[arg[0]].dataType, "sum")), F.col(f"__d_n_{name}")
        results[name] = F.when(n > 0, total if kind == "sum" else total / n).cast(_result_type(df.schema[arg[0]].dataType, kind))
    return made, results


def _differences(df: DataFrame, data: DataFrame, probes: DataFrame, keys: list[str], measures: dict[str, Column], results: dict[str, Column]) -> DataFrame:
    """``df`` (with ``__id``) and the results of what lies between its probes
    of side 0 and 1."""
    sums = {m[2:]: m for m in measures}
    found = _prefix_sums(data, probes, _names(keys), {f"__p_{n}": m for n, m in sums.items()})
    ends = [F.sum(F.when(F.col("__side") == 1, F.col(f"__p_{n}")).otherwise(-F.col(f"__p_{n}"))).alias(f"__d_{n}") for n in sums]
    between = found.groupBy("__id").agg(*ends)
    joined = df.join(between, "__id")
    return joined.select(*[_name(c) for c in df.columns if c != "__id"], *[c.alias(n) for n, c in results.items()])


def _keyed(keys: list[str]) -> list[Column]:
    """The keys as ``__k0``, ...; without any, all rows have one."""
    return [_name(k).alias(f"__k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("__k0")]


def _names(keys: list[str]) -> list[str]:
    return [f"__k{i}" for i in range(max(1, len(keys)))]


def split_range_frame(df: DataFrame, keys: list[str], order: str, preceding: str, following: str, outputs: dict[str, tuple]) -> DataFrame:
    """``df`` with one more column for each of ``outputs`` (name -> (function,
    column)): ``count``, ``sum``, ``avg`` (whole numbers and decimals), ``min``
    or ``max`` over the rows of the key whose ``order`` is between its own less
    ``preceding`` and its own plus ``following`` (SQL texts: ``"5000"``,
    ``"INTERVAL 1 HOUR"``, ``"0"``), both included. Null keys are a group, rows
    with a null order are each other's frame, as in SQL."""
    base = stored(df.withColumn("__id", F.monotonically_increasing_id()), "frame-rows")
    summed = {n: o for n, o in outputs.items() if o[0] in ("count", "sum", "avg")}
    haloed = {n: o for n, o in outputs.items() if o[0] in ("min", "max")}
    unknown = sorted(o[0] for n, o in outputs.items() if n not in summed and n not in haloed)
    if unknown:
        raise ValueError(f"unknown functions {unknown}; known are count, sum, avg, min, max")
    v = "`" + order.replace("`", "``") + "`"
    low, high = F.expr(f"{v} - {preceding}" if preceding != "0" else v), F.expr(f"{v} + {following}" if following != "0" else v)
    out = base
    if summed:
        measures, results = _measures(df, summed)
        data = base.select(*_keyed(keys), _name(order).alias("__v"), F.col("__id").alias("__row"), *[c.alias(n) for n, c in measures.items()])
        probes = base.select(*_keyed(keys), low.alias("__v"), F.lit(False).alias("__after"), "__id", F.lit(0).alias("__side")).union(
            base.select(*_keyed(keys), high.alias("__v"), F.lit(True).alias("__after"), "__id", F.lit(1).alias("__side"))
        )
        out = _differences(base.withColumn("__own", F.col("__id")), data, probes, keys, measures, results).withColumnRenamed("__own", "__id")
    if haloed:
        out = out.join(_halo(base, keys, order, low, high, preceding, following, haloed), "__id")
    return out.select(*[_name(c) for c in df.columns], *outputs)


def _halo(base: DataFrame, keys: list[str], order: str, low: Column, high: Column, preceding: str, following: str, outputs: dict[str, tuple]) -> DataFrame:
    """(__id, outputs): frames run inside chunks that hold, beside their own
    rows, the rows of other chunks that their frames reach."""
    names = _names(keys)
    taken = [_name(a).alias(f"__x{i}") for i, (_, a) in enumerate(outputs.values())]
    own = _chunked(base.select(*_keyed(keys), _name(order).alias("__v"), "__id", low.alias("__low"), high.alias("__high"), *taken), names, ["__v", "__id"])
    # a key's pieces are numbered in order; edges say how far their frames reach
    edges = own.where("__v is not null").groupBy("__chunk", *names).agg(
        F.min("__v").alias("first"), F.max("__v").alias("last"), F.min("__low").alias("low"), F.max("__high").alias("high")
    )
    per_key = Window.partitionBy(*names)
    edges = stored(edges.withColumn("piece", F.row_number().over(per_key.orderBy("__chunk"))), "chunk-edges")
    # pieces that end before the reach, and those that begin within it or before
    asked = edges.select(*names, F.col("last").alias("v"), F.lit(1).alias("kind"), F.lit(None).cast("int").alias("__chunk")).union(
        edges.select(*names, F.col("low").alias("v"), F.lit(0).alias("kind"), "__chunk")
    )
    upto = per_key.orderBy("v", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    skipped = asked.withColumn("from", F.sum("kind").over(upto) + 1).where("kind = 0").drop("v", "kind")
    asked = edges.select(*names, F.col("first").alias("v"), F.lit(0).alias("kind"), F.lit(None).cast("int").alias("__chunk")).union(
        edges.select(*names, F.col("high").alias("v"), F.lit(1).alias("kind"), "__chunk")
    )
    met = asked.withColumn("to", F.sum(1 - F.col("kind")).over(upto)).where("kind = 1").drop("v", "kind")
    pairs = (
        edges.alias("e").join(skipped.alias("s"), F.expr(_same("e", "s", ["__chunk", *names]))).join(met.alias("m"), F.expr(_same("e", "m", ["__chunk", *names])))
        .select(*[F.col(f"e.{n}") for n in names], F.col("e.__chunk").alias("target"), "e.low", "e.high", F.explode(F.sequence("s.from", "m.to")).alias("piece"))
    )
    sources = pairs.alias("p").join(edges.alias("e"), F.expr(_same("p", "e", ["piece", *names]) + " and p.target <> e.__chunk")).select(
        *[F.col(f"p.{n}") for n in names], "e.__chunk", "p.target", "p.low", "p.high"
    )
    halo = own.alias("o").join(sources.alias("s"), F.expr(_same("o", "s", ["__chunk", *names]) + " and o.__v between s.low and s.high"))
    halo = halo.select(*[F.col(f"o.{n}") for n in names], "o.__v", F.lit(None).cast("long").alias("__id"), F.col("s.target").alias("__chunk"), *[F.col(f"o.__x{i}") for i in range(len(outputs))])
    both = own.select(*names, "__v", "__id", "__chunk", *[f"__x{i}" for i in range(len(outputs))]).unionByName(halo)
    ends = [f"{x} {word}" if x != "0" else "CURRENT ROW" for x, word in ((preceding, "PRECEDING"), (following, "FOLLOWING"))]
    frame = f"OVER (PARTITION BY {', '.join(['__chunk', *names])} ORDER BY __v RANGE BETWEEN {ends[0]} AND {ends[1]})"
    found = both.selectExpr("__id", "__v", *[f"{kind}(__x{i}) {frame} AS `{n}`" for i, (n, (kind, _)) in enumerate(outputs.items())])
    done = found.where("__id is not null and __v is not null").select("__id", *outputs)
    # rows without an order: the group of them, as one aggregate joined back
    alone = own.where("__v is null")
    summary = alone.groupBy(*names).agg(*[(F.min if kind == "min" else F.max)(f"__x{i}").alias(n) for i, (n, (kind, _)) in enumerate(outputs.items())])
    rest = alone.alias("a").join(summary.alias("b"), F.expr(_same("a", "b", names))).select("a.__id", *[F.col(f"b.{n}") for n in outputs])
    return done.unionByName(rest)


def split_interval(left: DataFrame, right: DataFrame, keys: list[str], left_on: str, right_on: str, start: str, end: str, outputs: dict[str, tuple]) -> DataFrame:
    """``left`` with one more column for each of ``outputs`` (name -> (``count``,
    ``sum`` or ``avg``, column of ``right``)) over the rows of ``right`` with
    equal keys whose ``right_on`` is at least ``left_on + start`` and below
    ``left_on + end`` (SQL texts, as ``"-INTERVAL 2 HOURS"``, ``"0"``). Null
    keys and times meet nothing."""
    base = stored(left.withColumn("__id", F.monotonically_increasing_id()), "interval-rows")
    measures, results = _measures(right, outputs)
    told = right.where(" and ".join(f"{c} is not null" for c in [*[f"`{k}`" for k in keys], f"`{right_on}`"]))
    data = stored(
        told.select(*_keyed(keys), _name(right_on).alias("__v"), F.monotonically_increasing_id().alias("__row"), *[c.alias(n) for n, c in measures.items()]),
        "interval-events",
    )
    own = "`" + left_on.replace("`", "``") + "`"
    probes = None
    for side, offset in enumerate((start, end)):
        at = F.expr(own if offset == "0" else f"{own} + ({offset})")
        part = base.select(*_keyed(keys), at.alias("__v"), F.lit(False).alias("__after"), "__id", F.lit(side).alias("__side"))
        probes = part if probes is None else probes.union(part)
    return _differences(base, data, probes, keys, measures, results)


def split_asof(left: DataFrame, right: DataFrame, keys: list[str], left_on: str, right_on: str, take: dict[str, str], equal: bool = True) -> DataFrame:
    """``left`` with columns ``take`` (name -> column of ``right``) of the last
    row of ``right`` with equal keys and a ``right_on`` not after ``left_on``
    (before it, unless ``equal``); null where there is none. Of several at one
    time the one with the largest taken values counts. Null keys and times
    meet nothing."""
    base = stored(left.withColumn("__id", F.monotonically_increasing_id()), "asof-rows")
    names = _names(keys)
    told = right.select(*_keyed(keys), _name(right_on).alias("__v"), F.struct(*[_name(c).alias(n) for n, c in take.items()]).alias("__m"))
    told = told.dropna(subset=[*names, "__v"]).groupBy(*names, "__v").agg(F.max("__m").alias("__m"))
    kind = 1 if equal else -1
    told = told.select(*names, "__v", F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__id"), "__m")
    asked = base.select(*_keyed(keys), _name(left_on).alias("__v"), F.lit(kind).alias("__kind"), "__id", F.lit(None).cast(told.schema["__m"].dataType).alias("__m"))
    both = stored(told.unionByName(asked), "asof-union")
    rows = _chunked(both, names, ["__v", "__kind", "__id"])
    upto = Window.partitionBy("__chunk", *names).orderBy(F.col("__v").asc_nulls_first(), "__kind", "__id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("__near", F.last("__m", ignorenulls=True).over(upto)).where("__kind <> 0")
    pieces = rows.where("__kind = 0").groupBy("__chunk", *names).agg(F.max_by("__m", "__v").alias("__last"))
    pieces = rows.select("__chunk", *names).distinct().alias("c").join(pieces.alias("p"), F.expr(_same("c", "p", ["__chunk", *names])), "left").select(
        "c.__chunk", *[F.col(f"c.{n}") for n in names], "p.__last"
    )
    earlier = Window.partitionBy(*names).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.withColumn("__carried", F.last("__last", ignorenulls=True).over(earlier)).drop("__last")
    found = local.alias("l").join(carried.alias("r"), F.expr(_same("l", "r", ["__chunk", *names])), "left").select(
        "l.__id", F.coalesce("l.__near", "r.__carried").alias("__m")
    )
    out = base.join(found, "__id")
    return out.select(*[_name(c) for c in left.columns], *[F.col("__m").getField(n).alias(n) for n in take])


def split_percentile(df: DataFrame, column: str, share: float) -> DataFrame:
    """One row (value): what ``percentile`` gives for a column of numbers, from
    the counts of its values in chunks instead of one task's map of them all."""
    value = _name(column).cast("double")
    counted = df.where(value.isNotNull()).groupBy(F.lit(0).alias("__k0"), value.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    values = stored(counted, "value-counts")
    upto = _accumulated(_chunked(values, ["__k0"], ["__v"]), ["__k0"], ["__v"], {"__upto": F.col("__n")}, "true")
    at = values.agg((F.lit(float(share)) * (F.sum("__n") - 1)).alias("__at"))
    ends = upto.crossJoin(F.broadcast(at)).agg(
        F.min(F.when(F.col("__upto") > F.floor("__at"), F.col("__v"))).alias("low"),
        F.min(F.when(F.col("__upto") > F.ceil("__at"), F.col("__v"))).alias("high"), F.max("__at").alias("at"),
    )
    between = (F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high")
    return ends.select(F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between).alias("value"))


def _extremes(items: DataFrame, asks: DataFrame, names: list[str], kinds: dict[str, str]) -> DataFrame:
    """(__id, measures): for each of ``asks`` (keys, __id, __from, __to) the
    ``min`` or ``max`` (``kinds``) of each measure of ``items`` (keys, __rank,
    measures) with ranks from ``__from`` to before ``__to``. A span is the tail
    of its first cell, the head of its last one and whole cells between, which
    are the items of the next level; in a cell of its own it meets at most
    ``LEVEL_FAN`` items. So a level costs its items and two lookups an ask."""
    least = {x: F.min if kind == "min" else F.max for x, kind in kinds.items()}
    found, cell = None, f"DIV {LEVEL_FAN}"
    while True:
        cells = items.withColumn("__cell", F.expr(f"__rank {cell}"))
        asked = asks.withColumns({"__a": F.expr(f"__from {cell}"), "__b": F.expr(f"(__to - 1) {cell}")})
        within = cells.alias("c").join(
            asked.where("__a = __b").alias("q"), F.expr(_same("c", "q", names) + " and c.__cell = q.__a and c.__rank >= q.__from and c.__rank < q.__to")
        ).groupBy("q.__id").agg(*[f(f"c.{x}").alias(x) for x, f in least.items()])
        group = Window.partitionBy(*names, "__cell")
        upto = (Window.unboundedPreceding, Window.currentRow)
        runs = cells.select(
            *names, "__rank", *[f(x).over(group.orderBy("__rank").rowsBetween(*upto)).alias(f"__head_{x}") for x, f in least.items()],
            *[f(x).over(group.orderBy(F.desc("__rank")).rowsBetween(*upto)).alias(f"__tail_{x}") for x, f in least.items()],
        )
        spread = asked.where("__a < __b")
        ends = spread.select(*names, "__id", F.explode(F.array(F.struct(F.lit(True).alias("first"), F.col("__from").alias("at")), F.struct(F.lit(False).alias("first"), (F.col("__to") - 1).alias("at")))).alias("end"))
        sides = runs.alias("r").join(ends.alias("q"), F.expr(_same("r", "q", names) + " and r.__rank = q.end.at")).select(
            "q.__id", *[F.when(F.col("q.end.first"), F.col(f"r.__tail_{x}")).otherwise(F.col(f"r.__head_{x}")).alias(x) for x in kinds]
        )
        level = within.unionByName(sides)
        found = level if found is None else found.unionByName(level)
        asks = stored(spread.select(*names, "__id", (F.col("__a") + 1).alias("__from"), F.col("__b").alias("__to")).where("__from < __to"), "band-asks")
        if asks.isEmpty():
            return found.groupBy("__id").agg(*[f(x).alias(x) for x, f in least.items()])
        items = stored(cells.groupBy(*names, F.col("__cell").alias("__rank")).agg(*[f(x).alias(x) for x, f in least.items()]), "band-level")


def band_join(
    points: DataFrame, bands: DataFrame, value: str, low: str, high: str, keys: list[str] | None = None, outputs: dict[str, tuple] | None = None
) -> DataFrame:
    """All columns of both sides, for each row of ``points`` and ``bands`` with
    equal ``keys`` (columns of both, given once in the result) and ``low <=
    value < high``. Null keys, values and bounds meet nothing.

    With ``outputs`` (name -> (function, column of ``points``); functions and
    types as in ``split_range_frame``) the pairs are not made: one row for each
    row of ``bands`` that meets any, its columns and the aggregates over the
    rows of ``points`` that it meets."""
    keys, outputs = keys or [], outputs or {}
    clash = set(points.columns) & set(bands.columns) - set(keys)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    kinds = {f"__x{i}": kind for i, (kind, *_) in enumerate(outputs.values()) if kind in ("min", "max")}
    measures, results = _measures(points, {n: o for n, o in outputs.items() if o[0] not in ("min", "max")})
    names = _names(keys)
    rows = stored(points.dropna(subset=[*keys, value]).withColumn("__id", F.monotonically_increasing_id()), "band-points")
    spans = stored(bands.dropna(subset=[*keys, low, high]).withColumn("__band", F.monotonically_increasing_id()), "bands")
    told = rows.select(
        *_keyed(keys), _name(value).alias("__v"), F.lit(1).alias("__kind"), "__id", F.lit(0).alias("__side"), F.lit(1).cast("long").alias("__one"), *[c.alias(n) for n, c in measures.items()]
    )
    both = told
    for side, bound in enumerate((low, high)):
        asked = spans.select(
            *_keyed(keys), _name(bound).alias("__v"), F.lit(0).alias("__kind"), F.col("__band").alias("__id"), F.lit(side).alias("__side"),
            *[F.lit(None).cast(told.schema[m].dataType).alias(m) for m in ["__one", *measures]],
        )
        both = both.unionByName(asked)
    chunks = _chunked(both, names, ["__v", "__kind", "__id", "__side"])
    sums = {"__rank": F.col("__one"), **{f"__p_{m[2:]}": F.col(m) for m in measures}}
    ranked = _accumulated(chunks, names, ["__v", "__kind", "__id", "__side"], sums, "true").drop("__v", "__one", "__chunk", *measures)
    ranked = stored(ranked, "band-ranks")
    places = ranked.where("__kind = 1").select("__id", (F.col("__rank") - 1).alias("__rank"))
    edges = ranked.where("__kind = 0").groupBy("__id", *names).agg(
        F.max(F.expr("if(__side = 0, __rank, null)")).alias("__from"), F.max(F.expr("if(__side = 1, __rank, null)")).alias("__to"),
        *[F.sum(F.when(F.col("__side") == 1, F.col(f"__p_{m[2:]}")).otherwise(-F.col(f"__p_{m[2:]}"))).alias(f"__d_{m[2:]}") for m in measures],
    ).where("__from < __to")
    if outputs:
        met = spans.join(edges.drop(*names), F.expr("__band = __id")).drop("__band")
        if kinds:
            taken = [_name(o[1]).alias(f"__x{i}") for i, o in enumerate(outputs.values()) if f"__x{i}" in kinds]
            items = stored(rows.join(places, "__id").select(*_keyed(keys), "__rank", *taken), "band-items")
            met = met.join(_extremes(items, edges.select(*names, "__id", "__from", "__to"), names, kinds), "__id", "left")
        made = [results[n].alias(n) if n in results else F.col(f"__x{i}").alias(n) for i, n in enumerate(outputs)]
        return met.select(*[_name(c) for c in bands.columns], *made)
    edges = edges.drop(*names)
    cell = f"DIV {CELL_ROWS}"
    held = rows.join(places, "__id").withColumn("__cell", F.expr(f"__rank {cell}")).drop("__id")
    copied = spans.join(edges, F.expr("__band = __id")).drop("__id", "__band").withColumn("__cell", F.explode(F.expr(f"sequence(__from {cell}, (__to - 1) {cell})")))
    copied = copied.withColumnsRenamed(dict(zip(keys, names)))
    match = F.expr(" and ".join(["p.__cell = b.__cell", "p.__rank >= b.__from", "p.__rank < b.__to", *[f"p.`{k}` = b.{n}" for k, n in zip(keys, names)]]))
    return held.alias("p").join(copied.alias("b"), match).select(
        *[F.col(f"p.`{c}`") for c in points.columns], *[F.col(f"b.`{c}`") for c in bands.columns if c not in keys]
    )
