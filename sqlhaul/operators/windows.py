"""Window functions whose tasks do not grow with the busiest key.

A plain window puts all rows of a key in one ordered group. Here the rows are
range-partitioned by key and order together, so a key with many rows lies in
many partitions ("chunks", whose size the data and the number of shuffle
partitions set, not constants); rows that are equal in key and order stay
together. Each function is computed inside (chunk, key), then shifted by a
summary with one row for each chunk and key: the rows, distinct order values
and sums of the key's earlier chunks, and the values at their edges. The
numbered rows are written to the shared workspace once, so both branches see
the same chunks and a lost executor costs a retry only.

The largest group holds one chunk's rows; the summary's largest group has a row
for each chunk that the key lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .ordered import chunk_count, stored

FUNCTIONS = (
    "row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile", "lag", "lead", "running_sum", "first_value", "last_value", "nth_value",
)


def split_window(df: DataFrame, keys: list[str], order: list[Column], outputs: dict[str, tuple]) -> DataFrame:
    """``df`` with one more column for each of ``outputs``: name -> (function,
    arguments). ``ntile`` takes a number; ``running_sum`` (ties share a value, as
    in SQL) a column name; ``lag`` and ``lead`` a column name and a distance (1
    where it is not given); ``first_value``, ``last_value`` (a column name) and
    ``nth_value`` (a column name and a number from 1) are those of the whole
    group, from its first to its last row. Null keys are a group, as in SQL."""
    unknown = sorted(f for f, *_ in outputs.values() if f not in FUNCTIONS)
    if unknown:
        raise ValueError(f"unknown functions {unknown}; known are {FUNCTIONS}")
    spark = df.sparkSession
    base = df.repartitionByRange(chunk_count(spark, df.count()), *[F.col(k) for k in keys], *order).withColumn("__chunk", F.spark_partition_id())
    group = Window.partitionBy("__chunk", *keys)
    inside = group.orderBy(*order)
    upto = inside.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    local = {"__rn": F.row_number().over(inside).cast("long"), "__rank": F.rank().over(inside).cast("long"), "__dense": F.dense_rank().over(inside).cast("long")}
    edge = [F.count(F.lit(1)).alias("__n"), F.max("__dense").alias("__d")]
    for name, (kind, *arg) in outputs.items():
        if kind == "cume_dist":
            local["__upto"] = F.count(F.lit(1)).over(upto)
        elif kind in ("lag", "lead"):
            local[f"__{kind}_{name}"] = (F.lag if kind == "lag" else F.lead)(F.col(arg[0]), _distance(arg)).over(inside)
            edge.append((F.max_by if kind == "lag" else F.min_by)(F.col(arg[0]), F.col("__rn")).alias(f"__edge_{name}"))
        elif kind == "running_sum":
            local[f"__sum_{name}"] = F.sum(F.col(arg[0])).over(upto)
            edge.append(F.sum(F.col(arg[0])).alias(f"__edge_{name}"))
    path = scratch_dir(spark, "split-window")
    numbered = base.withColumns(local)
    numbered.write.parquet(path)
    numbered = spark.read.schema(numbered.schema).parquet(path)

    names = [f"__key{i}" for i in range(len(keys))]
    pieces = numbered.groupBy("__chunk", *keys).agg(*edge).withColumnsRenamed(dict(zip(keys, names)) | {"__chunk": "__piece"})
    chunks = Window.partitionBy(*names).orderBy("__piece")
    earlier = chunks.rowsBetween(Window.unboundedPreceding, -1)
    known = {
        "__before": F.coalesce(F.sum("__n").over(earlier), F.lit(0)), "__dense_before": F.coalesce(F.sum("__d").over(earlier), F.lit(0)),
        "__total": F.sum("__n").over(Window.partitionBy(*names)),
    }
    for name, (kind, *_) in outputs.items():
        if kind in ("lag", "lead"):
            known[f"__near_{name}"] = (F.lag if kind == "lag" else F.lead)(f"__edge_{name}").over(chunks)
        elif kind == "running_sum":
            known[f"__near_{name}"] = F.sum(f"__edge_{name}").over(earlier)
    summary = pieces.withColumns(known)
    summary = _with_values(numbered, summary, keys, names, outputs)
    match = F.col("__chunk") == F.col("__piece")
    for k, n in zip(keys, names):
        match = match & F.col(k).eqNullSafe(F.col(n))
    row, total = F.col("__before") + F.col("__rn"), F.col("__total")
    rank = F.col("__before") + F.col("__rank")
    placed = numbered.join(summary, match)
    far = {name: (kind, arg[0], _distance(arg)) for name, (kind, *arg) in outputs.items() if kind in ("lag", "lead") and _distance(arg) > 1}
    if far:
        placed = _with_far(placed, keys, names, far)
    made = []
    for name, (kind, *arg) in outputs.items():
        if kind in ("first_value", "last_value", "nth_value"):
            out = F.col(f"__value_{name}")
        elif name in far:
            inside_chunk = F.col("__rn") > _distance(arg) if kind == "lag" else F.col("__rn") <= F.col("__n") - _distance(arg)
            out = F.when(inside_chunk, F.col(f"__{kind}_{name}")).otherwise(F.col(f"__far_{name}"))
        elif kind == "row_number":
            out = row
        elif kind == "rank":
            out = rank
        elif kind == "dense_rank":
            out = F.col("__dense_before") + F.col("__dense")
        elif kind == "percent_rank":
            out = F.when(total == 1, F.lit(0.0)).otherwise((rank - 1).cast("double") / (total - 1).cast("double"))
        elif kind == "cume_dist":
            out = (F.col("__before") + F.col("__upto")).cast("double") / total.cast("double")
        elif kind == "ntile":
            # the first (total mod k) tiles hold one row more
            k = F.lit(int(arg[0])).cast("long")
            small, more = F.expr(f"__total DIV {int(arg[0])}"), total % k
            wide = more * (small + 1)
            out = F.when(row <= wide, F.floor((row - 1) / (small + 1)) + 1).otherwise(F.floor((row - 1 - more) / F.greatest(small, F.lit(1))) + 1)
        elif kind == "lag":
            out = F.when(F.col("__rn") == 1, F.col(f"__near_{name}")).otherwise(F.col(f"__lag_{name}"))
        elif kind == "lead":
            out = F.when(F.col("__rn") == F.col("__n"), F.col(f"__near_{name}")).otherwise(F.col(f"__lead_{name}"))
        else:
            here, there = F.col(f"__sum_{name}"), F.col(f"__near_{name}")
            out = F.when(there.isNull(), here).when(here.isNull(), there).otherwise(here + there)
        made.append(out.alias(name))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *made)


def _distance(arg: list) -> int:
    k = int(arg[1]) if len(arg) > 1 else 1
    if k < 1:
        raise ValueError(f"a distance of {k}")
    return k


def _with_values(numbered: DataFrame, summary: DataFrame, keys: list[str], names: list[str], outputs: dict[str, tuple]) -> DataFrame:
    """``summary`` with ``__value_<output>``: the value at one place of the
    group. It is looked for only in rows that can stand there."""
    for name, (kind, *arg) in outputs.items():
        if kind not in ("first_value", "last_value", "nth_value"):
            continue
        place = {"first_value": F.lit(1), "last_value": F.col("__total")}.get(kind) if kind != "nth_value" else F.lit(_distance(arg))
        rows = numbered if kind == "last_value" else numbered.where(F.col("__rn") <= place)
        here = (F.col("__chunk") == F.col("__piece")) & (F.col("__before") + F.col("__rn") == place)
        if kind == "last_value":
            here = here & (F.col("__rn") == F.col("__n"))
        for k, n in zip(keys, names):
            here = here & F.col(k).eqNullSafe(F.col(n))
        edges = summary.select("__piece", "__before", "__total", "__n", *names)
        found = rows.join(edges, here).select(*[F.col(n).alias(f"__of_{n}") for n in names], F.col(arg[0]).alias(f"__value_{name}"))
        same = F.lit(True)
        for n in names:
            same = same & F.col(n).eqNullSafe(F.col(f"__of_{n}"))
        summary = summary.join(found, same, "left").drop(*[f"__of_{n}" for n in names])
    return summary


def _with_far(placed: DataFrame, keys: list[str], names: list[str], far: dict[str, tuple[str, str, int]]) -> DataFrame:
    """``placed`` with ``__far_<output>``: values from other chunks. A value that
    lies k rows away in another chunk is among the k last (first) rows that a
    chunk has of the key, and is asked for by the k first (last) ones: these
    edges meet by the number of the row within its key."""
    placed = stored(placed, "split-window-far")
    most = max(k for _, _, k in far.values())
    rn, n, row = F.col("__rn"), F.col("__n"), F.col("__before") + F.col("__rn")
    at_edge = (rn <= most) | (rn > n - most)
    inner = placed.where(~at_edge)
    outer = placed.where(at_edge)
    for name, (kind, column, k) in far.items():
        kept = rn > n - k if kind == "lag" else rn <= k
        buffer = placed.where(kept).select(*[F.col(x).alias(f"__of_{x}") for x in names], row.alias("__at"), F.col(column).alias(f"__far_{name}"))
        same = F.col("__at") == (row - k if kind == "lag" else row + k)
        for x in names:
            same = same & F.col(x).eqNullSafe(F.col(f"__of_{x}"))
        outer = outer.join(buffer, same, "left").drop("__at", *[f"__of_{x}" for x in names])
        inner = inner.withColumn(f"__far_{name}", F.lit(None).cast(placed.schema[column].dataType))
    return inner.unionByName(outer)


def split_sessions(df: DataFrame, keys: list[str], ts: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each key: rows at most ``gap`` apart, one after the other.
    (keys, s_start, s_end, n_events), ``s_end`` the last row's time and the gap."""
    span = F.expr(f"INTERVAL {gap}")
    step = split_window(df.select(*keys, ts), keys, [F.col(ts)], {"__prev": ("lag", ts)})
    step = step.withColumn("__new", F.when(F.col("__prev") >= F.col(ts) - span, 0).otherwise(1)).drop("__prev")
    numbered = split_window(step, keys, [F.col(ts)], {"__session": ("running_sum", "__new")})
    return numbered.groupBy(*keys, "__session").agg(
        F.min(ts).alias("s_start"), (F.max(ts) + span).alias("s_end"), F.count(F.lit(1)).alias("n_events")
    ).drop("__session")
