"""Aggregates made once at the finest level and combined from partial states.

Spark copies every row for each sliding window it lies in, and for each
grouping set of a ``CUBE`` or ``GROUPING SETS``, before it aggregates. Here the
rows are aggregated once, at the finest level that all results share, and the
copies are made of those states:

* ``sliding_panes``: panes of the greatest common step of width and slide,
  each then copied to the windows it lies in;
* ``lattice``: one aggregate by all dimensions; every smaller grouping set is
  derived from the smallest set already made that holds it.

Functions (``(name of the result) -> (function, column)``): ``count`` (of rows
for ``"*"``), ``sum``, ``avg``, ``min``, ``max`` and ``approx_distinct``, whose
state is a HyperLogLog sketch. A count of distinct values has no bounded state;
put its column among the dimensions, or use the approximate one.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordered import stored

FUNCTIONS = ("count", "sum", "avg", "min", "max", "approx_distinct")


def _name(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _states(outputs: dict[str, tuple[str, str]]) -> dict[str, tuple[Column, Column]]:
    """State columns: name -> (made from rows, merged from states)."""
    out: dict[str, tuple[Column, Column]] = {}
    for name, (kind, column) in outputs.items():
        if kind not in FUNCTIONS:
            raise ValueError(f"unknown function {kind!r}; known are {FUNCTIONS}")
        col = F.lit(1) if column == "*" else _name(column)
        if kind in ("count", "avg"):
            out[f"__n_{name}"] = (F.count(col), F.sum(f"__n_{name}"))
        if kind in ("sum", "avg"):
            out[f"__s_{name}"] = (F.sum(col), F.sum(f"__s_{name}"))
        if kind in ("min", "max"):
            f = F.min if kind == "min" else F.max
            out[f"__m_{name}"] = (f(col), f(f"__m_{name}"))
        if kind == "approx_distinct":
            out[f"__h_{name}"] = (F.hll_sketch_agg(col), F.hll_union_agg(f"__h_{name}"))
    return out


def _results(df: DataFrame, outputs: dict[str, tuple[str, str]]) -> list[Column]:
    """The results from states, in the types that SQL gives them."""
    made = []
    for name, (kind, column) in outputs.items():
        if kind == "count":
            out = F.coalesce(f"__n_{name}", F.lit(0)).cast("long")
        elif kind == "sum":
            out = F.col(f"__s_{name}").cast(df.select(F.sum(_name(column))).schema[0].dataType)
        elif kind == "avg":
            total, n = F.col(f"__s_{name}"), F.nullif(F.col(f"__n_{name}"), F.lit(0))
            kind_of = df.select(F.avg(_name(column))).schema[0].dataType
            own = df.select(F.sum(_name(column))).schema[0].dataType
            out = (total.cast(own) / n if isinstance(kind_of, T.DecimalType) else total.cast("double") / n).cast(kind_of)
        elif kind == "approx_distinct":
            out = F.coalesce(F.hll_sketch_estimate(f"__h_{name}"), F.lit(0)).cast("long")
        else:
            out = F.col(f"__m_{name}")
        made.append(out.alias(name))
    return made


def lattice(df: DataFrame, dims: list[str], sets: list[tuple[str, ...]], outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """(dims, grouping_id, outputs) of all grouping sets; dimensions that a set
    lacks are null, and ``grouping_id`` has a bit for each of them, the last
    dimension's the lowest, as in SQL. A set given twice counts twice; the empty
    set has one row, also over an empty table."""
    states = _states(outputs)
    wrong = sorted({d for s in sets for d in s} - set(dims))
    if wrong:
        raise ValueError(f"not dimensions: {wrong}")
    keys = {d: f"__d{i}" for i, d in enumerate(dims)}
    finest = stored(df.groupBy(*[_name(d).alias(keys[d]) for d in dims]).agg(*[c.alias(n) for n, (c, _) in states.items()]), "lattice")
    made: dict[frozenset, DataFrame] = {frozenset(dims): finest}
    for want in sorted({frozenset(s) for s in sets}, key=lambda s: (-len(s), sorted(s))):
        if want not in made:
            parent = made[min((s for s in made if s >= want), key=lambda s: (len(s), sorted(s)))]
            made[want] = parent.groupBy(*[keys[d] for d in dims if d in want]).agg(*[c.alias(n) for n, (_, c) in states.items()])
    out = None
    for s in sets:
        part = made[frozenset(s)]
        shown = [F.col(keys[d]).alias(d) if d in s else F.lit(None).cast(df.schema[d].dataType).alias(d) for d in dims]
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in s)
        part = part.select(*shown, F.lit(bits).cast("long").alias("grouping_id"), *_results(df, outputs))
        out = part if out is None else out.unionByName(part)
    return out


def cube_sets(dims: list[str]) -> list[tuple[str, ...]]:
    return [tuple(d for i, d in enumerate(dims) if bits >> i & 1) for bits in range(1 << len(dims))]


def rollup_sets(dims: list[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def sliding_panes(df: DataFrame, ts: str, width: int, slide: int, keys: list[str], outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """(win_start, win_end, keys, outputs) of the windows of ``width`` seconds that
    start at each multiple of ``slide`` seconds and have a row. Rows without a
    time are in none, as in Spark's ``window``."""
    if not 0 < slide <= width:
        raise ValueError("0 < slide <= width")
    step = gcd(width, slide)
    states = _states(outputs)
    names = [f"__d{i}" for i in range(len(keys))]
    panes = df.groupBy(F.window(_name(ts), f"{step} seconds").alias("__w"), *[_name(k).alias(n) for k, n in zip(keys, names)]).agg(
        *[c.alias(n) for n, (c, _) in states.items()]
    )
    at = F.col("__w.start")
    ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    zero = "TIMESTAMP_NTZ '1970-01-01 00:00:00'" if ntz else "TIMESTAMP '1970-01-01 00:00:00Z'"
    # seconds from the pane back to the starts of the windows that hold it
    back = F.expr(f"pmod(timestampdiff(SECOND, {zero}, __w.start), {slide})")
    pane = panes.withColumn("__back", F.explode(F.sequence(back, F.lit(width - step).cast("long"), F.lit(slide).cast("long"))) if slide < width else back)
    pane = pane.withColumn("win_start", at - F.expr("make_dt_interval(0, 0, 0, __back)")).drop("__w", "__back")
    merged = pane.groupBy("win_start", *names).agg(*[c.alias(n) for n, (_, c) in states.items()])
    return merged.select(
        "win_start", (F.col("win_start") + F.expr(f"INTERVAL {width} SECONDS")).alias("win_end"), *[F.col(n).alias(k) for n, k in zip(names, keys)], *_results(df, outputs)
    )
