"""Mixing sources to target weights by hierarchical budgeting.

The levels (say domain, language, source) form a tree. A budget of tokens goes
down it in proportion to the weights of siblings; a subtree can take at most
its tokens times ``max_epochs``. What a child cannot take goes to its siblings;
only what they cannot take together leaves their parent, for the parent's
siblings, and so on up.

A leaf that gets ``e`` whole epochs and a rest gives every document ``e`` times,
and of epoch ``e + 1`` the prefix, in that epoch's own seeded order, that reaches
the rest: a document is in it while the tokens before it are fewer than the
rest. The prefix is found without ordering a leaf: sums over 65,536 ranges of
the order's hash name the one range in which it ends, and only that range's
documents are put in order.

The tree is a table: budgets go down level by level as grouped sums and running
sums over chunks (``allocate_table``; ``allocate`` is the same on one machine),
and a leaf's quota meets its documents by a join. That is a broadcast, and the
documents are read in place, where the counted leaves are at most
``BROADCAST_LEAVES``; with more it is a shuffle. Nothing but three sums passes
through the driver.

Defined results: a null level value is a child of its own; null and empty texts
have no tokens, are in every whole epoch, and in the prefix by the same rule;
rows that are equal in id and text are counted and may stand for each other;
weights that are
not given count ``default_weight``; a leaf of weight 0 gives nothing; an empty
table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import save
from sqlhaul.operators.windows import split_window

#: Leaves (and keys of the ranges in which prefixes end) up to which their
#: table is broadcast, about 100 bytes each; the same joins shuffle above that.
BROADCAST_LEAVES = 100_000
RANGES_BITS = 16


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def share_out(budget: float, weights: list[float], most: list[float]) -> list[float]:
    """``budget`` in proportion to ``weights``, none above its ``most``; what the
    full ones leave goes to the others in proportion."""
    got = [0.0] * len(weights)
    open_ = [i for i, w in enumerate(weights) if w > 0 and most[i] > 0]
    left = min(budget, sum(most[i] for i in open_))
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= most[i]]
        if not full:
            for i in open_:
                got[i] = left * weights[i] / total
            break
        for i in full:
            got[i] = most[i]
        left -= sum(most[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return got


def allocate(leaves: dict[tuple, int], weight: Callable[[tuple], float], budget: float, max_epochs: float) -> dict[tuple, float]:
    """Tokens for each leaf (a path of level values) from its tokens at hand."""
    capacity: dict[tuple, float] = {}
    children: dict[tuple, set] = {}
    for path, tokens in leaves.items():
        usable = tokens * max_epochs
        if any(weight(path[: i + 1]) <= 0 for i in range(len(path))):
            usable = 0.0
        for i in range(len(path) + 1):
            capacity[path[:i]] = capacity.get(path[:i], 0.0) + usable
            if i:
                children.setdefault(path[: i - 1], set()).add(path[:i])
    got = {(): min(float(budget), capacity.get((), 0.0))}
    todo = [()]
    while todo:
        node = todo.pop()
        kids = sorted(children.get(node, ()), key=lambda p: tuple((x is None, str(x)) for x in p))
        for kid, x in zip(kids, share_out(got[node], [weight(k) for k in kids], [capacity[k] for k in kids])):
            got[kid] = x
            todo.append(kid)
    return {p: got.get(p, 0.0) for p in leaves}


def _weighted(leaves: DataFrame, weights: dict[tuple, float], depth: int, default_weight: float) -> DataFrame:
    """``leaves`` with ``w1``, ``w2``, ...: the weights along their paths. The
    given weights are as many as the caller has written down; as an Arrow table
    they are a local relation, which starts no Python workers on the executors."""
    spark = leaves.sparkSession
    for i in range(1, depth + 1):
        own = {p: float(w) for p, w in weights.items() if len(p) == i}
        if not own:
            leaves = leaves.withColumn(f"w{i}", F.lit(float(default_weight)))
            continue
        given = spark.createDataFrame(pa.table({f"p{i}": pa.array(list(map(list, own)), pa.list_(pa.string())), f"g{i}": pa.array(list(own.values()), pa.float64())}))
        leaves = leaves.join(F.broadcast(given), F.slice("path", 1, i) == F.col(f"p{i}"), "left").withColumn(f"w{i}", F.coalesce(f"g{i}", F.lit(float(default_weight))))
    return leaves.drop(*[f"{c}{i}" for c in "pg" for i in range(1, depth + 1)])


def share_out_table(children: DataFrame) -> DataFrame:
    """(node, got) of (parent, node, w, most, budget): ``share_out`` for every
    parent at once. In the order of ``most / w``, the children that are full come
    first; the others share what those leave in proportion to their weights.
    The sums run over chunks of the order, so a parent may have any number of
    children."""
    open_ = children.where("w > 0 and most > 0").withColumn("t", F.col("most") / F.col("w"))
    ordered = split_window(open_, ["parent"], [F.col("t"), F.col("node")], {"most_upto": ("running_sum", "most"), "w_upto": ("running_sum", "w")})
    total = open_.groupBy("parent").agg(F.sum("w").alias("w_all"), F.sum("most").alias("most_all")).withColumnRenamed("parent", "of")
    ordered = ordered.join(total, F.col("parent") == F.col("of"))
    left = F.least("budget", "most_all") - (F.col("most_upto") - F.col("most"))
    ordered = save(ordered.select("parent", "node", "w", "most", left.alias("left"), (F.col("w_all") - (F.col("w_upto") - F.col("w"))).alias("share")), "mix-shares")
    full = F.col("left") * F.col("w") >= F.col("most") * F.col("share")
    first = ordered.where(~full).groupBy("parent").agg(F.max(F.struct((F.col("left") / F.col("share")).alias("level"), "left", "share")).alias("first"))
    first = first.select(F.col("parent").alias("of"), F.col("first.left").alias("rest"), F.col("first.share").alias("by"))
    got = F.when(full, F.col("most")).otherwise(F.greatest(F.lit(0.0), F.least("most", F.col("rest") * F.col("w") / F.col("by"))))
    return ordered.join(first, F.col("parent") == F.col("of"), "left").select("node", got.alias("got"))


def allocate_table(leaves: DataFrame, weights: dict[tuple, float], depth: int, budget: float | None, max_epochs: float, default_weight: float) -> DataFrame:
    """(path, n, allowed, quota): ``allocate`` for a table of leaves (path, n),
    level by level as grouped sums. ``budget`` defaults to all tokens."""
    known = _weighted(leaves, weights, depth, default_weight)
    allowed = F.lit(True)
    for i in range(1, depth + 1):
        allowed = allowed & (F.col(f"w{i}") > 0)
    known = save(known.withColumn("allowed", allowed).withColumn("usable", F.when(allowed, F.col("n") * float(max_epochs)).otherwise(0.0)), "mix-leaves")
    totals = known.agg(F.sum("usable").alias("usable"), F.sum("n").alias("n")).first()
    top = min(float(totals["n"] or 0) if budget is None else float(budget), totals["usable"] or 0.0)
    level = None
    for i in range(1, depth + 1):
        nodes = known.groupBy(F.slice("path", 1, i).alias("node"), F.slice("path", 1, i - 1).alias("parent")).agg(
            F.first(f"w{i}").alias("w"), F.sum("usable").alias("most")
        )
        if level is None:
            nodes = nodes.withColumn("budget", F.lit(top))
        else:
            nodes = nodes.join(level.select(F.col("node").alias("parent"), F.col("got").alias("budget")), "parent")
        level = save(share_out_table(nodes.select("parent", "node", "w", "most", "budget")), "mix-level")
    out = known.join(level, F.col("path") == F.col("node"), "left")
    return out.select("path", "n", "allowed", F.coalesce("got", F.lit(0.0)).alias("quota"))


def _few(df: DataFrame) -> DataFrame:
    """With a broadcast hint if its counted rows allow one."""
    return F.broadcast(df) if df.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES else df


def mix_sources(
    docs: DataFrame, levels: dict[str, Column], weights: dict[tuple, float], budget: float | None = None, max_epochs: float = 4.0,
    seed: int = 0, default_weight: float = 1.0, tokens: Callable[[Column], Column] = word_count, text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with the columns ``mix_path`` (its level values), ``mix_tokens``
    and ``mix_copies`` (at least 1), without the documents that are not taken.
    ``budget`` defaults to all tokens at hand; ``weights`` are by path prefix."""
    path = F.array(*[c.cast("string") for c in levels.values()])
    key = F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.col(text))
    narrow = save(docs.select(path.alias("path"), key.alias("key"), tokens(F.col(text)).alias("n")), "mix-rows")
    leaves = save(narrow.groupBy("path").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), "mix-sizes")
    quota = allocate_table(leaves, weights, len(levels), budget, max_epochs, default_weight)
    floor = F.floor(F.col("quota") / F.col("n"))
    whole = F.when(F.col("n") == 0, F.col("allowed").cast("int")).otherwise(floor - F.when(floor * F.col("n") > F.col("quota"), 1).otherwise(0))
    plan = quota.withColumn("whole", whole.cast("int")).select(
        "path", "whole", F.when(F.col("n") > 0, F.col("quota") - F.col("whole") * F.col("n")).otherwise(0.0).alias("rest")
    )
    plan = save(plan, "mix-plan")

    order = F.xxhash64(F.lit(seed), F.col("whole"), F.col("key"))
    at = F.shiftrightunsigned(order, 64 - RANGES_BITS)
    asked = narrow.join(_few(plan.where("rest > 0")), "path")
    sums = asked.groupBy("path", "rest", at.alias("r")).agg(F.sum("n").alias("n"))
    # at most 2**RANGES_BITS rows for each leaf, whatever its documents
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = sums.withColumn("before", before).where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
    ends = ends.groupBy("path").agg(F.min(F.struct("r", "before")).alias("e")).select("path", F.col("e.r").alias("last"), F.col("e.before").alias("before"))
    plan = save(
        plan.join(ends, "path", "left").select(
            F.col("path").alias("mix_path"), F.col("whole").alias("__whole"), F.col("rest").alias("__rest"),
            F.coalesce("last", F.lit(-1).cast("long")).alias("__last"), F.coalesce("before", F.lit(0).cast("long")).alias("__before"),
        ),
        "mix-ends",
    )
    # the range in which a prefix ends, key by key: equal rows are counted, and
    # ``take`` says how many of a key's rows are in the prefix
    edge = asked.withColumns({"o": order, "r": at}).join(
        _few(plan.where("__last >= 0").select(F.col("mix_path").alias("path"), F.col("__last").alias("r"), "__before")), ["path", "r"]
    ).groupBy("path", "key", "o", "rest", "__before").agg(F.count(F.lit(1)).alias("many"), F.first("n").alias("n"))
    upto = F.coalesce(F.sum(F.col("n") * F.col("many")).over(Window.partitionBy("path").orderBy("o", "key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.col("rest") - F.col("__before") - upto
    take = F.when(open_ <= 0, 0).when(F.col("n") == 0, F.col("many")).otherwise(F.least(F.col("many"), F.ceil(open_ / F.col("n"))))
    taken = save(edge.withColumn("take", take.cast("long")).select(F.col("path").alias("__p"), F.col("key").alias("__k"), F.col("many").alias("__many"), F.col("take").alias("__take")), "mix-edges")

    own = docs.columns
    read = docs.withColumns({"mix_path": path, "__key": key}).join(_few(plan), "mix_path")
    read = read.withColumn("__order", F.xxhash64(F.lit(seed), F.col("__whole"), F.col("__key")))
    read = read.withColumn("__r", F.shiftrightunsigned("__order", 64 - RANGES_BITS))
    clear = read.where("__r <> __last").withColumn("mix_copies", F.col("__whole") + F.when(F.col("__r") < F.col("__last"), 1).otherwise(0))
    at_edge = read.where("__r = __last").join(_few(taken), F.expr("mix_path = __p and __key = __k"))
    even = at_edge.where("__take = 0 or __take = __many").withColumn("mix_copies", F.col("__whole") + F.when(F.col("__take") > 0, 1).otherwise(0))
    # equal rows of which some are in the prefix: the first of them, numbered over chunks
    split = at_edge.where("__take > 0 and __take < __many").select(
        F.struct(*[F.col(f"`{c}`") for c in own]).alias("__doc"), "mix_path", "__key", "__whole", "__take", F.monotonically_increasing_id().alias("__row")
    )
    split = split_window(save(split, "mix-equal"), ["mix_path", "__key"], [F.col("__row")], {"__number": ("row_number",)})
    split = split.withColumn("mix_copies", F.col("__whole") + F.when(F.col("__number") <= F.col("__take"), 1).otherwise(0)).select("__doc.*", "mix_path", "mix_copies")
    columns = [*[F.col(f"`{c}`") for c in own], "mix_path", tokens(F.col(text)).alias("mix_tokens"), "mix_copies"]
    out = None
    for part in (clear, even, split):
        part = part.where("mix_copies > 0").select(*columns)
        out = part if out is None else out.unionByName(part)
    return out
