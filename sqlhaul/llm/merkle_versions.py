"""Merkle manifest of a dataset as a persistent tree that is copied by paths.

Every row is a leaf, the hash of its fields. The leaves of a language stand in
ascending id order; every ``FAN`` consecutive nodes have one node above them,
until one is left, the subroot; the subroots, in the order of the languages,
have a root alike.

* *Places.* Leaves are range-partitioned by their order and numbered from the
  counts of the parts before, so no language is in one task (``place``).
* *Blocks.* ``FAN ** depth`` consecutive leaves are an aligned block: a whole
  subtree, whose nodes depend on nothing else. A task builds a block's nodes
  and hands up its top node only. The tops are leaves of the next storey, which
  is cut into aligned blocks again, and so on (``storeys``).
* *Sides.* From the top storey down, each block gets the path above it: for
  each level, the digests on its left and on its right (``sides``). A path has
  one entry a level.
* *Versions.* A tampered leaf makes a version of the tree: the nodes from it to
  the root are copied, every other node is shared with the base. The task of
  its block makes the copies within the block; those of the storeys above go on
  from the block's stored path, so the versions are never brought together and
  the top of the tree is no bottleneck.

A table of ``n`` rows has one task group for every ``FAN ** depth`` rows of a
language, two shuffles of (id, two digests) and none of texts. Nothing passes
through the driver but the storeys' largest counts.

Defined results: a null field hashes as ``-``; null languages come first, as do
null ids; rows with one id stand in the order of their digests, equal rows are
leaves of their own; ids that are null are not tampered with; an empty table
has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, ship

#: Children of a node, and levels above its leaves that one block holds.
FAN, DEPTH = 8, 4
#: Rows of a part of the ordered table.
PART_ROWS = 500_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """The hash of a row: every field as its length in bytes and its text."""
    shown = [c.cast("string") for c in fields]
    marked = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in shown]
    return F.sha2(F.concat(*marked).cast("binary"), 256)


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", group: str = "lang", tampered: Column | None = None) -> DataFrame:
    """(g, key, leaf, tampered, row): the leaves, stored. ``tampered`` is the
    hash that a tampered row has instead, null for all others."""
    return save(
        docs.select(
            F.col(f"`{group}`").cast("string").alias("g"), F.col(f"`{doc_id}`").cast("long").alias("key"),
            leaf([F.col(f"`{c}`") for c in fields]).alias("leaf"),
            (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered"), F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )


def place(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with a column ``g``) with ``place``, their number from 0 within
    ``g`` by ``order``, and ``total``, the rows of ``g``. ``order`` must tell
    all rows apart, so that no part can be larger than the others."""
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.count() // PART_ROWS + 1)
    by = [F.col(c).asc_nulls_first() for c in ["g", *order]]
    dealt = rows.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    # the number of a row within its part; parts are files of a stored table
    numbered = dealt.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    numbered = save(numbered, "merkle-order")
    runs = numbered.groupBy("g", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # a run is a part's rows of one group: as many as parts and groups
    runs = save(runs, "merkle-runs")
    earlier = runs.alias("a").join(
        _running(runs).alias("b"), F.expr("a.g <=> b.g and a.part = b.part")
    ).selectExpr("a.g as rg", "a.part as rp", "b.before - a.first as shift", "b.total as total")
    joined = numbered.join(earlier, F.expr("g <=> rg and part = rp"))
    return joined.withColumn("place", F.col("at") + F.col("shift")).drop("rg", "rp", "shift", "part", "at")


def _running(runs: DataFrame) -> DataFrame:
    """(g, part, before, total): the rows of the group's earlier parts. A group
    has at most one run for each part, so its window is bounded by them."""
    group = Window.partitionBy("g")
    upto = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return runs.select("g", "part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"), F.sum("n").over(group).alias("total"))


def height(total: int, depth: int) -> int:
    """Levels above ``total`` nodes, at most ``depth``."""
    levels = 0
    while total > 1 and levels < depth:
        total = -(-total // FAN)
        levels += 1
    return levels


def block_levels(digests: list[str], total: int, depth: int) -> list[list[str]]:
    """The nodes of a block, level by level, its leaves first and its top last,
    in a storey of ``total`` nodes."""
    levels = [digests]
    for _ in range(height(total, depth)):
        below = levels[-1]
        levels.append([digest("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return levels


def block_sides(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """(left, right) siblings of a leaf's ancestors, level by level."""
    out = []
    for below in levels[:-1]:
        run, own = at // FAN * FAN, at % FAN
        out.append(("".join(below[run : run + own]), "".join(below[run + own + 1 : run + FAN])))
        at //= FAN
    return out


def tops(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, place, digest, total) of the next storey: the top of each block of
    (g, place, digest, total)."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total = int(rows["total"].iloc[0])
        top = block_levels(rows["digest"].tolist(), total, depth)[-1]
        assert len(top) == 1
        return pd.DataFrame({"g": rows["g"].iloc[:1], "place": [int(rows["block"].iloc[0])], "digest": top, "total": [-(-total // FAN**depth)]})

    blocks = nodes.select("g", "place", "digest", "total", F.expr(f"place DIV {FAN**depth}").alias("block"))
    return blocks.groupBy("g", "block").applyInPandas(build, "g string, place long, digest string, total long")


def sides(nodes: DataFrame, above: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, place, subroot, path) of every node: its siblings up to the top of
    the tree. ``above`` has (g, place, subroot, path) of the tops of the blocks."""

    def build(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        levels = block_levels(rows["digest"].tolist(), int(rows["total"].iloc[0]), depth)
        rest = [(x["left"], x["right"]) for x in upper["path"].iloc[0]]
        found = [[{"left": a, "right": b} for a, b in block_sides(levels, i) + rest] for i in range(len(rows))]
        return pd.DataFrame({"g": rows["g"], "place": rows["place"], "subroot": upper["subroot"].iloc[0], "path": found})

    blocks = nodes.select("g", "place", "digest", "total", F.expr(f"place DIV {FAN**depth}").alias("block"))
    return blocks.groupBy("g", "block").cogroup(above.groupBy("g", "place")).applyInPandas(build, PATHS)


def nodes(storey: DataFrame, levels_below: int = 0, depth: int = DEPTH) -> DataFrame:
    """(g, level, place, digest): all nodes of a storey (g, place, digest,
    total), whose own nodes are of level ``levels_below``; its tops are in the
    next storey, unless it is the last."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        total, first = int(rows["total"].iloc[0]), int(rows["place"].iloc[0])
        levels = block_levels(rows["digest"].tolist(), total, depth)
        if total > FAN**depth:
            levels = levels[:-1]
        found = [(levels_below + k, first // FAN**k + i, x) for k, level in enumerate(levels) for i, x in enumerate(level)]
        out = pd.DataFrame(found, columns=["level", "place", "digest"])
        out.insert(0, "g", [rows["g"].iloc[0]] * len(out))
        return out

    blocks = storey.select("g", "place", "digest", "total", F.expr(f"place DIV {FAN**depth}").alias("block"))
    return blocks.groupBy("g", "block").applyInPandas(build, "g string, level int, place long, digest string")


def tree_nodes(placed: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, level, place, digest): every node of the base trees of the groups
    over ``placed`` (g, place, digest, total)."""
    out = nodes(placed, 0, depth)
    for k, upper in enumerate(storeys(placed, depth)[0]):
        out = out.unionByName(nodes(upper.where("total > 1"), (k + 1) * depth, depth))
    return out


PATHS = "g string, place long, subroot string, path array<struct<left: string, right: string>>"


def storeys(nodes: DataFrame, depth: int = DEPTH) -> tuple[list[DataFrame], DataFrame]:
    """The stored storeys above ``nodes`` (g, place, digest, total), each the
    tops of the blocks below it, and (g, place, subroot, path) of the last one,
    with one node for each ``g`` and nothing above it."""
    out = []
    while True:
        nodes = save(tops(nodes, depth), "merkle-storey")
        out.append(nodes)
        most = nodes.agg(F.max("total")).first()[0]
        if most is None or most <= 1:
            break
    empty = F.array().cast("array<struct<left: string, right: string>>")
    return out, nodes.select("g", "place", F.col("digest").alias("subroot"), empty.alias("path"))


def paths(nodes: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, place, subroot, path) of the tops of the blocks of ``nodes``: one row
    for each block, stored."""
    levels, found = storeys(nodes, depth)
    for upper in reversed(levels[:-1]):
        found = sides(upper, found, depth)
    return save(found, "merkle-paths")


def manifest(placed: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(g, place, subroot, root, path): for each block of the leaves (g, place,
    digest, total) the path from its top to the root of all groups."""
    lower = paths(placed, depth)
    # the subroots are the leaves of a tree of their own
    heads = lower.select(F.col("g").alias("name"), "subroot").distinct()
    heads = place(heads.withColumn("g", F.lit("all")), ["name"])
    heads = save(heads.select("g", "place", "total", "name", F.col("subroot").alias("digest")), "merkle-subroots")
    upper = sides(heads, paths(heads, depth), depth).select(F.col("place").alias("p"), F.col("subroot").alias("root"), F.col("path").alias("rest"))
    heads = heads.join(upper, F.expr("place = p")).select("name", "root", "rest")
    return save(
        lower.join(heads, F.expr("g <=> name")).select("g", "place", "subroot", "root", F.concat("path", "rest").alias("path")), "merkle-manifest"
    )


def versions(placed: DataFrame, tree: DataFrame, depth: int = DEPTH) -> DataFrame:
    """One row for each leaf of ``placed`` (g, key, leaf, tampered, place,
    total): (key, leaf, subroot, root, proof_sha256, copied, folded_root).
    ``copied`` are the nodes of the leaf's version from the leaf to the root;
    all its other nodes are those of the base tree. Where ``tampered`` is null
    the version is the base itself."""

    def build(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        own = rows["leaf"].tolist()
        levels = block_levels(own, int(rows["total"].iloc[0]), depth)
        rest = [(x["left"], x["right"]) for x in upper["path"].iloc[0]]
        tail = "".join(a + b for a, b in rest)
        proofs, copies = [], []
        for i, (base, other) in enumerate(zip(own, rows["tampered"])):
            path = block_sides(levels, i)
            proofs.append(digest("".join(a + b for a, b in path) + tail))
            node = other if isinstance(other, str) else base
            copy = [node]
            for left, right in path:
                node = digest(left + node + right)
                copy.append(node)
            for left, right in rest:  # the storeys above, from the stored path
                node = digest(left + node + right)
                copy.append(node)
            copies.append(copy)
        return pd.DataFrame({
            "key": rows["key"], "leaf": own, "subroot": upper["subroot"].iloc[0], "root": upper["root"].iloc[0],
            "proof_sha256": proofs, "copied": copies, "folded_root": [c[-1] for c in copies],
        })

    # ids as text: pandas would make floats of whole numbers beside a null
    blocks = placed.withColumns({"block": F.expr(f"place DIV {FAN**depth}"), "key": F.col("key").cast("string")})
    made = blocks.groupBy("g", "block").cogroup(tree.groupBy("g", "place")).applyInPandas(
        build, "key string, leaf string, subroot string, root string, proof_sha256 string, copied array<string>, folded_root string"
    )
    return made.withColumn("key", F.col("key").cast("long"))


def lowered(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def tamper_versions(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", group: str = "lang", text: str = "text", every: int = 3, depth: int = DEPTH) -> DataFrame:
    """The versions of all rows of ``docs`` under the tree of ``docs``, where the
    text of each row whose crc32 of the id is a multiple of ``every`` is
    tampered with (A-Z lower-cased), with ``verified``: whether the version has
    the root of the base."""
    ship(docs.sparkSession)
    chosen = F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % every == 0, F.lit(False))
    low = lowered(F.col(f"`{text}`").cast("string"))
    tampered = F.when(chosen, leaf([low if c == text else F.col(f"`{c}`") for c in fields]))
    own = leaves(docs, fields, doc_id, group, tampered).withColumn("tampered", F.expr("nullif(tampered, leaf)"))
    placed = save(place(own, ["key", "leaf", "row"]), "merkle-placed")
    tree = manifest(placed.select("g", "place", F.col("leaf").alias("digest"), "total"), depth)
    return versions(placed, tree, depth).withColumn("verified", F.col("folded_root") == F.col("root"))
