"""Approximate nearest neighbours with randomly rotated one-bit codes.

Each vector is brought to length 1 and rotated by one fixed random orthogonal
matrix; its code is the signs of the rotated coordinates, packed, with one
correction scalar: the inner product of the code's unit vector with the
rotated vector. For a query the inner product with every code comes from
lookup tables over the packed bytes; divided by the correction it estimates
the cosine, with an error that is, but for a chance set by ``EPSILON``, at most
``EPSILON * sqrt((1 - c*c) / (c*c) / (d - 1))`` for a correction ``c``. A vector is
reranked, by its exact cosine in double precision, when its estimate and error
bound together reach the exact cosine of the ``k``-th best found so far.

The index is a stored table, one row for each block of vectors (packed codes,
corrections, original vectors, ids, row numbers). The stated queries are packed
into blocks alike. Index blocks are dealt into slots of about ``SLOT`` vectors,
query blocks into rounds of about ``ROUND`` queries, and the two meet in a grid: a
task has one slot and one round of one dimension, looks through the slot for
all queries of the round and hands on its ``k`` best a query. Nothing passes
through the driver but counts, and nothing is broadcast; the shuffle moves the
index once a round and the queries once a slot.

Defined results: vectors that are null, zero, or hold null or non-finite
components take no part, neither as queries nor as candidates; vectors with
another dimension than most are searched among their own; a query's own row is
no candidate, others with its id are; rows equal in id and vector are one query,
whose own row is one of them; a null id takes no part; with fewer candidates all are returned; ties go to the smaller
id; an empty table has an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sqlhaul.llm.common import save, ship

#: Vectors in a block and about in a slot, queries about in a round and in a
#: step, reach of the bound.
BLOCK, SLOT, ROUND, STEP = 4096, 65_536, 16_384, 128
EPSILON = 2.5
SEED = 20240611
#: Best estimates that are reranked before the bound is used.
FIRST = 32

_ROTATIONS: dict[int, np.ndarray] = {}


def rotation(d: int) -> np.ndarray:
    """The fixed random orthogonal matrix of dimension ``d``."""
    if d not in _ROTATIONS:
        q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).standard_normal((d, d)))
        _ROTATIONS[d] = q * np.sign(np.diag(r))
    return _ROTATIONS[d]


def codes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, corrections) of unit vectors."""
    z = x @ rotation(x.shape[1]).T
    return np.packbits(z > 0, axis=1), np.abs(z).sum(1) / np.sqrt(x.shape[1])


def bound(correction: np.ndarray, d: int, epsilon: float = EPSILON) -> np.ndarray:
    c2 = np.minimum(correction * correction, 1.0)
    return epsilon * np.sqrt((1 - c2) / np.maximum(c2, 1e-12) / max(d - 1, 1)) + 1e-9


_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1


def estimates(queries: np.ndarray, packed: np.ndarray, correction: np.ndarray) -> np.ndarray:
    """Estimated inner products (queries x vectors) from packed codes."""
    d = queries.shape[1]
    z = np.zeros((len(queries), packed.shape[1] * 8), np.float32)
    z[:, :d] = queries @ rotation(d).T
    if z.shape[1] > d:  # the unused bits of the last byte count nothing
        z[:, d:] = 0
    total = np.zeros((len(queries), len(packed)), np.float32)
    for j in range(packed.shape[1]):
        table = z[:, 8 * j : 8 * j + 8] @ _SIGNS.T
        total += table[:, packed[:, j]]
    return total / (np.sqrt(d) * correction).astype(np.float32)


def _exact(q: np.ndarray, qn: np.ndarray, x: np.ndarray, xn: np.ndarray) -> np.ndarray:
    """Cosines of paired rows, in double precision."""
    return np.einsum("ij,ij->i", q, x) / (qn * xn)


class _Best:
    """The k best (cosine, then smaller id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.k = k

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(q):
            return
        rows = np.unique(q)
        everyone = np.r_[np.repeat(rows, self.k), q]
        s = np.r_[self.score[rows].ravel(), score]
        i = np.r_[self.id[rows].ravel(), ids]
        order = np.lexsort((i, -s, everyone))
        everyone, s, i = everyone[order], s[order], i[order]
        at = np.flatnonzero(np.r_[True, everyone[1:] != everyone[:-1]])
        pick = at[:, None] + np.arange(self.k)
        self.score[rows], self.id[rows] = s[pick], i[pick]

    def least(self) -> np.ndarray:
        return self.score[:, -1]


def search_block(best: _Best, at: slice, queries: np.ndarray, norms: np.ndarray, own_rows: np.ndarray, block: dict, epsilon: float) -> int:
    """Look through one block for the queries ``at``; returns how many
    vectors were reranked."""
    x, xn, ids = block["x"], block["norm"], block["ids"]
    q, qn, own = queries[at], norms[at], own_rows[at]
    est = estimates(q / qn[:, None], block["codes"], block["corr"])
    est[own[:, None] == block["rows"][None, :]] = -np.inf
    done = np.zeros(est.shape, bool)
    first = min(max(FIRST, best.k), len(ids))
    top = np.argpartition(-est, first - 1, axis=1)[:, :first]
    r, c = np.repeat(np.arange(len(q)), first), top.ravel()
    use = np.isfinite(est[r, c])
    r, c = r[use], c[use]
    done[r, c] = True
    part = _Best(len(q), best.k)
    part.score, part.id = best.score[at], best.id[at]
    part.add(r, _exact(q[r], qn[r], x[c], xn[c]), ids[c])
    reach = est + bound(block["corr"], x.shape[1], epsilon).astype(np.float32) >= part.least()[:, None].astype(np.float32) - 1e-6
    r2, c2 = np.nonzero(reach & ~done & np.isfinite(est))
    for a in range(0, len(r2), 200_000):
        rr, cc = r2[a : a + 200_000], c2[a : a + 200_000]
        part.add(rr, _exact(q[rr], qn[rr], x[cc], xn[cc]), ids[cc])
    best.score[at], best.id[at] = part.score, part.id
    return len(r) + len(r2)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _vectors(frame: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, x) of the usable rows; single precision stays as it is."""
    single = isinstance(frame.schema[vector].dataType.elementType, T.FloatType)
    rows = frame.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("x"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("x")))


def _packed(ids: np.ndarray, rows: np.ndarray, lists: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(dimension, ids, row numbers, vectors) in blocks of at most ``most``."""
    size = np.diff(np.asarray(lists.offsets))
    flat = np.asarray(lists.flatten())
    start = np.cumsum(size) - size
    for d in np.unique(size).tolist():
        mine = np.flatnonzero(size == d)
        for a in range(0, len(mine), most):
            m = mine[a : a + most]
            yield d, ids[m], rows[m], flat[start[m][:, None] + np.arange(d)]


def build_index(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The stored index: one row for each block (d, n, ids, rows, codes, corr,
    x), with a number for each row of the table. Vectors are kept in the
    precision that they have."""
    ship(vectors.sparkSession)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        for b in batches:
            numbers = np.arange(first, first + b.num_rows)
            first += b.num_rows
            for d, ids, own, x in _packed(np.asarray(b.column(0)), numbers, b.column(1), BLOCK):
                whole = x.astype(float)
                packed, corr = codes(whole / np.linalg.norm(whole, axis=1, keepdims=True))
                yield pa.RecordBatch.from_pylist(
                    [{"d": d, "n": len(ids), "ids": ids.tobytes(), "rows": own.tobytes(), "codes": packed.tobytes(), "corr": corr.tobytes(), "x": x.tobytes()}]
                )

    made = _vectors(vectors, vec_id, vector).mapInArrow(blocks, "d long, n long, ids binary, rows binary, codes binary, corr binary, x binary")
    return save(made, "onebit-index")


def _doubles(raw: bytes, n: int, d: int) -> np.ndarray:
    return np.frombuffer(raw, "<f4" if len(raw) == 4 * n * d else "<f8").reshape(n, d).astype(float)


def _block(r: dict) -> dict:
    x = _doubles(r["x"], r["n"], r["d"])
    return {
        "ids": np.frombuffer(r["ids"], np.int64), "rows": np.frombuffer(r["rows"], np.int64), "codes": np.frombuffer(r["codes"], np.uint8).reshape(r["n"], -1),
        "corr": np.frombuffer(r["corr"]), "x": x, "norm": np.linalg.norm(x, axis=1),
    }


def stated(index: DataFrame, every: int) -> DataFrame:
    """(id, x, row) of the indexed rows whose id is divisible by ``every``."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                ids, x = np.frombuffer(r["ids"], np.int64), _doubles(r["x"], r["n"], r["d"])
                use = np.flatnonzero(ids % every == 0)
                for a in range(0, len(use), 1024):
                    m = use[a : a + 1024]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * r["d"], pa.int32()), pa.array(x[m].ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[m]), lists, pa.array(np.frombuffer(r["rows"], np.int64)[m])], names=["id", "x", "row"])

    return index.select("d", "n", "ids", "rows", "x").mapInArrow(pick, "id long, x array<double>, row long")


def search(index: DataFrame, queries: DataFrame, k: int = 5, epsilon: float = EPSILON, slot: int = SLOT, round_size: int = ROUND) -> DataFrame:
    """(query_id, query_row, rank, vec_id, score) of the ``k`` nearest of each of
    ``queries`` (id, x, row): ``stated`` rows of the index, or others with numbers
    below 0, which leave nothing out."""
    spark = index.sparkSession
    asked = queries.groupBy("id", "x").agg(F.min("row").alias("row"))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for d, ids, own, x in _packed(np.asarray(b.column(0)), np.asarray(b.column(2)), b.column(1), min(1024, round_size)):
                yield pa.RecordBatch.from_pylist([{"d": d, "n": len(ids), "ids": ids.tobytes(), "rows": own.tobytes(), "x": x.tobytes()}])

    asked = save(asked.select("id", "x", "row").mapInArrow(blocks, "d long, n long, ids binary, rows binary, x binary"), "onebit-queries")
    count = {t: (x.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()) for t, x in (("index", index), ("asked", asked))}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(-(-count["index"][0] // slot), min(parts, count["index"][1]), 1)
    rounds = max(-(-count["asked"][0] // round_size), 1)
    left = index.withColumn("slot", F.pmod(F.xxhash64("rows"), F.lit(slots))).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    right = asked.withColumn("round", F.pmod(F.xxhash64("rows"), F.lit(rounds)).cast("int")).withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))

    def scan(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(wanted):
            return pd.DataFrame({"query_id": [], "query_row": [], "vec_id": [], "score": []})
        d = int(wanted["d"].iloc[0])
        ids, own = (np.concatenate([np.frombuffer(b, np.int64) for b in wanted[c]]) for c in ("ids", "rows"))
        q = np.concatenate([np.frombuffer(b).reshape(-1, d) for b in wanted["x"]])
        norms, best = np.linalg.norm(q, axis=1), _Best(len(ids), k)
        for r in vectors.to_dict("records"):
            block = _block(r)
            for a in range(0, len(ids), STEP):
                search_block(best, slice(a, a + STEP), q, norms, own, block, epsilon)
        full = np.isfinite(best.score)
        at = np.repeat(np.arange(len(ids)), k).reshape(-1, k)[full]
        return pd.DataFrame({"query_id": ids[at], "query_row": own[at], "vec_id": best.id[full], "score": best.score[full]})

    cell = ["d", "slot", "round"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(scan, "query_id long, query_row long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("query_id", "query_row", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, vec_id, score) of the stated search: queries are the rows
    whose id is divisible by ``every``, candidates all rows but the query's own."""
    index = build_index(vectors, vec_id, vector)
    return search(index, stated(index, every), k, **options).select("query_id", "rank", "vec_id", "score")
