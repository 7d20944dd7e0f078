"""Quality classifier: regularised quadratic discriminant analysis.

Every whole text becomes a vector of transformed statistics (``FEATURES``).
Each class has a mean and a covariance; the covariance is shrunk towards the
pooled one and towards a multiple of the identity. The score of a text is the
logistic of the difference of the two classes' Gaussian log densities, from
Mahalanobis distances through Cholesky factors that are computed once, scaled
by a calibration line.

The statistics are read from the texts once and stored; the moments are sums
over all labelled training rows (one row for each batch and moment, added up
by Spark), the calibration uses a histogram of all their differences. The
driver sees moments and bins only, whose number does not grow with the rows.

Defined results: null and empty texts have the statistics of no words and are
scored like others; a null id is in no fold that is held out and has no
label; labels other than 0 and 1 are ignored; a repeated label counts again;
without labels of both classes every score is the share of label 1 (0.5 if
there is none); other columns of the inputs are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import mix, save, ship, slice_hashes, text_steps

FEATURES = (
    "log_words log_word_length upper digits stops symbols bangs bars space foreign "
    "repeat_word distinct_words repeat_triple words_per_line repeat_line symbol_words"
).split()
#: Shares of the pooled covariance and of the identity in a class's covariance.
POOLED, IDENTITY = 0.2, 0.02
#: Bin width and reach of the calibration histogram.
BIN, REACH = 0.25, 60.0

_CLASS = np.zeros(256, np.int64)  # 0 other letters, 1 upper, 2 digit, 3 stop, 4 symbol, 5 bang, 6 bar, 7 space, 8 newline, 9 foreign
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _c in ".,;:'\"-()?":
    _CLASS[ord(_c)] = 3
for _c in "#$%&*+/<=>@[\\]^_`{}~":
    _CLASS[ord(_c)] = 4
_CLASS[ord("!")], _CLASS[ord("|")] = 5, 6
_CLASS[[9, 11, 12, 13, 32]] = 7
_CLASS[10] = 8
_CLASS[:9] = _CLASS[14:32] = 4
_CLASS[127] = 4
_CLASS[128:] = 9


def _repeats(keys: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """For each row, how many of its keys have stood in it before."""
    order = np.lexsort((keys, doc))
    k, d = keys[order], doc[order]
    again = np.zeros(len(k), bool)
    again[1:] = (k[1:] == k[:-1]) & (d[1:] == d[:-1])
    return np.bincount(d[again], minlength=rows)


def features(column: pa.Array) -> np.ndarray:
    """The statistics of each text of a column, one row each."""
    out = []
    for _, data, offsets in text_steps(column):
        rows = len(offsets) - 1
        size = np.diff(offsets)
        doc = np.repeat(np.arange(rows), size)
        cls = _CLASS[data]
        share = np.bincount(doc * 10 + cls, minlength=rows * 10).reshape(rows, 10) / np.maximum(size, 1)[:, None]
        blank = (cls == 7) | (cls == 8)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = ~blank
        first[1:] &= blank[:-1] | edge[1:-1]
        starts = np.flatnonzero(first)
        last = ~blank
        last[:-1] &= blank[1:] | edge[1:-1]
        ends = np.flatnonzero(last) + 1
        wdoc = doc[starts]
        n = np.bincount(wdoc, minlength=rows)
        words = slice_hashes(data, starts, ends)
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (wdoc[1:] == wdoc[:-1])
        repeat = np.bincount(wdoc[same], minlength=rows)
        seen = _repeats(words, wdoc, rows)
        inside = wdoc[:-2] == wdoc[2:]
        triple = mix(words[:-2] + words[1:-1] * np.uint64(3) + words[2:] * np.uint64(5))[inside] if len(words) > 2 else words[:0]
        tdoc = wdoc[:-2][inside] if len(words) > 2 else wdoc[:0]
        triples = np.bincount(tdoc, minlength=rows)
        again = _repeats(triple, tdoc, rows)
        ls = np.flatnonzero(np.r_[True, (cls[:-1] == 8) | edge[1:-1]]) if len(data) else np.zeros(0, np.int64)
        le = np.r_[ls[1:], len(data)] if len(ls) else ls
        ldoc = doc[ls]
        lines = np.bincount(ldoc, minlength=rows)
        lagain = _repeats(slice_hashes(data, ls, le), ldoc, rows)
        odd = (cls[ends - 1] >= 4) & (cls[ends - 1] <= 6)
        odd = np.bincount(wdoc[odd], minlength=rows)
        w = np.maximum(n, 1)
        letters = np.maximum(1e-9, share[:, 0] + share[:, 1] + share[:, 9])
        chars = size * (1 - share[:, 7] - share[:, 8])
        out.append(
            np.column_stack(
                [
                    np.log1p(n), np.log1p(chars / w), np.sqrt(share[:, 1] / letters), np.sqrt(share[:, 2]), np.sqrt(share[:, 3]),
                    np.sqrt(share[:, 4]), np.sqrt(share[:, 5]), np.sqrt(share[:, 6]), share[:, 7] + share[:, 8], np.sqrt(share[:, 9]),
                    np.sqrt(repeat / w), np.log1p(n - seen) - np.log1p(n), np.sqrt(again / np.maximum(triples, 1)),
                    np.log1p(n / np.maximum(lines, 1)), np.sqrt(lagain / np.maximum(lines, 1)), np.sqrt(odd / w),
                ]
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(FEATURES)))


def feature_table(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, x) of every row, stored."""
    ship(docs.sparkSession)

    def rows(batches):
        for b in batches:
            x = features(b.column(1))
            flat = pa.array(x.ravel())
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, flat)], names=["doc_id", "x"])

    got = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t")).mapInArrow(rows, "doc_id long, x array<double>")
    return save(got.select("doc_id", held_out("doc_id").alias("held_out"), "x"), "quality-features")


def held_out(doc_id: str):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class QuadraticDiscriminant:
    """Class means, inverted Cholesky factors, log determinants and the
    calibration line (slope, offset)."""

    scale: np.ndarray
    means: np.ndarray
    whiten: np.ndarray
    logdet: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density under class 1 less that under class 0."""
        d = []
        for k in (0, 1):
            z = (x / self.scale - self.means[k]) @ self.whiten[k].T
            d.append(-0.5 * (z * z).sum(1) - 0.5 * self.logdet[k])
        return d[1] - d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        d = np.clip(self.difference(x), -REACH, REACH)
        return 1 / (1 + np.exp(-np.clip(self.slope * d + self.offset, -500, 500)))


def _moments(batches):
    d = len(FEATURES)
    up = np.triu_indices(d)
    for pdf in batches:
        for label, g in pdf.groupby("label"):
            x = np.stack(g.x.to_numpy())
            values = np.r_[len(x), x.sum(0), (x.T @ x)[up]]
            yield pd.DataFrame({"label": int(label), "k": np.arange(len(values)), "v": values})


def fit(table: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> QuadraticDiscriminant | float:
    """The model of all training rows; a constant score if a class is missing."""
    named = labels.select(F.col(doc_id).cast("long").alias("id"), F.col(label).cast("int").alias("label")).where("label in (0, 1)")
    train = save(table.where(~F.col("held_out")).join(named, F.expr("doc_id = id")).select("label", "x"), "quality-train")
    got = train.mapInPandas(_moments, "label int, k int, v double").groupBy("label", "k").agg(F.sum("v").alias("v")).collect()
    d, up = len(FEATURES), np.triu_indices(len(FEATURES))
    sums = {k: np.zeros(1 + d + len(up[0])) for k in (0, 1)}
    for r in got:
        sums[r["label"]][r["k"]] = r["v"]
    n = np.array([sums[0][0], sums[1][0]])
    if n.min() < 1:
        return float(n[1] / n.sum()) if n.sum() else 0.5
    mean = np.stack([sums[k][1 : 1 + d] / n[k] for k in (0, 1)])
    second = np.zeros((2, d, d))
    for k in (0, 1):
        second[k][up] = sums[k][1 + d :] / n[k]
        second[k] = second[k] + np.triu(second[k], 1).T
    cov = second - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * n[:, None, None]).sum(0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    cov, pooled = cov / np.outer(scale, scale), pooled / np.outer(scale, scale)
    # the fewer the rows of a class, the more of the pooled covariance it takes
    share = np.maximum(POOLED, np.minimum(1.0, d / n))
    cov = (1 - IDENTITY) * ((1 - share)[:, None, None] * cov + share[:, None, None] * pooled) + IDENTITY * np.eye(d)
    chol = np.linalg.cholesky(cov)
    model = QuadraticDiscriminant(scale, mean / scale, np.linalg.inv(chol), 2 * np.log(np.stack([np.diag(c) for c in chol])).sum(1))
    shared = train.sparkSession.sparkContext.broadcast(model)

    def differ(batches):
        for pdf in batches:
            yield pd.DataFrame({"label": pdf.label, "bin": np.clip(np.round(shared.value.difference(np.stack(pdf.x.to_numpy())) / BIN), -REACH / BIN, REACH / BIN).astype(int)})

    bins = train.mapInPandas(differ, "label int, bin int").groupBy("label", "bin").count().collect()
    z = np.array([r["bin"] * BIN for r in bins])
    y = np.array([r["label"] for r in bins], float)
    w = np.array([r["count"] for r in bins], float)
    model.slope, model.offset = _line(z, y, w)
    return model


def _line(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic line with a slight pull of the slope to 0, by Newton steps."""
    a, b = 0.1, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([(w * (p - y) * z).sum() + a, (w * (p - y)).sum() + 0.01 * b])
        v = w * p * (1 - p) + 1e-9
        h = np.array([[(v * z * z).sum() + 1, (v * z).sum()], [(v * z).sum(), v.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -0.5, 0.5)), b - float(np.clip(step[1], -2, 2))
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 1e-3), b


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``. The model is
    fitted as for ``quality_scores``; the texts are scored where they are read."""
    # statistics of all rows, so that labels meet narrow rows and no text is moved
    shared = docs.sparkSession.sparkContext.broadcast(fit(feature_table(docs, text, doc_id), labels, label))

    @F.pandas_udf("double")
    def score(t: pd.Series) -> pd.Series:
        if isinstance(shared.value, float):
            return pd.Series(np.full(len(t), shared.value))
        return pd.Series(shared.value.score(features(pa.array(t, pa.string(), from_pandas=True))))

    return docs.withColumn("__score", score(F.col(text).cast("string"))).where(F.col("__score") >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; the
    model learns from the labelled rows that are not held out (crc32 of the id
    as text, modulo 5, is not 0)."""
    table = feature_table(docs, text, doc_id)
    shared = table.sparkSession.sparkContext.broadcast(fit(table, labels, label))

    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        model = shared.value
        if isinstance(model, float):
            return pd.Series(np.full(len(x), model))
        return pd.Series(model.score(np.stack(x.to_numpy()))) if len(x) else pd.Series([], dtype=float)

    scored = table.select("doc_id", "held_out", score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
