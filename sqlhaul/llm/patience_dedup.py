"""Line de-duplication by pairwise alignment.

Every document is the sequence of its lines' hashes. Its blocks name partners: a
block is a run of lines that reaches ``min_words`` words and would not without
its last line, or not without its first. Every common run of that many words is
a union of blocks, so a document that is aligned with the first document of each
of its blocks loses what it shares with any earlier one. There are at most two
blocks a line, so the pairs are linear in the lines, however common a line is. A
document is aligned with each partner by patience diff (anchors are lines that
are unique in both, in longest increasing order; gaps between anchors are aligned
likewise). Runs of aligned lines with at least ``min_words`` words are deleted from
the later document. So are blocks that the alignment does not reach, because they
moved or stand more than once in either text: they are looked up among the earlier
text's blocks, each copy by itself.

Whatever is deleted stays in an earlier document: a line is only deleted from
a document that comes after another one with the line, so its first one keeps it.

Defined results: documents come in the order of their ids, a null id last; a
line's outer white space does not count, blank lines are in no run's count and never
anchors; null texts stay null, empty ones empty; rows that are equal in id and
text are one document and are treated alike; other columns are kept.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import _powers, as_long, mix, save, ship, slice_hashes, text_steps

MIN_WORDS = 25
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def line_table(column: pa.Array):
    """(first row, line offsets by row, hashes, words) of texts, in steps; a
    blank line has hash 0 and no words."""
    for row, data, offsets in text_steps(column):
        rows = len(offsets) - 1
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        newline = data == 10
        begin = np.zeros(len(data) + 1, bool)
        begin[1:] |= newline
        # a text's first line; a line after a text's last line break has no bytes
        starts = np.unique(np.r_[np.flatnonzero(begin[:-1]), offsets[:-1]])
        starts = starts[starts < len(data)]
        doc = np.searchsorted(offsets, starts, side="right") - 1
        keep = starts < offsets[doc + 1]
        starts, doc = starts[keep], doc[keep]
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        ink = np.flatnonzero(~_BLANK[data])
        a, b = np.searchsorted(ink, starts), np.searchsorted(ink, ends)
        full = b > a
        hashes = np.zeros(len(starts), np.uint64)
        hashes[full] = slice_hashes(data, ink[a[full]], ink[b[full] - 1] + 1) | np.uint64(1)
        word = ~_BLANK[data]
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:-1]
        upto = np.r_[0, np.cumsum(first)]
        yield row, np.searchsorted(doc, np.arange(rows + 1)), hashes, (upto[ends] - upto[starts]).astype(np.int32)


def blocks(hashes: np.ndarray, words: np.ndarray, offsets: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, key) of the distinct blocks of documents whose lines
    lie between ``offsets``: the shortest run from each line on, and up to each
    line, that has ``min_words`` words."""
    n = len(hashes)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    line = np.arange(n)
    upto = np.r_[0, np.cumsum(words, dtype=np.int64)]
    least = max(1, min_words)
    end = np.searchsorted(upto, upto[:-1] + least)
    start = np.searchsorted(upto, upto[1:] - least, side="right") - 1
    on, up = end <= offsets[doc + 1], start >= offsets[doc]
    s, e = np.divmod(np.unique(np.r_[line[on], start[up]] * (n + 1) + np.r_[end[on], line[up] + 1]), n + 1)
    power, back = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(0x9E3779B97F4A7C15)) * power[:n], out=total[1:])
    key = mix((total[e] - total[s]) * back[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return doc[s], s, e, key | np.uint64(1)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of (i, j), sorted by i, with increasing j."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect.bisect_left(tails, j)
        back.append(at[p - 1] if p else -1)
        if p == len(tails):
            tails.append(j)
            at.append(k)
        else:
            tails[p], at[p] = j, k
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j) of two sequences, in order. 0 is never an anchor."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, p, j, q = todo.pop()
        while i < p and j < q and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < p and j < q and a[p - 1] == b[q - 1]:
            p, q = p - 1, q - 1
            out.append((p, q))
        if i >= p or j >= q:
            continue
        once: dict[int, int] = {}
        for k in range(i, p):
            once[a[k]] = -1 if a[k] in once or a[k] == 0 else k
        there: dict[int, int] = {}
        for k in range(j, q):
            if once.get(b[k], -1) >= 0:
                there[b[k]] = -1 if b[k] in there else k
        pairs = sorted((once[x], k) for x, k in there.items() if k >= 0)
        pi, pj = i, j
        anchors = _increasing(pairs)
        if not anchors:
            continue
        for x, y in anchors:
            out.append((x, y))
            todo.append((pi, x, pj, y))
            pi, pj = x + 1, y + 1
        todo.append((pi, p, pj, q))
    return sorted(out)


def _outside(earlier: list[int], later: list[int], words: list[int], aligned: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the later sequence's blocks that the earlier one has too
    and that are not all ``aligned``."""
    a, b = (np.array(x, np.int64).view(np.uint64) for x in (earlier, later))
    count = np.array(words, np.int64)
    _, s, e, key = blocks(b, count, np.array([0, len(b)]), min_words)
    done = np.r_[0, np.cumsum(aligned)]
    open_ = done[e] - done[s] < e - s
    if not len(a) or not open_.any():
        return []
    # lines that the later text does not have are in no common block: their words do not matter
    lines, first = np.unique(b, return_index=True)
    at = np.minimum(np.searchsorted(lines, a), len(lines) - 1)
    there = blocks(a, np.where(lines[at] == a, count[first[at]], 0), np.array([0, len(a)]), min_words)[3]
    open_ &= np.isin(key, there)
    return list(zip(s[open_].tolist(), e[open_].tolist()))


def common_blocks(earlier: list[int], later: list[int], words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the later sequence's lines that are in common runs with at
    least ``min_words`` words."""
    gone, run = np.zeros(len(later) + 2, np.int8), []
    for i, j in [*patience(earlier, later), (-2, -2)]:
        if run and (i, j) != (run[-1][0] + 1, run[-1][1] + 1):
            a, b = run[0][1], run[-1][1] + 1
            if sum(words[a:b]) >= min_words:
                gone[a + 1 : b + 1] = 1
            run = []
        run.append((i, j))
    for a, b in _outside(earlier, later, words, gone[1:-1].copy(), min_words):
        gone[a + 1 : b + 1] = 1
    edges = np.flatnonzero(np.diff(gone))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, rare: int | None = None) -> DataFrame:
    """``docs`` with the common blocks deleted from ``text``, and the columns
    ``lines_before`` and ``lines_deleted``.

    With a number for ``rare`` the partners come from single lines instead: a
    line's first document, and if at most so many have it the one before this.
    That misses blocks whose lines stood in different documents before."""
    ship(docs.sparkSession)

    def scan(batches):
        for b in batches:
            for row, offsets, hashes, words in line_table(b.column(2)):
                k = len(offsets) - 1
                at = pa.array(offsets.astype(np.int32))
                lines = pa.ListArray.from_arrays(at, pa.array(as_long(hashes)))
                if rare is None:
                    doc, _, _, names = blocks(hashes, words, offsets, min_words)
                    named = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(k + 1)).astype(np.int32)), pa.array(as_long(names)))
                else:
                    named = lines
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, k), b.column(1).slice(row, k), lines, pa.ListArray.from_arrays(at, pa.array(words)), named],
                    names=["doc", "key", "lines", "words", "named"],
                )

    key = F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), key.alias("key"), F.col(text).cast("string").alias("t"))
    table = save(rows.mapInArrow(scan, "doc long, key long, lines array<long>, words array<int>, named array<long>"), "dedup-lines")
    each = table.select(
        F.struct(F.coalesce("doc", F.lit((1 << 63) - 1)).alias("doc"), "key").alias("place"), F.explode(F.array_distinct("named")).alias("line")
    ).where("line <> 0").distinct()
    stats = each.groupBy("line").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = save(each.join(stats, "line"), "dedup-shared")
    pairs = shared.where("place <> first").select(F.col("first.key").alias("early"), F.col("place.key").alias("late"))
    if rare is not None:
        previous = shared.where(F.col("c") <= rare).withColumn("before", F.lag("place").over(Window.partitionBy("line").orderBy("place"))).where("before is not null")
        pairs = pairs.union(previous.select(F.col("before.key").alias("early"), F.col("place.key").alias("late")))
    pairs = pairs.where("early <> late").distinct()
    known = table.dropDuplicates(["key"])
    both = pairs.join(known.select(F.col("key").alias("late"), F.col("lines").alias("b"), "words"), "late").join(
        known.select(F.col("key").alias("early"), F.col("lines").alias("a")), "early"
    )

    def align(batches):
        for pdf in batches:
            got = []
            for late, a, b, words in zip(pdf.late, pdf.a, pdf.b, pdf.words):
                for s, e in common_blocks(a.tolist(), b.tolist(), words.tolist(), min_words):
                    got.append((late, s, e))
            yield pd.DataFrame(got, columns=["late", "s", "e"])

    cut = both.select("late", "a", "b", "words").mapInPandas(align, "late long, s int, e int")
    # what goes from a text as runs of lines, sorted and apart from each other
    each = cut.select("late", F.explode(F.sequence("s", F.col("e") - 1)).alias("i")).distinct()
    runs = each.withColumn("run", F.col("i") - F.row_number().over(Window.partitionBy("late").orderBy("i")))
    runs = runs.groupBy("late", "run").agg(F.struct(F.min("i").alias("s"), (F.max("i") + 1).alias("e")).alias("r"))
    gone = save(runs.groupBy("late").agg(F.array_sort(F.collect_list("r")).alias("runs"), F.sum(F.col("r.e") - F.col("r.s")).alias("gone")), "dedup-deleted")
    lines = F.split(F.col(text), "\n")

    def between(x: Column) -> Column:
        """The lines before, between and after the runs, in one pass."""

        def part(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(x["runs"], k - 1)["e"])
            end = F.when(k == F.size(x["runs"]), F.size(x["lines"])).otherwise(F.get(x["runs"], k)["s"])
            return F.slice(x["lines"], start + 1, end - start)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["runs"])), part))

    # a lambda's variable, so that the text is split once
    kept = F.transform(F.array(F.struct(lines.alias("lines"), F.col("__runs").alias("runs"))), between)[0]
    out = docs.withColumn("__key", key).join(
        # by shuffle at every size: what is deleted grows with the texts
        gone.select(F.col("late").alias("__key"), F.col("runs").alias("__runs"), F.col("gone").alias("__gone")).hint("merge"), "__key", "left"
    )
    clean = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))
    return out.select(
        *[clean.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).alias("lines_before"),
        F.coalesce("__gone", F.lit(0)).cast("int").alias("lines_deleted"),
    )
