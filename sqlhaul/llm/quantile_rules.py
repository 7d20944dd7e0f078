"""Quality rules whose limits come from the data.

1. *Statistics.* Every whole text is read once and becomes counts (words, code
   points in words, symbols, repeated lines, words in repeated five-word
   windows), from which ratios in parts of 10,000 are made, in whole numbers.
2. *Sketches.* A ratio's quantile sketch counts the rows of log-linear bins: a
   bin is named by its lower edge, which keeps the first ``BITS`` + 1 bits of
   the value, so an edge is less than a share of 2**-BITS below the values in
   it, and a sketch has at most 64 * 2**BITS bins however many rows it stands
   for. Sketches merge by adding counts (``merge``), so those of a language
   come from those of its sources, those of today from yesterday's and the new
   rows'. A sketch belongs to a language, a source and a band of lengths (its
   words go up to four times those of the band before; short texts scatter more).
3. *Limits.* For every ratio the quartiles, and ``REACH`` times their distance
   (or the least one in ``RATIOS``) beyond them. A group of fewer than
   ``LEAST_ROWS`` documents takes the limits of its language and band, or those
   of the band; a band with fewer has no limits, and its documents pass.
4. *Filter.* Documents meet the limits of their group by a join: a broadcast
   where the counted groups are at most ``BROADCAST_ROWS``, else a shuffle with
   the groups copied over ``SALT`` parts, so that a hot source is spread.

Rows are pre-aggregated before each shuffle; the texts are never shuffled.

Defined results: words are runs without blanks (0x09-0x0D, 0x20); null and
empty texts have no words and fail the base rules; null languages and sources
are groups of their own; repeated rows count again and have the same verdict;
an empty table has no rows; other columns are ignored, and ``keep_by_rules``
hands them on whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import mix, save, ship, slice_hashes, text_steps

#: Words of a window, base limits: least words, most percent of repeated ones.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Ratios: name -> (counts above and below the line, least distance of the
#: quartiles in parts of 10,000, whether small values are outliers too).
RATIOS = {
    "word_length": ("word_chars", "n_words", 2500, True),
    "symbols": ("n_symbols", "n_words", 250, False),
    "repeated_lines": ("n_dup_lines", "n_lines", 1000, False),
    "repeated_words": ("n_repeat_words", "n_words", 600, False),
}
SCALE = 10_000
#: Distances of the quartiles that a limit lies beyond them.
REACH = 3
#: Bits of a value that its bin keeps, besides the first.
BITS = 6
LEAST_ROWS = 50
#: Groups up to which the limits are broadcast (about 150 bytes each), and the
#: parts that a group's rows are dealt over above that.
BROADCAST_ROWS, SALT = 200_000, 32

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _per_row(hit: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a key stands in its row more than once, whether it stood there
    before), for keys in the order of their places."""
    order = np.lexsort((keys, row))  # stable: places stay in order
    k, r = keys[order], row[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = (k[1:] == k[:-1]) & (r[1:] == r[:-1])
    again, before = np.zeros(len(k), bool), np.zeros(len(k), bool)
    before[order] = same[:-1]
    again[order] = same[:-1] | same[1:]
    return again, before


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text in a buffer."""
    rows = len(offsets) - 1
    blank = _BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = ~blank, ~blank
    begins[1:] &= blank[:-1] | edge[1:-1]
    ends[:-1] &= blank[1:] | edge[1:-1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, starts, side="right") - 1
    out = {
        "n_words": np.bincount(row, minlength=rows), "n_symbols": _per_row(_SYMBOL[data], offsets),
        "word_chars": _per_row(~blank & ((data & 0xC0) != 0x80), offsets),
    }
    # lines with a word
    cuts = np.flatnonzero(data == 10)
    at = np.unique(np.r_[offsets[:-1], cuts + 1])  # empty texts begin where the next one does
    of = np.searchsorted(offsets, at, side="right") - 1
    upto = np.minimum(np.r_[cuts, len(data)][np.searchsorted(cuts, at)], offsets[np.minimum(of + 1, rows)])
    full = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~blank, out=full[1:])
    real = (at < upto) & (of < rows)
    real[real] = full[upto[real]] > full[at[real]]
    at, upto, of = at[real], upto[real], of[real]
    _, before = _repeated(slice_hashes(data, at, upto), of)
    out["n_lines"] = np.bincount(of, minlength=rows)
    out["n_dup_lines"] = np.bincount(of[before], minlength=rows)
    # windows
    n = len(starts) - WINDOW + 1
    inside = np.zeros(len(starts) + 1, np.int64)
    if n > 0:
        word = slice_hashes(data, starts, stops)
        key = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + word[i : i + n])
        whole = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
        again, _ = _repeated(key[whole], row[whole])
        hit = whole[again]
        np.add.at(inside, hit, 1)
        np.subtract.at(inside, hit + WINDOW, 1)
    covered = np.cumsum(inside)[:-1] > 0
    out["n_repeat_words"] = np.bincount(row[covered], minlength=rows)
    return out


def statistics(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """(doc_id, lang, source, ``COUNTS``, band, a value for each ratio,
    base_failed) of every row, stored."""
    ship(docs.sparkSession)
    fields = ["doc_id long", "lang string", "source string", *[f"{c} long" for c in COUNTS]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_steps(batch.column(3)):
                got = counts(data, offsets)
                own = [batch.column(i).slice(first, len(offsets) - 1) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(got[c], pa.int64()) for c in COUNTS]], names=["doc_id", "lang", "source", *COUNTS])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
        F.col(source).cast("string").alias("source"), F.col(text).cast("string").alias("text"),
    )
    got = rows.mapInArrow(read, ", ".join(fields))
    ratios = {name: F.expr(f"{SCALE} * {over} DIV greatest({under}, 1)") for name, (over, under, *_) in RATIOS.items()}
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return save(got.withColumns({"band": F.expr("length(bin(n_words)) DIV 2"), **ratios, "base_failed": failed}), "rule-statistics")


def edge(value: str) -> Column:
    """The bin of a whole number of at least 0: its first bits, the rest 0."""
    shift = f"greatest(length(bin({value})) - {BITS + 1}, 0)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(stats: DataFrame) -> DataFrame:
    """(lang, source, band, ratio, edge, n): a quantile sketch for every group
    and ratio, from the rows that pass the base rules."""
    pairs = F.array(*[F.struct(F.lit(name).alias("ratio"), edge(name).alias("edge")) for name in RATIOS])
    each = stats.where("not base_failed").select("lang", "source", "band", F.explode(pairs).alias("p"))
    return each.groupBy("lang", "source", "band", "p.ratio", "p.edge").agg(F.count(F.lit(1)).alias("n"))


def merge(*parts: DataFrame, by: tuple[str, ...] = ("lang", "source", "band")) -> DataFrame:
    """One sketch for each group ``by`` and ratio, of all rows of the parts."""
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*by, "ratio", "edge").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, ratio, rows, q1, q3) of groups with ``LEAST_ROWS`` rows or more."""
    group = Window.partitionBy(*by, "ratio")
    upto = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("edge")), "rows": F.sum("n").over(group)})
    return upto.groupBy(*by, "ratio").agg(
        F.max("rows").alias("rows"),
        F.min(F.expr("if(4 * upto >= rows, edge, null)")).alias("q1"),
        F.min(F.expr("if(4 * upto >= 3 * rows, edge, null)")).alias("q3"),
    ).where(F.col("rows") >= LEAST_ROWS)


def limits(sketch: DataFrame) -> DataFrame:
    """(lang, source, band, low_<ratio>, high_<ratio>): limits for every group
    that the sketch has, null where there are none."""
    fine = quartiles(sketch, ("lang", "source", "band"))
    by_lang = merge(sketch, by=("lang", "band"))
    some = quartiles(by_lang, ("lang", "band"))
    most = quartiles(merge(by_lang, by=("band",)), ("band",))
    groups = sketch.select("lang", "source", "band", "ratio").distinct().alias("g")
    found = (
        groups.join(fine.alias("f"), F.expr("g.lang <=> f.lang and g.source <=> f.source and g.band = f.band and g.ratio = f.ratio"), "left")
        .join(some.alias("s"), F.expr("g.lang <=> s.lang and g.band = s.band and g.ratio = s.ratio"), "left")
        .join(most.alias("m"), F.expr("g.band = m.band and g.ratio = m.ratio"), "left")
        .selectExpr("g.lang", "g.source", "g.band", "g.ratio", "coalesce(f.q1, s.q1, m.q1) as q1", "coalesce(f.q3, s.q3, m.q3) as q3")
    )
    out = []
    for name, (_, _, least, both) in RATIOS.items():
        wide = f"{REACH} * greatest(q3 - q1, {least})"
        out.append(F.max(F.expr(f"if(ratio = '{name}', q3 + {wide}, null)")).alias(f"high_{name}"))
        if both:
            out.append(F.max(F.expr(f"if(ratio = '{name}', q1 - {wide}, null)")).alias(f"low_{name}"))
    return found.groupBy("lang", "source", "band").agg(*out)


def verdicts(stats: DataFrame, limit: DataFrame) -> DataFrame:
    """``stats`` with its limits and ``kept``."""
    limit = save(limit, "rule-limits").withColumnsRenamed({"lang": "l_lang", "source": "l_source", "band": "l_band"})
    same = F.expr("lang <=> l_lang and source <=> l_source and band = l_band")
    if limit.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        met = stats.join(F.broadcast(limit), same, "left")
    else:
        copies = limit.withColumn("l_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        salted = stats.withColumn("salt", F.pmod(F.xxhash64("doc_id", *COUNTS), F.lit(SALT)))
        met = salted.join(copies, same & F.expr("salt = l_salt"), "left").drop("salt", "l_salt")
    bad = F.col("base_failed")
    for name, (_, _, _, both) in RATIOS.items():
        bad = bad | F.coalesce(F.col(name) > F.col(f"high_{name}"), F.lit(False))
        if both:
            bad = bad | F.coalesce(F.col(name) < F.col(f"low_{name}"), F.lit(False))
    return met.drop("l_lang", "l_source", "l_band").withColumn("kept", ~bad)


def quality_rules(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row for each document: its counts, ratios, limits, ``base_failed``
    and ``kept``."""
    stats = statistics(docs, text, doc_id, lang, source)
    return verdicts(stats, limits(save(sketches(stats), "rule-sketches")))


def keep_by_rules(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are. Rows
    with one id, language, source and text share a verdict."""
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"),
    ).withColumn("id", F.xxhash64(F.col(f"row.`{doc_id}`").cast("long"), F.col("row").getField(doc_id).isNull(), "text", F.col("text").isNull(), "lang", "source"))
    good = quality_rules(own, "text", "id", "lang", "source").where("kept").select(F.col("doc_id").alias("good")).distinct()
    return own.join(good, F.expr("id = good"), "left_semi").select("row.*")
