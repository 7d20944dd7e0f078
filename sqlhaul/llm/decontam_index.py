"""Benchmark decontamination by a distributed positional inverted index.

Only DataFrame functions, no Python on the executors.

1. *Index.* Every text is split once; the postings (term, document, position)
   of all terms that the test items use are stored in files sorted by term,
   as they come from the scan (each file indexes its own documents; nothing is
   shuffled), with one row more for each document's number of words. No text is
   read after that.
2. *Rarest terms.* The index gives each term's frequency over all documents.
   Each different window of the items, a phrase, names its two rarest places.
3. *Intersection.* The postings of the rarest term, moved back by its place in
   the phrase, say where the phrase would have to begin. The postings of the
   second rarest one, moved likewise, must agree: at the same beginning (a
   phrase candidate) or at most ``slop`` words from it (a proximity match).
   Candidates then ask for the postings of all their other terms by document,
   position and term; those that get every one are exact.

All joins of positions are by equality (the one with ``slop`` by cells of its
width), so work is linear in the postings of rare terms, also where a text
repeats one word. Test-side tables (vocabulary, phrases) are broadcast only when
counted and below ``BROADCAST_ROWS``, keys of documents below
``BROADCAST_KEYS``; above that the same joins shuffle, and AQE splits skewed terms.

Defined results: words are maximal runs of ASCII letters and digits and of
non-ASCII characters, A-Z lower-cased; null and empty texts have none; an item
with fewer words than the window is one window, one without words none;
repeated rows give repeated results; a null doc_id stays; a null item_id takes
part as the text ``null``; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import save

#: Rows up to which a counted table of the test side is broadcast, and one of
#: document keys (16 bytes each), which may grow with the corpus.
BROADCAST_ROWS, BROADCAST_KEYS = 1_000_000, 200_000
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """With a broadcast hint if its counted rows allow one."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def words(text: Column) -> Column:
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), BREAK), "")


def item_places(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """(item, n, place, term): the words of the test items."""
    named = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").alias("t")).distinct()
    split = named.select("item", F.xxhash64("t").alias("copy"), words(F.col("t")).alias("w"))
    return split.select("item", "copy", F.size("w").alias("n"), F.posexplode("w").alias("place", "term"))


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The stored index: (term_id, doc_id, copy, pos, n_words). ``terms`` is
    (term, term_id). ``copy`` tells apart rows with one doc_id; ``n_words`` is
    set on one row of each document, which may have no ``term_id``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    split = rows.select("doc_id", F.xxhash64("t").alias("copy"), words(F.col("t")).alias("w"))
    each = split.select("doc_id", "copy", F.size("w").alias("n"), F.posexplode_outer("w").alias("pos", "term"))
    last = F.col("pos").isNull() | (F.col("pos") == F.col("n") - 1)
    return save(
        each.join(terms, "term", "left")
        .where(F.col("term_id").isNotNull() | last)
        .select("term_id", "doc_id", "copy", "pos", F.when(last, F.col("n")).alias("n_words"))
        .sortWithinPartitions("term_id"),
        "positional-index",
    )


def _phrases(places: DataFrame, terms: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(phrase, terms, items, size, term_id, place1, term2, place2): every
    different window of the items, the items that have it, and its two rarest
    places. Windows with a term that no document has are left out, as they
    cannot occur."""
    freq = index.where("term_id is not null").groupBy("term_id").agg(F.count(F.lit(1)).alias("f"))
    known = places.join(small(terms), "term").join(freq, "term_id", "left")
    begins = known.withColumn(
        "begin",
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - (window - 1)), F.least(F.col("place"), F.greatest(F.lit(0), F.col("n") - window)))),
    ).withColumn("place", F.col("place") - F.col("begin"))
    ranked = begins.groupBy("item", "copy", "begin").agg(
        F.sort_array(F.collect_list(F.struct("f", "place", "term_id"))).alias("r"),
        F.transform(F.sort_array(F.collect_list(F.struct("place", "term_id"))), lambda x: x["term_id"]).alias("terms"),
        F.min(F.coalesce("f", F.lit(0))).alias("least"),
    ).where("least > 0")
    other = F.when(F.size("r") > 1, F.col("r")[1]).otherwise(F.col("r")[0])
    # the order of places follows from the terms: it is the same in all items
    return ranked.groupBy("terms").agg(F.first("r").alias("r"), F.array_sort(F.collect_set("item")).alias("items")).select(
        F.monotonically_increasing_id().alias("phrase"), "terms", "items", F.size("terms").alias("size"),
        F.col("r")[0]["term_id"].alias("term_id"), F.col("r")[0]["place"].alias("place1"),
        other["term_id"].alias("term2"), other["place"].alias("place2"),
    )


def _met(lists: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(phrase, doc_id, copy, begin, off): where the rarest term of a phrase says
    it would begin, and how far from its place the nearest occurrence of the
    second rarest one is, up to ``slop``. Positions meet by cells of 2 * slop + 1
    words, so a place meets a bounded number of others however often a term
    stands in a text."""
    wide = 2 * slop + 1
    asked = small(phrases.select("phrase", "term_id", "place1", "term2", "place2"))
    first = lists.join(asked, "term_id").where("pos >= place1").selectExpr(
        "phrase", "doc_id", "copy", "pos - place1 as begin", "term2", "pos - place1 + place2 as want"
    )
    ends = [F.expr(f"(want + {d}) DIV {wide}") for d in (wide - slop, wide + slop)]
    first = first.withColumn("cell", F.explode(F.array_distinct(F.array(*ends))))
    second = lists.join(small(phrases.select(F.col("term2").alias("term_id")).distinct()), "term_id", "left_semi")
    second = second.withColumn("cell", F.expr(f"(pos + {wide}) DIV {wide}"))
    near = first.alias("a").join(
        second.alias("b"), F.expr(f"a.doc_id <=> b.doc_id and a.copy = b.copy and a.term2 = b.term_id and a.cell = b.cell and abs(b.pos - a.want) <= {slop}")
    )
    off = F.expr("b.pos - a.want")
    return near.groupBy("a.phrase", "a.doc_id", "a.copy", "a.begin").agg(F.min(F.struct(F.abs(off).alias("far"), off.alias("off"))).alias("o")).select(
        "phrase", "doc_id", "copy", "begin", "o.off"
    )


def _exact(lists: DataFrame, phrases: DataFrame, met: DataFrame) -> DataFrame:
    """(phrase, doc_id, copy, begin, size): the candidates whose other terms all
    have a posting at their place."""
    rest = "filter(sequence(0, size - 1), x -> x <> place1 and x <> place2)"
    asked = phrases.select("phrase", "size", "terms", F.expr(rest).alias("rest")).withColumn("missing", F.size("rest"))
    found = save(met.where("off = 0").join(small(asked), "phrase").drop("off"), "phrase-candidates")
    places = found.where("missing > 0").select("phrase", "doc_id", "copy", "begin", "size", "missing", "terms", F.explode("rest").alias("place")).selectExpr(
        "phrase", "doc_id", "copy", "begin", "size", "missing", "begin + place as pos", "terms[place] as term_id"
    )
    keys = small(found.select(F.col("doc_id").alias("kd"), F.col("copy").alias("kc")).distinct(), BROADCAST_KEYS)
    own = lists.join(keys, F.expr("doc_id <=> kd and copy = kc"), "left_semi")
    there = places.alias("a").join(own.alias("b"), F.expr("a.doc_id <=> b.doc_id and a.copy = b.copy and a.pos = b.pos and a.term_id = b.term_id"))
    whole = there.groupBy("a.phrase", "a.doc_id", "a.copy", "a.begin", "a.size", "a.missing").agg(F.count_distinct("a.pos").alias("there")).where("there = missing")
    return whole.select("phrase", "doc_id", "copy", "begin", "size").union(found.where("missing = 0").select("phrase", "doc_id", "copy", "begin", "size"))


def benchmark_hits(
    docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 3,
    text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated, hit_windows (item, position and length of every
    exact phrase), n_near (items that come near), near (item, begin, offset:
    a window of the item would begin at that word by its rarest term, and its
    second rarest one is that many words, at most ``slop``, from its place),
    copy (a hash of the text)."""
    places = save(item_places(items, item_text, item_id), "item-places")
    terms = save(places.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()), "item-terms")
    index = build_index(docs, small(terms), text, doc_id)
    lists = index.where("term_id is not null").select("term_id", "doc_id", "copy", "pos")
    phrases = save(_phrases(places, terms, index, window), "item-phrases")
    met = save(_met(lists, phrases, int(slop)), "phrase-places")
    exact = save(_exact(lists, phrases, met), "exact-phrases")

    of = small(phrases.select("phrase", "items"))
    hits = exact.join(of, "phrase").groupBy("doc_id", "copy").agg(
        F.array_sort(F.flatten(F.collect_list(F.transform("items", lambda x: F.struct(x.alias("item"), F.col("begin").alias("pos"), F.col("size").alias("len")))))).alias("hit_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("begin", F.col("begin") + F.col("size") - 1))))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("found"),
    )
    # a set of structs hashes; array_distinct of them would compare all pairs
    each = met.join(of, "phrase").select("doc_id", "copy", F.explode("items").alias("item"), "begin", F.col("off").alias("offset"))
    near = each.groupBy("doc_id", "copy").agg(
        F.array_sort(F.collect_set(F.struct("item", "begin", "offset"))).alias("near"), F.size(F.collect_set("item")).cast("long").alias("n_near")
    )
    base = index.where("n_words is not null").select(F.col("doc_id").alias("id"), F.col("copy").alias("c"), "n_words")
    out = base.join(hits, F.expr("id <=> doc_id and c = copy"), "left").drop("doc_id", "copy").join(near, F.expr("id <=> doc_id and c = copy"), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        F.sha2(F.array_join(found, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "hit_windows",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "near",
        F.col("c").alias("copy"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows in which a window of an item occurs."""
    bad = benchmark_hits(docs, items, text=text, doc_id=doc_id, **options).where("contaminated").select(
        F.col("doc_id").alias("__id"), F.col("copy").alias("__copy")
    ).distinct()
    bad = small(save(bad, "contaminated"), BROADCAST_KEYS)
    own = docs.withColumn("__of", F.xxhash64(F.col(text).cast("string")))
    return own.join(bad, F.col(doc_id).cast("long").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__copy")), "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
