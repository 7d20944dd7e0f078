"""N-gram Jaccard self-join by T-occurrence search with DivideSkip.

Documents are sets of distinct word n-grams; two link when their Jaccard
similarity reaches ``percent`` / 100. The join is exact (up to collisions of
64-bit n-gram hashes) and never writes out all pairs of a group of copies:

1. *Classes.* Documents with equal sets form a class (grouped minimum).
2. *Rarest-first sets.* Every distinct n-gram of every class goes, in packed
   arrays, to the part that owns its hash; n-grams that one class alone has
   cannot be shared and go no further, the others return to their class with
   their frequency band. The order (band, hash) is the same everywhere, so two
   similar classes share an n-gram among their rarest ``n - ceil(t n) + 1``.
   N-grams that are frequent within single batches are known beforehand (they
   are salted over several parts).
3. *Families.* Classes that share a prefix n-gram and have compatible sizes
   are connected; every link lies inside a family. Lists are combined to one
   posting a batch before the shuffle.
4. *Leaders.* Every class is compared with the leader of its family, the one
   with the most widely shared n-grams. In a group of copies of one page that
   settles all but the outliers in time linear in the group.
5. *T-occurrence search.* What its leader does not settle is searched against
   its whole family in cells of bounded size. A cell builds inverted lists of
   its index block; for a query with ``n`` n-grams a match needs at least
   ``T = ceil(t n)`` of them, so the ``L`` longest lists are left out, the
   short ones are heap-merged, documents met at least ``T - L`` times are looked up
   in the long lists by binary search, and those that reach the overlap that
   their own size asks for are links. Documents already in one component with
   the query are passed over; with ``all_links`` nothing is passed over.

Defined results: a null or empty text, or one without words, has an empty set
and no links; a text with fewer than ``n`` words is one n-gram of all its
words; repeated rows are copies of each other; a null id stays null, is
nobody's component name unless no row of its component has an id; other
columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import as_hash, as_long, components, mix, save, ship, slice_hashes, text_steps

#: N-grams in one part, block or cell (8 bytes each and small change).
PART = 1_000_000
QUERIES = 250_000
#: Bytes of a family's sets that meet one copy of its leader.
SALT_BYTES = 4 << 20
#: An n-gram that so many documents of one batch have is handled as frequent.
LOCAL_HOT = 24
#: At most so many frequent n-grams are told to all tasks (16 bytes each); the
#: bar is raised until they fit. The order alone depends on it, no result does.
HOT_BOUND = 200_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WEIGHTS = (mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)).astype(np.uint64)
_SHORT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets, hashes): for each row the sorted distinct hashes
    of its n-grams, for steps of rows."""
    for row, data, offsets in text_steps(column):
        rows = len(offsets) - 1
        data = _LOWER[data]
        word = ~_SPACE[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | edge[1:-1]
        starts = np.flatnonzero(first)
        last = word.copy()
        last[:-1] &= ~word[1:] | edge[1:-1]
        ends = np.flatnonzero(last) + 1
        words = slice_hashes(data, starts, ends)
        at = np.searchsorted(starts, offsets)
        count = np.diff(at)
        grams, doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if len(words) >= n:
            m = len(words) - n + 1
            grams = np.zeros(m, np.uint64)
            for k in range(n):
                grams += words[k : k + m] * _WEIGHTS[k]
            doc = np.repeat(np.arange(rows), count)
            inside = doc[:m] == doc[n - 1 :]
            grams, doc = mix(grams[inside]), doc[:m][inside]
        few = np.flatnonzero((count > 0) & (count < n))
        if len(few):
            short = np.zeros(len(few), np.uint64)
            for k in range(n - 1):
                has = count[few] > k
                short[has] += words[at[few][has] + k] * _WEIGHTS[k]
            short = mix(short ^ (_SHORT * count[few].astype(np.uint64)))
            grams, doc = np.concatenate([grams, short]), np.concatenate([doc, few])
        order = np.lexsort((grams, doc))
        grams, doc = grams[order], doc[order]
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        grams, doc = grams[keep], doc[keep]
        yield row, np.searchsorted(doc, np.arange(rows + 1)), grams


def _signatures(offsets: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """A 64-bit signature of each row's set."""
    total = np.zeros(len(grams) + 1, np.uint64)
    np.cumsum(mix(grams ^ _SHORT), out=total[1:])
    size = np.diff(offsets).astype(np.uint64)
    return mix(total[offsets[1:]] - total[offsets[:-1]] + size * _WEIGHTS[9])


def need(size: int, percent: int) -> int:
    """The least overlap of a set of ``size`` with any similar set."""
    return -(-percent * size // 100)


def _by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first positions, lengths) of the runs of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return at, np.diff(np.r_[at, len(keys)])


def _sets(docs: DataFrame, text: str, doc_id: str, n: int) -> tuple[DataFrame, dict[str, int]]:
    """(doc_id, copy, n_shingles, sig) of every row, and the frequent n-grams."""

    ship(docs.sparkSession)

    def rows(batches):
        for b in batches:
            for row, offsets, grams in shingle_sets(b.column(2), n):
                k = len(offsets) - 1
                sig = _signatures(offsets, grams)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(row, k), b.column(1).slice(row, k), pa.array(np.diff(offsets), pa.int64()), pa.array(as_long(sig)), pa.nulls(k, pa.int64())],
                    names=["doc_id", "copy", "n_shingles", "sig", "hot"],
                )
                fresh = _fresh(offsets, sig)
                s = np.sort(grams[np.repeat(fresh, np.diff(offsets))])
                at, length = _by_key(s)
                hot = length >= LOCAL_HOT
                if hot.any():
                    h = int(hot.sum())
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(h, pa.int64()), pa.nulls(h, pa.int64()), pa.array(length[hot], pa.int64()), pa.nulls(h, pa.int64()), pa.array(as_long(s[at[hot]]))],
                        names=["doc_id", "copy", "n_shingles", "sig", "hot"],
                    )

    out = save(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text).cast("string")).alias("copy"), F.col(text).cast("string").alias("text")
        ).mapInArrow(rows, "doc_id long, copy long, n_shingles long, sig long, hot long"),
        "shingle-sets",
    )
    frequent = out.where("hot is not null").groupBy("hot").agg(F.sum("n_shingles").alias("c"))
    bar = LOCAL_HOT
    while frequent.where(F.col("c") >= bar).count() > HOT_BOUND:
        bar *= 4
    hot = {r["hot"]: r["c"] for r in frequent.where(F.col("c") >= bar).collect()}
    return out.where("hot is null").drop("hot"), hot


def _fresh(offsets: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Rows that are the first of their set in this step, without empty sets."""
    fresh = np.zeros(len(sig), bool)
    fresh[np.unique(sig, return_index=True)[1]] = True
    return fresh & (np.diff(offsets) > 0)


def _runs(values: np.ndarray) -> list[np.ndarray]:
    """Run-length form of an array with long runs."""
    at, length = _by_key(values)
    return [values[at], length.astype(np.uint32)]


def _unrun(values: bytes, lengths: bytes, kind) -> np.ndarray:
    return np.repeat(np.frombuffer(values, kind), np.frombuffer(lengths, np.uint32))


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))], names=names.split()
    )


def _shared(docs: DataFrame, text: str, n: int, percent: int, total: int, hot: dict[int, int]) -> DataFrame:
    """(sig, n, own, grams, bands) of each class that can have a partner:
    ``own`` n-grams that no other class has, and the others rarest first."""
    parts = max(1, math.ceil(total / PART))
    hot_key = np.sort(as_hash(np.fromiter(hot.keys(), np.int64, len(hot))))
    hot_n = np.array([hot[int(x)] for x in as_long(hot_key)], np.int64)
    salts = 1 + hot_n * 4 // PART
    base = parts + np.r_[0, np.cumsum(salts)].astype(np.int64)
    spread = parts + int(salts.sum())
    shared = docs.sparkSession.sparkContext.broadcast((hot_key, hot_n, salts, base))

    def deal(batches):
        key, _, salt, first = shared.value
        for b in batches:
            for _, offsets, grams in shingle_sets(b.column(0), n):
                sig, size = _signatures(offsets, grams), np.diff(offsets)
                fresh = _fresh(offsets, sig)
                grams = grams[np.repeat(fresh, size)]
                who = np.repeat(sig[fresh], size[fresh])
                many = np.repeat(size[fresh].astype(np.uint32), size[fresh])
                part = (grams % np.uint64(parts)).astype(np.int64)
                if len(key):
                    at = np.minimum(np.searchsorted(key, grams), len(key) - 1)
                    is_hot = key[at] == grams
                    part[is_hot] = first[at[is_hot]] + (who[is_hot] % salt[at[is_hot]].astype(np.uint64)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                part, grams, who, many = part[order], grams[order], who[order], many[order]
                at, length = _by_key(part)
                rows = []
                for s, k in zip(at.tolist(), length.tolist()):
                    run, times = _runs(who[s : s + k])
                    ns = many[s : s + k][np.r_[0, np.cumsum(times[:-1])].astype(np.int64)] if k else many[:0]
                    rows.append((int(part[s]), run.tobytes(), times.tobytes(), ns.tobytes(), grams[s : s + k].tobytes()))
                if rows:
                    yield _batch(rows, "part who times size grams")

    back = max(1, math.ceil(total / PART))

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        key, freq, _, _ = shared.value
        who = np.concatenate([_unrun(a, t, np.uint64) for a, t in zip(pdf.who, pdf.times)])
        many = np.concatenate([_unrun(a, t, np.uint32) for a, t in zip(pdf["size"], pdf.times)])
        grams = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf.grams])
        order = np.lexsort((who, grams))
        who, many, grams = who[order], many[order], grams[order]
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (who[1:] != who[:-1])
        who, many, grams = who[keep], many[keep], grams[keep]
        at, length = _by_key(grams)
        if len(key):
            p = np.minimum(np.searchsorted(key, grams[at]), len(key) - 1)
            known = np.where(key[p] == grams[at], freq[p], 0)
        else:
            known = np.zeros(len(at), np.int64)
        # a frequent n-gram's band is above all others', whatever its salt holds
        band = np.where(known > 0, 64 + np.log2(np.maximum(known, 1)), 2 * np.log2(np.maximum(length, 1))).astype(np.uint8)
        band = np.where(known > 0, band, np.minimum(band, 63)).astype(np.uint8)
        use = np.repeat((length > 1) | (known > 0), length)
        band = np.repeat(band, length)[use]
        who, many, grams = who[use], many[use], grams[use]
        order = np.argsort(who, kind="stable")
        who, many, grams, band = who[order], many[order], grams[order], band[order]
        at, length = _by_key(who)
        to = (mix(who[at]) % np.uint64(back)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        pick = np.repeat(at[order], length[order]) + _within(length[order])
        who_r, len_r, n_r, to = who[at[order]], length[order].astype(np.uint32), many[at[order]], to[order]
        grams, band = grams[pick], band[pick]
        pos = np.r_[0, np.cumsum(len_r.astype(np.int64))]
        s, k = _by_key(to)
        return pd.DataFrame(
            [
                (int(to[i]), who_r[i : i + j].tobytes(), len_r[i : i + j].tobytes(), n_r[i : i + j].tobytes(), grams[pos[i] : pos[i + j]].tobytes(), band[pos[i] : pos[i + j]].tobytes())
                for i, j in zip(s.tolist(), k.tolist())
            ],
            columns=["part", "who", "times", "size", "grams", "bands"],
        )

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        who = np.concatenate([_unrun(a, t, np.uint64) for a, t in zip(pdf.who, pdf.times)])
        many = np.concatenate([_unrun(a, t, np.uint32) for a, t in zip(pdf["size"], pdf.times)])
        grams = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf.grams])
        band = np.concatenate([np.frombuffer(x, np.uint8) for x in pdf.bands])
        order = np.lexsort((grams, band, who))
        who, many, grams, band = who[order], many[order], grams[order], band[order]
        at, length = _by_key(who)
        size = many[at].astype(np.int64)
        own = size - length
        prefix = size - (-(-percent * size // 100)) + 1
        out = [
            (s, m, o, grams[a : a + k].tobytes(), band[a : a + k].tobytes())
            for s, m, o, a, k in zip(as_long(who[at])[own < prefix].tolist(), size[own < prefix].tolist(), own[own < prefix].tolist(), at[own < prefix].tolist(), length[own < prefix].tolist())
        ]
        return pd.DataFrame(out, columns=["sig", "n", "own", "grams", "bands"])

    dealt = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        deal, "part long, who binary, times binary, size binary, grams binary"
    )
    wide = max(1, min(spread, 4 * parts))
    counted = dealt.repartition(wide, "part").groupBy("part").applyInPandas(
        count, "part long, who binary, times binary, size binary, grams binary, bands binary"
    )
    return save(
        counted.repartition(back, "part").groupBy("part").applyInPandas(gather, "sig long, n long, own long, grams binary, bands binary"),
        "shared-sets",
    )


def _within(length: np.ndarray) -> np.ndarray:
    """0..k-1 for each k of ``length``, one after the other."""
    total = int(length.sum())
    return np.arange(total) - np.repeat(np.r_[0, np.cumsum(length)[:-1]] if len(length) else length, length)


def _families(sets: DataFrame, percent: int, postings: int) -> DataFrame:
    """(node, root) for the classes that share a prefix n-gram with another
    class of compatible size. Similar sizes fall in the same or neighbouring
    bands of a geometric scale, so each n-gram is posted under its class's
    band and the next one."""
    parts = max(1, math.ceil(postings / PART))
    scale = math.log(100 / percent) * (1 + 1e-9) + 1e-9

    def post(batches):
        for b in batches:
            who, grams, size = [], [], []
            for s, n, own, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                k = n - need(n, percent) + 1 - own
                g = np.frombuffer(g, np.uint64)[:k]
                who.append(np.full(len(g), s, np.int64))
                grams.append(g)
                size.append(np.full(len(g), int(math.log(n) / scale), np.uint64))
            if not who:
                continue
            who, grams, size = np.concatenate(who), np.concatenate(grams), np.concatenate(size)
            key = np.concatenate([mix(grams + size * _WEIGHTS[3]), mix(grams + (size + np.uint64(1)) * _WEIGHTS[3])])
            who = np.concatenate([who, who])
            order = np.lexsort((who, key))
            key, who = key[order], who[order]
            at, length = _by_key(key)
            low = np.repeat(who[at], length)
            pairs = np.unique(np.stack([who, low], 1)[who != low], axis=0)
            # the combined posting of each list, and the batch's own stars
            order = np.argsort(key[at] % np.uint64(parts), kind="stable")
            k2, w2 = key[at][order], who[at][order]
            s, m = _by_key(k2 % np.uint64(parts))
            rows = [(int(k2[i] % np.uint64(parts)), w2[i : i + j].tobytes(), k2[i : i + j].tobytes()) for i, j in zip(s.tolist(), m.tolist())]
            if len(pairs):
                rows.append((-1, pairs[:, 0].tobytes(), pairs[:, 1].tobytes()))
            yield _batch(rows, "part who keys")

    def star(pdf: pd.DataFrame) -> pd.DataFrame:
        who = np.concatenate([np.frombuffer(x, np.int64) for x in pdf.who])
        key = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
        order = np.lexsort((who, key))
        key, who = key[order], who[order]
        at, length = _by_key(key)
        low = np.repeat(who[at], length)
        pairs = np.unique(np.stack([who, low], 1)[who != low], axis=0)
        return pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    def own(batches):
        for b in batches:
            u = [np.frombuffer(x, np.int64) for x in b.column(0).to_pylist()]
            v = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            if u:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])

    posted = save(sets.select("sig", "n", "own", "grams").mapInArrow(post, "part long, who binary, keys binary"), "prefix-lists")
    across = posted.where("part >= 0").repartition(parts, "part").groupBy("part").applyInPandas(star, "u long, v long")
    within = posted.where("part < 0").select("who", "keys").mapInArrow(own, "u long, v long")
    return components(across.union(within))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if not len(a) or not len(b):
        return 0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def similar(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def divide_skip(query: np.ndarray, lists: dict[int, np.ndarray], least: int, sizes: np.ndarray, size: int, percent: int, skip) -> list[int]:
    """Documents of ``lists`` (n-gram -> sorted document numbers) similar to
    the query: its shared n-grams, and its full ``size``.

    ``least`` is the overlap that any match needs. The longest lists are left
    out of the merge (at most ``least - 1`` of them); what the short lists'
    heap merge meets at least ``least - L`` times is probed in the long ones by
    binary search, until it has the overlap that its own size needs or cannot
    reach it. ``skip(document)`` passes over documents of no interest.
    """
    found = sorted((lists[g] for g in query.tolist() if g in lists), key=len)
    if len(found) < least:
        return []
    # DivideSkip's balance between merging and probing
    long = min(least - 1, int(least / (0.0085 * math.log(max(len(found[-1]), 2)) + 1)))
    short, probes = found[: len(found) - long], found[len(found) - long :]
    probes = probes[::-1]
    out = []
    merged = heapq.merge(*(x.tolist() for x in short))
    met, times = None, 0

    def settle(doc: int, times: int) -> None:
        if times < least - long or skip(doc):
            return
        other = int(sizes[doc])
        wanted = -(-percent * (size + other) // (100 + percent))
        left = len(probes)
        for x in probes:
            if times >= wanted or times + left < wanted:
                break
            at = int(np.searchsorted(x, doc))
            times += at < len(x) and x[at] == doc
            left -= 1
        if times >= wanted:
            out.append(doc)

    for doc in merged:
        if doc == met:
            times += 1
            continue
        if met is not None:
            settle(met, times)
        met, times = doc, 1
    if met is not None:
        settle(met, times)
    return out


def _cell(percent: int, all_links: bool):
    """Search of one cell: its query rows against its index rows."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        index = pdf[pdf.role == 0].reset_index(drop=True)
        queries = pdf[pdf.role == 1].sort_values("sig")
        sigs = index.sig.to_numpy()
        sizes = index.n.to_numpy()
        grams = [np.frombuffer(x, np.uint64) for x in index.grams]
        of = np.repeat(np.arange(len(index)), [len(g) for g in grams])
        flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        # only the n-grams that some query has need lists
        asked = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in queries.grams])) if len(queries) else flat[:0]
        if not len(asked) or not len(flat):
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        at = np.minimum(np.searchsorted(asked, flat), len(asked) - 1)
        use = asked[at] == flat
        flat, of = flat[use], of[use]
        order = np.lexsort((of, flat))
        flat, of = flat[order], of[order]
        at, length = _by_key(flat)
        lists = {int(flat[s]): of[s : s + k] for s, k in zip(at.tolist(), length.tolist())}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        for s, to in zip(index.sig.tolist() + queries.sig.tolist(), index.linked.tolist() + queries.linked.tolist()):
            parent[root(s)] = root(to)
        names = sigs.tolist()
        out = []
        for s, n, g in zip(queries.sig.tolist(), queries.n.tolist(), queries.grams):

            def skip(doc: int, s=s) -> bool:
                return names[doc] == s or not all_links and root(names[doc]) == root(s)

            for doc in divide_skip(np.frombuffer(g, np.uint64), lists, need(n, percent), sizes, n, percent, skip):
                if all_links or root(names[doc]) != root(s):
                    parent[root(names[doc])] = root(s)
                    out.append((s, names[doc]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return search


def class_links(sets: DataFrame, families: DataFrame, percent: int, all_links: bool = False) -> DataFrame:
    """(u, v): links between classes. With ``all_links`` every link, both
    ways; else enough of them to connect what is connected."""

    @F.pandas_udf("double")
    def mean_band(n: pd.Series, bands: pd.Series) -> pd.Series:
        return pd.Series([int(np.frombuffer(b, np.uint8).sum()) / max(m, 1) for m, b in zip(n, bands)], dtype=float)

    # what is known of a family (its salts, leader, blocks) meets its members as
    # narrow rows; the sets themselves move by class, or by family and salt
    named = sets.select("sig", "n", F.length("grams").alias("bytes"), "bands").join(
        families.select(F.col("node").alias("sig"), F.col("root").alias("family")), "sig"
    ).select("sig", "family", "bytes", mean_band("n", "bands").alias("score"))
    named = save(named, "family-members")
    heads = named.groupBy("family").agg(
        F.max(F.struct("score", "sig")).alias("x"), F.ceil(F.sum("bytes") / F.lit(SALT_BYTES)).cast("int").alias("salts")
    ).select("family", F.col("x.sig").alias("leader"), "salts")
    heads = save(heads, "family-heads")
    placed = named.join(heads, "family").select("sig", "family", "leader", F.pmod(F.xxhash64("sig"), F.col("salts")).cast("int").alias("salt"))
    rows = save(sets.select("sig", "n", "grams").join(placed, "sig"), "families")
    leaders = rows.where("sig = leader").drop("salt", "leader", "sig").withColumnsRenamed({"n": "ln", "grams": "lg"}).join(heads.select("family", "salts"), "family")
    leaders = leaders.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")

    def against(batches):
        for pdf in batches:
            close = [
                s == ls or similar(overlap(np.sort(np.frombuffer(g, np.uint64)), np.sort(np.frombuffer(lg, np.uint64))), n, ln, percent)
                for s, n, g, ls, ln, lg in zip(pdf.sig, pdf.n, pdf.grams, pdf.leader, pdf.ln, pdf.lg)
            ]
            linked = np.where(close, pdf.leader, pdf.sig)
            yield pd.DataFrame({"sig": pdf.sig, "family": pdf.family, "leader": pdf.leader, "linked": linked.astype(np.int64), "bytes": [len(g) for g in pdf.grams]})

    tested = save(
        rows.join(leaders, ["family", "salt"]).select("family", "sig", "n", "grams", "leader", "ln", "lg").mapInPandas(
            against, "sig long, family long, leader long, linked long, bytes long"
        ),
        "leader-links",
    )
    direct = tested.where("linked <> sig").select(F.col("sig").alias("u"), F.col("linked").alias("v"))
    # a leader has met its whole family; it need not ask again
    asks = F.lit(True) if all_links else (F.col("linked") == F.col("sig")) & (F.col("sig") != F.col("leader"))
    asking = tested.withColumn("asks", asks)
    plan = asking.groupBy("family").agg(
        F.sum("bytes").alias("all_bytes"), F.sum(F.when(F.col("asks"), F.col("bytes")).otherwise(0)).alias("ask_bytes")
    ).where("ask_bytes > 0").select(
        "family",
        F.ceil(F.col("all_bytes") / F.lit(8 * PART)).cast("int").alias("blocks"),
        F.ceil(F.col("ask_bytes") / F.lit(8 * QUERIES)).cast("int").alias("rounds"),
    )
    todo = rows.select("sig", "n", "grams").join(asking.join(plan, "family").select("sig", "family", "linked", "asks", "blocks", "rounds"), "sig")
    block = F.pmod(F.xxhash64("sig"), F.col("blocks")).cast("int")
    turn = F.pmod(F.xxhash64("sig", F.lit(7)), F.col("rounds")).cast("int")
    as_index = todo.withColumn("role", F.lit(0)).withColumn("block", block).withColumn(
        "turn", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1))
    )
    as_query = todo.where("asks").withColumn("role", F.lit(1)).withColumn("turn", turn).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    cells = as_index.unionByName(as_query).select("family", "block", "turn", "role", "sig", "n", "linked", "grams")
    searched = cells.groupBy("family", "block", "turn").applyInPandas(_cell(percent, all_links), "u long, v long")
    if all_links:
        return searched
    return direct.union(searched)


def with_components(docs: DataFrame, text: str, doc_id: str, n: int, percent: int) -> DataFrame:
    """(doc_id, copy, n_shingles, root, component_id) of every row: ``copy``
    tells rows with one id apart by their text, ``root`` names the component
    (null without words), ``component_id`` is its smallest doc_id."""
    base, hot = _sets(docs, text, doc_id, n)
    total = base.agg(F.sum("n_shingles")).first()[0] or 0
    classes = base.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("low"))
    sets = _shared(docs, text, n, percent, total, hot)
    sizes = sets.agg(F.sum(F.length("grams") / 8)).first()[0] or 0
    families = _families(sets, percent, int(sizes))
    roots = components(class_links(sets, families, percent))
    named = classes.join(roots.withColumnRenamed("node", "sig"), "sig", "left").select(
        "sig", "low", F.coalesce("root", "sig").alias("root")
    )
    names = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_class = named.join(names, "root").select(F.col("sig").alias("key"), "root", "component_id")
    return (
        base.withColumn("key", F.when(F.col("n_shingles") > 0, F.col("sig")))
        .join(by_class, "key", "left")
        .select(
            "doc_id", "copy", "n_shingles", "root",
            F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def ngram_jaccard_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``; the
    component's name is its smallest doc_id. See the module for the method."""
    return with_components(docs, text, doc_id, n, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (a null id
    comes last), then the smallest text hash. Documents without words are in
    no component and stay; rows that are equal in id and text are one."""
    rows = with_components(docs, text, doc_id, n, percent).withColumn("order", F.struct(F.col("doc_id").isNull(), "doc_id", "copy"))
    first = rows.where("root is not null").groupBy("root").agg(F.min("order").alias("o")).select("o.doc_id", "o.copy")
    kept = first.union(rows.where("root is null").select("doc_id", "copy")).distinct().select(
        F.coalesce("doc_id", F.lit(0)).alias("__id"), F.col("doc_id").isNull().alias("__none"), F.col("copy").alias("__copy")
    )
    own = docs.withColumns(
        {"__id": F.coalesce(F.col(doc_id).cast("long"), F.lit(0)), "__none": F.col(doc_id).cast("long").isNull(), "__copy": F.xxhash64(F.col(text).cast("string"))}
    )
    keys = ["__id", "__none", "__copy"]
    return own.join(kept, keys, "left_semi").dropDuplicates(keys).select(*[F.col(f"`{c}`") for c in docs.columns])


def ngram_jaccard_links(docs: DataFrame, text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(u, v) signatures of every pair of similar classes, both ways round:
    the join itself, for callers that need every link and not components."""
    base, hot = _sets(docs.withColumn("__none", F.lit(None)), text, "__none", n)
    total = base.agg(F.sum("n_shingles")).first()[0] or 0
    sets = _shared(docs, text, n, percent, total, hot)
    sizes = sets.agg(F.sum(F.length("grams") / 8)).first()[0] or 0
    return class_links(sets, _families(sets, percent, int(sizes)), percent, all_links=True).distinct()
