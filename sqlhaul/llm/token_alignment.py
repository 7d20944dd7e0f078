"""Alignment of two tokenizers by a galloping intersection of token ends.

1. *Tokens.* Every whole text, with a space before it, is cut by a byte-level
   BPE (A) and by a piece model (B, which adds that space). Both must give back
   the bytes they were given; a text where one does not has no tokens.
2. *Galloping.* A text's shorter list of token ends is looked up in its longer
   one: from the place of an earlier end, steps of 1, 2, 4, ... until the end is
   passed, then a binary search in the last step (``gallop``). Many ends
   gallop at once, each from the nearest one already placed.
3. *Slices and ranges.* Where an end is in both lists, both are cut: the groups.
   The ranks of a token's two ends in the other list bound the tokens that it
   overlaps: its links (``align``).
4. *Counts.* Tasks hand texts on in parts of about ``PART_BYTES``, each with its
   distinct links and the number of its documents that hold them. Those are
   added up over the corpus, and each A id's highest is found; then a part gets
   back the counts of its own links (a cogroup by part) and scores its
   documents. What is shuffled are the parts' distinct links and the documents'
   packed ones, never a row for each link; no part grows with the table.

Defined results: null and empty texts, and those that a tokenizer does not give
back, have no tokens and zeros; every row is a document, so repeated rows count
again; null ids stay; an empty table has no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, ship, text_steps
from sqlhaul.llm.rans_tokens import tokenizer

#: Bytes of text that a part has about, or one text.
PART_BYTES = 16 << 20
#: Bytes of text that are aligned in one step, or one text.
STEP = 1 << 20
#: Bits of a link (A's id times B's size plus B's id) beside a step's text number.
KEY_BITS = 40


# ------------------------------------------------------------ intersection


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short`` how many of ``long`` are smaller (both ascending):
    exponential, then binary search from the place of an earlier element."""
    n, m = len(short), len(long)
    found = np.zeros(n, np.int64)
    stride = 1 << max(n - 1, 0).bit_length()
    lanes, start = np.arange(min(n, 1)), np.zeros(min(n, 1), np.int64)
    while True:
        x = short[lanes]
        low, high = start, start.copy()  # all before low are smaller
        step, going = 1, np.arange(len(lanes))
        while len(going):
            at = high[going]
            more = at < m
            more[more] = long[at[more]] < x[going[more]]
            going, at = going[more], at[more]
            low[going] = at + 1
            high[going] = np.minimum(at + 1 + step, m)
            step *= 2
        going = np.flatnonzero(low < high)
        while len(going):
            mid = (low[going] + high[going]) >> 1
            less = long[mid] < x[going]
            low[going] = np.where(less, mid + 1, low[going])
            high[going] = np.where(less, high[going], mid)
            going = going[low[going] < high[going]]
        found[lanes] = low
        stride >>= 1
        if not stride:
            return found
        lanes = np.arange(stride, n, 2 * stride)
        start = found[lanes - stride]


def align(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(indices of the common ends in ``short``, and in ``long``; first and last
    token of ``long`` that each token of ``short`` overlaps) for two lists of
    ends of the same bytes."""
    rank = gallop(short, long)
    common = long[np.minimum(rank, len(long) - 1)] == short if len(long) else np.zeros(len(short), bool)
    first = np.zeros(len(short), np.int64)
    first[1:] = (rank + common)[:-1]
    at = np.flatnonzero(common)
    return at, rank[at], first, rank


# ---------------------------------------------------------------- tokens


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level BPE files write bytes: printable Latin-1
    ones stand for themselves, the others for 256 and up, in order."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Entries:
    """The bytes of a vocabulary's entries, and texts of their ids."""

    def __init__(self, entries: list[bytes]):
        self.width = np.array([len(x) for x in entries], np.int64)
        self.start = np.r_[0, np.cumsum(self.width)[:-1]]
        self.pool = np.frombuffer(b"".join(entries), np.uint8)
        self.ends = {e: np.array([b"%d%s" % (i, e) for i in range(len(entries))], object) for e in (b",", b"|", b";", b"")}

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        size = self.width[ids]
        total = np.cumsum(size)
        place = np.arange(total[-1] if len(total) else 0)
        return self.pool[place + np.repeat(self.start[ids] - (total - size), size)]


class TokenizerPair:
    """Both tokenizers of a worker."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = tokenizer(path_a)
        letter = byte_letters()
        vocab = self.a.model.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            entries[i] = bytes(letter[c] for c in token)
        self.entries_a = Entries(entries)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size = self.b.get_piece_size()
        if len(entries) * size >> KEY_BITS:
            raise ValueError("the vocabularies are too large for a link's bits")
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.entries_b = Entries([
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ])

    def ids_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.b.encode(texts, out_type=int, num_threads=1)
        size = np.array([len(x) for x in got], np.int64)
        flat = np.empty(int(size.sum()), np.int64)
        at = 0
        for x in got:
            flat[at : at + len(x)] = x
            at += len(x)
        return flat, size


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space before each."""
    out = np.full(len(data) + len(offsets) - 1, 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    wide = offsets + np.arange(len(offsets))
    keep[wide[:-1]] = False
    out[keep] = data
    return out, wide


def _given_back(entries: Entries, ids: np.ndarray, size: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the tokens of each text spell its bytes."""
    rows = len(size)
    row = np.repeat(np.arange(rows), size)
    same = np.bincount(row, entries.width[ids], rows).astype(np.int64) == np.diff(offsets)
    wrong = entries.spelled(ids[same[row]]) != data[np.repeat(same, np.diff(offsets))]
    bad = np.bincount(np.repeat(np.flatnonzero(same), np.diff(offsets)[same]), wrong, rows)
    return same & (bad == 0)


def align_texts(pair: TokenizerPair, texts: list[str | None], data: np.ndarray, offsets: np.ndarray) -> dict[str, list]:
    """For each text n_a, n_b, n_groups, n_links, groups_sha256, and its distinct
    links (a * B's size + b) with how often it has them."""
    rows = len(texts)
    data, offsets = _spaced(data, offsets)
    ids_a, size_a = pair.a.ids(data, offsets)
    ids_a = ids_a.astype(np.int64)
    ids_b, size_b = pair.ids_b([t or "" for t in texts])
    good = np.diff(offsets) > 1
    good &= _given_back(pair.entries_a, ids_a, size_a, data, offsets) & _given_back(pair.entries_b, ids_b, size_b, data, offsets)
    out = {
        "n_a": np.where(good, size_a, 0), "n_b": np.where(good, size_b, 0), "n_groups": np.zeros(rows, np.int64),
        "n_links": np.zeros(rows, np.int64), "groups_sha256": [""] * rows, "pairs": [b""] * rows, "times": [b""] * rows,
    }
    row_a, row_b = np.repeat(np.arange(rows), size_a), np.repeat(np.arange(rows), size_b)
    for chosen, b_drives in ((good & (size_b <= size_a), True), (good & (size_b > size_a), False)):
        of = np.flatnonzero(chosen)
        if not len(of):
            continue
        a, b = ids_a[chosen[row_a]], ids_b[chosen[row_b]]
        # the chosen texts' bytes one after the other: their last ends are common
        ends_a, ends_b = np.cumsum(pair.entries_a.width[a]), np.cumsum(pair.entries_b.width[b])
        short, long = (ends_b, ends_a) if b_drives else (ends_a, ends_b)
        cut_s, cut_l, first, last = align(short, long)
        many = last - first + 1
        total = np.cumsum(many)
        in_short = np.repeat(np.arange(len(short)), many)
        in_long = np.arange(total[-1]) + np.repeat(first - (total - many), many)
        at_a, at_b, cut_a, cut_b = (in_long, in_short, cut_l, cut_s) if b_drives else (in_short, in_long, cut_s, cut_l)
        row = row_a[chosen[row_a]]
        links = np.bincount(row[at_a], minlength=rows)
        out["n_links"] += links
        out["n_groups"] += np.bincount(row[cut_a], minlength=rows)
        # written groups: A's ids of a group, then B's
        group_a, group_b = np.searchsorted(cut_a, np.arange(len(a))), np.searchsorted(cut_b, np.arange(len(b)))
        words = np.empty(len(a) + len(b), object)
        entry_a, entry_b = pair.entries_a.ends, pair.entries_b.ends
        place_a = np.arange(len(a)) + np.r_[0, cut_b + 1][group_a]
        place_b = np.arange(len(b)) + (cut_a + 1)[group_b]
        words[place_a] = entry_a[b","][a]
        words[place_a[cut_a]] = entry_a[b"|"][a[cut_a]]
        words[place_b] = entry_b[b","][b]
        words[place_b[cut_b]] = entry_b[b";"][b[cut_b]]
        ends_of = np.cumsum(size_b[of]) - 1
        words[place_b[ends_of]] = entry_b[b""][b[ends_of]]
        upto = np.cumsum(size_a[of] + size_b[of])
        # a text's distinct links, in order of text and link
        both = np.sort(row[at_a] << KEY_BITS | a[at_a] * len(pair.entries_b.width) + b[at_b])
        begin = np.flatnonzero(np.r_[True, both[1:] != both[:-1]])
        times = np.diff(np.r_[begin, len(both)]).astype("<i4")
        distinct, owner = (both[begin] & (1 << KEY_BITS) - 1).astype("<i8"), both[begin] >> KEY_BITS
        bound = np.searchsorted(owner, np.r_[of, rows])
        for i, x in enumerate(of.tolist()):
            out["groups_sha256"][x] = hashlib.sha256(b"".join(words[upto[i] - size_a[x] - size_b[x] : upto[i]].tolist())).hexdigest()
            out["pairs"][x] = distinct[bound[i] : bound[i + 1]].tobytes()
            out["times"][x] = times[bound[i] : bound[i + 1]].tobytes()
    return out


# ------------------------------------------------------------ the operator

_PAIRS: dict[tuple[str, str], TokenizerPair] = {}


def _pair(path_a: str, path_b: str) -> TokenizerPair:
    """One for each worker process and files."""
    if (path_a, path_b) not in _PAIRS:
        _PAIRS[path_a, path_b] = TokenizerPair(path_a, path_b)
    return _PAIRS[path_a, path_b]


ALIGNED = pa.schema([
    ("part", pa.int64()), ("doc_id", pa.int64()), ("document", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
])


def aligned(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """The stored alignments: a row for each document, with its distinct links
    packed (``pairs`` 8 bytes, ``times`` 4 bytes each), and one row for each
    part (``document`` false), with the part's distinct links and the number
    of its documents that hold them."""
    ship(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = _pair(path_a, path_b)
        part, held = TaskContext.get().partitionId() << 32, 0
        met: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            keys, back = np.unique(np.concatenate([k for k, _ in met]), return_inverse=True)
            number = np.bincount(back, np.concatenate([n for _, n in met]), len(keys))
            row = {"part": part, "document": False, "pairs": keys.astype("<i8").tobytes(), "times": number.astype("<i4").tobytes()}
            return pa.RecordBatch.from_pylist([row], schema=ALIGNED)

        for batch in batches:
            texts = batch.column(1)
            for first, data, offsets in text_steps(texts, STEP):
                rows = len(offsets) - 1
                got = align_texts(pair, texts.slice(first, rows).to_pylist(), data, offsets)
                # a document has each of its links once here: count documents
                met.append(np.unique(np.frombuffer(b"".join(got["pairs"]), "<i8"), return_counts=True))
                n = [pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, part), pa.int64()), batch.column(0).slice(first, rows), pa.array([True] * rows), *n,
                        pa.array(got["groups_sha256"], pa.string()), pa.array(got["pairs"], pa.binary()), pa.array(got["times"], pa.binary()),
                    ],
                    schema=ALIGNED,
                )
                held += len(data)
                if held >= part_bytes:
                    yield close()
                    part, held, met = part + 1, 0, []
        if met:
            yield close()

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "part long, doc_id long, document boolean, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
    return save(rows.mapInArrow(read, schema), "token-alignment")


def link_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(part, pair, documents, best): for each part's distinct links the number
    of documents that hold them in the whole corpus, and whether no other link
    of the same A id has more. Stored."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pairs, times in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                key, n = np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i4")
                for a in range(0, len(key), 100_000):
                    b = a + 100_000
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key[a:b]), part), pa.int64()), pa.array(key[a:b], pa.int64()), pa.array(n[a:b].astype(np.int64))], names=["part", "pair", "n"]
                    )

    packed = rows.where("not document").select("part", "pairs", "times")
    each = save(packed.mapInArrow(unpack, "part long, pair long, n long"), "part-links")
    total = save(each.groupBy("pair").agg(F.sum("n").alias("documents")).withColumn("a", F.expr(f"pair DIV {size_b}")), "links")
    top = total.groupBy("a").agg(F.max("documents").alias("top"))
    total = total.join(top, "a").select("pair", "documents", (F.col("documents") == F.col("top")).alias("best"))
    return save(each.select("part", "pair").join(total, "pair"), "part-counts")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, text: str = "text", doc_id: str = "doc_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = aligned(docs, path_a, path_b, text, doc_id, part_bytes)
    counts = link_counts(rows, size_b)

    def score(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values("pair")
        keys, documents = known["pair"].to_numpy(np.int64), known["documents"].to_numpy(np.int64)
        best = known["best"].to_numpy(bool)
        size = np.array([len(x) // 8 for x in own["pairs"]], np.int64)
        at = np.searchsorted(keys, np.frombuffer(b"".join(own["pairs"]), "<i8"))
        times = np.frombuffer(b"".join(own["times"]), "<i4").astype(np.int64)
        upto = np.r_[0, np.cumsum(size)]

        def per_row(x: np.ndarray) -> np.ndarray:
            return np.diff(np.r_[0, np.cumsum(x)][upto])

        out = own.drop(columns=["part", "pairs", "times"])
        out["n_best"] = per_row(times * best[at]) if len(at) else 0
        out["count_sum"] = per_row(times * documents[at]) if len(at) else 0
        return out

    # ids as text: pandas would make floats of whole numbers beside a null
    documents = rows.where("document").drop("document").withColumn("doc_id", F.col("doc_id").cast("string"))
    made = documents.groupBy("part").cogroup(counts.groupBy("part")).applyInPandas(
        score, "doc_id string, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    )
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))
