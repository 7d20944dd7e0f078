"""Token ids as binary files coded with a static range asymmetric numeral system.

Documents are dealt out in ascending id order (range partitioning), tokenized
where they land and appended to files of bounded size. A file is coded at
once: its own symbol counts give one static frequency table, shared by all of
its blocks; a block is a fixed number of ids, coded by ``LANES`` interleaved
64-bit states that give 32-bit words to one stream. Every block stands alone
(its words, a CRC-32 and its states), and has checkpoints (all states and the
place in the stream) from which a decoder can start, so blocks, and parts of
blocks, decode in parallel.

Tasks write under names of their own and hand back a manifest row for each
file; the manifest is a table that Spark commits. What a lost or repeated task
has written is in no manifest and is never read.

File layout, little-endian: ``MAGIC``; u32 length and u32 CRC-32 of the
header; the header (JSON: counts and the length of each section); then the
sections in the header's order (``SECTIONS``).
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import SMALL_STEP, save, ship, slice_hashes, text_steps
from sqlhaul.session import scratch_dir

MAGIC = b"SQHRANS1"
#: Ids in a block, interleaved states, steps of a state between checkpoints.
BLOCK, LANES, MARK = 65536, 64, 256
#: Ids after which a file is closed (a document is never split).
FILE_IDS = 4_000_000
#: Blocks that are coded together.
GROUP = 8
LOW = np.uint64(1 << 31)
SECTIONS = {
    "symbols": "<u4", "freqs": "<u4", "doc_ids": "<i8", "doc_nulls": "<u1", "doc_lengths": "<u8",
    "block_words": "<u4", "block_crc": "<u4", "marks": "<u8", "mark_words": "<u4", "words": "<u4",
}
#: Token chunks kept by a worker (about 30 bytes each), the longest one kept, and
#: those that are given to the tokenizer as one text, or as one batch.
CACHE, CACHED_BYTES, TOGETHER, BATCH = 2_000_000, 64, 128, 1024

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: Bytes that, after a space, are no white space: printable ASCII, and lead bytes
#: that start none.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = _PLAIN[0xC3:] = True
_PLAIN[0xE1:0xE4] = False


# ---------------------------------------------------------------- coder


def quantise(counts: np.ndarray, bits: int) -> np.ndarray:
    """Frequencies of at least 1 that add up to ``2**bits``, near ``counts``."""
    m = 1 << bits
    f = np.maximum(1, np.floor(counts * (m / counts.sum())).astype(np.int64))
    order = np.argsort(-counts, kind="stable")
    rest = m - int(f.sum())
    if rest > 0:
        f[order[0]] += rest
    k = 0
    while rest < 0:  # the rare symbols took more than their share
        take = min(int(f[order[k]]) - 1, max(1, int(f[order[k]]) // 2), -rest)
        f[order[k]] -= take
        rest += take
        k = (k + 1) % len(order)
    return f.astype(np.uint64)


def table_bits(symbols: int) -> int:
    return max(14, int(np.ceil(np.log2(max(symbols, 2)))) + 2)


def encode_blocks(ids: np.ndarray, number: np.ndarray, freqs: np.ndarray, bits: int) -> dict[str, np.ndarray]:
    """Code ids, by their symbol numbers, as blocks; the sections of blocks and words."""
    cum = np.r_[np.uint64(0), np.cumsum(freqs)[:-1]].astype(np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    out: dict[str, list] = {k: [] for k in ("block_words", "block_crc", "marks", "mark_words", "words")}
    steps = BLOCK // LANES
    # a state that would outgrow 63 bits gives its low word first
    shift, scale, room = np.uint64(32), np.uint64(bits), np.uint64(63 - bits)
    for b in range(0, blocks, GROUP):
        part = number[ids[b * BLOCK : (b + GROUP) * BLOCK]]
        k = -(-len(part) // BLOCK)
        # the last block is filled up with symbol 0; the counts say where it ends
        full = np.zeros(k * BLOCK, part.dtype)
        full[: len(part)] = part
        grid = np.ascontiguousarray(full.reshape(k, steps, LANES).transpose(1, 0, 2).reshape(steps, k * LANES))
        x = np.full(k * LANES, LOW, np.uint64)
        words = np.empty((steps, k * LANES), np.uint32)
        gave = np.empty((steps, k * LANES), bool)
        marks = np.empty((steps // MARK, k * LANES), np.uint64)
        for t in range(steps - 1, -1, -1):
            f = freqs[grid[t]]
            over = x >= f << room
            words[t] = x
            gave[t] = over
            x = x >> (over * shift)
            q = x // f
            x = (q << scale) + (x - q * f) + cum[grid[t]]
            if t % MARK == 0:
                marks[t // MARK] = x
        per = gave.reshape(steps, k, LANES)
        count = per.sum(2)
        before = np.zeros((steps, k), np.int64)
        np.cumsum(count[:-1], 0, out=before[1:])
        out["mark_words"].append(before[::MARK].T.astype(np.uint32).ravel())
        out["marks"].append(marks.reshape(steps // MARK, k, LANES).transpose(1, 0, 2).ravel())
        w = words.reshape(steps, k, LANES)
        for i in range(k):
            stream = w[:, i][per[:, i]]
            out["words"].append(stream)
            out["block_words"].append(np.uint32([len(stream)]))
            out["block_crc"].append(np.uint32([zlib.crc32(stream.tobytes())]))
    return {k: np.concatenate(v) if v else np.zeros(0, SECTIONS[k]) for k, v in out.items()}


def decode_blocks(sections: dict[str, np.ndarray], n: int, bits: int, first: int = 0, last: int | None = None, mark: int = 0) -> np.ndarray:
    """Symbol numbers of the blocks ``first`` to ``last`` (exclusive), each
    from its checkpoint ``mark`` on. Raises ``ValueError`` on a bad checksum."""
    freqs = sections["freqs"].astype(np.uint64)
    cum = np.r_[np.uint64(0), np.cumsum(freqs)[:-1]].astype(np.uint64)
    slot = np.repeat(np.arange(len(freqs), dtype=np.uint32), freqs.astype(np.int64))
    width, inside = freqs[slot], np.arange(len(slot), dtype=np.uint64) - cum[slot]
    blocks = len(sections["block_words"])
    last = blocks if last is None else last
    start = np.r_[0, np.cumsum(sections["block_words"].astype(np.int64))]
    steps, per = BLOCK // LANES, BLOCK // LANES // MARK
    shift, scale, mask = np.uint64(32), np.uint64(bits), np.uint64((1 << bits) - 1)
    words = sections["words"]
    out = []
    for b in range(first, last, GROUP):
        ids = np.arange(b, min(b + GROUP, last))
        k = len(ids)
        for i in ids.tolist():
            if zlib.crc32(words[start[i] : start[i + 1]].tobytes()) != int(sections["block_crc"][i]):
                raise ValueError(f"block {i}: checksum mismatch")
        x = np.ascontiguousarray(sections["marks"].reshape(blocks, per, LANES)[ids, mark]).ravel()
        at = start[ids] + sections["mark_words"].reshape(blocks, per)[ids, mark]
        stream = np.r_[words[start[ids[0]] : start[ids[-1] + 1]], np.zeros(LANES, np.uint32)].astype(np.uint64)
        at = at - start[ids[0]]
        from_step = mark * MARK
        grid = np.empty((steps - from_step, k * LANES), np.uint32)
        for t in range(steps - from_step):
            low = x & mask
            grid[t] = low
            x = width[low] * (x >> scale) + inside[low]
            want = (x < LOW).reshape(k, LANES)
            place = np.cumsum(want, 1)
            w = want.ravel()
            x[w] = (x[w] << shift) | stream[(place + (at[:, None] - 1)).ravel()[w]]
            at = at + place[:, -1]
        out.append(slot[grid].reshape(steps - from_step, k, LANES).transpose(1, 0, 2).reshape(k, -1))
    if not out:
        return np.zeros(0, np.uint32)
    got = np.concatenate(out)
    if last == blocks and n < blocks * BLOCK:
        return got.ravel()[: got.size - (blocks * BLOCK - n)]
    return got.ravel()


def id_counts(ids: np.ndarray) -> np.ndarray:
    """How often each id is there; counted in slices, as each is widened."""
    counts = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    for a in range(0, len(ids), GROUP * BLOCK):
        counts += np.bincount(ids[a : a + GROUP * BLOCK], minlength=len(counts))
    return counts


def file_parts(ids: np.ndarray, doc_ids: np.ndarray, doc_nulls: np.ndarray, lengths: np.ndarray) -> list:
    """The buffers that make a whole file, one after the other, for the ids of
    some documents."""
    counts = id_counts(ids)
    symbols = np.flatnonzero(counts)
    bits = table_bits(len(symbols))
    freqs = quantise(counts[symbols], bits) if len(symbols) else np.zeros(0, np.uint64)
    number = np.zeros(len(counts), np.uint32)
    number[symbols] = np.arange(len(symbols))
    body = encode_blocks(ids, number, freqs, bits) | {"symbols": symbols, "freqs": freqs, "doc_ids": doc_ids, "doc_nulls": doc_nulls, "doc_lengths": lengths}
    parts = [np.ascontiguousarray(body[k], kind) for k, kind in SECTIONS.items()]
    header = json.dumps({"n_ids": len(ids), "bits": bits, "block": BLOCK, "lanes": LANES, "mark": MARK, "bytes": [p.nbytes for p in parts], "crc": [zlib.crc32(p) for p in parts[:-1]]}).encode()
    return [MAGIC, struct.pack("<II", len(header), zlib.crc32(header)), header, *parts]


def pack_file(ids: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """A whole file for the ids of some documents, one after the other."""
    return b"".join(file_parts(ids, np.array([x or 0 for x in doc_ids], np.int64), np.array([x is None for x in doc_ids], np.uint8), lengths))


def unpack_file(raw: bytes) -> tuple[dict, dict[str, np.ndarray]]:
    """(header, sections); raises ``ValueError`` where a checksum is wrong."""
    if raw[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    size, crc = struct.unpack_from("<II", raw, len(MAGIC))
    at = len(MAGIC) + 8
    if zlib.crc32(raw[at : at + size]) != crc:
        raise ValueError("header: checksum mismatch")
    header = json.loads(raw[at : at + size])
    if (header["block"], header["lanes"], header["mark"]) != (BLOCK, LANES, MARK):
        raise ValueError("unknown block form")
    at += size
    sections = {}
    for i, (k, kind) in enumerate(SECTIONS.items()):
        part = raw[at : at + header["bytes"][i]]
        if i < len(header["crc"]) and zlib.crc32(part) != header["crc"][i]:
            raise ValueError(f"{k}: checksum mismatch")
        sections[k] = np.frombuffer(part, kind)
        at += len(part)
    return header, sections


# ------------------------------------------------------------ tokenizing


class ChunkTokenizer:
    """A byte-level BPE file applied to columns of texts.

    A space before anything that is not white space always starts a new
    pre-token, and so does an ASCII character that is no letter after an ASCII
    letter; a text is cut there into chunks whose ids do not depend on each
    other. Each different chunk is given to the tokenizer once (as long as it
    stays cached); the ids of a column are gathered from the chunks'. The cache
    is arrays sorted by the chunks' hashes, its ids as narrow as the vocabulary
    allows; when it is full, the chunks that have not been met since it was full
    before go. Strings of special tokens are
    ordinary text.
    """

    def __init__(self, path: str, cache: int = CACHE):
        # one thread: a task has one core
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        vocab = self.model.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.width[i] = len(token)
        self.cache = cache
        self.kind = np.uint16 if len(self.width) <= 1 << 16 else np.uint32
        # chunks by number: where their ids are; by hash: their numbers, the latest apart
        self.starts, self.sizes, self.met = np.zeros(0, np.uint32), np.zeros(0, np.uint16), np.zeros(0, bool)
        self.keys, self.rows = self.late_keys, self.late_rows = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.pool, self.used = np.empty(1 << 16, self.kind), 0

    def _merge(self) -> None:
        """Put the latest chunks among the others."""
        at = np.searchsorted(self.keys, self.late_keys)
        self.keys, self.rows = np.insert(self.keys, at, self.late_keys), np.insert(self.rows, at, self.late_rows)
        self.late_keys, self.late_rows = np.zeros(0, np.uint64), np.zeros(0, np.uint32)

    def _turn(self) -> None:
        """Forget the chunks that were not met since the last turn."""
        self._merge()
        keep = self.met
        mine = keep[self.rows]
        self.keys, self.rows = self.keys[mine], (np.cumsum(keep, dtype=np.uint32) - np.uint32(1))[self.rows[mine]]
        self.starts, self.sizes = self.starts[keep], self.sizes[keep]
        pool, self.used = np.empty(max(int(self.sizes.sum(dtype=np.int64)), 1 << 16), self.kind), 0
        for a in range(0, len(self.sizes), 1 << 16):  # in slices: the places of all ids are four times the pool
            starts, sizes = self.starts[a : a + (1 << 16)], self.sizes[a : a + (1 << 16)].astype(np.int64)
            ends = self.used + np.cumsum(sizes)
            pool[self.used : ends[-1]] = self.pool[np.arange(self.used, ends[-1]) + np.repeat(starts - (ends - sizes), sizes)]
            self.starts[a : a + (1 << 16)] = ends - sizes
            self.used = int(ends[-1])
        self.pool, self.met = pool, np.zeros(len(self.sizes), bool)

    def _put(self, keys: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Add the ids of new chunks, in the order of their hashes."""
        if self.used + len(ids) > len(self.pool):
            more = np.empty(max(self.used + len(ids), len(self.pool) * 3 // 2), self.kind)
            more[: self.used] = self.pool[: self.used]
            self.pool = more
        self.pool[self.used : self.used + len(ids)] = ids
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)
        at = np.searchsorted(self.late_keys, keys)
        rows = np.arange(len(self.sizes), len(self.sizes) + len(keys), dtype=np.uint32)
        self.late_keys, self.late_rows = np.insert(self.late_keys, at, keys), np.insert(self.late_rows, at, rows)
        self.starts, self.sizes = np.append(self.starts, starts.astype(np.uint32)), np.append(self.sizes, sizes.astype(np.uint16))
        self.met = np.append(self.met, np.ones(len(keys), bool))
        if len(self.late_keys) > max(1 << 14, len(self.keys) >> 3):
            self._merge()

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in the cache, whether it is there) of ascending hashes."""
        found, have = np.zeros(len(keys), np.uint32), np.zeros(len(keys), bool)
        for known, rows in ((self.keys, self.rows), (self.late_keys, self.late_rows)):
            at = np.searchsorted(known, keys)
            here = at < len(known)
            here[here] = known[at[here]] == keys[here]
            found[here] = rows[at[here]]
            have |= here
        return found, have

    def _learn(self, keys: np.ndarray, texts: list[bytes]) -> None:
        """Tokenize new chunks, given in the order of their hashes, and keep
        their ids. Those of a space and a plain character go to the tokenizer
        many as one text, cut again by the tokens' bytes."""
        got: list = [None] * len(texts)
        lead = [i for i, x in enumerate(texts) if len(x) > 1 and x[0] == 0x20 and _PLAIN[x[1]]]
        for a in range(0, len(lead), TOGETHER):
            group = lead[a : a + TOGETHER]
            joined = b"".join([texts[i] for i in group]).decode()
            ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.cumsum([len(texts[i]) for i in group])
            cuts = np.searchsorted(np.cumsum(self.width[ids]), ends - 1, side="right") + 1
            low = 0
            for i, high in zip(group, cuts.tolist()):
                got[i] = ids[low:high]
                low = high
        rest = [i for i, x in enumerate(got) if x is None]
        for a in range(0, len(rest), BATCH):
            group = rest[a : a + BATCH]
            for i, e in zip(group, self.model.encode_batch_fast([texts[i].decode() for i in group], add_special_tokens=False)):
                got[i] = np.array(e.ids, np.uint32)
        self._put(keys, np.concatenate(got), np.array(list(map(len, got)), np.int64))

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) for texts in one buffer."""
        cut = np.zeros(len(data) + 1, bool)
        filled = np.diff(offsets) > 0
        if len(data) > 1:
            cut[:-2] = (data[:-1] == 0x20) & _PLAIN[data[1:]]
            cut[offsets[1:][filled] - 1] = False  # a space that ends a text
            letter = _LETTER[data]
            cut[1:-1] |= letter[:-1] & ~letter[1:] & (data[1:] < 0x80)
        cut[offsets[:-1][filled]] = True
        cut[len(data)] = False
        starts = np.flatnonzero(cut)
        ends = np.r_[starts[1:], len(data)] if len(starts) else starts
        back, keys = pd.factorize(slice_hashes(data, starts, ends))
        first = np.zeros(len(keys), np.int64)
        first[back[::-1]] = np.arange(len(back))[::-1]
        order = np.argsort(keys)
        at, have = self._find(keys[order])
        self.met[at[have]] = True
        long: dict[int, np.ndarray] = {}
        new = order[~have]
        if len(new):
            wide = ends[first[new]] - starts[first[new]] > CACHED_BYTES
            raw = data.tobytes()
            for i in new[wide].tolist():
                long[i] = np.array(self.model.encode(raw[starts[first[i]] : ends[first[i]]].decode(), add_special_tokens=False).ids, np.uint32)
            new = new[~wide]
            if len(new):
                if len(self.sizes) + len(new) > self.cache:
                    self._turn()
                self._learn(keys[new], [raw[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
            at, have = self._find(keys[order])
        size, at0 = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        size[order[have]], at0[order[have]] = self.sizes[at[have]], self.starts[at[have]]
        where = np.fromiter(long.keys(), np.int64, len(long))
        if long:
            size[where] = [len(x) for x in long.values()]
            at0[where] = np.cumsum(size[where]) - size[where]
        own = np.zeros(len(keys), bool)
        own[where] = True
        size, at0, own = size[back], at0[back], own[back]
        total = np.r_[0, np.cumsum(size)]
        place = np.arange(total[-1]) + np.repeat(at0 - total[:-1], size)
        if long:  # their ids are not in the pool
            own = np.repeat(own, size)
            ids = np.empty(len(place), np.uint32)
            ids[~own] = self.pool[place[~own]]
            ids[own] = np.concatenate(list(long.values()))[place[own]]
        else:
            ids = self.pool[place].astype(np.uint32)
        return ids, np.diff(total[np.searchsorted(starts, offsets)])


_MODELS: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One for each worker process and file."""
    if path not in _MODELS:
        _MODELS[path] = ChunkTokenizer(path)
    return _MODELS[path]


# ------------------------------------------------------------ the operator


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of every text, ``end_id`` after each, as token files under
    ``folder`` (a shared one) in ascending id order, null ids first, ties by
    the text's hash. Returns the manifest (part, seq, path, n_docs, n_ids), a
    committed table. Null and empty texts have the end id alone; an empty
    table has no files. Other columns are ignored.

    A worker holds one file's ids (2 or 4 bytes each, by the vocabulary) and the
    chunks it has tokenized, whatever the size of its partition; its steps and
    the file's buffers are small beside these.
    """
    ship(docs.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        model = tokenizer(tokenizer_path)
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        kind = np.promote_types(model.kind, np.min_scalar_type(end_id))
        ids, lengths, names, held = [], [], [], 0

        def close():
            nonlocal ids, lengths, names, held, seq
            path = f"{base}/part-{part:06d}-{seq:04d}-{uuid.uuid4().hex}.rans"
            whole, ids = np.concatenate(ids), []
            keys = pa.chunked_array(names)
            docs = file_parts(whole, keys.fill_null(0).to_numpy(), keys.is_null().to_numpy(), np.concatenate(lengths))
            with store.open_output_stream(path) as f:
                for x in docs:
                    f.write(x)
            row = pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": path, "n_docs": len(keys), "n_ids": held}])
            lengths, names, held, seq = [], [], 0, seq + 1
            return row

        for batch in batches:
            keys = batch.column(0)
            for row, data, offsets in text_steps(batch.column(1), min(SMALL_STEP, 4 * file_ids)):
                got, size = model.ids(data, offsets)
                size = size + 1
                ends = np.cumsum(size)
                out = np.full(int(ends[-1]), end_id, kind)
                keep = np.ones(len(out), bool)
                keep[ends - 1] = False
                out[keep] = got
                ids.append(out)
                lengths.append(size)
                names.append(pa.concat_arrays([keys.slice(row, len(size))]))  # a copy: a slice would keep its batch
                held += len(out)
                if held >= file_ids:
                    yield close()
        if names:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text")
    return save(ordered.mapInArrow(write, "part long, seq long, path string, n_docs long, n_ids long"), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, path) of every document, decoded
    from the files of a manifest: ``start`` counts the ids of all documents
    before it. Only the totals of the parts (one for each writing task) pass
    through the driver."""
    ship(manifest.sparkSession)
    base, total = {}, 0
    for r in manifest.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        base[r["part"]] = total
        total += r["n"]
    # a part has one manifest row for each of its files
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("part", "seq", "path", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("before"))
    shared = manifest.sparkSession.sparkContext.broadcast(base)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for f in batch.to_pylist():
                with store.open_input_file(f["path"]) as h:
                    header, s = unpack_file(h.read())
                ids, at, blocks = np.empty(header["n_ids"], "<u4"), 0, len(s["block_words"])
                for b in range(0, blocks, GROUP):  # the decoder's arrays are several times a group's ids
                    some = s["symbols"][decode_blocks(s, header["n_ids"], header["bits"], b, min(b + GROUP, blocks))]
                    ids[at : at + len(some)] = some
                    at += len(some)
                ends = np.cumsum(s["doc_lengths"].astype(np.int64))
                starts = np.r_[0, ends[:-1]].astype(np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                offset = shared.value[f["part"]] + f["before"]
                for a in range(0, len(crc), 10_000):
                    b = a + 10_000
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(s["doc_ids"][a:b], pa.int64(), mask=s["doc_nulls"][a:b].astype(bool)),
                            pa.array(starts[a:b] + offset), pa.array(ends[a:b] - starts[a:b]),
                            pa.array(crc[a:b], pa.int64()), pa.array([f["path"]] * len(crc[a:b])),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "path"],
                    )

    count = max(1, manifest.count())
    return files.repartition(min(count, 100_000), "path").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, path string"
    )


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, text: str = "text", doc_id: str = "doc_id", folder: str | None = None) -> DataFrame:
    """Write and read back: the decoded rows of ``read_token_files``."""
    folder = folder or scratch_dir(docs.sparkSession, "tokens")
    uri = folder if "://" in folder or folder.startswith("/") else folder.replace("file:/", "file:///", 1)
    return read_token_files(write_token_files(docs, uri, tokenizer_path, end_id, text, doc_id), uri)
