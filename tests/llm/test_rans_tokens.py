import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sqlhaul.llm import rans_tokens as R
from sqlhaul.llm.common import text_steps

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
END = 2


@pytest.fixture(scope="module")
def model():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def expected(model, rows):
    """Rows as (doc_id, start, n_tokens, ids_crc32) by brute force."""
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*model.encode(t or "", add_special_tokens=False).ids, END], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(map(tuple, df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


def test_whole_table(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert got(R.token_files(docs, PATH, END)) == expected(model, rows)


def test_edge_cases_and_small_files(spark, odd_docs, model, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    df = odd_docs.repartition(3)
    assert got(R.token_files(df, PATH, END)) == expected(model, rows)
    manifest = R.write_token_files(df, str(tmp_path / "t"), PATH, END, file_ids=30)
    assert manifest.count() > 3
    assert got(R.read_token_files(manifest, str(tmp_path / "t"))) == expected(model, rows)
    assert R.token_files(odd_docs.limit(0), PATH, END).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab 'sé\n\t 　\x1c1.-中"), max_size=30), max_size=6))
def test_chunks_are_independent(texts):
    own = R.tokenizer(PATH)
    for row, data, offsets in text_steps(pa.array(texts, pa.string())):
        ids, size = own.ids(data, offsets)
        ends = np.r_[0, np.cumsum(size)]
        for k in range(len(size)):
            assert ids[ends[k] : ends[k + 1]].tolist() == own.model.encode(texts[row + k], add_special_tokens=False).ids


@pytest.mark.parametrize("n,symbols", [(0, 5), (1, 1), (7, 3), (R.BLOCK, 2), (R.BLOCK + 1, 500), (200_000, 40_000)])
def test_round_trip_checkpoints_and_checksums(n, symbols):
    r = np.random.default_rng(n)
    ids = (r.zipf(1.4, n) % symbols).astype(np.uint32)
    raw = R.pack_file(ids, [1], np.array([n]))
    header, s = R.unpack_file(raw)
    assert (s["symbols"][R.decode_blocks(s, n, header["bits"])] == ids).all() if n else True
    blocks = len(s["block_words"])
    if blocks > 1 and n > 2 * R.BLOCK:
        part = s["symbols"][R.decode_blocks(s, n, header["bits"], 1, 2, mark=1)]
        assert (part == ids[R.BLOCK + R.MARK * R.LANES : 2 * R.BLOCK]).all()
    if n > 100:
        assert len(raw) < 4 * n + 40_000
        bad = bytearray(raw)
        bad[-3] ^= 1
        header, s = R.unpack_file(bytes(bad))
        with pytest.raises(ValueError):
            R.decode_blocks(s, n, header["bits"])
        bad = bytearray(raw)
        bad[20] ^= 1
        with pytest.raises(ValueError):
            R.unpack_file(bytes(bad))


def test_quantise():
    for counts in ([1], [1, 10**9], [1] * 5000 + [10**7], list(range(1, 3000))):
        bits = R.table_bits(len(counts))
        f = R.quantise(np.array(counts), bits)
        assert f.sum() == 1 << bits and f.min() >= 1


def test_a_full_cache_gives_the_same_ids(words_of):
    """Far more chunks than the cache holds: generations go, ids stay."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    from sqlhaul.llm.common import text_steps
    from sqlhaul.llm.queries import tokenizer_path
    from sqlhaul.llm.rans_tokens import ChunkTokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    odd = ["  two", " \n x", "it's I'M don't", "a  b", " ", "\n", "x ", "word“quote”", "tab\tx", "é'll", "<|endoftext|>", "", "end.\n\nNext", " 　x", "   ", "a,b;c 1,000.5", "\x00\x01", "Ab's"]
    texts = [" ".join(words_of(k, 60)) + odd[k % len(odd)] for k in range(300)] + odd + [a + b for a in odd for b in odd]
    model = ChunkTokenizer(tokenizer_path(), cache=500)
    for _, data, offsets in text_steps(pa.array(texts), 2000):
        ids, size = model.ids(data, offsets)
        ends = size.cumsum()
        for i in range(len(size)):
            text = bytes(data[offsets[i] : offsets[i + 1]]).decode()
            assert ids[ends[i] - size[i] : ends[i]].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
        assert len(model.keys) <= 500 + 2000


def test_the_cache_and_a_file_take_little_beside_their_ids(words_of):
    """Bytes of a cached chunk, and of packing a file beside its ids."""
    import tracemalloc

    model = R.ChunkTokenizer(PATH)
    texts = [" ".join(words_of(k, 400)) for k in range(200)]
    for _, data, offsets in text_steps(pa.array(texts), 1 << 16):
        model.ids(data, offsets)
    held = sum(x.nbytes for x in vars(model).values() if isinstance(x, np.ndarray) and x is not model.width)
    assert held < 32 * len(model.sizes)
    ids = (np.random.default_rng(1).zipf(1.4, 3_000_000) % 50_000).astype(np.uint16)
    tracemalloc.start()
    raw = R.pack_file(ids, [1], np.array([len(ids)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(ids)
    header, s = R.unpack_file(raw)
    assert (s["symbols"][R.decode_blocks(s, len(ids), header["bits"])] == ids).all()


def test_long_chunks_beside_cached_ones_over_turns(words_of):
    """Chunks that are not cached, small steps, and a cache that turns often."""
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    texts = [" ".join([*words_of(k, 30), "z" * (60 + k), *words_of(k // 2, 30), "中" * (k % 40)]) for k in range(120)]
    model = R.ChunkTokenizer(PATH, cache=400)
    for row, data, offsets in text_steps(pa.array(texts), 1500):
        ids, size = model.ids(data, offsets)
        ends = size.cumsum()
        for i in range(len(size)):
            assert ids[ends[i] - size[i] : ends[i]].tolist() == plain.encode(texts[row + i], add_special_tokens=False).ids
        assert len(model.sizes) <= 400 + 1500 and len(model.sizes) == len(model.keys) + len(model.late_keys)
