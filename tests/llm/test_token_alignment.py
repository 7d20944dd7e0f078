"""Galloping against plain search, alignments against brute force over all pairs."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sqlhaul.llm import token_alignment as ta
from sqlhaul.llm.queries import piece_path, tokenizer_path


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 300)), st.sets(st.integers(0, 300)))
def test_gallop_is_a_lower_bound(short, long):
    a, b = np.array(sorted(short), np.int64), np.array(sorted(long), np.int64)
    assert ta.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_byte_letters_cover_all_bytes():
    assert sorted(ta.byte_letters().values()) == list(range(256))


def brute(rows):
    """From the libraries' own tokens, every pair of tokens tried."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path())
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=piece_path())
    letter = ta.byte_letters()
    docs = []
    for key, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spans_a, spans_b, at = [], [], 0
        raw_a = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(raw_a) != (" " + text).encode() or b"".join(raw_b) != (" " + text).encode():
            docs.append((key, [], [], [], []))
            continue
        for raw, spans in ((raw_a, spans_a), (raw_b, spans_b)):
            at = 0
            for x in raw:
                spans.append((at, at + len(x)))
                at += len(x)
        links = [(i, j) for i, (s, e) in zip(ids_a, spans_a) for j, (p, q) in zip(ids_b, spans_b) if s < q and p < e]
        cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
        groups, low = [], 0
        for c in cuts:
            of = [[str(i) for i, (s, e) in zip(ids, spans) if low < e <= c] for ids, spans in ((ids_a, spans_a), (ids_b, spans_b))]
            groups.append(",".join(of[0]) + "|" + ",".join(of[1]))
            low = c
        docs.append((key, ids_a, ids_b, groups, links))
    count = Counter(x for d in docs for x in set(d[4]))
    top = {}
    for (i, _), n in count.items():
        top[i] = max(top.get(i, 0), n)
    return [
        (key, len(x), len(y), len(g), len(k), sum(count[p] == top[p[0]] for p in k), sum(count[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for key, x, y, g, k in docs
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "The quick brown fox", " leading space", "  two  spaces ", "naïve café ñandú 東京タワー", "tab\tand\nline\r\n", "\U0001f600 emoji \U0001f468‍\U0001f469‍\U0001f467", "",
    "x", " ", "\n", "<|endoftext|> </s> <s> <unk> <0x41>", "a ▁ sign", "ﬁne ligature ½ ①", "é combining", "1234567890 $%&* ###", "\x00nul", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
]


@pytest.mark.parametrize("part_bytes", [1, 200, ta.PART_BYTES])
def test_against_all_pairs_of_tokens(spark, words_of, part_bytes):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (100, "The quick brown fox"), (100, "The quick brown fox"), (None, "no id"), (2**60 + 1, "large id")]
    rows += [(200 + i, " ".join(words_of(i, 30)) + " The quick fox") for i in range(20)]
    docs = spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id long, text string, pairs string, part int").repartition(3)
    got = ta.align_tokenizers(docs, tokenizer_path(), piece_path(), part_bytes=part_bytes).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(rows)))


def test_odd_rows(spark, odd_docs):
    got = ta.align_tokenizers(odd_docs, tokenizer_path(), piece_path()).select(*COLUMNS).collect()
    assert len(got) == odd_docs.count()
    by = {r["doc_id"]: r for r in got}
    assert tuple(by[4])[1:] == tuple(by[5])[1:] == (0, 0, 0, 0, 0, 0, "")
    assert by[11]["n_links"] > 50_000 and by[11]["n_best"] <= by[11]["n_links"] <= by[11]["count_sum"]
    assert ta.align_tokenizers(odd_docs.limit(0), tokenizer_path(), piece_path()).count() == 0
