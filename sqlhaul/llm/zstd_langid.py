"""Language identification by compression.

For each language a raw-content dictionary of plain training text. A text is
cut into pieces, each compressed with every language's dictionary as zstandard
frames without header fields; the language with the smallest total wins. The
pieces are independent, so a long text does not turn into its own dictionary.
A margin below ``reject`` leaves the decision open (``accepted`` is false).

The dictionaries come from a bounded sample: for each language the
``SAMPLE_DOCS`` training rows of the smallest id hash, ``DICT_BYTES`` of their
plain text in all. Every distinct text has an equal share; what short ones leave
of theirs goes to the longer ones, whose share is taken in pieces spread over the
whole text. That bounds what passes through the driver and what is sent to the
tasks (``DICT_BYTES`` for each language).

Defined results: a null text, or one without letters, is ``und`` with score 0
and not accepted; rows with a null language or id teach nothing; equal sizes
go to the language with more training rows, then to the smaller name; without
training rows all is ``und``; a language whose training texts have no letters is
never predicted; repeated rows are predicted alike; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, ship
from sqlhaul.llm.qda_quality import held_out

SAMPLE_DOCS, DICT_BYTES = 256, 96 << 10
#: Bytes of one of the pieces that a long text's share is made of.
SPREAD = 1024
#: Characters of a piece; texts of up to SHORT bytes are compressed harder.
PIECE, SHORT = 4096, 512
LEVEL, SHORT_LEVEL = 9, 19
REJECT = 0.02

#: Bytes below which zstandard does not use a dictionary; shorter ones are repeated.
LEAST_BYTES = 8

_NOT_LETTERS = regex.compile(r"\P{L}+")


def plain(text: str | None) -> str:
    """Lower-cased letters (Unicode category L), everything else one space."""
    return _NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def share(sizes: list[int], budget: int) -> int:
    """The most bytes that each text may have, so that all, with a space between
    two, fit the budget: equal shares, what short texts leave going to the others."""
    rest, most = budget + 1, 0
    for i, n in enumerate(sorted(sizes)):
        most = rest // (len(sizes) - i) - 1
        if n > most:
            return max(0, most)
        rest -= n + 1
    return max(sizes, default=0)


def spread(text: str, most: int) -> bytes:
    """The text, or ``most`` bytes of it in pieces at equal distances."""
    raw = text.encode()
    if len(raw) <= most:
        return raw
    k = max(1, -(-most // SPREAD))
    piece = (most - (k - 1)) // k
    starts = [(len(raw) - piece) // 2] if k == 1 else [i * (len(raw) - piece) // (k - 1) for i in range(k)]
    return b" ".join(raw[a : a + piece].decode(errors="ignore").encode() for a in starts)


class CompressionLanguages:
    """Dictionaries, by language in order of preference at equal sizes."""

    def __init__(self, samples: dict[str, bytes]):
        import zstandard as z

        self.names = list(samples)
        params = lambda level: z.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.by_level = {}
        for level in (LEVEL, SHORT_LEVEL):
            made = []
            for s in samples.values():
                d = z.ZstdCompressionDict(s, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(compression_params=params(level))
                made.append(z.ZstdCompressor(dict_data=d, compression_params=params(level)))
            self.by_level[level] = made

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, score): the score is how much smaller the winner is than
        the next, as a share of the next."""
        raw = plain(text)
        if not raw or not self.names:
            return "und", 0.0
        pieces = [raw[i : i + PIECE].encode() for i in range(0, len(raw), PIECE)]
        with_level = self.by_level[SHORT_LEVEL if len(pieces) == 1 and len(pieces[0]) <= SHORT else LEVEL]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in with_level]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.names[best], (second - sizes[best]) / second


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> dict[str, bytes]:
    """Dictionary bytes by language, the most frequent first."""
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("t"))
    train = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("t").isNotNull() & ~held_out("id"))
    counts = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = train.select("lang", "id").withColumn("k", F.row_number().over(by_hash)).where(F.col("k") <= SAMPLE_DOCS).drop("k").distinct()
    texts = train.join(F.broadcast(chosen), ["lang", "id"]).select("lang", "id", "t")

    @F.pandas_udf("string")
    def plain_text(t: pd.Series) -> pd.Series:
        return t.map(plain)

    found = texts.select("lang", "id", plain_text("t").alias("t")).groupBy("lang", "t").agg(F.min("id").alias("id"))
    sample = save(found.withColumn("n", F.octet_length("t")), "language-sample")
    sizes: dict[str, list[int]] = {}
    for r in sample.select("lang", "n").collect():
        sizes.setdefault(r["lang"], []).append(r["n"])
    shares = {name: share(n, DICT_BYTES) for name, n in sizes.items()}

    @F.pandas_udf("binary")
    def pieces(name: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([spread(x, shares[k]) for k, x in zip(name, t)], dtype=object)

    got: dict[str, list[bytes]] = {}
    for r in sorted(sample.select("lang", "id", pieces("lang", "t").alias("b")).collect(), key=lambda r: (r["lang"], r["id"], bytes(r["b"]))):
        got.setdefault(r["lang"], []).append(bytes(r["b"]))
    out = {name: b" ".join(got[name]) for name in sorted(got, key=lambda x: (-counts[x], x))}
    return {k: v if len(v) >= LEAST_BYTES else b" ".join([v] * LEAST_BYTES) for k, v in out.items() if v}


_MODELS: dict[str, CompressionLanguages] = {}


def languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", reject: float = REJECT) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row."""
    ship(docs.sparkSession)
    learned = learn(docs, text, lang, doc_id)
    # workers keep a model by what it is made of
    key = hashlib.sha256(repr(list(learned.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double")
    def predict(t: pd.Series) -> pd.DataFrame:
        if key not in _MODELS:
            _MODELS.clear()
            _MODELS[key] = CompressionLanguages(shared.value)
        got = [_MODELS[key].predict(x) for x in t]
        return pd.DataFrame({"lang_pred": [x[0] for x in got], "score": np.array([x[1] for x in got], float)})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    found = rows.select("doc_id", held_out("doc_id").alias("held_out"), predict("t").alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", ((F.col("p.score") >= reject) & (F.col("p.lang_pred") != "und")).alias("accepted"))
