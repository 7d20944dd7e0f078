"""Personal data by bootstrapped contextual extraction.

Fixed patterns find seed entities of four kinds. Each seed, and each other
candidate that looks like an identifier (a token with an @, or the longest run of
adjacent tokens with digits, of any length) votes with its context: lexical patterns are the two words before it, the word before and the
word after it, and its own shape with the word before. Spark scores the graph of
patterns and distinct instances in rounds: a pattern is as good as the
instances it extracts (unknown ones count against it, few ones are discounted),
an instance as good as the patterns that extract it together. Candidates that no
fixed pattern matched and whose patterns reach ``MIN_PATTERN`` become new spans
of the kind that the pattern's seeds have. They are known instances from then on:
they count as seeds, so that patterns they share can extract in their turn. The
rounds end when nothing new is found and no score rises by more than ``STILL``.

Texts are read once; what the rounds work on is the stored table of pattern
occurrences. Both sides of the graph are grouped sums over distinct edges, so
a very common pattern or instance is combined before the shuffle.

Defined results: null and empty texts have no spans; offsets count code
points, ends are exclusive; the fixed patterns' spans always stay; repeated
rows have equal results; a null id stays; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, ship

KINDS = ("email", "ip", "card", "phone")
#: Rounds of scoring, where they are bounded; distinct seeds a pattern needs; scores from which a pattern extracts.
ROUNDS, MIN_SEEDS, MIN_PATTERN = 3, 5, 0.9
#: Scores that rise by no more than this in a round have converged.
STILL = 1e-4
#: Share of a pattern's seeds that its kind must have.
MIN_KIND = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]+")
_WORD = re.compile(r"[^\W\d_]+")
#: What may stand between two tokens with digits of one candidate: blanks of a line, dots, brackets, hyphens.
_JOINT = re.compile(r"(?:[^\S\n\r\v\f\x1c-\x1e\x85\u2028\u2029]|[.()\[\]{}\u2010-\u2015-])+")
#: Characters before and after a token in which its context words are looked for.
REACH = 64


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start, then kind."""
    out = []
    # an e-mail's local part is the run before its @, after the match before
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            out.append((start, done, "email"))
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def other_tokens(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Candidates: tokens with a digit or an @, stripped of outer punctuation,
    that touch no span taken; adjacent ones with digits are one. The search for a
    token's ends is linear in the text."""
    out: list[tuple[int, int]] = []
    at, k, joins = 0, 0, False
    merged: list[list[int]] = []
    for a, b, _ in sorted(taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    for m in _MARK.finditer(text):
        if m.start() < at:
            continue
        a, b = m.start(), m.end()
        while a > at and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and not text[b].isspace():
            b += 1
        at = b
        while a < b and not text[a].isalnum():
            a += 1
        while b > a and not text[b - 1].isalnum():
            b -= 1
        if a == b:
            continue
        while k < len(merged) and merged[k][1] <= a:
            k += 1
        if k < len(merged) and merged[k][0] < b:
            joins = False
            continue
        digits = any("0" <= c <= "9" for c in text[a:b])
        if joins and digits and _JOINT.fullmatch(text, out[-1][1], a):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
        joins = digits
    return out


def _shape(token: str) -> str:
    s = re.sub(r"[0-9]+", "0", re.sub(r"[^\W\d_]+", "a", token))
    return s if len(s) <= 24 else s[:24]


def contexts(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns around a token."""
    before = _WORD.findall(text[max(0, start - REACH) : start])
    after = _WORD.findall(text[end : end + REACH])
    left = [w.lower() for w in before[-2:]]
    right = after[0].lower() if after else ""
    out = []
    if len(left) == 2:
        out.append(f"LL {left[0]} {left[1]}")
    if left:
        if right:
            out.append(f"LR {left[-1]} {right}")
        out.append(f"LS {left[-1]} {_shape(text[start:end])}")
    return out


_DOC = "rid long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, marks array<struct<kind:string,start:int,stop:int,instance:string,patterns:array<string>>>"


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scan(batches):
    from pyspark import TaskContext

    n = TaskContext.get().partitionId() << 33
    for pdf in batches:
        rows = []
        for doc_id, text in zip(pdf.doc_id, pdf.t):
            text = text if isinstance(text, str) else ""
            spans = base_spans(text)
            count = [sum(s[2] == k for s in spans) for k in KINDS]
            joined = _joined(spans)
            marks = [(k, a, b) for a, b, k in spans] + [(None, a, b) for a, b in other_tokens(text, spans)]
            marks = [
                {"kind": k, "start": a, "stop": b, "instance": hashlib.blake2b(text[a:b].lower().encode(), digest_size=12).hexdigest(), "patterns": contexts(text, a, b)}
                for k, a, b in marks
            ]
            rows.append((n, doc_id, *count, hashlib.sha256(joined.encode()).hexdigest(), joined, marks))
            n += 1
        out = pd.DataFrame(rows, columns=["rid", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "marks"])
        out["doc_id"] = out.doc_id.astype("Int64")
        yield out


def _eligible(labelled: DataFrame) -> DataFrame:
    """(pattern, pattern_kind, seeds) of the patterns with enough known instances, nearly all of one kind."""
    kinds = labelled.where("kind is not null").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("c"))
    kinds = kinds.groupBy("pattern").agg(F.max(F.struct("c", "kind")).alias("best"), F.sum("c").alias("seeds")).where(
        (F.col("seeds") >= MIN_SEEDS) & (F.col("best.c") >= MIN_KIND * F.col("seeds"))
    )
    return kinds.select("pattern", F.col("best.kind").alias("pattern_kind"), "seeds")


def score_patterns(edges: DataFrame, rounds: int | None = ROUNDS, least: float = MIN_PATTERN) -> DataFrame:
    """(pattern, kind, score, seeds) from the distinct edges (pattern,
    instance, kind), ``kind`` null where no fixed pattern knows the instance.

    In each round a pattern's score is the mean score of its instances, less
    for few of them; an unknown instance's is 1 less the product of its
    patterns' shortfalls, counting only patterns with enough seeds.

    A number for ``rounds`` bounds them, and only what the fixed patterns know
    are seeds. With None instances of patterns that reach ``least`` are known
    from then on, of the best pattern's kind, until nothing changes. A pattern
    that has enough seeds keeps its kind, so scores never fall; ``seeds`` counts
    the known instances when it first had enough."""
    plain = edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"))
    plain = save(plain, "pii-edges")
    kinds = save(_eligible(plain), "pii-patterns")
    graph = save(plain.join(kinds, "pattern").select("pattern", "instance", "kind"), "pii-graph")
    known = graph.withColumn("s", F.when(F.col("kind").isNotNull(), 1.0).otherwise(0.0))
    before, k = None, 0
    while True:
        scores = known.groupBy("pattern").agg((F.sum("s") / (F.count(F.lit(1)) + 0.25)).alias("score"), F.count_if(F.col("kind").isNull()).alias("unknown"))
        scores = save(scores, "pii-scores")
        k += 1
        if k == rounds:
            break
        if rounds is None:
            old = scores.select("pattern", F.lit(0.0).alias("old")) if before is None else before.select("pattern", F.col("score").alias("old"))
            rise, finds = scores.join(old, "pattern", "left").agg(
                F.max(F.col("score") - F.coalesce("old", F.lit(0.0))), F.max((F.col("score") >= least) & (F.col("unknown") > 0))
            ).first()
            before = scores
            if not finds and (rise is None or rise <= STILL):
                break
            if finds:
                new = graph.where("kind is null").join(scores.where(F.col("score") >= least), "pattern").join(kinds, "pattern")
                new = new.groupBy("instance").agg(F.max(F.struct("score", "pattern_kind")).alias("b")).select("instance", F.col("b.pattern_kind").alias("found"))
                plain = save(plain.join(new, "instance", "left").select("pattern", "instance", F.coalesce("kind", "found").alias("kind")), "pii-edges")
                kinds = save(kinds.union(_eligible(plain).join(kinds.select("pattern"), "pattern", "left_anti")), "pii-patterns")
                graph = save(plain.join(kinds, "pattern").select("pattern", "instance", "kind"), "pii-graph")
        told = graph.join(scores, "pattern", "left").groupBy("instance").agg(
            F.max("kind").alias("k"), (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.coalesce("score", F.lit(0.0))))))).alias("p")
        )
        known = graph.join(told.select("instance", F.when(F.col("k").isNotNull(), 1.0).otherwise(F.col("p") * F.col("p")).alias("s")), "instance")
    return scores.join(kinds, "pattern").select("pattern", F.col("pattern_kind").alias("kind"), "score", "seeds")


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rounds: int | None = None, least: float = MIN_PATTERN) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found)
    of every row; ``spans`` has the fixed patterns' spans and the discovered
    ones, ``n_found`` counts the latter. ``rounds`` bounds the rounds of scoring."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    table = save(rows.mapInPandas(_scan, _DOC), "pii-scan")
    marks = table.select("rid", F.explode("marks").alias("m")).select("rid", "m.kind", "m.start", "m.stop", "m.instance", F.explode("m.patterns").alias("pattern"))
    scores = score_patterns(marks.select("pattern", "instance", "kind"), rounds, least).where(F.col("score") >= least)
    found = (
        marks.where("kind is null").join(scores.select("pattern", F.col("kind").alias("k"), "score"), "pattern")
        .groupBy("rid", "start", "stop").agg(F.max(F.struct("score", "k")).alias("b"))
        .groupBy("rid").agg(F.collect_list(F.struct("start", "stop", F.col("b.k").alias("kind"))).alias("more"))
    )
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    base = F.transform(
        F.filter(F.split("base", ","), lambda x: x != ""),
        lambda x: F.struct(F.split(x, ":")[1].cast("int").alias("start"), order[F.split(x, ":")[0]].alias("o"), F.split(x, ":")[2].cast("int").alias("stop"), F.split(x, ":")[0].alias("kind")),
    )
    extra = F.transform("more", lambda x: F.struct(x["start"].alias("start"), order[x["kind"]].alias("o"), x["stop"].alias("stop"), x["kind"].alias("kind")))
    both = F.array_sort(F.concat(base, extra))
    spans = F.array_join(F.transform(both, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    return table.drop("marks").join(found, "rid", "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.when(F.col("more").isNull(), F.col("base")).otherwise(spans).alias("spans"),
        F.when(F.col("more").isNull(), 0).otherwise(F.size("more")).cast("long").alias("n_found"),
    )
