import hashlib
import re

from sqlhaul.llm import pii_bootstrap as B

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    out = [(m.start(), "email", m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), "card", m.end()))
    out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted((a, B.KINDS.index(k), b, k) for a, k, b in out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


HARD = [
    "a@b.c_d@e.f.g @x.y a@@b.c a@b.c.d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3", "4111 1111-1111 1111 41111111111111112 4111  1111",
    "+1 (234) 555-0100. +12345678 ++1 234567890 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é a@b.é x@y.z\U0001f600 1.1.1.1", "", "@", "+", "5555555555554444 x 378282246310005",
    "." * 3000 + "a" * 3000 + "1" * 3000 + "+" * 300,
]


def test_fixed_patterns_against_plain_regexes(spark, sf_dir):
    texts = HARD + [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    for t in texts:
        assert [(a, B.KINDS.index(k), b, k) for a, b, k in B.base_spans(t)] == brute(t), t[:80]


def test_base_digest_and_edge_cases(spark, odd_docs):
    rows = [(100 + i, t) for i, t in enumerate(HARD)] + [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, kind string, rid int, score int")
    got = B.personal_data(df).collect()
    wanted = []
    for i, t in rows:
        s = brute(t or "")
        wanted.append((i, *(sum(x[3] == k for x in s) for k in B.KINDS), hashlib.sha256(joined(s).encode()).hexdigest(), joined(s)))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(wanted, key=repr)
    assert B.personal_data(df.limit(0)).count() == 0


def test_patterns_discover_unseen_identifiers(spark):
    """Phones after 'call me at' teach the context; a number that the fixed
    pattern cannot match is found there, and nothing elsewhere."""
    seeds = [(i, f"please call me at +1 234 555 {1000 + i} today") for i in range(30)]
    hidden = [(100, "please call me at 0044-20-7946 today"), (101, "chapter 1234 of the book"), (102, "room 5678b is free")]
    df = spark.createDataFrame(seeds + hidden, "doc_id long, text string")
    got = {r["doc_id"]: r for r in B.personal_data(df).collect()}
    assert got[100]["spans"] == "phone:18:30" and got[100]["n_found"] == 1 and got[100]["n_phone"] == 0
    assert got[100]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[101]["spans"] == got[102]["spans"] == "" and all(got[i]["n_found"] == 0 for i in range(30))


def test_scores_against_brute_force(spark):
    edges = [(f"p{p}", f"i{i}", "ip" if i % 3 else None) for p in range(4) for i in range(40) if (i * 7 + p) % (p + 2) == 0]
    got = {r["pattern"]: (r["kind"], round(r["score"], 9), r["seeds"]) for r in B.score_patterns(spark.createDataFrame(edges, "pattern string, instance string, kind string")).collect()}
    by, known = {}, {}
    for p, i, k in edges:
        by.setdefault(p, set()).add(i)
        known[i] = k
    seeds = {p: sum(known[i] is not None for i in s) for p, s in by.items()}
    by = {p: s for p, s in by.items() if seeds[p] >= B.MIN_SEEDS}
    inst = {i: float(k is not None) for i, k in known.items()}
    for _ in range(B.ROUNDS):
        score = {p: sum(inst[i] for i in s) / (len(s) + 0.25) for p, s in by.items()}
        for i, k in known.items():
            if k is None:
                miss = 1.0
                for p, s in by.items():
                    if i in s:
                        miss *= max(1e-6, 1 - score[p])
                inst[i] = (1 - miss) ** 2
    assert got == {p: ("ip", round(score[p], 9), seeds[p]) for p in by}


def test_bootstrap_grows_and_converges(spark):
    """A pattern with 60 known and 40 unknown instances passes after more than
    three rounds; what it finds are the only seeds of another pattern, whose
    other instances are found then. An unseeded pattern stays out."""
    edges = [("mixed", f"i{i}", "phone" if i < 60 else None) for i in range(100)]
    edges += [("next", f"i{i}", None) for i in range(61, 100)] + [("next", "far", None), ("none", "other", None)]
    df = spark.createDataFrame(edges, "pattern string, instance string, kind string")
    three = {r["pattern"]: r["score"] for r in B.score_patterns(df).collect()}
    assert set(three) == {"mixed"} and 0.8 < three["mixed"] < B.MIN_PATTERN
    got = {r["pattern"]: (r["kind"], r["score"] >= B.MIN_PATTERN, r["seeds"]) for r in B.score_patterns(df, None).collect()}
    assert got == {"mixed": ("phone", True, 60), "next": ("phone", True, 39)}


def test_contexts_of_discovered_identifiers_extract(spark):
    rows = [f"please call me at +1 234 555 {1000 + i} today" for i in range(60)]
    rows += [f"please call me at 0044-20-{7000 + i} today" for i in range(5)]
    rows += [f"her number remains 0044-20-{7000 + i} always" for i in range(5)] + ["her number remains 0044-20-9999 always", "chapter 1234 of the book"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in B.personal_data(df).collect()}
    assert all(got[i] == "phone:18:30" for i in range(60, 65)) and all(got[i] == "phone:19:31" for i in range(65, 71)) and got[71] == ""


def test_candidates_are_whole_runs_of_any_length():
    tokens = lambda t: [t[a:b] for a, b in B.other_tokens(t, B.base_spans(t))]
    assert tokens("call me at 020 7946 0958 today") == ["020 7946 0958"]
    assert tokens("(020) 7946-0958. or [0161] 496.0000, ext 7") == ["020) 7946-0958", "0161] 496.0000", "7"]
    assert tokens("pin 42\n17 doors, x@y 5 and AB1 2CD") == ["42", "17", "x@y", "5", "AB1 2CD"]
    assert tokens("on 1.2.3.4 12 and 4111 1111 1111 1112 @ -") == ["12", "4111 1111 1111 1112"]
    assert tokens("12 a@b.cd 34") == ["12", "34"]


def test_spaced_and_short_identifiers_are_found_whole(spark):
    rows = [f"please call me at +1 234 555 {1000 + i} today" for i in range(60)]
    hidden = ["please call me at 020 7946 0958 today", "please call me at 112 today", "please call me at 4111 1111 1111 1112 today", "please call me at (020) 7946 0958 today"]
    df = spark.createDataFrame(list(enumerate([*rows, *hidden, "chapter 7 of the book"])), "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in B.personal_data(df).collect()}
    assert [got[i] for i in range(60, 65)] == ["phone:18:31", "phone:18:21", "phone:18:37", "phone:19:33", ""]
