import base64
import gzip
import hashlib

import pytest
from pyarrow import fs as pafs

from sqlhaul.llm import warc_index as W


def expected(rows):
    classes = {}
    for i, _, h in rows:
        p = (h or "").encode()
        classes.setdefault(p, []).append(i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        ids = [x for x in classes[p] if x is not None]
        low = min(ids) if ids else None
        revisit = low is not None and i != low
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", low if revisit else None))
    return sorted(out, key=repr)


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, W.round_trip(pages).collect()), key=repr) == expected(rows)


def test_edge_cases(spark):
    rows = [
        (1, "http://a.example/x y\r\nBad: 1", "p"), (2, None, "p"), (3, "HTTPS://WWW.A.example:443/", None), (4, "u", ""), (None, "http://b/", "p"),
        (None, "http://b/", "alone"), (5, "http://b/", "é" * 200_000), (6, "http://[bad", "q"), (6, "http://[bad", "q"), (7, "http://c/\U0001f600", "q"),
    ]
    pages = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, key string, offset int")
    assert sorted(map(tuple, W.round_trip(pages).collect()), key=repr) == expected(rows)
    assert W.round_trip(pages.limit(0)).count() == 0


def test_least_payload(spark):
    pages = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")], "page_id long, url string, html string")
    got = {r["page_id"]: r["record_type"] for r in W.round_trip(pages, least=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_blocks_ties_and_members(spark, tmp_path):
    """One key over several blocks, absent keys, and archives that any gzip
    reader takes as a whole."""
    pages = spark.createDataFrame([(i, "http://hot.example/" if i % 3 else f"http://h{i:03d}.example/", f"p{i}") for i in range(60)], "page_id long, url string, html string")
    folder = str(tmp_path / "w")
    captures = W.write_archives(pages, folder)
    directory = W.build_index(captures, folder, lines=4)
    assert directory.count() >= 15
    keys = spark.createDataFrame([(W.url_key("http://hot.example/"),), ("example,absent)/",), ("example,h003)/",)], "key string")
    found = W.look_up(keys, directory, folder)
    assert sorted(r["page_id"] for r in found.collect()) == sorted([3] + [i for i in range(60) if i % 3])
    payloads = {r["page_id"]: bytes(r["payload"]) for r in W.read_records(found, folder, with_payload=True).collect()}
    assert payloads[4] == b"p4" and payloads[3] == b"p3"
    store = pafs.LocalFileSystem()
    archives = [f.path for f in store.get_file_info(pafs.FileSelector(folder)) if f.path.endswith(".warc.gz")]
    assert sum(gzip.open(a).read().count(b"WARC/1.1\r\n") for a in archives) == 60


def test_keys_and_damage():
    assert W.url_key("http://user@www.B.example.com:80/x?y#z") == "com,example,b)/x?y"
    assert W.url_key("https://b.example.com:8443") == "com,example,b:8443)/"
    member = W.record(1, "http://a/", b"payload", None, False)
    raw = gzip.decompress(member)
    assert W.parse(member)["payload"] == b"payload"
    with pytest.raises(ValueError):
        W.parse(gzip.compress(raw.replace(b"payload\r\n", b"pAyload\r\n")))
