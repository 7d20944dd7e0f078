"""WARC archives with a two-level capture index.

*Write.* Each page becomes one record in its own gzip member: a response with
the payload, or a revisit that names the response with the same payload.
Archives are files of bounded size in a shared folder, under names of their
own; the captures table that Spark commits names every record's place, so what
a lost or repeated task has written is never read.

*Index.* Captures are sorted by reversed-host URL key over all partitions;
each partition writes one index file of compressed blocks of ``LINES`` lines
and one directory row for each block. The directory is sparse (a row for
``LINES`` captures) and a table itself.

*Look up.* Keys are routed to index files by binary search in the files' first
keys, to blocks by binary search in the file's directory, and to lines by
binary search in the block, which is read by its byte range. Captures are
then read from the archives by their byte ranges, in the order of their
places, neighbours together.

Defined results: a null payload is empty; a null URL has the key ``-``;
control characters and spaces in a URL are percent-encoded in the record; of
records with equal payloads (SHA-256 and length) all rows with the smallest
non-null id are responses; a null id is revisit where another row of its
class has an id, else response; repeated rows have a record each; other columns
are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sqlhaul.llm.common import save, ship
from sqlhaul.session import scratch_dir

#: Captures in an index block; bytes after which an archive is closed; bytes read at once.
LINES, ARCHIVE_BYTES, READ_BYTES = 3000, 64 << 20, 4 << 20
GZIP_LEVEL = 5
#: The date that records bear; the tables hold none.
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6f1c0f0e-2a52-5d8e-9c1b-0d2f6c3f7a11")


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.b.example.com/x?y`` ->
    ``com,example,b)/x?y``. Scheme, user, default port, leading ``www`` and
    fragment do not count; the host is lower-cased."""
    if url is None:
        return "-"
    try:
        u = urlsplit(url.strip())
        host, port = (u.hostname or "").rstrip("."), u.port
    except ValueError:
        return quote(url, safe="%/:?#[]@!$&'()*+,;=")
    parts = host.split(".")
    if len(parts) > 2 and parts[0] == "www":
        parts = parts[1:]
    key = ",".join(reversed(parts))
    if port and port != {"http": 80, "https": 443}.get(u.scheme):
        key += f":{port}"
    tail = (u.path or "/") + (f"?{u.query}" if u.query else "")
    return quote(f"{key}){tail}", safe="%/:?#[]@!$&'()*+,;=")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One gzip member with a response or revisit record."""
    digest = sha1_base32(payload)
    target = quote(url or "", safe="%/:?#[]@!$&'()*+,;=~")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_urn(page_id, digest)}",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_urn(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}",
        ]
    # a revisit keeps the response's HTTP head, with the full payload's length
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block += b"" if revisit else payload
    head.append(f"Content-Length: {len(block)}")
    z = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse(member: bytes) -> dict:
    """Fields of one record; raises ``ValueError`` where the payload does not
    have the digest that the record names."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: payload mismatch")
    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page-Id")
    return {
        "page_id": None if page is None else int(page), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": None if refers is None else int(refers), "payload": payload if kind == "response" else None,
    }


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("/") else folder.replace("file:/", "file:///", 1)


def write_archives(pages: DataFrame, folder: str, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages as records under ``folder``; the committed captures
    (key, page_id, path, offset, length). Payloads of fewer than ``least`` bytes
    are always responses."""
    ship(pages.sparkSession)
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha", F.sha2("payload", 256)).withColumn("size", F.length("payload"))
    narrow = rows.select("page_id", "sha", "size")
    low = narrow.groupBy("sha", "size").agg(F.min("page_id").alias("low"), F.count(F.lit(1)).alias("c")).where((F.col("c") > 1) & (F.col("size") >= least))
    # decided on narrow rows; the payloads then move by page, not by class
    decided = (
        narrow.distinct().join(low.drop("c"), ["sha", "size"]).where(~F.col("page_id").eqNullSafe(F.col("low")) & F.col("low").isNotNull())
        .select(F.col("page_id").alias("p"), F.col("sha").alias("s"), "low")
    )
    full = rows.join(decided, F.expr("page_id <=> p and sha = s"), "left").select("page_id", "url", "payload", "low")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, at, got = None, "", 0, []

        def flush():
            return pa.RecordBatch.from_pylist(got, schema=schema)

        schema = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
        for b in batches:
            for page, link, payload, low in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    path, at = f"{base}/archive-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(path, compression=None)
                member = record(page, link, payload, low, low is not None)
                out.write(member)
                got.append({"key": url_key(link), "page_id": page, "path": path, "offset": at, "length": len(member)})
                at += len(member)
                if at >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    # rows leave only when their archive is whole
                    yield flush()
                    got = []
        if out is not None:
            out.close()
            yield flush()

    return save(full.mapInArrow(write, "key string, page_id long, path string, offset long, length long"), "warc-captures")


def build_index(captures: DataFrame, folder: str, lines: int = LINES) -> DataFrame:
    """The sparse directory (shard, seq, first, last, path, offset, length) of
    compressed index blocks, sorted by key."""
    ship(captures.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        path, out, at, seq, held, rows = f"{base}/index-{shard:06d}-{uuid.uuid4().hex}.cdx", None, 0, 0, [], []

        def block():
            nonlocal out, at, seq, held
            out = out or store.open_output_stream(path, compression=None)
            raw = zlib.compress("\n".join(f"{k} {json.dumps(rest)}" for k, rest in held).encode(), 6)
            out.write(raw)
            rows.append({"shard": shard, "seq": seq, "first": held[0][0], "last": held[-1][0], "path": path, "offset": at, "length": len(raw)})
            at, seq, held = at + len(raw), seq + 1, []

        for b in batches:
            for key, page, file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                held.append((key, [page, file, offset, length]))
                if len(held) >= lines:
                    block()
        if held:
            block()
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(rows)

    ordered = captures.select("key", "page_id", "path", "offset", "length").repartitionByRange("key", "page_id", "path", "offset").sortWithinPartitions("key", "page_id", "path", "offset")
    return save(
        ordered.mapInArrow(write, "shard long, seq long, first string, last string, path string, offset long, length long"), "warc-directory"
    )


def find_in_block(keys: list[str], key: str) -> range:
    """Lines of a sorted block that have the key."""
    return range(bisect.bisect_left(keys, key), bisect.bisect_right(keys, key))


def look_up(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures (key, page_id, path, offset, length) of the distinct ``key``
    values of a table. What goes through the driver is one first and last key
    for each index file."""
    spark = keys.sparkSession
    edges = directory.groupBy("shard").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("shard").collect()
    shared = spark.sparkContext.broadcast(([r["shard"] for r in edges], [r["first"] for r in edges], [r["last"] for r in edges]))

    def route(batches):
        shards, first, last = shared.value
        for pdf in batches:
            got = []
            for key in pdf.key:
                k = bisect.bisect_left(last, key)
                while k < len(first) and first[k] <= key:
                    got.append((shards[k], key))
                    k += 1
            yield pd.DataFrame(got, columns=["shard", "key"])

    def read(asked: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(asked) and len(blocks):
            store, _ = pafs.FileSystem.from_uri(folder)
            blocks = blocks.sort_values("seq")
            first, last = blocks["first"].tolist(), blocks["last"].tolist()
            path, offset, length = blocks.path.iloc[0], blocks.offset.tolist(), blocks.length.tolist()
            at, names, rest = -1, [], []
            with store.open_input_file(path) as f:
                for key in sorted(asked.key):
                    k = bisect.bisect_left(last, key)
                    while k < len(first) and first[k] <= key:
                        if k != at:
                            text = zlib.decompress(f.read_at(length[k], offset[k])).decode().split("\n")
                            names, rest = map(list, zip(*(x.split(" ", 1) for x in text)))
                            at = k
                        got += [(key, *json.loads(rest[i])) for i in find_in_block(names, key)]
                        k += 1
        out = pd.DataFrame(got, columns=["key", "page_id", "path", "offset", "length"])
        out["page_id"] = out.page_id.astype("Int64")
        return out

    routed = keys.select("key").distinct().mapInPandas(route, "shard long, key string")
    return routed.groupBy("shard").cogroup(directory.groupBy("shard")).applyInPandas(read, "key string, page_id long, path string, offset long, length long")


def read_records(captures: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records at the captures' places: (page_id, payload_bytes,
    payload_digest, record_type, refers_to) and, if asked, payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pafs.FileSystem.from_uri(folder)
        file, opened = None, None
        for b in batches:
            rows = b.to_pylist()
            i, out = 0, []
            while i < len(rows):
                r = rows[i]
                j, end = i + 1, r["offset"] + r["length"]
                while j < len(rows) and rows[j]["path"] == r["path"] and rows[j]["offset"] == end and end - r["offset"] < READ_BYTES:
                    end += rows[j]["length"]
                    j += 1
                if opened != r["path"]:
                    if file is not None:
                        file.close()
                    file, opened = store.open_input_file(r["path"]), r["path"]
                raw = file.read_at(end - r["offset"], r["offset"])
                for x in rows[i:j]:
                    a = x["offset"] - r["offset"]
                    got = parse(raw[a : a + x["length"]])
                    if not with_payload:
                        del got["payload"]
                    out.append(got)
                i = j
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if file is not None:
            file.close()

    kinds = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    schema = pa.schema(kinds + [("payload", pa.binary())] * with_payload)
    ordered = captures.select("path", "offset", "length").repartitionByRange("path", "offset").sortWithinPartitions("path", "offset")
    spark_schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload
    return ordered.mapInArrow(read, spark_schema)


def round_trip(pages: DataFrame, least: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None) -> DataFrame:
    """Write the archives and the index, look all pages' keys up, and read the
    records found: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    folder = _uri(folder or scratch_dir(pages.sparkSession, "warc"))
    directory = build_index(write_archives(pages, folder, least, page_id, url, html), folder)

    @F.pandas_udf("string")
    def key_of(u: pd.Series) -> pd.Series:
        return u.map(lambda x: url_key(x if isinstance(x, str) else None)) if len(u) else pd.Series([], dtype=str)

    keys = pages.select(key_of(F.col(url).cast("string")).alias("key"))
    return read_records(look_up(keys, directory, folder), folder)
