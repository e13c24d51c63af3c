"""WARC archives, index first: records are found through their index and read by coalesced byte ranges.

Writing yields one index row per record: file, offset, length, URL and digest. Reading takes the wanted
index rows, sorts them by file and offset, joins neighbouring ranges into one read, and parses the
records in it. Records are gzip members of WARC/1.1 files. Of pages with equal payloads of at least
`min_payload` bytes, the one with the largest identifier is a response and the others revisit it.

Defined cases: a null payload is empty; a null URL is written as `urn:none` and indexed as null. Pages
without identifier are responses that nobody refers to. Rows that repeat identifier and payload are all
responses (or all revisits) alike. An empty table writes nothing and reads back no rows. Other columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_with, materialize, small_side
from .token_files import as_uri, write_bytes

INDEX = "file string, offset long, length long, url string, digest string, page_id long, record_type string"
RECORDS = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
_NONE = "urn:none"


def _urn(page_id: int) -> str:
    return f"<urn:tidemark:page:{page_id}>"


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> tuple[bytes, str]:
    """One gzip member, and its payload's SHA-1 in hex."""
    sha = hashlib.sha1(payload)
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id) if page_id is not None else '<urn:tidemark:nameless:' + sha.hexdigest() + '>'}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + (url or _NONE).replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest: sha1:" + base64.b32encode(sha.digest()).decode(),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_urn(refers_to)}"]
    data = ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush(), sha.hexdigest()


def _parse(data: bytes) -> dict:
    """A record's fields from its uncompressed bytes."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    number = lambda urn: int(urn[19:-1]) if urn.startswith("<urn:tidemark:page:") else None
    return {
        "page_id": number(fields["WARC-Record-ID"]),
        "url": None if fields["WARC-Target-URI"] == _NONE else fields["WARC-Target-URI"],
        "type": fields["WARC-Type"],
        "digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
        "size": size,
        "refers_to": number(fields.get("WARC-Refers-To", "")),
        "payload": payload,
    }


def revisits_of(pages: DataFrame, min_payload: int = 1000) -> DataFrame:
    """(page_id, payload_key, refers_to): pages whose payload a page with a larger identifier has too."""
    size = F.octet_length(F.coalesce("html", F.lit("")))
    keyed = pages.where("page_id IS NOT NULL").where(size >= min_payload).select("page_id", F.sha2("html", 256).alias("payload_key"))
    top = keyed.groupBy("payload_key").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("lo")).where("lo < refers_to").select("payload_key", "refers_to")
    return materialize(keyed.join(small_side(materialize(top, "warc-groups")), "payload_key").where("page_id < refers_to").distinct(), "warc-revisits")


def write_warcs(pages: DataFrame, out: str, min_payload: int = 1000, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", file_bytes: int = 64_000_000) -> DataFrame:
    """Write the archives under out; returns the index, already complete. A file closes at file_bytes."""
    root = as_uri(pages.sparkSession, out)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(payload_col).alias("html"))
    twins = revisits_of(rows, min_payload)
    if twins.isEmpty():
        rows = rows.withColumn("refers_to", F.lit(None).cast("long"))
    else:
        # an identifier with several payloads is told apart by the payload's digest
        rows = rows.join(small_side(twins.withColumnRenamed("page_id", "_id")), (F.col("page_id") == F.col("_id")) & (F.sha2("html", 256) == F.col("payload_key")), "left").select("page_id", "url", "html", "refers_to")

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        blobs, index, size = [], [], 0

        def close() -> pa.RecordBatch:
            path = f"{root}/part-{part:06d}-{seq:04d}.warc.gz"
            write_bytes(path, b"".join(blobs))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*[(path, *r) for r in index]), kinds)], ["file", "offset", "length", "url", "digest", "page_id", "record_type"])

        for ids, urls, bodies, refs in batches_with(["page_id", "url", "html", "refers_to"], it):
            for i, url, body, ref in zip(ids, urls, bodies, refs):
                data, digest = _record(i, url, (body or "").encode("utf-8", "surrogatepass"), ref)
                if size and size + len(data) > file_bytes:
                    yield close()
                    seq += 1
                    blobs, index, size = [], [], 0
                index.append((size, len(data), url, digest, i, "response" if ref is None else "revisit"))
                blobs.append(data)
                size += len(data)
        if index:
            yield close()

    return materialize(rows.mapInArrow(write, INDEX), "warc-index")


def read_records(index: DataFrame, gap: int = 65_536, most: int = 8_000_000, with_payload: bool = True) -> DataFrame:
    """The records of the index rows, by sorted byte ranges; ranges at most gap bytes apart are read as one."""
    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a stretch of a file is one unit of work, so one large file spreads over many tasks
    wanted = index.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / most))
    wanted = wanted.repartition(parts, "file", "stretch").sortWithinPartitions("file", "offset")
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = [f.split()[0] for f in RECORDS.split(", ")]

    def ranges(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, list]]:
        cur: list | None = None
        for files, offs, lens in batches_with(["file", "offset", "length"], it):
            for f, o, n in zip(files, offs, lens):
                if cur and cur[0] == f and o - cur[2] <= gap and o + n - cur[1] <= most:
                    cur[2] = o + n
                    cur[3].append((o - cur[1], n))
                else:
                    if cur:
                        yield tuple(cur)
                    cur = [f, o, o + n, [(0, n)]]
        if cur:
            yield tuple(cur)

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened: tuple = ("", None)
        for path, start, end, records in ranges(it):
            if opened[0] != path:
                store, at = fs.FileSystem.from_uri(path)
                opened = (path, store.open_input_file(at))
            data = opened[1].read_at(end - start, start)
            out = []
            for o, n in records:
                r = _parse(zlib.decompress(data[o : o + n], 31))
                digest, size = r["digest"], r["size"]
                if r["type"] == "response":
                    digest, size = hashlib.sha1(r["payload"]).hexdigest(), len(r["payload"])
                    if digest != r["digest"] or size != r["size"]:
                        raise ValueError(f"damaged record at {path}:{start + o}")
                out.append((r["page_id"], r["url"], r["type"], digest, size, r["refers_to"], r["payload"] if with_payload else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return wanted.select("file", "offset", "length").mapInArrow(read, RECORDS)
