"""WARC archives: written with an index, read back by sorted and coalesced byte ranges.

Every record is a gzip member of its own, so it can be read alone. Tasks write archives of bounded size into the shared
folder under names that no other attempt uses; what a task returns is the index of what it wrote. Only the index of
attempts that Spark committed is ever read, so archives of lost or repeated attempts are never seen.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

ARCHIVE_BYTES = 64 << 20
#: Records are handed to readers by blocks of an archive; neighbours at most this far apart are read at once.
BLOCK_BYTES, GAP_BYTES = 4 << 20, 64 << 10
DATE = "1970-01-01T00:00:00Z"
INDEX = "archive string, offset long, length long, page_id long, url string, digest string, record_type string, refers_to long, payload_bytes long"
_RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page: int | None) -> str:
    return f"<urn:x-page:{'none' if page is None else page}>"


def _page(name: str) -> int | None:
    text = re.fullmatch(r"<urn:x-page:(none|-?\d+)>", name)[1]
    return None if text == "none" else int(text)


def _fields(pairs: Iterable[tuple[str, object]]) -> bytes:
    return "".join(f"{k}: {v}\r\n" for k, v in pairs).encode()


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> tuple[bytes, str]:
    """A record, uncompressed, and its payload's digest. A revisit has the response's header and no payload."""
    name = digest(payload)
    http = b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + b"\r\n"
    body = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(page)), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x1f\x7f%]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _name(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{name}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(body))]
    return b"WARC/1.1\r\n" + _fields(head) + b"\r\n" + body + b"\r\n\r\n", name


def _header(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return dict(x.split(": ", 1) for x in lines), rest


def parse(data: bytes) -> dict:
    """What a record says; a response's payload is checked against its length and digest."""
    head, rest = _header(data)
    body = rest[: int(head["Content-Length"])]
    if not data.startswith(b"WARC/1.1\r\n") or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a record")
    http, payload = _header(body)
    size, name = int(http["Content-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or digest(payload) != name):
        raise ValueError(f"{head['WARC-Record-ID']}: the payload is not the one written")
    url = head.get("WARC-Target-URI")
    return {
        "page_id": _page(head["WARC-Record-ID"]),
        "url": url and re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)) if int(m[1], 16) < 32 or m[1] in ("7F", "25") else m[0], url),
        "record_type": head["WARC-Type"],
        "refers_to": _page(head["WARC-Refers-To"]) if revisit else None,
        "payload_bytes": size,
        "payload_digest": name,
        "payload": None if revisit else payload,
    }


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def _writer(folder: str):
    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        out, at, name, made = None, 0, "", 0
        try:
            for b in batches:
                rows = {k: [] for k in ("archive", "offset", "length", "page_id", "url", "digest", "record_type", "refers_to", "payload_bytes")}
                for page, url, html, refers, revisit in zip(*(b.column(k) for k in range(5))):
                    if out is None or at >= ARCHIVE_BYTES:
                        if out:
                            out.close()
                        name, made = f"{TaskContext.get().partitionId():06d}-{made:04d}-{uuid.uuid4().hex}.warc.gz", made + 1
                        out, at = store.open_output_stream(f"{top}/{name}", compression=None), 0
                    payload = (html.as_py() or "").encode()
                    data, key = record(page.as_py(), url.as_py(), payload, refers.as_py(), revisit.as_py())
                    data = _member(data)
                    out.write(data)
                    for k, v in zip(rows, (name, at, len(data), page.as_py(), url.as_py(), key, "revisit" if revisit.as_py() else "response", refers.as_py(), len(payload))):
                        rows[k].append(v)
                    at += len(data)
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], list(rows))
        finally:
            if out:
                out.close()

    return run


def write(df: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Write a record per row of df into archives in `folder`; the index, itself a table in the shared folder.

    Of the records with equal payloads of at least `least` bytes, that with the smallest id is the response and others
    revisit it; smaller payloads are all responses. Null payloads are empty ones. Rows that repeat the smallest id are
    all responses. A row without an id is a revisit if any row with an id has its payload, else a response. A null url
    has no target field. Other columns are not looked at. An empty table gives an empty index and no archive.

    `folder` must be one that every executor reaches, by a scheme that pyarrow's file systems know.
    """
    text = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), text.alias("html")).withColumn("d", F.sha1("html"))
    keys = common.stored(rows.select("page_id", "d", F.octet_length("html").alias("n")), "payloads")
    # only payloads that occur again are joined, and the copies of one are dealt to several tasks
    first = keys.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("times")).filter("times > 1 AND first IS NOT NULL").select("d", "first")
    again = common.salted(keys.filter(F.col("n") >= least).select("page_id", "d").distinct(), first, "d", "page_id", "inner").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    again = common.stored(again.select(F.col("page_id").alias("p"), F.col("d").alias("e"), F.col("first").alias("refers_to")), "again")
    same = F.col("page_id").eqNullSafe(F.col("p")) & (F.col("d") == F.col("e"))
    told = rows.join(common.small(again), same, "left").select("page_id", "url", "html", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))
    store, top = fs.FileSystem.from_uri(folder)
    store.create_dir(top)
    return common.stored(told.mapInArrow(common.frugal(_writer(folder)), INDEX), "index")


def _reads(rows: Iterable[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Neighbouring records of one archive as one range, at most about BLOCK_BYTES long."""
    archive, start, end, parts = "", 0, 0, []
    for a, offset, length in rows:
        if parts and (a != archive or offset - end > GAP_BYTES or offset + length - start > BLOCK_BYTES):
            yield archive, start, end, parts
            parts = []
        if not parts:
            archive, start = a, offset
        end = offset + length
        parts.append((offset - start, length))
    if parts:
        yield archive, start, end, parts


def read(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records that rows of an index (archive, offset, length) name, as they stand in the archives."""
    spark = index.sparkSession

    def run(batches):
        store, top = fs.FileSystem.from_uri(folder)
        opened, file = None, None
        rows = (x for b in batches for x in zip(*(b.column(k).to_pylist() for k in range(3))))
        for archive, start, end, parts in _reads(rows):
            if archive != opened:
                opened, file = archive, store.open_input_file(f"{top}/{archive}")
            data = file.read_at(end - start, start)
            found = [parse(zlib.decompress(data[a : a + n], 31)) for a, n in parts]
            if not payloads:
                for r in found:
                    r["payload"] = None
            yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)

    blocks = index.select("archive", "offset", "length", F.floor(F.col("offset") / BLOCK_BYTES).alias("block"))
    dealt = blocks.repartition(common.parts(spark), "archive", "block").sortWithinPartitions("archive", "offset")
    return dealt.select("archive", "offset", "length").mapInArrow(common.frugal(run), _RECORD)


_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def op10_warc(spark, sf_dir: str) -> DataFrame:
    folder = common.scratch(spark, "warc")
    index = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return read(index, folder, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_CHARS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {s}) & 31), 1)" for k in range(8) for s in (15, 10, 5, 0))
OP10_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, strlen(html) AS payload_bytes, {_CHARS} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""
