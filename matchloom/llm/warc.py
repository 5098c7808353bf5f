"""WARC archives, index first.

Writing: each task writes an archive of gzip members, one record each, into the shared folder, and hands
on the index: file, offset, length, URL and digest of every record. Reading starts from the index: the
selected records are dealt out by file and stretch of file, sorted by offset, and neighbouring byte
ranges are read in one go.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, persisted, release, workspace
from .secrets import _arrow_type

STRETCH = 8 << 20
GAP = 64 << 10
#: Payloads below this size are always written in full.
LEAST_SHARED = 100
#: Bytes of payloads that are handed on at a time.
HANDED = 16 << 20


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of the shared folder, as Python on an executor reaches it."""
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri) if "://" in uri else f"file://{uri.removeprefix('file:')}")


def roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, payload, digest, refers_to: the page with the same payload and the smallest id, where that is another page.

    Digests are compared, not payloads; the join that decides carries no payload.
    """
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.sha2("payload", 256))
    light = p.select("page_id", "digest", F.octet_length("payload").alias("n")).filter(F.col("n") >= LEAST_SHARED)
    firsts = light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1")
    revisits = light.select("page_id", "digest").join(firsts, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first"))).select(F.col("page_id").alias("pid"), F.col("digest").alias("dig"), F.col("first").alias("refers_to")).distinct()
    return p.join(revisits, p["page_id"].eqNullSafe(revisits["pid"]) & (p["digest"] == revisits["dig"]), "left").drop("pid", "dig")


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    """One record. A revisit carries headers only; its payload is that of the record it refers to."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id, digest)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to, digest)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    if page_id is not None:
        head.append(f"X-Page-Id: {_id_text(page_id)}")
    if revisit:
        head.append(f"X-Refers-To-Page: {_id_text(refers_to)}")
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _escaped(text: str) -> str:
    """Text for a header: what would end the line is percent-encoded."""
    return re.sub(r"[\r\n]", lambda m: f"%{ord(m[0]):02X}", text)


def _id_text(value) -> str:
    """An id for a header; of texts, what is not printable and the percent sign are encoded, so that reading gives them back."""
    return urllib.parse.quote(value, safe="/:;,?@&=+$-_.!~*'()# ") if isinstance(value, str) else str(value)


def about() -> bytes:
    """The record at the beginning of an archive."""
    block = b"software: matchloom\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", "WARC-Date: 1970-01-01T00:00:00Z", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _urn(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case, and the payload, of one uncompressed record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in head.decode("utf-8").split("\r\n")[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


INDEX = "page_id {id}, url string, record_type string, refers_to {id}, payload_digest string, file string, offset long, length long"


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write one record per row of ``pages``, and return the index, kept in the shared folder.

    A null html is an empty payload; a null url leaves the header out. Of rows with equal payloads of 100 or
    more bytes, that with the smallest page_id is written in full, the others as revisits; rows repeated with
    one and the same page_id are all written as that page is. A task that is run again writes another file;
    only the files of the runs that count are in the index.
    """
    folder = folder or workspace(pages.sparkSession, "warc")
    kind = pages.schema[id_col].dataType.simpleString()
    id_type = _arrow_type(pages, id_col)
    schema = pa.schema([pa.field("page_id", id_type), pa.field("url", pa.string()), pa.field("record_type", pa.string()), pa.field("refers_to", id_type), pa.field("payload_digest", pa.string()), pa.field("file", pa.string()), pa.field("offset", pa.int64()), pa.field("length", pa.int64())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
        try:
            for batch in batches:
                rows = []
                for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                    for r in part.to_pylist():
                        if out is None:
                            fs, base = open_store(folder)
                            fs.create_dir(base, recursive=True)
                            out = fs.open_output_stream(f"{base}/{name.rpartition('/')[2]}", compression=None)
                            first = gzip.compress(about(), 5, mtime=0)
                            out.write(first)
                            at = len(first)
                        data = gzip.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"]), 5, mtime=0)
                        out.write(data)
                        rows.append({"page_id": r["page_id"], "url": r["url"], "record_type": "response" if r["refers_to"] is None else "revisit", "refers_to": r["refers_to"], "payload_digest": r["digest"], "file": name, "offset": at, "length": len(data)})
                        at += len(data)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if out is not None:
                out.close()

    return persisted(roles(pages, id_col, url_col, html_col).mapInArrow(write, INDEX.format(id=kind)), "warc-index")


def read_records(selected: DataFrame, with_payload: bool = True, gap: int = GAP, most: int = STRETCH) -> DataFrame:
    """The records that the rows of ``selected`` (rows of an index) stand for.

    Rows are dealt by file and stretch of ``most`` bytes and sorted by offset; ranges that are at most ``gap``
    bytes apart are read together, up to about ``most`` bytes at a time. Digests are taken from what was read.
    """
    kind = selected.schema["page_id"].dataType.simpleString()
    id_type = _arrow_type(selected, "page_id")
    whole = id_type if not pa.types.is_integer(id_type) else None
    fields = [pa.field("page_id", id_type), pa.field("url", pa.string()), pa.field("record_type", pa.string()), pa.field("refers_to", id_type), pa.field("payload_digest", pa.string()), pa.field("payload_bytes", pa.int64()), pa.field("payload", pa.binary())]
    schema = pa.schema(fields)

    def value(x: str | None):
        return None if x is None else urllib.parse.unquote(x) if whole else int(x)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple[str, int, int]] = []
        handle: dict = {}

        def flush() -> Iterator[pa.RecordBatch]:
            file, start = pending[0][0], pending[0][1]
            if handle.get("name") != file:
                fs, path = open_store(file)
                handle.update(name=file, file=fs.open_input_file(path))
            data = handle["file"].read_at(pending[-1][1] + pending[-1][2] - start, start)
            rows, size = [], 0
            for _, offset, length in pending:
                headers, payload = parse(zlib.decompress(data[offset - start : offset - start + length], 31))
                response = headers["warc-type"] == "response"
                rows.append({"page_id": value(headers.get("x-page-id")), "url": headers.get("warc-target-uri"), "record_type": headers["warc-type"], "refers_to": value(headers.get("x-refers-to-page")), "payload_digest": hashlib.sha256(payload).hexdigest() if response else headers["warc-payload-digest"].removeprefix("sha256:"), "payload_bytes": len(payload) if response else None, "payload": payload if response and with_payload else None})
                size += len(payload) if with_payload else 0
                if size >= HANDED:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
            pending.clear()
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            for file, offset, length in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if pending and (file != pending[0][0] or offset - (pending[-1][1] + pending[-1][2]) > gap or offset + length - pending[0][1] > most):
                    yield from flush()
                pending.append((file, offset, length))
        if pending:
            yield from flush()

    dealt = selected.select("file", "offset", "length").withColumn("stretch", F.expr(f"offset div {most}")).repartition("file", "stretch").sortWithinPartitions("file", "offset").select("file", "offset", "length")
    return dealt.mapInArrow(read, f"page_id {kind}, url string, record_type string, refers_to {kind}, payload_digest string, payload_bytes long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives, read all of them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    The size of a revisit's payload is that of the response with its digest, as read. The archives are deleted once
    they have been read.
    """
    folder = workspace(pages.sparkSession, "warc")
    index = write_archives(pages, folder=folder)
    got = persisted(read_records(index, with_payload=False).drop("payload"), "warc-read")
    release(index)
    drop_path(pages.sparkSession, folder)
    full = got.filter("record_type = 'response'").groupBy(F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("full_bytes"))
    revisits = got.filter("record_type = 'revisit'")
    revisits = revisits.join(full, revisits["payload_digest"] == full["digest"], "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return got.filter("record_type = 'response'").select(cols).unionByName(revisits.withColumn("payload_bytes", F.col("full_bytes")).select(cols))
