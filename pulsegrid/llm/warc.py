"""WARC archives of pages: written with one gzip member per record, read back as a stream.

Equal payloads are stored once: the page with the smallest id is a response, the others are
revisits that name it. Payloads below ``LEAST_BYTES`` are always responses. A task writes
one archive under a name of its own to the shared scratch folder; the list of archives is a
table that Spark commits, so an archive left by a lost task is never read. The reader
inflates a file piece by piece, frames each record by its content length, and checks the
digest of every payload; it holds one record at a time.

Defined cases: a null payload is empty; rows with the id of the response are responses too,
so repeated rows stay; a page without id never serves as the response of others and is a
response itself; urls may be null.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import named, shared_file, stored
from pulsegrid.session import scratch_dir

LEAST_BYTES = 100
CHUNK = 1 << 16
HOT_DIGESTS = 10_000
# Fixed values of the format.
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
REVISIT = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = b"1970-01-01T00:00:00Z"


def record_id(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"" if page_id is None else str(page_id).encode())


def page_of(value: bytes) -> int | None:
    number = value.strip(b"<>").rpartition(b":")[2]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: header lines, the block, and the closing line breaks."""
    digest = hashlib.sha256(payload).hexdigest().encode()
    lines = [
        VERSION,
        b"WARC-Type: " + (b"response" if refers_to is None else b"revisit"),
        b"WARC-Record-ID: " + record_id(page_id),
        b"WARC-Date: " + DATE,
        b"WARC-Payload-Digest: sha256:" + digest,
        b"WARC-Payload-Length: %d" % len(payload),
    ]
    if url is not None:
        # A line break would end the header, so it is escaped as in any URI.
        safe = url.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(b"WARC-Target-URI: " + safe.encode("utf-8", "surrogatepass"))
    if refers_to is None:
        block = HTTP % len(payload) + payload
        lines.append(b"Content-Type: application/http;msgtype=response")
    else:
        block = b""
        lines += [b"WARC-Profile: " + REVISIT, b"WARC-Refers-To: " + record_id(refers_to)]
    lines.append(b"Content-Length: %d" % len(block))
    return CRLF.join(lines) + CRLF * 2 + block + CRLF * 2


def member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    return pack.compress(data) + pack.flush()


class Members:
    """Inflates gzip members one after another from a stream, a chunk at a time."""

    def __init__(self, stream):
        self.stream, self.raw, self.inflate = stream, b"", None
        self.ready = bytearray()

    def _fill(self) -> bool:
        """Inflate some more of the current member; False at its end."""
        while True:
            if self.inflate.eof:
                self.raw = self.inflate.unused_data
                return False
            data = self.inflate.unconsumed_tail or self.raw or self.stream.read(CHUNK)
            if not data:
                raise ValueError("archive ends inside a record")
            self.raw = b""
            out = self.inflate.decompress(data, CHUNK)
            self.ready += out
            if out:
                return True

    def open(self) -> bool:
        """Begin the next member, if there is one."""
        self.raw = self.raw or self.stream.read(CHUNK)
        if not self.raw:
            return False
        self.inflate = zlib.decompressobj(16 + zlib.MAX_WBITS)
        return True

    def until(self, mark: bytes) -> bytes:
        at = self.ready.find(mark)
        while at < 0:
            if not self._fill():
                raise ValueError("record without end of header")
            at = self.ready.find(mark)
        found = bytes(self.ready[:at])
        del self.ready[: at + len(mark)]
        return found

    def take(self, count: int) -> bytes:
        while len(self.ready) < count:
            if not self._fill():
                raise ValueError("record shorter than its content length")
        found = bytes(self.ready[:count])
        del self.ready[:count]
        return found

    def close(self) -> None:
        if self.ready or self._fill():
            raise ValueError("more than one record in a member")


def read_records(stream) -> Iterator[dict]:
    """The records of an archive in order, each checked against its length and digest."""
    members = Members(stream)
    while members.open():
        version, *lines = members.until(CRLF * 2).split(CRLF)
        if version != VERSION:
            raise ValueError("not a record")
        header = dict(line.split(b": ", 1) for line in lines)
        block = members.take(int(header[b"Content-Length"]))
        if members.take(4) != CRLF * 2:
            raise ValueError("record longer than its content length")
        members.close()
        digest = header[b"WARC-Payload-Digest"].removeprefix(b"sha256:").decode()
        length = int(header[b"WARC-Payload-Length"])
        found = {
            "page_id": page_of(header[b"WARC-Record-ID"]), "payload_bytes": length,
            "payload_digest": digest, "record_type": header[b"WARC-Type"].decode(),
            "refers_to": None, "payload": None,
        }
        if header[b"WARC-Type"] == b"revisit":
            found["refers_to"] = page_of(header[b"WARC-Refers-To"])
        else:
            payload = block.partition(CRLF * 2)[2]
            if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError("payload does not match its digest")
            found["payload"] = payload
        yield found


def _write(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, count = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for page, url, html, refers in zip(*[batch.column(c) for c in ("id", "url", "payload", "refers")]):
                if out is None:
                    store, place = shared_file(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place)
                out.write(member(record(page.as_py(), url.as_py(), html.as_py() or b"", refers.as_py())))
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([count], pa.int64())})

    return write


def write_archives(
    df: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html"
) -> DataFrame:
    """Write every row as a record; returns the table of archives (path, records)."""
    rows = df.select(
        named(id_col).cast("long").alias("id"), named(url_col).cast("string").alias("url"),
        named(payload_col).cast("string").cast("binary").alias("payload"),
    )
    rows = rows.withColumn("digest", F.sha2(F.coalesce("payload", F.lit(b"")), 256))
    fits = (F.octet_length("payload") >= LEAST_BYTES) & F.col("id").isNotNull()
    first = rows.filter(fits).groupBy("digest").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("copies")
    )
    first = stored(first.filter("first < last").select("digest", "first", "copies"), "first")
    # At most HOT_DIGESTS payloads have more copies than this; they go to every task.
    many = (first.agg(F.sum("copies")).first()[0] or 0) / HOT_DIGESTS
    hot = first.filter(F.col("copies") > many).select(F.col("digest").alias("hot_digest"), F.col("first").alias("hot"))
    other = first.filter(F.col("copies") <= many).select(F.col("digest").alias("key"), "first")
    joined = rows.join(F.broadcast(hot), F.col("digest") == F.col("hot_digest"), "left")
    # Rows that need no partner any more are spread by a key that no digest equals.
    spread = F.concat(F.lit("-"), F.xxhash64("id", "url", "digest").cast("string"))
    joined = joined.withColumn("key", F.when(fits & F.col("hot").isNull(), F.col("digest")).otherwise(spread))
    joined = joined.join(other, "key", "left")
    joined = joined.withColumn("first", F.when(fits, F.coalesce("hot", "first")))
    refers = F.when(F.col("id") != F.col("first"), F.col("first"))
    ready = joined.select("id", "url", "payload", refers.alias("refers"))
    return stored(ready.mapInArrow(_write(folder), "path string, records long"), "archives")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of all archives, one task per archive; payloads only if wanted."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                store, place = shared_file(path)
                rows, size = [], 0
                with store.open_input_stream(place) as stream:
                    for found in read_records(stream):
                        if not payloads:
                            del found["payload"]
                        rows.append(found)
                        size += 1000 + len(found.get("payload") or b"")
                        if size > 4_000_000:
                            yield frame(rows)
                            rows, size = [], 0
                if rows:
                    yield frame(rows)

    def frame(rows: list[dict]) -> pd.DataFrame:
        made = pd.DataFrame(rows)
        for c in ("page_id", "refers_to"):
            made[c] = made[c].astype("Int64")
        return made

    shape = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    count = max(1, archives.count())
    paths = archives.select("path").repartition(count, "path")
    return paths.mapInPandas(read, shape + (", payload binary" if payloads else ""))


def round_trip(df: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read them back."""
    folder = scratch_dir(df.sparkSession, "warc")
    return read_archives(write_archives(df, folder))
