"""WARC archives written from and read back as a chunked record table.

A record longer than a chunk is several rows (record, chunk number, bytes), in order, so that neither writing nor reading holds a whole
payload in Python. The digest of what has been seen so far goes along with the chunks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwake.llm.bloom import key_filter
from topicwake.llm.jobs import Batches, map_arrow
from topicwake.session import materialize
from topicwake.sources.stores import open_store

#: Bytes of a chunk, of an archive from which the next one is begun, and of compressed data read at once.
CHUNK, ARCHIVE, READ = 1 << 16, 1 << 30, 1 << 18
#: Fixed values of the format.
VERSION, PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


# ---- what is written ----


def records(df: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """(page_id, url, payload, n_bytes, digest, refers_to, revisit) of each row.

    Rows whose payload may occur twice meet the largest id of their payload; the others, told apart by a filter of fixed size, do not move.
    """
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload"))
    key = {"n_bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "mark": F.xxhash64("payload")}
    rows = rows.withColumns(key)
    counts = rows.where(F.col("n_bytes") >= least).groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
    several = materialize(counts.where("n > 1").drop("n"), "payloads")
    listed = key_filter(several.select("mark"))
    doubtful = (F.col("n_bytes") >= least) & listed.column("mark")
    names = ["page_id", "url", "payload", "n_bytes", "digest"]
    alone = rows.where(~doubtful).select(*names, F.lit(None).cast("long").alias("refers_to"), F.lit(False).alias("revisit"))
    met = rows.where(doubtful).join(several.withColumn("met", F.lit(True)), [*key], "left")
    revisit = F.coalesce(F.col("met"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return alone.unionByName(met.select(*names, F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")))


def chunked(rows: DataFrame, size: int = CHUNK) -> DataFrame:
    """The records as rows of at most ``size`` bytes each, chunk 0, 1, ... next to one another; a revisit has one chunk without bytes."""
    pieces = F.when(F.col("revisit"), 1).otherwise(F.greatest(F.lit(1), F.ceil(F.col("n_bytes") / size)))
    each = rows.select("*", F.explode_outer(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("chunk"))
    data = F.substring("payload", (F.col("chunk") * size + 1).cast("int"), F.lit(size))
    empty: Column = F.lit(b"")
    return each.select(
        "page_id", "url", "n_bytes", "digest", "refers_to", "revisit", "chunk", F.when(F.col("revisit"), empty).otherwise(data).alias("data")
    )


def record_id(page_id: int | None, digest: str) -> str:
    """The name of a record; a revisit names the one it refers to without having met it."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{page_id} {digest}'.encode()).digest()[:16], version=5)}>"


def _header(fields: dict[str, object]) -> bytes:
    return (VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n").encode()


def _address(url: str | None) -> str:
    """The URL on one line: control characters, spaces and what is not ASCII as %XX; ``about:blank`` for null."""
    if not url:
        return "about:blank"
    return re.sub(rb"[^\x21-\x7E]", lambda m: b"%%%02X" % m[0][0], url.encode()).decode()


def _http_head(n_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()


class _Archive:
    """One archive being written: a compressed member for each record."""

    def __init__(self, folder: str, date: str):
        self.path, self.date = f"{folder}/{uuid.uuid4().hex}.warc.gz", date
        self.store, name = open_store(self.path)
        self.store.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out, self.n_records, self.n_bytes = self.store.open_output_stream(name, compression=None), 0, 0
        self.packer = None
        note = b"software: topicwake\r\nformat: " + VERSION.encode() + b"\r\n"
        self.begin({"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields", "Content-Length": len(note)}, f"<urn:uuid:{uuid.uuid4()}>")
        self.write(note)
        self.end()

    def begin(self, fields: dict[str, object], name: str) -> None:
        self.packer = zlib.compressobj(1, zlib.DEFLATED, 31)
        self.write(_header({"WARC-Type": fields.pop("WARC-Type"), "WARC-Record-ID": name, "WARC-Date": self.date, **fields}))

    def write(self, data: bytes | memoryview) -> None:
        self._put(self.packer.compress(data))

    def end(self) -> None:
        self.write(_END)
        self._put(self.packer.flush())
        self.n_records += 1

    def _put(self, packed: bytes) -> None:
        self.out.write(packed)
        self.n_bytes += len(packed)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        columns = [pa.array([x]) for x in (self.path, self.n_records - 1, self.n_bytes)]
        return pa.record_batch(columns, names=["path", "n_records", "n_bytes"])


def write_archives(
    df: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for each row of ``df`` below ``folder``; returns (path, n_records, n_bytes) of the archives.

    Of rows with equal payloads of ``least`` bytes or more, the one of the largest id is a response and the others are revisits that name
    it; all smaller payloads are responses. Equal means equal length, SHA-1 and a second hash. A null payload is empty, a null URL is ``about:blank``, a
    null id is the smallest. Rows that share the largest id and the payload are all responses. An empty table gives no archives; other columns are ignored.

    Tasks write archives of about a gigabyte under names of their own. The returned table names those of tasks that
    succeeded only, so what a lost executor leaves is never read.
    """

    def write(batches: Batches) -> Batches:
        out: _Archive | None = None
        state, due = None, ""
        for batch in batches:
            data = batch.column(7)
            for i, (page, url, n_bytes, digest, refers, revisit, chunk) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:7]))):
                if chunk == 0:
                    if out is not None and out.n_bytes >= ARCHIVE:
                        yield out.close()
                        out = None
                    out = out or _Archive(folder, date)
                    head = _http_head(n_bytes)
                    fields = {
                        "WARC-Type": "revisit" if revisit else "response",
                        "WARC-Target-URI": _address(url),
                        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
                        "WARC-Profile": PROFILE if revisit else None,
                        "WARC-Refers-To": record_id(refers, digest) if revisit else None,
                        "Content-Type": "application/http;msgtype=response",
                        "Content-Length": len(head) + (0 if revisit else n_bytes),
                        "Page-Id": page,
                        "Payload-Length": n_bytes,
                        "Refers-To-Page-Id": refers,
                    }
                    out.begin(fields, record_id(page, digest))
                    out.write(head)
                    state, due, left = hashlib.sha1(), digest, 0 if revisit else n_bytes
                piece = data[i].as_buffer()
                state.update(piece)
                out.write(memoryview(piece))
                left -= len(piece)
                if left <= 0:
                    out.end()
                    if left < 0 or not revisit and state.hexdigest() != due:
                        raise ValueError(f"chunks of page {page} do not make up its payload")
        if out is not None:
            yield out.close()

    chunks = chunked(records(df, id_col, url_col, payload_col, least))
    return materialize(map_arrow(chunks, write, "path string, n_records long, n_bytes long"), "archives")


# ---- what is read ----


class _Members:
    """The plain bytes of an archive, compressed member by member or not at all; a bounded stretch is held at a time."""

    def __init__(self, stream):
        self.stream, self.held, self.at, self.rest, self.packed = stream, b"", 0, b"", None

    def _more(self) -> bool:
        raw = self.rest or self.stream.read(READ)
        if not raw:
            return False
        if self.packed is None:
            self.packed = raw[:2] == b"\x1f\x8b" and zlib.decompressobj(31)
        plain, self.rest = raw, b""
        if self.packed:
            plain, self.rest = self.packed.decompress(raw, READ), self.packed.unconsumed_tail
            if self.packed.eof:
                self.rest, self.packed = self.packed.unused_data, zlib.decompressobj(31)
        self.held, self.at = self.held[self.at :] + plain, 0
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the archive."""
        while (end := self.held.find(mark, self.at)) < 0:
            if not self._more():
                if self.at < len(self.held):
                    raise ValueError("the archive breaks off in a header")
                return None
        return self._next(end + len(mark) - self.at)

    def take(self, n: int) -> bytes:
        while len(self.held) - self.at < n:
            if not self._more():
                raise ValueError("the archive breaks off in a record")
        return self._next(n)

    def _next(self, n: int) -> bytes:
        self.at += n
        return self.held[self.at - n : self.at]


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines[1:] if line)}


def read_chunks(stream, size: int = CHUNK) -> Iterator[tuple]:
    """(record id, page id, type, refers to, chunk, offset, bytes, digest so far, last, payload length, payload digest) of an open archive.

    The digest so far is that of the payload up to the end of the chunk. A response's digest and length must equal those in its header.
    """
    members = _Members(stream)
    while (head := members.until(_END)) is not None:
        f = _fields(head)
        left = int(f["content-length"])
        kind = f["warc-type"]
        if kind in ("response", "revisit"):
            http = members.until(_END)
            left -= len(http)
            page, refers = f.get("page-id"), f.get("refers-to-page-id")
            name, due = f["warc-record-id"], base64.b32decode(f["warc-payload-digest"].removeprefix("sha1:")).hex()
            length, state, chunk, at = int(f["payload-length"]), hashlib.sha1(), 0, 0
            while True:
                data = members.take(min(size, left))
                state.update(data)
                left -= len(data)
                digest = state.copy().hexdigest()
                if not left and kind == "response" and (digest != due or at + len(data) != length):
                    raise ValueError(f"record {name} does not match its digest")
                yield (
                    name, None if page is None else int(page), kind, None if refers is None else int(refers),
                    chunk, at, data, digest, not left, length, due,
                )
                chunk, at = chunk + 1, at + len(data)
                if not left:
                    break
        else:
            while left:
                left -= len(members.take(min(size, left)))
        if members.take(4) != _END:
            raise ValueError("a record is longer than its header says")


_TABLE = pa.schema(
    [
        ("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("chunk", pa.int64()),
        ("offset", pa.int64()), ("data", pa.binary()), ("digest", pa.string()), ("last", pa.bool_()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)


def read_archives(manifest: DataFrame, size: int = CHUNK, data: bool = True) -> DataFrame:
    """The chunk table of the archives that ``manifest`` names in ``path``; without ``data``, its bytes are null.

    ``record_id`` and ``chunk`` name a row. ``digest`` is the SHA-1 of the payload up to the chunk's end, ``last`` marks a record's last
    chunk, where it equals ``payload_digest``; for a revisit, which has no bytes, length and digest are those of the payload it refers to. A damaged archive is an error.
    """

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_stream(name, compression=None) as stream:
                    held, n = [], 0
                    for row in read_chunks(stream, size):
                        held.append(row if data else (*row[:6], None, *row[7:]))
                        n += len(row[6]) if data else 0
                        if n >= 1 << 22 or len(held) >= 2000:
                            yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), _TABLE)], schema=_TABLE)
                            held, n = [], 0
                    if held:
                        yield pa.record_batch([pa.array(c, t.type) for c, t in zip(zip(*held), _TABLE)], schema=_TABLE)

    schema = (
        "record_id string, page_id long, record_type string, refers_to long, chunk long, offset long, data binary, digest string, last boolean, "
        "payload_bytes long, payload_digest string"
    )
    paths = manifest.select("path")
    files = max(1, min(paths.count(), 64 * manifest.sparkSession.sparkContext.defaultParallelism))
    return map_arrow(paths.repartition(files, "path"), read, schema)
