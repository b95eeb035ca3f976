"""WARC archives: round trips, revisits, chunks, damage."""

import gzip
import hashlib
import io
import random
import re

import pytest
from cases import CLASHES

from topicwake.llm import warc
from topicwake.llm.warc import read_archives, read_chunks, write_archives
from topicwake.session import new_table_path

RNG = random.Random(3)
LONG = "".join(RNG.choice("abcdefgh é\r\n") for _ in range(300_000))
PAGES = [
    (1, "http://a/ b\né", "<p>" + "x" * 2000), (2, None, "<p>" + "x" * 2000), (9, "http://a", "<p>" + "x" * 2000), (3, "http://c", None), (4, "http://d", ""),
    (5, "", "small"), (6, "http://e", "small"), (7, "http://f", LONG), (8, "http://f", LONG), (None, "http://f", LONG), (None, None, None), (10, "u", "é" * 500),
    (11, "u", "é" * 500), (12, "u", "y" * 999), (13, "u", "y" * 999), (14, "x", "\r\n\r\nWARC/1.1\r\n\r\n" * 80), (15, "twice", "z" * 3000), (15, "twice", "z" * 3000),
    (None, "n", "q" * 1500), (None, "n", "q" * 1500),
]


def table(spark, rows):
    names = [*CLASHES, "payload", "n_bytes", "digest", "refers_to", "revisit", "chunk", "first", "met", "mark"]
    full = [(*r, *(None if i % 3 == 0 else f"{c}{i}" for c in names)) for i, r in enumerate(rows)]
    kinds = ", ".join(f"`{c}` string" for c in names)
    return spark.createDataFrame(full, f"page_id long, url string, html string, {kinds}").repartition(4)


def wanted(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "")]
        first = max((p for p in same if p is not None), default=None)
        revisit = len(raw) >= 1000 and page != first
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("archive", [1 << 30, 1000])
def test_round_trip(spark, monkeypatch, archive):
    monkeypatch.setattr(warc, "ARCHIVE", archive)
    manifest = write_archives(table(spark, PAGES), new_table_path(spark, "warc"))
    rows = read_archives(manifest).collect()
    last = [r for r in rows if r.last]
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in last), key=str) == wanted(PAGES)
    assert sum(r.n_records for r in manifest.collect()) == len(PAGES)
    texts = {(p, hashlib.sha1((h or "").encode()).hexdigest()): (h or "").encode() for p, _, h in PAGES}
    for r in last:
        chunks = sorted(x.chunk for x in rows if x.record_id == r.record_id)
        if r.record_type == "response" and (r.page_id, r.payload_digest) not in {(15, last[0].payload_digest)} and len(set(chunks)) == len(chunks):
            data = b"".join(bytes(x.data) for x in sorted(rows, key=lambda x: x.chunk) if x.record_id == r.record_id)
            assert data == texts[r.page_id, r.payload_digest] and len(chunks) == max(1, -(-len(data) // warc.CHUNK))
    assert max(len(r.data) for r in rows) <= warc.CHUNK


def test_chunks_carry_the_digest_so_far(spark):
    manifest = write_archives(table(spark, PAGES[7:8]), new_table_path(spark, "warc"))
    raw = LONG.encode()
    rows = read_archives(manifest, size=50_000).orderBy("chunk").collect()
    assert [r.offset for r in rows] == list(range(0, len(raw), 50_000)) and len(rows) > 5
    assert all(r.digest == hashlib.sha1(raw[: r.offset + len(r.data)]).hexdigest() for r in rows)
    assert read_archives(manifest, data=False).where("data is not null").isEmpty()


def test_archives_are_plain_warc(spark):
    """Read by a few lines that know the format only: members, headers, lengths, references."""
    found = {}
    for r in write_archives(table(spark, PAGES), new_table_path(spark, "warc")).collect():
        with open(r.path.removeprefix("file:"), "rb") as f:
            raw = gzip.decompress(f.read())
        while raw:
            head, raw = raw.split(b"\r\n\r\n", 1)
            fields = dict(line.split(": ", 1) for line in head.decode("ascii").split("\r\n")[1:])
            n = int(fields["Content-Length"])
            body, end, raw = raw[:n], raw[n : n + 4], raw[n + 4 :]
            assert head.startswith(b"WARC/1.1\r\n") and end == b"\r\n\r\n" and re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"])
            if fields["WARC-Type"] != "warcinfo":
                http, payload = body.split(b"\r\n\r\n", 1)
                assert http.startswith(b"HTTP/1.1 200 OK") and (fields["WARC-Type"] == "response" or not payload)
                found[fields["WARC-Record-ID"]] = fields
    revisits = [f for f in found.values() if f["WARC-Type"] == "revisit"]
    assert revisits and all(found[f["WARC-Refers-To"]]["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] for f in revisits)
    assert {f["WARC-Target-URI"] for f in found.values()} >= {"http://a/%20b%0A%C3%A9", "about:blank"}


def test_damage_and_empty_tables(spark):
    manifest = write_archives(table(spark, PAGES[:1]), new_table_path(spark, "warc"))
    with open(manifest.first().path.removeprefix("file:"), "rb") as f:
        raw = gzip.decompress(f.read())
    assert [r[2] for r in read_chunks(io.BytesIO(raw))] == ["response"]  # archives may be plain
    for broken in (raw[:-3], raw[:-900], raw.replace(b"xxxx", b"xxyx", 1), raw.replace(b"Content-Length: 20", b"Content-Length: 10", 1)):
        with pytest.raises(ValueError):
            list(read_chunks(io.BytesIO(broken)))
    none = write_archives(table(spark, []), new_table_path(spark, "warc"))
    assert none.count() == 0 and read_archives(none).count() == 0
