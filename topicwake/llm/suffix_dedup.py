"""Exact removal of repeated byte strings with a partitioned suffix array.

All places of the corpus whose next ``depth`` bytes could be equal must meet in one task to be sorted. They
are brought together by anchors: a window of ``depth`` bytes belongs to the least hash among the runs of
``GRAM`` bytes inside it, a choice that depends on the window alone, so equal windows have equal anchors.
Neighbouring windows mostly share an anchor; such a stretch of text is a context. Contexts whose
anchor occurs once are unique at once; equal contexts are repeats at once; only different contexts
around the same anchor need their suffixes sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.bloom import key_filter
from topicwake.llm.jobs import Batches, map_arrow
from topicwake.llm.suffixes import join, share_with_neighbour, sort_suffixes
from topicwake.llm.text import U64, blocks, mix, ragged, rolling
from topicwake.session import materialize

GRAM = 40
#: Different contexts of an anchor that are sorted together; more are split by longer strings first.
GROUP = 1000
#: Bytes of contexts sorted at once.
SORTED = 1 << 19


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` values in a row, from running minima forward and backward in blocks."""
    n = len(values) - width + 1
    size = -(-len(values) // width) * width
    padded = np.full(size, ~U64(0))
    padded[: len(values)] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def contexts(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, anchor hash, context hash) of every context of a block; places in the block."""
    n = len(data)
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= depth)
    if not len(long):
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U64),) * 2
    roll = rolling(data)
    hashes = (roll.sums[GRAM:] - roll.sums[:-GRAM]) * roll.inverse[: n - GRAM + 1]
    hashes = mix(hashes + U64(GRAM * 0x9E3779B9))
    ranked = (hashes & U64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=U64)
    least = (_sliding_least(ranked, depth - GRAM + 1) & U64(0xFFFFFFFF)).astype(np.int64)
    count = sizes[long] - depth + 1
    window = ragged(offsets[:-1][long], count)
    text = np.repeat(long, count)
    anchor = least[window]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))
    at = np.flatnonzero(new)
    number = np.diff(np.append(at, len(anchor)))
    first = window[at]
    return text[at], first, number, anchor[at], hashes[anchor[at]], roll.of(first, first + number - 1 + depth)


def _tag(key: np.ndarray) -> np.ndarray:
    return key.view(np.int64)


def _context_rows(df: DataFrame, depth: int) -> DataFrame:
    """(key, ctx, pid, at); ``at`` packs 16 bits of the text's hash, 32 of the first window, 8 and 8 of windows and anchor."""

    def find(batches: Batches) -> Batches:
        for batch in batches:
            pid, th = np.asarray(batch.column(0)), np.asarray(batch.column(1)).astype(np.int64)
            for lo, _, data, offsets in blocks(batch.column(2)):
                text, first, number, anchor, key, ctx = contexts(data, offsets, depth)
                start = first - offsets[:-1][text]
                at = (th[lo + text] << 48) | (start << 16) | (number << 8) | (anchor - first)
                columns = [_tag(key), _tag(ctx), pid[lo + text], at]
                yield pa.record_batch([pa.array(c) for c in columns], names=["key", "ctx", "pid", "at"])

    return map_arrow(df.select("pid", "th", "text"), find, "key long, ctx long, pid long, at long")


def _fetch(docs: DataFrame, wanted: DataFrame, depth: int) -> DataFrame:
    """(key, n, m, pid, at, bytes) of the wanted contexts (key, n, m, pid, at); texts without any stay where they are."""
    lists = wanted.groupBy("pid", F.shiftright("at", 48).alias("th")).agg(F.collect_list(F.struct("key", "n", "m", "at")).alias("c"))
    keep = key_filter(wanted.select("pid"))
    rows = docs.where(keep.column("pid")).dropDuplicates(["pid", "th"]).join(lists, ["pid", "th"])

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(2)
            sizes = np.diff(np.asarray(lists.offsets))
            inner = lists.flatten()
            at = np.asarray(inner.field("at"))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            start, number = (at >> 16) & 0xFFFFFFFF, (at >> 8) & 0xFF
            for lo, hi, data, offsets in blocks(batch.column(1)):
                mine = np.flatnonzero((owner >= lo) & (owner < hi))
                begin = offsets[:-1][owner[mine] - lo] + start[mine]
                size = number[mine] - 1 + depth
                raw = data[ragged(begin, size)]
                ends = np.append(0, np.cumsum(size)).astype(np.int32)
                pieces = pa.Array.from_buffers(pa.binary(), len(mine), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())])
                pick = pa.array(mine)
                yield pa.record_batch(
                    [inner.field(f).take(pick) for f in ("key", "n", "m")]
                    + [batch.column(0).take(pa.array(owner[mine])), inner.field("at").take(pick), pieces],
                    names=["key", "n", "m", "pid", "at", "bytes"],
                )

    return map_arrow(rows.select("pid", "text", "c"), cut, "key long, n long, m long, pid long, at long, bytes binary")


def _binary(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = pieces.buffers()
    offsets = np.frombuffer(offsets, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], np.diff(offsets)


_SPANS = "pid long, at long, lo long, hi long, key long, n long, bytes binary"


def _sort_groups(rows: DataFrame, depth: int) -> DataFrame:
    """Repeated windows of the contexts, as runs (pid, at, lo, hi); contexts of too large groups are handed on with their bytes."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        pid, at, n = (np.asarray(table.column(c).combine_chunks()) for c in ("pid", "at", "n"))
        pieces = table.column("bytes").combine_chunks()
        pieces = pieces.chunk(0) if isinstance(pieces, pa.ChunkedArray) else pieces
        raw, sizes = _binary(pieces)
        symbols, starts = join(raw, sizes, depth)
        number = (at >> 8) & 0xFF
        places = ragged(starts, number)
        wanted = np.zeros(len(symbols), bool)
        wanted[places] = True
        order = sort_suffixes(symbols, wanted, depth)
        repeated = np.zeros(len(symbols), bool)
        repeated[order] = share_with_neighbour(symbols, order, depth)
        piece = np.repeat(np.arange(len(at)), number)
        hit = repeated[places] & (n[piece] == 1)  # the others are known as repeats already
        places, piece = places[hit], piece[hit]
        new = np.append(True, (np.diff(places) != 1) | (np.diff(piece) != 0))[: len(places)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(places)) - 1 if len(first) else first
        owner = piece[first]
        begin = ((at[owner] >> 16) & 0xFFFFFFFF) - starts[owner]
        blank = pa.nulls(len(owner), pa.int64())
        return pa.record_batch(
            [pa.array(pid[owner]), pa.array(at[owner]), pa.array(begin + places[first]), pa.array(begin + places[last] + depth)]
            + [blank, blank, pa.nulls(len(owner), pa.binary())],
            names=["pid", "at", "lo", "hi", "key", "n", "bytes"],
        )

    def sort(batches: Batches) -> Batches:
        held, size = [], 0
        for batch in batches:
            large = np.asarray(batch.column("m")) > GROUP
            if large.any():
                out = batch.filter(pa.array(large))
                blank = pa.nulls(out.num_rows, pa.int64())
                yield pa.record_batch(
                    [out.column("pid"), out.column("at"), blank, blank, out.column("key"), out.column("n"), out.column("bytes")],
                    names=["pid", "at", "lo", "hi", "key", "n", "bytes"],
                )
                batch = batch.filter(pa.array(~large))
            if not batch.num_rows:
                continue
            keys = np.asarray(batch.column("key"))
            edges = np.append(np.flatnonzero(np.append(True, keys[1:] != keys[:-1])), len(keys))
            ends = np.cumsum(np.asarray(pa.compute.binary_length(batch.column("bytes"))))
            begin = 0
            for k, edge in enumerate(edges[:-1]):  # a new group begins: sort what is held, if it is enough
                if size + (ends[edge - 1] if edge else 0) - (ends[begin - 1] if begin else 0) >= SORTED and (
                    k or (held and held[-1].column("key")[-1].as_py() != keys[0])
                ):
                    if edge > begin:
                        held.append(batch.slice(begin, edge - begin))
                    yield solve(held)
                    held, size, begin = [], 0, edge
            held.append(batch.slice(begin))
            size += ends[-1] - (ends[begin - 1] if begin else 0)
        if held:
            yield solve(held)

    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = F.when(F.col("m") > GROUP, F.xxhash64("pid", "at")).otherwise(F.lit(0).cast("long"))
    placed = rows.repartition(parts, "key", spread).sortWithinPartitions("key")
    return map_arrow(placed, sort, _SPANS)


def _halves(rows: DataFrame, depth: int, level: int) -> DataFrame:
    """Contexts of large groups cut in two by the anchor's place in their windows, each half keyed by all bytes its windows share."""
    width = depth - GRAM + 1
    step = -(-width // (1 << level))

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            for pid, at, n, raw in zip(*(batch.column(c).to_pylist() for c in ("pid", "at", "n", "bytes"))):
                first, number, anchor = (at >> 16) & 0xFFFFFFFF, (at >> 8) & 0xFF, at & 0xFF
                low, high = anchor - number + 1, anchor
                for a in range(low // step * step, high + 1, step):
                    lo, hi = max(low, a), min(high, a + step - 1)
                    skip = high - hi
                    own = raw[skip : skip + hi - lo + depth]
                    shared = raw[anchor - a : anchor - (a + step - 1) + depth]
                    mark = a.to_bytes(4, "little") + step.to_bytes(4, "little")
                    key, ctx = (
                        int.from_bytes(hashlib.blake2b(mark + x, digest_size=8).digest(), "little", signed=True) for x in (shared, own)
                    )
                    place = (at >> 48 << 48) | ((first + skip) << 16) | ((hi - lo + 1) << 8) | hi
                    out.append((key, ctx, n, pid, place, own))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["key", "ctx", "n", "pid", "at", "bytes"])

    source = rows.select("pid", "at", "n", "bytes")
    return map_arrow(source, cut, "key long, ctx long, n long, pid long, at long, bytes binary")


def _whole(rows: DataFrame, depth: int) -> DataFrame:
    """All windows of a context as one span."""
    lo = F.shiftright("at", 16).bitwiseAND(F.lit(0xFFFFFFFF))
    number = F.shiftright("at", 8).bitwiseAND(F.lit(0xFF))
    return rows.select("pid", "at", lo.alias("lo"), (lo + number - 1 + depth).alias("hi"))


def repeated_spans(docs: DataFrame, depth: int) -> DataFrame:
    """(pid, th, lo, hi): byte ranges covered by strings of ``depth`` bytes that start elsewhere too; they may overlap."""
    rows = _context_rows(docs, depth)
    often = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "anchor-keys")
    found = materialize(rows.join(often, "key"), "anchors")
    # aggregates are written before they are joined, so that Spark can split hot keys
    equal = found.groupBy("key", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("pid", "at")).alias("one"))
    equal = materialize(equal, "equal")
    kinds = materialize(equal.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "kinds")
    groups = materialize(equal.join(kinds, "key").select("key", "ctx", "n", "m", "one.pid", "one.at"), "contexts")
    parts = [_whole(found.join(groups.where("n > 1").select("key", "ctx"), ["key", "ctx"], "left_semi"), depth)]
    wanted = groups.where("m > 1").select("key", "n", "m", "pid", "at")
    level = 0
    pending = _fetch(docs, wanted, depth)
    while True:
        solved = materialize(_sort_groups(pending, depth), "spans")
        parts.append(solved.where("bytes is null").select("pid", "at", "lo", "hi"))
        large = solved.where("bytes is not null")
        if large.isEmpty():
            break
        level += 1
        cut = materialize(_halves(large, depth, level), "halves")
        first = F.min(F.struct("pid", "at")).alias("one")
        equal = cut.groupBy("key", "ctx").agg(F.sum("n").alias("total"), first)
        kinds = equal.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
        equal = materialize(equal.join(kinds, "key"), "contexts")
        parts.append(_whole(cut.where("n = 1").join(equal.where("total > 1").select("key", "ctx"), ["key", "ctx"], "left_semi"), depth))
        one = equal.where("m > 1").select("key", "ctx", F.col("total").alias("n"), "m", "one.pid", "one.at")
        pending = cut.select("key", "ctx", "pid", "at", "bytes").distinct().join(one, ["key", "ctx", "pid", "at"]).select(
            "key", "n", "m", "pid", "at", "bytes"
        )
    spans = parts[0]
    for more in parts[1:]:
        spans = spans.unionByName(more)
    return materialize(spans.select("pid", F.shiftright("at", 48).alias("th"), "lo", "hi"), "repeats")


def suffix_array_dedup(df: DataFrame, depth: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, spans, kept) of each row of ``df``.

    ``spans`` are the maximal byte ranges [start, end) covered by strings of ``depth`` UTF-8 bytes that also start
    at another place of the table, in the same text or another; ``kept`` is what remains, as bytes. Judged on
    the input, not on what is left. A null or empty text, or one shorter than ``depth``, has no spans; repeated rows are repeats
    of each other, wholly removed if long enough; null ids stay null. Two texts under one id are told apart by 16 bits of
    their hash. Ids are longs. An empty table gives no rows; other columns are ignored. ``depth`` is from 48 to 255.

    Contexts are grouped by anchor hash and counted before bytes move. An anchor with very many different
    contexts (the edge of a passage that a third of all texts hold) is not sorted in one task: its contexts
    are cut in halves by the anchor's place, keyed by longer strings, until groups are small; the last halves are single windows,
    which are equal or not. All texts are scanned three times, and only texts with repeats are exchanged.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    docs = docs.withColumns(
        {"pid": F.coalesce("id", F.xxhash64("text")), "th": F.pmod(F.xxhash64("text"), F.lit(1 << 15)).cast("long")}
    )
    spans = repeated_spans(docs, depth)
    merged = spans.groupBy("pid", "th").agg(F.collect_list(F.struct("lo", "hi")).alias("found"))
    touched = key_filter(spans.select("pid").distinct())

    def apply(batches: Batches) -> Batches:
        for batch in batches:
            lists, spans, kept = batch.column(2), [], []
            for raw, found in zip(batch.column(1), lists):
                raw, out, left, end = raw.as_buffer(), [], [], 0
                for x in sorted((f["lo"], f["hi"]) for f in found.as_py() or []):
                    if out and x[0] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], x[1])
                    else:
                        out.append(list(x))
                raw = raw.to_pybytes() if raw is not None else b""
                for lo, hi in out:
                    left.append(raw[end:lo])
                    end = hi
                left.append(raw[end:])
                spans.append([{"start": a, "end": b} for a, b in out])
                kept.append(b"".join(left))
            sizes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.record_batch([batch.column(0), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    schema = "id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    raw = F.col("text").cast("binary")
    some = docs.where(touched.column("pid")).join(merged, ["pid", "th"], "left").select("id", raw.alias("raw"), "found")
    changed = map_arrow(some, apply, schema)
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    rest = docs.where(~touched.column("pid")).select("id", F.octet_length(raw).cast("long").alias("n_bytes"), none.alias("spans"), raw.alias("kept"))
    return changed.unionByName(rest).withColumnRenamed("id", id_col)
