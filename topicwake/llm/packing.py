"""Best-fit packing of token sequences by bin completion over a histogram of lengths."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwake.llm.encode import encoder
from topicwake.llm.jobs import map_arrow
from topicwake.session import materialize

Plan = list[tuple[tuple[int, ...], int]]  # lengths of a bin from the left, and how many such bins


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing on a histogram: equal bins are held once, with their number."""
    open_bins: dict[int, list[list]] = defaultdict(list)
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, group in open_bins.items() if r >= length and group), default=None)
            if room is None:
                fit = capacity // length
                full, rest = divmod(left, fit)
                if full:
                    open_bins[capacity - fit * length].append([(length,) * fit, full])
                if rest:
                    open_bins[capacity - rest * length].append([(length,) * rest, 1])
                break
            items, number = open_bins[room].pop()
            used = min(number, left)
            if used < number:
                open_bins[room].append([items, number - used])
            open_bins[room - length].append([(*items, length), used])
            left -= used
    return [(items, number) for group in open_bins.values() for items, number in group]


def fillings(room: int, counts: dict[int, int], largest: int, width: int, effort: int) -> list[tuple[int, ...]]:
    """Undominated sets of lengths for ``room``, least waste first, at most ``width`` of them.

    A set is maximal (no further length fits). Of two sets where one follows from the other by
    shrinking a length, only the fuller is kept; larger lengths come first among equal waste. ``effort``
    bounds the sets looked at, since their number is exponential.
    """
    lengths = sorted((x for x, n in counts.items() if n and x <= min(room, largest)), reverse=True)
    if not lengths:
        return [()]
    smallest, found, looked = lengths[-1], {}, 0
    stack = [(0, room, ())]
    while stack and looked < effort:
        place, left, items = stack.pop()
        looked += 1
        fits = [k for k in range(place, len(lengths)) if lengths[k] <= left]
        fits = [k for k in fits if items.count(lengths[k]) < counts[lengths[k]]]
        if not fits:
            found.setdefault(items, left)
            if left == 0 and sum(w == 0 for w in found.values()) >= width:
                break
            continue
        exact = [k for k in fits if lengths[k] == left]
        near = exact or fits[:3] + ([fits[-1]] if lengths[fits[-1]] == smallest else [])
        for k in reversed(near):
            stack.append((k, left - lengths[k], (*items, lengths[k])))
    ranked = sorted(found.items(), key=lambda x: (x[1], len(x[0]), tuple(-v for v in x[0])))
    kept: list[tuple[int, ...]] = []
    for items, _ in ranked:
        if not any(len(k) == len(items) and all(a >= b for a, b in zip(k, items)) for k in kept):
            kept.append(items)
        if len(kept) == width:
            break
    return kept or [()]


def complete_bins(counts: dict[int, int], capacity: int, width: int = 4, effort: int = 400, nodes: int = 6_000) -> Plan:
    """Few bins for the given numbers of lengths, by bin completion.

    Around the largest length left, its fillings are tried in order of waste; a filling is repeated as
    often as the numbers allow, so the depth follows the distinct lengths and not the documents. A branch
    ends when its waste excludes fewer bins than the best plan so far, which begins as best-fit
    decreasing. ``nodes`` bounds the search; the best plan found until then is returned.
    """
    counts = {k: n for k, n in counts.items() if n}
    total = sum(k * n for k, n in counts.items())
    if not total:
        return []
    bound = max(-(-total // capacity), sum(n for k, n in counts.items() if 2 * k > capacity))
    best = best_fit(counts, capacity)
    fewest = sum(n for _, n in best)
    seen = 0
    trail: list[tuple[tuple[int, ...], int]] = []
    stack: list[tuple[int, int, list]] = []  # bins and waste so far, fillings still to try

    def options() -> list:
        largest = max(counts)
        counts[largest] -= 1
        sets = fillings(capacity - largest, counts, largest, width, effort)
        counts[largest] += 1
        return [(largest, *s) for s in reversed(sets)]

    bins = waste = 0
    todo = options()
    while fewest > bound and seen < nodes:
        seen += 1
        if not todo:
            if not stack:
                break
            bins, waste, todo = stack.pop()
            items, number = trail.pop()
            for x in items:
                counts[x] = counts.get(x, 0) + number
            continue
        items = todo.pop()
        need = defaultdict(int)
        for x in items:
            need[x] += 1
        number = min(counts[x] // n for x, n in need.items())
        spare = capacity - sum(items)
        if waste + spare > (fewest - 1) * capacity - total:
            continue
        allowed = ((fewest - 1) * capacity - total - waste) // spare if spare else number
        number = max(1, min(number, allowed))
        stack.append((bins, waste, todo))
        trail.append((items, number))
        for x, n in need.items():
            counts[x] -= n * number
            if not counts[x]:
                del counts[x]
        bins, waste = bins + number, waste + spare * number
        if not counts:
            if bins < fewest:
                fewest, best = bins, list(trail)
            todo = []
        else:
            left = total - sum(sum(i) * n for i, n in trail)
            todo = options() if bins + -(-left // capacity) < fewest else []
    return best


def _slots(plan: Plan) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, first sequence, offset) of the places it gets."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for items, number in plan:
        offset = 0
        for x in items:
            rows[x].append((used[x], sequence, offset))
            used[x] += number
            offset += x
        sequence += number
    return {x: np.array(r, np.int64) for x, r in rows.items()}


def pieces(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, rank) of the pieces of every text, one pass over the scan.

    A longer text is cut so that all pieces but the first are full. ``rank`` counts the pieces of that
    length before this one in its ``part``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seen = encoder(tokenizer, False), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for lo, ids, offsets in own.blocks(batch.column(1)):
                n = np.diff(offsets) + 1
                number = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), number)
                place = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
                first = n - (number - 1) * capacity
                length = np.where(place == 0, first[doc], capacity)
                start = np.where(place == 0, 0, first[doc] + (place - 1) * capacity)
                ends = np.full(len(ids) + len(n), end_id, "<u4")
                keep = np.ones(len(ends), bool)
                keep[offsets[1:] + np.arange(len(n))] = False
                ends[keep] = ids
                raw, at = ends.tobytes(), (offsets[:-1] + np.arange(len(n)))[doc] + start
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist())]
                order = np.argsort(length, kind="stable")
                by = length[order]
                new = np.append(True, by[1:] != by[:-1])
                rank = np.empty(len(by), np.int64)
                rank[order] = np.arange(len(by)) - np.flatnonzero(new)[np.cumsum(new) - 1] + seen[by]
                seen += np.bincount(by, minlength=capacity + 1)
                yield pa.record_batch(
                    [
                        batch.column(0).take(pa.array(lo + doc)),
                        pa.array(place, pa.int32()),
                        pa.array(start),
                        pa.array(length),
                        pa.array(sums, pa.int64()),
                        pa.array(np.full(len(doc), part)),
                        pa.array(rank),
                    ],
                    names=[id_col, "piece", "start", "length", "ids_crc32", "part", "rank"],
                )

    rows = df.select(id_col, text_col)
    kind = rows.schema[0].dataType.simpleString()
    schema = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, part long, rank long"
    return map_arrow(rows, cut, schema, tokenizer=True)


def pack(
    df: DataFrame, tokenizer: str, end_id: int, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset): every piece with its place in a sequence.

    A null or empty text is the end id alone. Repeated rows are packed each, null ids stay null, an empty
    table gives no rows; other columns are ignored.

    Only the histogram of lengths, at most ``capacity`` rows for any input, reaches the driver; there bin
    completion gives a plan of distinct bins with their numbers, whose size follows ``capacity`` as well.
    A piece finds its place from its rank among the pieces of its length: the rank in its part plus the
    pieces of the parts before.
    """
    spark = df.sparkSession
    cut = materialize(pieces(df, tokenizer, end_id, capacity, id_col, text_col), "pieces")
    per_part = materialize(cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(capacity, 0)
    plan = complete_bins(histogram, capacity)
    slots = _slots([((capacity,), full), *plan] if full else plan)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    held = spark.sparkContext.broadcast(slots)
    names = [id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (3, 5))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length):
                rows, table = np.flatnonzero(length == x), held.value[int(x)]
                slot = np.searchsorted(table[:, 0], rank[rows], "right") - 1
                sequence[rows] = table[slot, 1] + rank[rows] - table[slot, 0]
                offset[rows] = table[slot, 2]
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=names)

    kind = cut.schema[id_col].dataType.simpleString()
    return map_arrow(
        ranked.select(id_col, "piece", "start", "length", "ids_crc32", "rank"),
        place,
        f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
