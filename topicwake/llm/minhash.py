"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.bloom import key_filter
from topicwake.llm.components import components, forest
from topicwake.llm.jobs import Batches, map_arrow, ship
from topicwake.llm.superminhash import band_keys, signatures
from topicwake.llm.text import Words, blocks, distinct, shingles
from topicwake.session import materialize

#: Members of a cluster that are compared in one task, and the bytes of their sets.
GROUP_ROWS, GROUP_BYTES = 512, 8 << 20
#: Bytes of texts sketched at once; each word needs two bytes for every slot.
SKETCHED = 1 << 18


def sketches(df: DataFrame, size: int, bands: int, width: int) -> DataFrame:
    """(id, n, print, keys) of each row of ``df`` (id, text): set size, fingerprint of the set, band hashes."""

    def sketch(batches: Batches) -> Batches:
        for batch in batches:
            for lo, hi, data, offsets in blocks(batch.column(1), SKETCHED):
                n = hi - lo
                text, hashes = distinct(*shingles(Words(data, offsets), size))
                bounds = np.searchsorted(text, np.arange(n + 1))
                keys = band_keys(signatures(text, hashes, n, bands * width), bands).view(np.int64)
                prints = [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds, bounds[1:])]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, n),
                        pa.array(np.diff(bounds)),
                        pa.array(prints, pa.binary()),
                        pa.ListArray.from_arrays(np.arange(0, n * bands + 1, bands, dtype=np.int32), keys.ravel()),
                    ],
                    names=["id", "n", "print", "keys"],
                )

    return map_arrow(df, sketch, "id long, n long, print binary, keys array<long>")


def similar_pairs(sets: list[np.ndarray], left: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) with 100 * intersection >= percent * union, i below ``left``, j at or above it (or i < j if left is all).

    Intersections are counted by a product of 0/1 matrices over the shingles that two sets at least
    share, a slice of shingles at a time.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        hit = 100 * common >= percent * (sizes.sum() - common)
        return (np.array([0]), np.array([1])) if hit else (np.zeros(0, int), np.zeros(0, int))
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(np.concatenate(sets), kind="stable")
    hashes, owner = np.concatenate(sets)[order], owner[order]
    new = np.append(True, hashes[1:] != hashes[:-1])
    number = np.bincount(np.cumsum(new) - 1)
    shared = np.repeat(number > 1, number)
    owner, code = owner[shared], np.cumsum(new[shared]) - 1
    whole = left == n
    counts = np.zeros((left, n if whole else n - left), np.float32)
    step = max(256, (16 << 20) // (4 * n))
    for lo in range(0, int(code[-1]) + 1 if len(code) else 0, step):
        a, b = np.searchsorted(code, [lo, lo + step])
        table = np.zeros((n, step), np.float32)
        table[owner[a:b], code[a:b] - lo] = 1
        counts += table[:left] @ (table if whole else table[left:]).T
    other = sizes if whole else sizes[left:]
    hit = 100 * counts >= percent * (sizes[:left, None] + other[None, :] - counts)
    if whole:
        hit = np.triu(hit, 1)
    i, j = np.nonzero(hit)
    return i, j if whole else j + left


def _verify(size: int, percent: int):
    def verify(table: pa.Table) -> pa.Table:
        side = np.asarray(table.column("side").combine_chunks())
        order = np.argsort(side, kind="stable")
        ids = np.asarray(table.column("id").combine_chunks())[order]
        sets = []
        for lo, hi, data, offsets in blocks(table.column("text").combine_chunks().take(pa.array(order))):
            text, hashes = distinct(*shingles(Words(data, offsets), size))
            sets += np.split(hashes, np.searchsorted(text, np.arange(1, hi - lo)))
        left = int((side == 0).sum())
        i, j = similar_pairs(sets, left, percent)
        u, v = forest(ids[i], ids[j])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return verify


def clusters(reps: DataFrame) -> DataFrame:
    """(hub, id): for every band bucket of two or more ``reps`` (id, keys) its members under the bucket's hub.

    The hub is the member that shares buckets with most others. All buckets of a hub form one cluster, so
    that every two members of a bucket are in a cluster together, most of them once.
    """
    entries = reps.select("id", F.explode("keys").alias("key"))
    sizes = materialize(entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "band-counts")
    shared = key_filter(sizes.select("key"))  # most buckets of a large table have one member and need not move
    entries = materialize(entries.where(shared.column("key")).join(sizes, "key"), "buckets")
    popular = entries.groupBy("id").agg(F.sum("c").alias("p"))
    hubs = entries.join(popular, "id").groupBy("key").agg(F.max(F.struct("p", -F.col("id"))).alias("top"))
    hubs = materialize(hubs.select("key", (-F.col("top.col2")).alias("hub")), "hubs")
    return entries.join(hubs, "key").select("hub", "id").distinct()


def near_duplicates(
    df: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 50,
    width: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row of ``df``; ids are longs.

    A document's set holds its distinct shingles of lower-cased (A-Z) words; fewer words make one
    shingle. Two documents are linked if 100 * intersection >= percent * union; a component is what links
    reach, named after its least id, which is the row kept. A null, empty or blank text has no shingles
    and is linked with nothing. Rows that share an id count as one document, linked to whatever one of their texts
    is linked to; a null id is linked with nothing, has a null component and is kept. An empty table gives no rows;
    other columns are ignored.

    Equal sets are found by fingerprint and linked as a star, whatever their number. Only one document
    of each set is banded. With 50 bands of 7 slots a pair at 0.8 is missed with a chance below 8e-6, a
    pair at 0.85 below 1e-8. Members of a cluster are then compared on full sets in groups of bounded
    size, every group with itself and with each other, and each comparison returns a spanning forest
    instead of its pairs: no link between components is lost, and output grows with members.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ship(df.sparkSession)
    table = materialize(sketches(docs, shingle, bands, width), "sketches")
    linkable = table.where("n > 0 and id is not null")
    reps = linkable.groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    reps = materialize(reps, "sets")  # joined as a written table, Spark can split a set that a third of all rows have
    copies = linkable.select(F.col("id").alias("u"), "print").join(
        reps.select(F.col("id").alias("v"), "print"), "print"
    ).where("u <> v").select("u", "v")
    members = materialize(clusters(reps).join(reps.select("id", "n"), "id"), "clusters")
    groups = members.groupBy("hub").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_ROWS), F.ceil(F.sum("n") * 8 / GROUP_BYTES)).alias("groups")
    )
    own = F.pmod(F.xxhash64("id"), "groups")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("other")
    placed = members.join(groups, "hub").select("hub", "id", own.alias("own"), "groups").select("hub", "id", "own", other)
    placed = placed.select(
        "hub",
        "id",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    wanted = key_filter(members.select("id"))
    texts = placed.join(docs.where("id is not null").where(wanted.column("id")), "id").select("hub", "a", "b", "side", "id", "text")
    links = texts.groupBy("hub", "a", "b").applyInArrow(_verify(shingle, percent), "u long, v long")
    links = materialize(links, "links")  # else each task would keep two Python workers, for comparing and for union-find
    found = components(copies.unionByName(links))
    rows = table.join(found, table.id == found.node, "left")
    component = F.coalesce("component", "id")
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
