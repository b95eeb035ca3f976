"""Exact top-k inner products by the three-phase uniform threshold over blocks of dimensions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicwake.llm.jobs import Batches, map_arrow
from topicwake.session import materialize

#: Bytes of query vectors that one pass broadcasts, and entries of a score matrix held at once.
PASS_BYTES, MATRIX = 16 << 20, 1 << 20
_LEAST = np.iinfo(np.int64).min


def integers(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component; vectors that are null or hold null, NaN or infinity are left out."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * scale)).alias("v"))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, shorter vectors filled up with zeros and longer ones cut to ``dims``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = np.asarray(vectors.flatten())
    out = np.zeros((len(sizes), dims), np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    for i, (a, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes)):
        out[i, : min(n, dims)] = flat[a : a + min(n, dims)]
    return out


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products; through floats while they hold every possible sum."""
    if not rows.size or not queries.size:
        return np.zeros((len(queries), len(rows)), np.int64)
    top = float(np.abs(queries).max()) * float(np.abs(rows).max()) * queries.shape[1]
    if top < 2**53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k of each row by score, then by smaller id."""
    order = np.lexsort((ids, ~scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _cuts(dims: int, nodes: int) -> list[slice]:
    edges = np.linspace(0, dims, min(nodes, max(dims, 1)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


class _Scores:
    """Scores of a slice of rows, by block of dimensions; ``own`` marks a query's own row."""

    def __init__(self, ids, rows, query_ids, queries, cuts):
        self.ids = ids
        self.parts = [_products(queries[:, c], rows[:, c]) for c in cuts]
        self.total = sum(self.parts)
        at = np.searchsorted(query_ids, ids)
        hit = np.flatnonzero(query_ids[np.minimum(at, len(query_ids) - 1)] == ids)
        self.own = (at[hit], hit)


def _slices(batches: Batches, query_ids, queries, cuts):
    step = max(64, MATRIX // max(1, len(query_ids)))
    for batch in batches:
        ids, rows = np.asarray(batch.column(0)), matrix(batch.column(1), queries.shape[1])
        for lo in range(0, len(ids), step):
            yield _Scores(ids[lo : lo + step], rows[lo : lo + step], query_ids, queries, cuts)


def _pass(rows: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int, nodes: int) -> DataFrame:
    """(query_id, vec_id, score) of at least the k best of each query."""
    spark, n, cuts = rows.sparkSession, len(query_ids), _cuts(queries.shape[1], nodes)
    held = spark.sparkContext.broadcast((query_ids, queries))

    def gather(batches: Batches) -> Batches:
        """Local lists: for each block the k best partial scores, with their whole scores, and the least partial score."""
        query_ids, queries = held.value
        best, least, seen = np.full((n, k), _LEAST), np.full((n, len(cuts)), np.iinfo(np.int64).max), False
        for s in _slices(batches, query_ids, queries, cuts):
            seen = True
            listed = np.zeros(s.total.shape, bool)
            for b, part in enumerate(s.parts):
                least[:, b] = np.minimum(least[:, b], part.min(axis=1))
                ranked = part.copy()
                ranked[s.own] = _LEAST
                m = min(k, part.shape[1])
                np.put_along_axis(listed, np.argpartition(ranked, part.shape[1] - m, axis=1)[:, -m:], True, 1)
            listed[s.own] = False
            scores = np.where(listed, s.total, _LEAST)
            m = min(k, scores.shape[1])
            scores = ~np.partition(~scores, m - 1, axis=1)[:, :m]  # ~ turns the order round, without overflow
            best = np.sort(np.concatenate([best, scores], 1), axis=1)[:, -k:]
        if seen:
            q = np.repeat(np.arange(n), k)
            lists = pa.ListArray.from_arrays(np.arange(0, n * len(cuts) + 1, len(cuts), dtype=np.int32), least.ravel())
            yield pa.record_batch(
                [pa.array(q), pa.array(best.ravel()), lists.take(pa.array(q))], names=["q", "score", "least"]
            )

    lists = materialize(map_arrow(rows, gather, "q long, score long, least array<long>"), "lists")
    order = Window.partitionBy("q").orderBy(F.col("score").desc())
    cutoffs = lists.withColumn("r", F.row_number().over(order)).where(F.col("r") == k)
    least = lists.groupBy("q").agg(*[F.min(F.col("least")[b]).alias(f"b{b}") for b in range(len(cuts))])
    known = cutoffs.select("q", "score").join(least, "q").collect()  # one row a query of this pass
    cutoff, floor = np.full(n, _LEAST), np.zeros((n, len(cuts)), np.int64)
    for r in known:
        cutoff[r["q"]], floor[r["q"]] = r["score"], [r[f"b{b}"] for b in range(len(cuts))]
    safe = spark.sparkContext.broadcast((cutoff, floor))

    def collect(batches: Batches) -> Batches:
        """Entries that can reach the cutoff: one block at least has its share. What remains of them is added up exactly."""
        query_ids, queries = held.value
        cutoff, floor = safe.value
        share = np.where(cutoff == _LEAST, -1.0, (cutoff.astype(float) - floor.sum(1)) / len(cuts))
        best = np.full((n, k), _LEAST), np.full((n, k), np.iinfo(np.int64).max)
        for s in _slices(batches, query_ids, queries, cuts):
            enough = np.zeros(s.total.shape, bool)
            for b, part in enumerate(s.parts):
                enough |= part - floor[:, b : b + 1] >= share[:, None] - 1e-6 * np.abs(share[:, None])
            enough[s.own] = False
            q, c = np.nonzero(enough)
            score, vec = s.total[q, c], s.ids[c]
            keep = score >= cutoff[q]
            q, score, vec = q[keep], score[keep], vec[keep]
            order = np.lexsort((vec, ~score, q))
            q, score, vec = q[order], score[order], vec[order]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            keep = place < k
            fresh = np.full((n, k), _LEAST), np.full((n, k), np.iinfo(np.int64).max)
            fresh[0][q[keep], place[keep]], fresh[1][q[keep], place[keep]] = score[keep], vec[keep]
            best = _best(*(np.concatenate(x, 1) for x in zip(best, fresh)), k)
        full = best[0] > _LEAST
        q, _ = np.nonzero(full)
        yield pa.record_batch(
            [pa.array(query_ids[q]), pa.array(best[1][full]), pa.array(best[0][full])], names=["query_id", "vec_id", "score"]
        )

    return map_arrow(rows, collect, "query_id long, vec_id long, score long")


def exact_top_k(
    df: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    nodes: int = 2,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product for each row whose id divides by ``every``.

    A query's candidates are all rows but those of its own id; ties go to the smaller id, repeated
    rows count each. Vectors are integers floor(scale * x); null ones and those with null or non-finite
    components, and rows with a null id, take no part. Shorter vectors count as filled up with zeros.
    Scores must fit in 63 bits. Fewer candidates than k give fewer rows, an empty table none. Other columns are ignored.

    The blocks of dimensions are the nodes of the threshold algorithm. (1) Every task gathers each
    node's k best partial scores; the k-th best whole score among all lists is a safe cutoff. (2) The cutoff
    goes back to all tasks; partial scores are shifted to be non-negative, so a row that reaches the cutoff
    has, in one node at least, the cutoff's share, and only such entries are collected. (3) Their
    remaining scores are added exactly. Tasks keep k entries a query. Queries are taken in blocks of a
    fixed number of bytes, one pass over the table for each, so that what is broadcast does not grow.
    """
    rows = materialize(integers(df, id_col, vector_col, scale), "vectors")
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    queries = rows.where(F.pmod("id", F.lit(every)) == 0)
    per_pass = max(1, PASS_BYTES // (8 * max(1, dims)))
    n = queries.select("id").distinct().count()
    passes = -(-n // per_pass)
    results = []
    for p in range(passes):
        mine = queries.where(F.pmod(F.xxhash64("id"), F.lit(passes)) == p) if passes > 1 else queries
        found = mine.toArrow()
        order = np.argsort(np.asarray(found.column("id")), kind="stable")
        ids = np.asarray(found.column("id"))[order]
        first = np.append(True, ids[1:] != ids[:-1])
        table = matrix(found.column("v"), dims)[order][first]
        results.append(_pass(rows, ids[first], table, k, nodes))
    if not results:
        empty = "query_id long, rank int, vec_id long, score long"
        return df.sparkSession.createDataFrame([], empty)
    entries = results[0]
    for more in results[1:]:
        entries = entries.unionByName(more)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = entries.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
