"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.features import bounded_sample, collect_rows, fold, score_texts, stems, sums, words

VIEWS, BITS = (words, stems), 18


def evidence(labels: np.ndarray, bounds: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """log of the smoothed share of each indicator among positives over that among unlabelled rows; 0 if weak or rare."""
    per_item = np.repeat(labels, np.diff(bounds))
    ones, others = max(int((labels == 1).sum()), 1), max(int((labels == 0).sum()), 1)
    one = np.bincount(index[per_item == 1], minlength=size)
    other = np.bincount(index[per_item == 0], minlength=size)
    ratio = np.log(((one + 1) / (ones + 2)) / ((other + 1) / (others + 2)))
    error = np.sqrt(1 / (one + 1) + 1 / (other + 1))
    return np.where((np.abs(ratio) > 3.2 * error) & (one + other >= 4), ratio, 0.0)


def fit_pu(
    labels: np.ndarray,
    bounds: np.ndarray,
    index: np.ndarray,
    prior: float,
    size: int,
    epochs: int = 30,
    batch: int = 256,
    rate: float = 0.05,
    decay: float = 1e-3,
    seed: int = 0,
) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model from positives (label 1) and unlabelled rows (label 0).

    The risk is prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]). When a batch's second part is
    negative, which only overfitting makes it, the step goes up that part instead of down the whole.
    """
    weights, bias = np.zeros(size), float(np.log(prior / (1 - prior)))
    values = evidence(labels, bounds, index, size)
    told = values[index] != 0  # only what differs between the two kinds of rows is learned from
    inside = np.append(0, np.cumsum(told))
    bounds, index = inside[bounds], index[told]
    positive, unlabelled = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(positive) or not len(unlabelled):
        return weights, bias
    random = np.random.default_rng(seed)
    first, second, scale = np.zeros(size), np.zeros(size), 0
    counts = np.diff(bounds)

    def part(chosen):
        at = np.repeat(bounds[chosen] - np.cumsum(counts[chosen]) + counts[chosen], counts[chosen])
        columns = index[at + np.arange(len(at))]
        inner = np.append(0, np.cumsum(counts[chosen]))
        return columns, inner, 1 / (1 + np.exp(-np.clip(sums(inner, (weights * values)[columns]) + bias, -30, 30)))

    steps = max(1, -(-len(unlabelled) // batch))
    for _ in range(epochs):
        order = random.permutation(unlabelled)
        for k in range(steps):
            u = order[k * batch : (k + 1) * batch]
            p = random.choice(positive, min(batch, len(positive)), replace=False)
            pc, pb, ps = part(p)
            uc, ub, us = part(u)
            negative = -np.log(np.maximum(1 - us, 1e-12)).mean() + prior * np.log(np.maximum(1 - ps, 1e-12)).mean()
            if negative >= 0:
                gp, gu = prior * (ps - 1) / len(p) - prior * ps / len(p), us / len(u)
            else:
                gp, gu = prior * ps / len(p), -us / len(u)
            columns = np.concatenate([pc, uc])
            grads = np.concatenate([np.repeat(gp, np.diff(pb)), np.repeat(gu, np.diff(ub))])
            gradient = np.bincount(columns, grads, minlength=size) * values + decay * weights
            scale += 1
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient**2 - second)
            weights -= rate * (first / (1 - 0.9**scale)) / (np.sqrt(second / (1 - 0.999**scale)) + 1e-8)
            bias -= rate * (gp.sum() + gu.sum())
    return weights * values, bias


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    folds: int = 5,
    held: int = 0,
    positives: int = 5_000,
    unlabelled: int = 10_000,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted) of each row of ``df``.

    Learns from ids whose crc32 modulo ``folds`` is not ``held``: at most ``positives`` texts marked 1, and
    ``unlabelled`` texts of any kind whose labels are not looked at, both chosen by the hash of the id;
    the share of 1 among all such labels is the class prior. Every text is scored whole. A null or
    empty text scores the bias alone. Repeated rows and ids are scored each; an id marked both ways counts
    as 1; null labels and ids teach nothing, a null id is not held out. Without a positive every score is the
    prior, which is 0.01 without labels. An empty table gives no rows; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    taught = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, folds) != held))
    taught = taught.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).alias("label"))
    share = taught.agg(F.avg(F.col("label").cast("double"))).first()[0]
    prior = min(max(share if share is not None else 0.01, 1e-3), 0.5)
    known = docs.where(F.col("id").isNotNull() & (fold("id", folds) != held))
    marked = bounded_sample(taught.where("label = 1").select("id"), "id", positives).withColumn("label", F.lit(1))
    others = bounded_sample(known.select("id"), "id", unlabelled, 1).withColumn("label", F.lit(0))
    sample = known.join(F.broadcast(marked.unionByName(others)), "id")  # at most positives + unlabelled short rows
    target, bounds, index = collect_rows(sample, VIEWS, BITS)
    weights, bias = fit_pu(target, bounds, index, prior, 1 << BITS)
    scored = score_texts(docs, VIEWS, BITS, weights, False, bias)
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id", folds) == held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
