"""Quality scores by naive Bayes support vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicwake.llm.features import bounded_sample, byte_runs, collect_rows, fold, score_texts, shapes, sums, words

VIEWS, BITS = (words, byte_runs, shapes), 18


def log_count_ratio(target: np.ndarray, bounds: np.ndarray, index: np.ndarray, size: int) -> np.ndarray:
    """log of the smoothed share of each indicator among the texts of class 1 over that of class 0."""
    per_item = np.repeat(target, np.diff(bounds))
    one = 1 + np.bincount(index[per_item == 1], minlength=size)
    zero = 1 + np.bincount(index[per_item == 0], minlength=size)
    return np.log(one / one.sum()) - np.log(zero / zero.sum())


def dual_coordinate_descent(
    target: np.ndarray, bounds: np.ndarray, index: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear model with squared hinge loss and a cost for each row.

    Each step solves for one row's dual variable exactly while the others stand still; rows whose
    variable stays at 0 for no gain are skipped until the next full round, every third one.
    """
    weights, bias = np.zeros(len(scale)), 0.0
    sign = np.where(target == 1, 1.0, -1.0)
    norm = np.sqrt(np.maximum(np.diff(bounds), 1))
    alpha = np.zeros(len(target))
    diagonal = 0.5 / cost
    values = scale[index] / np.repeat(norm, np.diff(bounds))
    square = sums(bounds, values**2) + 1 + diagonal
    random = np.random.default_rng(seed)
    for epoch in range(epochs):
        if epoch % 3 == 0:
            active = np.arange(len(target))
        moved = np.zeros(len(target), bool)
        for i in random.permutation(active).tolist():
            row = slice(bounds[i], bounds[i + 1])
            columns, value = index[row], values[row]
            gradient = sign[i] * (weights[columns] @ value + bias) - 1 + diagonal[i] * alpha[i]
            if alpha[i] == 0 and gradient >= 0:
                continue
            new = max(alpha[i] - gradient / square[i], 0.0)
            step = (new - alpha[i]) * sign[i]
            moved[i] = True
            if step:
                alpha[i] = new
                weights[columns] += step * value
                bias += step
        active = active[moved[active]]
    return weights * scale, bias


def calibrate(margin: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins of rows the model has not seen (Newton steps)."""
    a, b = 1.0, 0.0
    if not len(margin) or target.min() == target.max():
        return a, b
    one = target.sum()
    goal = np.where(target == 1, (one + 1) / (one + 2), 1 / (len(target) - one + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, h = p - goal, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(d * margin).sum(), d.sum()])
        m = np.array([[(h * margin**2).sum() + 1e-3, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(m, g), -2, 2)
    return float(a), float(b)


def fit_nbsvm(target: np.ndarray, bounds: np.ndarray, index: np.ndarray, size: int) -> tuple[np.ndarray, float, float]:
    """(weights, slope, offset): a fifth of the rows is kept back to calibrate."""
    if not len(target) or target.min() == target.max():
        share = (target.sum() + 1) / (len(target) + 2)
        return np.zeros(size), 1.0, float(np.log(share / (1 - share)))
    back = np.arange(len(target)) % 5 == 4
    fit = np.flatnonzero(~back) if len(np.unique(target[~back])) == 2 else np.arange(len(target))
    counts = np.diff(bounds)
    inner = np.append(0, np.cumsum(counts[fit]))
    keep = np.zeros(len(target), bool)
    keep[fit] = True
    items = index[np.repeat(keep, counts)]
    scale = log_count_ratio(target[fit], inner, items, size)
    rare = target[fit].mean()
    cost = np.where(target[fit] == 1, 0.5 / max(rare, 1e-6), 0.5 / max(1 - rare, 1e-6))
    weights, bias = dual_coordinate_descent(target[fit], inner, items, scale, cost)
    margin = sums(bounds, weights[index]) / np.sqrt(np.maximum(counts, 1)) + bias
    slope, offset = calibrate(margin[back], target[back])
    return weights, slope, slope * bias + offset


def quality(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    folds: int = 4,
    held: int = 2,
    sample: int = 12_000,
    threshold: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, held_out, score, predicted) of each row of ``df``.

    Learns from labels of ids whose crc32 modulo ``folds`` is not ``held``, at most ``sample`` of them, chosen by
    the hash of the id. Every text is scored whole. A null or empty text scores its shapes alone.
    Repeated rows and ids are scored each; an id marked both ways counts as 1; null labels and ids teach nothing, a
    null id is not held out. With labels of one kind only every score is their smoothed share. An empty table gives no rows;
    other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    taught = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col, folds) != held))
    taught = taught.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = F.broadcast(bounded_sample(taught, "id", sample))  # at most ``sample`` short rows
    weights, slope, offset = fit_nbsvm(*collect_rows(docs.join(chosen, "id"), VIEWS, BITS), 1 << BITS)
    scored = score_texts(docs, VIEWS, BITS, weights, True, offset, slope)
    return scored.select(
        F.col("id").alias(id_col),
        F.coalesce(fold("id", folds) == held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
