"""Toxicity, quality and benchmark passages: held-out accuracy and planted cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from cases import CLASHES, docs, odd_rows, prose

from topicwake.llm.alignment import best_prefixes, edit_distances, find_within, pad
from topicwake.llm.decontaminate import Benchmark, Sequences, benchmark_passages, candidates, verify
from topicwake.llm.quality import dual_coordinate_descent, quality
from topicwake.llm.text import PUNCT, Words, blocks
from topicwake.llm.toxicity import fit_pu, toxicity


def labelled(spark, rows):
    extra = ", ".join(f"`{c}` string" for c in CLASHES if c != "label")
    full = [(*r, *([None] * (len(CLASHES) - 1))) for r in rows]
    return spark.createDataFrame(full, f"doc_id long, quality int, toxic int, {extra}")


def crc(i, n):
    return zlib.crc32(str(i).encode()) % n


def test_toxicity(spark):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(600):
        words, bad = prose(80, 1000 + i).split(), i % 8 == 0
        for _ in range(4 if bad else 0):
            words.insert(rng.randint(0, len(words)), rng.choice(["scumbag", "idiotic", "worthless", "filth"]) + rng.choice(["", "!", "s"]))
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(bad)))
    marks += [(None, 1, 1), (5, None, None), (3, 0, 0), (10_000, 1, 1)]
    odd = [(10_000 + k, t) for k, (_, t) in enumerate(odd_rows())] + [(None, None), (0, rows[0][1])]
    found = toxicity(docs(spark, rows + odd), labelled(spark, marks)).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert all(r.held_out == (r.doc_id is not None and crc(r.doc_id, 5) == 0) for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 600]
    assert len(held) > 80 and all(r.predicted == (r.doc_id % 8 == 0) for r in held)


def test_toxicity_without_labels_or_rows(spark):
    none = labelled(spark, [])
    assert [r.score for r in toxicity(docs(spark, odd_rows()[:5]), none).collect()] == pytest.approx([0.01] * 5)
    assert toxicity(docs(spark, []), none).count() == 0


def test_labels_of_the_held_fold_are_not_learned_from(spark):
    rows = [(i, prose(40, i)) for i in range(120)]
    marks = [(i, 1, int(i % 6 == 0)) for i in range(120)]
    other = [(i, q, 1 - t if crc(i, 5) == 0 else t) for i, q, t in marks]
    score = lambda m: {r.doc_id: r.score for r in toxicity(docs(spark, rows), labelled(spark, m)).collect()}
    assert score(marks) == score(other)


def test_pu_risk_corrects_for_the_prior():
    """Unlabelled rows are a mixture; the fitted scores still tell the classes apart."""
    rng = np.random.default_rng(0)
    kind = np.concatenate([np.ones(200, int), (rng.random(800) < 0.2).astype(int)])
    index = np.concatenate([np.where(rng.random(5) < 0.9, rng.integers(0, 20, 5) + 20 * k, rng.integers(0, 40, 5)) for k in kind])
    bounds = np.arange(0, 5 * len(kind) + 1, 5)
    labels = np.concatenate([np.ones(200, int), np.zeros(800, int)])
    weights, bias = fit_pu(labels, bounds, index, 0.2, 64)
    score = weights[index].reshape(-1, 5).sum(1) + bias
    assert ((score > 0) == (kind == 1))[200:].mean() > 0.95


def test_quality(spark):
    rows, marks = [], []
    for i in range(500):
        text = prose(60, 5000 + i).capitalize() + "."
        bad = i % 5 == 0
        junk = [text.upper().replace(" ", "!! "), " ".join(w for w in text.split()[:12] for _ in range(5)), text.replace(" ", " | ")]
        rows.append((i, junk[i % 3] if bad else text))
        marks.append((i, int(not bad), 0))
    marks += [(None, 1, 1), (7, None, None), (9_999, 1, 0)]
    odd = [(20_000 + k, t) for k, (_, t) in enumerate(odd_rows())] + [(None, "text")]
    found = quality(docs(spark, rows + odd), labelled(spark, marks)).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    held = [r for r in found if r.held_out and r.doc_id < 500]
    right = [r.predicted == (r.doc_id % 5 != 0) for r in held]
    assert len(held) > 80 and np.mean(right) > 0.97
    assert quality(docs(spark, []), labelled(spark, [])).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    """The gap between primal and dual objective closes."""
    rng = np.random.default_rng(2)
    n, size = 80, 30
    bounds, index = np.arange(0, 4 * n + 1, 4), np.concatenate([rng.choice(size, 4, replace=False) for _ in range(n)])
    target = (np.bincount(np.repeat(np.arange(n), 4), index < 15) + rng.normal(0, 0.5, n) > 2).astype(int)
    cost = np.full(n, 0.5)
    weights, bias = dual_coordinate_descent(target, bounds, index, np.ones(size), cost, epochs=400)

    def primal(w, b):
        margin = np.where(target == 1, 1, -1) * (w[index].reshape(n, 4).sum(1) / 2 + b)
        return 0.5 * (w @ w + b * b) + (cost * np.maximum(0, 1 - margin) ** 2).sum()

    base = primal(weights, bias)
    for _ in range(200):
        assert primal(weights + rng.normal(0, 0.01, size), bias + rng.normal(0, 0.01)) >= base - 1e-3


def plain_distance(a, b, free):
    row = [0 if free else j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row) if free else row[-1]


def test_edit_tables_against_plain_loops():
    rng = np.random.default_rng(6)
    left = [rng.integers(2, 6, rng.integers(1, 9)).astype(np.uint64) for _ in range(60)]
    right = [rng.integers(2, 6, rng.integers(0, 14)).astype(np.uint64) for _ in range(60)]
    table = lambda xs, fill: (
        pad(np.concatenate(xs), np.cumsum([0] + [len(x) for x in xs[:-1]]), np.array([len(x) for x in xs]), fill),
        np.array([len(x) for x in xs]),
    )
    a, n = table(left, 0)
    b, m = table(right, 1)
    assert edit_distances(a, n, b, m).tolist() == [plain_distance(x, y, False) for x, y in zip(left, right)]
    best, start, end = find_within(a, n, b, m)
    assert best.tolist() == [plain_distance(x, y, True) for x, y in zip(left, right)]
    assert all(plain_distance(x, y[s:e], False) == k for x, y, s, e, k in zip(left, right, start, end, best))
    length, edits = best_prefixes(a, n, b, m)
    for x, y, size, wrong in zip(left, right, length, edits):
        each = [i - 3 * min(plain_distance(x[:i], y[:j], False) for j in range(len(y) + 1)) for i in range(len(x) + 1)]
        assert size - 3 * wrong == max(each)


def test_recall_of_edited_items():
    rng = random.Random(3)
    items = [prose(rng.randint(12, 60), 300 + i) for i in range(150)]
    benchmark = Benchmark(pa.array(range(150)), pa.array(items), 0.2)
    for rate, least in ((0, 1.0), (0.1, 0.95), (0.2, 0.9)):
        texts = []
        for i, item in enumerate(items):
            words = item.split()
            for _ in range(int(rate * len(words))):
                at, what = rng.randrange(len(words)), rng.random()
                if what < 0.34:
                    words[at] = "zz" + str(at)
                elif what < 0.67:
                    words.insert(at, "yy" + str(at))
                elif len(words) > 1:
                    del words[at]
            texts.append(f"{prose(rng.randint(0, 90), 900 + i)} {' '.join(words)} {prose(20, 1300 + i)}")
        hits = 0
        for lo, hi, data, offsets in blocks(pa.array(texts)):
            own = Sequences(Words(data, offsets, PUNCT))
            found = verify(benchmark, own, *candidates(benchmark, own))
            pairs = set(zip((found[0] + lo).tolist(), found[1].tolist()))
            hits += sum((i, i) in pairs for i in range(lo, hi))
        assert hits / len(items) >= least


def test_benchmark_passages(spark):
    items = [(1, prose(30, 501)), (2, prose(18, 502)), (2, prose(18, 502)), (3, None), (4, ""), (5, "one"), (None, prose(25, 503))]
    rows = [
        (1, f"{prose(50, 601)} {items[0][1].upper().replace(' ', ', ')}! {prose(50, 602)}"),
        (2, f"é {items[1][1]}"),
        (3, f"{' '.join(items[0][1].split()[:12])} {prose(50, 603)}"),
        (None, items[6][1]),
        (5, "number one"),
    ] + odd_rows()
    table = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, id string")
    found = benchmark_passages(docs(spark, rows), table).collect()
    pairs = sorted(((r.doc_id, r.item_id, r.edits) for r in found), key=str)
    assert pairs == sorted([(1, 1, 0), (2, 2, 0), (2, 2, 0), (None, None, 0), (5, 5, 0)], key=str)
    one = next(r for r in found if r.doc_id == 1)
    passage = rows[0][1].encode()[one.start_byte : one.end_byte].decode()
    assert passage.lower().replace(",", "") == items[0][1]
    assert benchmark_passages(docs(spark, []), table).count() == 0
    assert benchmark_passages(docs(spark, rows), table.limit(0)).count() == 0
