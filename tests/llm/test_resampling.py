"""Importance resampling against plain loops."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import CLASHES, docs, odd_rows, prose
from test_texts import odd_texts

from topicwake.llm import resampling
from topicwake.llm.resampling import Shift, features, importance_resample
from topicwake.llm.text import blocks

import pyarrow as pa

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, n=3):
    w = WORD.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def test_shift_gives_the_crc_of_joined_bytes():
    rng = np.random.default_rng(1)
    shift = Shift()
    sizes = [0, 1, 2, 7, 255, 256, 257, 511, 700, 5000, 70_000]
    parts = [(rng.bytes(9), rng.bytes(n)) for n in sizes]
    a, b = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    assert (shift(a, np.array(sizes)) ^ b).tolist() == [zlib.crc32(x + y) for x, y in parts]


@pytest.mark.parametrize("piece", [1 << 20, 40])
def test_features_of_a_block(monkeypatch, piece):
    monkeypatch.setattr(resampling, "PIECE", piece)
    texts = odd_texts(150) + ["a", "", "b c", "É x0 " * 50, "w" * 900 + " v"]
    for lo, hi, data, offsets in blocks(pa.array(texts), 4000):
        found, words = Counter(), Counter()
        for text, crc, fresh in features(data, offsets):
            found.update(zip(text.tolist(), crc.tolist()))
            words.update(fresh.tolist())
        wanted = [grams(t) for t in texts[lo:hi]]
        assert found == Counter((i, zlib.crc32(g.encode())) for i, (_, gs) in enumerate(wanted) for g in gs)
        assert all(words[i] == n for i, (n, _) in enumerate(wanted))


def plain(rows, target, percent=5, min_words=20, buckets=10_000):
    of = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(of, grams(text)[1]))
    for text in target:
        t.update(map(of, grams(text)[1]))
    S, T, out = sum(s.values()), sum(t.values()), []
    for i, text in rows:
        n, gs = grams(text)
        gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(of(g)) for g in gs)
        out.append((i, n, len(gs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    return out, eligible[: percent * len(eligible) // 100]


@pytest.mark.parametrize("percent", [5, 60])
def test_resampling_equals_a_plain_loop(spark, percent):
    rows = odd_rows() + [(100 + i, t) for i, t in enumerate(odd_texts(60, 4)[:60])] + [(300 + i, prose(15 + 7 * i, i)) for i in range(40)]
    bench = [prose(30, 3), None, "", prose(12, 305)]
    target = spark.createDataFrame([(t,) for t in bench], "text string")
    found = importance_resample(docs(spark, rows), target, percent=percent).collect()
    wanted, drawn = plain(rows, bench, percent)
    assert Counter(tuple(r)[:5] for r in found) == Counter(wanted)
    ranked = sorted((r for r in found if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in ranked] == list(range(1, len(drawn) + 1)) and [r.doc_id for r in ranked] == [r[0] for r in drawn]


def test_small_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert importance_resample(docs(spark, []), none).count() == 0
    (row,) = importance_resample(docs(spark, [(1, prose(30, 1))]), none, percent=100).collect()
    assert row["rank"] == 1 and not set(row.asDict()) & (set(CLASHES) - {"rank", "score"})
