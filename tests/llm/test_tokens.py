"""Packing, token files, token counts and exact top-k against the library and brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import docs, odd_rows, prose
from test_texts import odd_texts
from tokenizers import Tokenizer

from topicwake.llm.packing import best_fit, complete_bins, fillings, pack
from topicwake.llm.token_counts import token_counts
from topicwake.llm.token_file import read_token_files, write_token_files
from topicwake.llm.topk import exact_top_k
from topicwake.session import new_table_path


def library(name):
    own = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def rows_of_all_kinds():
    return odd_rows() + [(100 + i, t) for i, t in enumerate(odd_texts(60, 4)[:60])] + [(300 + i, prose(40 + 17 * i, i)) for i in range(40)]


def test_token_counts(spark):
    rows, encode = rows_of_all_kinds(), library("byte_bpe_50k")
    found = token_counts(docs(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).collect()
    wanted = [(i, len((t or "").encode()), len(encode(t)), len(encode(t)) > 1024) for i, t in rows]
    assert Counter(tuple(r) for r in found) == Counter(wanted)
    assert token_counts(docs(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("files", [1, 5])
def test_token_files(spark, files):
    rows, encode = rows_of_all_kinds(), library("word_bpe_49k")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = write_token_files(docs(spark, rows), path, 1, new_table_path(spark, "ids"), files=files)
    found = read_token_files(manifest).collect()
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(encode(t) + [1])
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter((i, len(x), crc(x)) for i, xs in ids.items() for x in xs)
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0] + [r.n_tokens for r in ordered])[:-1].tolist()
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    assert read_token_files(write_token_files(docs(spark, []), path, 1, new_table_path(spark, "ids"), files=2)).count() == 0


def check_plan(counts, plan, capacity):
    used = Counter()
    for items, number in plan:
        assert sum(items) <= capacity and number > 0
        for x in items:
            used[x] += number
    assert used == Counter({k: n for k, n in counts.items() if n})
    return sum(n for _, n in plan)


def fewest_bins(items, capacity):
    best = len(items)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(items):
            best = len(bins)
            return
        for i, b in enumerate(bins):
            if b + items[k] <= capacity and b not in bins[:i]:
                place(k + 1, [*bins[:i], b + items[k], *bins[i + 1 :]])
        place(k + 1, [*bins, items[k]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_sets():
    rng = random.Random(8)
    for _ in range(60):
        capacity = rng.choice([10, 20, 50])
        items = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = Counter(items)
        assert check_plan(counts, complete_bins(dict(counts), capacity, width=16, effort=5000), capacity) == fewest_bins(items, capacity)


def test_bin_completion_beats_or_equals_best_fit():
    for seed in range(6):
        rng = random.Random(seed)
        counts = Counter(rng.randint(1, 1023) if seed % 2 else rng.randint(100, 512) for _ in range(800))
        plain = best_fit(dict(counts), 1024)
        check_plan(counts, plain, 1024)
        found = check_plan(counts, complete_bins(dict(counts), 1024, nodes=800), 1024)
        assert -(-sum(k * n for k, n in counts.items()) // 1024) <= found <= sum(n for _, n in plain)
    assert complete_bins({}, 10) == []
    assert fillings(7, {5: 1, 4: 1, 3: 1, 2: 1}, 10, 2, 100)[0] in [(5, 2), (4, 3)]


def test_pack(spark):
    rows, encode = rows_of_all_kinds(), library("byte_bpe_50k")
    found = pack(docs(spark, rows), public_tokenizers.path("byte_bpe_50k.json"), 2).collect()
    wanted = Counter()
    for i, t in rows:
        ids = encode(t) + [2]
        first = (len(ids) - 1) % 1024 + 1
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            wanted[(i, k, a, b - a, crc(ids[a:b]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [p for p, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist()
        assert sum(n for _, n in places) <= 1024
    assert len(sequences) <= -(-sum(r.length for r in found) // 1024) + 2
    assert pack(docs(spark, []), public_tokenizers.path("byte_bpe_50k.json"), 2).count() == 0


@pytest.mark.parametrize("nodes", [1, 2, 5])
def test_exact_top_k(spark, nodes):
    rng = np.random.default_rng(9)
    vectors = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(400)]
    vectors += [(500 + i, vectors[3][1]) for i in range(30)] + [(60, vectors[60][1])]
    odd = [(1000, None), (1050, [1.0, None] + [0.0] * 6), (1100, [float("nan")] * 8), (1150, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (1200, []), (1201, [2.0, -3.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in vectors + odd], "vec_id long, embedding array<float>, score string")
    found = exact_top_k(table.repartition(4), nodes=nodes).collect()
    whole = [(i, np.floor(256 * np.pad(np.array(v, np.float32).astype(float), (0, 8 - len(v)))).astype(int)) for i, v in vectors + odd[-2:]]
    wanted = []
    for q in sorted({i for i, _ in whole if i % 50 == 0}):
        mine = next(v for i, v in whole if i == q)
        best = sorted((-int(mine @ v), i) for i, v in whole if i != q)[:5]
        wanted += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in found) == wanted


def test_top_k_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert exact_top_k(spark.createDataFrame([], schema)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (7, [2.0])], schema)
    assert [tuple(r) for r in exact_top_k(few).collect()] == [(0, 1, 7, 131072)]
    assert exact_top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
