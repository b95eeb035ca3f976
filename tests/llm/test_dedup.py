"""Exact, fuzzy and near-duplicate removal against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import docs, odd_rows, prose

from topicwake.llm import minhash, substring_dedup as fuzzy, suffix_dedup
from topicwake.llm.chaining import BREAK, GAP, SEED, chains
from topicwake.llm.components import components, forest
from topicwake.llm.jobs import map_arrow
from topicwake.llm.minhash import near_duplicates, similar_pairs
from topicwake.llm.substring_dedup import close_enough, substring_dedup
from topicwake.llm.suffix_dedup import suffix_array_dedup
from topicwake.llm.suffixes import join, share_with_neighbour, sort_suffixes
from topicwake.llm.superminhash import signatures
from topicwake.session import materialize


def test_suffix_order_against_sorting():
    rng = random.Random(2)
    for _ in range(60):
        depth, letters = rng.choice([8, 12, 20, 200]), rng.choice([b"ab", b"abc", b"a", bytes(range(97, 123))])
        base = [bytes(rng.choice(letters) for _ in range(rng.randint(0, depth * 3))) for _ in range(3)]
        pieces = [rng.choice(base)[rng.randint(0, 9) :] + bytes(rng.choice(letters) for _ in range(rng.randint(0, 9))) for _ in range(6)]
        sizes = np.array([len(p) for p in pieces])
        symbols, starts = join(np.frombuffer(b"".join(pieces), np.uint8), sizes, depth)
        wanted = np.zeros(len(symbols), bool)
        for s, n in zip(starts, sizes):
            if n >= depth:
                wanted[s + rng.randint(0, n - depth) : s + n - depth + 1] = True
        order = sort_suffixes(symbols, wanted, depth)
        keys = [symbols[i : i + depth].tobytes() for i in order]
        assert sorted(order) == np.flatnonzero(wanted).tolist() and keys == sorted(keys)
        count = Counter(keys)
        assert share_with_neighbour(symbols, order, depth).tolist() == [count[k] > 1 for k in keys]


def brute_spans(rows, depth):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + depth] for t in texts for i in range(len(t) - depth + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - depth + 1):
            if count[t[i : i + depth]] > 1:
                cover[i : i + depth] = True
        edge = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]])))
        out.append((list(zip(edge[::2].tolist(), edge[1::2].tolist())), bytes(b for b, c in zip(t, cover) if not c)))
    return out


@pytest.mark.parametrize("group", [1000, 2])
def test_suffix_dedup(spark, monkeypatch, group):
    """Also with groups so small that every anchor's contexts are halved again and again."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    passage, line = prose(60, 5), prose(9, 6)
    rows = [r for r in odd_rows() if r[0] not in (8, 9)]
    rows += [(20 + i, f"{prose(30, 30 + i)} {line} {prose(20, 60 + i)} {passage} {prose(25, 90 + i)}") for i in range(12)]
    rows += [(50, "ab" * 400), (51, prose(40, 7) + passage[40:260] + "é" * 130)]
    found = suffix_array_dedup(docs(spark, rows), depth=100).collect()
    wanted = Counter((i, str(s), k) for (i, _), (s, k) in zip(rows, brute_spans(rows, 100)))
    assert Counter((r.doc_id, str([(s.start, s.end) for s in r.spans]), bytes(r.kept)) for r in found) == wanted


def test_suffix_dedup_of_nothing(spark):
    assert suffix_array_dedup(docs(spark, []), depth=100).count() == 0


def chain_score(x, y):
    """Best score by trying every predecessor."""
    order = sorted(range(len(x)), key=lambda i: (x[i], y[i]))
    best = {}
    for i in order:
        before = [
            best[j] - GAP * (x[i] - x[j] + y[i] - y[j])
            for j in best
            if x[j] < x[i] and y[j] < y[i] and x[i] - x[j] <= BREAK and y[i] - y[j] <= BREAK
        ]
        best[i] = SEED + max(0, *before, 0)
    return max(best.values())


def test_chains_against_all_predecessors():
    rng = np.random.default_rng(4)
    for _ in range(40):
        n = int(rng.integers(2, 40))
        x, y = rng.integers(0, 100, n), rng.integers(0, 100, n)
        found = chains(x, y)
        assert all((np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all() for c in found)
        assert len({i for c in found for i in c}) == sum(map(len, found))
        if found:
            c = found[0]
            score = SEED * len(c) - GAP * (np.diff(x[c]).sum() + np.diff(y[c]).sum())
            assert score == pytest.approx(chain_score(x.tolist(), y.tolist()))


def test_chains_of_two_passages():
    """A long chain's far end does not hide the neighbours of the matches after a gap, however far in either text."""
    for gap_x, gap_y in ((194, 194), (194, 10), (10, 194), (700, 5)):
        x = np.concatenate([np.arange(0, 186, 6), 186 + gap_x + np.arange(0, 90, 6)])
        y = np.concatenate([np.arange(0, 186, 6), 186 + gap_y + np.arange(0, 90, 6)])
        assert [c.tolist() for c in chains(x, y)] == [list(range(31)), list(range(31, 46))]
    rng = np.random.default_rng(6)
    for _ in range(40):
        x, y = rng.integers(0, 700, 120), rng.integers(0, 700, 120)
        x[:60] = y[:60] = np.arange(0, 360, 6)
        c = chains(x, y)[0]
        score = SEED * len(c) - GAP * (np.diff(x[c]).sum() + np.diff(y[c]).sum())
        assert score == pytest.approx(chain_score(x.tolist(), y.tolist()))


def edited(text, every, seed):
    words, rng = text.split(), random.Random(seed)
    for i in range(every, len(words), every):
        words[i] = "zz" + str(rng.randint(0, 999))
    return " ".join(words)


def test_substring_dedup(spark):
    passage = prose(80, 11)
    rows = [
        (1, f"{prose(70, 12)} {passage} {prose(50, 13)}"),
        (2, f"{prose(60, 14)} {passage} {prose(40, 15)}"),
        (3, f"{prose(60, 16)} {edited(passage, 15, 1)} {prose(40, 17)}"),
        (4, f"{prose(60, 18)} {' '.join(passage.split()[:30])} {prose(40, 19)}"),
        (5, prose(400, 20)),
        (6, f"{passage}. {passage}"),
    ]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    assert not found[1].spans and not found[4].spans and not found[5].spans and found[5].kept == rows[4][1]
    for i in (2, 3):
        (span,) = found[i].spans
        raw = rows[i - 1][1].encode()
        cut = raw[span.start : span.end].decode().split()
        assert 76 <= len(cut) <= 84 and found[i].kept.encode() == raw[: span.start] + raw[span.end :]
    assert len(found[6].kept.split()) <= 90


def words_left(row):
    return row.kept.split()


def test_substring_dedup_of_two_passages(spark):
    """Two passages of the same two documents, 200 words of their own apart."""
    one, two = prose(186, 21), prose(120, 22)
    rows = [(1, f"{one} {prose(200, 23)} {two}"), (2, f"{one} {prose(200, 24)} {two}")]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    assert not found[1].spans and len(found[2].spans) == 2 and 196 <= len(words_left(found[2])) <= 204


def test_close_enough_against_all_stretches():
    """The stretches found cover just the words that any stretch within the limit covers."""
    rng = random.Random(8)
    for _ in range(200):
        pieces, at = [], rng.randint(0, 5)
        for _ in range(rng.randint(1, 12)):
            n = rng.randint(0, 9)
            pieces.append((at, at + n, rng.choice([0, 0, rng.randint(0, max(n, 1))])))
            at += n
        wanted = set()
        places = sorted({w for lo, hi, e in pieces for w in ([lo, hi] if e else range(lo, hi + 1))})
        for a in places:
            for b in places:
                # edits of the pieces that [a, b) holds; those at its very ends are left out
                wrong = sum(e for lo, hi, e in pieces if e and a <= lo and hi <= b and (lo < hi or a < lo < b))
                if b - a >= 10 and wrong <= 0.2 * (b - a) + 1e-9:
                    wanted.update(range(a, b))
        found = close_enough(pieces, 10, 0.2)
        assert {w for a, b, _ in found for w in range(a, b)} == wanted
        assert all(b - a >= 10 and wrong <= 0.2 * (b - a) + 1e-9 for a, b, wrong in found)


def test_substring_dedup_of_a_loose_neighbour(spark):
    """60 exact words are cut although over a fifth of the many words that follow them are edited."""
    rows = []
    for i, (period, first, words) in enumerate(((18, 8, 320), (20, 10, 640))):
        exact, loose = prose(60, (1009, 1015)[i]), prose(words, (2009, 2015)[i]).split()
        other = [f"zz{k}" if k % period in range(first, period, 2) else w for k, w in enumerate(loose)]
        rows += [(2 * i, f"{exact} {' '.join(loose)}"), (2 * i + 1, f"{exact} {' '.join(other)}")]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    for i in (0, 2):
        assert not found[i].spans
        assert found[i + 1].spans[0].start == 0 and found[i + 1].spans[0].end >= len(" ".join(rows[i][1].split()[:60]))


def test_substring_dedup_of_copies(spark):
    """A later document loses every copy of a passage, also where it holds more of them than the first holder."""
    passage, other = prose(80, 27), prose(70, 28)
    rows = [
        (1, f"{prose(70, 29)} {passage} {prose(50, 30)}"),
        (2, " ".join([passage, prose(30, 31)] * 5)),
        (3, f"{passage}. {passage}"),
        (4, f"{other} {prose(60, 32)} {other}"),
        (5, f"{other} {prose(20, 33)} {other} {prose(25, 34)} {other}"),
        (6, "yes " * 60),
        (7, "yes " * 1000),
    ]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    assert not any(found[i].spans for i in (1, 4, 6))
    assert [len(found[i].spans) for i in (2, 3, 5)] == [5, 1, 3]
    assert 140 <= len(words_left(found[2])) <= 160 and not words_left(found[3]) and 40 <= len(words_left(found[5])) <= 50
    assert len(words_left(found[7])) < 50


def test_substring_dedup_of_pieces_held_elsewhere(spark):
    """A passage is found though each part of it was seen first in another document, word for word or edited."""
    rows, wanted = [], {}
    for i in range(12):
        words, edit = prose(90, 300 + i).split(), i % 2
        later = edited(" ".join(words), 30, i) if edit else " ".join(words)
        at = 10 * i
        rows += [(at, f"{' '.join(words[:48])} {prose(20, 320 + i)}"), (at + 1, f"{prose(20, 340 + i)} {' '.join(words[42:])}")]
        rows += [(at + 2, f"{' '.join(words)} {prose(20, 360 + i)}"), (at + 3, f"{prose(20, 380 + i)} {later}")]
        wanted[at + 3] = 20
    pieces = prose(50, 400).split()
    rows += [(1000, " ".join(pieces[:49])), (1001, " ".join(pieces[1:])), (1002, " ".join(pieces)), (1003, " ".join(pieces))]
    rows += [(1004, "yes " * 60), (1005, "yes " * 1000)]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    left = {i: len(words_left(found[i])) for i in wanted}
    assert all(n <= wanted[i] + 4 for i, n in left.items()), left
    assert not words_left(found[1003]) and not words_left(found[1005])


def test_substring_dedup_of_seeds_held_elsewhere(spark):
    """An edited passage is found though every seed that is left of it was seen first in a document of its own, which has no more of it."""
    rows, edits = [], {}
    for i in range(6):
        words, at = prose(84, 800 + i).split(), 100 * i
        runs = [words[k + 1 : k + 7] for k in range(0, 84, 7)]
        rows += [(at + k, f"{prose(20, 900 + at + k)} {' '.join(run)} {prose(20, 1900 + at + k)}") for k, run in enumerate(runs)]
        later = [f"zz{k}" if k % 7 == 0 else w for k, w in enumerate(words)]
        rows += [(at + 50, f"{prose(30, 2900 + i)} {' '.join(words)}"), (at + 51, f"{' '.join(later)} {prose(30, 3900 + i)}")]
        edits[at + 51] = len(words)
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    assert all(r.n_words - len(words_left(r)) >= edits.get(i, 0) - 3 for i, r in found.items()), {i: len(words_left(found[i])) for i in edits}
    assert not any(r.spans for i, r in found.items() if i not in edits)


def test_partners_are_all_earlier_holders(spark):
    """Pairs of seeds lead to every earlier document with other words between them; one run of words, distances too far apart, and texts cut already do not."""
    seed = {name: 1000 + k for k, name in enumerate("abc")}

    def rows(pid, *seeds):
        return [(pid, seed[s], (place << 32) | (between << 1) | (k & 1)) for k, (s, place, between) in enumerate(seeds)]

    held = rows(1, ("a", 5, 11), ("b", 30, 12)) + rows(2, ("a", 50, 21), ("b", 76, 22)) + rows(3, ("a", 0, 31), ("b", 100, 32))
    held += rows(4, ("a", 7, 41), ("b", 33, 42), ("c", 34, 43)) + rows(5, ("b", 90, 42), ("c", 91, 53)) + rows(6, ("a", 5, 61), ("b", 30, 62))
    found = spark.createDataFrame(held, "pid long, holders long, at long")
    counts = spark.createDataFrame([(i, 120) for i in range(1, 7)], "pid long, n long")
    covered = spark.createDataFrame([(6, 0, 1 << 30)], "pid long, lo long, hi long")
    pairs = fuzzy._pair_rows(found, covered, counts, 4)
    assert sorted(map(tuple, fuzzy._partners(pairs, 4, 10.0).collect())) == [(2, 1), (4, 1), (4, 2)]


def test_substring_dedup_recall(spark):
    """Passages of 60 and 100 words with 0.05, 0.1 and 0.2 edits a word, evenly spread and at random."""
    rows, plan = [], {}
    for size in (60, 100):
        for every in (20, 10, 5):
            for even in (True, False):
                for _ in range(60):
                    i = len(rows)
                    words, rng = prose(size, 5000 + i).split(), random.Random(i)
                    other = list(words)
                    for k in range(every // 2, size, every) if even else rng.sample(range(size), size // every):
                        other[k] = f"zz{rng.randint(0, 9999)}"
                    for j, held in ((i, words), (i + 1, other)):
                        rows.append((j, f"{prose(30, 20_000 + j)} {' '.join(held)} {prose(30, 30_000 + j)}"))
                    plan[i + 1] = (size, every, even)
    hits = Counter()
    for r in substring_dedup(docs(spark, rows)).collect():
        if r.doc_id in plan:
            hits[plan[r.doc_id]] += r.n_words - len(words_left(r)) >= 0.7 * plan[r.doc_id][0]
        else:
            assert not r.spans
    recall = {k: hits[k] / 60 for k in sorted(set(plan.values()))}
    assert min(recall.values()) >= 0.95, recall


def test_substring_dedup_writes_shared_seeds_only(spark, monkeypatch):
    """Copies of whole texts write no seeds, and a seed that one text holds is not written; edited passages are found all the same."""
    sizes = {}

    def record(df, name):
        table = materialize(df, name)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(fuzzy, "materialize", record)
    text, short, passage = prose(400, 700), prose(20, 701), prose(80, 702)
    rows = [(i, text) for i in range(10)] + [(20 + i, short) for i in range(3)] + [(30 + i, prose(300, 710 + i)) for i in range(5)]
    found = {r.doc_id: r for r in substring_dedup(docs(spark, rows)).collect()}
    assert sizes["seeds"] == 0 and not any(found[i].spans for i in (0, 20, 21, 22, 30, 34))
    assert all(not found[i].kept and len(found[i].spans) == 1 for i in range(1, 10))
    rows += [(40, f"{prose(50, 720)} {passage}"), (41, f"{edited(passage, 15, 3)} {prose(50, 721)}"), (41, f"{edited(passage, 15, 3)} {prose(50, 721)}")]
    found = [r for r in substring_dedup(docs(spark, rows)).collect() if r.doc_id == 41]
    assert 0 < sizes["seeds"] < 2 * 80 and len(found) == 2 and all(46 <= len(words_left(r)) <= 54 for r in found)


def test_texts_meet_one_python_process_a_task(spark, monkeypatch):
    """Functions on all texts leave copies out themselves; no filter in a second Python process runs before them."""
    plans = {}

    def record(name, function):
        def recorded(*args):
            plans[name] = (found := function(*args))._jdf.queryExecution().executedPlan().toString()
            return found

        monkeypatch.setattr(fuzzy, name, recorded)

    for name in ("_holders", "_windows", "_seed_rows"):
        record(name, getattr(fuzzy, name))
    text, passage = prose(90, 730), prose(60, 731)
    rows = [(1, text), (2, text), (3, f"{passage} {prose(30, 732)}"), (4, f"{prose(30, 733)} {passage}"), (None, text)]
    found = {r.doc_id: len(words_left(r)) for r in substring_dedup(docs(spark, rows)).collect()}
    assert found == {1: 90, 2: 0, 3: 90, 4: 30, None: 0}
    assert len(plans) == 3 and all("MapInArrow" in p and "ArrowEvalPython" not in p for p in plans.values()), plans


def test_a_process_keeps_no_powers(spark):
    """A worker that waits for its next task holds no tables of hash powers, and short blocks need small ones."""

    def sizes(batches):
        from topicwake.llm import text

        for _ in batches:
            held = text._powers.cache_info().currsize
            made = text._power(1000).base.nbytes
            yield pa.record_batch([pa.array([held]), pa.array([made])], names=["held", "made"])

    rows = [map_arrow(spark.range(8).coalesce(1), sizes, "held long, made long").first() for _ in range(3)]
    assert all(r.held == 0 and r.made <= 1 << 21 for r in rows)


def test_packed_rows_come_back():
    """Keys of the same 64 bits stay equal, others differ; the pid and the place are as they were."""
    rng = np.random.default_rng(3)
    key = rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 5000).astype(np.uint64)
    key[2500:] = key[:2500]
    pid, at = rng.integers(0, 1 << 62, 5000), rng.integers(0, 1 << 45, 5000)
    pid[:2] = -5, -1 << 63
    for buckets in (4, 256, 1 << 15):
        batches = list(fuzzy._packed(iter([(key[:1000], pid[:1000], at[:1000]), (key[1000:], pid[1000:], at[1000:])]), buckets))
        names, back, place = fuzzy._unpacked(iter(batches))
        was = {(int(p), int(a)): int(k) for p, a, k in zip(pid, at, key)}
        assert len(names) == 5000 and {(int(p), int(a)) for p, a in zip(back, place)} == set(was)
        pairs = {(int(n), was[(int(p), int(a))]) for n, p, a in zip(names, back, place)}
        assert len(pairs) == len({n for n, _ in pairs}) == len({k for _, k in pairs}) == len(set(key.tolist()))


def test_substring_dedup_of_odd_rows(spark):
    rows = odd_rows()
    found = substring_dedup(docs(spark, rows)).collect()
    kept = Counter((r.doc_id, r.kept) for r in found)
    same, long = rows[5][1], rows[8][1]
    assert len(found) == len(rows) and kept[(6, same)] == 1 and kept[(7, "")] == 2 and kept[(8, long)] == 1 and kept[(9, "")] == 1
    assert kept[(11, "")] == 1 and kept[(1, "")] == 1 and kept[(3, " \n\t ")] == 1 and kept[(10, rows[12][1])] == 1
    assert substring_dedup(docs(spark, [])).count() == 0


def test_substring_dedup_of_ids_with_several_texts(spark):
    """Each text keeps what is its own; a passage that two texts under one id hold is held once."""
    passage = prose(80, 900)
    rows = [(1, f"{prose(50, 901)} {passage}"), (2, f"{prose(40, 902)} {passage} {prose(40, 903)}"), (2, prose(200, 904)), (3, prose(120, 905)), (3, f"{prose(30, 906)} {passage}")]
    found = substring_dedup(docs(spark, rows)).collect()
    left = Counter((r.doc_id, r.n_words - len(words_left(r))) for r in found)
    assert len(found) == 5 and left[(1, 0)] == 1 and left[(2, 0)] == 1 and left[(3, 0)] == 1
    assert sorted(n for i, n in left if i == 2)[1] >= 78 and sorted(n for i, n in left if i == 3)[1] >= 78


def test_signature_estimates():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8):
        sets, hashes, n = [], [], 300
        for t in range(100):
            u = rng.integers(0, 1 << 63, n).astype(np.uint64)
            k = int(n * share)
            for side, x in enumerate((u[: k + (n - k) // 2], np.concatenate([u[:k], u[k + (n - k) // 2 :]]))):
                sets.append(np.full(len(x), 2 * t + side))
                hashes.append(x)
        found = signatures(np.concatenate(sets), np.concatenate(hashes), 200, 350)
        estimate = (found[0::2] == found[1::2]).mean(axis=1)
        assert abs(estimate.mean() - share) < 0.01 and estimate.std() < np.sqrt(share * (1 - share) / 350)
    one = signatures(np.zeros(1, np.int64), np.array([7], np.uint64), 2, 350)
    assert sorted((one[0] >> np.uint64(32)).tolist()) == list(range(350)) and (one[1] == ~np.uint64(0)).all()


def test_similar_pairs_against_sets():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    plain = {
        (i, j)
        for i in range(40)
        for j in range(i + 1, 40)
        if 100 * len(set(sets[i]) & set(sets[j])) >= 50 * len(set(sets[i]) | set(sets[j]))
    }
    assert set(zip(*map(np.ndarray.tolist, similar_pairs(sets, 40, 50)))) == plain
    assert set(zip(*map(np.ndarray.tolist, similar_pairs(sets, 15, 50)))) == {(i, j) for i, j in plain if i < 15 <= j}


def brute_components(rows, size, percent):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = defaultdict(list)
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low))
        sets[i].append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                for s in sets[a]:
                    for t in sets[b]:
                        if s and t and label[a] < label[b] and 100 * len(s & t) >= percent * len(s | t):
                            label[b], changed = label[a], True
    return label, sets


@pytest.mark.parametrize("rows_per_group", [512, 2])
def test_near_duplicates(spark, monkeypatch, rows_per_group):
    monkeypatch.setattr(minhash, "GROUP_ROWS", rows_per_group)
    base = prose(150, 40)
    rows = odd_rows() + [(100 + i, edited(base, 40 + i, i)) for i in range(12)] + [(130, base), (131, edited(base, 8, 3))]
    found = near_duplicates(docs(spark, rows), shingle=4).collect()
    label, sets = brute_components(rows, 4, 80)
    assert Counter((r.doc_id, r.component_id, r.kept) for r in found) == Counter(
        (i, label.get(i), i is None or label[i] == i) for i, _ in rows
    )
    assert all(r.n_shingles in {len(s) for s in sets[r.doc_id]} for r in found)
    assert near_duplicates(docs(spark, [])).count() == 0


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 300, 2)] + [(i, i + 1) for i in range(400, 500)] + [(1000, 1000 + k) for k in range(1, 200)]
    edges += [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(60)] + [(5, 5)]
    rng.shuffle(edges)
    nodes, roots = forest(np.array([e[0] for e in edges]), np.array([e[1] for e in edges]))
    found = components(spark.createDataFrame([(b, a) for a, b in edges], "u long, v long").repartition(5)).collect()
    assert {(r.node, r.component) for r in found} == set(zip(nodes.tolist(), roots.tolist()))
    label = {i: i for e in edges for i in e}
    for _ in range(len(label)):
        new = dict(label)
        for a, b in edges:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            break
        label = new
    assert dict(zip(nodes.tolist(), roots.tolist())) == {i: r for i, r in label.items() if i != r}
