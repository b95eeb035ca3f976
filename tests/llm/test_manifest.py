"""Merkle manifest against a tree built in a plain loop."""

import hashlib
import random

import pytest
from cases import CLASHES
from pyspark.sql import functions as F

from topicwake.llm.merkle import folded, merkle_manifest, proof_hash


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))


def tree(nodes, fan):
    paths, own = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(own):
            run = nodes[i - i % fan : i - i % fan + fan]
            paths[k].append("".join(run[: i % fan]) + "".join(run[i % fan + 1 :]))
            own[k] = i // fan
        nodes = [digest("".join(nodes[a : a + fan])) for a in range(0, len(nodes), fan)]
    return nodes[0], paths


def wanted(rows, fan):
    groups = sorted({r[1] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    found, tops = [], []
    for g in groups:
        leaves = sorted((r[0] is not None, r[0] or 0, leaf(*r)) for r in rows if r[1] == g)
        top, paths = tree([x[2] for x in leaves], fan)
        tops.append(top)
        found.append((leaves, paths))
    root, above = tree(tops, fan)
    return root, {
        (x[2], top, root, digest("".join(p + up)))
        for (leaves, paths), top, up in zip(found, tops, above)
        for x, p in zip(leaves, paths)
    }


def table(spark, rows):
    full = [(*r, *(None if i % 3 == 0 else f"{c}{i}" for c in CLASHES)) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, lang string, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)).repartition(5)


@pytest.mark.parametrize("fan,height", [(2, 2), (3, 2), (2, 6)])
def test_equals_a_plain_tree(spark, fan, height):
    rng = random.Random(1)
    langs = [None, "de", "en", "en", "en", "é", ""]
    rows = [(i, rng.choice(langs), rng.choice([None, "", "x é", "long " * 5000])) for i in rng.sample(range(10**6), 300)]
    rows += [(None, "en", "q"), (5, "en", "a"), (5, "en", "b"), (6, "zz", "only"), (7, None, "same"), (7, None, "same")]
    df = table(spark, rows)
    found = merkle_manifest(df, ["doc_id", "lang", "text"], carry={"n": F.length("text")}, fan=fan, height=height).select(
        "*", folded(F.col("leaf"), F.col("path")).alias("again"), proof_hash(F.col("path")).alias("proof")
    )
    found = found.collect()
    root, every = wanted(rows, fan)
    assert len(found) == len(rows) and all(r.again == root for r in found)
    assert {(r.leaf, r.subroot, r.root, r.proof) for r in found} == every
    assert sorted(r.n or 0 for r in found) == sorted(len(r[2] or "") for r in rows)


def test_small_tables(spark):
    assert merkle_manifest(table(spark, []), ["doc_id", "text"]).count() == 0
    (one,) = merkle_manifest(table(spark, [(1, "en", "x")]), ["doc_id", "text"]).collect()
    assert one.leaf == one.subroot == one.root == leaf(1, "x") and one.path == []
    (a, b) = merkle_manifest(table(spark, [(1, None, "x"), (2, "", "x")]), ["doc_id"]).orderBy("doc_id").collect()
    assert a.subroot == leaf(1) and b.subroot == leaf(2) and a.root == digest(leaf(1) + leaf(2))
    assert [tuple(x) for x in a.path] == [("", leaf(2))] and [tuple(x) for x in b.path] == [(leaf(1), "")]


def test_changed_records_do_not_verify(spark):
    df = table(spark, [(i, "en", f"text {i}") for i in range(200)])
    other = F.sha2(F.concat(F.col("text"), F.lit("!")), 256)
    found = merkle_manifest(df, ["doc_id", "text"], carry={"other": other}, height=3)
    assert found.where(folded(F.col("other"), F.col("path")) == F.col("root")).count() == 0
