"""Merkle manifest of a table: leaves in aligned blocks, each level of a block one string of hex digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicwake.operators.ids import dense_id
from topicwake.session import discard, materialize

#: Hex digits of a digest, and levels of the tree that one aligned block covers.
HEX, HEIGHT = 64, 6


def record_hash(*fields: Column) -> Column:
    """The leaf of a record: SHA-256 of its fields one after the other, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    text = [f.cast("string") for f in fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*sized), 256)


def _piece(level: Column, first: Column, count: Column) -> Column:
    """``count`` digests of a level from digest ``first`` on. As bytes, a place in the string is found without walking to it."""
    return F.substring(level.cast("binary"), (first * HEX + 1).cast("int"), (count * HEX).cast("int")).cast("string")


def _parents(level: Column, fan: int) -> Column:
    """The next level: every ``fan`` digests in a row are cut out at their fixed width and hashed; the last run may be shorter."""
    runs = F.ceil(F.length(level) / (fan * HEX))
    digest = lambda i: F.sha2(_piece(level, i * fan, F.lit(fan)), 256)
    return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), runs - 1), digest), "")


def _steps(n: Column, fan: int, height: int) -> Column:
    """The sizes fan^0, fan^1, ... below a block's levels: all ``height`` of them, fewer where ``n`` nodes meet in one before."""
    powers = F.array(*[F.lit(fan**j).cast("long") for j in range(height)])
    return F.filter(powers, lambda p: p < n)


def _blocks(nodes: DataFrame, fan: int, height: int) -> DataFrame:
    """(g, n, block, nodes, levels) from (g, n, place, node, ...): fan^height nodes of a group at most, and their levels up to one digest."""
    held = ["place", *[c for c in nodes.columns if c not in ("g", "n", "place")]]
    block = F.expr(f"place div {fan**height}").alias("block")
    blocks = nodes.groupBy("g", "n", block).agg(F.sort_array(F.collect_list(F.struct(*held))).alias("nodes"))
    first = F.array(F.array_join(F.transform("nodes", lambda x: x["node"]), ""))
    climb = lambda levels, _: F.concat(levels, F.array(_parents(F.element_at(levels, -1), fan)))
    return materialize(blocks.withColumn("levels", F.aggregate(_steps(F.col("n"), fan, height), first, climb)), "merkle-blocks")


def _climb(nodes: DataFrame, most: int, fan: int, height: int) -> list[DataFrame]:
    """Tiers of blocks: the tops of one tier's blocks are the nodes of the next, until every group has one block. ``most``: nodes of the largest group."""
    tiers, size = [_blocks(nodes, fan, height)], fan**height
    while most > size:
        most = -(-most // size)
        top = F.element_at("levels", -1).alias("node")
        tiers.append(_blocks(tiers[-1].select("g", F.ceil(F.col("n") / size).alias("n"), F.col("block").alias("place"), top), fan, height))
    return tiers


def _path(index: Column, fan: int, height: int) -> Column:
    """What stands left and right of a node in its run, for each level of its block: list of (left, right)."""

    def flanks(power: Column, j: Column) -> Column:
        level, at = F.col("levels")[j], F.floor(index / power)
        start = at - at % fan
        end = F.least(start + fan, F.length(level) / HEX)
        return F.struct(_piece(level, start, at - start).alias("left"), _piece(level, at + 1, end - at - 1).alias("right"))

    return F.transform(_steps(F.col("n"), fan, height), flanks)


def _descend(tiers: list[DataFrame], above: DataFrame, fan: int, height: int) -> DataFrame:
    """The nodes of the lowest tier with ``path``, the flanks up to the top of ``above`` (g, above, top), and ``top``."""
    blocks = tiers[-1].join(above, "g")
    each = path = None
    for k in reversed(range(len(tiers))):
        each = blocks.select("g", "n", "levels", "above", "top", F.posexplode("nodes").alias("index", "node"))
        path = F.concat(_path(F.col("index"), fan, height), F.col("above"))
        if k:
            children = each.select("g", F.col("node.place").alias("block"), path.alias("above"), "top")
            blocks = tiers[k - 1].join(children, ["g", "block"])
    return each.select("g", "node.*", path.alias("path"), "top")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the flanks on its path give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_hash(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def merkle_manifest(
    df: DataFrame,
    fields: list[str],
    id_col: str = "doc_id",
    group_col: str = "lang",
    carry: dict[str, Column] | None = None,
    fan: int = 2,
    height: int = HEIGHT,
) -> DataFrame:
    """(id, leaf, subroot, root, path) of each row of ``df``, and the columns of ``carry``.

    A leaf is the record hash of ``fields``. The leaves of a group ascend by id; every ``fan`` nodes in a row become the SHA-256 of
    their hex digests, a shorter last run too, until one is left, the subroot. The subroots, by group (null first, then bytewise), go the
    same way to the root. ``path`` lists, from the leaf to the root, what stands left and right of the node in its run.

    A null field counts as ``-``; a null group is a group of its own, null ids come first in theirs, and rows that share an
    id are ordered by their leaf. Rows repeated whole are leaves each, with equal results but for their paths' order. A group of one row has its leaf as
    subroot, one group's subroot is the root, and a table of one row has an empty path. An empty table gives no rows; columns that are not named are ignored.

    Rows get dense places by ranges of (group, id), which splits a hot group over tasks. An aligned block of fan^height
    leaves is one row that keeps each of its levels as one string; digests are cut out at their fixed width. The blocks' tops are
    the leaves of the next tier, so a tier is fan^height times smaller than the one below, and no task ever holds a whole level.
    """
    extra = carry or {}
    leaves = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{group_col}`").alias("grp"),
        record_hash(*[F.col(f"`{c}`") for c in fields]).alias("node"),
        (F.struct(*[c.alias(n) for n, c in extra.items()]) if extra else F.lit(None).cast("string")).alias("extra"),
        F.monotonically_increasing_id().alias("tie"),
    )
    leaves = materialize(leaves, "leaves")
    placed = dense_id(leaves, ["grp", "id", "node", "tie"], "at").drop("tie")
    discard(leaves)
    groups = placed.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("base"))
    groups = materialize(dense_id(groups, ["grp"], "g"), "merkle-groups")
    most, count = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    same = placed["grp"].eqNullSafe(groups["grp"])
    nodes = placed.join(groups, same).select("g", "n", (F.col("at") - F.col("base")).alias("place"), "node", "id", "extra")
    tiers = _climb(nodes, most or 0, fan, height)

    subroots = tiers[-1].select("g", F.element_at("levels", -1).alias("node"))
    named = subroots.select(F.lit(0).cast("long").alias("g"), F.lit(count).cast("long").alias("n"), F.col("g").alias("place"), "node")
    upper = _climb(named, count, fan, height)
    root = upper[-1].select(F.element_at("levels", -1)).first()  # one digest
    none = F.array().cast("array<struct<left:string,right:string>>")
    ends = _descend(upper, upper[-1].select("g", none.alias("above"), F.lit("").alias("top")), fan, height)
    ends = materialize(ends.select(F.col("place").alias("g"), F.col("path").alias("above"), F.col("node").alias("top")), "subroot-paths")
    found = _descend(tiers, ends, fan, height)
    return found.select(
        F.col("id").alias(id_col),
        F.col("node").alias("leaf"),
        F.col("top").alias("subroot"),
        F.lit(root[0] if root else None).cast("string").alias("root"),
        "path",
        *[F.col(f"extra.`{c}`").alias(c) for c in extra],
    )
