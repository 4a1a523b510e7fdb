"""Merkle manifest of a table as a persistent, path-copying tree.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else byte count, ``:``
and value. The leaves of a group (``lang``) ascend by id; every two consecutive nodes
become the hash of their joined digests, a node without a partner the hash of its own,
until one is left: the group's subroot. Subroots in order of their group give the root
in the same way.

1. Leaves get their position in the group (``ranks``: no group is gathered anywhere).
2. Aligned blocks of ``1 << LEVELS`` consecutive nodes are one task's work: it builds the
   block's nodes, which are written once and never changed. Block roots are the nodes of
   the next stage, by the same function, until every group has one node; the subroots go
   through it once more. A stage has a thousandth of the rows of the one before.
3. The paths of a stage's nodes are joined to those of the blocks above them from the top
   down (at most ``1 << LEVELS`` children a node, so no key is hot), which gives every
   lowest block its siblings up to the root.
4. A changed leaf makes a version of the tree: it copies its own ancestors in its aligned
   block and shares all other nodes, then goes on from its block's root through the shared
   siblings of the blocks above. Versions are made where their block is, so however many
   pass through an upper node, no task holds more than those of one block.

Edge cases: null and repeated ids are rows of their own (nulls first, equal ids by leaf);
a null group is one group, and the first; a row alone in its group is the subroot, the only
group's subroot the root; an empty table gives no row. A null id is never chosen for a change.
Columns other than the five fields are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm.ranks import ranked
from terrace.session import fresh_dir

LEVELS = 10
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A sibling of a path is written behind the side it stands on; empty where a node has none.
LEFT, RIGHT = "<", ">"
BLOCK = "group string, block bigint, nodes array<array<string>>"
PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
VERSION = "group string, version bigint, digests array<string>"


@dataclass
class Manifest:
    """The written tree.

    ``leaves``: doc_id, lang, group, pos, leaf, changed. ``blocks``: group, block, nodes (of the lowest
    stage, by level) and upper, the siblings from the block's root to the root. ``groups``: group, subroot, root.
    """

    leaves: DataFrame
    blocks: DataFrame
    groups: DataFrame
    levels: int


def leaf_hash(**changed: Column) -> Column:
    """Hash of the fields of a row; ``changed`` replaces columns."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in FIELDS]), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def block_nodes(nodes: list[str], alone: bool, levels: int = LEVELS) -> list[list[str]]:
    """The nodes of a block by level, its root last; a block ``alone`` in its group stops at one node."""
    out = [nodes]
    while len(out) <= levels and not (alone and len(out[-1]) == 1):
        below = out[-1]
        out.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def siblings(nodes: list[list[str]], at: int) -> list[str]:
    """The path of a node of the lowest level: per level its sibling behind its side, or an empty text."""
    out = []
    for level in nodes[:-1]:
        other = at ^ 1
        out.append((LEFT if other < at else RIGHT) + level[other] if other < len(level) else "")
        at >>= 1
    return out


def copies(node: str, path: list[str]) -> list[str]:
    """The ancestors that a version has for itself, from its leaf and the siblings that it shares."""
    out = []
    for step in path:
        node = digest(step[1:], node) if step.startswith(LEFT) else digest(node, step[1:])
        out.append(node)
    return out


def _build(levels: int):
    """A block's nodes (group, block, pos, node) to one row of them. The first block is alone if it is not full."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        group, block = table.column("group")[0].as_py(), table.column("block")[0].as_py()
        low = table.column("node").to_pylist()
        nodes = block_nodes(low, block == 0 and len(low) <= 1 << levels, levels)
        return pa.table({"group": [group], "block": [block], "nodes": pa.array([nodes], pa.list_(pa.list_(pa.string())))})

    return build


def climb(spark: SparkSession, nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """The written blocks of every stage over ``nodes`` (group, pos, node), and ``group, node``: the one that is left of each group."""
    stages = []
    while True:
        path = fresh_dir(spark, f"merkle-stage{len(stages)}")
        rows = nodes.select("group", F.shiftright("pos", levels).alias("block"), "pos", "node")
        rows.groupBy("group", "block").applyInArrow(_build(levels), BLOCK).write.parquet(path)
        stages.append(spark.read.parquet(path))
        top = F.get(F.get("nodes", F.size("nodes") - 1), F.lit(0))
        # a finished group's only node is a block of its own in the stages that follow, and stays as it is
        nodes = stages[-1].select("group", F.col("block").alias("pos"), top.alias("node"))
        if not (nodes.agg(F.max("pos")).first()[0] or 0):
            return stages, nodes.select("group", "node")


def paths(stage: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``group, pos, path`` of every lowest node of a stage's blocks."""

    def run(batches):
        for batch in batches:
            for group, block, nodes in zip(*(c.to_pylist() for c in batch.columns)):
                made = [siblings(nodes, i) for i in range(len(nodes[0]))]
                pos = [(block << levels) + i for i in range(len(made))]
                yield pa.RecordBatch.from_arrays([pa.array([group] * len(made)), pa.array(pos, pa.int64()), pa.array(made, pa.list_(pa.string()))], names=["group", "pos", "path"])

    return stage.select("group", "block", "nodes").mapInArrow(run, "group string, pos bigint, path array<string>")


def down(stages: list[DataFrame], above: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``group, block, upper`` for the blocks of the stage under ``stages``: the siblings from a block's root on.

    ``above`` (group, block, upper) says what follows the one node that is left of each group.
    """
    for stage in reversed(stages):
        mine = paths(stage, levels).withColumn("block", F.shiftright("pos", levels))
        above = mine.join(above, ["group", "block"]).select("group", F.col("pos").alias("block"), F.concat("path", "upper").alias("upper"))
    return above


def manifest(spark: SparkSession, rows: DataFrame, changed_chars: Column, levels: int = LEVELS) -> Manifest:
    """The tree of ``rows``; a leaf whose ``changed_chars`` are not its ``n_chars`` makes a version of it."""
    differs = ~changed_chars.eqNullSafe(F.col("n_chars"))
    changed = F.when(differs, leaf_hash(n_chars=changed_chars))
    leaves = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", leaf_hash().alias("leaf"), changed.alias("changed"))
    placed = ranked(spark, leaves, ["lang"], ["doc_id", "leaf"]).withColumn("group", F.to_json(F.struct("lang")))
    stages, subroots = climb(spark, placed.select("group", "pos", F.col("leaf").alias("node")), levels)
    langs = placed.filter("pos = 0").select("group", "lang")
    whole = ranked(spark, subroots.join(langs, "group").withColumn("one", F.lit("")), ["one"], ["lang"])
    heads, roots = climb(spark, whole.select(F.col("one").alias("group"), "pos", "node"), levels)
    named = whole.join(roots.select(F.col("group").alias("one"), F.col("node").alias("root")), "one")
    top = down(heads, roots.select("group", F.lit(0).cast("bigint").alias("block"), F.array().cast("array<string>").alias("upper")), levels)
    above = whole.join(top.select(F.col("block").alias("pos"), "upper"), "pos").select("group", F.lit(0).cast("bigint").alias("block"), "upper")
    uppers = down(stages[1:], above, levels)
    path = fresh_dir(spark, "merkle-blocks")
    stages[0].join(uppers, ["group", "block"]).write.parquet(path)
    groups = named.select("group", F.col("node").alias("subroot"), "root")
    return Manifest(placed, spark.read.parquet(path), groups, levels)


def _per_block(tree: Manifest, make, kind: str, leaves: DataFrame) -> DataFrame:
    """``make`` over the leaves of every block (sorted), its nodes and upper siblings, and its subroot and root."""
    mine = leaves.withColumn("block", F.shiftright("pos", tree.levels))
    mine = mine.select("group", "block", "pos", "doc_id", "leaf", "changed")
    blocks = tree.blocks.join(tree.groups, "group").select("group", "block", "nodes", "upper", "subroot", "root")

    def run(rows: pa.Table, block: pa.Table) -> pa.Table:
        found = {c: block.column(c)[0].as_py() for c in ("nodes", "upper", "subroot", "root")} if len(block) and len(rows) else None
        return make(rows, found)

    return mine.groupBy("group", "block").cogroup(blocks.groupBy("group", "block")).applyInArrow(run, kind)


def proofs(tree: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    The proof's hash is over the original siblings, from the leaf's up; ``folded_root`` is what the row's
    version of the tree ends in (the changed leaf's, else the original one's), ``verified`` whether that is the root.
    """
    low = tree.levels

    def make(rows: pa.Table, block) -> pa.Table:
        out = []
        for pos, doc, leaf, changed in zip(*(rows.column(c).to_pylist() for c in ("pos", "doc_id", "leaf", "changed"))):
            path = siblings(block["nodes"], pos & ((1 << low) - 1)) + block["upper"]
            folded = ([changed or leaf] + copies(changed or leaf, path))[-1]
            out.append((doc, leaf, block["subroot"], block["root"], digest(*(s[1:] for s in path)), folded))
        kinds = (pa.int64(), *[pa.string()] * 5)
        cols = list(zip(*out)) or [[]] * 6
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in PROOF.split(", ")])

    return _per_block(tree, make, PROOF, tree.leaves).withColumn("verified", F.col("folded_root") == F.col("root"))


def versions(tree: Manifest) -> DataFrame:
    """``group, version, level, digest``: the nodes that the version of each changed leaf has for itself.

    ``version`` is the leaf's position, level 0 the changed leaf, the last level the version's root.
    All nodes that are not listed are shared with the original tree.
    """
    low = tree.levels

    def make(rows: pa.Table, block) -> pa.Table:
        made = []
        for pos, changed in zip(rows.column("pos").to_pylist(), rows.column("changed").to_pylist()):
            path = siblings(block["nodes"], pos & ((1 << low) - 1)) + block["upper"]
            made.append((pos, [changed, *copies(changed, path)]))
        group = [rows.column("group")[0].as_py()] * len(made) if made else []
        pos, nodes = list(zip(*made)) or ([], [])
        return pa.table([pa.array(group, pa.string()), pa.array(pos, pa.int64()), pa.array(nodes, pa.list_(pa.string()))], names=["group", "version", "digests"])

    found = _per_block(tree, make, VERSION, tree.leaves.filter("changed is not null"))
    return found.select("group", "version", F.posexplode("digests").alias("level", "digest"))


def planted_chars() -> Column:
    """The planted change: ``n_chars`` and one where 7 divides the unsigned CRC-32 of the decimal id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
