"""A Merkle manifest of a dataset, its trees stored in van Emde Boas layout.

Rows are leaves; per group (language) they ascend by id, and every ``FANOUT`` consecutive nodes of
a level (the last run may be shorter) hash to their parent until one node, the group's subroot, is
left.  The subroots, ordered by group (null first, bytewise), are the leaves of one more tree,
whose last node is the root.

A tree is cut into aligned blocks of ``HEIGHT`` levels above their leaves.  A block is one row of a
stored table and holds its nodes in van Emde Boas order: the levels are split at half their
height, the upper part comes first, then the lower subtrees, each laid out in the same way.  So a
path from a leaf upwards stays in few short stretches at every scale, and a node's place follows
from its depth and index alone (``address``) - used to write the nodes and to read siblings.  The
block roots are the leaves of the next round of blocks, until every tree has one root.

Spark sorts the leaves once by range to number them (one count per partition on the driver), deals
them out by block - at most 8^4 rows meet in one task's group, however large a language is - and
joins paths downwards block by block, one to one.

Defined cases: null fields hash as ``-``; null ids come first; rows with one id are ordered by their
leaf; equal rows are interchangeable; a null group is a group; a group of one row has its leaf as
subroot; an empty table gives an empty result; other input columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_groups, numbered, stored

FANOUT, SHIFT = 8, 3
HEIGHT = 4
FULL = FANOUT ** HEIGHT
DIGEST, HEX = 32, 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_hash(fields: dict[str, Column] | None = None) -> Column:
    """The digest (32 bytes) of a row's fields; ``fields`` replaces some by other columns."""
    def part(name: str) -> Column:
        value = (fields or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(part, FIELDS)), 256))


def hash_text(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def tree_size(levels: int) -> int:
    return (FANOUT ** levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, index):
    """The place of node ``index`` at ``depth`` (root: 0) in a tree of ``levels`` levels."""
    at = index * 0
    while levels > 1:
        lower = levels // 2
        upper = levels - lower
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        subtree = index >> SHIFT * depth
        at = at + tree_size(upper) + subtree * tree_size(lower)
        index = index - (subtree << SHIFT * depth)
        levels = lower
    return at


def height_of(n: int) -> int:
    """Levels above the leaves of a block in a tree whose round has ``n`` nodes."""
    h = 0
    while h < HEIGHT and FANOUT ** h < n:
        h += 1
    return h


class Block:
    """An aligned subtree: ``count`` leaves, ``height`` levels above them, nodes in layout order."""

    def __init__(self, nodes: bytes, count: int, height: int):
        self.nodes = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
        self.count, self.height = count, height

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> "Block":
        nodes = np.zeros((tree_size(height + 1), DIGEST), np.uint8)
        block = cls(nodes.tobytes(), len(leaves), height)
        block.nodes = nodes
        level = leaves
        for depth in range(height, -1, -1):
            nodes[address(height + 1, depth, np.arange(len(level)))] = np.frombuffer(b"".join(level), np.uint8).reshape(-1, DIGEST)
            if depth:
                run = FANOUT * HEX
                text = block.level(depth)
                level = [hash_text(text[i:i + run]) for i in range(0, len(text), run)]
        return block

    def width(self, depth: int) -> int:
        return -(-self.count // FANOUT ** (self.height - depth))

    def level(self, depth: int) -> str:
        """The hex digests of all nodes at ``depth``, joined."""
        return self.nodes[address(self.height + 1, depth, np.arange(self.width(depth)))].tobytes().hex()

    @property
    def root(self) -> bytes:
        return self.nodes[0].tobytes()

    def paths(self):
        """Per leaf its siblings (before it, after it) level by level upwards, as hex."""
        levels = [self.level(d) for d in range(self.height, 0, -1)]
        run = FANOUT * HEX
        for leaf in range(self.count):
            path, i = [], leaf
            for text in levels:
                start, k = (i >> SHIFT) * run, (i & FANOUT - 1) * HEX
                path.append((text[start:start + k], text[start + k + HEX:start + run]))
                i >>= SHIFT
            yield path


def fold(digest: str, path) -> str:
    for before, after in path:
        digest = hash_text(before + digest + after).hex()
    return digest


_PATH = "array<struct<before:string,after:string>>"
_PATH_ARROW = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_BLOCK = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("count", pa.int32()), ("height", pa.int32()),
                    ("nodes", pa.binary()), ("root", pa.binary()), ("ids", pa.list_(pa.int64())), ("claims", pa.list_(pa.binary()))])
_BLOCK_SQL = "tree long, block long, n long, count int, height int, nodes binary, root binary, ids array<long>, claims array<binary>"


def _built(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("pos")
    n, height = rows["n"][0].as_py(), height_of(rows["n"][0].as_py())
    block = Block.build(rows["digest"].to_pylist(), height)
    return pa.Table.from_pylist([{
        "tree": rows["tree"][0].as_py(), "block": rows["block"][0].as_py(), "n": n, "count": block.count, "height": height,
        "nodes": block.nodes.tobytes(), "root": block.root, "ids": rows["id"].to_pylist(), "claims": rows["claim"].to_pylist()}], _BLOCK)


def build_forest(nodes: DataFrame) -> list[DataFrame]:
    """The stored block tables, round by round, of the trees over ``nodes`` (tree, pos, n: nodes of
    the tree, digest, id, claim)."""
    rounds = []
    while True:
        dealt = nodes.withColumn("block", F.expr(f"pos div {FULL}"))
        blocks = stored(dealt.groupBy("tree", "block").applyInArrow(_built, _BLOCK_SQL), "merkle-blocks")
        rounds.append(blocks)
        nodes = blocks.filter(F.col("n") > FULL).select(
            "tree", F.col("block").alias("pos"), F.expr(f"(n + {FULL - 1}) div {FULL}").alias("n"), F.col("root").alias("digest"),
            F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim"))
        if nodes.isEmpty():
            return rounds


def tree_roots(rounds: list[DataFrame]) -> DataFrame:
    """tree, root of every tree of a forest."""
    return reduce(DataFrame.unionByName, [b.filter(F.col("n") <= FULL).select("tree", "root") for b in rounds])


def _leaf_paths(it):
    for batch in it:
        for b in batch.to_pylist():
            upper = [(p["before"], p["after"]) for p in b["path"]]
            paths = [[{"before": x, "after": y} for x, y in [*p, *upper]] for p in Block(b["nodes"], b["count"], b["height"]).paths()]
            k = len(paths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b["tree"]] * k, pa.int64()), pa.array(range(b["block"] * FULL, b["block"] * FULL + k), pa.int64()),
                 pa.array([b["subroot"]] * k, pa.binary()), pa.array(paths, _PATH_ARROW)], names=["tree", "block", "subroot", "path"])


def _with_paths(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first round's blocks with subroot and the path from the block's root upwards; ``above``
    (tree, subroot, path) has the paths of the trees' own roots."""
    placed = None
    for blocks in reversed(rounds):
        whole = blocks.filter(F.col("n") <= FULL).join(above, "tree")
        if placed is not None:
            upper = placed.select("tree", "block", "count", "height", "nodes", "subroot", "path").mapInArrow(
                _leaf_paths, f"tree long, block long, subroot binary, path {_PATH}")
            whole = whole.unionByName(blocks.filter(F.col("n") > FULL).join(upper, ["tree", "block"]))
        placed = whole
    return placed


_PROOF = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                    ("proof", _PATH_ARROW), ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def _proofs(root: str, with_paths: bool):
    def run(it):
        for batch in it:
            for b in batch.to_pylist():
                upper = [(p["before"], p["after"]) for p in b["path"]]
                above, known = "".join(x + y for x, y in upper), {}
                block, out = Block(b["nodes"], b["count"], b["height"]), []
                leaves = block.level(block.height)
                for i, path in enumerate(block.paths()):
                    leaf = leaves[i * HEX:(i + 1) * HEX]
                    top = fold(b["claims"][i].hex() if b["claims"][i] is not None else leaf, path)
                    if top not in known:  # most leaves of a block fold to its one root
                        known[top] = fold(top, upper)
                    out.append((b["ids"][i], leaf, b["subroot"].hex(), root,
                                [{"before": x, "after": y} for x, y in [*path, *upper]] if with_paths else None,
                                hash_text("".join(x + y for x, y in path) + above).hex(), known[top]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), _PROOF)], schema=_PROOF)
    return run


class Manifest:
    """The stored trees of a dataset: ``rounds`` of the groups' blocks, ``top`` of the tree over the
    subroots, and the ``root`` (hex; None for an empty dataset)."""

    def __init__(self, leaves: DataFrame):
        """``leaves``: id, grp, digest[, claim: the digest to be verified in its place]."""
        if "claim" not in leaves.columns:
            leaves = leaves.withColumn("claim", F.lit(None).cast("binary"))
        rows, total = numbered(leaves.select(F.col("id").cast("long"), F.col("grp").cast("string"), "digest", "claim"), ["grp", "id", "digest"])
        rows = rows.withColumn("key", F.coalesce(F.concat(F.lit("g"), "grp"), F.lit("")))
        groups = rows.groupBy("key").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"))
        groups, self.groups = numbered(groups, ["first"], "tree")
        groups = stored(groups, "merkle-groups")
        nodes = join_groups(rows, groups, "key", "n", total)
        self.rounds = build_forest(nodes.select("tree", (F.col("row") - F.col("first")).alias("pos"), "n", "digest", "id", "claim"))
        self.subroots = tree_roots(self.rounds)
        self.top = build_forest(self.subroots.select(
            F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(self.groups).cast("long").alias("n"),
            F.col("root").alias("digest"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("claim")))
        one = tree_roots(self.top).first()
        self.root = one["root"].hex() if one else None

    def proofs(self, with_paths: bool = False) -> DataFrame:
        """doc_id, leaf, subroot, root, proof (siblings before and after, level by level; only on
        request), proof_sha256 and folded_root (from the claim, else the leaf) of every row."""
        spark = self.subroots.sparkSession
        start = spark.createDataFrame([(0, None, [])], f"tree long, subroot binary, path {_PATH}")
        tops = _with_paths(self.top, start).select("tree", "block", "count", "height", "nodes", "subroot", "path")
        above = tops.mapInArrow(_leaf_paths, f"tree long, block long, subroot binary, path {_PATH}").select(F.col("block").alias("tree"), "path")
        above = stored(self.subroots.withColumnRenamed("root", "subroot").join(above, "tree"), "merkle-top")
        blocks = _with_paths(self.rounds, above).select("count", "height", "nodes", "ids", "claims", "subroot", "path")
        return blocks.mapInArrow(_proofs(self.root, with_paths), f"doc_id long, leaf string, subroot string, root string, proof {_PATH}, "
                                                                 "proof_sha256 string, folded_root string")


def tampered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def document_leaves(docs: DataFrame) -> DataFrame:
    """id, grp, digest of the documents, and as claim the digest of the text with A-Z lower-cased
    where 3 divides the crc32 of the id."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"), leaf_hash().alias("digest"),
                       F.when(hit, leaf_hash({"text": tampered(F.col("text"))})).alias("claim"))
