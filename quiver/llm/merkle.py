"""A Merkle manifest of a dataset: one tree of its rows per source, and one tree over the sources.

The tree of a source is cut into superblocks of ``fanout ** height`` consecutive nodes. Going up, a superblock is
reduced to one node, tier by tier, until each source has one (its subroot); the subroots form the last tree. Going
down, the nodes of a superblock are cogrouped with the outer nodes that their proofs need beyond it, and
one pass over the group finishes the local reduction, joins both parts of each proof and folds it. A group holds
one superblock and the outer nodes of one path, whatever the size of its source.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiver.llm.common import prepare, reliable
from quiver.llm.places import places

FANOUT = 16
HEIGHT = 3  # levels of a superblock: 4096 leaves
TAMPER = 5
TOP = "top"  # the tree over the sources
NODES = "tree string, pos long, node string"
OUTER = "tree string, block long, level int, before string, behind string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(*values: Column) -> Column:
    """SHA-256 of the values: ``-`` for a null, else the count of its bytes, a colon and the value."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told), 256)


def levels_of(n: int, fanout: int) -> int:
    """How often ``n`` nodes are grouped until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _local(nodes: list[str], block: int, fanout: int, height: int) -> list[list[str]]:
    """The joined runs of each level of a superblock, and its one node as the last level.

    Only the first superblock of a tree may be the whole tree, which ends where one node is left."""
    out = []
    for _ in range(levels_of(len(nodes), fanout) if block == 0 else height):
        runs = ["".join(nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        out.append(runs)
        nodes = [_sha(r) for r in runs]
    return [*out, nodes]


def _up(fanout: int, height: int):
    def run(key, t):
        top = _local(t.sort_values("pos")["node"].tolist(), key[1], fanout, height)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "node": [top]})

    return run


def _paths(own: pd.DataFrame, outer: pd.DataFrame, block: int, fanout: int, height: int) -> list[list[tuple[str, str]]]:
    """For each node of the superblock, in order, what stands before and behind it at each level up to the root."""
    *runs, _ = _local(own["node"].tolist(), block, fanout, height)
    beyond = outer[outer["level"] > 0].sort_values("level")
    tail = list(zip(beyond["before"], beyond["behind"]))
    out = []
    for i in range(len(own)):
        path = []
        for level in runs:
            run, at = level[i // fanout], 64 * (i % fanout)
            path.append((run[:at], run[at + 64:]))
            i //= fanout
        out.append(path + tail)
    return out


def _down(fanout: int, height: int):
    """The outer nodes of the superblocks below; level 0 holds the subroot (known below a source) and the root."""

    def run(key, own, outer):
        own = own.sort_values("pos")
        subroot, root = outer.loc[outer["level"] == 0, ["before", "behind"]].iloc[0]
        rows = []
        for path, node, tree, block in zip(_paths(own, outer, key[1], fanout, height), own["node"], own["below"], own["below_block"]):
            rows.append((tree, block, 0, node if key[0] == TOP and tree != TOP else subroot, root))
            rows += [(tree, block, k, *pair) for k, pair in enumerate(path, 1)]
        return pd.DataFrame(rows, columns=["tree", "block", "level", "before", "behind"])

    return run


def _prove(fanout: int, height: int):
    def run(key, own, outer):
        own = own.sort_values("pos")
        subroot, root = outer.loc[outer["level"] == 0, ["before", "behind"]].iloc[0]
        proofs, folded = [], []
        for path, node in zip(_paths(own, outer, key[1], fanout, height), own["shown"]):
            proofs.append(_sha("".join(a + b for a, b in path)))
            for a, b in path:
                node = _sha(a + node + b)
            folded.append(node)
        return pd.DataFrame({"doc_id": own["doc_id"].astype("Int64").tolist(), "leaf": own["node"].tolist(), "subroot": subroot, "root": root, "proof_sha256": proofs,
                             "folded_root": folded, "verified": [x == root for x in folded]}, columns=[c.split()[0] for c in PROOFS.split(", ")])

    return run


def _tiers(nodes: DataFrame, fanout: int, height: int) -> list[DataFrame]:
    """``nodes`` and the tables of superblock nodes above it; the last one has a node for each tree."""
    tiers, size = [nodes], fanout ** height
    while True:
        blocks = tiers[-1].select("tree", "pos", "node", F.expr(f"pos div {size}").alias("block"))
        tiers.append(reliable(blocks.groupBy("tree", "block").applyInPandas(_up(fanout, height), NODES), "merkle"))
        if tiers[-1].where("pos > 0").isEmpty():
            return tiers


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
             text_col: str = "text", fanout: int = FANOUT, height: int = HEIGHT, tampered: Column | None = None) -> DataFrame:
    """Per row ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the hash of ``columns``. The leaves of a source ascend by id (null first, then by leaf); repeated rows are
    leaves each, and equal leaves are interchangeable. A null source is a source of its own, before all others. ``tampered`` says whose
    text is shown to the check in lower case (default: the ids whose CRC-32 five divides; a null id never, a null text stays
    null). An empty table gives no rows. Columns beyond ``columns`` are not read, whatever their names.
    """
    prepare(docs.sparkSession)
    key = F.col(id_col).cast("long")
    if tampered is None:
        tampered = F.crc32(key.cast("string").cast("binary")) % TAMPER == 0
    shown = [F.translate(c, _UPPER, _LOWER) if c == text_col else F.col(c) for c in columns]
    leaf = leaf_hash(*[F.col(c) for c in columns])
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # null first, then by bytes; never TOP
    leaves = reliable(docs.select(tree.alias("tree"), key.alias("doc_id"), leaf.alias("node"), F.when(tampered, leaf_hash(*shown)).otherwise(leaf).alias("shown")), "leaves")
    leaves = places(leaves, "tree", [F.col("doc_id").asc_nulls_first(), F.col("node")])
    sources = _tiers(leaves, fanout, height)
    top = places(sources.pop().select("tree", "node", F.lit(TOP).alias("top")), "top", [F.col("tree")])
    top = top.select(F.col("top").alias("tree"), "pos", "node", F.col("tree").alias("below"), F.lit(0).cast("long").alias("below_block"))
    tops = _tiers(top, fanout, height)
    root = tops.pop().select("tree", F.lit(0).cast("long").alias("block"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("before"), F.col("node").alias("behind"))
    inner = [t.select("tree", "pos", "node", F.col("tree").alias("below"), F.col("pos").alias("below_block")) for t in (*sources[1:], *tops[1:])]
    size, outer = fanout ** height, root

    def meet(nodes: DataFrame, outer: DataFrame, fn, schema: str) -> DataFrame:
        blocks = nodes.withColumn("block", F.expr(f"pos div {size}"))
        return blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(fn, schema)

    for nodes in [*inner[len(sources) - 1:][::-1], top, *inner[:len(sources) - 1][::-1]]:
        outer = reliable(meet(nodes, outer, _down(fanout, height), OUTER), "outer")
    return meet(leaves.select("tree", "pos", "doc_id", "node", "shown"), outer, _prove(fanout, height), PROOFS)
