"""A Merkle manifest of a table, its trees stored in van Emde Boas layout.

Every group of rows (a language) is a tree whose nodes have eight children; the roots of all groups are
the leaves of one more tree. A tree is cut into aligned blocks of ``8 ** HEIGHT`` leaves, each one row of
a written table. The nodes of a block lie in one array in van Emde Boas order: the block is split at half
its height, first the upper part, then the lower parts from left to right, each laid out in the
same way. ``address`` computes the place of any node without a table, and the same arithmetic serves for
building a block and for reading the siblings on a path, so a path touches few neighbouring stretches
of the array whatever the size of a cache line. The roots of the blocks are the leaves of the next tier, until
a group has one block.

Work per tier is one shuffle of 32-byte digests by block. Leaves get their place in the group from
running totals over ranges, so no group is ever in one task, and a block bounds what a task holds.

``H`` is the lower-case hexadecimal SHA-256 of its inputs one after another, digests as hexadecimal text.

Defined results: null values are ``-`` in a leaf; rows with the same id are ordered by their leaf, so
repeated rows have equal leaves and neighbouring places; null ids and null groups come first; a group of one row
has its leaf as its root; an empty table has no rows; columns other than the five are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.tables import ship
from propensa.operators.running import Running, running_totals
from propensa.session import stored

ARITY = 8
HEIGHT = 4  # levels of a block above its leaves: 4,096 leaves, 150 KB of nodes
DIGEST = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODES = "tree long, block long, n long, size long, height int, nodes binary, root binary"
PATHS = "tree long, block long, path binary, turns binary"


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """Binary digest of a row: each value as its byte count, a colon and the value, ``-`` for null."""
    values = [c.cast("string") for c in (doc_id, source, lang, n_chars, text)]
    written = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*written), 256))


def tampered(doc_id: Column) -> Column:
    """Whether a row's text is changed: 3 divides the unsigned CRC-32 of its decimal id (never for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))


# --- the layout ---------------------------------------------------------------------------------------------------


def n_nodes(leaves: np.ndarray | int, levels: int) -> np.ndarray | int:
    """Nodes of ``levels`` levels over ``leaves`` leaves filled from the left."""
    return sum(-(-leaves // ARITY**level) for level in range(levels))


def address(leaves: np.ndarray | int, levels: int, level: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Places of nodes (``level`` from the leaves up, ``index`` from the left) in the array of a tree.

    The tree has ``levels`` levels and ``leaves`` leaves, filled from the left. Its lower half is cut into subtrees
    of ``levels // 2`` levels, which are complete but for the last; the part above them comes first.
    """
    level, index = np.asarray(level), np.asarray(index)
    leaves = np.broadcast_to(np.asarray(leaves), index.shape)
    if levels <= 1:
        return index.astype(np.int64)
    low = levels // 2
    width = ARITY ** (low - 1)  # leaves of a lower subtree
    out = np.empty(index.shape, np.int64)
    above = level >= low
    tops = -(-leaves // width)  # lower subtrees
    upper_leaves = -(-tops // ARITY)
    out[above] = address(upper_leaves[above], levels - low, level[above] - low, index[above])
    below = ~above
    subtree = index[below] // ARITY ** (low - 1 - level[below])
    own = np.minimum(width, leaves[below] - subtree * width)
    start = n_nodes(upper_leaves[below], levels - low) + subtree * n_nodes(width, low)
    out[below] = start + address(own, low, level[below], index[below] - subtree * ARITY ** (low - 1 - level[below]))
    return out


def height_of(leaves: int) -> int:
    """Levels above the leaves until one node is left."""
    height = 0
    while leaves > 1:
        leaves, height = -(-leaves // ARITY), height + 1
    return height


def build(leaves: list[bytes], height: int) -> bytes:
    """Nodes of a block as one array in van Emde Boas order."""
    array = np.zeros((n_nodes(len(leaves), height + 1), DIGEST), np.uint8)
    nodes = leaves
    for level in range(height + 1):
        if level:
            texts = [n.hex() for n in nodes]
            nodes = [hashlib.sha256("".join(texts[i:i + ARITY]).encode()).digest() for i in range(0, len(texts), ARITY)]
        place = address(len(leaves), height + 1, np.full(len(nodes), level), np.arange(len(nodes)))
        array[place] = np.frombuffer(b"".join(nodes), np.uint8).reshape(-1, DIGEST)
    return array.tobytes()


def root_of(nodes: bytes, leaves: int, height: int) -> bytes:
    at = int(address(leaves, height + 1, np.array([height]), np.array([0]))[0])
    return nodes[DIGEST * at:DIGEST * (at + 1)]


def siblings(nodes: bytes, leaves: int, height: int, of: np.ndarray) -> list[tuple[bytes, bytes]]:
    """For each leaf in ``of``: the digests of its siblings level by level, and per level how many are left and right of the path.

    Both are bytes: the digests one after another, and two counts for each level.
    """
    array = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    parts: list[list[bytes]] = [[] for _ in of]
    turns: list[list[int]] = [[] for _ in of]
    for level in range(height):
        width = -(-leaves // ARITY**level)
        at = of // ARITY**level
        run = at // ARITY * ARITY
        members = run[:, None] + np.arange(ARITY)[None, :]
        inside = members < width
        place = address(leaves, height + 1, np.full(inside.sum(), level), members[inside])
        digests = np.zeros((*members.shape, DIGEST), np.uint8)
        digests[inside] = array[place]
        sizes, own = inside.sum(axis=1).tolist(), (at - run).tolist()
        for i, (size, left) in enumerate(zip(sizes, own, strict=True)):
            raw = digests[i].tobytes()
            parts[i].append(raw[:DIGEST * left] + raw[DIGEST * (left + 1):DIGEST * size])
            turns[i] += (left, size - left - 1)
    return [(b"".join(p), bytes(t)) for p, t in zip(parts, turns, strict=True)]


def fold(node: bytes, path: bytes, turns: bytes) -> bytes:
    """The digest at the end of a path, recomputed from a node and the siblings on its way."""
    at, text, hexed = 0, node.hex(), path.hex()
    for left, right in zip(turns[::2], turns[1::2], strict=True):
        middle, end = at + 2 * DIGEST * left, at + 2 * DIGEST * (left + right)
        text = hashlib.sha256((hexed[at:middle] + text + hexed[middle:end]).encode()).hexdigest()
        at = end
    return bytes.fromhex(text)


# --- trees over tables --------------------------------------------------------------------------------------------


def _batch(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*[f.split() for f in schema.split(", ")], strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def tiers(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Blocks over ``leaves`` (tree, rank, size, digest), and over their roots, until each tree has one root.

    ``rank`` counts a tree's leaves from 0, ``size`` is their number. Each tier is a written table of blocks; their
    number is the logarithm of the largest tree's leaves to the base of a block's.
    """
    width = ARITY**height

    def built(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        digests, size = group.column("digest").to_pylist(), group.column("size")[0].as_py()
        own = min(height, height_of(size))
        nodes = build(digests, own)
        tree, block = group.column("tree")[0].as_py(), group.column("block")[0].as_py()
        return _batch(NODES, [(tree, block, len(digests), size, own, nodes, root_of(nodes, len(digests), own))])

    found = []
    while True:
        dealt = leaves.select("tree", F.expr(f"rank div {width}").alias("block"), "rank", "size", "digest")
        blocks = stored(dealt.groupBy("tree", "block").applyInArrow(built, NODES))
        found.append(blocks)
        if (blocks.agg(F.max("block")).first()[0] or 0) == 0:
            return found
        # Trees that are finished stay as blocks of one leaf: their root is the digest itself.
        size = F.expr(f"(size + {width - 1}) div {width}")
        leaves = blocks.select("tree", F.col("block").alias("rank"), size.alias("size"), F.col("root").alias("digest"))


def roots(found: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    return found[-1].select("tree", "root")


def paths(found: list[DataFrame], top: DataFrame, height: int) -> DataFrame:
    """Path to the root (tree, block, path, turns) of every leaf of the tiers ``found``, with the leaf's place as ``block``,
    given the paths (tree, path, turns) of the trees' own roots. A path is short: seven digests a level."""
    width = ARITY**height

    def descended(blocks: pa.Table, above: pa.Table) -> pa.Table:
        block, path = blocks.to_pylist()[0], above.to_pylist()[0]
        own = siblings(block["nodes"], block["n"], block["height"], np.arange(block["n"]))
        return _batch(PATHS, [(block["tree"], block["block"] * width + i, inside + path["path"], turns + path["turns"])
                              for i, (inside, turns) in enumerate(own)])

    known = top.select("tree", F.lit(0).cast("long").alias("block"), "path", "turns")
    for blocks in reversed(found):
        known = stored(blocks.groupBy("tree", "block").cogroup(known.groupBy("tree", "block")).applyInArrow(descended, PATHS))
    return known


VERIFIED = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verifier(height: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def prove(rows: pa.Table, block: pa.Table) -> pa.Table:
        """The leaves of one block: siblings read at their addresses, hashes folded up to the root."""
        kept = block.to_pylist()[0]
        leaves, changed = rows.column("digest").to_pylist(), rows.column("changed").to_pylist()
        found = siblings(kept["nodes"], kept["n"], kept["height"], rows.column("rank").to_numpy() - kept["block"] * ARITY**height)
        root, above = kept["top"].hex(), kept["path"].hex()
        proofs, folded = [], []
        for digest, other, (own, turns) in zip(leaves, changed, found, strict=True):
            proofs.append(hashlib.sha256((own.hex() + above).encode()).hexdigest())
            folded.append(fold(fold(other or digest, own, turns), kept["path"], kept["turns"]).hex())
        n = len(leaves)
        return pa.table({
            "id": rows.column("id"), "leaf": pa.array([d.hex() for d in leaves]), "subroot": pa.array([kept["subroot"].hex()] * n),
            "root": pa.array([root] * n), "proof_sha256": pa.array(proofs), "folded_root": pa.array(folded),
            "verified": pa.array([f == root for f in folded], pa.bool_())})

    return prove


def ranked(leaves: DataFrame) -> DataFrame:
    """Leaves (lang, id, digest, changed) with ``rank`` from 0 and ``size`` in their group, by id, then digest. Written once.

    A repeated row is counted in one place of the order and then given places one by one.
    """
    counted = leaves.groupBy("lang", "id", "digest").agg(F.first("changed").alias("changed"), F.count(F.lit(1)).alias("times"))
    totals = running_totals(counted, ["id", "digest"], Running(sums={"upto": "times"}, totals={"size": "times"}), ["lang"])
    places = F.explode(F.sequence(F.col("upto") - F.col("times"), F.col("upto") - 1))
    return totals.select("lang", "id", "digest", "changed", "size", places.alias("rank"))


@dataclass(frozen=True)
class Manifest:
    """Trees of a written table: its leaves, the blocks of all tiers, the tree of the groups, and the root."""

    leaves: DataFrame
    groups: list[DataFrame]
    top: list[DataFrame]
    height: int


def manifest(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    """Build the trees of ``docs`` (doc_id, source, lang, n_chars, text) by language and over the languages.

    Leaves also carry ``changed``: the digest after tampering, for the rows that are tampered with.
    """
    ship(docs.sparkSession)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    own = docs.select(
        "lang", fields[0].cast("long").alias("id"), leaf(*fields, text).alias("digest"),
        F.when(tampered(fields[0]), leaf(*fields, F.translate(text, UPPER, LOWER))).alias("changed"))
    placed = ranked(own)
    # One row per language, numbered in the order of their bytes with null first.
    langs = placed.groupBy("lang").agg(F.max("size").alias("size"))
    bytes_of = langs.select("lang", F.coalesce(F.hex(F.encode("lang", "utf-8")), F.lit("")).alias("by"),
                            F.when(F.col("lang").isNull(), 0).otherwise(1).cast("long").alias("some"), F.lit(1).cast("long").alias("one"))
    order = running_totals(bytes_of, ["some", "by"], Running(sums={"tree": "one"}, totals={"n": "one"}))
    order = stored(order.select(F.col("lang").alias("_lang"), (F.col("tree") - 1).alias("tree"), "n"))
    numbered = placed.join(order, placed["lang"].eqNullSafe(order["_lang"]))
    leaves = stored(numbered.select("tree", "n", "rank", "size", "id", "digest", "changed"))
    groups = tiers(leaves.select("tree", "rank", "size", "digest"), height)
    sizes = order.select("tree", "n")
    upper = roots(groups).join(sizes, "tree").select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.col("n").alias("size"), F.col("root").alias("digest"))
    return Manifest(leaves, groups, tiers(upper, height), height)


def verify(made: Manifest) -> DataFrame:
    """Per row: id, leaf, subroot, root, proof_sha256, folded_root, verified. The path is folded from the changed leaf if there is one."""
    none = F.lit(bytearray())
    langs = paths(made.top, roots(made.top).select("tree", none.alias("path"), none.alias("turns")), made.height)
    blocks = paths(made.groups[1:], langs.select(F.col("block").alias("tree"), "path", "turns"), made.height)
    subroots = roots(made.groups).select("tree", F.col("root").alias("subroot"))
    top = roots(made.top).select(F.col("root").alias("top"))  # one row
    lowest = made.groups[0].drop("root").join(blocks, ["tree", "block"]).join(subroots, "tree").crossJoin(F.broadcast(top))
    rows = made.leaves.select("tree", F.expr(f"rank div {ARITY**made.height}").alias("block"), "rank", "id", "digest", "changed")
    return rows.groupBy("tree", "block").cogroup(lowest.groupBy("tree", "block")).applyInArrow(_verifier(made.height), VERIFIED)
