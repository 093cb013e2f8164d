"""Op 11. Merkle dataset manifest with octopus multiproofs.

Every row is a leaf; leaves are grouped into one tree per value of a column
(their subroots form one more tree, whose root names the dataset). Two
consecutive nodes are hashed into one of the next level; the last of an odd
level is hashed alone.

* Positions: leaves are range-partitioned by (tree, id, leaf), so a tree that
  holds most rows is spread like any other; a position is the rank within a
  range plus the sizes of the ranges before it.
* Nodes: blocks of 2**LEVELS consecutive nodes are folded ``LEVELS`` levels
  up at a time, so a group never holds more, and a table of 10**10 leaves
  takes four rounds. Only nodes that a block may lack are stored.
* Multiproof: a leaf partition is one such block of leaves. It works out
  which node coordinates its leaves' proofs lack once all that can be derived
  from its own leaves is left out (``octopus``), fetches those in one join,
  derives the shared interior nodes, and expands the single proofs locally.
  A node near the root is lacked by very many blocks: requests are salted, so
  each copy of a node answers about ``FETCHES`` of them.

Defined cases: a null field is hashed as ``-``, an empty one as ``0:``; texts
are hashed whole; null ids come first; rows that share (tree, id) are ordered
by leaf; repeated rows are leaves each for itself; the tree of the null value
comes first; a tree of one leaf has that leaf as its subroot; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oddsline.llm.common import bucket, written

LEVELS = 10     # a block holds 2**LEVELS nodes
FETCHES = 1024  # requests that one copy of a node answers, about
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = ""        # the tree of subroots; other trees' keys start with 0 (null) or 1

NODE = "tree string, level int, index long, n long, digest binary, root boolean"


def digest(data: bytes) -> bytes:
    """SHA-256 as lowercase hexadecimal text."""
    return sha256(data).hexdigest().encode()


def leaf(*values: Column) -> Column:
    """The leaf of these values (strings), as 32 bytes."""
    parts = [F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)) for v in values]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    return max(n - 1, 0).bit_length()


def width(n: int, level: int) -> int:
    """Nodes at a level of a tree of n leaves."""
    return (n + (1 << level) - 1) >> level


# ------------------------------------------------------------------ positions and nodes

def located(rows: DataFrame, *order: str) -> DataFrame:
    """The rows with their position ``at`` in their tree's order and the tree's size ``n``."""
    ranged = rows.withColumn("_salt", F.monotonically_increasing_id())  # spreads repeated rows
    placed = written(ranged.repartitionByRange("tree", *order, "_salt").drop("_salt")
                     .withColumn("part", F.spark_partition_id()), "merkle-ranges")
    sizes = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"))  # a row per range and tree
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
                          F.sum("rows").over(Window.partitionBy("tree")).alias("n"))
    rank = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)) - 1
    return placed.withColumn("rank", rank).join(starts, ["tree", "part"]) \
        .withColumn("at", F.col("start") + F.col("rank")).drop("part", "rank", "start")


def _rise(level: int, least: int, levels: int):
    """Folds a block of nodes of ``level`` up; nodes below ``least`` that are no root aren't returned."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("index")
        n, tree = int(pdf["n"].iloc[0]), pdf["tree"].iloc[0]
        now, first, top = [bytes(d).hex().encode() for d in pdf["digest"]], int(pdf["index"].iloc[0]), height(n)
        out: list[tuple] = []

        def keep(at):
            if at >= least or at == top:
                out.extend((tree, at, first + k, n, bytes.fromhex(d.decode()), at == top) for k, d in enumerate(now))

        if not level:
            keep(0)
        for at in range(level + 1, min(level + levels, top) + 1):
            now, first = [digest(b"".join(now[k : k + 2])) for k in range(0, len(now), 2)], first >> 1
            keep(at)
        return pd.DataFrame(out, columns=["tree", "level", "index", "n", "digest", "root"])

    return run


def nodes(rows: DataFrame, least: int, levels: int) -> DataFrame:
    """The nodes of level ``least`` and above, and every root, of the trees of
    ``rows`` (tree, at, n, digest)."""
    most = rows.agg(F.max("n")).first()[0] or 0
    now, out = rows.select("tree", F.col("at").alias("index"), "n", "digest"), None
    for level in range(0, max(height(most), 1), levels):
        grown = written(now.groupBy("tree", F.shiftright("index", levels)).applyInPandas(_rise(level, least, levels), NODE), "merkle-nodes")
        out = grown if out is None else out.union(grown)
        now = grown.where((F.col("level") == level + levels) & ~F.col("root")).select("tree", "index", "n", "digest")
    return out


# ------------------------------------------------------------------ multiproofs

def octopus(known: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Coordinates (level, index) of the fewest nodes that, with the leaves at
    ``known``, give every proof of theirs in a tree of n leaves."""
    out, known = [], np.unique(known)
    for level in range(height(n)):
        other = known ^ 1
        lacks = other[(other < width(n, level)) & ~np.isin(other, known)]
        out += [(level, i) for i in lacks.tolist()]
        known = np.unique(known >> 1)
    return out


def climb(known: dict[int, bytes], fetched: dict[int, dict[int, bytes]], n: int) -> list[dict[int, bytes]]:
    """Nodes by level, from leaves and fetched nodes: all that the leaves' proofs take."""
    levels = []
    for level in range(height(n)):
        now = known | fetched.get(level, {})
        levels.append(now)
        known = {i: digest(now[2 * i] + (now[2 * i + 1] if 2 * i + 1 < width(n, level) else b""))
                 for i in {k >> 1 for k in known}}
    return [*levels, known]


def chains(levels: list[dict[int, bytes]], known, above: bytes) -> dict[int, bytes]:
    """Each leaf's siblings, level by level, in one text that ends in ``above``."""
    paths = [set(known)]
    for _ in levels[1:]:
        paths.append({k >> 1 for k in paths[-1]})
    out = {0: above}
    for now, path in zip(levels[-2::-1], paths[-2::-1], strict=True):
        out = {i: now.get(i ^ 1, b"") + out[i >> 1] for i in path}
    return out


def fold(start: bytes, at: int, levels: list[dict[int, bytes]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for now in levels[:-1]:
        other = now.get(at ^ 1, b"")
        start = digest(other + start if at & 1 else start + other)
        at >>= 1
    return start


PROVED = "doc_id long, leaf string, subroot string, root string, proof string, proof_sha256 string, folded_root string"


def _expand(proofs: bool):
    def run(leaves: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(leaves):
            return pd.DataFrame(columns=[c.split()[0] for c in PROVED.split(", ")])
        fetched: dict[bool, dict[int, dict[int, bytes]]] = {True: {}, False: {}}
        for of, level, index, d in zip(got["of"], got["level"], got["index"], got["digest"], strict=True):
            fetched[of == TOP].setdefault(int(level), {})[int(index)] = bytes(d).hex().encode()
        at, n, tree_at, trees = (leaves[c].astype("int64") for c in ("at", "n", "tree_at", "trees"))
        own = {i: bytes(d).hex().encode() for i, d in zip(at.tolist(), leaves["digest"], strict=True)}
        levels = climb(own, fetched[False], int(n.iloc[0]))
        place = int(tree_at.iloc[0])
        upper = climb({place: levels[-1][0]}, fetched[True], int(trees.iloc[0]))
        chain = chains(levels, own, chains(upper, [place], b"")[place])
        rows = []
        for doc, i, changed in zip(leaves["doc_id"], at.tolist(), leaves["tampered"], strict=True):
            start = own[i] if changed is None else bytes(changed).hex().encode()
            folded = fold(fold(start, i, levels), place, upper)
            rows.append((doc, own[i].decode(), levels[-1][0].decode(), upper[-1][0].decode(),
                         chain[i].decode() if proofs else None, digest(chain[i]).decode(), folded.decode()))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in PROVED.split(", ")])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def _requests(levels: int):
    """The coordinates that each leaf partition lacks, in its own tree and in the tree of subroots."""
    def run(pdfs):
        for pdf in pdfs:
            rows = []
            for tree, block, n, tree_at, trees in zip(*(pdf[c] for c in ("tree", "block", "n", "tree_at", "trees")), strict=True):
                mine = np.arange(block << levels, min(n, (block + 1) << levels))
                for of, lacks in ((tree, octopus(mine, int(n))), (TOP, octopus(np.array([tree_at]), int(trees)))):
                    rows += [(tree, block, of, level, index) for level, index in lacks]
            yield pd.DataFrame(rows, columns=["tree", "block", "of", "level", "index"])

    return run


class Manifest:
    """A dataset's trees: leaves (tree, doc_id, digest, tampered, at, n) and
    nodes (tree, level, index, n, digest, root), written in the shared folder."""

    def __init__(self, leaves: DataFrame, levels: int = LEVELS):
        """``leaves``: tree, doc_id, digest, tampered (a changed leaf, or null).
        A leaf partition holds 2**levels of them."""
        self.levels = levels
        first = written(leaves, "merkle-leaves")  # range partitioning reads it twice
        self.leaves = written(located(first, "doc_id", "digest"), "merkle-positions")
        self.nodes = nodes(self.leaves, levels, levels)
        roots = self.nodes.where("root").select(F.lit(TOP).alias("tree"), F.col("tree").alias("key"), "digest")
        self.trees = written(located(roots, "key"), "merkle-trees")
        self.upper = nodes(self.trees, 0, levels)

    @property
    def root(self) -> str | None:
        row = self.upper.where("root").select(F.lower(F.hex("digest")).alias("root")).first()
        return row and row["root"]

    def proofs(self, full: bool = True) -> DataFrame:
        """Every leaf's proof: PROVED (``proof``, the siblings' text, only if ``full``)."""
        block = F.shiftright("at", self.levels).alias("block")
        place = self.trees.select(F.col("key").alias("tree"), F.col("at").alias("tree_at"), F.col("n").alias("trees"))
        blocks = written(self.leaves.groupBy("tree", block).agg(F.max("n").alias("n")).join(place, "tree"), "merkle-blocks")
        salts = max(1, -(-blocks.count() // FETCHES))
        coordinate = ["of", "level", "index", "salt"]
        asked = written(blocks.mapInPandas(_requests(self.levels), "tree string, block long, of string, level int, index long")
                        .withColumn("salt", bucket(salts, "tree", "block")), "merkle-requests")
        stored = self.nodes.union(self.upper).select(F.col("tree").alias("of"), "level", "index", "digest")
        copies = asked.select(*coordinate).distinct().join(stored, coordinate[:3])
        got = asked.join(copies, coordinate).select("tree", "block", "of", "level", "index", "digest")
        mine = self.leaves.withColumn("block", block).join(blocks.select("tree", "block", "tree_at", "trees"), ["tree", "block"])
        return mine.groupBy("tree", "block").cogroup(got.groupBy("tree", "block")).applyInPandas(
            _expand(full), PROVED)


def tampered(doc_id: Column) -> Column:
    """Which leaves are tampered with (fixed rule: 7 divides the crc32 of the decimal id)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 0, F.lit(False))


def document_leaves(docs: DataFrame) -> DataFrame:
    """Leaves of the documents table; the tampered ones have n_chars raised by one."""
    value = {c: F.col(c).cast("string") for c in FIELDS}
    raised = value | {"n_chars": (F.col("n_chars").cast("decimal(38,0)") + 1).cast("string")}
    changed = tampered(F.col("doc_id")) & F.col("n_chars").isNotNull()
    return docs.select(
        F.coalesce(F.concat(F.lit("1"), value["lang"]), F.lit("0")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf(*value.values()).alias("digest"), F.when(changed, leaf(*raised.values())).alias("tampered"))


def audit(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    return Manifest(document_leaves(docs), levels).proofs(full=False).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
