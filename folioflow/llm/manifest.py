"""Merkle manifest of a dataset, with proofs that are checked against it.

A row's leaf is the digest of its fields; 16 consecutive nodes of a source make the next level's, until one
is left, its subroot; the subroots make the root likewise. Leaves are placed by a distributed sort, so a source
of any size spreads over tasks.

Cogrouped subtree exchange: 4,096 consecutive nodes are a superblock, whose three levels fit one task. Going
up, each superblock is reduced to its top, and the tops are the next table: three tables hold 68 billion rows.
Coming down, the nodes of a superblock are cogrouped with the one row of nodes outside it that their proofs need
(15 a level at most); one function finishes the reduction, joins inner and outer siblings to proofs and folds
them. What it gives for the members of an upper superblock are the outer rows of the superblocks below.

Edge cases: a null field is `-` in its leaf; rows without an id come first in their source and are never
altered; equal ids of a source stand in the order of their digests; a null source is a source of its own, before all others; repeated
rows are leaves of their own; an empty table has no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.llm.ordering import numbered
from folioflow.session import ship_package, stored

FAN, LEVELS = 16, 3
HEX = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# shape: (place, size) of the run at each level, a byte each; others: the siblings in hex, level by level.
OUTER = "branch string, block long, shape binary, others binary, subroot string, root string"
ROWS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def leaf(fields: list[Column]) -> Column:
    """Digest (32 bytes) of fields, each with its length, so that no two rows run together."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def levels(nodes: list[bytes], first: bool, height: int) -> list[list[bytes]]:
    """The nodes of a superblock and those above them, up to its top, `height` levels up at most.

    The first superblock of a tree may be all of it and ends as soon as one node is left; any other is
    followed up to the top, through runs of one as well.
    """
    out = [nodes]
    while len(out[-1]) > 1 or not first and len(out) <= height:
        below = out[-1]
        out.append([digest(b"".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def siblings(tree: list[list[bytes]], at: int, shape: bytes, others: bytes) -> tuple[bytes, bytes]:
    """Shape and siblings from the node `at` of the lowest level to the root: those in the tree, then those outside it."""
    shapes, found = [], []
    for nodes in tree[:-1]:
        run = nodes[at - at % FAN : at - at % FAN + FAN]
        shapes += [at % FAN, len(run)]
        found += run[: at % FAN] + run[at % FAN + 1 :]
        at //= FAN
    return bytes(shapes) + shape, b"".join(found) + others


def fold(node: bytes, shape: bytes, others: bytes) -> bytes:
    """The root that a node and its siblings give."""
    at = 0
    for place, size in zip(shape[::2], shape[1::2]):
        end = at + HEX * (size - 1)
        cut = at + HEX * place
        node = digest(others[at:cut] + node + others[cut:end])
        at = end
    return node


def _members(rows: pd.DataFrame, outer: pd.DataFrame, height: int):
    """(members in order, their hex digests, tree, the outer row) of a cogroup."""
    rows = rows.sort_values("pos", ignore_index=True)
    nodes = [bytes(d).hex().encode() for d in rows["digest"]]
    return rows, nodes, levels(nodes, int(rows["block"].iloc[0]) == 0, height), outer.iloc[0]


def _descend(height: int, subroots: bool):
    """The outer row of each superblock that a member of this one is the top of; if they are subroots, of each source."""

    def step(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, nodes, tree, above = _members(rows, outer, height)
        paths = [siblings(tree, i, bytes(above["shape"]), bytes(above["others"])) for i in range(len(nodes))]
        named = [n.decode() for n in nodes] if subroots else above["subroot"]
        shapes, others = [p[0] for p in paths], [p[1] for p in paths]
        return pd.DataFrame({"branch": rows["below"], "block": rows["lower"], "shape": shapes, "others": others, "subroot": named, "root": above["root"]})

    return step


def _prove(height: int):
    """Proof and folded root of each leaf of a superblock."""

    def step(rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows, nodes, tree, above = _members(rows, outer, height)
        shape, others = bytes(above["shape"]), bytes(above["others"])
        alone = len(tree) == 1  # a source of one row: its leaf is its subroot
        proofs, folded = [], []
        for start in range(0, len(nodes), FAN):
            run = nodes[start : start + FAN]
            # What lies above a run is the same for all of it.
            upper, beyond = (shape, others) if alone else siblings(tree[1:], start // FAN, shape, others)
            roots: dict[bytes, bytes] = {}
            for place, changed in enumerate(rows["altered"].iloc[start : start + len(run)]):
                node = run[place] if changed is None else bytes(changed).hex().encode()
                before, after = run[:place], run[place + 1 :]
                proofs.append(digest(b"".join([*before, *after, beyond])).decode())
                up = node if alone else digest(b"".join([*before, node, *after]))
                if up not in roots:
                    roots[up] = fold(up, upper, beyond)
                folded.append(roots[up].decode())
        leaves = [n.decode() for n in nodes]
        return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": leaves, "subroot": above["subroot"], "root": above["root"], "proof_sha256": proofs, "folded_root": folded})

    return step


def _tops(nodes: DataFrame, height: int) -> DataFrame:
    """The top of each superblock: branch, pos (its number), digest."""
    ship_package(nodes.sparkSession)

    def reduce(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("pos").to_numpy())
        block = table.column("block")[0].as_py()
        digests = table.column("digest").take(pa.array(order)).to_pylist()
        top = levels([d.hex().encode() for d in digests], block == 0, height)[-1][0]
        return pa.table({"branch": pa.array([table.column("branch")[0].as_py()], pa.string()), "pos": pa.array([block], pa.int64()), "digest": pa.array([bytes.fromhex(top.decode())], pa.binary())})

    return nodes.groupBy("branch", "block").applyInArrow(reduce, "branch string, pos long, digest binary")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / FAN**height).cast("long"))


def _tree(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Tables of nodes (branch, pos, block, digest), each holding the superblock tops of the one before; the last has one row a branch."""
    tables = [leaves.select("branch", "pos", "block", "digest")]
    while True:
        tops = stored(_blocks(_tops(tables[-1], height), height))
        tables.append(tops)
        if not tops.where("pos > 0").head(1):
            return tables


def _down(nodes: DataFrame, outer: DataFrame, height: int, subroots: bool = False) -> DataFrame:
    """The outer rows one table further down. A node is the top of superblock `pos` of its branch, a subroot that of a source's first one."""
    below = (F.col("below"), F.lit(0).cast("long")) if subroots else (F.col("branch"), F.col("pos"))
    members = nodes.withColumns({"below": below[0], "lower": below[1]})
    keys = ["branch", "block"]
    return stored(members.groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(_descend(height, subroots), OUTER))


def manifest(docs: DataFrame, altered: Column | None = None, height: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, one row per input row.

    `altered`: the text found later, where it is to be checked; null elsewhere. Its leaf is folded with the
    siblings of the dataset as it was, and is verified if that gives the dataset's root. `height`: levels of a superblock.
    """
    ship_package(docs.sparkSession)
    kinds = {"doc_id": "long", "n_chars": "long"}
    field = {c: F.col(c).cast(kinds.get(c, "string")) for c in FIELDS}
    changed = F.lit(None).cast("string") if altered is None else altered
    read = docs.select(*[field[c].alias(c) for c in FIELDS], changed.alias("altered"))
    own = [F.col(c) for c in FIELDS]
    rows = read.select(
        "doc_id",
        # A source is told from no source, and sorts after it.
        F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("")).alias("branch"),
        leaf(own).alias("digest"),
        F.when(F.col("altered").isNotNull(), leaf([*own[:-1], F.col("altered")])).alias("altered"),
    )
    leaves = stored(_blocks(numbered(rows, "branch", ["doc_id", "digest"]), height))
    branches = _tree(leaves, height)

    subroots = branches[-1].select(F.lit("").alias("trunk"), F.col("branch").alias("below"), "digest")
    sources = stored(_blocks(numbered(subroots, "trunk", ["below"]).withColumnRenamed("trunk", "branch"), height))
    trunk = _tree(sources, height)

    none, nothing = F.lit(None).cast("string").alias("subroot"), F.lit(b"")
    root = F.lower(F.hex("digest")).alias("root")
    outer = trunk[-1].select("branch", F.lit(0).cast("long").alias("block"), nothing.alias("shape"), nothing.alias("others"), none, root)
    for nodes in reversed(trunk[1:-1]):
        outer = _down(nodes, outer, height)
    outer = _down(sources, outer, height, subroots=True)
    for nodes in reversed(branches[1:-1]):
        outer = _down(nodes, outer, height)

    members = leaves.withColumn("doc_id", F.col("doc_id").cast("string"))
    keys = ["branch", "block"]
    proved = members.groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(_prove(height), ROWS)
    names = [p.split()[0] for p in ROWS.split(", ")[1:]]
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return proved.select(F.col("doc_id").cast("long").alias("doc_id"), *names, verified)


def tampered(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The text in lower case (A-Z only) where 5 divides the CRC-32 of the decimal id; null elsewhere."""
    chosen = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(F.col(text).cast("string"), UPPER, LOWER))
