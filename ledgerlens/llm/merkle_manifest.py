"""Merkle dataset manifest on a persistent, path-copying tree.

The rows of each group are ranked across the cluster and cut into aligned blocks of leaves. One task
builds a block's tree of immutable nodes; a tampered leaf makes a version of it that copies the
leaf's ancestors inside the block and shares every other node. Block roots are the leaves of the next
level of blocks, and so on up to the group's root; the group roots are the leaves of one more tree.
A version goes on through the upper levels over the siblings that it shares with the original.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.operators.joins import bounded
from ledgerlens.session import materialize

BITS = 10  # a block holds 2**BITS aligned leaves


class Node(NamedTuple):
    digest: str
    left: Node | None = None
    right: Node | None = None


def parent(left: Node, right: Node | None) -> Node:
    return Node(hashlib.sha256((left.digest + (right.digest if right else "")).encode()).hexdigest(), left, right)


def build(leaves: Sequence[str], height: int) -> Node:
    """The tree over the leaves; an odd last node of a level is hashed alone."""
    level = [Node(x) for x in leaves]
    for _ in range(height):
        level = [parent(level[i], level[i + 1] if i + 1 < len(level) else None) for i in range(0, len(level), 2)]
    return level[0]


def version(node: Node, height: int, at: int, leaf: str) -> Node:
    """The tree with another leaf at a position: its ancestors are copied, all other nodes shared."""
    if not height:
        return Node(leaf)
    if at >> (height - 1) & 1:
        return parent(node.left, version(node.right, height - 1, at, leaf))
    return parent(version(node.left, height - 1, at, leaf), node.right)


def siblings(node: Node, height: int, at: int) -> list[str]:
    """From the leaf up: ``L`` or ``R`` and the digest of the sibling on that side, or nothing."""
    out = []
    for h in range(height - 1, -1, -1):
        right = at >> h & 1
        other = node.left if right else node.right
        out.append(("L" if right else "R") + other.digest if other else "")
        node = node.right if right else node.left
    return out[::-1]


_BUILT = "tree string, pos long, leaf string, path array<string>, root string, version string, id {id}"


def _build_fn(schema: pa.Schema):
    """Trees of the blocks of a partition whose rows come ordered by (tree, pos)."""

    def block(rows: list[tuple]) -> pa.RecordBatch:
        height = min(BITS, (rows[0][2] - 1).bit_length())
        top = build([r[3] for r in rows], height)
        inside = (1 << BITS) - 1
        out = [(tree, pos, leaf, siblings(top, height, pos & inside), None if pos & inside else top.digest,
                top.digest if changed in (None, leaf) else version(top, height, pos & inside, changed).digest, own)
               for tree, pos, _, leaf, changed, own in rows]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*out), schema)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (held[0][0], held[0][1] >> BITS) != (row[0], row[1] >> BITS):
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    return run


def _built(nodes: DataFrame) -> DataFrame:
    """One level of blocks over ``nodes`` (tree, pos, n, leaf, changed, id)."""
    id_type = nodes.schema["id"].dataType
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("leaf", pa.string()), ("path", pa.list_(pa.string())), ("root", pa.string()), ("version", pa.string()), ("id", to_arrow_type(id_type))])
    dealt = nodes.repartition(F.col("tree"), F.shiftright("pos", BITS)).sortWithinPartitions("tree", "pos")
    return materialize(dealt.select("tree", "pos", "n", "leaf", "changed", "id").mapInArrow(_build_fn(schema), _BUILT.format(id=id_type.simpleString())))


def _ranked(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with each row's position ``pos`` in its ``tree`` and the tree's size ``n``.

    Rows are range-partitioned by (tree, order, a row number), so neither a large tree nor a repeated
    row is one task; offsets come from the counts by partition."""
    keys = ["tree", *order]
    df = df.withColumn("_row", F.monotonically_increasing_id())
    at = materialize(df.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()))
    runs = at.groupBy(F.col("tree").alias("_tree"), F.shiftright("_at", 33).alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tree = Window.partitionBy("_tree")  # one row for each partition that holds a part of the tree
    runs = runs.withColumn("_before", F.sum("_rows").over(tree.orderBy("_part")) - F.col("_rows")).withColumn("n", F.sum("_rows").over(tree))
    placed = at.join(bounded(runs), (F.col("tree") == F.col("_tree")) & (F.shiftright("_at", 33) == F.col("_part")))
    return placed.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_row", "_at", "_tree", "_part", "_first", "_rows", "_before")


def _upper(built: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From the lowest blocks to the tree's root: (tree, block, up) with the siblings above each lowest block, and (tree, top)."""
    sizes = nodes.groupBy("tree").agg(F.max("n").alias("n"))
    level = built.where("root IS NOT NULL").select("tree", F.shiftright("pos", BITS).alias("pos"), F.col("root").alias("leaf"))
    paths = level.select("tree", F.col("pos").alias("block"), F.col("pos").alias("at"), F.array().cast("array<string>").alias("up"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    while most > 1 << BITS:
        most = -(-most >> BITS)
        sizes = sizes.withColumn("n", F.ceil(F.col("n") / F.lit(1 << BITS)).cast("long"))
        out = _built(level.join(sizes, "tree").select("tree", "pos", "n", "leaf", F.lit(None).cast("string").alias("changed"), F.lit(0).alias("id")))
        step = out.select("tree", F.col("pos").alias("at"), "path")
        paths = paths.join(step, ["tree", "at"]).select("tree", "block", F.shiftright("at", BITS).alias("at"), F.concat("up", "path").alias("up"))
        level = out.where("root IS NOT NULL").select("tree", F.shiftright("pos", BITS).alias("pos"), F.col("root").alias("leaf"))
    return paths.drop("at"), level.select("tree", F.col("leaf").alias("top"))


def row_digest(*values: Column) -> Column:
    """Digest of a row's values: ``-`` for a null, else UTF-8 byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def merkle_manifest(docs: DataFrame, leaf: Column, changed: Column, id_col: str = "doc_id", group_col: str = "lang") -> DataFrame:
    """(id, group, leaf, subroot, root, proof, folded_root) for each row of ``docs``.

    ``leaf`` is the row's digest and ``changed`` the digest of a tampered row (null or equal: not
    tampered). A group's leaves ascend by (id, leaf), a null id first; every two consecutive nodes
    become the digest of their concatenated digests, an odd last one alone, while more than one
    remains. Group roots, ordered by group (null first, bytewise), likewise give ``root``. ``proof``
    is the concatenated digests of the siblings from the leaf to the root; ``folded_root`` is the
    root of the row's own version of the tree: the original one where nothing was tampered.

    A null group is a group of its own, apart from an empty one. Rows that are there twice are two
    leaves; such equal leaves are interchangeable. Texts of any length are one digest, made in the
    scan. Only the named columns are read, so others may have any name. No rows give no rows.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = materialize(docs.select(F.col(id_col).alias("id"), tree.alias("tree"), leaf.alias("leaf"), F.nullif(changed, leaf).alias("changed")))
    nodes = _ranked(leaves, ["id", "leaf"])
    built = _built(nodes)
    paths, tops = _upper(built, nodes)

    groups = tops.select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("top").alias("leaf"), F.lit(None).cast("string").alias("changed"))
    groups = _ranked(groups, ["id"])
    top_built = _built(groups)
    top_paths, top = _upper(top_built, groups)
    over = top_built.select(F.col("id").alias("tree"), F.shiftright("pos", BITS).alias("block"), F.col("path").alias("top_path")).join(
        top_paths.select("block", F.col("up").alias("top_up")), "block").select("tree", F.concat("top_path", "top_up").alias("top_path"))
    up = paths.join(tops, "tree").join(over, "tree").crossJoin(F.broadcast(top.select(F.col("top").alias("root_all"))))
    up = materialize(up.select(F.col("tree").alias("up_tree"), F.col("block").alias("up_block"), F.concat("up", "top_path").alias("up"), F.col("top").alias("subroot"), "root_all"))

    joined = built.join(bounded(up), (F.col("tree") == F.col("up_tree")) & (F.shiftright("pos", BITS) == F.col("up_block")))
    digest = lambda x: F.substring(x, 2, 64)
    folded = F.aggregate("up", F.col("version"), lambda acc, x: F.sha2(F.when(x.startswith("L"), F.concat(digest(x), acc)).otherwise(F.concat(acc, digest(x))), 256))
    return joined.select(
        F.col("id").alias(id_col), F.when(F.col("tree") != "", F.substring("tree", 2, (1 << 31) - 1)).alias(group_col), "leaf", "subroot",
        F.col("root_all").alias("root"), F.array_join(F.transform(F.concat("path", "up"), digest), "").alias("proof"), folded.alias("folded_root"))


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` rows (doc_id, source, lang, n_chars, text) in which every row
    whose id's crc32 seven divides has been tampered with: one was added to its ``n_chars``."""
    value = lambda n: row_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = F.when(hit & F.col("n_chars").isNotNull(), value(F.col("n_chars").cast("decimal(20,0)") + 1))
    out = merkle_manifest(docs, value(F.col("n_chars")), changed)
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
