"""Merkle manifest of a dataset: a hash tree per group, one over the groups, and versions by path copying.

A leaf is the digest of a row's fields. In a group, leaves stand in the order of their keys; every ``WIDTH``
consecutive nodes become the digest of their joined hexadecimal digests until one is left, and the groups'
last nodes become the dataset's root in the same way.

The tree is cut into aligned blocks of some levels, one row each, so a group of any size is many rows. A
block gives the level above one node; that level is cut into blocks again, until a tree has one block. Paths
then come down: a block hears the siblings above it and hands its members theirs.

A changed leaf makes a version of the tree. It shares all untouched nodes and copies only the ancestors of
the leaf, first within its block, then in the blocks above, of which it needs the siblings alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from canopy.llm.batches import bound_batches
from canopy.operators.ranking import chunked
from canopy.session import cut_lineage

WIDTH = 16
LEVELS = 3                      # of a block: 4,096 nodes
ROWS_OUT = 128                  # rows handed on at a time: each carries its proof
DIGEST = 64                     # hexadecimal digits
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as the leaves hash it: byte count, colon and text; a dash if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def depth(nodes: int) -> int:
    """Levels above that many nodes until one is left."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // WIDTH), levels + 1
    return levels


def runs(joined: str) -> list[str]:
    return [joined[i:i + WIDTH * DIGEST] for i in range(0, len(joined), WIDTH * DIGEST)]


def block_runs(joined: str, nodes: int, levels: int) -> list[list[str]]:
    """The runs of every level of a block in a tree of that many nodes, from below; none for a lone node."""
    found = []
    for _ in range(min(levels, depth(nodes))):
        found.append(runs(joined))
        joined = "".join(map(digest, found[-1]))
    return found


def siblings(found: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of a member in its run, level by level."""
    path = []
    for level in found:
        run, i = level[at // WIDTH], at % WIDTH * DIGEST
        path.append((run[:i], run[i + DIGEST:]))
        at //= WIDTH
    return path


def fold(node: str, path: Sequence[tuple[str, str]]) -> str:
    """Copies of a node's ancestors along a path: the last one."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def leaves(df: DataFrame, key: str, group: str, fields: Sequence[str], changed: Column, change: Sequence[Column]) -> DataFrame:
    """(key, group, leaf, new): the digest of every row and, where ``changed`` holds, of the row as changed."""
    return df.select(F.col(key).alias("key"), F.col(group).alias("group"), leaf([F.col(c) for c in fields]).alias("leaf"),
                     F.when(changed, leaf(change)).alias("new"))


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows with tree number, place in the tree and size of the tree; and (tree, group, nodes).

    Rows are cut into range chunks over group, key and digest, so a hot group is many tasks. What is summed
    over is one row per chunk and group.
    """
    parts = chunked(rows, ["group", "key", "leaf", "new"])
    of_chunk = parts.groupBy("_chunk", "group").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    groups = of_chunk.groupBy("group").agg(F.sum("n").alias("nodes"))
    trees = cut_lineage(numbered_groups(groups))
    before = Window.partitionBy("tree").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    of_chunk = (of_chunk.join(trees, of_chunk["group"].eqNullSafe(trees["group"])).drop(trees["group"])
                .select("_chunk", F.col("group").alias("g"), "tree", "nodes",
                        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")))
    found = parts.join(of_chunk, (parts["_chunk"] == of_chunk["_chunk"]) & parts["group"].eqNullSafe(of_chunk["g"]))
    return found.select("tree", "nodes", (F.col("_at") + F.col("shift")).alias("place"), "key", "leaf", "new"), trees


def numbered_groups(groups: DataFrame) -> DataFrame:
    """Groups numbered from 0 in the order of their names, null first."""
    parts = chunked(groups, ["group"])
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)     # one row a chunk
    counts = (parts.groupBy("_chunk").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
              .select("_chunk", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")))
    return parts.join(counts, "_chunk").select((F.col("_at") + F.col("shift")).alias("tree"), "group", "nodes")


def _mapped(df: DataFrame, schema: str, run) -> DataFrame:
    """Rows made from each row of ``df``, a bounded number at a time."""
    bound_batches(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from (pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(made, out)], schema=out)
                            for made in run({n: batch.column(n)[i] for n in batch.schema.names}))

    return df.mapInArrow(task, schema)


def blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """(tree, nodes, block, members) of rows (tree, nodes, place, leaf, …): a row per aligned block, members in order."""
    others = [c for c in nodes.columns if c not in ("tree", "nodes", "place")]
    return cut_lineage(nodes.groupBy("tree", "nodes", F.floor(F.col("place") / WIDTH ** levels).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", *others))).alias("members")))


def tops(made: DataFrame, levels: int) -> DataFrame:
    """(tree, nodes, place, leaf): every block's node at the level above it."""
    def run(row):
        nodes, joined = row["nodes"].as_py(), "".join(row["members"].values.field("leaf").to_pylist())
        found = block_runs(joined, nodes, levels)
        top = digest(found[-1][0]) if found else joined
        yield [row["tree"].as_py()], [-(-nodes // WIDTH ** levels)], [row["block"].as_py()], [top]

    return _mapped(made, "tree bigint, nodes bigint, place bigint, leaf string", run)


def build(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """All layers of blocks, from below, and (tree, root)."""
    layers = [blocks(nodes, levels)]
    while True:
        above = cut_lineage(tops(layers[-1], levels))
        if not above.where("nodes > 1").take(1):
            return layers, above.select("tree", F.col("leaf").alias("root"))
        layers.append(blocks(above, levels))


def paths_down(layers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """(tree, place, path) of the members of the lowest of the layers, ``above`` being the paths of the trees' roots."""
    path = above
    for n, layer in enumerate(reversed(layers)):
        on = ["tree"] if n == 0 else ["tree", "block"]
        known = path.drop("place") if n == 0 else path.withColumnRenamed("place", "block")

        def run(row):
            own, over = row["members"], row["path"].as_py()
            joined, at = "".join(own.values.field("leaf").to_pylist()), own.values.field("place").to_pylist()
            found = block_runs(joined, row["nodes"].as_py(), levels)
            for i in range(0, len(at), ROWS_OUT):
                paths = [[{"left": a, "right": b} for a, b in siblings(found, p % WIDTH ** levels)] + over for p in at[i:i + ROWS_OUT]]
                yield [row["tree"].as_py()] * len(paths), at[i:i + ROWS_OUT], paths

        path = cut_lineage(_mapped(layer.join(known, on), f"tree bigint, place bigint, path {PATH}", run))
    return path


def manifest(df: DataFrame, fields: Sequence[str], changed: Column, change: Sequence[Column], key: str = "doc_id",
             group: str = "source", levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof, new_leaf, folded_root) for every row of the table.

    ``fields`` are hashed, in order; ``change`` are their values in the version that changes a row, made where
    ``changed`` is true (null: not). ``proof`` holds the siblings of every level, left and right, through the
    group's last node up to the root; ``folded_root`` is what they and the row's new leaf, else its leaf, fold to.

    Null keys come first in their group and a null group before all; rows alike in key stand in the order of
    their digests, so repeated rows are equal leaves side by side. A null field is hashed as a dash, an empty
    one as ``0:``. A group of one row has its leaf as last node, a dataset of one group that group's. An empty
    table gives no rows. Texts may be of any length and are hashed where they are read; other columns of
    ``df`` play no part. Groups may be as many as rows.
    """
    rows = cut_lineage(leaves(df, key, group, fields, changed, change))
    nodes, trees = placed(rows)
    kind = rows.schema["key"].dataType.simpleString()
    layers, subroots = build(nodes, levels)
    # The groups' last nodes are the leaves of one more tree.
    count = trees.agg(F.count("*")).scalar()
    over, roots = build(subroots.select(F.lit(0).cast("long").alias("tree"), count.alias("nodes"), F.col("tree").alias("place"),
                                        F.col("root").alias("leaf")), levels)
    root = roots.first()
    if root is None:
        return df.sparkSession.createDataFrame([], f"{key} {kind}, leaf string, subroot string, root string, proof {PATH}, new_leaf string, folded_root string")
    root = root["root"]
    nothing = F.array().cast(PATH).alias("path")
    # As below: the blocks of the upper tree hand the groups' nodes their paths, and those go down the groups.
    top = paths_down(over, df.sparkSession.range(1).select(F.col("id").alias("tree"), F.lit(0).cast("long").alias("place"), nothing), levels)
    down = paths_down(layers[1:], top.select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), "path"), levels)
    lowest = layers[0].join(down.withColumnRenamed("place", "block"), ["tree", "block"])

    def run(row):
        own, over = row["members"].values, [(p["left"], p["right"]) for p in row["path"].as_py()]
        keys, old, new = own.field("key"), own.field("leaf").to_pylist(), own.field("new").to_pylist()
        nodes = row["nodes"].as_py()
        found = block_runs("".join(old), nodes, levels)
        # The path leaves the group where its tree ends.
        subroot = fold(digest(found[-1][0]) if found else old[0], over[:depth(nodes) - len(found)])
        folded: dict[str, str] = {}       # the last copy above the block, by the copy of the block's own node
        above = [{"left": a, "right": b} for a, b in over]
        for i in range(0, len(old), ROWS_OUT):
            proofs, ends = [], []
            for at in range(i, min(i + ROWS_OUT, len(old))):
                path = siblings(found, at)
                node = fold(new[at] or old[at], path)
                if node not in folded:
                    if len(folded) > ROWS_OUT:
                        folded.clear()
                    folded[node] = fold(node, over)
                ends.append(folded[node])
                proofs.append([{"left": a, "right": b} for a, b in path] + above)
            n = len(ends)
            yield (keys[i:i + n], old[i:i + n], [subroot] * n, [root] * n, proofs, new[i:i + n], ends)

    schema = f"key {kind}, leaf string, subroot string, root string, proof {PATH}, new_leaf string, folded_root string"
    return _mapped(lowest, schema, run).withColumnRenamed("key", key)


def proof_text(proof: Column) -> Column:
    """All siblings of a proof joined, from the leaf's to the root's, left to right."""
    return F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "")
