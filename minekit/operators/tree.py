"""Routing rows through a decision tree, and views of the tree as tables.

A node is named by its path: the root is ``1``, and a node ``p`` has the children ``p0`` (below the split) and ``p1``. Read as a binary
number a path is the usual number of the node, but it has no largest depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.columns import majority
from minekit.functions.storage import settle
from minekit.operators.features import lookup_join

ROOT = "1"
PACKED_NODES = 1_000_000
PACKED_BYTES = 64 << 20
CHUNK_LEVELS = 8


def child(node: Column, below: Column) -> Column:
    """The child of a node on the side that ``below`` tells; an absent value goes to the right."""
    return F.concat(node, F.when(below, "0").otherwise("1"))


def node_number(node: Column) -> Column:
    """The usual number of a node: 1 for the root, ``2p`` and ``2p + 1`` for children; for trees of up to 61 levels."""
    return F.conv(node, 2, 10).cast("bigint")


def value_of(held: str, feature: Column) -> Column:
    """The value of a feature in the column ``features``, or in ``entries``, where a feature that is not listed is 0."""
    if held == "features":
        return F.get("features", feature)
    listed = F.filter("entries", lambda e: e["feature"] == feature)
    return F.when(F.size(listed) > 0, F.get(listed, F.lit(0))["value"]).otherwise(0.0)


def split_rows(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Move rows from their node to its child; rows of nodes without a split are left out."""
    moved = lookup_join(rows, splits.select("node_id", "feature", "split"), "node_id", "row_id")
    below = F.element_at("features", F.col("feature") + 1) < F.col("split")
    return moved.select(child(F.col("node_id"), below).alias("node_id"), *[c for c in rows.columns if c != "node_id"])


@dataclass(frozen=True)
class PackedTree:
    """A tree as flat arrays: feature and split of each node, -1 in leaves, and the places of its children."""

    names: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> PackedTree:
        names = table.column("node_id").to_numpy()
        place = {name: i for i, name in enumerate(names)}
        feature = table.column("feature").fill_null(-1).to_numpy()
        sides = [np.array([place.get(name + side, -1) for name in names], np.int32) for side in "01"]
        return cls(names, feature, table.column("split").fill_null(0.0).to_numpy(), *sides, table.column("prediction").to_numpy())

    def leaves(self, lists: pa.Array) -> np.ndarray:
        """The place of the leaf of each list of features; all rows go down one level at a time."""
        flat = np.append(lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False), np.nan)
        sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        at = np.full(len(sizes), int(np.flatnonzero(self.names == ROOT)[0]), np.int32)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            here = at[moving]
            feature = self.feature[here]
            found = np.where(feature < sizes[moving], starts[moving] + feature, len(flat) - 1)
            at[moving] = np.where(flat[found] < self.split[here], self.left[here], self.right[here])
            moving = moving[self.feature[at[moving]] >= 0]
        return at


    def sparse_leaves(self, lists: pa.Array) -> np.ndarray:
        """The same for lists of entries (feature, value); what a row does not list is 0."""
        sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
        flat = lists.flatten()
        feature = flat.field("feature").to_numpy(zero_copy_only=False).astype(np.int64)
        width = max(int(feature.max(initial=0)), int(self.feature.max(initial=0))) + 1
        keys = np.repeat(np.arange(len(sizes)), sizes) * width + feature
        order = np.argsort(keys, kind="stable")
        keys = np.append(keys[order], -1)
        values = np.append(flat.field("value").fill_null(float("nan")).to_numpy(zero_copy_only=False)[order], 0.0)
        at = np.full(len(sizes), int(np.flatnonzero(self.names == ROOT)[0]), np.int32)
        moving = np.flatnonzero(self.feature[at] >= 0)
        while len(moving):
            here = at[moving]
            wanted = moving * width + self.feature[here]
            place = np.searchsorted(keys[:-1], wanted)
            value = np.where(keys[place] == wanted, values[place], 0.0)
            at[moving] = np.where(value < self.split[here], self.left[here], self.right[here])
            moving = moving[self.feature[at[moving]] >= 0]
        return at


def tree_predictions(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``row_id, label, node_id, prediction``: the leaf and class of each row, with ``features`` or sparse ``entries``.

    A tree of measured size travels whole, as flat arrays, and rows walk it where they lie. A larger one is cut into pieces of
    some levels that rows meet by joins.
    """
    n, size = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("node_id") + 32), F.lit(0))).first()
    if n > PACKED_NODES or size > PACKED_BYTES:
        return _by_pieces(rows, nodes)
    packed = PackedTree.of(nodes.select("node_id", "feature", "split", "prediction").toArrow())
    shared = rows.sparkSession.sparkContext.broadcast(packed)
    sparse = "entries" in rows.columns

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            at = tree.sparse_leaves(batch.column("entries")) if sparse else tree.leaves(batch.column("features"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), batch.column("label"), pa.array(tree.names[at], pa.string()), pa.array(tree.prediction[at], pa.int32())],
                ["row_id", "label", "node_id", "prediction"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"row_id {kinds['row_id']}, label {kinds['label']}, node_id string, prediction int"
    return rows.select("row_id", "entries" if sparse else "features", "label").mapInArrow(walk, schema)


def _by_pieces(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Predictions by joins with pieces of ``CHUNK_LEVELS`` levels; rows that have reached a leaf are sent no more."""
    levels = F.lit(CHUNK_LEVELS)
    root = F.substring("node_id", F.lit(1), (F.expr(f"(length(node_id) - 1) div {CHUNK_LEVELS}") * levels + 1).cast("int"))
    entry = F.struct("node_id", F.struct("feature", "split", "prediction").alias("e"))
    pieces = settle(nodes.groupBy(root.alias("root")).agg(F.map_from_entries(F.collect_list(entry)).alias("piece")), "pieces")
    held = "entries" if "entries" in rows.columns else "features"
    at = rows.select(F.lit(ROOT).alias("root"), "row_id", held, "label")
    done = []
    for depth in range(0, (nodes.agg(F.max(F.length("node_id"))).first()[0] or 1), CHUNK_LEVELS):
        here = pieces.where(F.length("root") == depth + 1)
        met = lookup_join(at, here, "root", "row_id")

        def step(node: Column, _: Column) -> Column:
            own = F.col("piece")[node]
            below = value_of(held, own["feature"]) < own["split"]
            return F.when(own["feature"].isNull(), node).otherwise(child(node, below))

        end = F.aggregate(F.sequence(F.lit(1), levels), F.col("root"), step)
        walked = settle(met.select("row_id", held, "label", end.alias("root"), F.col("piece")[end].alias("own")), "walked")
        done.append(walked.where("own is not null").select("row_id", "label", F.col("root").alias("node_id"), "own.prediction"))
        at = walked.where("own is null").select("root", "row_id", held, "label")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def leaf_predictions(nodes: DataFrame) -> DataFrame:
    """``node_id, n, n_pos, prediction`` of the leaves; half or more positives predict 1."""
    return nodes.where("feature is null").select(
        "node_id", "n", "n_pos", majority(F.col("n"), F.col("n_pos")).alias("prediction")
    )


def tree_listing(nodes: DataFrame) -> DataFrame:
    """``path, part, line``: the tree in pre-order, children under ``left`` and ``right`` markers.

    ``path`` holds one digit per level (0 left, 1 right), so ordering by ``path, part`` gives the
    listing; splits print as ``(feature, split)`` and leaves as their class.
    """
    tab = F.lit("\t")
    body = F.when(
        F.col("feature").isNull(), F.col("prediction").cast("string")
    ).otherwise(F.format_string("(%d, %.6f)", "feature", "split"))
    side = F.when(F.endswith("node_id", F.lit("0")), "left").otherwise("right")
    marker = F.struct(F.lit(0).alias("part"), F.concat(F.repeat(tab, F.col("depth") - 1), side).alias("line"))
    own = F.struct(F.lit(1).alias("part"), F.concat(F.repeat(tab, F.col("depth")), body).alias("line"))
    parts = F.when(F.col("node_id") == ROOT, F.array(own)).otherwise(F.array(marker, own))
    listed = nodes.select(F.expr("substring(node_id, 2)").alias("path"), F.explode(parts).alias("p"))
    return listed.select("path", "p.part", "p.line").orderBy("path", "part")


def accuracy(predictions: DataFrame) -> DataFrame:
    """``n, accuracy``: percentage of rows whose prediction equals the label."""
    hit = (F.col("prediction").cast("double") == F.col("label")).cast("double")
    return predictions.agg(F.count(F.lit(1)).alias("n"), (F.avg(hit) * 100).alias("accuracy"))
