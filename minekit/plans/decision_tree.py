"""Information-gain decision trees, built one level at a time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.columns import majority
from minekit.functions.storage import Stored, settle, stored
from minekit.operators.codes import Coded, CodedEntries, code_entries, code_values
from minekit.operators.features import lookup_join
from minekit.operators.splits import (
    best_split,
    best_split_per_feature,
    coded_candidates,
    node_entropy,
    split_candidates,
    sparse_candidates,
    split_gains,
    value_counts,
)
from minekit.operators.tree import ROOT, accuracy, child

STORE_LEVELS = 4


def level_candidates(routed: DataFrame, coded: Coded | CodedEntries, candidates: int) -> DataFrame:
    """``node_id, feature, code, left_n, left_pos, n, n_pos`` of all nodes of ``routed`` (node_id, row_id, codes or entries, label)."""
    if isinstance(coded, CodedEntries):
        return sparse_candidates(routed, coded.zeros, candidates, coded.widest)
    if candidates > 0:
        return coded_candidates(routed, candidates, coded.widest)
    # every value is a candidate
    long = value_counts(routed.withColumnRenamed("codes", "features"))
    return split_candidates(long, 0).withColumnRenamed("value", "code")


def feature_splits(routed: DataFrame, coded: Coded | CodedEntries, candidates: int = 10) -> DataFrame:
    """``node_id, feature, code, split, gain, left_n, left_pos, n, n_pos``: the best split of every node and feature."""
    gains = split_gains(level_candidates(routed, coded, candidates)).withColumnRenamed("code", "value")
    return coded.with_values(best_split_per_feature(gains).withColumnRenamed("split", "code")).withColumnRenamed("value", "split")


def search_splits(rows: DataFrame, candidates: int = 10) -> DataFrame:
    """Best split of every node in ``rows`` (node_id, row_id, features, label)."""
    coded = code_values(rows)
    nodes = rows.select("row_id", "node_id")
    return best_split(feature_splits(coded.rows.join(nodes, "row_id"), coded, candidates))


@dataclass(frozen=True)
class DecisionTree:
    """Settings: nodes up to ``min_leaf`` rows stay leaves; ``max_depth`` bounds the levels where it is given.

    A node also stays a leaf when no candidate gains anything.
    """

    min_leaf: int = 250
    candidates: int = 10
    max_depth: int | None = None

    def __post_init__(self) -> None:
        if self.max_depth is not None and self.max_depth < 0:
            raise ValueError("max_depth must not be negative")

    def _open(self, n: Column, n_pos: Column, depth: int) -> Column:
        return (n > self.min_leaf) & (n_pos > 0) & (n_pos < n) & F.lit(self.max_depth is None or depth < self.max_depth)

    def fit(self, rows: DataFrame) -> DataFrame:
        """The node table of a tree over ``row_id, features, label``, or over sparse rows ``row_id, entries, label``.

        Columns: ``node_id, depth, feature, split, gain, left, right, n, n_pos, prediction``; nodes are paths (see
        ``operators.tree``); feature, split, gain and children are null in leaves. Values are turned into ranks once. One search per level
        covers all its open nodes. A level routes the rows through the splits since they were stored last; every ``STORE_LEVELS``
        levels the rows of open nodes are stored anew and the older copy is removed, so no plan grows with the depth. A child's
        counts come from its parent's split, so no level is counted again.
        """
        coded = code_entries(rows) if "entries" in rows.columns else code_values(rows)
        routed = coded.rows.withColumn("node_id", F.lit(ROOT))
        level = settle(node_entropy(routed).select("node_id", "n", "n_pos"), "nodes")
        parts, held, depth = [], None, 0
        opened = not level.where(self._open(F.col("n"), F.col("n_pos"), 0)).isEmpty()
        while opened:
            if depth and depth % STORE_LEVELS == 0:
                held = _stored_again(routed, held)
                routed = held.table
            found = feature_splits(routed, coded, self.candidates).where("gain > 0")
            splits = best_split(found).select("node_id", "feature", "code", "split", "gain", "left_n", "left_pos", "n", "n_pos")
            if isinstance(coded, CodedEntries):
                splits = coded.with_zeros(splits)
            splits = settle(splits.select("*", *self._sides(depth + 1)), "splits")
            parts.append(level.join(splits.select("node_id", "feature", "split", "gain"), "node_id", "left").withColumn("depth", F.lit(depth)))
            level = splits.select(F.explode(F.array("below", "above")).alias("child")).select("child.node_id", "child.n", "child.n_pos")
            opened = not splits.where("below.opened or above.opened").isEmpty()
            depth += 1
            if opened:
                routed = _routed(routed, splits)
        parts.append(level.select("*", *_no_split(), F.lit(depth).alias("depth")))
        nodes = reduce(DataFrame.unionByName, parts).select(
            "node_id",
            "depth",
            "feature",
            "split",
            "gain",
            F.when(F.col("feature").isNotNull(), F.concat("node_id", F.lit("0"))).alias("left"),
            F.when(F.col("feature").isNotNull(), F.concat("node_id", F.lit("1"))).alias("right"),
            "n",
            "n_pos",
            majority(F.col("n"), F.col("n_pos")).alias("prediction"),
        )
        nodes = settle(nodes, "tree")
        if held is not None:
            held.discard()
        return nodes

    def _sides(self, depth: int) -> list[Column]:
        """The children of a split with their counts, and whether they are to be split again."""

        def side(name: str, n: Column, n_pos: Column) -> Column:
            node = child(F.col("node_id"), F.lit(name == "below"))
            return F.struct(node.alias("node_id"), n.alias("n"), n_pos.alias("n_pos"), self._open(n, n_pos, depth).alias("opened")).alias(name)

        left = F.col("left_n"), F.col("left_pos")
        return [side("below", *left), side("above", F.col("n") - left[0], F.col("n_pos") - left[1])]


def _routed(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Coded rows at the children of their nodes; those of leaves are left out."""
    held = "entries" if "entries" in rows.columns else "codes"
    known = [c for c in ("node_id", "feature", "code", "zero", "below", "above") if c in splits.columns]
    moved = lookup_join(rows, splits.select(known), "node_id", "row_id")
    if held == "codes":
        own = F.get("codes", F.col("feature"))
    else:
        listed = F.filter("entries", lambda e: e["feature"] == F.col("feature"))
        own = F.coalesce(F.get(listed, F.lit(0))["code"], F.col("zero"))
    side = F.when(own < F.col("code"), F.col("below")).otherwise(F.col("above"))
    at = moved.select("row_id", held, "label", side.alias("_at")).where("_at.opened")
    return at.select("row_id", held, "label", F.col("_at.node_id").alias("node_id"))


def _stored_again(rows: DataFrame, older: Stored | None) -> Stored:
    kept = stored(rows, "routed")
    if older is not None:
        older.discard()
    return kept


def _no_split() -> list[Column]:
    return [
        F.lit(None).cast("int").alias("feature"),
        F.lit(None).cast("double").alias("split"),
        F.lit(None).cast("double").alias("gain"),
    ]


def library_accuracy(
    train: DataFrame, test: DataFrame, max_depth: int = 5, max_bins: int = 5
) -> DataFrame:
    """Accuracy of Spark's own entropy tree on the same features, for comparison."""
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    def vectors(rows: DataFrame) -> DataFrame:
        return rows.select("row_id", array_to_vector("features").alias("features"), "label")

    model = DecisionTreeClassifier(
        impurity="entropy", maxDepth=max_depth, maxBins=max_bins, featuresCol="features", labelCol="label"
    ).fit(vectors(train))
    return accuracy(model.transform(vectors(test)).select("label", "prediction"))
