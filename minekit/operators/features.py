"""Labelled rows (``row_id, category, numbers, label``) as feature vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.columns import to_number
from minekit.functions.ranking import dense_index
from minekit.functions.skew import balanced_join

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 16 << 20


def lookup_join(rows: DataFrame, table: DataFrame, on: str, spread: str) -> DataFrame:
    """Inner join with a table that has one row per ``on``.

    The table is measured: up to ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` of keys it is broadcast,
    beyond that both sides are shuffled with frequent keys cut into blocks.
    """
    size = F.coalesce(F.sum(F.length(F.col(on).cast("string"))), F.lit(0))
    rows_found, key_bytes = table.agg(F.count(F.lit(1)), size).first()
    if rows_found <= BROADCAST_ROWS and key_bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table), on)
    return balanced_join(rows, table, [on], [spread])


def category_index(rows: DataFrame) -> DataFrame:
    """``category, position``: the distinct categories numbered from 0 in ascending order."""
    known = dense_index(rows.select(_named()).distinct(), "category", "position")
    return known.select("category", F.col("position").cast("int").alias("position"))


def _named() -> Column:
    """The category of a row; an absent one is the empty category, as in a file with an empty field."""
    return F.coalesce("category", F.lit("")).alias("category")


def one_hot_features(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``one_hot``: an array with 1.0 at the position of the category and 0.0 elsewhere."""
    sized = index.withColumn("last", index.agg(F.max("position")).scalar())
    keyed = rows.select("*", _named().alias("_category"))
    placed = lookup_join(keyed, sized.withColumnRenamed("category", "_category"), "_category", "row_id")
    one_hot = F.transform(F.sequence(F.lit(0), F.col("last")), lambda at: F.when(at == F.col("position"), 1.0).otherwise(0.0))
    return placed.select(*rows.columns, one_hot.alias("one_hot"))


def sparse_features(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``row_id, entries, label``: position and value of the features that are not 0, in the positions of ``feature_vectors``.

    A row holds one entry for its category, however many there are, and one for each number.
    """
    last = index.agg(F.max("position")).scalar()
    keyed = rows.select("*", _named().alias("_category")).withColumn("_last", last)
    placed = lookup_join(keyed, index.withColumnRenamed("category", "_category"), "_category", "row_id")

    def entry(feature: Column, value: Column) -> Column:
        return F.struct(feature.cast("int").alias("feature"), value.alias("value"))

    numbers = F.transform("numbers", lambda x, at: entry(F.col("_last") + 1 + at, to_number(x)))
    listed = F.concat(F.array(entry(F.col("position"), F.lit(1.0))), numbers)
    return placed.select("row_id", F.filter(listed, lambda e: e["value"] != 0.0).alias("entries"), "label")


def feature_vectors(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``row_id, features, label``: the one-hot category followed by the numbers, ``?`` read as 0."""
    return one_hot_features(rows, index).select(
        "row_id", F.concat("one_hot", F.transform("numbers", to_number)).alias("features"), "label"
    )


def in_train(key: str, share: float, seed: int) -> Column:
    """Whether a row belongs to the training part, decided by a hash of its key and the seed."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return draw < F.lit(int(share * (1 << 32)))


def train_test_split(rows: DataFrame, key: str, weights: tuple[float, float] = (9, 1), seed: int = 0) -> DataFrame:
    """Add ``part``, ``'train'`` or ``'test'``; the same key and seed always give the same part."""
    share = weights[0] / sum(weights)
    return rows.withColumn("part", F.when(in_train(key, share, seed), "train").otherwise("test"))
