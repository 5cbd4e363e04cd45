"""Feature values as small integers: the rank of each distinct value of a feature, found once for all levels of a tree.

Ranks keep the order of values, so a split can be searched and rows can be routed on them alone. The distinct values
are few against the rows of most tables: up to ``BROADCAST_VALUES`` of them travel to the rows as sorted arrays; more meet
the rows by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from minekit.functions.ranking import chunked, running_totals
from minekit.functions.skew import balanced_join
from minekit.functions.storage import settle, spread

BROADCAST_VALUES = 4_000_000


@dataclass(frozen=True)
class Coded:
    """``rows`` (row_id, codes, label) and ``values`` (feature, code, value); ``widest`` is the most values that a feature has."""

    rows: DataFrame
    values: DataFrame
    widest: int
    sorted_values: Broadcast | None

    def with_values(self, df: DataFrame) -> DataFrame:
        """Add ``value`` to rows with ``feature, code``."""
        if self.sorted_values is None:
            return df.join(self.values.hint("shuffle_hash"), ["feature", "code"]).select(*df.columns, "value")
        known = self.sorted_values

        def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                features, codes = batch.column("feature").to_pylist(), batch.column("code").to_pylist()
                found = pa.array([float(known.value[f][c]) for f, c in zip(features, codes)], pa.float64())
                yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "value"])

        return df.mapInArrow(look_up, StructType([*df.schema.fields, StructField("value", DoubleType())]))


def code_values(rows: DataFrame) -> Coded:
    """The codes of ``rows`` (row_id, features, label). An absent value counts as NaN, the largest of all."""
    kept = spread(rows.select("row_id", "features", "label"))
    plain = F.coalesce(F.col("value"), F.lit(float("nan"))).alias("value")
    distinct = kept.select(F.posexplode("features").alias("feature", "value")).select("feature", plain).distinct()
    distinct = settle(distinct, "distinct")
    if distinct.count() > BROADCAST_VALUES:
        ranked = running_totals(chunked(distinct, ["feature", "value"], "values"), ["feature"], ["value"], {"values": "1"})
        values = settle(ranked.select("feature", F.col("before_values").cast("int").alias("code"), "value"), "values")
        coded = _joined(kept, values)
        shared = None
    else:
        rank = F.row_number().over(Window.partitionBy("feature").orderBy("value")) - 1
        values = settle(distinct.select("feature", rank.alias("code"), "value"), "values")
        shared = rows.sparkSession.sparkContext.broadcast(_arrays(values))
        coded = _searched(kept, shared)
    widest = values.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0]
    return Coded(settle(coded, "coded"), values, widest, shared)


def _arrays(values: DataFrame) -> list[np.ndarray]:
    """The sorted values of each feature."""
    table = values.orderBy("feature", "code").toArrow()
    features, found = table.column("feature").to_numpy(), table.column("value").to_numpy()
    width = int(features[-1]) + 1 if len(features) else 0
    bounds = np.searchsorted(features, np.arange(width + 1))
    return [found[bounds[f] : bounds[f + 1]] for f in range(width)]


def _searched(rows: DataFrame, shared: Broadcast) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("features")
            flat = lists.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False)
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            bounds = np.concatenate(([0], np.cumsum(sizes)))
            place = np.arange(len(flat)) - np.repeat(bounds[:-1], sizes)
            codes = np.empty(len(flat), np.int32)
            for feature in range(int(sizes.max(initial=0))):
                own = place == feature if len(np.unique(sizes)) > 1 else slice(feature, None, int(sizes[0]))
                codes[own] = np.searchsorted(shared.value[feature], flat[own])
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(codes))
            yield pa.RecordBatch.from_arrays([batch.column("row_id"), listed, batch.column("label")], ["row_id", "codes", "label"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(code, f"row_id {kinds['row_id']}, codes array<int>, label {kinds['label']}")


def _joined(rows: DataFrame, values: DataFrame) -> DataFrame:
    """The codes by a join on the values, one row per value; frequent values are cut into blocks."""
    long = rows.select("row_id", "label", F.posexplode("features").alias("feature", "value"))
    long = long.withColumn("value", F.coalesce("value", F.lit(float("nan"))))
    found = balanced_join(long, values, ["feature", "value"], ["row_id"])
    lists = found.groupBy("row_id", "label").agg(F.sort_array(F.collect_list(F.struct("feature", "code"))).alias("c"))
    return lists.select("row_id", F.transform("c", lambda c: c["code"]).alias("codes"), "label")


@dataclass(frozen=True)
class CodedEntries:
    """Sparse rows: ``rows`` (row_id, entries of feature and code, label), ``values`` (feature, code, value).

    What a row does not list is 0, whose code ``zeros`` (feature, zero) tells.
    """

    rows: DataFrame
    values: DataFrame
    zeros: DataFrame
    widest: int

    def with_values(self, df: DataFrame) -> DataFrame:
        """Add ``value`` to rows with ``feature, code``."""
        return df.join(self.values.hint("shuffle_hash"), ["feature", "code"]).select(*df.columns, "value")

    def with_zeros(self, df: DataFrame) -> DataFrame:
        """Add ``zero``, the code of 0, to rows with ``feature``."""
        return df.join(self.zeros.hint("shuffle_hash"), "feature").select(*df.columns, "zero")


def code_entries(rows: DataFrame) -> CodedEntries:
    """The codes of sparse ``rows`` (row_id, entries, label); ``entries`` lists features and values that are not 0, each feature once.

    An absent value counts as NaN. A value that is 0 may be listed; it counts as left out.
    """
    kept = spread(rows.select("row_id", "entries", "label"))
    held = F.transform("entries", lambda e: F.struct(e["feature"].alias("feature"), F.coalesce(e["value"], F.lit(float("nan"))).alias("value")))
    kept = kept.withColumn("entries", F.filter(held, lambda e: e["value"] != 0.0))
    listed = kept.select(F.explode("entries").alias("e")).select("e.feature", "e.value").distinct()
    listed = settle(listed, "distinct")
    zero = listed.select("feature").distinct().withColumn("value", F.lit(0.0))
    ranked = running_totals(
        chunked(listed.unionByName(zero), ["feature", "value"], "values"), ["feature"], ["value"], {"values": "1"}
    )
    values = settle(ranked.select("feature", F.col("before_values").cast("int").alias("code"), "value"), "values")
    zeros = settle(values.where("value = 0").select("feature", F.col("code").alias("zero")), "zeros")
    n, widest = values.agg(F.count(F.lit(1)), F.coalesce(F.max("code") + 1, F.lit(0))).first()
    if n <= BROADCAST_VALUES:
        coded = _searched_entries(kept, rows.sparkSession.sparkContext.broadcast(_flat(values)))
    else:
        long = kept.select("row_id", "label", F.explode_outer("entries").alias("e")).select("row_id", "label", "e.feature", "e.value")
        found = balanced_join(long.where("feature is not null"), values, ["feature", "value"], ["row_id"])
        lists = found.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("feature", "code"))).alias("entries"))
        nothing = F.array().cast("array<struct<feature:int,code:int>>")
        coded = kept.select("row_id", "label").join(lists, "row_id", "left").select("row_id", F.coalesce("entries", nothing).alias("entries"), "label")
    return CodedEntries(settle(coded, "coded"), values, zeros, widest)


def _flat(values: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The values of all features in order, and where each feature begins."""
    table = values.orderBy("feature", "code").toArrow()
    features = table.column("feature").to_numpy()
    width = int(features[-1]) + 1 if len(features) else 0
    return table.column("value").to_numpy(), np.searchsorted(features, np.arange(width + 1))


def _searched_entries(rows: DataFrame, shared: Broadcast) -> DataFrame:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, bounds = shared.value
        for batch in batches:
            lists = batch.column("entries")
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            flat = lists.flatten()
            feature = flat.field("feature").to_numpy(zero_copy_only=False)
            value = flat.field("value").to_numpy(zero_copy_only=False)
            # all entries search the values of their own feature at once, NaN above all
            low, high = bounds[feature], bounds[feature + 1] if len(feature) else bounds[feature]
            while (low < high).any():
                middle = np.minimum((low + high) >> 1, len(values) - 1)
                below = (low < high) & ((values[middle] < value) | (np.isnan(value) & ~np.isnan(values[middle])))
                low, high = np.where(below, middle + 1, low), np.where(below | (low >= high), high, middle)
            codes = (low - bounds[feature]).astype(np.int32) if len(feature) else np.zeros(0, np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(feature, pa.int32()), pa.array(codes)], ["feature", "code"])
            offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_id"), pa.ListArray.from_arrays(offsets, pairs), batch.column("label")], ["row_id", "entries", "label"]
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(code, f"row_id {kinds['row_id']}, entries array<struct<feature:int,code:int>>, label {kinds['label']}")
