"""Pairs of similar sets without comparing all sets that share something.

Two sets of ``m <= n`` items with a Jaccard similarity of ``t`` or more share ``t / (1 + t) * (m + n)`` items at
least. In any order of items that is the same for all sets, the first item that they share is therefore among the first
``m - 2t / (1 + t) * m + 1`` items of the smaller set and the first ``n - t * n + 1`` of the larger one. Items are
ordered by rarity, so a set meets others through the items that few sets hold. The smaller set is *filed* under its
short prefix, the larger one *probes* with the long one; sizes and the positions of the common item bound the
overlap before any set is read. A copy whose own edits fill its short prefix meets nobody. Nothing that
reaches the similarity is lost, and every pair is counted exactly in the end.

How many sets hold an item is counted over packed items: a task sends the items of many sets to a bucket in one row, as bytes
with the places of their sets, and the counts come back the same way. A row for each item would take several times the disk.

Sets may carry a ``part``; pairs inside one part are then left out, and items that only one part holds are the
rarest of all and are not filed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from minekit.functions.skew import BLOCK_COST, balanced_join, row_counts
from minekit.functions.storage import partitions_for, settle

# items that a task packs at once, and the most sets they may come from; stored bytes of sets whose items meet in one bucket
PACKED_ITEMS = 1 << 18
PACKED_SETS = (1 << 16) - 1
BUCKET_BYTES = 8 << 20
# sets of each side that are compared in one cell
CELL_SETS = 256
# numbers of sets that are broadcast at once
BROADCAST_ROWS = 1_000_000


def needed(n: Column | int, percent: int) -> Column:
    """Items of a set of ``n`` that a similar set holds at least."""
    return F.floor((n * percent + 99) / 100)


def needed_of_smaller(n: Column | int, percent: int) -> Column:
    """The same for the smaller of two sets, or one of two equal size."""
    return F.floor((n * 2 * percent + 99 + percent) / (100 + percent))


def needed_together(m: Column, n: Column, percent: int) -> Column:
    """Items that two similar sets of ``m`` and ``n`` items share at least."""
    return F.floor(((m + n) * percent + 99 + percent) / (100 + percent))


def rare_prefixes(sets: DataFrame, percent: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """``id, part, n, own, pos, item`` for the shared items in the long prefix of each set, rarest first.

    ``sets`` has ``id, part, items``. ``own`` counts the items of the set that no other part holds; ``pos`` counts all items
    of the set that come earlier, those included. The
    shuffle carries one row per item of a set; a set is gathered in one row, as it came.
    """
    rows = sets.select("id", "part", F.size("items").alias("n"), F.explode("items").alias("item"))
    shared = settle(
        rows.groupBy("item")
        .agg(F.count(F.lit(1)).alias("n_sets"), F.min("part").alias("_low"), F.max("part").alias("_high"))
        .where("_low < _high")
        .select("item", "n_sets"),
        "items",
    )
    counts = shared.select(F.xxhash64("item").alias("_key"), F.col("n_sets").alias("_left"))
    known = balanced_join(rows, shared, ["item"], ["id"], block_cost=block_cost, left_counts=counts)
    lists = known.groupBy("id", "part", "n").agg(F.sort_array(F.collect_list(F.struct("n_sets", "item"))).alias("_list"))
    own = F.col("n") - F.size("_list")
    room = F.greatest(F.col("n") - needed(F.col("n"), percent) + 1 - own, F.lit(0)).cast("int")
    return lists.select(
        "id", "part", "n", own.alias("own"), F.posexplode(F.slice("_list", F.lit(1), room)).alias("_at", "_entry")
    ).select("id", "part", "n", "own", (F.col("own") + F.col("_at")).cast("int").alias("pos"), F.col("_entry.item").alias("item"))


def _mixed(items: np.ndarray) -> np.ndarray:
    """A hash of 64 bits of each item, different for different items."""
    x = items.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _blobs(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the runs of ``values`` between ``bounds``."""
    ends = (bounds * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


_PACKED = {"pack": "bigint", "owners": "binary", "marks": "binary", "counts": "binary", "ids": "binary", "sizes": "binary"}


def _rows(**columns: pa.Array) -> dict[str, pa.Array]:
    """All packed columns, null where they are not given."""
    n = len(next(iter(columns.values())))
    return {name: columns.get(name, pa.nulls(n, pa.int64() if kind == "bigint" else pa.binary())) for name, kind in _PACKED.items()}


def _exchanged(sets: DataFrame, exact: bool, total: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """``total`` over each pack of stored ``sets`` (``id, items``, both of longs) with the counts of its items.

    A pack is a run of sets; one row names them (``ids, sizes``), the others hold the items that at least two sets hold: the places of their
    sets in the pack (``owners``) and, if ``exact``, the items (``marks``) and the number of sets that hold them (``counts``). Otherwise items are told apart
    by 32 bits beside their bucket, so that a few more are taken as shared; those that two sets of one pack hold are sent once and counted in ``counts`` of the row with names.
    """
    buckets = partitions_for(sets, BUCKET_BYTES)
    kind = np.int64 if exact else np.uint32

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a task that runs again reads the same stored rows and gives its packs the same numbers
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lists = batch.column("items")
            flat = lists.flatten().to_numpy()
            sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy().astype(np.int64)
            ids = batch.column("id").to_numpy()
            ends = np.concatenate(([0], np.cumsum(sizes)))
            low = 0
            while low < len(ids):
                high = int(np.searchsorted(ends, ends[low] + PACKED_ITEMS, "right")) - 1
                high = min(max(high, low + 1), low + PACKED_SETS, len(ids))
                items = flat[ends[low] : ends[high]]
                mixed = _mixed(items)
                owners = np.repeat(np.arange(high - low).astype(np.uint16), sizes[low:high])
                names = {"ids": _blobs(ids[low:high], np.array([0, high - low])), "sizes": _blobs(sizes[low:high], np.array([0, high - low]))}
                if not exact:
                    _, first, inverse, n = np.unique(mixed, return_index=True, return_inverse=True, return_counts=True)
                    several = n[inverse] > 1
                    names["counts"] = _blobs(np.bincount(owners[several], minlength=high - low), np.array([0, high - low]))
                    # the owner of an item of several sets needs no answer: it is the place behind all sets
                    owners[several] = high - low
                    first.sort()
                    items, mixed, owners = items[first], mixed[first], owners[first]
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([number % buckets], pa.int32()), **_rows(pack=pa.array([number], pa.int64()), **names)})
                if len(items):
                    at = (mixed >> np.uint64(33)) % np.uint64(buckets)
                    order = np.argsort(at.astype(np.uint16) if buckets <= 1 << 16 else at, kind="stable")
                    at = at[order].astype(np.int32)
                    cuts = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]))
                    marks = items if exact else (mixed & np.uint64(0xFFFFFFFF)).astype(kind)
                    columns = _rows(
                        pack=pa.array(np.full(len(cuts) - 1, number)), owners=_blobs(owners[order], cuts), marks=_blobs(marks[order], cuts)
                    )
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array(at[cuts[:-1]]), **columns})
                number, low = number + 1, high

    def count(table: pa.Table) -> pa.Table:
        named, rows = (table.filter(keep).select(list(_PACKED)) for keep in (pc.is_valid(table["ids"]), pc.is_null(table["ids"])))
        marks, owners = _joined(rows["marks"], kind), _joined(rows["owners"], np.uint16)
        _, inverse, n = np.unique(marks, return_inverse=True, return_counts=True)
        shared = n[inverse] > 1
        ends = np.concatenate(([0], np.cumsum(pc.binary_length(rows["marks"]).to_numpy() // marks.itemsize))).astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(shared)))[ends]
        found = {"pack": rows["pack"].combine_chunks(), "owners": _blobs(owners[shared], ends)}
        if exact:
            found |= {"marks": _blobs(marks[shared], ends), "counts": _blobs(n[inverse][shared].astype(np.uint32), ends)}
        return pa.concat_tables([named, pa.table(_rows(**found))])

    kinds = ", ".join(f"{name} {kind}" for name, kind in _PACKED.items())
    packed = sets.select("id", "items").mapInArrow(pack, f"bucket int, {kinds}")
    return packed.groupBy("bucket").applyInArrow(count, kinds).groupBy("pack").applyInArrow(total, schema)


def _named(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Table]:
    """The row that names the sets of a pack, their ids and sizes, and the other rows."""
    named, rows = table.filter(pc.is_valid(table["ids"])), table.filter(pc.is_null(table["ids"]))
    return named, _joined(named["ids"], np.int64), _joined(named["sizes"], np.int64), rows


def able_sets(sets: DataFrame, percent: int) -> DataFrame:
    """``id`` of those stored ``sets`` of which enough items are held by others too for a similar set; a few others may pass."""

    def total(table: pa.Table) -> pa.Table:
        named, ids, sizes, rows = _named(table)
        shared = _joined(named["counts"], np.int64) + np.bincount(_joined(rows["owners"], np.uint16), minlength=len(ids))[: len(ids)]
        return pa.table({"id": pa.array(ids[(sizes > 0) & (shared >= (sizes * percent + 99) // 100)])})

    return _exchanged(sets, False, total, "id bigint")


def packed_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``rare_prefixes`` of stored sets of longs that are a part each."""

    def total(table: pa.Table) -> pa.Table:
        _, ids, sizes, rows = _named(table)
        owners, items, n_sets = _joined(rows["owners"], np.uint16), _joined(rows["marks"], np.int64), _joined(rows["counts"], np.uint32)
        order = np.lexsort((items, n_sets, owners))
        owners, items = owners[order], items[order]
        shared = np.bincount(owners, minlength=len(ids))
        own = sizes - shared
        room = np.maximum(sizes - (sizes * percent + 99) // 100 + 1 - own, 0)
        at = np.arange(len(owners)) - np.concatenate(([0], np.cumsum(shared)))[owners]
        kept = at < room[owners]
        owners, at, items = owners[kept], at[kept], items[kept]
        columns = {"id": ids[owners], "part": ids[owners], "n": sizes[owners].astype(np.int32), "own": own[owners].astype(np.int32)}
        return pa.table(columns | {"pos": (own[owners] + at).astype(np.int32), "item": items})

    return _exchanged(sets, True, total, "id bigint, part bigint, n int, own int, pos int, item bigint")


def picked(sets: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of stored ``sets`` with one of the stored distinct ``ids``; no set is shuffled, and bounded slices of ``ids`` are broadcast."""
    slices = max(1, math.ceil(ids.count() / BROADCAST_ROWS))
    place = F.pmod(F.xxhash64("id"), F.lit(slices))
    return reduce(DataFrame.unionByName, [sets.join(F.broadcast(ids.where(place == s)), "id", "left_semi") for s in range(slices)])


def prefix_candidates(sets: DataFrame, percent: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """``a, b`` with ``a < b``: all pairs of ``sets`` that may be similar enough and are of different parts."""
    return met_prefixes(settle(rare_prefixes(sets, percent, block_cost), "prefixes"), percent, block_cost)


def met_prefixes(probes: DataFrame, percent: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """The candidates of stored ``rare_prefixes``."""
    short = F.col("n") - needed_of_smaller(F.col("n"), percent) + 1
    filed = probes.where(F.col("pos") < short)
    small = filed.select("item", *[F.col(c).alias(f"{c}_s") for c in ("id", "part", "n", "pos")])
    large = probes.select("item", *[F.col(c).alias(f"{c}_l") for c in ("id", "part", "n", "pos")])
    met = balanced_join(small, large, ["item"], ["id_s"], ["id_l"], block_cost=block_cost).where(
        (F.col("part_s") != F.col("part_l"))
        & (F.struct("n_s", "id_s") < F.struct("n_l", "id_l"))
        & (F.col("n_s") >= needed(F.col("n_l"), percent))
        & (
            F.least(F.col("n_s") - F.col("pos_s"), F.col("n_l") - F.col("pos_l"))
            >= needed_together(F.col("n_s"), F.col("n_l"), percent)
        )
    )
    return met.select(F.least("id_s", "id_l").alias("a"), F.greatest("id_s", "id_l").alias("b")).distinct()


def counted_pairs(pairs: DataFrame, sets: DataFrame, percent: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """``a, b, n_a, n_b, shared`` for those of ``pairs`` that are similar enough by their full sets."""
    first = sets.select(F.col("id").alias("a"), F.col("items").alias("_a"))
    second = sets.select(F.col("id").alias("b"), F.col("items").alias("_b"))
    both = balanced_join(pairs.select("a", "b"), first, ["a"], ["b"], block_cost=block_cost)
    both = balanced_join(both, second, ["b"], ["a"], block_cost=block_cost, left_counts=row_counts(pairs, ["b"], "_left"))
    counted = both.select(
        "a", "b", F.size("_a").alias("n_a"), F.size("_b").alias("n_b"), F.size(F.array_intersect("_a", "_b")).alias("shared")
    )
    return counted.where(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent)


def cell_pairs(pairs: DataFrame, sets: DataFrame, percent: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """``counted_pairs`` of stored ``pairs`` of sets of longs, where a set does not travel with each of its pairs.

    A pair belongs to the cell of the smallest set that its first set is paired with, so near copies are in few cells; a cell of many sets is cut into
    blocks. A set goes once to each block that has pairs of it.
    """
    leads = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.col("a").alias("cell")), F.struct(F.col("b").alias("id"), F.col("a").alias("cell")))).alias("_e"))
    leads = settle(leads.groupBy(F.col("_e.id").alias("a")).agg(F.min("_e.cell").alias("cell")), "leads")
    named = settle(balanced_join(pairs.select("a", "b"), leads, ["a"], ["b"], block_cost=block_cost), "cells")
    held = named.select("cell", F.explode(F.array("a", "b")).alias("id")).distinct().groupBy("cell").agg(F.count(F.lit(1)).alias("_n"))
    blocks = settle(held.select("cell", F.ceil(F.col("_n") / CELL_SETS).alias("_k")), "blocks")
    key = ["cell", "x", "y"]
    x, y = (F.pmod(F.xxhash64(side), F.col("_k")).cast("int").alias(name) for side, name in (("a", "x"), ("b", "y")))
    placed = settle(balanced_join(named, blocks, ["cell"], ["a", "b"], block_cost=block_cost).select("cell", x, y, "a", "b"), "placed")
    members = settle(placed.select(*key, F.explode(F.array("a", "b")).alias("id")).distinct(), "members")
    carried = balanced_join(members, sets.select("id", "items"), ["id"], key, block_cost=block_cost)

    def compare(some: pa.Table, held: pa.Table) -> pa.Table:
        ids, lists = held["id"].to_numpy(), held["items"].combine_chunks()
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        items, numbers = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        runs = np.split(numbers, np.cumsum(sizes)[:-1])
        order = np.argsort(ids)
        a, b = (order[np.searchsorted(ids[order], some[side].to_numpy())] for side in ("a", "b"))
        shared, mine = np.zeros(len(a), np.int64), np.zeros(len(items), bool)
        by_first = np.argsort(a, kind="stable")
        for run in np.split(by_first, np.flatnonzero(np.diff(a[by_first])) + 1):
            mine[runs[a[run[0]]]] = True
            shared[run] = [np.count_nonzero(mine[runs[other]]) for other in b[run]]
            mine[runs[a[run[0]]]] = False
        kept = shared * 100 >= (sizes[a] + sizes[b] - shared) * percent
        counts = {"n_a": sizes[a], "n_b": sizes[b], "shared": shared}
        return pa.table({"a": ids[a][kept], "b": ids[b][kept], **{name: n[kept].astype(np.int32) for name, n in counts.items()}})

    return placed.groupBy(*key).cogroup(carried.groupBy(*key)).applyInArrow(compare, "a bigint, b bigint, n_a int, n_b int, shared int")


def similar_sets(sets: DataFrame, percent: int = 80, block_cost: int = BLOCK_COST) -> DataFrame:
    """``a, b, n_a, n_b, shared`` for all pairs ``a < b`` of stored ``sets`` (``id, items``) with that similarity.

    ``items`` holds distinct values, ``id`` is unique; empty sets are in no pair. Sets that are equal
    should be folded before, since their pairs are all in the result.
    """
    longs = sets.schema["id"].dataType == LongType() and sets.schema["items"].dataType in (ArrayType(LongType()), ArrayType(LongType(), False))
    if longs and "part" not in sets.columns:
        met = met_prefixes(settle(packed_prefixes(sets, percent), "prefixes"), percent, block_cost)
        return cell_pairs(settle(met, "candidates"), sets, percent, block_cost)
    parted = sets if "part" in sets.columns else sets.withColumn("part", F.col("id"))
    pairs = settle(prefix_candidates(parted, percent, block_cost), "candidates")
    return counted_pairs(pairs, parted, percent, block_cost)
