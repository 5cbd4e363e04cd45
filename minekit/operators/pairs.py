"""Candidate pairs of similar documents.

Copies of one document have equal signatures, share every bucket, and would turn into a quadratic
number of pairs. So equal signatures are folded first: a *group* is one signature with its smallest
``doc_id`` and number of documents. Pairs are kept between groups; a row ``a < b`` stands for every
pair of a document of group ``a`` with one of group ``b``, and a row ``a = b`` for the pairs inside
one group, which agree in all bands. ``n_pairs`` says how many document pairs a row stands for, and
``group_members`` names the documents, so nothing is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from minekit.functions.columns import equal_positions
from minekit.functions.skew import BLOCK_COST, balanced_join, row_counts
from minekit.functions.storage import partitions_for, settle
from minekit.operators.minhash import lsh_buckets, lsh_rows

# cells of so few rows are compared together, others by so many rows of one side; pairs are counted so many at once (4 MB)
FEW_ROWS = 64
ROWS_AT_ONCE = 256
PAIRS_AT_ONCE = 1 << 12
# stored signatures whose buckets one task counts
COUNTED_BYTES = 4 << 20


def signature_groups(signatures: DataFrame) -> DataFrame:
    """``doc_id, sig, n_docs``: distinct signatures with their smallest document."""
    return (
        signatures.groupBy("sig")
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_docs"))
        .select("doc_id", "sig", "n_docs")
    )


def group_members(signatures: DataFrame, groups: DataFrame, block_cost: int = BLOCK_COST) -> DataFrame:
    """``doc_id, group_doc``: the group of every document."""
    named = groups.select("sig", F.col("doc_id").alias("group_doc"))
    counts = row_counts(groups, ["sig"], "_left", "n_docs")
    joined = balanced_join(signatures, named, ["sig"], ["doc_id"], block_cost=block_cost, left_counts=counts)
    return joined.select("doc_id", "group_doc")


def bucket_places(groups: DataFrame, bands: int, rows: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """Stored ``doc_id, mark, band, bucket_no, n_docs``: the buckets of each group that it shares with others, and their sizes.

    ``mark`` tells groups of one ``doc_id`` apart. Buckets have numbers, so that the runs of values need not travel on.
    """
    marked = groups.where("doc_id is not null").select(F.struct("doc_id", F.xxhash64("sig").alias("mark")).alias("doc_id"), "sig")
    placed = lsh_rows(marked, bands, rows)
    # a group has as many buckets as bands and nearly all are its own, so a task counts those of a bounded part of the groups
    dealt = groups.where("doc_id is not null").repartition(partitions_for(groups, COUNTED_BYTES), "sig")
    shared = lsh_buckets(lsh_rows(dealt, bands, rows)).select("band", "bucket", "n_docs", F.monotonically_increasing_id().alias("bucket_no"))
    # stored, so that the numbers stay
    shared = settle(shared, "buckets")
    counts = shared.select(F.xxhash64("band", "bucket").alias("_key"), F.col("n_docs").alias("_left"))
    members = balanced_join(placed, shared, ["band", "bucket"], ["doc_id"], block_cost=block_cost, left_counts=counts)
    return settle(members.select("doc_id.doc_id", "doc_id.mark", "band", "bucket_no", "n_docs"), "places")


def rare_places(places: DataFrame, least: int) -> DataFrame:
    """The places at which any two groups that share ``least`` buckets meet: all but the last ``least - 1`` of each group, the fullest last."""
    order = F.sort_array(F.collect_list(F.struct("n_docs", "bucket_no", "band")))
    lists = places.groupBy("doc_id", "mark").agg(order.alias("_list")).where(F.size("_list") >= least)
    first = F.slice("_list", F.lit(1), F.size("_list") - (least - 1))
    return lists.select("doc_id", "mark", F.explode(first).alias("_at")).select("doc_id", "mark", "_at.*")


def met_groups(
    groups: DataFrame, bands: int, rows: int, block_cost: int = BLOCK_COST, least: int = 1, places: DataFrame | None = None
) -> DataFrame:
    """``a, b, shared_bands, similarity, n_pairs``: groups ``a < b`` that share ``least`` buckets or more.

    Signatures travel to the shared buckets, which are few rows beside the pairs, and are compared where they meet. A pair is given by the first
    band that it shares, so pairs are neither shuffled nor gathered. A bucket of more than ``sqrt(block_cost)`` groups is cut into
    blocks, and two blocks meet in a cell: what a task holds is bounded by a cell.
    """
    places = bucket_places(groups, bands, rows, block_cost) if places is None else places
    if least > 1:
        places = rare_places(places, least)
    side = max(1, math.isqrt(block_cost))
    signed = groups.where("doc_id is not null").select("doc_id", F.xxhash64("sig").alias("mark"), F.col("sig").cast("array<int>").alias("_sig"), F.col("n_docs").alias("_docs"))
    known = places.join(signed, ["doc_id", "mark"]).withColumn("_blocks", F.ceil(F.col("n_docs") / side).cast("int"))
    known = known.withColumn("_at", F.pmod(F.xxhash64("doc_id", "mark"), F.col("_blocks")).cast("int"))
    cells = known.withColumn("_k", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).select(
        "bucket_no", F.least("_at", "_k").alias("_r"), F.greatest("_at", "_k").alias("_c"), "_at", "band", "doc_id", "_docs", "_sig"
    )
    dealt = cells.repartition("bucket_no", "_r", "_c").sortWithinPartitions("bucket_no", "_r", "_c")
    key = groups.schema["doc_id"].dataType
    kinds = StructType([StructField("_x", key), StructField("_y", key)] + StructType.fromDDL(
        "_docs_x bigint, _docs_y bigint, shared_bands bigint, similarity double").fields)
    schema = to_arrow_schema(kinds)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in whole_cells(batches):
            yield from (batch.cast(schema) for batch in compared(cells, bands, rows, least))

    met = dealt.mapInArrow(measure, kinds).where("_x <> _y").select(
        F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), "shared_bands", "similarity", (F.col("_docs_x") * F.col("_docs_y")).alias("n_pairs")
    )
    # rare places of a pair may coincide more than once
    return met if least == 1 else met.distinct()


def whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables that end with a cell."""
    held = []
    for batch in batches:
        cell = np.stack([batch.column(c).to_numpy() for c in ("bucket_no", "_r", "_c")], axis=1)
        if held:
            last = [held[-1].column(c)[-1].as_py() for c in ("bucket_no", "_r", "_c")]
            cell = np.concatenate(([last], cell))
        cuts = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + (0 if held else 1)
        if len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])])
            held = [batch.slice(cuts[-1])]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


@cache
def two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all two of ``n`` rows, for at most ``FEW_ROWS``."""
    return np.triu_indices(n, 1)


def compared(cells: pa.Table, bands: int, rows: int, least: int) -> Iterator[pa.RecordBatch]:
    """The pairs of each cell that meet here for the first time, or share ``least`` bands."""
    cells = cells.combine_chunks()
    names = ("bucket_no", "_r", "_c", "_at", "band")
    no, r, c, at, band = (cells.column(n).to_numpy() for n in names)
    flat = cells.column("_sig").combine_chunks().flatten().to_numpy()
    sig = flat.reshape(len(cells), -1)
    docs, keys = cells.column("_docs").to_numpy(), cells.column("doc_id").combine_chunks()
    starts = np.flatnonzero(np.concatenate(([True], (no[1:] != no[:-1]) | (r[1:] != r[:-1]) | (c[1:] != c[:-1]))))

    def counted(i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(i), PAIRS_AT_ONCE):
            x, y = i[low : low + PAIRS_AT_ONCE], j[low : low + PAIRS_AT_ONCE]
            same = sig[x] == sig[y]
            agree = same[:, 0 : bands * rows : rows]
            for row in range(1, rows):
                agree = agree & same[:, row : bands * rows : rows]
            shared = agree.sum(axis=1)
            kept = np.flatnonzero(agree.argmax(axis=1) + 1 == band[x]) if least == 1 else np.flatnonzero(shared >= least)
            if len(kept):
                x, y = x[kept], y[kept]
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(x)), keys.take(pa.array(y)), pa.array(docs[x]), pa.array(docs[y]), pa.array(shared[kept]),
                     pa.array(same[kept].sum(axis=1) / sig.shape[1])],
                    names=["_x", "_y", "_docs_x", "_docs_y", "shared_bands", "similarity"],
                )

    few: tuple[list, list] = ([], [])
    waiting = 0
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(no)]):
        if high - low <= FEW_ROWS and r[low] == c[low]:
            # nearly all cells are of this kind
            x, y = two_of(high - low)
            few[0].append(x + low)
            few[1].append(y + low)
            waiting += len(x)
            if waiting >= PAIRS_AT_ONCE:
                yield from counted(np.concatenate(few[0]), np.concatenate(few[1]))
                few, waiting = ([], []), 0
            continue
        own = np.arange(low, high)
        left, right = (own, own) if r[low] == c[low] else (own[at[low:high] == r[low]], own[at[low:high] == c[low]])
        if not len(left) or not len(right):
            continue
        one = left is right
        if len(own) <= FEW_ROWS:
            i, j = (side.ravel() for side in np.meshgrid(left, right, indexing="ij"))
            few[0].append(i)
            few[1].append(j)
            waiting += len(i)
            if waiting >= PAIRS_AT_ONCE:
                yield from counted(np.concatenate(few[0]), np.concatenate(few[1]))
                few, waiting = ([], []), 0
            continue
        columns = np.ascontiguousarray(sig[right].T)
        for first in range(0, len(left), ROWS_AT_ONCE):
            some = left[first : first + ROWS_AT_ONCE]
            new = np.ones((len(some), len(right)), bool) if not one else some[:, None] < right[None, :]
            misses = np.zeros(new.shape, np.uint16)
            for at_band in range(bands if least > 1 else band[low] - 1):
                agree = new.copy()
                for h in range(at_band * rows, (at_band + 1) * rows):
                    agree &= sig[some, h][:, None] == columns[h][None, :]
                if least == 1:
                    # pairs that share an earlier band are given there
                    new ^= agree
                elif (misses := misses + ~agree).min() > bands - least:
                    break
            if least > 1:
                new &= misses <= bands - least
            i, j = np.nonzero(new)
            yield from counted(some[i], right[j])
    if waiting:
        yield from counted(np.concatenate(few[0]), np.concatenate(few[1]))


def candidate_pairs(
    groups: DataFrame,
    bands: int,
    rows: int,
    block_cost: int = BLOCK_COST,
    least: int = 1,
    places: DataFrame | None = None,
    measured: bool = False,
) -> DataFrame:
    """``a, b, shared_bands``: groups that share at least ``least`` buckets, ``a <= b``.

    ``measured`` pairs bring their ``similarity, n_pairs`` along. Where several groups have one ``doc_id``, their bands are summed up for that,
    all pairs are listed, and none is measured.
    """
    repeated = not groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    between = met_groups(groups, bands, rows, block_cost, 1 if repeated else least, places)
    if repeated:
        between = between.groupBy("a", "b").agg(F.sum("shared_bands").alias("shared_bands"))
    inside = groups.where("n_docs > 1").select(
        F.col("doc_id").alias("a"),
        F.col("doc_id").alias("b"),
        F.lit(bands).cast("bigint").alias("shared_bands"),
        F.lit(1.0).alias("similarity"),
        F.expr("n_docs * (n_docs - 1) div 2").alias("n_pairs"),
    )
    names = ["a", "b", "shared_bands"] + (["similarity", "n_pairs"] if measured and not repeated else [])
    return between.select(*names).unionByName(inside.select(*names))


def candidate_signatures(groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """The groups that occur in a candidate pair."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    return groups.join(wanted, "doc_id", "left_semi")


def pair_similarity(pairs: DataFrame, groups: DataFrame, block_cost: int = BLOCK_COST) -> DataFrame:
    """``a, b, shared_bands, similarity, n_pairs``; similarity is the share of equal positions.

    ``pairs`` that were measured where they met only lose their nulls.
    """
    if "similarity" in pairs.columns:
        return pairs.where("a is not null").select("a", "b", "shared_bands", "similarity", "n_pairs")
    first = groups.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"), F.col("n_docs").alias("n_a"))
    second = groups.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"), F.col("n_docs").alias("n_b"))
    joined = balanced_join(pairs, first, ["a"], ["b"], block_cost=block_cost)
    joined = balanced_join(
        joined, second, ["b"], ["a"], block_cost=block_cost, left_counts=row_counts(pairs, ["b"], "_left")
    )
    inside = F.col("n_a") * (F.col("n_a") - 1) / 2
    return joined.select(
        "a",
        "b",
        "shared_bands",
        (equal_positions(F.col("sig_a"), F.col("sig_b")) / F.size("sig_a")).alias("similarity"),
        F.when(F.col("a") == F.col("b"), inside).otherwise(F.col("n_a") * F.col("n_b")).cast("bigint").alias("n_pairs"),
    )


def similarity_bound(shared_bands: int, n_hashes: int, bands: int, rows: int) -> float:
    """The largest similarity of two signatures that agree in exactly that many bands: all others miss one position at least."""
    return (shared_bands * rows + (bands - shared_bands) * (rows - 1) + n_hashes - bands * rows) / n_hashes


def strongest_pairs(pairs: DataFrame, groups: DataFrame, k: int, n_hashes: int, bands: int, rows: int, block_cost: int = BLOCK_COST) -> DataFrame:
    """Similarities of those stored candidate ``pairs`` that may be among the first ``k`` rows.

    Pairs are taken by their number of shared bands, most first. When ``k`` of them are measured, the last of these is a threshold: pairs whose
    bands allow no more than less never meet their signatures. Only counts by shared bands reach the driver.
    """
    counts = {r.shared_bands: r["count"] for r in pairs.groupBy("shared_bands").count().collect()}
    seen, lowest = 0, max(counts, default=0)
    for shared in sorted(counts, reverse=True):
        seen, lowest = seen + counts[shared], shared
        if seen >= k:
            break
    first = settle(pair_similarity(pairs.where(F.col("shared_bands") >= lowest), groups, block_cost), "strongest")
    least = first.orderBy(F.desc("similarity")).limit(k).agg(F.min("similarity")).first()[0]
    others = [s for s in counts if s < lowest and (seen < k or similarity_bound(s, n_hashes, bands, rows) >= least)]
    if not others:
        return first
    reach = (F.col("shared_bands") < lowest) & (F.col("shared_bands") >= min(others))
    return first.unionByName(pair_similarity(pairs.where(reach), groups, block_cost))


def top_pairs(similarities: DataFrame, signatures: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most similar document pairs ``a < b``: by similarity, then ``a``, then ``b``.

    Exact without listing the pairs of large groups. In the order (similarity, a, b) a row comes
    before all document pairs it stands for, except that the row ``a = a`` may come before a row
    ``(a, b)`` with a smaller second document. So the best ``k`` document pairs come from the first
    ``k + 1`` rows; and within a row only the ``k + 1`` smallest documents of a group can take part,
    since a pair with a later document has at least ``k`` better ones. Every task keeps that many
    documents per group, and every row gives its ``k`` smallest pairs.
    """
    best = settle(
        similarities.orderBy(F.desc("similarity"), "a", "b").limit(k + 1).select("a", "b", "similarity"), "best"
    )
    # at most 2 * (k + 1) groups from here on
    named = F.broadcast(best.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    chosen = signatures.join(named, "doc_id", "left_semi").select(F.col("doc_id").alias("group_doc"), "sig")
    found = signatures.join(F.broadcast(chosen), "sig").select("group_doc", "doc_id")
    firsts = settle(smallest_of_groups(smallest_of_groups(found, k + 1).repartition("group_doc"), k + 1), "members")
    lists = firsts.groupBy("group_doc").agg(F.collect_list("doc_id").alias("members"))
    both = best.join(lists.toDF("a", "_x"), "a").join(lists.toDF("b", "_y"), "b")

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, similarity, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "similarity", "_x", "_y"))):
                pairs = smallest_pairs(np.array(x), np.array(y), a == b, k)
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array(pairs[0]), "b": pa.array(pairs[1]), "similarity": pa.array(np.full(len(pairs[0]), similarity))}
                ).cast(schema)

    key = signatures.schema["doc_id"].dataType
    kinds = StructType([StructField("a", key), StructField("b", key), StructField("similarity", DoubleType())])
    schema = to_arrow_schema(kinds)
    return both.mapInArrow(smallest, kinds).orderBy(F.desc("similarity"), "a", "b").limit(k)


def smallest_of_groups(members: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest ``doc_id`` of each ``group_doc`` within each partition; ``members`` has few groups."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            held = held.sort_by([("group_doc", "ascending"), ("doc_id", "ascending")])
            groups = held.column("group_doc").to_numpy()
            first = np.searchsorted(groups, groups, "left")
            held = held.filter(pa.array(np.arange(len(groups)) - first < k)).combine_chunks()
        if held is not None:
            yield from held.to_batches()

    return members.mapInArrow(keep, members.schema)


def smallest_pairs(x: np.ndarray, y: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` pairs ``p < q`` of a document of each list, or of two of one list when they are the ``same``."""
    x, y = np.sort(x), np.sort(y)
    sides = [(x, x)] if same else [(x, y), (y, x)]
    firsts = np.concatenate([p for p, _ in sides])
    after = np.concatenate([np.searchsorted(q, p, "right") for p, q in sides])
    side = np.repeat(np.arange(len(sides)), [len(p) for p, _ in sides])
    sizes = np.array([len(q) for _, q in sides])[side] - after
    order = np.argsort(firsts, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    out_p, out_q = [], []
    for i in order[before < k]:
        q = sides[side[i]][1][after[i] : after[i] + k]
        out_p.append(np.full(len(q), firsts[i]))
        out_q.append(q)
    return np.concatenate(out_p)[:k], np.concatenate(out_q)[:k]
