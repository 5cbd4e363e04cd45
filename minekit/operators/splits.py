"""Search for the best binary split of tree nodes by information gain.

All open nodes of a level are searched together. Rows are ``node_id, row_id, codes, label`` with values as ranks (see ``codes``). Which
ranks a node holds is kept as a bitmap, 64 ranks in one number and 512 numbers in one block, filled by a hash aggregate; the
candidates are picked from the numbers of bits, and a second hash aggregate counts the rows between them. Nothing is
sorted. Where every value is a candidate, the long form (``value_counts``) is summed up in order instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.columns import binary_entropy
from minekit.functions.ranking import chunked, running_totals
from minekit.functions.skew import balanced_join
from minekit.functions.storage import settle

CELL = ["node_id", "feature"]
ORDER = [*CELL, "value"]
WORDS = 512  # 64-bit numbers of one block
BLOCK = 64 * WORDS
BROADCAST_CANDIDATES = 4_000_000


def node_entropy(rows: DataFrame) -> DataFrame:
    """``node_id, n, n_pos, entropy``."""
    return (
        rows.groupBy("node_id")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n_pos"))
        .withColumn("entropy", binary_entropy(F.col("n"), F.col("n_pos")))
    )


def value_counts(rows: DataFrame) -> DataFrame:
    """``node_id, feature, value, n, n_pos``: class counts of every distinct feature value."""
    return (
        rows.select("node_id", "label", F.posexplode("features").alias("feature", "value"))
        .groupBy(*ORDER)
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n_pos"))
    )


def candidate_ranks(n: int, wanted: int) -> np.ndarray:
    """Every ``int(n / wanted)``-th of ``n`` ranks, the smallest first; all when there are no more than ``wanted``."""
    return np.arange(0, n, n // wanted if n > wanted else 1)


def candidate_codes(rows: DataFrame, wanted: int, widest: int) -> DataFrame:
    """``node_id, candidates``: for each feature of a node the ascending codes of its candidates.

    Every ``int(L / wanted)``-th of the ``L`` distinct codes that the rows of the node hold. ``widest`` is the most codes that any feature has:
    up to one block each node and feature is one bitmap, beyond that the blocks with candidates are found from their numbers of bits first.
    """
    long = rows.select("node_id", F.posexplode("codes").alias("feature", "code"))
    lists = _candidate_lists(long, wanted, widest)
    by_feature = lists.groupBy("node_id").agg(F.sort_array(F.collect_list(F.struct("feature", "codes"))).alias("f"))
    return by_feature.select("node_id", F.transform("f", lambda x: x["codes"]).alias("candidates"))


def _candidate_lists(long: DataFrame, wanted: int, widest: int) -> DataFrame:
    """``node_id, feature, codes``: the ascending candidates of ``long`` (node_id, feature, code)."""
    words = long.groupBy(*CELL, F.shiftright("code", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, code & 63))").alias("bits"))
    maps = words.groupBy(*CELL, F.expr("word div " + str(WORDS)).alias("block")).agg(
        F.collect_list(F.struct("word", "bits")).alias("words"), F.sum(F.bit_count("bits")).cast("int").alias("held")
    )
    if widest <= BLOCK:
        picked = _picked(maps.withColumn("ranks", F.lit(None).cast("array<int>")), wanted)
    else:
        maps = settle(maps, "maps")
        listed = maps.groupBy(*CELL).agg(F.collect_list(F.struct("block", "held")).alias("blocks"))
        wanted_blocks = _ranks_by_block(listed, wanted).hint("shuffle_hash")
        picked = _picked(maps.join(wanted_blocks, [*CELL, "block"]), wanted)
    return picked.groupBy(*CELL).agg(F.sort_array(F.flatten(F.collect_list("codes"))).alias("codes"))


def _ranks_by_block(listed: DataFrame, wanted: int) -> DataFrame:
    """``node_id, feature, block, ranks``: which bits of which block are candidates, from the bits of all blocks."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"node_id": [], "feature": [], "block": [], "ranks": []}
            for node, feature, blocks in zip(*(batch.column(c).to_pylist() for c in ("node_id", "feature", "blocks"))):
                blocks = sorted((b["block"], b["held"]) for b in blocks)
                ends = np.cumsum([held for _, held in blocks])
                ranks = candidate_ranks(int(ends[-1]), wanted)
                at = np.searchsorted(ends, ranks, "right")
                for i in np.unique(at):
                    out["node_id"].append(node)
                    out["feature"].append(feature)
                    out["block"].append(blocks[i][0])
                    out["ranks"].append(ranks[at == i] - (ends[i] - blocks[i][1]))
            yield pa.RecordBatch.from_pydict(
                {
                    "node_id": pa.array(out["node_id"], pa.string()), "feature": pa.array(out["feature"], pa.int32()),
                    "block": pa.array(out["block"], pa.int64()), "ranks": pa.array(out["ranks"], pa.list_(pa.int32())),
                }
            )

    return listed.mapInArrow(place, "node_id string, feature int, block bigint, ranks array<int>")


def _picked(maps: DataFrame, wanted: int) -> DataFrame:
    """``node_id, feature, codes``: the codes at the given ranks of each block, or at the candidates' ranks where none are given."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for words, ranks in zip(batch.column("words").to_pylist(), batch.column("ranks").to_pylist()):
                words.sort(key=lambda w: w["word"])
                bits = np.array([w["bits"] for w in words], "<i8").view(np.uint8)
                at = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
                held = np.array([w["word"] for w in words], np.int64)[at >> 6] * 64 + (at & 63)
                codes.append(held[candidate_ranks(len(held), wanted) if ranks is None else ranks])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node_id"), batch.column("feature"), pa.array(codes, pa.list_(pa.int32()))], ["node_id", "feature", "codes"]
            )

    return maps.select(*CELL, "words", "ranks").mapInArrow(pick, "node_id string, feature int, codes array<int>")


def coded_candidates(rows: DataFrame, wanted: int, widest: int) -> DataFrame:
    """``node_id, feature, code, left_n, left_pos, n, n_pos`` for the candidates of all nodes of coded ``rows``.

    Rows are counted between candidates where they lie, so the shuffle carries some ``2 * wanted`` rows per node, feature and task.
    """
    found = settle(candidate_codes(rows, wanted, widest), "candidates")
    size = found.agg(F.sum(F.aggregate("candidates", F.lit(0), lambda n, c: n + F.size(c)))).first()[0] or 0
    if size <= BROADCAST_CANDIDATES:
        placed = rows.join(F.broadcast(found), "node_id")
    else:
        placed = balanced_join(rows, found, ["node_id"], ["row_id"])
    below = F.transform("codes", lambda code, f: F.element_at(F.filter(F.get("candidates", f), lambda c: c <= code), -1))
    long = placed.select("node_id", "label", F.posexplode(below).alias("feature", "code"))
    counts = long.groupBy(*CELL, "code").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") > 0).alias("n_pos"))
    return _left_counts(counts)


def sparse_candidates(rows: DataFrame, zeros: DataFrame, wanted: int, widest: int) -> DataFrame:
    """The same for sparse ``rows`` (node_id, row_id, entries, label); ``zeros`` (feature, zero) tells the code of 0.

    Only listed values are counted. The rows of a node that do not list a feature are its rows less those that do. A feature that no row of a
    node lists has one value there and cannot split it, so it has no candidates.
    """
    positive = F.count_if(F.col("label") > 0).alias("n_pos")
    totals = rows.groupBy("node_id").agg(F.count(F.lit(1)).alias("n"), positive)
    long = rows.select("node_id", "label", F.explode("entries").alias("e")).select("node_id", "label", "e.feature", "e.code")
    listed = long.groupBy(*CELL).agg(F.count(F.lit(1)).alias("n_listed"), positive.alias("pos_listed"))
    absent = settle(
        listed.join(totals.hint("shuffle_hash"), "node_id").where("n_listed < n").join(zeros.hint("shuffle_hash"), "feature").select(
            *CELL, F.col("zero").alias("code"), (F.col("n") - F.col("n_listed")).alias("n"), (F.col("n_pos") - F.col("pos_listed")).alias("n_pos")
        ),
        "absent",
    )
    found = settle(_candidate_lists(long.select(*CELL, "code").unionByName(absent.select(*CELL, "code")), wanted, widest), "candidates")

    def floor_code(df: DataFrame, spread: list[str]) -> DataFrame:
        met = df.join(F.broadcast(found), CELL) if small else balanced_join(df, found, CELL, spread)
        return met.withColumn("code", F.element_at(F.filter("codes", lambda c: c <= F.col("code")), -1))

    small = (found.agg(F.sum(F.size("codes") + 2)).first()[0] or 0) <= BROADCAST_CANDIDATES
    present = long.groupBy(*CELL, "code").agg(F.count(F.lit(1)).alias("n"), positive)
    counts = floor_code(present.unionByName(absent.select(*present.columns)), ["code"])
    return _left_counts(counts.groupBy(*CELL, "code").agg(F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")))


def _left_counts(counts: DataFrame) -> DataFrame:
    """Add the rows below each candidate to ``counts`` (node_id, feature, code, n, n_pos) of the rows from one candidate to the next."""
    parts = counts.groupBy(*CELL).agg(
        F.collect_list(F.struct("code", "n", "n_pos")).alias("parts"), F.sum("n").alias("n"), F.sum("n_pos").alias("n_pos")
    )
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_pos"))

    def left_of(part):
        before = F.filter("parts", lambda p: p["code"] < part["code"])
        sums = F.aggregate(before, nothing, lambda s, p: F.struct((s["n"] + p["n"]).alias("n"), (s["n_pos"] + p["n_pos"]).alias("n_pos")))
        return F.struct(part["code"].alias("code"), sums.alias("left"))

    each = parts.select(*CELL, "n", "n_pos", F.explode(F.transform("parts", left_of)).alias("c"))
    return each.select(
        *CELL, "c.code", F.col("c.left.n").alias("left_n"), F.col("c.left.n_pos").alias("left_pos"), "n", "n_pos"
    )


def split_candidates(counts: DataFrame, wanted: int = 10) -> DataFrame:
    """Every ``int(L / wanted)``-th of the ``L`` distinct values of a feature, the smallest first.

    All values are candidates when there are no more than ``wanted``, or when ``wanted`` is 0. The
    counts below each candidate cover all values, candidates or not.
    """
    sums = {"values": "1", "n": "n", "pos": "n_pos"}
    ranked = running_totals(chunked(counts, ORDER, "values"), CELL, ["value"], sums)
    stride = F.lit(1)
    if wanted > 0:
        stride = F.when(F.col("all_values") > wanted, F.floor(F.col("all_values") / wanted)).otherwise(1)
    return ranked.where(F.col("before_values") % stride == 0).select(
        *ORDER,
        F.col("before_n").alias("left_n"),
        F.col("before_pos").alias("left_pos"),
        F.col("all_n").alias("n"),
        F.col("all_pos").alias("n_pos"),
    )


def split_gains(candidates: DataFrame) -> DataFrame:
    """Add ``gain`` of sending values below the candidate left and the others right.

    Rounded to 12 places, so that ties do not hang on the last bits of a logarithm.
    """
    n, n_pos = F.col("n"), F.col("n_pos")
    left_n, left_pos = F.col("left_n"), F.col("left_pos")
    right_n, right_pos = n - left_n, n_pos - left_pos
    gain = (
        binary_entropy(n, n_pos)
        - left_n / n * F.when(left_n > 0, binary_entropy(left_n, left_pos)).otherwise(0.0)
        - right_n / n * binary_entropy(right_n, right_pos)
    )
    # adding 0.0 turns a negative zero into zero
    return candidates.withColumn("gain", F.round(gain, 12) + 0.0)


def best_split_per_feature(gains: DataFrame) -> DataFrame:
    """The best candidate of each node and feature; the larger value wins a tie."""
    best = F.max(F.struct("gain", "value", "left_n", "left_pos", "n", "n_pos")).alias("best")
    return gains.groupBy(*CELL).agg(best).select(
        *CELL, "best.gain", F.col("best.value").alias("split"), "best.left_n", "best.left_pos", "best.n", "best.n_pos"
    )


def best_split(per_feature: DataFrame) -> DataFrame:
    """The best split of each node; ties go to the larger split value, then the larger feature."""
    first = ["gain", "split", "feature"]
    best = F.max(F.struct(*first, *[c for c in per_feature.columns if c not in [*CELL, *first]])).alias("best")
    return per_feature.groupBy("node_id").agg(best).select("node_id", "best.*")
