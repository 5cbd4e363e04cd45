"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact confirmation.

A document is the set of its distinct word shingles. The steps:

1. Where the texts are read, each set becomes a key of the whole set, band hashes of MinHash samples, and two
   *odd sketches*: MinHash samples by one permutation (the smallest hash in each of many bins) are folded
   into a bitmap in which each sample flips one bit. Samples that two documents share cancel in the XOR of
   their sketches, so its population count tells how many differ, and most precisely so
   for high similarities. Small sets use many bins, so that nearly the whole set is sampled; large sets use few.
2. Documents with equal sets are one class; its smallest id stands for it.
3. Each class is paired with the smallest class that it shares a bucket with, then, where that leaves it
   unconnected, with the smallest class of every bucket. Pairs whose sketches differ too much are dropped, the
   others are confirmed on the full sets.
4. Classes of one bucket that are not yet connected after that are paired where they share one of their rarest shingles (an exact
   prefix filter), so that no link between different texts is lost that the bands show; the sketches
   judge these pairs too. Links inside a component add nothing.
5. The components of all confirmed links are found by passing on minima with path shortening.

Sets are compared as sets of 64-bit hashes of shingles.

Cases: words are maximal runs of bytes other than the separators, A-Z lower-cased. A text with fewer words
than a shingle is one shingle of all of them. Null and empty texts and texts without words have no
shingle, link with nothing, and stand for themselves. Rows without a ``doc_id`` link with nothing,
have no component and are kept. Repeated rows are all returned; rows with equal id are one node. Columns beyond
``doc_id`` and ``text`` are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.storage import Stored, settle, stored
from minekit.llm.batches import SPACES, Words, fresh_name, map_batches, mixed, text_slices
from minekit.operators.setjoin import prefix_candidates

SKETCH_WORDS = 16  # 1024 bits
BINS = (16384, 512)
SMALL_SET = 1000
_SHINGLE = np.uint64(0xD1342543DE82EF95)
_CHUNK = 1 << 15
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class NearDuplicates:
    """Words per shingle, similarity in percent, and the bands of MinHash samples.

    With 32 bands of 5 a pair at similarity 0.8 shares a bucket with probability 1 - 3e-6. A pair is confirmed exactly
    unless its sketches differ in more bits than a pair at the wanted similarity does, plus ``deviations`` standard
    deviations of the sampling and of the bitmap each.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    deviations: float = 4.0
    seed: int = 7

    def signatures(self, docs: DataFrame) -> DataFrame:
        """``doc_id, mark, n_shingles, k1, k2, bands, sketch, n_samples`` of every row.

        ``k1, k2`` name the whole set, ``mark`` hashes the text.
        """
        k, bands, rows, seed = self.shingle, self.bands, self.rows, self.seed

        def sign(batches: Iterator[pa.RecordBatch]):
            words, family = Words(SPACES), _Family(bands, rows, seed)
            for batch in batches:
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    sets, bounds = shingle_sets(words, raw, offsets, k)
                    columns = family.sign(sets, bounds)
                    for name in ("doc_id", "mark"):
                        columns[name] = batch.column(name).slice(first, end - first)
                    columns["n_shingles"] = np.diff(bounds)
                    yield columns

        schema = (
            "doc_id bigint, mark bigint, n_shingles bigint, k1 bigint, k2 bigint, bands array<bigint>, sketch array<bigint>, "
            "n_samples array<int>"
        )
        return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("mark")), sign, schema)

    def sets(self, docs: DataFrame) -> DataFrame:
        """``rep, shingles`` with the full hashed set of each document."""
        k = self.shingle

        def full(batches: Iterator[pa.RecordBatch]):
            words = Words(SPACES)
            for batch in batches:
                ids = batch.column("rep")
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    sets, bounds = shingle_sets(words, raw, offsets, k)
                    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))
                    yield {"rep": ids.slice(first, end - first), "shingles": listed}

        return map_batches(docs.select("rep", "text"), full, "rep bigint, shingles array<bigint>")

    def components(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_shingles, component_id, kept`` of every row."""
        return self._judged(docs).drop("mark")

    def _judged(self, docs: DataFrame) -> DataFrame:
        signed = settle(self.signatures(docs), "signatures")
        keys = ["k1", "k2", "n_shingles"]
        classes = (
            signed.where("n_shingles > 0 and doc_id is not null")
            .groupBy(*keys)
            .agg(F.min("doc_id").alias("rep"))
        )
        # one row carries the bands of a class: that of its smallest id
        named = classes.select(F.col("rep").alias("doc_id"), "k1", "k2", F.col("rep"))
        own = signed.join(named, ["doc_id", "k1", "k2"])
        reps = settle(own.dropDuplicates(["rep", *keys]).select("rep", *keys, "bands", "sketch", "n_samples"), "classes")
        linked = self._links(docs, reps)
        labels = connected(linked)

        named = reps.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("rep").alias("_rep"))
        same = [F.col(c) == F.col(f"_{c}") for c in keys]
        found = signed.select("doc_id", "mark", *keys).join(named, same, "left")
        names = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
        placed = found.join(names, F.col("_rep") == F.col("_node"), "left")
        known = F.col("doc_id").isNotNull()
        component = F.when(known, F.coalesce("_label", "_rep", "doc_id"))
        return placed.select(
            "doc_id", "mark", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
        )

    def deduplicated(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs``, with all their columns, without all but one document of each component.

        Rows that share ``doc_id`` and text are copies; any one of them stays. Rows of one ``doc_id`` with unlike texts are judged
        each by its own text, so no text is lost. Rows without ``doc_id`` all stay.
        """
        judged = settle(self._judged(docs), "components").where("doc_id is not null")
        rows = judged.groupBy("doc_id", "mark").agg(F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
        settled = settle(rows.where("not kept or n > 1"), "copies")
        away, repeated = settled.where("not kept"), settled.where("kept")
        kept = _matching(docs, away, "left_anti")
        if repeated.isEmpty():
            return kept
        mark = fresh_name()
        once = _matching(kept, repeated, "left_semi").withColumn(mark, F.xxhash64("text")).dropDuplicates(["doc_id", mark])
        return _matching(kept, repeated, "left_anti").unionByName(once.drop(mark))

    def _links(self, docs: DataFrame, reps: DataFrame) -> DataFrame:
        """``a, b`` for confirmed links that connect the classes."""
        filed = reps.select("rep", F.posexplode("bands").alias("band", "hash")).select(
            "rep", F.xxhash64("band", "hash").alias("bucket")
        )
        full = filed.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
        members = settle(filed.join(full.select("bucket", "hub"), "bucket"), "buckets")

        # each class with the smallest class that it meets anywhere
        first = members.groupBy(F.col("rep").alias("b")).agg(F.min("hub").alias("a")).where("a < b")
        near = settle(self._close(first.select("a", "b"), reps), "near")
        sure = settle(self._confirm(near, docs), "links")

        # with the smallest of every bucket, where that is not connected yet
        star = members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))
        open_star = _across(star, connected(sure)).distinct().join(near.select("a", "b"), ["a", "b"], "left_anti")
        more = settle(self._close(open_star, reps), "near")
        sure = settle(sure.unionByName(self._confirm(more, docs)), "links")

        # members of a bucket that are still apart meet through their rarest shingles only
        node = connected(sure).select(F.col("node").alias("rep"), "label")
        parts = members.join(node, "rep", "left").select("bucket", "rep", F.coalesce("label", "rep").alias("part"))
        split = parts.groupBy("bucket").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low < _high")
        apart = settle(parts.join(split.select("bucket"), "bucket").select("rep", "part").distinct(), "apart")
        sets = self._sets_of(apart.select("rep"), docs).join(apart, "rep").select(F.col("rep").alias("id"), "part", F.col("shingles").alias("items"))
        met = settle(prefix_candidates(settle(sets, "apart-sets"), self.percent), "candidates")
        tested = near.select("a", "b").union(more.select("a", "b"))
        last = settle(self._close(met.join(tested, ["a", "b"], "left_anti"), reps), "near")
        return settle(sure.unionByName(self._confirm(last, docs)), "links")

    def _allowed(self) -> Column:
        """Whether odd sketches and sizes allow the similarity."""
        p = self.percent / 100
        n = F.col("n_a") + F.col("n_b")

        def within(which: int) -> Column:
            """By the sketch with ``BINS[which]`` bins."""
            bins, bits = BINS[which], 64 * SKETCH_WORDS
            first = which * SKETCH_WORDS
            flips = sum(
                (F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(first, first + SKETCH_WORDS)),
                F.lit(0),
            )
            samples = F.col("samples_a")[which] + F.col("samples_b")[which]
            # at similarity p: bins that hold a sample of either, those with an equal one, and those that differ
            filled = bins * (1 - F.exp(-n / ((1 + p) * bins)))
            left_out = F.greatest(1 - samples / n, F.lit(0.0))
            differ = F.greatest(samples - 2 * p * filled, F.lit(0.0))
            differ = differ + 2 * self.deviations * F.sqrt(0.25 * filled * left_out + 0.25)
            fade = F.exp(-4 * differ / bits)
            spread = F.sqrt(F.greatest(bits / 4 * (1 - fade) - differ * fade, F.lit(1.0)))
            return flips <= bits / 2 * (1 - F.exp(-2 * differ / bits)) + self.deviations * spread

        sizes = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        return sizes & F.when(F.greatest("n_a", "n_b") <= SMALL_SET, within(0)).otherwise(within(1))

    def _close(self, pairs: DataFrame, reps: DataFrame) -> DataFrame:
        """The pairs whose sketches and sizes allow the similarity; with their sizes."""
        side = reps.select("rep", "sketch", "n_shingles", "n_samples")
        both = pairs.join(side.toDF("a", "sketch_a", "n_a", "samples_a"), "a")
        both = both.join(side.toDF("b", "sketch_b", "n_b", "samples_b"), "b")
        return both.where(self._allowed()).select("a", "b", "n_a", "n_b")

    def _sets_of(self, ids: DataFrame, docs: DataFrame) -> DataFrame:
        """``rep, shingles`` of the classes that the stored ``ids`` (``rep``) name."""
        wanted = ids.distinct()
        if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
            wanted = F.broadcast(wanted)  # a number a row
        texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").where("text is not null")
        return settle(self.sets(texts.join(wanted, "rep", "left_semi")).dropDuplicates(["rep", "shingles"]), "sets")

    def _confirm(self, near: DataFrame, docs: DataFrame) -> DataFrame:
        """The pairs of the stored ``near`` whose full sets are similar enough."""
        sets = self._sets_of(near.select(F.col("a").alias("rep")).union(near.select("b")), docs)
        left = sets.toDF("a", "_xa")
        both = near.join(left, "a").join(sets.toDF("b", "_xb"), "b")
        shared = F.size(F.array_intersect("_xa", "_xb"))
        enough: Column = shared * 100 >= (F.size("_xa") + F.size("_xb") - shared) * self.percent
        return both.where(enough).select("a", "b").distinct()


def _matching(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` that have (``left_semi``) or have not a row in the stored ``marks`` (doc_id, mark)."""
    doc_id, mark = fresh_name(), fresh_name()
    named = marks.select(F.col("doc_id").alias(doc_id), F.col("mark").alias(mark))
    few = marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    same = (F.col("doc_id").cast("bigint") == F.col(doc_id)) & (F.xxhash64("text") == F.col(mark))
    return docs.join(F.broadcast(named) if few else named, same, how)


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose ends are in different components."""
    named = pairs.join(labels.toDF("a", "_la"), "a", "left").join(labels.toDF("b", "_lb"), "b", "left")
    return named.where(F.coalesce("_la", "a") != F.coalesce("_lb", "b")).select("a", "b")


def connected(links: DataFrame) -> DataFrame:
    """``node, label`` with the smallest node reachable over stored ``links`` (``a, b``).

    Each round takes the smallest label among the neighbours and then the label of the label, so
    the number of rounds grows with the logarithm of the longest path.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label"))
    state: Stored = stored(first, "labels")
    while True:
        labels = state.table
        seen = both.join(labels.toDF("b", "_label"), "b").groupBy("a").agg(F.min("_label").alias("_low"))
        lowered = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "_low").alias("low")
        )
        ends = labels.toDF("low", "_end")
        step = lowered.join(ends, "low", "left").select("node", "old", F.least("low", F.coalesce("_end", "low")).alias("label"))
        after = stored(step, "labels")
        moved = after.table.where("old <> label").limit(1).count()
        state.discard()
        state = Stored(after.table.select("node", "label"), after.path)
        if not moved:
            return state.table


def shingle_sets(words: Words, raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text and where each text's run begins."""
    hashes, _, _, bounds = words(raw, offsets)
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - k + 1, np.minimum(sizes, 1)))
    rolled = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for i in range(k):
        rolled = mixed(rolled * _SHINGLE + hashes[i : i + len(rolled)]) if len(rolled) else rolled
    starts = np.cumsum(np.maximum(sizes - k + 1, np.minimum(sizes, 1)))
    at = np.arange(len(owner)) - np.concatenate(([0], starts))[owner] + bounds[owner]
    short = (sizes < k)[owner]
    values = np.empty(len(owner), np.uint64)
    values[~short] = rolled[at[~short]]
    for place in np.flatnonzero(short):
        text = owner[place]
        value = np.array([sizes[text]], np.uint64)
        for i in range(bounds[text], bounds[text + 1]):
            value = mixed(value * _SHINGLE + hashes[i : i + 1])
        values[place] = value[0]
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.searchsorted(owner[fresh], np.arange(len(sizes) + 1))


class _Family:
    """MinHash samples, their bands and odd sketches for runs of sets."""

    def __init__(self, bands: int, rows: int, seed: int):
        draw = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        n = bands * rows
        self.a = draw.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = draw.integers(0, 1 << 63, n, dtype=np.uint64)
        self.salt = draw.integers(0, 1 << 63, dtype=np.uint64)

    def sign(self, sets: np.ndarray, bounds: np.ndarray) -> dict:
        n_texts, n = len(bounds) - 1, len(self.a)
        sizes = np.diff(bounds)
        filled = np.flatnonzero(sizes)
        samples = np.full((n, n_texts), np.iinfo(np.uint64).max, np.uint64)
        if len(filled):
            # pieces of bounded length; a text longer than a piece is folded over several
            cuts = np.unique(np.concatenate((bounds[filled], np.arange(0, len(sets), _CHUNK))))
            owner = np.searchsorted(bounds, cuts, "right") - 1
            for low in range(0, len(sets), _CHUNK):
                part = sets[low : low + _CHUNK]
                own = (cuts >= low) & (cuts < low + len(part))
                places, texts = cuts[own] - low, owner[own]
                value = np.empty_like(part)
                for i in range(n):
                    np.multiply(part, self.a[i], out=value)
                    np.add(value, self.b[i], out=value)
                    lowest = np.minimum.reduceat(value, places)
                    samples[i, texts] = np.minimum(samples[i, texts], lowest)
        banded = np.zeros((self.bands, n_texts), np.uint64)
        for band in range(self.bands):
            for i in range(band * self.rows, (band + 1) * self.rows):
                banded[band] = mixed(banded[band] * _SHINGLE + samples[i])
        owner = np.repeat(np.arange(n_texts), sizes)
        sketches, counts = zip(*(self._odd_sketch(sets, owner, n_texts, bins) for bins in BINS))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(sets), dtype=np.uint64)))
        more = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(sets ^ self.salt), dtype=np.uint64)))
        return {
            "k1": (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64),
            "k2": (more[bounds[1:]] - more[bounds[:-1]]).view(np.int64),
            "bands": _lists(banded),
            "sketch": _lists(np.concatenate(sketches)),
            "n_samples": pa.array(list(np.stack(counts, 1).astype(np.int32)), pa.list_(pa.int32())),
        }

    def _odd_sketch(self, sets: np.ndarray, owner: np.ndarray, n_texts: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
        """The bitmap (a column per text) and the number of samples: the first hash of each bin, as sets are sorted."""
        place = owner * bins + (sets >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
        first = np.ones(len(sets), bool)
        first[1:] = place[1:] != place[:-1]
        bits = 64 * SKETCH_WORDS
        bit = (mixed(sets[first] ^ self.salt) % np.uint64(bits)).astype(np.int64)
        flips = np.bincount(owner[first] * bits + bit, minlength=n_texts * bits).reshape(n_texts, bits) & 1
        packed = np.packbits(flips.astype(np.uint8), axis=1).view(np.uint64).reshape(n_texts, SKETCH_WORDS)
        return packed.T, np.bincount(owner[first], minlength=n_texts)


def _lists(rows: np.ndarray) -> pa.Array:
    width, n = rows.shape
    flat = np.ascontiguousarray(rows.T).reshape(-1).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width), pa.int32()), pa.array(flat))
