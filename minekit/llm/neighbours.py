"""Approximate nearest neighbours by inner product over learned partitions.

*Fit*, on a bounded sample of distinct vectors: a graph of nearest neighbours, cut into parts of equal size (halving
along principal directions, then moves and swaps that lower the number of cut edges), and a small network
that learns to tell the part of a vector. How many parts a query visits is measured on sampled rows that the partition and
the network have not seen, as queries and as their neighbours alike: the fewest that hold ``recall + margin`` of the true neighbours.

*Second level*: a part of more than ``split_rows`` entries is cut again in the same way, by a partition and a network of its own, fitted in
a task on a bounded sample of the part that the first level has not drawn. The inner parts take the place of the large one. A query ranks the parts of
both levels by the product of their probabilities, and its visits are measured on the same unseen rows, so that both levels are
judged together.

*Index*: every vector goes to its most probable part. Equal vectors are one entry with their smallest
ids, so copies cost nothing. A part of more than ``block_rows`` entries is cut into blocks, and so are the queries that visit it.

*Search*: a query visits all blocks of its most probable parts; all entries there are measured in double
precision, and the best of all blocks are merged. A query that finds fewer than ``k`` others there visits all parts.

Cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without
``vec_id`` or vectors of another length than most of the sample. Ties go to the smaller id. Repeated
rows count once. With fewer candidates than ``k`` all are returned; a table that fits into the sample with one part is
searched whole. Columns beyond ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minekit.functions.storage import settle
from minekit.llm.batches import map_batches

SALTS = 64
DRAWS = 1 << 20
ROUTED = 256  # rows whose probabilities of all parts are held at once
LISTED = 1 << 20  # parts in one batch of routed rows


@dataclass
class Router:
    """The trained network: probabilities of parts for rows of vectors."""

    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    visits: int
    dimension: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-30)).astype(np.float32)
        return np.maximum(x @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    @property
    def n_parts(self) -> int:
        return len(self.out_bias)

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` most probable parts of each row, best first."""
        return np.argsort(-self.logits(x), axis=1, kind="stable")[:, :n]

    def filed(self, x: np.ndarray) -> np.ndarray:
        """The part that holds each row."""
        return self.parts(x, 1)[:, 0]


class Nested:
    """Two levels: ``outer``, and for some of its parts a router whose parts take the place of that part."""

    def __init__(self, outer: Router, inner: dict[int, Router]):
        self.outer, self.inner, self.visits, self.dimension = outer, inner, 1, outer.dimension
        self.widths = np.array([inner[p].n_parts if p in inner else 1 for p in range(outer.n_parts)])
        self.first = np.concatenate(([0], np.cumsum(self.widths)))

    @property
    def n_parts(self) -> int:
        return int(self.first[-1])

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` parts of each row with the largest products of both probabilities, best first."""
        out = np.empty((len(x), n), np.int64)
        for low in range(0, len(x), ROUTED):
            own = x[low : low + ROUTED]
            score = np.repeat(_log_shares(self.outer.logits(own)), self.widths, axis=1)
            for p, router in self.inner.items():
                score[:, self.first[p] : self.first[p + 1]] += _log_shares(router.logits(own))
            out[low : low + ROUTED] = np.argsort(-score, axis=1, kind="stable")[:, :n]
        return out

    def filed(self, x: np.ndarray) -> np.ndarray:
        """The part that holds each row: the inner part within its most probable outer part."""
        outer = self.outer.filed(x)
        out = self.first[outer]
        for p, router in self.inner.items():
            own = np.flatnonzero(outer == p)
            if len(own):
                out[own] += router.filed(x[own])
        return out


def _log_shares(logits: np.ndarray) -> np.ndarray:
    z = logits - logits.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


@dataclass(frozen=True)
class LearnedPartitions:
    """``sample_rows`` bounds what the fit sees; ``per_part`` sample rows make a part, ``max_parts`` at most.

    ``held_out`` is the share of the sample that only measures recall. Parts of more than ``split_rows`` entries get a second level of
    ``max_parts`` parts at most, of ``block_rows`` entries or more on average, from ``sample_rows`` of their entries.
    """

    k: int = 20
    sample_rows: int = 10_000
    per_part: int = 80
    max_parts: int = 96
    graph_degree: int = 10
    recall: float = 0.95
    margin: float = 0.02
    held_out: float = 0.25
    block_rows: int = 20_000
    query_rows: int = 20_000
    split_rows: int = 200_000
    hidden: int = 128
    epochs: int = 15
    seed: int = 5

    def valid(self, vectors: DataFrame) -> DataFrame:
        """``vec_id, embedding`` of the rows that take part."""
        v = F.col("embedding")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = vectors.select(F.col("vec_id").cast("bigint"), v.cast("array<double>").alias("embedding"))
        return rows.where("vec_id is not null and embedding is not null").where(finite & F.exists(v, lambda x: x != 0))

    def entries(self, vectors: DataFrame) -> DataFrame:
        """``entry, embedding, ids``: each distinct vector, its smallest id and its ``k + 1`` smallest ids."""
        keyed = self.valid(vectors).distinct()
        salted = Window.partitionBy("embedding", "_salt").orderBy("vec_id")
        whole = Window.partitionBy("embedding").orderBy("vec_id")
        few = (
            keyed.withColumn("_salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
            .withColumn("_rank", F.row_number().over(salted))
            .where(F.col("_rank") <= self.k + 1)
            .withColumn("_rank", F.row_number().over(whole))
            .where(F.col("_rank") <= self.k + 1)
        )
        listed = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # k + 1 at most
        return listed.select(F.col("ids")[0].alias("entry"), "embedding", "ids")

    def fit(self, entries: DataFrame) -> Router | Nested | None:
        """Partition and router from a sample of stored entries; None when there are none."""
        n = entries.count()
        cut = int(min(1.0, self.sample_rows / n) * DRAWS) if n else 0
        sample = entries.where(_draw() < cut)
        rows = [r[1] for r in sorted(sample.select("entry", "embedding").collect())]  # about ``sample_rows``
        if not rows:
            return None
        sizes, counts = np.unique([len(r) for r in rows], return_counts=True)
        dimension = int(sizes[counts.argmax()])
        x = np.array([r for r in rows if len(r) == dimension])
        unseen = np.random.default_rng(self.seed).random(len(x)) < self.held_out
        if unseen.sum() < 2 * self.k or (~unseen).sum() < 2 * self.per_part:
            unseen[:] = False  # too few to be told apart: one part
        seen = x[~unseen]
        n_parts = int(np.clip(len(seen) // self.per_part, 1, self.max_parts)) if unseen.any() else 1
        router = self._router(seen, n_parts)
        if unseen.any() and n > self.split_rows:
            router = self._nested(entries, router, cut)
        if router.n_parts > 1:
            # as many neighbours as fall into the share of the rows that is measured
            k = max(1, round(self.k * unseen.mean()))
            router.visits = self._visits(router, x[unseen], self._graph(x[unseen], k)[1])
        return router

    def _router(self, x: np.ndarray, n_parts: int) -> Router:
        graph, _ = self._graph(x, 0)
        return self._train(x, balanced_parts(x, graph, n_parts), graph, n_parts)

    def _nested(self, entries: DataFrame, router: Router, cut: int) -> Router | Nested:
        """``router`` with a second level for its large parts; each is fitted in one task on entries from draw ``cut`` on."""
        spark = entries.sparkSession
        fitting = entries.where(F.size("embedding") == router.dimension)
        shared = spark.sparkContext.broadcast(router)
        shape = "entry bigint, embedding array<double>, ids array<bigint>, parts array<int>"

        def placed(rows: DataFrame) -> DataFrame:
            return map_batches(rows, _filing(shared), shape).select("entry", "embedding", F.col("parts")[0].alias("part"))

        sizes = placed(fitting).groupBy("part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > self.split_rows).collect()
        # the draws behind the first sample; ``max_parts`` rows at most
        ends = [(r.part, r.n, cut + int(min(1.0, self.sample_rows / r.n) * (DRAWS - cut))) for r in sizes]
        if not ends:
            return router
        drawn = placed(fitting.where((_draw() >= cut) & (_draw() < max(e for _, _, e in ends))))
        large = F.broadcast(spark.createDataFrame(ends, "part int, n bigint, end int"))
        drawn = drawn.join(large, "part").where(_draw() < F.col("end")).select("part", "n", "entry", "embedding")

        def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            x = np.stack(rows.sort_values("entry")["embedding"].to_numpy())
            n_parts = min(len(x) // self.per_part, -(-int(rows["n"].iloc[0]) // self.block_rows), self.max_parts)
            models = [pickle.dumps(self._router(x, n_parts))] if n_parts > 1 else []
            return pd.DataFrame({"part": [key[0]] * len(models), "model": models})

        models = drawn.groupBy("part").applyInPandas(fit, "part int, model binary").collect()  # a network per large part
        inner = {r.part: pickle.loads(r.model) for r in sorted(models)}
        return Nested(router, inner) if inner else router

    def _graph(self, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest neighbours among the rows: a few for the graph, ``k`` to measure recall."""
        degree, k = min(self.graph_degree, len(x) - 1), min(k, len(x) - 1)
        near = np.empty((len(x), max(degree, k)), np.int64)
        for low in range(0, len(x), 1_000):
            score = x[low : low + 1_000] @ x.T
            score[np.arange(len(score)), np.arange(low, low + len(score))] = -np.inf
            width = near.shape[1]
            top = np.argpartition(-score, width - 1, axis=1)[:, :width] if width else near[low : low + 1_000]
            order = np.argsort(-np.take_along_axis(score, top, 1), axis=1, kind="stable")
            near[low : low + 1_000] = np.take_along_axis(top, order, 1)
        return near[:, :degree], near[:, :k]

    def _train(self, x: np.ndarray, part: np.ndarray, near: np.ndarray, n_parts: int) -> Router:
        """A network with one hidden layer that tells the parts of a row and its neighbours, by Adam on the cross entropy."""
        share = np.zeros((len(x), n_parts), np.float32)
        for column in (part, *part[near].T):
            share[np.arange(len(x)), column] += np.float32(1 / (1 + near.shape[1]))
        draw = np.random.default_rng(self.seed)
        shapes = [(x.shape[1], self.hidden), (self.hidden,), (self.hidden, n_parts), (n_parts,)]
        weights = [
            (draw.normal(0, np.sqrt(2 / s[0]), s) if len(s) == 2 else np.zeros(s)).astype(np.float32) for s in shapes
        ]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        unit = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
        step = 0
        for _ in range(self.epochs):
            order = draw.permutation(len(unit))
            for low in range(0, len(order), 256):
                rows = order[low : low + 256]
                a = unit[rows]
                h = np.maximum(a @ weights[0] + weights[1], 0)
                z = h @ weights[2] + weights[3]
                z = np.exp(z - z.max(1, keepdims=True))
                z /= z.sum(1, keepdims=True)
                z -= share[rows]
                z /= len(rows)
                back = (z @ weights[2].T) * (h > 0)
                step += 1
                for i, g in enumerate((a.T @ back, back.sum(0), h.T @ z, z.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    scale = np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    weights[i] -= np.float32(0.003 * scale) * first[i] / (np.sqrt(second[i]) + np.float32(1e-8))
        return Router(*weights, visits=1, dimension=x.shape[1])

    def _visits(self, router: Router | Nested, x: np.ndarray, near: np.ndarray) -> int:
        """The fewest visited parts that hold ``recall + margin`` of the neighbours of the rows ``x``."""
        n_parts = router.n_parts
        if near.shape[1] == 0:
            return n_parts
        home = router.filed(x)
        counts = np.zeros(n_parts, np.int64)
        for low in range(0, len(x), ROUTED):
            order = router.parts(x[low : low + ROUTED], n_parts)
            place = np.empty_like(order)
            np.put_along_axis(place, order, np.broadcast_to(np.arange(n_parts), order.shape), 1)
            reached = np.take_along_axis(place, home[near[low : low + ROUTED]], 1)
            counts += np.bincount(reached.ravel(), minlength=n_parts)
        share = np.cumsum(counts) / near.size
        return min(n_parts, int(np.searchsorted(share, min(self.recall + self.margin, 1.0)) + 1))

    def search(self, vectors: DataFrame, is_query) -> DataFrame:
        """``query_id, rank, vec_id, score`` for every valid row of ``vectors`` for which ``is_query`` holds."""
        spark = vectors.sparkSession
        entries = settle(self.entries(vectors), "entries")
        router = self.fit(entries)
        schema = "query_id bigint, rank int, vec_id bigint, score double"
        if router is None:
            return spark.createDataFrame([], schema)
        shared = spark.sparkContext.broadcast(router)

        fitting = entries.where(F.size("embedding") == router.dimension)
        shape = "entry bigint, embedding array<double>, ids array<bigint>, parts array<int>"
        filed = settle(map_batches(fitting, _filing(shared), shape), "filed").withColumn("part", F.col("parts")[0])
        blocks = filed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / self.block_rows).cast("int").alias("n"))
        blocks = F.broadcast(blocks)  # a row per part
        index = filed.join(blocks, "part").select(
            "part", F.pmod(F.xxhash64("entry"), F.col("n")).cast("int").alias("block"), "entry", "embedding", "ids"
        )

        asked = self.valid(vectors.where(is_query)).where(F.size("embedding") == router.dimension)
        asked = settle(
            asked.join(filed.select("embedding", "entry"), "embedding").select("vec_id", "entry").distinct(), "asked"
        )
        wanted = fitting.join(asked.select("entry").distinct(), "entry", "left_semi")
        n_parts = router.n_parts

        def nearest(queries: DataFrame, visits: int) -> DataFrame:
            sent = map_batches(queries, _visiting(shared, visits), shape).select("entry", "embedding", F.explode("parts").alias("part"))
            sent = settle(sent, "sent")
            asking = sent.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / self.query_rows).cast("int").alias("m"))
            asking = F.broadcast(asking)  # a row per part
            left = sent.join(blocks, "part").join(asking, "part").select(
                "part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"),
                F.pmod(F.xxhash64("entry"), F.col("m")).cast("int").alias("row"), "entry", "embedding",
            )
            right = index.join(asking, "part").withColumn("row", F.explode(F.sequence(F.lit(0), F.col("m") - 1))).drop("m")
            keys = ["part", "block", "row"]
            best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
                self._measure(), "entry bigint, part int, found array<struct<loss:double,vec_id:bigint>>"
            )
            first = F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, self.k + 1).alias("found")
            return best.groupBy("entry", "part").agg(first).groupBy("entry").agg(first)

        merged = settle(nearest(wanted, router.visits), "merged")
        if router.visits < n_parts:
            few = merged.where(F.size("found") <= self.k).select("entry")
            again = wanted.select("entry").join(merged.where(F.size("found") > self.k), "entry", "left_anti").union(few).distinct()
            again = settle(again, "again")
            if not again.isEmpty():
                rest = nearest(wanted.join(again, "entry", "left_semi"), n_parts)
                merged = merged.join(again, "entry", "left_anti").unionByName(rest)
        listed = asked.join(merged, "entry").select(
            F.col("vec_id").alias("query_id"),
            F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, self.k).alias("found"),
        )
        return listed.select("query_id", F.posexplode("found").alias("place", "x")).select(
            "query_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("x.vec_id").alias("vec_id"),
            (-F.col("x.loss")).alias("score"),
        )

    def _measure(self):
        keep = self.k + 1

        def measure(key: tuple, queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
            rows = []
            if len(queries) and len(index):
                index = index.sort_values("entry")
                table = np.stack(index["embedding"].to_numpy())
                lists = index["ids"].to_list()
                names, asked = queries["entry"].to_numpy(), queries["embedding"].to_list()
                for low in range(0, len(asked), 200):
                    score = np.stack(asked[low : low + 200]) @ table.T
                    for name, own in zip(names[low : low + 200], score):
                        # the best entries with all that tie with the last of them
                        edge = np.partition(own, -keep)[-keep] if len(own) > keep else -np.inf
                        top = np.flatnonzero(own >= edge)
                        found = sorted((-own[i], int(x)) for i in top for x in lists[i])[:keep]
                        rows.append((name, key[0], [{"loss": a, "vec_id": b} for a, b in found]))
            return pd.DataFrame(rows, columns=["entry", "part", "found"])

        return measure


def _draw() -> Column:
    """A number below ``DRAWS`` from the vector of an entry."""
    return F.pmod(F.xxhash64("embedding"), F.lit(DRAWS))


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _filing(shared: Broadcast):
    """Adds to each entry the part that holds it, as the only one of ``parts``."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if len(batch):
                yield {**{c: batch.column(c) for c in batch.schema.names}, "parts": list(shared.value.filed(_vectors(batch))[:, None])}

    return run


def _visiting(shared: Broadcast, n: int):
    """Adds to each entry the ``n`` parts that it visits."""

    def run(batches: Iterator[pa.RecordBatch]):
        step = max(1, LISTED // n)
        for batch in batches:
            for low in range(0, len(batch), step):
                own = batch.slice(low, step)
                yield {**{c: own.column(c) for c in own.schema.names}, "parts": list(shared.value.parts(_vectors(own), n))}

    return run


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int) -> np.ndarray:
    """A part for each row: sizes differ by a few percent at most, and few edges of ``graph`` are cut."""
    n = len(x)
    part = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, n_parts)]
    while todo:
        rows, first, many = todo.pop()
        if many == 1:
            part[rows] = first
            continue
        half = many // 2
        centred = x[rows] - x[rows].mean(0)
        axis = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ axis, kind="stable")]
        cut = len(rows) * half // many
        todo += [(order[:cut], first, half), (order[cut:], first + half, many - half)]
    if n_parts == 1 or not graph.shape[1]:
        return part
    # neighbours in both directions
    source = np.concatenate((np.repeat(np.arange(n), graph.shape[1]), graph.ravel()))
    target = np.concatenate((graph.ravel(), np.repeat(np.arange(n), graph.shape[1])))
    order = np.argsort(source, kind="stable")
    source, target = source[order], target[order]
    bounds = np.searchsorted(source, np.arange(n + 1))
    most = int(np.ceil(n / n_parts * 1.05))
    least = int(np.floor(n / n_parts * 0.95))
    sizes = np.bincount(part, minlength=n_parts)
    for _ in range(8):
        moved = 0
        for i in range(n):
            votes = np.bincount(part[target[bounds[i] : bounds[i + 1]]], minlength=n_parts)
            own, votes_own = part[i], votes[part[i]]
            if sizes[own] <= least:
                continue
            votes[sizes >= most] = -1
            best = int(votes.argmax())
            if votes[best] > votes_own:
                part[i] = best
                sizes[own] -= 1
                sizes[best] += 1
                moved += 1
        if moved < n // 200:
            break
    return part
