"""K-Means from given starting centroids, under either metric."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from minekit.functions.storage import spread, stored
from minekit.operators.cluster import PACKED_NUMBERS, assigned_to, assignments, centroid_update, packs_needed

HISTORY = "iteration int, k bigint, cost_l1 double, cost_l2sq double"


@dataclass(frozen=True)
class KMeansFit:
    """``centroids``: ``cid, v``. ``history``: ``iteration, k, cost_l1, cost_l2sq``."""

    centroids: DataFrame
    history: DataFrame


@dataclass(frozen=True)
class KMeans:
    """A fixed number of iterations; the metric decides the assignment, the update is the mean."""

    metric: str = "l2"
    iterations: int = 20
    packed_numbers: int = PACKED_NUMBERS

    def fit(self, points: DataFrame, start: DataFrame) -> KMeansFit:
        """Iterate from ``start``.

        The points are kept on the executors, in memory and then on disk. Each iteration assigns them and folds them into one row per
        cluster in a single pass. Centroids of up to ``packed_numbers`` numbers come to the driver with that pass and travel
        back into the next one, so an iteration is one job and writes nothing. Larger sets are stored, and the older ones removed. Row ``t``
        of the history holds the cost before update ``t``; ``k`` counts the clusters with members.
        """
        start = start.select("cid", "v")
        points = spread(points.select("id", "v")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if packs_needed(start, self.packed_numbers) == 1:
                return self._at_hand(points, start)
            return self._stored(points, start)
        finally:
            points.unpersist()

    def _at_hand(self, points: DataFrame, start: DataFrame) -> KMeansFit:
        spark = points.sparkSession
        centroids = [(r.cid, r.v) for r in start.collect()]
        dimension = max((len(v) for _, v in centroids), default=0)
        history = []
        for iteration in range(self.iterations):
            clusters = centroid_update(assigned_to(points, centroids), self.metric, dimension).collect()
            if not clusters:
                break
            centroids = [(r.cid, r.v) for r in clusters]
            history.append((iteration, len(clusters), *(math.fsum(r[c] for r in clusters) for c in ("cost_l1", "cost_l2sq"))))
        kinds = {f.name: f.dataType.simpleString() for f in start.schema}
        return KMeansFit(
            local_table(spark, sorted(centroids), f"cid {kinds['cid']}, v array<double>"),
            local_table(spark, history, HISTORY),
        )

    def _stored(self, points: DataFrame, start: DataFrame) -> KMeansFit:
        state = stored(start, "centroids")
        dimension = state.table.select(F.max(F.size("v"))).first()[0]
        history = []
        for iteration in range(self.iterations):
            near = assignments(points, state.table.select("cid", "v"), packs_needed(state.table, self.packed_numbers))
            after = stored(centroid_update(near, self.metric, dimension), "centroids")
            k, *costs = after.table.agg(F.count(F.lit(1)), F.sum("cost_l1"), F.sum("cost_l2sq")).first()
            if not k:
                after.discard()
                break
            state.discard()
            state = after
            history.append((iteration, k, *costs))
        return KMeansFit(state.table.select("cid", "v"), local_table(points.sparkSession, history, HISTORY))


def local_table(spark: SparkSession, rows: list[tuple], kinds: str) -> DataFrame:
    """Rows at hand as a table. They go over as Arrow data, so reading them starts no Python workers beside those of the scan."""
    schema = StructType.fromDDL(kinds)
    fields = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields), schema)


def cost_changes(history: DataFrame, run: str = "run") -> DataFrame:
    """Add the relative change of both costs against the previous iteration of the same run."""
    order = Window.partitionBy(run).orderBy("iteration")

    def change(cost: str) -> Column:
        before = F.lag(cost).over(order)
        return F.try_divide(F.col(cost) - before, before)

    return history.select(
        "*", change("cost_l1").alias("change_l1"), change("cost_l2sq").alias("change_l2sq")
    )


def compare_runs(points: DataFrame, starts: dict[str, DataFrame], iterations: int = 20) -> DataFrame:
    """Cost history of every start under both metrics: ``init, metric, iteration, k, costs``."""
    runs = []
    for name, start in starts.items():
        for metric in ("l2", "l1"):
            history = KMeans(metric, iterations).fit(points, start).history
            runs.append(history.select(F.lit(name).alias("init"), F.lit(metric).alias("metric"), "*"))
    return reduce(DataFrame.unionByName, runs)
