"""Headline timings: one JSON line with the wall seconds of each query.

Reads ``$BENCH_SF_DIR`` and runs on ``local[$BENCH_CPUS]``. Every query is computed in full and each
of its result columns is consumed by a sink that discards them. The Spark session is started and
warmed by a scan before the clock runs.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.checks import queries as Q
from minekit.checks import views
from minekit.operators import matrix
from minekit.operators.minhash import MinHash
from minekit.operators.tree import accuracy, tree_predictions
from minekit.plans.decision_tree import DecisionTree
from minekit.plans.kmeans import KMeans
from minekit.plans.pagerank import PageRank
from minekit.plans.similar import SimilarDocuments

SEARCH = SimilarDocuments(k=3, family=MinHash(100), bands=50, rows=2)


def lines_as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as labelled rows: five numbers and the line status, returned or not."""
    numbers = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return views.table(spark, sf_dir, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber").alias("row_id"),
        F.array(
            F.when(F.col("l_linestatus") == "F", 1.0).otherwise(0.0),
            F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0),
            *[F.col(c).cast("double") for c in numbers],
        ).alias("features"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = views.entries(spark, sf_dir)
    return matrix.ordered_cells(
        matrix.matrix_product(matrix.select_matrix(both, "M"), matrix.select_matrix(both, "N"))
    )


def fitted_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines_as_rows(spark, sf_dir)
    return accuracy(tree_predictions(rows, DecisionTree(min_leaf=250, max_depth=5).fit(rows)))


HEADLINES = {
    "matrix_product": product,
    "transition_matrix": Q.QUERIES["transition_matrix"],
    "pagerank_20_steps": lambda s, d: PageRank().run(views.edges(s, d), 20),
    "shingle_frequency": lambda s, d: Q.text.shingle_frequency(SEARCH.shingle_ids(views.docs(s, d))),
    "minhash_signatures": lambda s, d: SEARCH.signatures(views.docs(s, d)),
    "pair_similarity": lambda s, d: SEARCH.similarities(SEARCH.groups(SEARCH.signatures(views.docs(s, d)))),
    "similar_pairs_topk": lambda s, d: SEARCH.top(views.docs(s, d), 10),
    "pairwise_distance": lambda s, d: Q.cluster.pairwise_distance(views.points(s, d), views.centroids(s, d)),
    "kmeans_l2_20_iterations": lambda s, d: KMeans("l2", 20).fit(views.points(s, d), views.centroids(s, d)).history,
    "kmeans_l1_20_iterations": lambda s, d: KMeans("l1", 20).fit(views.points(s, d), views.centroids(s, d)).history,
    "decision_tree_depth_5": fitted_tree,
    "library_tree": Q.QUERIES["mllib_tree_accuracy"],
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("minekit-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    views.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").count().collect()

    seconds = {}
    for name, run in HEADLINES.items():
        begin = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 2)
    total = round(sum(seconds.values()), 2)
    scale = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "total_wall", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
