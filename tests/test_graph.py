import pytest
from pyspark.sql import functions as F

from minekit.operators.graph import dangling_fill, dangling_nodes, graph_nodes, out_degree, transition_matrix
from minekit.plans.pagerank import PageRank


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def ranks(df):
    return {r.node: r.rank for r in df.collect()}


def dense_ranks(pairs, steps, beta=0.8):
    n = max(max(p) for p in pairs) + 1
    degree = [sum(1 for s, _ in pairs if s == v) for v in range(n)]
    rank = [1 / n] * n
    for _ in range(steps):
        new = [(1 - beta) / n] * n
        for s, d in pairs:
            new[d] += beta * rank[s] / degree[s]
        lost = sum(rank[v] for v in range(n) if degree[v] == 0)
        rank = [r + beta * lost / n for r in new]
    return dict(enumerate(rank))


NO_DEAD_END = [(0, 1), (1, 2), (2, 1), (3, 1)]
MIXED = [(0, 1), (0, 1), (0, 2), (2, 0), (5, 2), (2, 7), (0, 9), (0, 6), (0, 3)]


def test_nodes_without_in_links_keep_their_share(spark):
    got = ranks(PageRank().run(edges(spark, NO_DEAD_END), 20))
    assert got == pytest.approx({0: 0.05, 1: 0.469660, 2: 0.430340, 3: 0.05}, abs=1e-6)
    assert sum(got.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("block_rows", [1, 2, 1 << 20])
def test_dead_ends_gaps_and_parallel_edges(spark, block_rows):
    got = ranks(PageRank(block_rows=block_rows).run(edges(spark, MIXED), 6))
    assert got == pytest.approx(dense_ranks(MIXED, 6))
    assert sum(got.values()) == pytest.approx(1.0)


def test_no_steps_returns_the_start(spark):
    assert ranks(PageRank().run(edges(spark, NO_DEAD_END), 0)) == {v: 0.25 for v in range(4)}


def test_resume_equals_one_run(spark):
    graph = edges(spark, MIXED)
    seen = []
    half = PageRank().run(graph, 3, on_step=lambda step, _: seen.append(step))
    assert seen == [1, 2, 3]
    assert ranks(PageRank().run(graph, 4, half)) == pytest.approx(ranks(PageRank().run(graph, 7)))


def test_filled_columns_sum_to_one(spark):
    graph = edges(spark, MIXED)
    nodes = graph_nodes(graph)
    n = nodes.count()
    filled = dangling_fill(transition_matrix(graph, block_cost=4), dangling_nodes(nodes, graph), n)
    share = F.when(F.col("dst").isNull(), F.col("weight") * n).otherwise(F.col("weight"))
    sums = filled.groupBy("src").agg(F.sum(share).alias("s"))
    assert sums.count() == n
    assert all(r.s == pytest.approx(1.0) for r in sums.collect())


def test_degrees_count_parallel_edges_and_idle_nodes(spark):
    graph = edges(spark, MIXED)
    degrees = {r.node: r.degree for r in out_degree(graph_nodes(graph), graph).collect()}
    assert degrees == {0: 6, 1: 0, 2: 2, 3: 0, 4: 0, 5: 1, 6: 0, 7: 0, 8: 0, 9: 0}
