"""Directed graphs (``src, dst``) and the steps of PageRank."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.skew import BLOCK_COST, MAX_HOT, balanced_join, row_counts


def graph_nodes(edges: DataFrame) -> DataFrame:
    """All node ids ``0 .. largest id``; unused ids in between count as nodes."""
    largest = edges.agg(F.max(F.greatest("src", "dst"))).first()[0]
    size = 0 if largest is None else largest + 1
    return edges.sparkSession.range(size).withColumnRenamed("id", "node")


def out_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, degree`` for every node; parallel edges count, nodes without out-edges have 0."""
    counted = edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    return nodes.join(counted, "node", "left").select("node", F.coalesce("degree", F.lit(0)).alias("degree"))


def transition_matrix(edges: DataFrame, block_cost: int = BLOCK_COST) -> DataFrame:
    """``src, dst, weight`` with weight ``1 / out-degree``; parallel edges stay separate rows."""
    degrees = edges.groupBy("src").agg(F.count(F.lit(1)).alias("degree"))
    counts = row_counts(degrees, ["src"], "_left", "degree")
    return balanced_join(edges, degrees, ["src"], ["dst"], block_cost=block_cost, left_counts=counts).select(
        "src", "dst", (1 / F.col("degree")).alias("weight")
    )


def dangling_nodes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without out-edges."""
    sources = edges.select(F.col("src").alias("node")).distinct()
    return nodes.join(sources, "node", "left_anti")


def dangling_fill(transition: DataFrame, dead: DataFrame, n_nodes: int) -> DataFrame:
    """The transition matrix with its empty columns repaired.

    A dead end links to every node with the same weight ``1 / n_nodes``. Such a constant column is
    kept as one row whose ``dst`` is null ("every node") in place of ``n_nodes`` equal rows.
    """
    constant = dead.select(
        F.col("node").alias("src"),
        F.lit(None).cast("bigint").alias("dst"),
        F.lit(1.0 / max(n_nodes, 1)).alias("weight"),
    )
    return transition.unionByName(constant)


def link_table(edges: DataFrame) -> DataFrame:
    """Parallel edges folded into ``src, dst, links``."""
    return edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def blocked_links(links: DataFrame, n_links: int, block_rows: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Cut sources with very many targets into blocks.

    Returns the links with their ``block`` and, per source, its degree and number of ``blocks``. A
    source has more than one block only if it has over ``max(block_rows, n_links / MAX_HOT)``
    targets, so there are fewer than ``MAX_HOT`` such sources and their table may be broadcast.
    """
    rows = max(block_rows, -(-n_links // MAX_HOT))
    sources = links.groupBy("src").agg(
        F.sum("links").alias("degree"), F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("blocks")
    )
    hot = F.broadcast(sources.where("blocks > 1").select("src", "blocks"))
    placed = links.join(hot, "src", "left").select(
        "src",
        F.pmod(F.xxhash64("dst"), F.coalesce("blocks", F.lit(1))).cast("int").alias("block"),
        "dst",
        "links",
    )
    return placed, sources


def start_state(nodes: DataFrame, sources: DataFrame, n_nodes: int, ranks: DataFrame | None = None) -> DataFrame:
    """``node, degree, blocks, rank``; the rank is ``1 / n_nodes`` unless ``ranks`` are given."""
    state = nodes.join(sources.withColumnRenamed("src", "node"), "node", "left").select(
        "node", F.coalesce("degree", F.lit(0)).alias("degree"), F.coalesce("blocks", F.lit(1)).alias("blocks")
    )
    if ranks is None:
        return state.withColumn("rank", F.lit(1.0 / max(n_nodes, 1)))
    return state.join(ranks.select("node", "rank"), "node", "left").withColumn(
        "rank", F.coalesce("rank", F.lit(0.0))
    )


def pagerank_step(state: DataFrame, links: DataFrame, n_nodes: int, beta: float = 0.8) -> DataFrame:
    """One power iteration ``r' = beta * M * r + (1 - beta) / n``, dead ends included.

    The rank held by dead ends is one number shared by all nodes, so it is added as a scalar. Every
    node of ``state`` keeps a row, with or without in-links.
    """
    sent = state.where("degree > 0").select(
        F.col("node").alias("src"),
        (F.col("rank") / F.col("degree")).alias("share"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    received = (
        links.join(sent, ["src", "block"])
        .groupBy(F.col("dst").alias("node"))
        .agg(F.sum(F.col("share") * F.col("links")).alias("inflow"))
    )
    dead_mass = state.where("degree = 0").agg(F.coalesce(F.sum("rank"), F.lit(0.0))).scalar()
    inflow = F.coalesce("inflow", F.lit(0.0)) + dead_mass / n_nodes
    return state.join(received, "node", "left").select(
        "node", "degree", "blocks", (beta * inflow + (1 - beta) / n_nodes).alias("rank")
    )


def top_ranks(ranks: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best nodes by rank, then id, both descending."""
    return ranks.select("node", "rank").orderBy(F.desc("rank"), F.desc("node")).limit(n)
