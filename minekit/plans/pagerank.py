"""PageRank as a resumable job."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.storage import partitions_for, settle, stored
from minekit.operators.graph import blocked_links, graph_nodes, link_table, pagerank_step, start_state

LINK_BYTES = 64 << 20  # stored links per partition


@dataclass(frozen=True)
class PageRank:
    """Settings of a run."""

    beta: float = 0.8
    block_rows: int = 1 << 20

    def run(
        self,
        edges: DataFrame,
        steps: int,
        ranks: DataFrame | None = None,
        nodes: DataFrame | None = None,
        on_step: Callable[[int, DataFrame], None] | None = None,
    ) -> DataFrame:
        """``node, rank`` after ``steps`` steps from ``ranks`` (or from equal ranks).

        The links are shuffled to their place and sorted once and kept so for all steps; a step moves only
        rank-sized tables and the partial sums of the contributions. Each step's ranks are stored.
        A step's ranks are removed once the next are stored; ``on_step`` is called with the step number
        and its ranks, for logging or saving, and has to use them before it returns.
        """
        nodes = graph_nodes(edges) if nodes is None else nodes
        n_nodes = nodes.count()
        folded = settle(link_table(edges), "links")
        links, sources = blocked_links(folded, folded.count(), self.block_rows)
        partitions = partitions_for(folded, LINK_BYTES)
        # sorted before they are kept, so that no step sorts them again
        links = links.repartition(partitions, "src", "block").sortWithinPartitions("src", "block").persist(StorageLevel.MEMORY_AND_DISK)
        state = stored(start_state(nodes, sources, n_nodes, ranks), "ranks")
        try:
            for step in range(1, steps + 1):
                after = stored(pagerank_step(state.table, links, n_nodes, self.beta), "ranks")
                state.discard()
                state = after
                if on_step is not None:
                    on_step(step, state.table.select("node", "rank"))
        finally:
            links.unpersist()
        return state.table.select("node", "rank")


def save_ranks(ranks: DataFrame, path: str) -> None:
    """Keep ranks for a later run."""
    ranks.select("node", "rank").write.parquet(path)


def load_ranks(like: DataFrame, path: str) -> DataFrame:
    """Ranks kept by ``save_ranks``, read in the session of ``like``."""
    return like.sparkSession.read.schema("node bigint, rank double").parquet(path).select("node", F.col("rank"))
