"""Search for similar documents, from raw text to the best pairs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.skew import BLOCK_COST, balanced_join
from minekit.functions.storage import Stored, estimated_bytes, settle, spread, stored
from minekit.operators.minhash import MinHash, list_signatures
from minekit.operators.pairs import (
    bucket_places,
    candidate_pairs,
    pair_similarity,
    signature_groups,
    similarity_bound,
    strongest_pairs,
    top_pairs,
)
from minekit.operators.setjoin import able_sets, picked, similar_sets
from minekit.operators.text import doc_tokens, listed_ids, shingle_id_lists

# documents that are dealt out before their sets are stored
DEALT_BYTES = 64 << 20


@dataclass(frozen=True)
class SimilarDocuments:
    """Settings of a search: words per shingle, hash family, bands and rows per band."""

    k: int = 3
    family: MinHash = field(default_factory=MinHash)
    bands: int = 50
    rows: int = 2
    id_method: str = "xxhash64"
    block_cost: int = BLOCK_COST

    def __post_init__(self) -> None:
        if self.bands * self.rows > self.family.n_hashes:
            raise ValueError("bands * rows exceeds the number of hashes")

    def tokens(self, docs: DataFrame, dealt: bool = False) -> DataFrame:
        """Words of ``doc_id, text``; documents that are ``dealt`` out already stay where they are."""
        docs = docs.select("doc_id", "text")
        return doc_tokens(docs if dealt else spread(docs))

    def shingle_ids(self, docs: DataFrame) -> DataFrame:
        """Distinct shingle ids as rows."""
        return listed_ids(shingle_id_lists(self.tokens(docs), self.k, self.id_method, distinct=True))

    def signatures(self, docs: DataFrame, dealt: bool = False) -> DataFrame:
        """Signatures of whole documents, computed where the documents are read."""
        return list_signatures(shingle_id_lists(self.tokens(docs, dealt), self.k, self.id_method), self.family)

    def groups(self, signatures: DataFrame) -> DataFrame:
        """Stored groups of equal signatures; they are read several times."""
        return settle(signature_groups(signatures), "groups")

    def candidates(self, groups: DataFrame, least: int = 1, places: DataFrame | None = None, measured: bool = False) -> DataFrame:
        """Candidate pairs of stored groups."""
        return candidate_pairs(groups, self.bands, self.rows, self.block_cost, least, places, measured)

    def similarities(self, groups: DataFrame) -> DataFrame:
        """Similarity of every candidate pair of stored groups, measured where they meet."""
        pairs = self.candidates(groups, measured=True)
        return pair_similarity(pairs if "similarity" in pairs.columns else settle(pairs, "pairs"), groups, self.block_cost)

    def top(self, docs: DataFrame, k: int = 10, dealt: bool = False) -> DataFrame:
        """The ``k`` most similar document pairs.

        Pairs that share most bands are searched first; fewer are asked for until no other pair can be among the best.
        """
        signatures = settle(self.signatures(docs, dealt), "signatures")
        groups = self.groups(signatures)
        places = bucket_places(groups, self.bands, self.rows, self.block_cost)
        shape = (self.family.n_hashes, self.bands, self.rows)
        for least in sorted({max(1, self.bands * part // 8) for part in (8, 7, 6, 4, 2, 0)}, reverse=True):
            pairs = settle(self.candidates(groups, least, places, measured=True), "pairs")
            strongest = settle(strongest_pairs(pairs, groups, k + 1, *shape, self.block_cost), "strongest")
            if strongest.where(F.col("similarity") > similarity_bound(least - 1, *shape)).limit(k + 1).count() > k:
                break
        return top_pairs(strongest, signatures, k)

    def set_lists(self, docs: DataFrame) -> Stored:
        """Stored ``id, doc_id, items, digest``: the distinct shingles of each document, in order; ``id`` is a number of the row."""
        # of larger texts the shuffle would take as much disk as the sets
        tokens = self.tokens(docs, dealt=estimated_bytes(docs) >= DEALT_BYTES)
        lists = shingle_id_lists(tokens, self.k, self.id_method)
        sets = lists.select(F.monotonically_increasing_id().alias("id"), "doc_id", F.sort_array(F.array_distinct("ids")).alias("items"))
        # stored first: a filter or a key would repeat the whole text expression
        return stored(sets.select("*", F.unhex(F.sha2(F.array_join("items", " "), 256)).alias("digest")), "lists")

    def above(self, docs: DataFrame, percent: int = 80) -> DataFrame:
        """``a, b, shared, similarity, n_pairs``: all pairs with an exact Jaccard similarity of ``percent`` or more.

        No bands and no signatures: nothing is missed. As elsewhere ``a`` and ``b`` name documents with distinct sets, ``a = b`` stands
        for the pairs inside one group of copies, and ``n_pairs`` counts the pairs of documents. A set is named by its smallest document; a row of
        the set carries it. Only sets that hold enough items of others are moved.
        """
        lists = self.set_lists(docs)
        copies = lists.table.where(F.size("items") > 0).groupBy("digest")
        groups = settle(
            copies.agg(
                F.min("id").alias("id"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_docs"), F.first(F.size("items")).alias("n")
            ).drop("digest"),
            "groups",
        )
        able = settle(able_sets(lists.table, percent).join(groups.select("id"), "id", "left_semi"), "able")
        sets = settle(picked(lists.table.select("id", "items"), able), "sets")
        lists.discard()
        # stored, as the joins read it twice each
        found = settle(similar_sets(sets, percent, self.block_cost), "found")
        names = groups.select("id", "doc_id", "n_docs")
        pairs = balanced_join(found, names.toDF("a", "doc_a", "docs_a"), ["a"], ["b"], block_cost=self.block_cost)
        pairs = balanced_join(pairs, names.toDF("b", "doc_b", "docs_b"), ["b"], ["a"], block_cost=self.block_cost)
        union = F.col("n_a") + F.col("n_b") - F.col("shared")
        between = pairs.where("doc_a <> doc_b").select(
            F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"), "shared", (F.col("shared") / union).alias("similarity"),
            (F.col("docs_a") * F.col("docs_b")).alias("n_pairs"),
        )
        inside = groups.where("n_docs > 1").select(
            F.col("doc_id").alias("a"), F.col("doc_id").alias("b"), F.col("n").alias("shared"), F.lit(1.0).alias("similarity"),
            F.expr("n_docs * (n_docs - 1) div 2").alias("n_pairs"),
        )
        return between.unionByName(inside)
