"""MinHash signatures and their buckets."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ids hashed at once, 8 MB; a longer document is a run of its own
RUN_IDS = 1 << 20
# ids that pass through all hashes while they are in the cache
PIECE_IDS = 1 << 13
MERSENNE = (1 << 31) - 1


@dataclass(frozen=True)
class MinHash:
    """A family of linear hashes ``(a*x + b) mod prime [mod modulus]`` with seeded ``a`` and ``b``.

    ``prime`` is below 2**31 and ``a``, ``b`` are at most 10000, so no product leaves 64 bits.
    """

    n_hashes: int = 100
    seed: int = 0
    prime: int = (1 << 31) - 1
    modulus: int | None = None
    largest: int = 10_000

    def parameters(self) -> list[tuple[int, int]]:
        """``(a, b)`` of each hash, ``a`` at least 1."""
        draw = random.Random(self.seed)
        return [(draw.randint(1, self.largest), draw.randint(0, self.largest)) for _ in range(self.n_hashes)]

    def names(self) -> list[str]:
        return [f"h_{i}" for i in range(self.n_hashes)]

    def values(self, x: Column) -> list[Column]:
        """All hashes of ``x``, an id reduced modulo the prime."""
        hashed = [(x * a + b) % self.prime for a, b in self.parameters()]
        return hashed if self.modulus is None else [h % self.modulus for h in hashed]

    def reduced(self, shingle_id: str) -> Column:
        return F.pmod(F.col(shingle_id), F.lit(self.prime))


def shingle_hashes(ids: DataFrame, family: MinHash) -> DataFrame:
    """``shingle_id, h_0 ..`` for each distinct shingle."""
    distinct = ids.select("shingle_id").distinct()
    x = family.reduced("shingle_id")
    return distinct.select("shingle_id", *[h.alias(n) for h, n in zip(family.values(x), family.names())])


class _Minima:
    """The least value of every hash over runs of ids."""

    def __init__(self, family: MinHash):
        self.parameters, self.prime, self.modulus = family.parameters(), family.prime, family.modulus

    def of(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row for each run of ``ids`` from one of ``starts`` to the next; no run is empty.

        Ids pass in pieces that stay in the cache; a run may go through several.
        """
        out = np.full((len(starts), len(self.parameters)), np.iinfo(np.int64).max, np.int64)
        for low in range(0, len(ids), PIECE_IDS):
            x = np.mod(ids[low : low + PIECE_IDS], self.prime)
            first = np.searchsorted(starts, low, "right") - 1
            last = np.searchsorted(starts, low + len(x), "left")
            at = np.maximum(starts[first:last] - low, 0)
            for i, (a, b) in enumerate(self.parameters):
                found = np.minimum.reduceat(self.hashed(x, a, b), at)
                np.minimum(out[first:last, i], found, out=out[first:last, i])
        return out

    def hashed(self, x: np.ndarray, a: int, b: int) -> np.ndarray:
        y = x * a
        y += b
        if self.prime == MERSENNE:
            # 2**31 leaves a rest of 1, so the upper bits are added to the lower ones, which leaves less than twice the prime
            low = y & MERSENNE
            y >>= 31
            low += y
            z = low.astype(np.uint32)
            h = np.minimum(z, z - np.uint32(MERSENNE))
        else:
            h = y % self.prime
        return h if self.modulus is None else h % self.modulus


def minhash_signatures(ids: DataFrame, family: MinHash) -> DataFrame:
    """``doc_id, sig``: the minimum of every hash over the shingles of a document.

    The shingles of a document leave one scan task side by side, so each batch folds them over Arrow and the shuffle carries about one row
    per document; the minima of its parts meet by their key.
    """
    schema = ids.schema["doc_id"].dataType.simpleString()
    least = _Minima(family)

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column("shingle_id").is_valid())
            if not batch.num_rows:
                continue
            # documents by number, nulls among them
            keys = batch.column("doc_id").dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            minima = least.of(batch.column("shingle_id").to_numpy(), starts)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1) * minima.shape[1], pa.int32()), pa.array(minima.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(starts)), lists], names=["doc_id", "sig"])

    parts = ids.select("doc_id", F.col("shingle_id").cast("bigint")).mapInArrow(folded, f"doc_id {schema}, sig array<bigint>")
    places = [F.min(F.get("sig", F.lit(i))).alias(n) for i, n in enumerate(family.names())]
    return parts.groupBy("doc_id").agg(*places).select("doc_id", F.array(*family.names()).alias("sig"))


def list_signatures(lists: DataFrame, family: MinHash) -> DataFrame:
    """``doc_id, sig`` of ``doc_id, ids`` with all shingle ids of a document in one row.

    The same signatures as ``minhash_signatures`` without any shuffle, over Arrow batches: each hash is
    computed once over the ids of many documents, in runs of bounded length. Documents
    without ids are dropped inside the batch: a filter behind it would be pushed down and repeat the
    whole text expression.
    """
    least = _Minima(family)

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["ids"].map(lambda ids: ids is not None and len(ids) > 0)]
            ends = np.cumsum([len(ids) for ids in batch["ids"]])
            for run in np.split(np.arange(len(batch)), np.flatnonzero(np.diff(ends // RUN_IDS)) + 1):
                if len(run):
                    own = batch.iloc[run]
                    lists = own["ids"].tolist()
                    starts = np.concatenate(([0], np.cumsum([len(ids) for ids in lists])))[:-1]
                    yield pd.DataFrame({"doc_id": own["doc_id"], "sig": list(least.of(np.concatenate(lists), starts))})

    key = lists.schema["doc_id"].dataType.simpleString()
    return lists.select("doc_id", "ids").mapInPandas(signed, f"doc_id {key}, sig array<bigint>")


def lsh_rows(signatures: DataFrame, bands: int, rows: int) -> DataFrame:
    """``doc_id, band, bucket``: one row per document and band, bands counted from 1.

    The bucket is the run of signature values itself, so different runs never share a bucket.
    """
    at = F.sequence(F.lit(0), F.lit(bands - 1))
    runs = F.transform(at, lambda band: F.slice("sig", band * rows + 1, rows))
    return signatures.select("doc_id", F.posexplode(runs).alias("_at", "bucket")).select(
        "doc_id", (F.col("_at") + 1).alias("band"), "bucket"
    )


def lsh_buckets(rows: DataFrame) -> DataFrame:
    """Buckets with two or more documents: ``band, bucket, n_docs, first_doc``.

    Members are not gathered into lists; ``lsh_rows`` lists them as rows.
    """
    return (
        rows.groupBy("band", "bucket")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))
        .where("n_docs > 1")
    )


def bucket_members(rows: DataFrame) -> DataFrame:
    """``band, bucket, doc_id``: a row for each member of a bucket with two or more documents."""
    return rows.join(lsh_buckets(rows).select("band", "bucket"), ["band", "bucket"], "left_semi")
