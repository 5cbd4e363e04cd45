"""Documents as words and word k-grams (shingles)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.columns import gram_hash

# documents whose runs of words are listed at once
LISTED_AT_ONCE = 1 << 10


def words_of(text: str) -> Column:
    """The words of a text column.

    Double quotes, full stops and commas are deleted; line ends and hyphens become blanks; the rest
    is lower-cased and split at blanks.
    """
    # the two leading characters have a counterpart, the others are deleted
    plain = F.lower(F.translate(text, '\n-".,', "  "))
    return F.filter(F.split(plain, " "), lambda t: t != "")


def doc_tokens(docs: DataFrame, *beside: Column) -> DataFrame:
    """``doc_id, tokens`` of ``doc_id, text``; what else is wanted of a document comes between, so that it is read once."""
    return docs.select("doc_id", *beside, words_of("text").alias("tokens"))


def _grams(k: int, of: Callable[[Column], Column]) -> Column:
    """One value per run of ``k`` words of ``tokens``, null for a document with fewer words.

    Words hold no blanks, so the text form (words joined by blanks) tells different runs apart.
    """
    starts = F.sequence(F.lit(1), F.size("tokens") - (k - 1))
    grams = F.transform(starts, lambda at: of(F.array_join(F.slice("tokens", at, k), " ")))
    return F.when(F.size("tokens") >= k, grams)


def doc_shingles(tokens: DataFrame, k: int = 3) -> DataFrame:
    """``doc_id, shingle``: the distinct runs of ``k`` words of each document, words joined by blanks.

    Documents with fewer than ``k`` words have no rows. Everything happens inside the row, without a
    shuffle. The outer form of explode keeps the optimizer from evaluating the whole expression a
    second time as a filter.
    """
    distinct = F.array_distinct(_grams(k, lambda gram: gram))
    return tokens.select("doc_id", F.explode_outer(distinct).alias("shingle")).where("shingle is not null")


def shingle_id_lists(tokens: DataFrame, k: int = 3, method: str = "xxhash64", distinct: bool = False) -> DataFrame:
    """``doc_id, ids``: the ids of all runs of ``k`` words as one array, repeats included unless the ``distinct`` runs are asked for.

    A document with fewer words has a null. ``md5`` is computed over Arrow batches, where a run is a slice of the words joined by blanks: on 51,000 texts
    with 26 million runs this took half the time of nested higher-order functions, which build, join and hash an array for each run.
    """
    if method == "md5":
        return _md5_lists(tokens, k, distinct)
    if distinct:
        grams = F.array_distinct(_grams(k, lambda gram: gram))
        return tokens.select("doc_id", F.transform(grams, lambda gram: gram_hash(gram, method)).alias("ids"))
    return tokens.select("doc_id", _grams(k, lambda gram: gram_hash(gram, method)).alias("ids"))


def _md5_lists(tokens: DataFrame, k: int, distinct: bool) -> DataFrame:
    """The leading 60 bits of the ``md5`` of each run, as ``gram_hash`` has them."""
    key = tokens.schema["doc_id"].dataType.simpleString()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            from _md5 import md5  # a hash without the set-up of the library behind hashlib
        except ImportError:
            from hashlib import md5

        # few at once, as their ids take more room than their texts
        for batch in (batch.slice(low, LISTED_AT_ONCE) for batch in batches for low in range(0, batch.num_rows, LISTED_AT_ONCE)):
            ids = []
            for joined in batch.column("joined"):
                line = joined.as_py()
                blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32) if line else []
                if not line or len(blanks) + 1 < k:
                    ids.append(None)
                    continue
                cuts = [-1, *(blanks.tolist() if len(blanks) else []), len(line)]
                grams = [line[low + 1 : high] for low, high in zip(cuts, cuts[k:])]
                digests = b"".join([md5(gram).digest() for gram in (dict.fromkeys(grams) if distinct else grams)])
                ids.append((np.frombuffer(digests, ">u8")[::2] >> np.uint64(4)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    joined = F.array_join("tokens", " ").cast("binary")
    return tokens.select("doc_id", joined.alias("joined")).mapInArrow(listed, f"doc_id {key}, ids array<bigint>")


def listed_ids(lists: DataFrame) -> DataFrame:
    """``doc_id, shingle_id``: a row for each entry of the lists."""
    return lists.select("doc_id", F.explode("ids").alias("shingle_id"))


def shingle_ids(shingles: DataFrame, method: str = "xxhash64") -> DataFrame:
    """``doc_id, shingle_id``."""
    return shingles.select("doc_id", gram_hash(F.col("shingle"), method).alias("shingle_id"))


def shingle_frequency(ids: DataFrame) -> DataFrame:
    """``shingle_id, n_docs``: the vocabulary with its document frequencies."""
    return ids.groupBy("shingle_id").agg(F.count(F.lit(1)).alias("n_docs"))
