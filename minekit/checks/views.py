"""The test tables in the parts the operators expect.

Every view reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.operators.text import words_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: supplier by part. N: part by line number. Values are quantities."""
    value = F.col("l_quantity").cast("bigint").alias("v")

    def entry(name: str, i: str, j: str) -> Column:
        return F.struct(
            F.lit(name).alias("name"), F.col(i).cast("bigint").alias("i"), F.col(j).cast("bigint").alias("j"), value
        )

    both = F.array(entry("M", "l_suppkey", "l_partkey"), entry("N", "l_partkey", "l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(F.explode(both).alias("e")).select("e.*")


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier to part for every line; part back to supplier for quantities above 49."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    lines = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", (F.col("l_partkey") + suppliers).alias("part_node")
    )
    there = F.struct(F.col("l_suppkey").alias("src"), F.col("part_node").alias("dst"))
    back = F.struct(F.col("part_node").alias("src"), F.col("l_suppkey").alias("dst"))
    links = F.when(F.col("l_quantity") > 49, F.array(there, back)).otherwise(F.array(there))
    return lines.select(F.explode(links).alias("e")).select("e.src", "e.dst")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v")
    )


def centroids(spark: SparkSession, sf_dir: str, start: str = "c1") -> DataFrame:
    """Start sets of one vector per label: the first (``c1``) or the last (``c2``) of each."""
    pick = F.min_by if start == "c1" else F.max_by
    return (
        table(spark, sf_dir, "embeddings")
        .groupBy(F.col("label").cast("bigint").alias("cid"))
        .agg(pick("embedding", "vec_id").cast("array<double>").alias("v"))
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as ``row_id, category, numbers, label`` with the numbers as text.

    Numbers: characters, words, mean word length (``?`` for a document without words).
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    words = documents.join(labels, "doc_id").withColumn("tokens", words_of("text"))
    counted = words.select(
        "doc_id",
        "lang",
        "n_chars",
        "quality",
        F.size("tokens").alias("n_words"),
        F.aggregate("tokens", F.lit(0), lambda n, t: n + F.length(t)).alias("letters"),
    )
    mean = F.when(F.col("n_words") == 0, "?").otherwise((F.col("letters") / F.col("n_words")).cast("string"))
    return counted.select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("category"),
        F.array(F.col("n_chars").cast("string"), F.col("n_words").cast("string"), mean).alias("numbers"),
        F.col("quality").cast("double").alias("label"),
    )
