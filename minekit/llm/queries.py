"""One registered query per operator of this package, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.checks.views import table
from minekit.llm.collocations import Collocations
from minekit.llm.collocations import oracle as collocation_oracle
from minekit.llm.decontamination import Decontamination
from minekit.llm.html import PageText
from minekit.llm.jaccardjoin import JaccardJoin
from minekit.llm.jaccardjoin import oracle as join_oracle
from minekit.llm.language import LanguageEvidence, page_evidence
from minekit.llm.neardup import NearDuplicates
from minekit.llm.licenses import license_scan
from minekit.llm.licenses import oracle as license_oracle
from minekit.llm.neighbours import LearnedPartitions
from minekit.llm.packing import Packing
from minekit.llm.periods import PeriodicRuns
from minekit.llm.records import token_records
from minekit.llm.toxicity import Toxicity
from minekit.llm.urlrules import Listed, UrlFilter, labelled_pages


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    operator = Toxicity()
    return operator.score(docs, operator.fit(docs, table(spark, sf_dir, "labels")))


def op2_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return LearnedPartitions(k=20).search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all documents, read back from the record files."""
    return token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and benchmark items within a fifth of the item's words."""
    return Decontamination().matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their 2-word shingles."""
    return NearDuplicates(shingle=2, percent=80).components(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    operator = PageText()
    return operator.run(pages, operator.fit(pages))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents from their text and, where a page shows them, its markup, address and host."""
    none = F.lit(None).cast("string")
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint"), "text", F.col("lang").alias("declared"), none.alias("suffix"), none.alias("host")
    )
    operator = LanguageEvidence()
    return operator.judge(docs, operator.fit(docs.select("text", "declared")), page_evidence(table(spark, sf_dir, "pages"))).drop("mark")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 2048."""
    return Packing(public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048).run(table(spark, sf_dir, "documents"))


URL_RULES = (
    Listed("com", "/", "allow"),
    Listed("example.com", "/en/", "block"),
    Listed("www.example.com", "/en/", "allow"),
    Listed("net", "/es/", "block"),
    Listed("net", "/fr/", "block"),
)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all page addresses by listed rules, else by rules mined from labels."""
    pages = table(spark, sf_dir, "pages")
    operator = UrlFilter(URL_RULES)
    return operator.judge(pages, operator.mine(labelled_pages(pages, table(spark, sf_dir, "labels"))))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents by the digest of the whole text, and of their notice lines."""
    return license_scan(table(spark, sf_dir, "documents"))


def planted_repetitions(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; the texts of about a tenth of all ids, chosen by checksum, repeat a stretch of words up to their end.

    Word ``i >= a`` becomes word ``a + (i - a) % p`` there; such texts come back with one blank between words.
    """
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    mark = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", mark.alias("h"))
    chosen = chosen.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w").cast("bigint"))
    chosen = chosen.withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    at = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    repeated = F.array_join(F.transform(at, lambda i: F.get("w", i.cast("int"))), " ")
    return chosen.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def runs_digest(found: DataFrame) -> DataFrame:
    """The longest run of each row, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div (-best.period)").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of all documents, a tenth of them with planted repetitions."""
    return runs_digest(PeriodicRuns().run(planted_repetitions(table(spark, sf_dir, "documents"))))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their 5-word shingles."""
    return JaccardJoin(shingle=5, percent=80).components(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language."""
    return Collocations().run(table(spark, sf_dir, "documents").select("lang", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_learned_partitions, op3_token_records, op4_url_filter, op5_decontamination, op6_minhash_near_dedup, op7_html_extraction,
        op8_language_id, op9_packing, op10_license_scan, op11_periodic_runs, op12_jaccard_join, op13_collocations,
    )
}
ORACLES: dict[str, str] = {
    "op6_minhash_near_dedup": f"SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM ({join_oracle(2, 80)})",
    "op10_license_scan": license_oracle(),
    "op12_jaccard_join": join_oracle(),
    "op13_collocations": collocation_oracle(),
}
