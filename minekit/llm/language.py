"""Language of documents by Bayesian fusion of several kinds of evidence.

The classes are the declared languages of the training texts and ``und`` for text in none of them. Their set comes from all
rows; each gives its own share of the sample. Beyond ``max_classes`` the languages with fewest rows have no class, nor has one
without a letter in its sample: their documents are kept on their declared language.

* *Text*: log-likelihood of letter trigrams under a smoothed multinomial per language; ``und`` is uniform. Neighbouring
  trigrams tell the same thing, so the sum is tempered.
* *Declared language*: equal to the language of the text with the share that the corpus shows.
* *Address suffix*: how often each suffix goes with each language of the text.
* *Host prior*: counts of text languages by host, smoothed towards those of its domain (the last
  two labels), these towards the whole corpus.

The counts behind the last three come from grouped aggregation over all rows; the decision that they count is that of
the text alone.

Cases: an evidence that is null says nothing. A text without letters (null, empty, digits) has no language:
``lang`` is null, ``kept`` false. Repeated rows are all judged. Without any declared language in the sample all
rows have ``lang`` null and are kept, as nothing is known. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.storage import settle
from minekit.llm.batches import fresh_name, map_batches, text_slices

BUCKETS = 1 << 15
UNKNOWN = "und"
# letters keep their lower-cased byte, all else is one blank
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of a slice, and the bounds of each text's run."""
    # a blank on both sides of each text
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 2)
    text = np.full(len(owner), 32, np.uint8)
    text[np.arange(len(raw)) + 2 * np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) + 1] = _LETTER[raw]
    if len(text) < 3:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    a, b, c = text[:-2].astype(np.uint32), text[1:-1].astype(np.uint32), text[2:].astype(np.uint32)
    good = (b != 32) & (owner[:-2] == owner[2:])
    code = ((a << 16 | b << 8 | c) * np.uint32(2654435761)) >> np.uint32(17)
    return code[good].astype(np.int64), np.searchsorted(owner[:-2][good], np.arange(len(offsets)))


@dataclass
class TextModel:
    """Log-probabilities of trigram buckets, a column per class; the last class is ``und``."""

    classes: list[str]
    table: np.ndarray
    unmodelled: frozenset[str] = frozenset()  # declared in training, without a class

    def likelihoods(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Summed log-likelihood of each text (a column per class) and its number of trigrams."""
        codes, bounds = trigrams(raw, offsets)
        out = np.zeros((len(offsets) - 1, len(self.classes)))
        filled = np.flatnonzero(np.diff(bounds))
        if len(filled):
            out[filled] = np.add.reduceat(self.table[codes], bounds[filled], axis=0)
        return out, np.diff(bounds)


@dataclass(frozen=True)
class LanguageEvidence:
    """``sample_rows`` bounds the texts of the fit; ``temper`` weighs a trigram; ``threshold`` is the least posterior."""

    sample_rows: int = 10_000
    temper: float = 0.25
    smoothing: float = 0.5
    host_weight: float = 20.0
    threshold: float = 0.5
    unknown_prior: float = 0.01
    max_classes: int = 64
    max_declared: int = 100_000  # more declared languages are refused

    def fit(self, docs: DataFrame) -> TextModel:
        """Trigram counts by declared language, from distinct texts of the sample. ``docs``: text, declared."""
        known = docs.where("text is not null and declared is not null").select("text", "declared")
        mark = F.xxhash64("text")
        seen = known.groupBy("declared").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(mark).alias("texts"))
        listed = seen.orderBy(F.desc("n"), "declared").limit(self.max_declared + 1).collect()
        if len(listed) > self.max_declared:
            raise ValueError(f"more than {self.max_declared} declared languages")
        modelled = listed[: self.max_classes]
        shares = self._shares({r.declared: (r.n, r.texts) for r in modelled})
        bounds = known.sparkSession.createDataFrame(list(shares.items()), "declared string, _below bigint")
        picked = known.join(F.broadcast(bounds), "declared").where(F.pmod(F.xxhash64(mark), F.lit(1_000_000)) < F.col("_below"))
        picked = picked.groupBy("declared", mark.alias("_mark")).agg(F.first("text").alias("text"))

        def count(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                names = batch.column("declared").to_pylist()
                for first, _, raw, offsets in text_slices(batch.column("text")):
                    codes, bounds = trigrams(raw, offsets)
                    for name in set(names[first : first + len(bounds) - 1]):
                        own = [codes[bounds[i] : bounds[i + 1]] for i in range(len(bounds) - 1) if names[first + i] == name]
                        n = np.bincount(np.concatenate(own), minlength=BUCKETS)
                        at = np.flatnonzero(n)
                        yield {"declared": [name] * len(at), "bucket": at, "n": n[at]}

        rows = map_batches(picked.select("text", "declared"), count, "declared string, bucket bigint, n bigint")
        sums = settle(rows.groupBy("declared", "bucket").agg(F.sum("n").alias("n")), "trigrams")
        classes = sorted(r.declared for r in sums.select("declared").distinct().collect())
        table = np.full((BUCKETS, len(classes) + 1), self.smoothing)
        place = {c: i for i, c in enumerate(classes)}
        for r in sums.toLocalIterator():  # at most buckets x classes
            table[r.bucket, place[r.declared]] += r.n
        table[:, -1] = 1.0
        unmodelled = frozenset(r.declared for r in listed) - set(classes) - {UNKNOWN}
        return TextModel([*classes, UNKNOWN], np.log(table / table.sum(0)), unmodelled)

    def _shares(self, sizes: dict[str, tuple[int, int]]) -> dict[str, int]:
        """The millionths of each language's texts to sample, so that no language gives more than an equal part of what is left."""
        out: dict[str, int] = {}
        left = self.sample_rows
        rows = sum(n for n, _ in sizes.values())
        for i, (name, (n, texts)) in enumerate(sorted(sizes.items(), key=lambda x: (min(x[1]), x[0]))):
            size = max(1, min(n, texts))
            part = size if rows <= self.sample_rows else min(size, max(1, left // (len(sizes) - i)))
            out[name] = -(-1_000_000 * part // size)
            left -= part
        return out

    def judge(self, docs: DataFrame, model: TextModel, pages: DataFrame | None = None) -> DataFrame:
        """``doc_id, mark, lang, text_lang, posterior, kept`` of every row of ``docs``.

        ``docs``: doc_id, text, declared, suffix, host, any of the last three may be null. ``mark`` hashes the text. ``pages`` (doc_id,
        declared, suffix, host, one row per id) overrides these three where it has a row and a value; it meets what has been read of the
        texts, not the texts.
        """
        if len(model.classes) == 1:
            none = F.lit(None).cast("string")
            return docs.select(
                F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("mark"), none.alias("lang"),
                none.alias("text_lang"), F.lit(None).cast("double").alias("posterior"), F.lit(True).alias("kept"),
            )
        seen = self._read(docs, model)
        if pages is not None:
            found = pages.select("doc_id", *[F.col(c).alias(f"_{c}") for c in TOLD])
            seen = seen.join(found, "doc_id", "left").select(
                "doc_id", "mark", "best", "likelihood", *[F.coalesce(f"_{c}", c).alias(c) for c in TOLD]
            )
        seen = settle(self._named(seen, model), "evidence")
        n = len(model.classes)
        counts = seen.where("best >= 0 and other is null")

        def listed(by: list[str], name: str) -> DataFrame:
            sums = [F.sum((F.col("best") == i).cast("bigint")) for i in range(n)]
            return counts.groupBy(*by).agg(F.array(*sums).alias(name))

        whole = listed([], "all_counts")
        total = [x or 0 for x in whole.first()[0]]
        prior = (np.array(total, float) + 1) / (sum(total) + n)
        prior[-1] = self.unknown_prior
        prior = prior / prior.sum()
        agreed = counts.where("declared is not null and best < " + str(n - 1)).agg(
            F.sum((F.col("declared") == F.col("best")).cast("int")), F.count(F.lit(1))
        ).first()
        trust = ((agreed[0] or 0) + 9.0) / (agreed[1] + 10.0)

        hosts = listed(["host"], "host_counts").where("host is not null")
        domains = listed(["domain"], "domain_counts").where("domain is not null")
        suffixes = listed(["suffix"], "suffix_counts").where("suffix is not null")
        judged = (
            _looked_up(_looked_up(_looked_up(seen, hosts, "host"), domains, "domain"), suffixes, "suffix")
        )
        weight, temper = self.host_weight, self.temper
        zeros = F.array_repeat(F.lit(0).cast("bigint"), n)

        def term(i: int) -> Column:
            p = F.lit(float(prior[i]))
            d, h = F.coalesce("domain_counts", zeros), F.coalesce("host_counts", zeros)
            s = F.coalesce("suffix_counts", zeros)
            in_domain = (d[i] + weight * p) / (_sum(d) + weight)
            in_host = (h[i] + weight * in_domain) / (_sum(h) + weight)
            # how much more often the suffix goes with this class than any does
            by_suffix = F.when(_sum(s) > 0, F.log((s[i] + weight * p) / (_sum(s) + weight) / p)).otherwise(0.0)
            if i == n - 1:
                told = F.lit(float(np.log(1.0 / max(n - 1, 1))))
            else:
                other = (1 - trust) / max(n - 2, 1)
                told = F.when(F.col("declared") == i, float(np.log(trust))).otherwise(float(np.log(other)))
            declared = F.when(F.col("declared").isNull() | (F.col("declared") < 0), 0.0).otherwise(told)
            return F.col("likelihood")[i] * temper + declared + by_suffix + F.log(in_host)

        scored = judged.select("doc_id", "mark", "best", "other", F.array(*[term(i) for i in range(n)]).alias("logs"))
        top = F.array_max("logs")
        place = F.array_position("logs", top).cast("int") - 1
        mass = F.aggregate("logs", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.array_max("logs")))
        names = F.array(*[F.lit(c) for c in model.classes])
        known = F.col("best") >= 0
        own = known & F.col("other").isNotNull()  # declared in a language without a class
        lang = F.when(own, F.col("other")).when(known, F.get(names, place))
        posterior = F.when(known & ~own, 1 / mass)
        return scored.select(
            "doc_id", "mark", lang.alias("lang"), F.when(known, F.get(names, F.col("best"))).alias("text_lang"),
            posterior.alias("posterior"),
            (known & (own | ((lang != UNKNOWN) & (posterior >= self.threshold)))).alias("kept"),
        )

    def _read(self, docs: DataFrame, model: TextModel) -> DataFrame:
        """What the text of each row tells, without the text; ``best`` is its class, -1 without letters."""
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def read(batches: Iterator[pa.RecordBatch]):
            own = shared.value
            for batch in batches:
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    sums, n = own.likelihoods(raw, offsets)
                    yield {c: batch.column(c).slice(first, end - first) for c in ("doc_id", "mark", *TOLD)} | {
                        "best": np.where(n > 0, sums.argmax(1), -1),
                        "likelihood": pa.array(list(sums), pa.list_(pa.float64())),
                    }

        rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("mark"), *TOLD)
        schema = "doc_id bigint, mark bigint, declared string, suffix string, host string, best int, likelihood array<double>"
        return map_batches(rows, read, schema)

    def _named(self, seen: DataFrame, model: TextModel) -> DataFrame:
        """The declared language as a class, -1 for one without, and ``other``, its name where it is known to the corpus; the host's domain."""
        classes = model.classes[:-1]
        listed = [(c, i, None) for i, c in enumerate(classes)] + [(c, -1, c) for c in sorted(model.unmodelled - set(classes))]
        names = seen.sparkSession.createDataFrame(listed, "declared string, _place int, other string")  # max_declared rows at most
        rows = seen.join(F.broadcast(names), "declared", "left")
        return rows.select(
            "doc_id", "mark", "suffix", "host", F.regexp_extract("host", r"([^.]+\.[^.]+|[^.]+)$", 1).alias("domain"),
            F.when(F.col("declared").isNotNull(), F.coalesce("_place", F.lit(-1))).alias("declared"), "other", "best", "likelihood",
        )

    def accepted(self, docs: DataFrame, evidence: DataFrame, model: TextModel) -> DataFrame:
        """The rows of ``docs`` (doc_id, text, more) that are kept, judged by ``evidence`` over the same rows."""
        rejected = settle(self.judge(evidence, model).where("not kept").select("doc_id", "mark").distinct(), "rejected")
        few = rejected.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        doc_id, mark = fresh_name(), fresh_name()
        names = [F.col("doc_id").alias(doc_id), F.col("mark").alias(mark)]
        away = F.broadcast(rejected.select(*names)) if few else rejected.select(*names)
        same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(mark))
        return docs.join(away, same, "left_anti")


BROADCAST_ROWS = 200_000
TOLD = ("declared", "suffix", "host")


def _looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table of one row per key. A small one is sent to the rows, so a key that many rows share stays spread."""
    kept = settle(table, key)
    few = kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(kept) if few else kept, key, "left")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def page_evidence(pages: DataFrame) -> DataFrame:
    """``doc_id, declared, suffix, host`` from web pages whose address ends in the number of a document.

    ``declared`` is the language of the markup, ``suffix`` the end of the host name and the first part of the path. Of several pages of
    one document the one with the smallest ``page_id`` counts.
    """
    rest = F.substring_index("url", "://", -1)
    host = F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    parts = pages.where("url is not null").select(
        F.expr("try_cast(regexp_extract(url, '/([0-9]+)(\\\\.html|/)?([?#].*)?$', 1) as bigint)").alias("doc_id"),
        "page_id",
        F.nullif(F.lower(F.regexp_extract("html", r"<html[^>]*\slang=[\"']?([A-Za-z]+)", 1)), F.lit("")).alias("declared"),
        F.concat_ws("/", F.substring_index(host, ".", -1), F.regexp_extract(rest, r"^[^/]*/([a-z]{2})/", 1)).alias("suffix"),
        F.nullif(host, F.lit("")).alias("host"),
    )
    one = F.min_by(F.struct("declared", "suffix", "host"), "page_id")
    return parts.where("doc_id is not null").groupBy("doc_id").agg(one.alias("e")).select("doc_id", "e.*")
