"""URL filter: listed rules first, mined association rules for the rest. DataFrame expressions only.

*Listed rules* name a host and a path. A rule fits its host and all subdomains when the path of the address
starts with its path; the longest rule decides.

*Mined rules*: an address is a set of tokens (scheme, host labels and their parts, ends of the host, path segments
with digits folded, query keys, fragment). FP-growth finds frequent token combinations among labelled
addresses; those that imply the unwanted label with enough confidence and lift become rules. Each rule is filed
under its rarest token, so an address meets only the rules filed under one of its own tokens.

Cases: a null address, or one without ``://``, has empty host and path, no rule, no tokens, and is allowed. Repeated
rows are all judged. Labels are joined by id; null labels teach nothing. Without labels, or when no combination passes, all unlisted
addresses are allowed. Columns beyond ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minekit.functions.skew import balanced_join
from minekit.functions.storage import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNWANTED = "=unwanted"
BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Listed:
    """One listed rule; ``path`` begins with a slash."""

    host: str
    path: str
    verdict: str


def _rest(url: str) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")


def host_of(url: str) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: str) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens_of(url: str) -> Column:
    """The distinct tokens of an address."""
    rest, host = _rest(url), host_of(url)
    labels = F.split(host, r"\.")
    query = F.regexp_extract(rest, r"\?([^#]*)", 1)

    def named(prefix: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    folded = F.regexp_replace(path_of(url), "[0-9]+", "#")
    parts = F.concat(
        named("scheme ", F.array(F.lower(F.substring_index(url, "://", 1)))),
        named("label ", labels),
        named("word ", F.filter(F.split(host, r"[.\-]"), lambda x: ~F.array_contains(labels, x))),
        named("domain ", F.array(F.substring_index(host, ".", -2))),
        named("segment ", F.split(folded, "/")),
        F.when(F.endswith(path_of(url), F.lit("/")), F.array(F.lit("slash"))).otherwise(F.array().cast("array<string>")),
        named("key ", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        named("fragment ", F.array(F.regexp_extract(rest, "#(.*)$", 1))),
    )
    none = F.array().cast("array<string>")
    return F.when(host != "", F.array_distinct(parts)).otherwise(none)


@dataclass(frozen=True)
class UrlFilter:
    """Least share and number of labelled addresses, confidence and lift of a mined rule.

    Tokens in nearly all addresses (``common``) are not mined.
    """

    rules: tuple[Listed, ...] = ()
    support: float = 0.005
    least_rows: int = 20
    confidence: float = 0.5
    lift: float = 1.5
    common: float = 0.9

    def mine(self, labelled: DataFrame) -> DataFrame:
        """``anchor, antecedent, confidence, lift`` of the rules from ``url, unwanted`` (0 or 1), stored."""
        known = settle(
            labelled.where("url is not null and unwanted in (0, 1)").select(tokens_of("url").alias("tokens"), "unwanted"),
            "addresses",
        )
        n = known.count()
        empty = known.sparkSession.createDataFrame([], "anchor string, antecedent array<string>, confidence double, lift double")
        if not n:
            return empty
        least = max(self.support, self.least_rows / n)
        if least > 1:
            return empty
        counts = settle(known.select(F.explode("tokens").alias("token")).groupBy("token").count(), "tokens")
        # by the support at most (tokens of an address / support) tokens pass
        usable = counts.where(F.col("count").between(least * n, self.common * n))
        tokens = [r.token for r in usable.orderBy("count", "token").collect()]
        if not tokens:
            return empty
        names = F.array(*map(F.lit, tokens))  # the rarest first
        baskets = known.select(
            F.array_union(
                F.array_intersect("tokens", names),
                F.when(F.col("unwanted") == 1, F.array(F.lit(UNWANTED))).otherwise(F.array().cast("array<string>")),
            ).alias("items")
        )
        model = FPGrowth(minSupport=least, minConfidence=self.confidence).fit(baskets)
        found = model.associationRules.where(
            (F.size("consequent") == 1) & (F.col("consequent")[0] == UNWANTED) & (F.col("lift") >= self.lift)
        )
        ranked = found.select(
            F.array_intersect(names, "antecedent")[0].alias("anchor"),
            "antecedent", "confidence", "lift",
        )
        return settle(ranked, "rules")

    def judge(self, pages: DataFrame, mined: DataFrame) -> DataFrame:
        """``page_id, host, path, rule, verdict`` of every row."""
        rows = pages.select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path"))
        listed = rows.select("*", self._listed().alias("hit"))
        addresses = rows.where("url is not null").select("url", tokens_of("url").alias("tokens")).distinct()
        anchored = addresses.select("url", "tokens", F.explode("tokens").alias("anchor"))
        if mined.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
            met = anchored.join(F.broadcast(mined), "anchor")
        else:
            # tokens that no rule is filed under stay where they are
            anchors = mined.select("anchor").distinct()
            kept = anchored.join(F.broadcast(anchors), "anchor", "left_semi") if anchors.count() <= BROADCAST_RULES else anchored
            met = balanced_join(settle(kept, "anchored"), mined, ["anchor"], ["url"], ["antecedent"])
        unwanted = met.where(F.size(F.array_except("antecedent", "tokens")) == 0).select("url").distinct()
        marked = unwanted.select(F.col("url").alias("_url"))
        joined = listed.join(marked, F.col("url") == F.col("_url"), "left")
        mined_verdict = F.when(F.col("_url").isNotNull(), "block").otherwise("allow")
        return joined.select(
            "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", mined_verdict).alias("verdict")
        )

    def _listed(self) -> Column:
        """The longest listed rule that fits, or null."""
        longest = sorted(self.rules, key=lambda r: (-len(r.host + r.path), r.host, r.path))
        if not longest:
            return F.lit(None).cast("struct<rule:string,verdict:string>")
        table = F.array(*[
            F.struct(
                F.lit(r.host).alias("host"), F.lit("." + r.host).alias("end"), F.lit(r.path).alias("path"),
                F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"),
            )
            for r in longest
        ])
        fits = F.filter(
            table,
            lambda r: ((F.col("host") == r["host"]) | F.endswith(F.col("host"), r["end"])) & F.startswith(F.col("path"), r["path"]),
        )
        first = F.get(fits, 0)
        return F.when(F.size(fits) > 0, F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))


def labelled_pages(pages: DataFrame, labels: DataFrame, unwanted: Column | None = None) -> DataFrame:
    """``url, unwanted``: pages whose address ends in the number of a labelled document; unwanted is low quality unless told otherwise.

    ``unwanted`` is 0, 1 or null, from the columns of ``labels``.
    """
    number = F.expr("try_cast(regexp_extract(url, '/([0-9]+)(\\\\.html|/)?([?#].*)?$', 1) as bigint)")
    numbered = pages.select("url", number.alias("_doc")).where("_doc is not null")
    told = F.when(F.col("quality").isin(0, 1), 1 - F.col("quality")) if unwanted is None else unwanted
    known = labels.select(F.col("doc_id").cast("bigint").alias("_id"), told.cast("int").alias("unwanted")).where("unwanted is not null")
    known = known.groupBy("_id").agg(F.max("unwanted").alias("unwanted"))
    return numbered.join(known, F.col("_doc") == F.col("_id")).select("url", "unwanted")
