"""All links between texts that share most of their word n-grams, by an exact join in the metric space of Jaccard distances.

A text is the set of its distinct word shingles; ``1 - Jaccard`` is a metric, so distances to a few *pivots* bound all others.

1. Equal sets are one class. Similar sets share many of their first shingles in hash order: of as many as a similar set may lack, and
   ``extra`` percent more, at least those ``extra`` percent. Classes that share fewer of them with others have no neighbour within
   the radius and leave before any set is moved.
2. The others are laid around pivots: the classes that meet in a shingle which few hold gather around the one of them with the fewest
   shingles of its own. Each class measures its distance to the pivot that it meets in most shingles, then, while it is not
   connected to them, to the others. Those within the radius are linked.
3. The classes around one pivot are a region. Two classes within the radius of each other meet in a common region. Only regions in which
   classes are still unconnected stay open.
4. Open regions that are too large for one task are split again, recursively: pivots drawn from the region make Voronoi cells; a class goes to the
   cell of its nearest pivot and, as boundary document, to every other whose pivot is at most twice the radius further away. By the
   triangle inequality two classes within the radius are together in the cells of both.
5. Small regions are joined exactly: all overlaps of their sets in one product of bounded size. Regions that do not shrink, since all
   distances in them are alike, are joined exactly through an index on their rarest shingles (``operators.setjoin``).
6. Components of all links; links inside a component add nothing, so they are not looked for.

Sets are compared as sets of 64-bit hashes of shingles.

Cases: words are maximal runs of bytes other than blank, tab and line ends, A-Z lower-cased. A text with fewer words than a shingle is one
shingle of all of them. Null and empty texts and texts without words have no shingle, link with nothing and stand for
themselves. Rows without ``doc_id`` link with nothing and have no component. Repeated rows are all returned; rows with equal id are one
node, whatever their texts. Columns beyond ``doc_id`` and ``text`` are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from minekit.functions.skew import balanced_join
from minekit.functions.storage import settle
from minekit.llm.batches import SPACES, Words, map_batches, mixed, text_slices
from minekit.llm.collocations import PRUNE_BITS, quotient_bitmap
from minekit.llm.neardup import connected, shingle_sets
from minekit.operators.setjoin import counted_pairs, needed, prefix_candidates, rare_prefixes

_SALT = np.uint64(0xA24BAED4963EE407)
_EPSILON = 1e-9
_COLUMNS = 4096
BROADCAST_ROWS = 1_000_000


@dataclass(frozen=True)
class JaccardJoin:
    """Words per shingle and similarity in percent; pivots per split, classes and shingles of a region for one task, depth of the recursion.

    A larger ``extra`` lets more classes leave early and reads more of each set for that.
    """

    shingle: int = 5
    percent: int = 80
    pivots: int = 8
    leaf_rows: int = 256
    leaf_items: int = 1 << 19
    depth: int = 4
    shrink: float = 0.75
    extra: int = 10

    def components(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_shingles, component_id`` of every row."""
        signed = settle(self._read(docs), "read")
        classes, links = self.links(docs, signed)
        labels = connected(links)
        keys = ["k1", "k2", "n_shingles"]
        named = classes.select(*[F.col(c).alias(f"_{c}") for c in keys], F.col("id").alias("_id"), F.col("rep").alias("_rep"))
        same = [F.col(c) == F.col(f"_{c}") for c in keys]
        placed = signed.select("doc_id", *keys).join(named, same, "left")
        placed = placed.join(labels.select(F.col("node").alias("_node"), F.col("label").alias("_label")), F.col("_id") == F.col("_node"), "left")
        return placed.select(
            "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_label", "_rep", "doc_id")).alias("component_id")
        )

    def links(self, docs: DataFrame, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The classes (``k1, k2, n_shingles, rep, id``) and stored links ``a, b`` between their ids that connect all that are similar."""
        classes, crowd = self._classes(signed)
        aliases = classes.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
        again = signed.where("doc_id is not null").groupBy("doc_id", "k1", "k2").count().where("count > 1")
        sets = self._sets(docs, crowd, not again.isEmpty())
        near = settle(rare_prefixes(sets.select("id", F.col("id").alias("part"), "items"), self.percent), "prefixes")

        # around the pivot of each rare shingle: the class with the fewest shingles of its own
        chosen = near.groupBy("item").agg(F.min(F.struct("own", "id")).alias("p"), F.count(F.lit(1)).alias("n")).where("n > 1")
        counts = chosen.select(F.xxhash64("item").alias("_key"), F.col("n").alias("_left"))
        met = balanced_join(near.select("item", "id"), chosen.select("item", F.col("p.id").alias("pivot")), ["item"], ["id"], left_counts=counts)
        around = settle(met.groupBy("pivot", "id").agg(F.count(F.lit(1)).alias("n")), "around")
        first = around.where("pivot <> id").groupBy(F.col("id").alias("b")).agg(F.max(F.struct("n", (-F.col("pivot")).alias("p"))).alias("m"))
        found = settle(self._linked(first.select((-F.col("m.p")).alias("a"), "b"), sets).unionByName(aliases), "links")
        rest = _across(around.where("pivot <> id").select(F.col("pivot").alias("a"), F.col("id").alias("b")), connected(found))
        found = settle(found.unionByName(self._linked(settle(rest, "rest"), sets)), "links")

        # regions that hold unconnected classes
        parts = connected(found).toDF("id", "part")
        rows = around.select(F.col("pivot").alias("region"), "id").join(parts, "id", "left").select("region", "id", F.coalesce("part", "id").alias("part"))
        rows = settle(_open(rows).withColumn("of", F.lit(None).cast("bigint")), "open")
        leaves, crowded = [], []
        for level in range(self.depth + 1):
            sized = rows.join(sets.select("id", "n"), "id").groupBy("region")
            sizes = sized.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("items"), F.max("of").alias("of"))
            small = (F.col("rows") <= self.leaf_rows) & (F.col("items") <= self.leaf_items)
            stuck = F.lit(level == self.depth) | F.coalesce(F.col("rows") > F.col("of") * self.shrink, F.lit(False))
            kind = F.when(small, "leaf").when(stuck, "crowded").otherwise("split")
            judged = settle(sizes.select("region", "rows", kind.alias("kind")), "sizes")
            present = {r.kind for r in judged.select("kind").distinct().collect()}
            placed = rows.select("region", "id", "part").join(judged, "region")
            if "leaf" in present:
                leaves.append(settle(self._joined(placed.where("kind = 'leaf'"), sets), "leaf-links"))
            if "crowded" in present:
                crowded.append(settle(placed.where("kind = 'crowded'").select("id", "part").distinct(), "crowded"))
            if "split" not in present:
                break
            cells, close = self._split(settle(placed.where("kind = 'split'"), "split"), sets, level)
            leaves.append(close)
            rows = settle(_open(cells), "cells")
        for links in leaves:
            found = found.unionByName(links)
        found = settle(found, "links")
        if crowded:
            found = settle(found.unionByName(self._indexed(crowded, found, sets)), "links")
        return classes, found

    def _read(self, docs: DataFrame) -> DataFrame:
        """``doc_id, n_shingles, k1, k2, prefix``: the set of each row by name, and its first hashes."""
        k, percent, extra = self.shingle, self.percent, self.extra

        def read(batches: Iterator[pa.RecordBatch]):
            words = Words(SPACES)
            for batch in batches:
                ids = batch.column("doc_id")
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    sets, bounds = shingle_sets(words, raw, offsets, k)
                    sizes = np.diff(bounds)
                    room = np.minimum(sizes, sizes - (sizes * percent + 99) // 100 + np.maximum((sizes * extra + 99) // 100, 1))
                    cuts = np.concatenate(([0], np.cumsum(room)))
                    at = np.arange(cuts[-1]) + np.repeat(bounds[:-1] - cuts[:-1], room)
                    yield {
                        "doc_id": ids.slice(first, end - first), "n_shingles": sizes, **_names(sets, bounds),
                        "prefix": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(sets[at].view(np.int64))),
                    }

        schema = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, prefix array<bigint>"
        return map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), read, schema)

    def _classes(self, signed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All classes with their node ids, and those that share one of their first shingles with another class."""
        keys = ["k1", "k2", "n_shingles"]
        known = signed.where("n_shingles > 0 and doc_id is not null")
        filed = known.select(*keys, F.explode("prefix").alias("item"))
        shared = settle(filed.groupBy("item").agg(F.min("k1").alias("_low"), F.max("k1").alias("_high")).where("_low < _high").select("item"), "shared")
        few = shared.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # a number a row
        may = self._may_share(known.select(*keys, "prefix"), shared).select(*keys, F.explode("items").alias("item"))
        met = may.join(F.broadcast(shared) if few else shared, "item", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        # the share of a similar set may be taken of a smaller one; rows of one class count again, which keeps more
        least = F.ceil(needed(F.col("n_shingles"), self.percent) * self.extra / 100)
        crowd = met.where(F.col("n") >= F.greatest(least, F.lit(1))).select("k1", "k2")
        classes = known.groupBy(*keys).agg(F.min("doc_id").alias("rep"))
        # where an id has unlike texts, all but one of its classes get a number behind all ids
        order = Window.partitionBy("rep").orderBy(*keys)
        behind = F.shiftrightunsigned(F.xxhash64("rep", *keys), 2).bitwiseOR(F.lit(1 << 62))
        classes = settle(classes.withColumn("id", F.when(F.row_number().over(order) == 1, F.col("rep")).otherwise(behind)), "classes")
        return classes, settle(classes.join(crowd, ["k1", "k2"], "left_semi"), "crowd")

    def _may_share(self, known: DataFrame, shared: DataFrame) -> DataFrame:
        """The rows of ``known`` with those ``items`` of their prefix that a bitmap of ``shared`` shows, where these are enough.

        The bitmap has a fixed size. The fuller it is, the more rows pass; none that shares enough is left out.
        """
        low_bits = F.col("item").bitwiseAND(F.lit((1 << PRUNE_BITS) - 1))
        bitmap = known.sparkSession.sparkContext.broadcast(quotient_bitmap(shared.select(low_bits.alias("place"))))
        percent, extra = self.percent, self.extra

        def show(batches: Iterator[pa.RecordBatch]):
            bits = bitmap.value
            for batch in batches:
                lists = batch.column("prefix")
                items = lists.flatten().to_numpy(zero_copy_only=False)
                place = items & ((1 << PRUNE_BITS) - 1)
                shown = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                sizes = np.asarray(lists.value_lengths()).astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                held = np.bincount(owner[shown], minlength=len(sizes))
                n = batch.column("n_shingles").to_numpy()
                least = np.maximum(-(-((n * percent + 99) // 100) * extra // 100), 1)
                enough = held >= least
                kept = items[shown & enough[owner]]
                cuts = np.concatenate(([0], np.cumsum(held[enough])))
                rows = pa.array(np.flatnonzero(enough))
                yield {c: batch.column(c).take(rows) for c in ("k1", "k2", "n_shingles")} | {
                    "items": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(kept, pa.int64()))
                }

        return map_batches(known, show, "k1 bigint, k2 bigint, n_shingles bigint, items array<bigint>")

    def _sets(self, docs: DataFrame, crowd: DataFrame, repeated: bool = True) -> DataFrame:
        """Stored ``id, n, items`` with the full hashed sets of ``crowd``; ``repeated`` tells whether rows come again."""
        k = self.shingle
        few = crowd.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # a few numbers a row
        wanted = crowd.select(F.col("rep").alias("doc_id")).distinct()
        wanted = F.broadcast(wanted) if few else wanted
        texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text is not null").join(wanted, "doc_id", "left_semi")

        def full(batches: Iterator[pa.RecordBatch]):
            words = Words(SPACES)
            for batch in batches:
                ids = batch.column("doc_id")
                for first, end, raw, offsets in text_slices(batch.column("text")):
                    sets, bounds = shingle_sets(words, raw, offsets, k)
                    listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))
                    yield {"rep": ids.slice(first, end - first), **_names(sets, bounds), "items": listed}

        found = map_batches(texts, full, "rep bigint, k1 bigint, k2 bigint, items array<bigint>")
        listed = crowd.select("rep", "k1", "k2", "id")
        named = found.join(F.broadcast(listed) if few else listed, ["rep", "k1", "k2"]).select("id", F.size("items").alias("n"), "items")
        return settle(named.dropDuplicates(["id"]) if repeated else named, "sets")

    def _linked(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return counted_pairs(settle(pairs, "pairs"), sets, self.percent).select("a", "b")

    def _split(self, rows: DataFrame, sets: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        """Voronoi cells (``region, id, part, of``) of the regions of ``rows`` (``region, id, part, rows``), and links to their pivots."""
        draw = F.xxhash64(F.lit(level), "id")
        slots = rows.groupBy("region", F.pmod(draw, F.lit(self.pivots)).alias("_slot")).agg(F.min_by("id", draw).alias("id"))
        drawn = slots.join(sets.select("id", "items"), "id").select("region", F.struct("id", "items").alias("_p"))
        drawn = settle(drawn.groupBy("region").agg(F.collect_list("_p").alias("_pivots")), "pivots")
        full = settle(rows.join(sets.select("id", "items"), "id"), "members")
        counts = rows.select("region", "rows").distinct().select(F.xxhash64("region").alias("_key"), F.col("rows").cast("bigint").alias("_left"))
        both = balanced_join(full, drawn, ["region"], ["id"], left_counts=counts)

        def measured(p: Column) -> Column:
            shared = F.size(F.array_intersect("items", p["items"]))
            return F.struct(p["id"].alias("pivot"), shared.alias("shared"), (F.size("items") + F.size(p["items"]) - shared).alias("together"))

        to = both.select("region", "id", "part", "rows", F.transform("_pivots", measured).alias("to"))
        far = lambda t: 1 - t["shared"] / t["together"]
        wide = settle(
            to.withColumn("nearest", F.array_min(F.transform("to", far))).select("region", "id", "part", "rows", "nearest", F.explode("to").alias("t")), "measured"
        )
        close = wide.where("id <> t.pivot and t.shared * 100 >= t.together * " + str(self.percent)).select(
            F.least("id", "t.pivot").alias("a"), F.greatest("id", "t.pivot").alias("b")
        )
        window = 2 * (1 - self.percent / 100) + _EPSILON
        cells = wide.where(far(F.col("t")) <= F.col("nearest") + window).select(
            F.xxhash64("region", "t.pivot").alias("region"), "id", "part", F.col("rows").alias("of")
        )
        return cells, settle(close.distinct(), "cell-links")

    def _joined(self, rows: DataFrame, sets: DataFrame) -> DataFrame:
        """``a, b``: links that connect the similar sets of each region of ``rows``, each in one task."""
        percent = self.percent

        def join(table: pa.Table) -> pa.Table:
            a, b = small_join(
                table.column("id").to_numpy(), table.column("part").to_numpy(),
                [np.asarray(x.values) for x in table.column("items")], percent,
            )
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        return rows.select("region", "id", "part").join(sets.select("id", "items"), "id").groupBy("region").applyInArrow(join, "a bigint, b bigint")

    def _indexed(self, crowded: list[DataFrame], found: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between classes of crowded regions that ``found`` has not connected."""
        ids = crowded[0].select("id")
        for other in crowded[1:]:
            ids = ids.union(other.select("id"))
        parts = connected(found).toDF("id", "part")
        own = ids.distinct().join(parts, "id", "left").select("id", F.coalesce("part", "id").alias("part"))
        own = settle(own.join(sets.select("id", "items"), "id").select("id", "part", "items"), "crowded-sets")
        pairs = settle(prefix_candidates(own, self.percent), "candidates")
        return counted_pairs(pairs, own, self.percent).select("a", "b")


def _names(sets: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Two hashes that name each whole set."""
    out = {}
    for name, values in (("k1", mixed(sets)), ("k2", mixed(sets ^ _SALT))):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        out[name] = (sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64)
    return out


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose ends are not connected."""
    named = pairs.join(labels.toDF("a", "_la"), "a", "left").join(labels.toDF("b", "_lb"), "b", "left")
    return named.where(F.coalesce("_la", "a") != F.coalesce("_lb", "b")).select("a", "b")


def _open(rows: DataFrame) -> DataFrame:
    """The rows of regions with more than one part."""
    several = rows.groupBy("region").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low < _high")
    return rows.join(several.select("region"), "region", "left_semi")


def small_join(ids: np.ndarray, parts: np.ndarray, items: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
    """Links that connect all similar sets of different parts; overlaps of all by products over blocks of shared items."""
    sizes = np.array([len(x) for x in items], np.int64)
    owner = np.repeat(np.arange(len(items)), sizes)
    _, item, held = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    common = np.flatnonzero(held > 1)
    place = np.full(len(held), -1, np.int64)
    place[common] = np.arange(len(common))
    column = place[item]
    owner, column = owner[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(items), len(items)), np.float64)
    for low in range(0, len(common), _COLUMNS):
        own = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
        block = np.zeros((len(items), min(_COLUMNS, len(common) - low)), np.float32)
        block[owner[own], column[own] - low] = 1
        shared += block @ block.T
    shared = shared.astype(np.int64)
    similar = np.triu(shared * 100 >= (sizes[:, None] + sizes[None, :] - shared) * percent, 1)
    similar &= parts[:, None] != parts[None, :]
    root = {p: p for p in parts.tolist()}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = p = root[root[p]]
        return p

    a, b = [], []
    for i, j in zip(*np.nonzero(similar)):
        x, y = find(int(parts[i])), find(int(parts[j]))
        if x != y:
            root[max(x, y)] = min(x, y)
            a.append(int(min(ids[i], ids[j])))
            b.append(int(max(ids[i], ids[j])))
    return a, b


def oracle(shingle: int = 5, percent: int = 80) -> str:
    """The same in SQL from the definitions: all overlaps by a join on shingles, components by reaching out along links."""
    upper = "".join(chr(c) for c in range(65, 91))
    return f"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    shingles AS MATERIALIZED (
        SELECT DISTINCT doc_id, array_to_string(w[p:p + {shingle - 1}], ' ') AS s
        FROM worded, unnest(range(1, greatest(len(w) - {shingle - 2}, 2))) AS starts(p) WHERE len(w) > 0),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
    links AS MATERIALIZED (
        SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared >= {percent} * (p.n + q.n - shared)),
    reached AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
    SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
    FROM documents d JOIN reached r ON r.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""
