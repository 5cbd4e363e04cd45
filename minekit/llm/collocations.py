"""Phrases whose words keep together, per language, from exact counts in counting quotient filters.

1. Words are counted per language; those that occur often enough are numbered. A phrase that occurs often holds no other words, so all
   others only part the text, as the ends of pieces do. Texts become lists of numbers, 0 where a phrase cannot go on.
2. For 2, 3 .. words the numbers of each n-gram are packed into one key. Every task counts keys in counting quotient filters (see
   ``quotient``): invertibly permuted, the upper bits as place, the full rest stored, so nothing is estimated. Filters leave a task as sorted
   runs of bytes, one per shard of the permuted keys, and the filters of a shard are merged. An n-gram is counted only if both
   its parts one word shorter may be frequent: their quotients are looked up in a bitmap of fixed size. Where the bitmap fills up,
   more n-grams are counted and dropped after the merge; the result stays the same.
3. Each cut of a phrase into two compares its count with what independent parts would give; the lowest cut is its score. A phrase inside
   a longer one that is (nearly) as frequent is dropped. The best of each language are returned.

Hot words and phrases are one entry of each filter, whatever their count. The number of shards follows the number of words.

Cases: A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A null language is ``und``. Null and empty texts
count nothing; ids do not matter, repeated rows count again; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from minekit.functions.ranking import dense_index
from minekit.functions.skew import balanced_join, row_counts
from minekit.functions.storage import settle
from minekit.llm.batches import SLICE_BYTES, map_batches
from minekit.llm.quotient import Permutation, decode, encode, summed

_BREAK = b"\xff"  # in no UTF-8 text
_FOLD = bytearray(range(256))
for _c in range(65, 91):
    _FOLD[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_c] = 0xFF
_FOLD[9] = 32
_FOLD = bytes(_FOLD)
FLUSH_WORDS = 200_000
FLUSH_KEYS = 1 << 21
SHARD_WORDS = 1 << 21
PRUNE_BITS = 26
_CHUNK_BITS = 15  # bits of one row of a bitmap


def tokens(text: str) -> list[bytes]:
    """The words of a text in order, with a break wherever a piece ends."""
    return text.encode().translate(_FOLD).replace(_BREAK, b" \xff ").split()


@dataclass(frozen=True)
class Collocations:
    """Longest phrase, least count, phrases per language, and the share of a count at which a longer phrase covers a shorter.

    Up to ``broadcast_words`` numbered words are sent to all tasks; more meet the texts by a join instead.
    """

    max_words: int = 5
    min_count: int = 100
    top: int = 2000
    covered_percent: int = 100
    broadcast_words: int = 1_000_000

    def run(self, docs: DataFrame) -> DataFrame:
        """``lang, rank, phrase, a, l, r, n, score`` of ``docs`` (lang, text); ``rank`` from 1."""
        texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
        counted = settle(self.words(texts), "words")
        totals = counted.groupBy("lang").agg(F.sum("f").alias("n"))
        words = settle(dense_words(counted.where(F.col("f") >= self.min_count)), "numbered")
        n_words, last = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("f"), F.lit(0))).first()
        bits = max(1, int(n_words).bit_length())  # numbers begin at 1
        lists = settle(self.numbered(texts, words, n_words), "lists")
        shard_bits = min(24, max(6, (int(last) // SHARD_WORDS).bit_length()))
        levels = [words.select(F.array("id").alias("ids"), "f")]
        seen: DataFrame | None = None
        for k in range(2, self.max_words + 1):
            seen = settle(self.frequent(lists, k, bits, shard_bits, seen), f"grams-{k}")
            levels.append(seen.select("ids", "f"))
        grams = levels[0]
        for level in levels[1:]:
            grams = grams.unionByName(level)
        return self.best(settle(grams, "grams"), words, totals)

    def words(self, texts: DataFrame) -> DataFrame:
        """``lang, word, f``: all words with their counts."""

        def count(batches: Iterator[pa.RecordBatch]):
            held: dict[str, Counter] = {}
            for batch in batches:
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    if text:
                        held.setdefault(lang, Counter()).update(tokens(text))
                if sum(map(len, held.values())) > FLUSH_WORDS:
                    yield from rows(held)
                    held = {}
            yield from rows(held)

        def rows(held: dict[str, Counter]):
            for lang, own in held.items():
                own.pop(_BREAK, None)
                if own:
                    yield {"lang": [lang] * len(own), "word": [w.decode() for w in own], "f": list(own.values())}

        found = map_batches(texts.select("lang", "text"), count, "lang string, word string, f bigint")
        return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))

    def numbered(self, texts: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
        """``ids``: the words of each text as numbers, 0 where a word has none or a piece ends."""
        if n_words > self.broadcast_words:
            return self._joined(texts, words)
        table: dict[str, dict[bytes, int]] = {}
        for r in words.select("lang", "word", "id").toLocalIterator():
            table.setdefault(r.lang, {})[r.word.encode()] = r.id
        shared = texts.sparkSession.sparkContext.broadcast(table)

        def number(batches: Iterator[pa.RecordBatch]):
            own = shared.value
            for batch in batches:
                out, size = [], 0
                for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                    get = own.get(lang, {}).get
                    out.append(np.array([get(w, 0) for w in tokens(text or "")], np.int32))
                    size += len(out[-1])
                    if size > SLICE_BYTES:
                        yield {"ids": _listed(out)}
                        out, size = [], 0
                if out:
                    yield {"ids": _listed(out)}

        return map_batches(texts.select("lang", "text"), number, "ids array<int>")

    def _joined(self, texts: DataFrame, words: DataFrame) -> DataFrame:
        """The same lists by a join on the words, each text gathered again from its numbered words."""
        named = settle(texts.where("text is not null").withColumn("row", F.monotonically_increasing_id()), "rows")

        def spell(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for row, lang, text in zip(*(batch.column(c).to_pylist() for c in ("row", "lang", "text"))):
                    found = [(i, w) for i, w in enumerate(tokens(text)) if w != _BREAK]
                    for low in range(0, len(found), SLICE_BYTES):
                        part = found[low : low + SLICE_BYTES]
                        yield {
                            "row": [row] * len(part), "lang": [lang] * len(part),
                            "at": [i for i, _ in part], "word": [w.decode() for _, w in part],
                        }

        spelled = settle(map_batches(named, spell, "row bigint, lang string, at int, word string"), "spelled")
        # words are their own counts: the hot ones are cut into blocks
        counts = words.select(F.xxhash64("lang", "word").alias("_key"), F.col("f").alias("_left"))
        known = balanced_join(spelled, words.select("lang", "word", "id"), ["lang", "word"], ["row", "at"], left_counts=counts)
        gathered = known.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "id"))).alias("found"))

        def fill(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                out = []
                for found in batch.column("found").to_pylist():
                    ids = np.zeros(found[-1]["at"] + 1, np.int32)
                    ids[[x["at"] for x in found]] = [x["id"] for x in found]
                    out.append(ids)
                yield {"ids": _listed(out)}

        return map_batches(gathered.select("found"), fill, "ids array<int>")

    def frequent(self, lists: DataFrame, k: int, word_bits: int, shard_bits: int, shorter: DataFrame | None) -> DataFrame:
        """``ids, f, place`` of the ``k``-grams that occur often enough; ``place`` is the quotient for the next bitmap."""
        bits = _key_bits(k, word_bits)
        own_shard_bits = min(shard_bits, bits)
        grams, permutation = _Grams(k, word_bits), Permutation(bits)
        bitmap = None if shorter is None or k < 3 else lists.sparkSession.sparkContext.broadcast(quotient_bitmap(shorter))
        previous = _Grams(k - 1, word_bits)
        least = self.min_count

        def count(batches: Iterator[pa.RecordBatch]):
            held, size = [], 0
            for batch in batches:
                numbers = _separated(batch.column("ids"))
                keys = grams.keys(numbers, previous if bitmap is not None else None, bitmap.value if bitmap is not None else None)
                held.append(summed(permutation.forward(keys), np.ones(len(keys[0]), np.int64)))
                size += len(held[-1][1])
                if size > FLUSH_KEYS:
                    yield from filters(held)
                    held, size = [], 0
            yield from filters(held)

        def filters(held):
            if not held:
                return
            lanes, counts = summed([np.concatenate(x) for x in zip(*(lanes for lanes, _ in held))], np.concatenate([c for _, c in held]))
            shards = permutation.leading(lanes, own_shard_bits).astype(np.int64)
            names, first = np.unique(shards, return_index=True)
            ends = np.append(first[1:], len(shards))
            for low in range(0, len(names), 1024):
                part = range(low, min(low + 1024, len(names)))
                if len(part):
                    yield {
                        "shard": names[low : low + 1024],
                        "filter": [encode([x[first[i] : ends[i]] for x in lanes], counts[first[i] : ends[i]], bits, own_shard_bits) for i in part],
                    }

        def merge(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            parts = [decode(x, shard, bits, own_shard_bits) for x in table.column("filter").to_pylist()]
            lanes, counts = summed([np.concatenate(x) for x in zip(*(lanes for lanes, _ in parts))], np.concatenate([c for _, c in parts]))
            often = counts >= least
            lanes = [x[often] for x in lanes]
            ids = grams.numbers(permutation.backward(lanes))
            return pa.table(
                {
                    "ids": pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * k, pa.int32()), pa.array(ids.reshape(-1), pa.int32())),
                    "f": pa.array(counts[often], pa.int64()),
                    "place": pa.array(permutation.leading(lanes, PRUNE_BITS).astype(np.int64), pa.int64()),
                }
            )

        runs = map_batches(lists, count, "shard bigint, filter binary")
        return runs.groupBy("shard").applyInArrow(merge, "ids array<int>, f bigint, place bigint")

    def best(self, grams: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
        """Scores, what longer phrases cover, and the first of each language. ``grams``: all frequent ``ids, f``, single words too."""
        size = F.size("ids")
        phrases = grams.where(size >= 2)
        inner = F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids")
        longer = phrases.where(size >= 3).select(inner, "f").groupBy("ids").agg(F.max("f").alias("longer"))
        open_ = phrases.join(longer, "ids", "left").where(
            F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * self.covered_percent)
        )
        cuts = settle(open_.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("cut")), "cuts")
        sided = cuts.select(
            "*", F.slice("ids", F.lit(1), F.col("cut")).alias("first"), F.slice("ids", F.col("cut") + 1, size - F.col("cut")).alias("rest")
        )
        sided = balanced_join(sided, grams.toDF("first", "l"), ["first"], ["ids", "cut"])
        rests = row_counts(cuts.select(F.slice("ids", F.col("cut") + 1, size - F.col("cut")).alias("rest")), ["rest"], "_left")
        sided = balanced_join(sided, grams.toDF("rest", "r"), ["rest"], ["ids", "cut"], left_counts=rests)
        sided = sided.select("ids", "a", "cut", "l", "r")

        # the texts of the phrases, and with them the language
        spelled = settle(open_.select("ids", F.posexplode("ids").alias("at", "id")), "spelled")
        spelled = balanced_join(spelled, words.select("id", "lang", "word"), ["id"], ["ids", "at"])
        named = spelled.groupBy("ids").agg(
            F.first("lang").alias("lang"),
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"),
        )
        wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731  1000 * a * n and l * r in 38 digits
        ratio = named.join(totals, "lang").join(sided, "ids").select(
            "lang", "phrase", "ids", "cut", "a", "l", "r", "n", (F.lit(1000).cast("decimal(4,0)") * wide("a")).cast("decimal(19,0)").alias("_up")
        )
        scored = ratio.withColumn("score", F.expr("(_up * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
        lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low"))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        return (
            lowest.select("lang", "phrase", "a", "low.l", "low.r", "n", "low.score")
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= self.top)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
        )


def dense_words(frequent: DataFrame) -> DataFrame:
    """``lang, word, f, id``: the words numbered from 1 by language and word."""
    keyed = frequent.withColumn("key", F.struct("lang", "word"))
    return dense_index(keyed, "key", "at").select("lang", "word", "f", (F.col("at") + 1).alias("id"))


def _key_bits(k: int, word_bits: int) -> int:
    """Bits of a key; above 64 at least 32 in the upper lane, for the shards."""
    bits = k * word_bits
    return bits if bits <= 64 else max(64 * (bits - 1 >> 6) + 32, bits)


class _Grams:
    """Packs runs of ``k`` numbers into keys, and back."""

    def __init__(self, k: int, word_bits: int):
        self.k, self.word_bits, self.permutation = k, word_bits, Permutation(_key_bits(k, word_bits))

    def keys(self, numbers: np.ndarray, shorter: _Grams | None, bitmap: np.ndarray | None) -> list[np.ndarray]:
        """Keys of all runs without a 0; with a ``bitmap``, of those whose two shorter runs it shows."""
        n = max(0, len(numbers) - self.k + 1)
        whole = np.ones(n, bool)
        for i in range(self.k):
            whole &= numbers[i : i + n] != 0
        at = np.flatnonzero(whole)
        for step in (0, 1) if shorter is not None else ():
            places = shorter.permutation.leading(shorter.permutation.forward(shorter._pack(numbers, at + step)), PRUNE_BITS)
            at = at[bitmap[places.astype(np.int64) >> 3] >> (places & np.uint64(7)).astype(np.uint8) & 1 == 1]
        return self._pack(numbers, at)

    def _pack(self, numbers: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        lanes = [np.zeros(len(at), np.uint64) for _ in range(self.permutation.lanes)]
        bits = np.uint64(self.word_bits)
        for i in range(self.k):
            for j in range(len(lanes) - 1):
                lanes[j] = (lanes[j] << bits) | (lanes[j + 1] >> (np.uint64(64) - bits))
            lanes[-1] = (lanes[-1] << bits) | numbers[at + i].astype(np.uint64)
        return lanes

    def numbers(self, lanes: list[np.ndarray]) -> np.ndarray:
        lanes, bits = list(lanes), np.uint64(self.word_bits)
        out = np.zeros((len(lanes[0]), self.k), np.int32)
        for i in range(self.k - 1, -1, -1):
            out[:, i] = (lanes[-1] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int32)
            lanes[-1] = lanes[-1] >> bits
            for j in range(len(lanes) - 1, 0, -1):
                lanes[j] = lanes[j] | (lanes[j - 1] << (np.uint64(64) - bits))
                lanes[j - 1] = lanes[j - 1] >> bits
        return out


def quotient_bitmap(grams: DataFrame) -> np.ndarray:
    """One bit for each quotient of ``PRUNE_BITS`` bits that a row has; at most 8 MB, whatever the rows."""
    chunk = 1 << _CHUNK_BITS
    rows = grams.groupBy((F.col("place") / chunk).cast("bigint").alias("chunk")).agg(
        F.bitmap_construct_agg(F.col("place") % chunk).alias("bits")
    )
    out = np.zeros(1 << PRUNE_BITS - 3, np.uint8)
    for r in rows.toLocalIterator():
        own = np.frombuffer(r.bits, np.uint8)
        out[r.chunk * (chunk >> 3) :][: len(own)] = own
    return out


def _separated(column: pa.Array) -> np.ndarray:
    """All lists of a column in one array, with a 0 behind each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(column.value_lengths().fill_null(0)).astype(np.int64)
    out = np.zeros(len(flat) + len(sizes), np.int32)
    inside = np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)
    out[inside] = flat
    return out


def _listed(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in rows])))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(rows), pa.int32()))


def oracle(min_count: int = 100, top: int = 2000, covered_percent: int = 100) -> str:
    """The same in SQL, from the definitions: all n-grams counted, all phrases inside longer ones listed."""
    upper = "".join(chr(c) for c in range(65, 91))
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
    grams AS MATERIALIZED (
        SELECT lang, k, array_to_string(w[p:p + k - 1], ' ') AS phrase, count(*) AS f
        FROM worded, unnest(range(1, 6)) AS sizes(k), unnest(range(1, len(w) - k + 2)) AS starts(p)
        GROUP BY lang, k, phrase HAVING count(*) >= {min_count}),
    phrases AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2),
    inner_phrases AS (
        SELECT lang, array_to_string(w[p:p + m - 1], ' ') AS phrase, max(f) AS f
        FROM phrases, unnest(range(2, k)) AS sizes(m), unnest(range(1, k - m + 2)) AS starts(p) GROUP BY lang, array_to_string(w[p:p + m - 1], ' ')),
    cuts AS (
        SELECT p.lang, p.phrase, p.f AS a, cut, x.f AS l, y.f AS r, n,
               CAST(1000 AS HUGEINT) * p.f * n // (CAST(x.f AS HUGEINT) * y.f) AS score
        FROM phrases p CROSS JOIN LATERAL (SELECT unnest(range(1, p.k)) AS cut)
        JOIN grams x ON x.lang = p.lang AND x.k = cut AND x.phrase = array_to_string(w[1:cut], ' ')
        JOIN grams y ON y.lang = p.lang AND y.k = p.k - cut AND y.phrase = array_to_string(w[cut + 1:p.k], ' ')
        JOIN totals t ON t.lang = p.lang),
    lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
    left_over AS (
        SELECT o.* FROM lowest o LEFT JOIN inner_phrases i ON i.lang = o.lang AND i.phrase = o.phrase
        WHERE i.f IS NULL OR 100 * i.f < {covered_percent} * o.a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM left_over QUALIFY rank <= {top}"""
