"""Packing of token sequences: shortest pack first over the histogram of lengths.

Documents are cut into pieces of at most ``size`` tokens. Only the histogram of piece lengths (at most
``size`` rows) reaches the driver. Lengths are placed longest first; all pieces of a length go
together, one into each pack of the pattern with the most room, else into new packs. Each pattern
keeps a count of packs, so the plan stays small whatever the number of documents. A piece then finds
its place by its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.ranking import chunked, running_totals
from minekit.functions.storage import settle
from minekit.llm.batches import map_batches
from minekit.llm.tokens import encoder


@dataclass
class Pattern:
    """``count`` packs that hold the same lengths, given as ``(length, first rank)`` in order."""

    count: int
    room: int
    parts: list[tuple[int, int]] = field(default_factory=list)

    def split(self, count: int) -> Pattern:
        """Take ``count`` packs off this pattern; ranks go to the packs in order."""
        taken = Pattern(count, self.room, list(self.parts))
        self.parts = [(length, first + count) for length, first in self.parts]
        self.count -= count
        return taken


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[Pattern]:
    """Patterns that place every piece of ``histogram`` (length: count) into packs of ``size``."""
    by_room: dict[int, list[Pattern]] = {}
    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left:
            room = max((r for r, own in by_room.items() if own and r >= length), default=None)
            if room is None:
                each = size // length  # new packs; equal pieces side by side
                if left >= each:
                    made = Pattern(left // each, size - each * length)
                    made.parts = [(length, first + k * made.count) for k in range(each)]
                    used = made.count * each
                else:
                    made, used = Pattern(1, size - left * length, [(length, first + k) for k in range(left)]), left
                by_room.setdefault(made.room, []).append(made)
            else:
                old = by_room[room][-1]
                used = min(left, old.count)
                taken = old.split(used) if used < old.count else by_room[room].pop()
                taken.parts.append((length, first))
                taken.room -= length
                by_room.setdefault(taken.room, []).append(taken)
            first, left = first + used, left - used
    return [p for own in by_room.values() for p in own]


@dataclass(frozen=True)
class Packing:
    """Settings: tokenizer file, the id that ends a document, tokens per sequence, padding id."""

    tokenizer: str
    end_id: int = 1
    size: int = 2048
    pad_id: int = 0

    def pieces(self, docs: DataFrame) -> DataFrame:
        """``doc_id, start, length, ids_crc32, doc_tokens`` of every piece, stored.

        Null and empty texts are one piece that holds the end id. Repeated rows are packed as often as they
        occur, rows without a ``doc_id`` too; other columns are ignored; an empty table gives no row.
        """
        made_by, end_id, size = self.tokenizer, self.end_id, self.size

        def cut(batches: Iterator[pa.RecordBatch]):
            encode = encoder(made_by, end_id)
            for batch in batches:
                names = batch.column("doc_id").to_pylist()
                rows = []
                for doc_id, ids in zip(names, encode(batch.column("text").fill_null("").to_pylist())):
                    whole = len(ids) // 4
                    for at in range(0, whole, size):
                        part = ids[4 * at : 4 * (at + size)]
                        rows.append((doc_id, at, len(part) // 4, zlib.crc32(part), whole))
                columns = zip(*rows) if rows else [[]] * 5
                yield dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens"), map(list, columns)))

        schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
        return settle(map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), cut, schema, True), "pieces")

    def plan(self, pieces: DataFrame) -> DataFrame:
        """``length, first, last, base, offset``: where the ranks of each length go; bounded by ``size``."""
        found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most ``size`` rows
        rows, base = [], 0
        for pattern in shortest_pack_first({r.length: r.n for r in found}, self.size):
            offset = 0
            for length, first in pattern.parts:
                rows.append((length, first, first + pattern.count - 1, base, offset))
                offset += length
            base += pattern.count
        table = pieces.sparkSession.createDataFrame(
            rows, "length bigint, first bigint, last bigint, base bigint, offset bigint"
        )
        return table

    def place(self, pieces: DataFrame) -> DataFrame:
        """Add ``sequence_id, offset`` to stored pieces."""
        order = ["length", "doc_id", "start", "ids_crc32"]
        ranked = running_totals(chunked(pieces, order, "lengths"), ["length"], order[1:], {"rank": "1"})
        blocks = F.broadcast(self.plan(pieces))  # a few thousand rows, see above
        hit = (F.col("before_rank") >= F.col("first")) & (F.col("before_rank") <= F.col("last"))
        return (
            ranked.join(blocks.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & hit)
            .select(
                *pieces.columns,
                (F.col("base") + F.col("before_rank") - F.col("first")).alias("sequence_id"),
                "offset",
            )
        )

    def run(self, docs: DataFrame) -> DataFrame:
        """All pieces of ``docs`` with their places."""
        return self.place(self.pieces(docs))

    def sequences(self, docs: DataFrame, placed: DataFrame) -> DataFrame:
        """``sequence_id, n_tokens, ids``: the filled sequences, for documents with unique ids.

        Padded with ``pad_id`` to ``size`` unless the number of tokens is a power of two.
        """
        made_by, end_id, size, pad = self.tokenizer, self.end_id, self.size, self.pad_id

        def cut(batches: Iterator[pa.RecordBatch]):
            encode = encoder(made_by, end_id)
            for batch in batches:
                names, rows = batch.column("doc_id").to_pylist(), []
                for doc_id, ids in zip(names, encode(batch.column("text").fill_null("").to_pylist())):
                    wide = np.frombuffer(ids, "<u4").tolist()
                    rows += [(doc_id, at, wide[at : at + size]) for at in range(0, len(wide), size)]
                columns = zip(*rows) if rows else [[]] * 3
                yield dict(zip(("doc_id", "start", "part"), map(list, columns)))

        parts = map_batches(docs.select(F.col("doc_id").cast("bigint"), "text"), cut, "doc_id bigint, start bigint, part array<int>", True)
        joined = placed.join(parts, ["doc_id", "start"]).groupBy("sequence_id")
        listed = joined.agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "part"))).alias("p"))
        ids = F.flatten(F.transform("p", lambda x: x["part"]))
        power = F.bit_count("n_tokens") == 1
        missing = F.when(power, 0).otherwise(size - F.col("n_tokens")).cast("int")
        return listed.select("sequence_id", "n_tokens", F.concat(ids, F.array_repeat(F.lit(pad), missing)).alias("ids"))
