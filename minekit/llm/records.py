"""Token ids as length-delimited binary records in shard files with a separate offset index.

A shard ``shard-NNNNN.rec`` is a run of frames::

    u64 length of the payload | u32 masked checksum of those 8 bytes | payload | u32 masked checksum of it

with all numbers little-endian. The checksum is CRC-32, rotated right by 15 bits plus a constant, so
that data that hold their own checksums stay distinguishable. The payload is a byte for the width of
an id (2 or 4), a byte that says whether the document has an id, the document's id as i64, and the
token ids. ``shard-NNNNN.idx`` lists ``u64 offset, u64 length`` of each frame, so a shuffled reader
can seek to any record without reading the rest.

Documents stand in ascending order of ``doc_id`` over all shards (null first; equal ids by a hash of
the text, then the text). Null and empty texts hold only the end id; repeated rows are all kept. Columns beyond ``doc_id`` and
``text`` are ignored; an empty table gives no record. Each task writes under a name of its own and
renames when complete, so a repeated task replaces its shard by the same bytes.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.functions.ranking import chunked, running_totals
from minekit.functions.storage import fresh_path, partitions_for, settle
from minekit.llm.batches import map_batches
from minekit.llm.tokens import encoder

MASK = 0xA282EAD8
SHARD_TEXT_BYTES = 16 << 20
_HEAD = struct.Struct("<BBq")


def masked(data: bytes) -> int:
    """The checksum of a frame's part."""
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data, at: int) -> tuple[bytes, int]:
    """The payload of the frame at ``at`` and the place after it; raises ``ValueError`` when damaged."""
    size = bytes(data[at : at + 8])
    if len(size) < 8 or struct.pack("<I", masked(size)) != bytes(data[at + 8 : at + 12]):
        raise ValueError(f"damaged length at byte {at}")
    end = at + 12 + struct.unpack("<Q", size)[0]
    payload = bytes(data[at + 12 : end])
    if struct.pack("<I", masked(payload)) != bytes(data[end : end + 4]):
        raise ValueError(f"damaged record at byte {at}")
    return payload, end + 4


def pack_ids(doc_id: int | None, ids: bytes) -> bytes:
    """The payload of a document; ids take two bytes where all fit."""
    wide = np.frombuffer(ids, "<u4")
    narrow = len(wide) == 0 or int(wide.max()) < 1 << 16
    head = _HEAD.pack(2 if narrow else 4, doc_id is not None, doc_id or 0)
    return head + (wide.astype("<u2").tobytes() if narrow else ids)


def unpack_ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    width, known, doc_id = _HEAD.unpack_from(payload)
    return (doc_id if known else None), np.frombuffer(payload, f"<u{width}", offset=_HEAD.size).astype("<u4")


def _open(folder: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


@dataclass(frozen=True)
class RecordFiles:
    """Writes and reads shards of token ids under one folder that all executors share."""

    tokenizer: str
    end_id: int

    def write(self, docs: DataFrame, folder: str) -> DataFrame:
        """Write the shards of ``docs``; ``shard, path, n_records, n_tokens`` per shard, stored."""
        made_by, end_id = self.tokenizer, self.end_id
        parts = partitions_for(docs.select("doc_id", "text"), SHARD_TEXT_BYTES)

        def write(batches: Iterator[pa.RecordBatch]):
            fs, root = _open(folder)
            fs.create_dir(root, recursive=True)
            shard = TaskContext.get().partitionId()
            name = f"{root}/shard-{shard:05d}"
            mark, encode = uuid.uuid4().hex, encoder(made_by, end_id)
            n_records = n_tokens = at = 0
            index = []
            with fs.open_output_stream(f"{name}.rec.{mark}") as out:
                for batch in batches:
                    texts = batch.column("text").fill_null("").to_pylist()
                    for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                        data = frame(pack_ids(doc_id, ids))
                        out.write(data)
                        index.append((at, len(data)))
                        at, n_tokens = at + len(data), n_tokens + len(ids) // 4
            with fs.open_output_stream(f"{name}.idx.{mark}") as out:
                out.write(np.array(index, "<u8").tobytes())
            for kind in ("idx", "rec"):
                fs.move(f"{name}.{kind}.{mark}", f"{name}.{kind}")
            n_records = len(index)
            yield {"shard": [shard], "path": [f"{folder}/shard-{shard:05d}"], "n_records": [n_records], "n_tokens": [n_tokens]}

        ordered = (
            docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("_hash"))
            .repartitionByRange(parts, "doc_id", "_hash")
            .sortWithinPartitions("doc_id", "_hash", "text")
            .select("doc_id", "text")
        )
        manifest = map_batches(ordered, write, "shard bigint, path string, n_records bigint, n_tokens bigint", True)
        return settle(manifest, "manifest")

    def read(self, manifest: DataFrame) -> DataFrame:
        """``shard, record, doc_id, ids`` of every record, checked against its checksums."""

        def read(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for shard, path in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist()):
                    for first, records in _records(path):
                        ids, numbers = zip(*records)
                        yield {
                            "shard": [shard] * len(ids),
                            "record": list(range(first, first + len(ids))),
                            "doc_id": list(ids),
                            "ids": pa.array(numbers, pa.list_(pa.int64())),
                        }

        return map_batches(_dealt(manifest), read, "shard bigint, record bigint, doc_id bigint, ids array<bigint>")

    def digests(self, manifest: DataFrame) -> DataFrame:
        """``doc_id, start, n_tokens, ids_crc32`` of every record, read back from the files."""
        totals = running_totals(chunked(manifest, ["shard"], "shards"), [], ["shard"], {"tokens": "n_tokens"})
        placed = settle(totals.select("shard", "path", F.col("before_tokens").alias("before")), "starts")

        def read(batches: Iterator[pa.RecordBatch]):
            for batch in batches:
                for path, start in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                    for _, records in _records(path):
                        sizes = np.array([len(x) for _, x in records], np.int64)
                        ends = start + np.cumsum(sizes)
                        yield {
                            "doc_id": [x for x, _ in records],
                            "start": ends - sizes,
                            "n_tokens": sizes,
                            "ids_crc32": [zlib.crc32(x.tobytes()) for _, x in records],
                        }
                        start = int(ends[-1])

        return map_batches(_dealt(placed), read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def _dealt(manifest: DataFrame) -> DataFrame:
    """One shard per row, dealt over tasks."""
    return manifest.repartition(partitions_for(manifest, 1 << 10))


def _records(path: str, block: int = 1_000) -> Iterator[tuple[int, list[tuple[int | None, np.ndarray]]]]:
    """Blocks of ``first record, [(doc_id, ids)]`` of a shard, found through its index."""
    fs, root = _open(path)
    with fs.open_input_stream(f"{root}.idx") as file:
        index = np.frombuffer(file.read(), "<u8").reshape(-1, 2)
    with fs.open_input_file(f"{root}.rec") as file:
        for first in range(0, len(index), block):
            own = index[first : first + block]
            base = int(own[0, 0])
            data = file.read_at(int(own[-1].sum()) - base, base)
            yield first, [unpack_ids(unframe(data, int(at) - base)[0]) for at in own[:, 0]]


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write all documents as records in the shared folder and return the digests read from the files."""
    files = RecordFiles(tokenizer, end_id)
    return files.digests(files.write(docs, fresh_path(docs.sparkSession, "records")))
