"""Line forms of results and their distributed text sinks."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix_line() -> Column:
    """``i,k,v``."""
    return F.concat_ws(",", "i", "k", "v")


def entry_line() -> Column:
    """``name,i,j,v``."""
    return F.concat_ws(",", "name", "i", "j", "v")


def edge_line() -> Column:
    """Source and target, tab-separated."""
    return F.concat_ws("\t", "src", "dst")


def vector_line() -> Column:
    """``id``, a tab, and the blank-separated numbers of ``v``."""
    return F.concat_ws("\t", F.col("id").cast("string"), F.array_join(F.col("v").cast("array<string>"), " "))


def bare_vector_line() -> Column:
    """The blank-separated numbers of ``v``, without a key."""
    return F.array_join(F.col("v").cast("array<string>"), " ")


def rank_line() -> Column:
    """Node and rank, tab-separated, the rank with nine decimals."""
    return F.format_string("%d\t%.9f", "node", "rank")


def rank_tuple() -> Column:
    """``(node, rank)`` with every digit of the rank."""
    return F.format_string("(%s, %s)", F.col("node").cast("string"), F.col("rank").cast("string"))


def pair_line() -> Column:
    """Both documents and their similarity, tab-separated."""
    return F.concat_ws("\t", "a", "b", "similarity")


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """Write one text line per row; the files follow the partitions, and so any sort, of ``df``."""
    df.select(line.alias("value")).write.text(path)


def write_corpus(docs: DataFrame, path: str, folders: int = 0) -> int:
    """Write each document (``name, text``) as a file of its own, ``<name>.txt``; the number of files.

    Names are unique and hold no slash. Tasks write under the folder ``path``, which all executors share, with the file system of its URI (local, or
    what the Arrow file systems know). A file appears whole, under its own name, so a task that runs again replaces what it wrote before. Many documents
    are dealt by name over that many ``folders`` below it, so that no folder is held up by all tasks or listed alone.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        fs.create_dir(root, recursive=True)
        made = {root}
        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").to_pylist()):
                folder = f"{root}/{zlib.crc32(str(name).encode()) % folders:04d}" if folders else root
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(part) as out:
                    out.write((text or "").encode())
                fs.move(part, f"{folder}/{name}.txt")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    counts = docs.select(F.col("name").cast("string").alias("name"), "text").mapInArrow(write, "n bigint")
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
