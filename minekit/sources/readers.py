"""Readers for the text forms of each data kind; schemas are explicit, but for the names in a header."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minekit.functions.ranking import dense_index
from minekit.functions.storage import fresh_path, partitions_for, settle

# bytes of documents that one task reads from their files
CORPUS_BYTES = 4 << 20
# bytes of files that leave a task at once, files of a list that do
READ_BYTES = 1 << 20
LISTED_FILES = 1 << 12


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``name,i,j,v`` lines as ``name, i, j, v``."""
    return spark.read.schema("name string, i bigint, j bigint, v bigint").csv(path, mode="FAILFAST")


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``source, target`` lines as ``src, dst``."""
    return spark.read.schema("src bigint, dst bigint").csv(path, sep="\t", mode="FAILFAST")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated numbers, one vector per line, as ``file, v``.

    A line carries no key: ``read_numbered_vectors`` numbers the lines in file order, and
    ``read_keyed_vectors`` reads a form with keys.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.transform(F.split("value", " "), lambda x: x.cast("double")).alias("v"),
    )


def read_numbered_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Blank-separated numbers, one vector per line, as ``id, v``, numbered from 0 in the order of files and lines.

    The place of a line is taken at the scan (file, start of the split, place in the task), stored once so
    that it stays, and then numbered by ranges.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = spark.read.text(path).select(
        place.alias("place"), F.transform(F.split("value", " "), lambda x: x.cast("double")).alias("v")
    )
    return dense_index(settle(lines, "lines"), "place", "id").select("id", "v")


def read_keyed_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB>blank-separated numbers`` as ``id, v``."""
    fields = F.split("value", "\t")
    return spark.read.text(path).select(
        fields[0].cast("bigint").alias("id"),
        F.transform(F.split(fields[1], " "), lambda x: x.cast("double")).alias("v"),
    )


def read_corpus(spark: SparkSession, path: str, folders: bool = False) -> DataFrame:
    """One document per file as ``file, text``; the file name is the stable key. A file without any byte gives no row.

    With ``folders`` the files of all folders below ``path``, which may be more than the driver can hold: tasks list them, and the list is stored as text.
    Tasks whose number follows the bytes read the files from it, with the file system of their URI (local, or what the Arrow file systems know).
    """
    if folders:
        files = _listed_files(spark, path)
    else:
        files = spark.read.text(path, wholetext=True)
        files = files.coalesce(partitions_for(files, CORPUS_BYTES)).select(F.col("_metadata.file_name").alias("file"), "value")
    return files.select("file", F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def _hidden(name: str) -> bool:
    """Names that Spark's readers pass over too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, value`` of all files below ``path`` that are not empty."""
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"

    def below(recursive: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow.fs import FileSelector, FileSystem, FileType

            fs, root = FileSystem.from_uri(uri)

            def shown(found: list) -> list:
                return [f for f in found if not any(_hidden(part) for part in f.path[len(root) :].split("/") if part)]

            for batch in batches:
                for name, size in zip(*(batch.column(c).to_pylist() for c in ("name", "size"))):
                    # files have a size, folders have none
                    found = [(name, size)] if size is not None else [
                        (f.path, f.size if f.type == FileType.File else None)
                        for f in shown(fs.get_file_info(FileSelector(name or root, recursive=recursive)))
                        if f.type == FileType.File or not recursive
                    ]
                    for low in range(0, len(found), LISTED_FILES):
                        names, sizes = zip(*found[low : low + LISTED_FILES])
                        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.string()), "size": pa.array(sizes, pa.int64())})

        return listed

    kinds = "name string, size bigint"
    # the folders at the top are dealt out by their names
    top = spark.createDataFrame([(None, None)], kinds).coalesce(1).mapInArrow(below(False), kinds)
    files = top.repartition(4 * spark.sparkContext.defaultParallelism, "name").mapInArrow(below(True), kinds)
    listing = fresh_path(spark, "listing")
    # no name holds the character behind each entry
    files.where("size > 0").select(F.concat_ws("\t", "size", "name").alias("value")).write.option("lineSep", "\0").text(listing)
    entries = spark.read.option("lineSep", "\0").text(listing)
    entries = entries.select(F.substring_index("value", "\t", 1).cast("bigint").alias("size"), F.expr("substring(value, instr(value, '\t') + 1)").alias("name"))
    total = entries.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total / CORPUS_BYTES))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSystem

        fs, _ = FileSystem.from_uri(uri)
        for batch in batches:
            names, texts, held = [], [], 0
            for name in batch.column("name").to_pylist():
                with fs.open_input_stream(name) as file:
                    texts.append(file.read())
                names.append(name.rsplit("/", 1)[-1])
                held += len(texts[-1])
                if held >= READ_BYTES:
                    yield pa.RecordBatch.from_pydict({"file": names, "value": pa.array(texts, pa.binary())})
                    names, texts, held = [], [], 0
            if names:
                yield pa.RecordBatch.from_pydict({"file": names, "value": pa.array(texts, pa.binary())})

    dealt = entries.repartition(tasks).select("name")
    return dealt.mapInArrow(read, "file string, value binary").select("file", F.col("value").cast("string").alias("value"))


def read_labeled(
    spark: SparkSession, path: str, id_column: int = 1, category_column: int = 3
) -> DataFrame:
    """Tab-separated rows with a header as ``row_id, category, numbers, label``.

    Quotes are removed wherever they stand. Everything between the category and the last two columns
    is a number; the last column is the label and the one before it is unused.
    """
    raw = spark.read.csv(path, sep="\t", header=True, quote="", inferSchema=False, mode="FAILFAST")
    fields = [F.translate(F.col(f"`{name}`"), '"', "") for name in raw.columns]
    return raw.select(
        fields[id_column].cast("bigint").alias("row_id"),
        fields[category_column].alias("category"),
        F.array(*fields[category_column + 1 : -2]).alias("numbers"),
        fields[-1].cast("double").alias("label"),
    )


def read_rank_text(spark: SparkSession, path: str) -> DataFrame:
    """Ranks saved as ``(node, rank)`` lines, as ``node, rank``."""
    pattern = r"\(([^,]+), ([^)]+)\)"
    return spark.read.text(path).select(
        F.regexp_extract("value", pattern, 1).cast("bigint").alias("node"),
        F.regexp_extract("value", pattern, 2).cast("double").alias("rank"),
    )
