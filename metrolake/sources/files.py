"""File discovery, hashing and per-format dispatch.

A *listing* is a DataFrame ``path, modificationTime, length`` as given by
Spark's ``binaryFile`` source (batch or streaming). Listing only the
metadata columns does not read file contents; hashing reads each file once
(``sha2`` over the ``content`` column, equal to hashlib's SHA-256).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SUPPORTED_SUFFIXES


#: The ``binaryFile`` source and the whole-document readers read no file of this size or more.
MAX_BYTES = (1 << 31) - 1
#: Formats that are read a document at a time, not in splits.
WHOLE_FORMATS = ("json", "excel")
#: Larger files are hashed in chunks of this size.
CHUNK = 8 << 20


def literal_path(path: str) -> str:
    """``path`` for a reader that would take brackets, braces, ``*`` and ``?`` as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def plain_path(c: Column) -> Column:
    """A scan's file path (a URI with escapes) as listings spell it."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def suffix_of(path: Column | str) -> Column:
    """Lower-case suffix including the dot (``.csv``), or '' when none."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.regexp_extract(p, r"([^/]*)$", 1)
    return F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))


def file_name(path: Column | str) -> Column:
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]*)$", 1)


def format_of(path: Column | str) -> Column:
    """Format name for supported suffixes, null otherwise."""
    sfx = suffix_of(path)
    out = F.lit(None).cast("string")
    for s, fmt in SUPPORTED_SUFFIXES.items():
        out = F.when(sfx == s, F.lit(fmt)).otherwise(out)
    return out


def unsupported_message(path: Column | str) -> Column:
    supported = ", ".join(f"'{s}'" for s in sorted(SUPPORTED_SUFFIXES))
    return F.format_string(f"Unsupported file extension '%s'. Supported: [{supported}]", suffix_of(path))


def list_files(spark: SparkSession, location: str, recursive: bool = False) -> DataFrame:
    """The files under a folder ``location`` (or the one file it names)
    with their mtime and size. Only metadata is read; order by
    ``modificationTime`` for oldest first."""
    reader = spark.read.format("binaryFile")
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(location).select("path", "modificationTime", "length")
    return describe_listing(df)


def describe_listing(listing: DataFrame) -> DataFrame:
    """Add file name, suffix and format to a listing."""
    return listing.select(
        "path", "modificationTime", "length",
        file_name("path").alias("file_name"), suffix_of("path").alias("suffix"),
        format_of("path").alias("format"))


def content_hash(content: Column) -> Column:
    """SHA-256 (hex) of a file's bytes."""
    return F.sha2(content, 256)


def _open(path: str):
    """A byte stream of a file by URI or plain path."""
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem().open_input_stream(path)
    if path.startswith("file:"):
        return arrow_fs.LocalFileSystem().open_input_stream(re.sub("^file:/*", "/", path))
    where, inner = arrow_fs.FileSystem.from_uri(path)
    return where.open_input_stream(inner)


def streamed_hashes(paths: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``path, file_hash`` of files of any size: a task reads its file's bytes in order, one chunk in memory."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for path in p["path"]:
                h = hashlib.sha256()
                with _open(path) as f:
                    while block := f.read(chunk):
                        h.update(block)
                yield pd.DataFrame({"path": [path], "file_hash": [h.hexdigest()]})
    # A file a task, as far as the session's partitions go.
    return paths.select("path").repartition("path").mapInPandas(run, "path string, file_hash string")


def file_hashes(spark: SparkSession, paths: list[str], large: DataFrame | None = None) -> DataFrame:
    """``path, file_hash`` (SHA-256 hex of the file bytes), one row per file.

    ``paths`` go through the ``binaryFile`` source, which takes files below
    ``MAX_BYTES``; ``large(path)`` are streamed in chunks.
    """
    out = spark.createDataFrame([], "path string, file_hash string")
    if paths:
        out = (spark.read.format("binaryFile").load([literal_path(p) for p in paths])
               .select("path", content_hash(F.col("content")).alias("file_hash")))
    return out if large is None else out.unionByName(streamed_hashes(large))
