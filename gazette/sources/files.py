"""Readers of crawled pages, feeds and API bodies: one row ``(path, body)`` a
document; ``url`` comes from a caller rule over the path (crawl dumps usually
encode it) or is the path itself."""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F


def read_documents(spark: SparkSession, documents: str | DataFrame) -> DataFrame:
    """One row per document that holds anything: ``path``, ``body``. Given as a
    folder (a document a file, read whole) or as a table of path and body, which
    is what large crawls are kept in: Spark's driver lists every file of a
    folder, and a table is some large files."""
    if isinstance(documents, DataFrame):
        return documents.select("path", "body").where(F.length("body") > 0)
    df = spark.read.text(documents, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def empty_documents(spark: SparkSession, documents: str | DataFrame) -> DataFrame:
    """``path`` of the documents without content. Spark reads no file of no
    length; a task lists the folders for them, one at a time, and names only
    these."""
    if isinstance(documents, DataFrame):
        return documents.where(F.coalesce(F.length("body"), F.lit(0)) == 0).select("path")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                yield from (pa.RecordBatch.from_pydict({"path": pa.array(found, pa.string())}) for found in empty_files(x))

    return spark.createDataFrame([(x,) for x in alternatives(documents)], "path string").mapInArrow(listed, "path string")


def alternatives(pattern: str) -> list:
    """The globs that one with {a,b} stands for."""
    m = re.match(r"(.*?)\{([^{}]*)\}(.*)", pattern)
    return [y for x in m[2].split(",") for y in alternatives(m[1] + x + m[3])] if m else [pattern]


def empty_files(pattern: str) -> Iterator[list]:
    """Files of no length that a path, folder or glob names, a folder at a time,
    as Spark writes their paths."""
    fs, place = file_system(pattern)
    parts = place.split("/")
    fixed = next((i for i, x in enumerate(parts) if any(c in x for c in "*?[")), len(parts) - 1)
    scheme = pattern[:len(pattern) - len(place)] if "://" in pattern else "file://"
    folders = ["/".join(parts[:fixed]) or "/"]
    while folders:
        info = fs.get_file_info(pafs.FileSelector(folders.pop(), allow_not_found=True))
        found = []
        for f in info:
            own = f.path.split("/")
            if f.base_name[:1] in "_.":
                continue
            if f.type == pafs.FileType.Directory and len(own) <= len(parts) and fits(own, parts[:len(own)]):
                folders.append(f.path)
            elif f.type == pafs.FileType.File and f.size == 0 and (fits(own, parts) or fits(own[:-1], parts)):
                found.append(scheme + quote(f.path))
        yield found


def fits(own: list, parts: list) -> bool:
    return len(own) == len(parts) and all(fnmatch.fnmatchcase(x, p) for x, p in zip(own, parts))


def file_system(path: str) -> tuple:
    """The file system of a path, for tasks, and the path there."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return (pafs.LocalFileSystem(), path) if "://" not in path else pafs.FileSystem.from_uri(path)


def with_key(df: DataFrame, sequence=None) -> DataFrame:
    """The key that ordering rules go by: ``sequence(path)`` if the caller knows
    the order in which files were crawled, else the path itself. Paths are
    unlike, so no two files tie."""
    key = F.col("path") if sequence is None else sequence(F.col("path"))
    return df.withColumn("doc_key", key.cast("string"))
