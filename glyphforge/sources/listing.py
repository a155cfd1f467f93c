"""Files below a folder (S7), listed by tasks: names go from a task to a table and never through the driver."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.sources.scratch import delete_later, mounted, shared_dir

#: Names in a batch.
BATCH_ROWS = 10_000
_FOUND = "value string, folder binary"


def files_below(spark: SparkSession, root: str) -> DataFrame:
    """`value`, paths of all files below the folder root, relative to it: hidden and empty ones too; links to folders are not followed.

    A round lists the folders of a level, each by one task, which streams its entries; a tree takes a round for each level. Folders
    are kept as bytes, so that those whose names are no UTF-8 are found again. Stores other than a mounted file system are listed by
    Spark's binary source, thus on the driver.
    """
    local = mounted(spark, root)
    if local is None:
        return _listed_by_source(spark, root)
    top, rows = os.fsencode(local), BATCH_ROWS

    def batch_of(values: list[str | None], folders: list[bytes | None]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(values, pa.string()), pa.array(folders, pa.binary())], ["value", "folder"])

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values: list[str | None] = []
        folders: list[bytes | None] = []
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                with os.scandir(os.path.join(top, folder)) as found:
                    for e in found:
                        name = os.path.join(folder, e.name)
                        inner = e.is_dir(follow_symlinks=False)
                        if not inner and e.is_symlink() and e.is_dir():
                            continue
                        values.append(None if inner else name.decode("utf-8", "replace"))
                        folders.append(name if inner else None)
                        if len(values) == rows:
                            yield batch_of(values, folders)
                            values, folders = [], []
        if values:
            yield batch_of(values, folders)

    table = f"{shared_dir(spark)}/glyphforge-listing-{uuid.uuid4().hex}"
    delete_later(spark, table)
    cores = max(1, spark.sparkContext.defaultParallelism)
    folders, level = spark.createDataFrame([(b"",)], "folder binary"), 0
    while level == 0 or not folders.isEmpty():
        at = f"{table}/{level}"
        folders.repartition(cores, "folder").mapInArrow(entries, _FOUND).write.parquet(at)
        folders, level = spark.read.schema(_FOUND).parquet(at).where("folder is not null").select("folder"), level + 1
    return spark.read.schema(_FOUND).option("recursiveFileLookup", True).parquet(table).where("value is not null").select("value")


def _listed_by_source(spark: SparkSession, root: str) -> DataFrame:
    """The binary source lists files; their contents are pruned and never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    base = root.split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    p = F.regexp_replace(F.regexp_replace("path", "^[a-z0-9]+:/+", "/"), "%20", " ")
    rel = F.when(p.startswith(base), F.substring(p, F.lit(len(base) + 1), F.length(p))).otherwise(p)
    return found.select(rel.alias("value")).distinct()
