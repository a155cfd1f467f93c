"""Intermediate tables of operators that must see the same rows twice, in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder in local mode if that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if sc.applicationId not in _OWN_DIRS:
        _OWN_DIRS[sc.applicationId] = "file://" + tempfile.mkdtemp(prefix="glyphforge-")
    return _OWN_DIRS[sc.applicationId]


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    out = os.path.join(tempfile.mkdtemp(prefix="glyphforge-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def mounted(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it; None if it lies in another store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(p).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def _delete_tree(folder: str) -> None:
    """Entries go as they are read: the names of a folder are never held together, as Hadoop and shutil hold them."""
    with os.scandir(folder) as found:
        for e in found:
            if e.is_dir(follow_symlinks=False):
                _delete_tree(e.path)
            else:
                os.remove(e.path)
    os.rmdir(folder)


def delete_later(spark: SparkSession, path: str) -> None:
    """The folder goes when the driver ends."""
    local = mounted(spark, path)

    def drop() -> None:
        try:
            if local is not None and os.path.isdir(local):
                _delete_tree(local)
                return
        except OSError:  # what is left is for the JVM
            pass
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)
        except Exception:  # the JVM may be gone already; the folder is then left to the shared folder's own cleaning
            pass

    atexit.register(drop)


def written(df: DataFrame, name: str = "table", by: tuple[str, ...] = ()) -> DataFrame:
    """df, written as Parquet and read back: every reader sees the same rows, and a lost executor loses none. Gone when the driver ends.

    With `by`, rows of equal values there are in folders of their own, so that readers of some values pass the others over.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/glyphforge-{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    delete_later(spark, path)
    return spark.read.schema(df.schema).parquet(path).select(*(F.col(f"`{c}`") for c in df.columns))
