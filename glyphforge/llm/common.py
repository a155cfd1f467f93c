"""Shared parts of the training-data operators: the work folder, Arrow batches, words and their hashes.

Words are runs of bytes other than 0x20 and 0x09-0x0D; every delimiter is ASCII, so the work is done on UTF-8
bytes without decoding. All functions here are vectorised over a whole Arrow batch.
"""

from __future__ import annotations

import atexit
import ctypes
import hashlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step takes at most (a single longer text makes a step of its own).
STEP_BYTES = 1 << 20
#: Bytes in one Arrow batch between the JVM and Python.
BATCH_BYTES = 8 << 20
#: Words longer than this are hashed one by one.
LONG_WORD = 64

#: Spark then removes a plan's shuffle files when it has run.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key of at least a HOT-th of all rows, and of MANY at least, is looked up in a broadcast table, which so has at most HOT rows.
HOT, MANY = 1000, 1000

_OWN_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one in local mode if unset."""
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
    """Send this package to the executors once, and keep Arrow batches of long texts small."""
    sc = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    out = os.path.join(tempfile.mkdtemp(prefix="glyphforge-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


class Workspace:
    """Tables that cut lineage: written as Parquet to the shared folder and read back, so that a lost executor loses nothing.

    They go when dropped, or else when the driver ends. The shuffle files of a table's plan go as soon as it is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark, self.path = spark, f"{shared_dir(spark)}/glyphforge-{name}-{uuid.uuid4().hex}"
        atexit.register(self._quietly_drop)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        conf, before = self.spark.conf, self.spark.conf.get(_CLEANUP, None)
        conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if before is None:
                conf.unset(_CLEANUP)
            else:
                conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for path in [f"{self.path}/{n}" for n in names] or [self.path]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)

    def _quietly_drop(self) -> None:
        try:
            self.drop()
        except Exception:  # the JVM may be gone already; the folder is then left to the shared folder's own cleaning
            pass


def lookup(work: Workspace, rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """rows joined with table by `key`, which is unique in table and never null in rows.

    Rows of hot keys (see HOT) meet a broadcast of these keys' entries and are not shuffled; all others are joined by a shuffle,
    in which no key then has more than a HOT-th of the rows.
    """
    total = rows.count()
    top = rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(HOT).collect() if total >= MANY else []  # HOT rows
    found = [(r[key],) for r in top if r.n >= MANY and r.n * HOT >= total]
    if not found:
        return rows.join(table, key, how)
    often = F.broadcast(work.spark.createDataFrame(found, rows.select(key).schema))
    hot = F.broadcast(table.join(often, key, "left_semi"))
    near = rows.join(often, key, "left_semi").join(hot, key, how)
    return near.unionByName(rows.join(often, key, "left_anti").join(table, key, how))


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, text: str | None = None) -> DataFrame:
    """mapInArrow of a function on batches; with `text`, batches are cut so that this column has at most STEP_BYTES in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, text) if text else [batch]:
                out = f(part)
                if out is not None and out.num_rows:
                    yield from out.to_batches(max_chunksize=1 << 16) if isinstance(out, pa.Table) else [out]
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps its Python workers, and with them all that they hold."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def cut(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(np.diff(offsets(batch.column(batch.schema.get_field_index(text)))))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + STEP_BYTES, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def offsets(a: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type) else np.int32
    if len(a) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(a.buffers()[1], kind, len(a) + 1, a.offset * np.dtype(kind).itemsize).astype(np.int64)


def text_bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and the n+1 offsets of its rows in them; null is empty."""
    if a.null_count:
        a = a.fill_null("")
    at = offsets(a)
    data = a.buffers()[2] if len(a) else None
    whole = np.frombuffer(data, np.uint8) if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of a batch of texts: starts and ends in `data`, and first[r]:first[r + 1] those of row r."""

    def __init__(self, column: pa.Array, lower: bool = False):
        data, at = text_bytes(column)
        self.raw, self.data, self.at = data, LOWER[data] if lower else data, at
        solid = ~SPACE[data]
        cutat = np.zeros(len(data) + 1, bool)
        cutat[at] = True
        left, right = np.empty_like(solid), np.empty_like(solid)
        if len(data):
            left[0], right[-1] = True, True
            left[1:] = ~solid[:-1] | cutat[1:-1]
            right[:-1] = ~solid[1:] | cutat[1:-1]
        self.starts = np.flatnonzero(solid & left)
        self.ends = np.flatnonzero(solid & right) + 1
        self.first = np.searchsorted(self.starts, at)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, those of different seeds independent."""
        start = np.uint64(seed * 0xA0761D6478BD642F & (2**64 - 1))
        lens = self.ends - self.starts
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        lanes = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        keep = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
        h = mix(lanes[self.starts] & keep[np.minimum(lens, 8)] ^ lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ start)
        todo = np.flatnonzero((lens > 8) & (lens <= LONG_WORD))
        at = 8
        while len(todo):
            h[todo] = mix(h[todo] * np.uint64(0xD6E8FEB86659FD93) + (lanes[self.starts[todo] + at] & keep[np.minimum(lens[todo] - at, 8)]))
            at += 8
            todo = todo[lens[todo] > at]
        for i in np.flatnonzero(lens > LONG_WORD):
            h[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]].tobytes(), seed)
        return h


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xE9846AF9B1A615D5)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(28)
    return x


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of words[i:i + k] for every i from which k words remain, rows not regarded."""
    n = max(0, len(words) - k + 1)
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(0xC2B2AE3D27D4EB4F) + words[j : j + n])
    return h


def digest(a: np.ndarray) -> bytes:
    return hashlib.blake2b(a.tobytes(), digest_size=16).digest()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
