"""One large CSV file read by many tasks (S1), though a row may go on over lines, ranges and tasks.

Spark's text source cuts files at line ends, whether or not these stand inside quotes. What a line does to the place where
it ends is one of four functions of the place where it starts (in a quoted cell or not): it keeps it, turns it, or ends
inside or outside in any case. So each range composes its lines' functions without knowing where it starts itself, a scan
over ranges (a row each) tells where they do, and a second pass joins lines to rows. Pieces of rows that lie in several
ranges, at most two a range, are put together by a shuffle of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphforge.sources.scratch import ship, written

#: Bytes of a range.
RANGE_BYTES = 64 << 20
#: Ranges that start inside quotes whose names are broadcast at most (some 200 bytes each); beyond, lines are shuffled by range.
MOST_BROADCAST = 100_000

#: What may follow in a quoted cell; what may follow its closing quote; cells that are closed, each up to its comma.
_MORE, _AFTER = '(?:[^"]|"")*', '(?:[^",][^,]*)?,'
_CLOSED = f'(?:"{_MORE}"{_AFTER}|[^",][^,]*,|,)*'
_OPENS = f'^{_CLOSED}"{_MORE}$'
_STAYS = f'^{_MORE}(?:$|"{_AFTER}{_CLOSED}"{_MORE}$)'


def lines_of(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """value, file, start: the lines of the files, and the range of exactly range_bytes that each begins in.

    Where files are cut follows a session's settings, so they are read in a session of their own; a view brings them back. One
    partition at least, so that the number of cores has no say; small files share a task.
    """
    own = spark.newSession()
    for name, value in (("maxPartitionBytes", range_bytes), ("openCostInBytes", min(range_bytes, 4 << 20)), ("minPartitionNum", 1)):
        own.conf.set(f"spark.sql.files.{name}", str(value))
    at = F.col("_metadata")
    lines = own.read.option("lineSep", "\n").text(path).select("value", at.file_path.alias("file"), at.file_block_start.alias("start"))
    view = f"csv_lines_{uuid.uuid4().hex}"
    lines.createGlobalTempView(view)
    try:
        return spark.table(f"global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)


def effects(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line, whether it ends inside quotes if it starts outside, and if it starts inside."""
    opens, stays = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    at = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(at):
        some = lines.take(pa.array(at))
        opens[at] = pc.match_substring_regex(some, _OPENS).to_numpy(zero_copy_only=False)
        stays[at] = pc.match_substring_regex(some, _STAYS).to_numpy(zero_copy_only=False)
    return opens, stays


def inside(opens: np.ndarray, stays: np.ndarray, first: bool) -> np.ndarray:
    """Whether each line, and what would follow the last, starts inside quotes, if the first does so as told."""
    turns = np.concatenate([[0], np.cumsum(opens & ~stays)])
    settled = np.flatnonzero(opens == stays)
    last = np.searchsorted(settled, np.arange(len(opens) + 1)) - 1  # the last line before with one end in any case
    base = np.full(len(turns), bool(first))
    since = turns.copy()
    known = last >= 0
    base[known] = opens[settled[last[known]]]
    since[known] -= turns[settled[last[known]] + 1]
    return base ^ (since % 2 == 1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Pieces of batches of one range each; True with the first of a range."""
    at = None
    for batch in batches:
        file, start = batch.column("file"), batch.column("start").to_numpy()
        key = file.dictionary_encode().indices.to_numpy() if len(file) else np.zeros(0, int)
        edges = np.flatnonzero((key[1:] != key[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *edges], [*edges, len(key)], strict=True):
            if b > a:
                here = (file[a].as_py(), int(start[a]))
                yield here != at, batch.slice(a, b - a)
                at = here


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, start, opens, stays of each range that has quotes."""
    at, ends = None, (False, True)

    def told() -> pa.RecordBatch:
        return pa.record_batch({"file": pa.array([at[0]], pa.string()), "start": pa.array([at[1]], pa.int64()), "opens": pa.array([ends[0]]), "stays": pa.array([ends[1]])})

    for new, piece in _runs(batches):
        if new:
            if at is not None:
                yield told()
            at, ends = (piece.column("file")[0].as_py(), piece.column("start")[0].as_py()), (False, True)
        both = effects(piece.column("value"))
        ends = tuple(bool(inside(*both, e)[-1]) for e in ends)
    if at is not None:
        yield told()


WHOLE, HEAD, TAIL = 0, 1, 2


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, start, row (within its range, -1 for what belongs to a row begun before), kind and text of each row or piece."""
    at, row, held, kind, within = None, 0, None, WHOLE, False

    def made(rows: list | np.ndarray, kinds: list | np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        n = len(texts)
        return pa.record_batch({"file": pa.array([at[0]] * n, pa.string()), "start": pa.array(np.full(n, at[1], np.int64)), "row": pa.array(rows, pa.int64()), "kind": pa.array(kinds, pa.int32()), "text": texts})

    def rest(kind: int) -> pa.RecordBatch:
        return made([-1 if kind == HEAD else row - 1], [kind], pa.array(["\n".join(held)], pa.string()))

    for new, piece in _runs(batches):
        value = piece.column("value").cast(pa.string())
        if new:
            if held is not None:
                yield rest(kind if kind == HEAD else TAIL)
            at, row = (piece.column("file")[0].as_py(), piece.column("start")[0].as_py()), 0
            within = bool(piece.column("inside")[0].as_py())
            held, kind = ([], HEAD) if within else (None, WHOLE)
        state = inside(*effects(value), within)
        within = bool(state[-1])
        begins = np.flatnonzero(~state[:-1])
        if held is not None:  # a row that this piece goes on with
            held += value.slice(0, begins[0] if len(begins) else len(value)).to_pylist()
            if len(begins) or not within:
                yield rest(kind)
                held, kind = None, WHOLE
        if not len(begins):
            continue
        ends = np.append(begins[1:], len(value))
        whole = len(begins) - 1 if within else len(begins)
        if whole:
            bounds = np.append(begins[:whole], ends[whole - 1]) - begins[0]
            texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), value.slice(begins[0], ends[whole - 1] - begins[0])), "\n")
            yield made(np.arange(row, row + whole), np.zeros(whole, int), texts)
        row += len(begins)
        if within:
            held, kind = value.slice(begins[-1]).to_pylist(), WHOLE
    if held is not None:
        yield rest(kind if kind == HEAD else TAIL)


def starts_inside(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """file, start of the ranges that start inside quotes; ranges holds all."""
    found = lines.where(F.contains("value", F.lit('"'))).mapInArrow(_compose, "file string, start long, opens boolean, stays boolean")
    all_ = ranges.join(found, ["file", "start"], "left").select("file", "start", F.coalesce("opens", F.lit(False)).alias("opens"), F.coalesce("stays", F.lit(True)).alias("stays"))
    by_file = Window.partitionBy("file").orderBy("start")  # a row for each range
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    turns = F.sum((F.col("opens") & ~F.col("stays")).cast("int"))
    odd = lambda c: F.coalesce(c, F.lit(0)) % 2 == 1
    # The end of a range that settles it, as if turned by all ranges up to it; all turns before a range turn it back.
    settled = all_.withColumn("end", F.when(F.col("opens") == F.col("stays"), F.col("opens") != odd(turns.over(by_file))))
    at = F.coalesce(F.last("end", ignorenulls=True).over(before), F.lit(False)) != odd(turns.over(before))
    return settled.withColumn("inside", at).where("inside").select("file", "start")


def rows_of(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """file, start, row, text: each row of the files as it stands (without its last line end), header included.

    Its place is (file, start + row), as a range has no more rows than bytes. Rows end with LF or CRLF; a quote opens a cell only as its first character, and a quoted
    cell goes on to its closing quote. Runs one pass over the lines with quotes at once.
    """
    ship(spark)
    lines = lines_of(spark, path, range_bytes)
    files = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file"), "length")  # lists, reads nothing
    if (files.agg(F.max("length")).collect()[0][0] or 0) > range_bytes:
        starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
        begun = written(starts_inside(lines, files.select("file", F.explode(starts).alias("start"))), "ranges")
        n = begun.count()
    else:
        n = 0
    if n == 0:
        return lines.withColumn("inside", F.lit(False)).mapInArrow(_rows, "file string, start long, row long, kind int, text string").drop("kind")
    begun = begun.withColumn("inside", F.lit(True))
    if n <= most_broadcast:
        told = lines.join(F.broadcast(begun), ["file", "start"], "left")
    else:
        placed = lines.withColumn("id", F.monotonically_increasing_id())
        told = placed.join(begun, ["file", "start"], "left").repartition("file", "start").sortWithinPartitions("file", "start", "id")
    told = told.select("value", "file", "start", F.coalesce("inside", F.lit(False)).alias("inside"))
    out = told.mapInArrow(_rows, "file string, start long, row long, kind int, text string")
    order = Window.partitionBy("file").orderBy("start", "kind")  # two pieces a range at most
    pieces = out.where(F.col("kind") != WHOLE).withColumn("of", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("start", "kind", "text"))), lambda p: p.text)
    first = F.min_by(F.struct("start", "row"), F.struct("start", "kind"))
    joined = pieces.groupBy("file", "of").agg(first.alias("first"), F.array_join(texts, "\n").alias("text"))
    return out.where(F.col("kind") == WHOLE).drop("kind").unionByName(joined.select("file", "first.start", "first.row", "text"))
