"""Mixing sources to target weights: packed blocks, multinomial source counts per output shard, index permutations.

The words of a source, its documents in order of doc_id, are one stream that is packed into blocks of a fixed number of
words. An output of as many blocks as the targets ask for is dealt to shards: each source's blocks fall to the shards
multinomially, by halving the range of shards with binomial draws, so that a task finds its own shard's counts without a
table of all shards, and the totals are exact. A source's k-th slot takes the block that a keyed permutation of the block
indices has at k, beginning anew after each round through the source; blocks and documents then meet by index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphforge.llm.common import Words, Workspace, column, map_batches, mix
from glyphforge.operators.columns import ordinals

BLOCK = 64
#: Blocks of an output shard, on average.
SHARD = 1 << 14
#: Sources whose plan, a few numbers for each, the driver holds and every task gets; more are planned in tables, in lots of this many.
MOST_SOURCES = 100_000
#: Shards of a lot that one task draws, one after the other.
TOGETHER = 64
MOST_ROUNDS = 3


def targets(sizes: list[int], weights: list[float], most: float = MOST_ROUNDS) -> list[float]:
    """Shares of sum(sizes) by weight, none above `most` times its size; what is above goes to the others by weight."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        scale = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / scale > most * sizes[i]}
        for i in over or free:
            out[i] = float(most * sizes[i]) if over else left * weights[i] / scale
        free = free - over if over else set()
    return out


def shard_counts(totals: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source in a shard, and in all shards before it."""
    lo, hi, here, before = 0, shards, totals.astype(np.int64), np.zeros(len(totals), np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = np.random.default_rng([seed, lo, hi]).binomial(here, (mid - lo) / (hi - lo))
        if shard < mid:
            hi, here = mid, left
        else:
            lo, here, before = mid, here - left, before + left
    return here, before


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(n), at `index`: a keyed Feistel network over the next power of 4, walked along its cycle."""
    half = max(1, math.ceil(math.log2(max(n, 2)) / 2))
    low = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & low
        for r in range(4):
            turn = np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
            left, right = right, left ^ (mix(right + turn) & low)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= n
    return out.astype(np.int64)


def slots_of(size: list[int], goal: list[float], block: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source, and how many slots of the output it fills."""
    blocks = np.array([-(-s // block) for s in size], np.int64)
    # A source's last block may be short, so slots are counted in its average block.
    return blocks, np.array([min(round(t * n / s), MOST_ROUNDS * n) if s else 0 for t, n, s in zip(goal, blocks.tolist(), size, strict=True)], np.int64)


_COPIES = pa.schema({"src": pa.int32(), "block": pa.int64(), "copies": pa.int64()})


def _drawn(blocks: np.ndarray, slots: np.ndarray, shards: int, shard: int, seed: int, first: int) -> pa.RecordBatch:
    """src, block and copies that a shard takes of the sources from number `first` on."""
    many, before = shard_counts(slots, shards, shard, seed)
    out = [[], [], []]
    for s in np.flatnonzero(many):
        k = int(before[s]) + np.arange(int(many[s]))
        index, n = np.unique(permuted(k % blocks[s], int(blocks[s]), seed + int(s)), return_counts=True)
        for o, v in zip(out, (np.full(len(index), first + s), index, n), strict=True):
            o.append(v)
    return pa.record_batch([pa.array(np.concatenate(o) if o else np.zeros(0, np.int64), f.type) for o, f in zip(out, _COPIES, strict=True)], schema=_COPIES)


class Mix:
    """The plan of a mix and its tables.

    docs: doc_id, text, source; other columns are not looked at. A null text has size 0 and is never taken; a null source is a
    source of its own, last in order; a null doc_id comes first in its source; rows that repeat a doc_id are separate
    documents. An empty table gives empty tables.

    placed: doc_id, print (of source and text), src, size, start (words of the source before the document)
    copies: src, block, copies (how often the mix takes a block)
    plan: src, source, source_size, target
    """

    def __init__(self, docs: DataFrame, block: int = BLOCK, seed: int = 20, cycle: tuple[int, ...] = (1, 2, 3)):
        spark = docs.sparkSession
        self.work, self.block = Workspace(spark, "mix"), block
        docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"), _print().alias("print"))

        def count(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = np.diff(Words(column(batch, "text")).first)
            return pa.record_batch({"doc_id": column(batch, "doc_id"), "print": column(batch, "print"), "source": column(batch, "source"), "size": pa.array(n, pa.int64())})

        sizes = self.work.write(map_batches(docs, count, "doc_id long, print long, source string, size long", text="text"), "sizes")
        totals = self.work.write(sizes.groupBy("source").agg(F.sum("size").alias("size")), "totals")
        few = totals.limit(MOST_SOURCES + 1).collect()
        if len(few) <= MOST_SOURCES:
            few = sorted(few, key=lambda r: (r.source is None, r.source or ""))
            size = [r["size"] for r in few]
            goal = targets(size, [cycle[i % len(cycle)] for i in range(len(size))])
            rows = [(i, r.source, s, t) for i, (r, s, t) in enumerate(zip(few, size, goal, strict=True))]
            self.plan = spark.createDataFrame(rows, "src int, source string, source_size long, target double")
            self._hinted = F.broadcast  # MOST_SOURCES rows at most
            copies = self._copies(spark, slots_of(size, goal, block), seed)
        else:
            self._hinted = lambda df: df
            self.plan = self.work.write(self._plan_many(totals, cycle), "plan")
            copies = self._copies_many(seed)
        self.placed = self.work.write(self._place(sizes), "placed")
        self.copies = self.work.write(copies, "copies")

    def _plan_many(self, totals: DataFrame, cycle: tuple[int, ...]) -> DataFrame:
        """The plan as a table. The sources at their most are those with left * weight / scale above it, for the left and the scale of
        the others; each round finds more of them, as `targets` does."""
        numbered = ordinals(totals.withColumn("none", F.col("source").isNull()), ["none", "source"], "src").withColumn("src", F.col("src").cast("int"))
        weight = F.element_at(F.array(*map(F.lit, cycle)), F.col("src") % len(cycle) + 1)
        rows = self.work.write(numbered.select("src", "source", F.col("size").alias("source_size"), weight.alias("weight")), "numbered")
        most = MOST_ROUNDS * F.col("source_size")
        total, scale, many = rows.agg(F.sum("source_size"), F.sum("weight"), F.lit(-1)).first()
        left = float(total)
        while True:
            share = left * F.col("weight") / scale if scale else F.lit(0.0)
            over = share > most
            full, rest, n = rows.agg(F.coalesce(F.sum(F.when(over, most)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)), F.count_if(over)).first()
            if n == many or not rest:
                break
            left, scale, many = float(total) - full, rest, n
        return rows.select("src", "source", "source_size", F.when(over, most.cast("double")).otherwise(share).alias("target"))

    def _copies_many(self, seed: int) -> DataFrame:
        """Copies where the sources are too many for one plan: each lot of them fills shards of its own."""

        block = self.block

        def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = zip(column(batch, "sizes").to_pylist(), column(batch, "goals").to_pylist(), strict=True)
            return pa.record_batch({"first": column(batch, "first"), "shards": pa.array([max(1, -(-int(slots_of(size, goal, block)[1].sum()) // SHARD)) for size, goal in rows], pa.int64())})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    r = batch.slice(k, 1).to_pylist()[0]
                    blocks, slots = slots_of(r["sizes"], r["goals"], block)
                    for shard in range(r["begin"], min(r["begin"] + TOGETHER, r["shards"])):  # one shard is held at a time
                        yield _drawn(blocks, slots, r["shards"], shard, seed + r["first"], r["first"])

        lot = F.floor(F.col("src") / MOST_SOURCES).alias("lot")
        lots = self.plan.groupBy(lot).agg(F.sort_array(F.collect_list(F.struct("src", "source_size", "target"))).alias("s"))  # MOST_SOURCES at most
        lots = self.work.write(lots.select(F.col("s.source_size").alias("sizes"), F.col("s.target").alias("goals"), (F.col("lot") * MOST_SOURCES).cast("long").alias("first")), "lots")
        shards = map_batches(lots, counted, "first long, shards long")
        begun = shards.select("first", "shards", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1, F.lit(TOGETHER).cast("long"))).alias("begin"))
        drawn = begun.join(lots, "first").repartition("first", "begin").mapInArrow(run, "src int, block long, copies long")
        return drawn.groupBy("src", "block").agg(F.sum("copies").alias("copies"))

    def _place(self, sizes: DataFrame) -> DataFrame:
        """Prefix sums in order of (source, doc_id): within ranges by a window, across ranges by the ranges' sums."""
        named = sizes.join(self._hinted(self.plan.select("src", F.col("source").alias("name"))), F.col("source").eqNullSafe(F.col("name")))
        ranged = named.select("doc_id", "print", "src", "size").repartitionByRange("src", "doc_id", "size", "print").withColumn("part", F.spark_partition_id())
        ranged = self.work.write(ranged, "ranged")
        sums = ranged.groupBy("src", "part").agg(F.sum("size").alias("sum"))
        before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("src", "part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base"))
        own = Window.partitionBy("src", "part").orderBy("doc_id", "size", "print").rowsBetween(Window.unboundedPreceding, -1)
        inner = ranged.select("doc_id", "print", "src", "part", "size", F.coalesce(F.sum("size").over(own), F.lit(0)).alias("inner"))
        return inner.join(sums, ["src", "part"]).select("doc_id", "print", "src", "size", (F.col("base") + F.col("inner")).alias("start"))

    def _copies(self, spark: SparkSession, plan: tuple[np.ndarray, np.ndarray], seed: int) -> DataFrame:
        blocks, slots = plan
        shards = max(1, -(-int(slots.sum()) // SHARD))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for shard in batch.column(0).to_pylist():
                    yield _drawn(blocks, slots, shards, shard, seed, 0)

        drawn = spark.range(0, shards, 1, min(shards, 10_000)).mapInArrow(run, "src int, block long, copies long")
        return drawn.groupBy("src", "block").agg(F.sum("copies").alias("copies"))

    def pieces(self) -> DataFrame:
        """src, start, doc_id, print, size, block, words (of the document in that block), copies: documents and blocks that meet."""
        ends = F.col("start") + F.col("size")
        spread = self.placed.where("size > 0").withColumn("block", F.explode(F.sequence(_whole(F.col("start"), self.block), _whole(ends - 1, self.block))))
        words = F.least(ends, (F.col("block") + 1) * self.block) - F.greatest("start", F.col("block") * self.block)
        return spread.withColumn("words", words).join(self.copies, ["src", "block"], "left").withColumn("copies", F.coalesce("copies", F.lit(0)))

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target (of the document's source), taken (words, repeats counted), a row for each input row."""
        sums = self.pieces().groupBy("src", "start", "doc_id", "size").agg(F.sum(F.col("words") * F.col("copies")).alias("taken")).select("doc_id", "src", "size", "taken")
        both = sums.union(self.placed.where("size = 0").select("doc_id", "src", "size", F.lit(0).cast("long")))
        return both.join(self._hinted(self.plan), "src").select("doc_id", "size", "source_size", "target", "taken")

    def texts(self, docs: DataFrame) -> DataFrame:
        """The documents that the mix takes, all their columns: text holds the words taken, each further round on new lines.

        A run of blocks is cut out of the text as it stands, so a document taken whole and once stays as it is. n_chars, if
        there, follows the text. Each row gets its own blocks, be its doc_id null or repeated: rows meet their places by doc_id,
        source and text, and rows that agree in all of these take their places in turn.
        """
        block = self.block
        same = Window.partitionBy("__none", "__id", "__print")
        placed = self.placed.where("size > 0").withColumn("__none", F.col("doc_id").isNull()).withColumn("__id", F.coalesce("doc_id", F.lit(0))).withColumnRenamed("print", "__print")
        turns = placed.select("__none", "__id", "__print", "src", F.col("start").alias("__start"), F.row_number().over(same.orderBy("start")).alias("__turn"))
        used = self.pieces().where("copies > 0").groupBy("src", F.col("start").alias("__start")).agg(F.sort_array(F.collect_list(F.struct("block", F.col("copies").cast("int").alias("copies")))).alias("b"))
        used = used.join(turns, ["src", "__start"]).select("__none", "__id", "__print", "__turn", "__start", F.col("b.block").alias("__blocks"), F.col("b.copies").alias("__copies"))
        own = docs.withColumn("__none", docs["doc_id"].isNull()).withColumn("__id", F.coalesce(docs["doc_id"].cast("long"), F.lit(0))).withColumn("__print", _print())
        own = own.withColumn("__turn", F.row_number().over(same.orderBy(F.lit(0))))
        names = docs.columns

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = column(batch, "text")
            w = Words(texts)
            new = []
            for r, (start, index, copies) in enumerate(zip(*(column(batch, c).to_pylist() for c in ("__start", "__blocks", "__copies")), strict=True)):
                a, n = int(w.first[r]), int(w.first[r + 1] - w.first[r])
                out = []
                for turn in range(1, max(copies) + 1):
                    runs: list[list[int]] = []
                    for i in (i for i, c in zip(index, copies, strict=True) if c >= turn):
                        lo, hi = max(0, i * block - start), min(n, (i + 1) * block - start)
                        if runs and runs[-1][1] == lo:
                            runs[-1][1] = hi
                        else:
                            runs.append([lo, hi])
                    for lo, hi in runs:
                        from_, to = (w.at[r] if lo == 0 else w.starts[a + lo]), (w.at[r + 1] if hi == n else w.ends[a + hi - 1])
                        out.append(w.raw[from_:to].tobytes())
                new.append(b"\n".join(out).decode())
            found = dict(zip(batch.schema.names, batch.columns, strict=True))
            found["text"] = pa.array(new, texts.type)
            if "n_chars" in found:
                found["n_chars"] = pa.array([len(t) for t in new], found["n_chars"].type)
            return pa.record_batch({c: found[c] for c in names})

        return map_batches(own.join(used, ["__none", "__id", "__print", "__turn"]), run, docs.schema, text="text")


def _print() -> Column:
    """A fingerprint of a row's source and text, by which rows of one doc_id are told apart."""
    return F.xxhash64(F.col("source").isNull(), F.col("source").cast("string"), F.col("text").cast("string"))


def _whole(c: Column, n: int) -> Column:
    return F.floor(c / n) if n & (n - 1) else F.shiftright(c, n.bit_length() - 1)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with source weights 1, 2, 3 in turn."""
    return Mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).taken()
