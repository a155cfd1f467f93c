"""Embedding whitening with an exact covariance from digit-slice matrix products.

Vectors are whole numbers. They are centred on whole numbers next to their means, and split into limbs of LIMB bits, so
that products of blocks of limbs in doubles (BLAS) stay below 2 ** 53 and are exact. Products of equal weight are added up
and recombined as big integers; tasks' sums are merged row by row of the matrix, and what centring left over is taken off
in whole numbers as well. Only then is the covariance divided, and decomposed once on the driver: dim * dim numbers.
"""

from __future__ import annotations

import decimal
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Workspace, column, give_back

#: Bits of a limb (signed, so at most 2 ** (LIMB - 1) in size), and rows of a block: 2 ** (2 * LIMB - 2) * BLOCK is below 2 ** 53.
LIMB, BLOCK = 21, 2048
#: Components that are given at most.
COMPONENTS = 16
#: x = floor(SCALE * c) + SHIFT; a vector shorter than the longest counts as filled up with zeros, whose x is SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Eigenvalues below this share of the largest count as zero: doubles cannot tell them apart.
_ZERO = 1e-14
#: Bytes of a whole number on its way from a task to its merge.
_WIDTH = 48


def whole(table: DataFrame, vector: str) -> DataFrame:
    """vec_id, and x for each entry of the vector; without rows whose vector is null or holds null or a number that is not finite."""
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("e"))
    rows = rows.where("e is not null and not exists(e, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
    edge = 2.0**61  # so that differences are longs
    return rows.select("vec_id", F.transform("e", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(edge)), F.lit(-edge))) + SHIFT).alias("x"))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    """A list array as rows of int64, filled up with SHIFT."""
    at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    size = np.diff(at)
    flat = flat[at[0] : at[-1]]
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.full((len(size), dim), SHIFT, np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(at[:-1] - at[0], size)] = flat
    return out


def limbs(z: np.ndarray) -> list[np.ndarray]:
    """Signed digits of z to base 2 ** LIMB as doubles, the lowest first, none above half the base; one where z is that small."""
    out, half = [], 1 << (LIMB - 1)
    while True:
        low = ((z + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        z = (z - low) >> LIMB
        if not z.any():
            return out


class Gram:
    """Sums of products of all pairs of columns, exact."""

    def __init__(self, dim: int):
        self.sums: dict[int, np.ndarray] = {}  # by weight: a matrix of products of limbs, exact in int64
        self.total = np.zeros((dim, dim), object)
        self.blocks = 0

    def add(self, z: np.ndarray) -> None:
        for a in range(0, len(z), BLOCK):
            digits = limbs(z[a : a + BLOCK])
            for i, x in enumerate(digits):
                for j in range(i + 1):
                    p = (x.T @ digits[j]).astype(np.int64)
                    held = self.sums.setdefault(i + j, np.zeros_like(p))
                    held += p if i == j else p + p.T
            self.blocks += 1
            if self.blocks % 256 == 0:  # of 2 ** 51, by 6 pairs of limbs of one weight at most
                self.fold()

    def fold(self) -> np.ndarray:
        for weight, m in self.sums.items():
            self.total = self.total + m.astype(object) * (1 << (LIMB * weight))
        self.sums = {}
        return self.total


def packed(numbers) -> bytes:
    return b"".join(int(v).to_bytes(_WIDTH, "little", signed=True) for v in numbers)


def unpacked(data: bytes) -> list[int]:
    return [int.from_bytes(data[k : k + _WIDTH], "little", signed=True) for k in range(0, len(data), _WIDTH)]


def merged(fit: DataFrame, partial: Callable[[Iterator[np.ndarray]], Iterator[tuple[int, list]]], dim: int) -> dict[int, list[int]]:
    """Sums over all tasks, by key, of the lists of whole numbers that `partial` makes of a task's blocks of vectors.

    A key's lists meet in one task each, so `partial` is to give few: at most a list a key and task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, numbers in partial(matrix(column(b, "x"), dim) for b in batches):
            yield pa.record_batch({"key": pa.array([key], pa.int64()), "sums": pa.array([packed(numbers)], pa.binary())})
        give_back()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[int]] = {}
        for b in batches:
            for key, data in zip(column(b, "key").to_pylist(), column(b, "sums").to_pylist(), strict=True):
                new = unpacked(data)
                found[key] = [p + q for p, q in zip(found[key], new, strict=True)] if key in found else new
        yield pa.record_batch({"key": pa.array(list(found), pa.int64()), "sums": pa.array(map(packed, found.values()), pa.binary())})

    schema = "key long, sums binary"
    rows = fit.select("x").mapInArrow(run, schema).repartition("key").mapInArrow(add, schema).collect()  # a row a key: dim + 1 at most
    return {r["key"]: unpacked(r["sums"]) for r in rows}


def eigen(gram: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues falling, eigenvectors as columns, and the trace of gram / n ** 3, divided as whole numbers."""
    v = np.array([[g / n**3 for g in row] for row in gram])
    e, u = np.linalg.eigh(v)
    return e[::-1], u[:, ::-1], sum(gram[k][k] for k in range(len(gram))) / n**3


def whiten(table: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each usable vector and component.

    Vectors that are null or hold null or a number that is not finite are left out; x = floor(64 c) + 1000000, 64 c within
    2 ** 61. n counts the distinct vectors x, each of which is fitted once, whatever its copies. deviation is a decimal of 38
    digits (null beyond). Shorter vectors count as filled up with zeros. Components of an eigenvalue of zero (below 1e-14 of
    the largest; all if there is one distinct vector) have no whitened (null) and do not count for identity_error, which is 0
    where no others are. There are as many components as dimensions, at most `components`. Rows that repeat a vec_id, or have
    none, are kept; empty tables and vectors without dimensions give no rows. Other columns are not looked at.

    The driver holds dim * dim whole numbers; a task holds as many, in doubles and as big integers.
    """
    spark = table.sparkSession
    work = Workspace(spark, "whitening")
    rows = whole(table, vector)
    fit = work.write(rows.select("x").distinct(), "fit")
    sizes = fit.groupBy(F.size("x").alias("size")).count().groupBy().agg(F.max("size").alias("dim"), F.count("*").alias("kinds")).collect()[0]
    dim = sizes["dim"] or 0
    empty = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not dim:
        return spark.createDataFrame([], empty)
    if sizes["kinds"] > 1:  # vectors that differ in zeros at the end are one
        fit = fit.select(F.when(F.size("x") < dim, F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(dim) - F.size("x")))).otherwise(F.col("x")).alias("x"))
        fit = work.write(fit.distinct(), "filled")

    def totals(blocks: Iterator[np.ndarray]) -> Iterator[tuple[int, list]]:
        n, low, high = 0, np.zeros(dim, np.int64), np.zeros(dim, object)
        for x in blocks:
            for a in range(0, len(x), 1 << 16):
                part = x[a : a + (1 << 16)]
                n += len(part)
                low = (part & 0xFFFFFFFF).sum(axis=0)
                high = high + low.astype(object) + (part >> 32).sum(axis=0).astype(object) * (1 << 32)
        if n:
            yield 0, [n, *high]

    n, *total = merged(fit, totals, dim)[0]
    middle = [(2 * s + n) // (2 * n) for s in total]  # the whole numbers next to the means
    rest = [s - n * m for s, m in zip(total, middle, strict=True)]
    centre = np.array(middle, np.int64)

    def products(blocks: Iterator[np.ndarray]) -> Iterator[tuple[int, list]]:
        gram = Gram(dim)
        for x in blocks:
            gram.add(x - centre)
        if gram.blocks:
            sums = gram.fold()
            for k in range(dim):
                yield k, list(sums[k, k:])

    upper = merged(fit, products, dim)
    # With y = n x - S = n z - rest and the sum of all z being rest: sum of y y' = n (n sum of z z' - rest rest').
    full = [[n * (n * upper[min(i, j)][abs(i - j)] - rest[i] * rest[j]) for j in range(dim)] for i in range(dim)]
    e, u, trace = eigen(full, n)
    k = min(components, dim)
    real = int((e[:k] > max(float(e[0]), 0.0) * _ZERO).sum())
    turn = u[:, :real] / np.sqrt(e[:real])
    off = np.array([r / n for r in rest])

    def white(x: np.ndarray) -> np.ndarray:
        return ((x - centre) - off) @ turn

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((real, real + 1))
        for b in batches:
            x = matrix(column(b, "x"), dim)
            for a in range(0, len(x), BLOCK):
                w = white(x[a : a + BLOCK])
                sums[:, :real] += w.T @ w
                sums[:, real] += w.sum(axis=0)
        i, j = (v.reshape(-1) for v in np.indices(sums.shape))
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(sums.reshape(-1))})

    error = 0.0
    if real:
        found = fit.mapInArrow(spread, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()  # 16 * 17 rows at most
        c = np.zeros((real, real + 1))
        for r in found:
            c[r["i"], r["j"]] = r["s"] / n
        error = float(np.abs(c[:, :real] - np.outer(c[:, real], c[:, real]) - np.eye(real)).max())
    explained = np.maximum(e[:k], 0.0) / trace if trace else np.zeros(k)
    left = sum(r * r for r in rest)

    def deviations(z: np.ndarray) -> list:
        """Sums of (n z - rest) ** 2 over the dimensions."""
        most = max(abs(int(z.min())), abs(int(z.max())))
        small = n < 2**62 and dim * max(most, 1) * max(most, n) < 2**62
        exact = z if small else z.astype(object)
        square = (exact * exact).sum(axis=1).astype(object)
        cross = (exact * np.array(rest, np.int64 if small else object)).sum(axis=1).astype(object)
        return [int(v) for v in n * n * square - 2 * n * cross + left]

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, BLOCK):
                part = b.slice(a, BLOCK)
                x, m = matrix(column(part, "x"), dim), part.num_rows
                w = np.full((m, k), np.nan)
                w[:, :real] = white(x)
                far = [decimal.Decimal(d) if d < 10**38 else None for d in deviations(x - centre)]
                each = pa.array(np.repeat(np.arange(m), k))
                none = np.tile(np.arange(k) >= real, m)
                yield pa.record_batch({
                    "vec_id": column(part, "vec_id").take(each), "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), "n": pa.array(np.full(m * k, n, np.int64)),
                    "deviation": pa.array(far, pa.decimal128(38, 0)).take(each), "whitened": pa.array(w.reshape(-1), mask=none), "explained": pa.array(np.tile(explained, m)),
                    "identity_error": pa.array(np.full(m * k, error)),
                })
        give_back()

    return rows.mapInArrow(out, empty)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every embedding; deviations beyond the range of long are its end."""
    out = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    deviation = F.least(F.coalesce("deviation", F.lit(2**63 - 1).cast("decimal(38,0)")), F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long")
    return out.select("vec_id", "component", "n", deviation.alias("deviation"), "whitened", "explained", "identity_error")
