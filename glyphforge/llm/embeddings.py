"""Embedding near-duplicates: iterative quantisation, multi-index Hamming tables, reranking with the original vectors.

ITQ learns, on a bounded sample, the principal axes and a rotation of them that brings the signs of the projections closest
to the projections: balanced binary codes. The code is cut into pieces, each piece a table; the more vectors, the longer the
pieces. Two vectors at a cosine of `least` are sqrt(2 - 2 * least) apart on the unit sphere, and where a code bit differs
between them the distance takes up at least the sum of both squared projections. So each vector is indexed under its own piece
and looked up under every piece that differs from it in bits whose squared projections sum to at most a budget: a pair meets if
either finds the other. A budget of half the squared distance, shared by the pieces, loses nothing and is taken where it
costs few lookups; else the budget is the one that all but a thousandth of a sample's pairs exactly at the bound need.

Buckets are first met by codes alone, which leaves the vectors that have a partner within reach; these are joined to their
vectors once and reranked in double precision. A pair that meets in several buckets counts in the first alone, and no pair
leaves a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Workspace, column, give_back, lookup, map_batches
from glyphforge.llm.components import components, forest

BITS = 64
#: Bits of a piece: five more than the logarithm of the number of vectors, so that few lookups find a bucket, within these limits.
LEAST_PIECE, MOST_PIECE = 12, 22
#: Vectors that ITQ is fitted on at most, those of the smallest hashes of their ids; every vector is indexed.
SAMPLE = 8192
#: Pairs at the bound that the budget is found with, the share of them that it must serve, what is added as the sample is fitted
#: better than other vectors, and the mean number of lookups of a vector up to which the budget that loses nothing is taken.
TRIED, SERVED, MARGIN, FEW_LOOKUPS = 8192, 0.999, 1.25, 64
#: Where vectors lie close around one direction, codes tell little and lookups multiply: pieces are then shortened, down to
#: SHORTEST bits, until a vector of the sample has MOST_LOOKUPS on average. Lookups listed at a time, but for a single vector's.
SHORTEST, MOST_LOOKUPS, MOST_LISTED = 4, 4096, 1 << 20
#: Indexed vectors of a bucket that one task holds; a larger bucket is dealt out in blocks.
BUCKET = 4096
#: Pairs that are compared at a time, vectors whose lookups are listed at a time, and rows of buckets held at a time.
PAIRS, LISTED, HELD = 1 << 17, 512, 1 << 15
_FINE = 2.0**40


class Itq:
    """mean, axes (dimension x bits), the bits of each piece, and for pairs at `least` the budget and the most differing bits.

    Without a sample the axes are a random rotation.
    """

    def __init__(self, sample: np.ndarray, dim: int, count: int = 0, least: float = 0.95, rounds: int = 30, seed: int = 3):
        bits = min(BITS, dim)
        rng = np.random.default_rng(seed)
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(dim)
        if len(sample):
            x = sample - self.mean
            _, axes = np.linalg.eigh(x.T @ x)
            axes = axes[:, ::-1][:, :bits]
            turn, _ = np.linalg.qr(rng.normal(size=(bits, bits)))
            y = x @ axes
            for _ in range(rounds):
                u, _, vt = np.linalg.svd(np.where(y @ turn >= 0, 1.0, -1.0).T @ y)
                turn = vt.T @ u.T
            self.axes = axes @ turn
        else:
            self.axes, _ = np.linalg.qr(rng.normal(size=(dim, bits)))
        wide = min(MOST_PIECE, max(LEAST_PIECE, math.ceil(math.log2(max(2, count))) + 5))
        pairs = self._pairs(sample, dim, least, rng)
        while True:
            self.pieces = np.array_split(np.arange(bits), max(1, -(-bits // MOST_PIECE), bits // wide))
            self._calibrate(*pairs, least)
            if wide <= SHORTEST or self.expected(pairs[1][:256], self.budget) <= MOST_LOOKUPS:
                break
            wide -= 2

    def expected(self, square: np.ndarray, budget: int) -> float:
        """Lookups of a vector on average, counted on a grid of sums rather than listed; a little more than there are."""
        total, grid = 0.0, 256
        unit = np.minimum(square // max(1, -(-budget // grid)), grid + 1)
        for p in self.pieces:
            ways = np.zeros((len(unit), grid + 1))
            ways[:, 0] = 1
            for b in p:
                at = np.arange(grid + 1) - unit[:, b, None]
                ways = ways + np.where(at >= 0, np.take_along_axis(ways, np.maximum(at, 0), axis=1), 0)
            total += ways.sum(axis=1).mean() - 1
        return total

    def _pairs(self, sample: np.ndarray, dim: int, least: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Codes and squares of vectors of the sample, and of vectors exactly at the bound from them."""
        a = sample[rng.integers(0, len(sample), TRIED)] if len(sample) else _unit(rng.normal(size=(TRIED // max(1, dim // 256), dim)))
        side = rng.normal(size=a.shape)
        side -= (side * a).sum(axis=1, keepdims=True) * a
        side[~side.any(axis=1)] = 1  # of one dimension: no other direction
        b = least * a + math.sqrt(max(0.0, 1 - least * least)) * _unit(side)
        return *self.project(a), *self.project(b)

    def _calibrate(self, bit: np.ndarray, square: np.ndarray, other: np.ndarray, square2: np.ndarray, least: float) -> None:
        differ = bit != other
        spread = differ.sum(axis=1)
        self.most_bits = math.ceil(spread.mean() + 5 * spread.std())
        lossless = int((2 - 2 * least) / 2 / len(self.pieces) * _FINE)
        some = slice(0, 256)
        # Expected lookups are counted without listing them: of one bit and of two, which more bits would only add to.
        ways = sum(((c := (square[some][:, p] <= lossless).sum(axis=1)) + c * (c - 1) / 2).mean() for p in self.pieces)
        if ways <= FEW_LOOKUPS and len(self.lookups(bit[some], square[some], lossless)[0]) <= FEW_LOOKUPS * len(bit[some]):
            self.budget = lossless
            return
        need = np.min([np.minimum((differ[:, p] * square[:, p]).sum(axis=1), (differ[:, p] * square2[:, p]).sum(axis=1)) for p in self.pieces], axis=0)
        self.budget = min(lossless, int(MARGIN * np.sort(need)[math.ceil(SERVED * len(need)) - 1]))

    def project(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code bits, and squared projections in integers, so that sums of them do not depend on their order."""
        z = (unit - self.mean) @ self.axes
        return z >= 0, np.rint(z * z * _FINE).astype(np.int64)

    def codes(self, bit: np.ndarray) -> np.ndarray:
        """For each vector and piece, the bucket: the piece's number, the vectors' length, the piece's bits."""
        low = np.stack([bit[:, p] @ (np.int64(1) << np.arange(len(p), dtype=np.int64)) for p in self.pieces], axis=1)
        return low + (np.arange(len(self.pieces), dtype=np.int64) << 48) + (np.int64(len(self.mean)) << 24)

    def listed(self, bit: np.ndarray, square: np.ndarray, budget: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """The lookups of slices of the vectors, so many at once that their lists stay small: 2 ** MOST_PIECE in a piece at most."""
        todo = [slice(0, len(bit))] if len(bit) else []
        while todo:
            part = todo.pop()
            n = part.stop - part.start
            found = self.lookups(bit[part], square[part], budget, MOST_LISTED if n > 1 else None)
            if found is None:
                todo += [slice(part.start + n // 2, part.stop), slice(part.start, part.start + n // 2)]
            else:
                yield part, *found

    def lookups(self, bit: np.ndarray, square: np.ndarray, budget: int, most: int | None = None) -> tuple[np.ndarray, np.ndarray] | None:
        """(vector, bucket) of every lookup but the vectors' own buckets; None if there are more than `most`."""
        code, who, where, before = self.codes(bit), [], [], 0
        for t, p in enumerate(self.pieces):
            v, flip, used = np.arange(len(bit)), np.zeros(len(bit), np.int64), np.zeros(len(bit), np.int64)
            for k, b in enumerate(p):
                more = used + square[v, b]
                ok = more <= budget
                v, flip, used = np.concatenate([v, v[ok]]), np.concatenate([flip, flip[ok] | (1 << k)]), np.concatenate([used, more[ok]])
                if most is not None and before + len(v) > most + len(bit):
                    return None
            before += len(v) - len(bit)
            v, flip = v[flip > 0], flip[flip > 0]
            who.append(v)
            where.append(code[v, t] ^ flip)
        return np.concatenate(who), np.concatenate(where)


@lru_cache(maxsize=8)
def _untrained(dim: int, count: int, least: float) -> Itq:
    return Itq(np.zeros((0, dim)), dim, count, least)


def _matrix(a: pa.Array, kind: type, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(a.to_pylist()), kind).reshape(-1, dim).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, first by their largest component, so that no square overflows."""
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), np.finfo(float).smallest_subnormal)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _bit(bucket: np.ndarray) -> np.ndarray:
    """A bucket's place in the map of occupied buckets of one length."""
    return ((bucket >> 48) << MOST_PIECE) + (bucket & ((1 << MOST_PIECE) - 1))


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, int, bool]]:
    """Tables of whole groups of equal (bucket, block), indexed rows first in each.

    A group of more than HELD rows comes in several tables, each led by all its indexed rows (BUCKET, about): the number says how
    many leading rows the table before held too, the flag that a group is cut.
    """
    held: list[pa.Table] = []
    seen = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(t.num_rows for t in held) < HELD + seen:
            continue
        t = pa.concat_tables(held).combine_chunks()
        bucket, place = t["bucket"].to_numpy(), t["place"].to_numpy()
        other = np.flatnonzero((bucket != bucket[-1]) | (place >> 1 != place[-1] >> 1))
        if len(other):
            cut = int(other[-1]) + 1
            yield t.slice(0, cut), seen, seen > 0
            held, seen = [t.slice(cut)], 0
        elif place[-1] & 1:
            yield t, seen, True
            held = [t.filter(pa.array(place & 1 == 0))]
            seen = held[0].num_rows
        else:
            held = [t]
    if held:
        yield pa.concat_tables(held).combine_chunks(), seen, seen > 0


def _meetings(bucket: np.ndarray, place: np.ndarray, seen: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (any but the first `seen`, indexed) of the same group, about PAIRS at a time."""
    block, own = place >> 1, place & 1 == 0
    starts = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (block[1:] != block[:-1])]))
    ends = np.append(starts[1:], len(bucket))
    homes = np.flatnonzero(own)
    lo, hi = np.searchsorted(homes, starts), np.searchsorted(homes, ends)
    count = np.repeat(hi - lo, ends - starts)  # indexed rows that each row meets
    count[:seen] = 0
    base = np.repeat(lo, ends - starts)
    total = np.cumsum(count)
    at = 0
    while at < len(count):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        c = count[at:stop]
        p = np.repeat(np.arange(at, stop), c)
        yield p, homes[np.repeat(base[at:stop], c) + np.arange(len(p)) - np.repeat(np.cumsum(c) - c, c)]
        at = stop


def link_vectors(table: DataFrame, least: float = 0.95, sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row, by links of cosine >= least.

    table: vec_id, embedding (array of numbers); other columns are not looked at. A vector that is null, empty, zero, or holds a
    null or a number that is not finite is linked with nothing, and so is a row without vec_id (component_id null, kept
    true). Vectors of different lengths have no cosine and are not linked; ITQ is fitted for the commonest length (of equally
    common, the longest), other lengths are coded by a random rotation. n_links counts the other rows linked directly,
    component_id is the smallest vec_id that links reach, kept is vec_id = component_id. Rows that repeat a vector link with
    each other. An empty table gives an empty table.

    Equal vectors first collapse to one with a count. No pair leaves a task: it passes on each vector's number of links and
    a spanning forest.
    """
    spark = table.sparkSession
    work = Workspace(spark, "embeddings")
    small = table.schema["embedding"].dataType.jsonValue().get("elementType") == "float"
    kind = np.float32 if small else np.float64
    size = np.dtype(kind).itemsize
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if small else 'double'}>").alias("embedding"))
    sound = F.col("vec_id").isNotNull() & F.expr("size(embedding) > 0 and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(embedding, x -> x <> 0)")

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = column(batch, "embedding")
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(kind)
        ok = column(batch, "ok").to_pylist()
        return pa.record_batch({"vec_id": column(batch, "vec_id"), "vec": pa.array([flat[a:b].tobytes() if good else None for a, b, good in zip(at[:-1], at[1:], ok, strict=True)], pa.binary())})

    vectors = work.write(map_batches(rows.select("vec_id", "embedding", F.coalesce(sound, F.lit(False)).alias("ok")), packed, "vec_id long, vec binary"), "vectors")
    classes = vectors.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many"))
    classes = work.write(classes.select("rep", F.xxhash64("vec").alias("print"), "many", "vec"), "classes")
    length = F.expr(f"octet_length(vec) div {size}").alias("dim")
    lengths = classes.groupBy(length).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim, count = (int(lengths[0]["dim"]), int(lengths[0]["n"])) if lengths else (1, 0)
    fitted = classes.where(F.expr(f"octet_length(vec) = {dim * size}")).select("rep", "vec").orderBy(F.xxhash64("rep"), "rep", "vec").limit(sample).toArrow()
    itq = Itq(_unit(_matrix(fitted.column("vec").combine_chunks(), kind, dim)) if len(fitted) else np.zeros((0, dim)), dim, count, least)

    def by_length(dims: np.ndarray) -> Iterator[tuple[Itq, np.ndarray, int]]:
        for d in np.unique(dims).tolist():
            yield itq if d == dim else _untrained(d, count, least), np.flatnonzero(dims == d), d

    def dims_of(vecs: pa.Array) -> np.ndarray:
        return pc.binary_length(vecs).to_numpy(zero_copy_only=False).astype(np.int64) // size

    def own_buckets(batch: pa.RecordBatch) -> pa.RecordBatch:
        vecs = column(batch, "vec")
        out = [q.codes(q.project(_unit(_matrix(vecs.take(pa.array(i)), kind, d)))[0]).reshape(-1) for q, i, d in by_length(dims_of(vecs))]
        return pa.record_batch({"bucket": pa.array(np.concatenate(out))})

    occupied = work.write(map_batches(classes.select("vec"), own_buckets, "bucket long").groupBy("bucket").agg(F.count("*").alias("n")), "occupied")
    # A bit for each bucket of the commonest length, 512 KB a piece at most: lookups of empty buckets are not sent.
    bit_at = f"(shiftright(bucket, 48) * {1 << MOST_PIECE} + (bucket & {(1 << MOST_PIECE) - 1}))"
    masks = occupied.where(f"(shiftright(bucket, 24) & {(1 << 24) - 1}) = {dim}").selectExpr(f"shiftright({bit_at}, 6) as word", f"shiftleft(1L, cast({bit_at} & 63 as int)) as mask")
    masks = masks.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    words = np.zeros(len(itq.pieces) << (MOST_PIECE - 6), np.int64)
    words[masks["word"].to_numpy()] = masks["mask"].to_numpy()
    filled = spark.sparkContext.broadcast(words)

    def placed(batch: pa.RecordBatch) -> pa.Table:
        ids, prints, vecs = column(batch, "rep").to_numpy(), column(batch, "print").to_numpy(), column(batch, "vec")
        out = []
        for q, rows_here, d in by_length(dims_of(vecs)):
            for at in range(0, len(rows_here), LISTED):
                i = rows_here[at : at + LISTED]
                bit, square = q.project(_unit(_matrix(vecs.take(pa.array(i)), kind, d)))
                kept = []
                for part, who, where in q.listed(bit, square, q.budget):
                    if q is itq:
                        b = _bit(where)
                        some = (filled.value[b >> 6] >> (b & 63)) & 1 == 1
                        who, where = who[some], where[some]
                    kept.append((who + part.start, where))
                who, where = (np.concatenate(x) for x in zip(*kept, strict=True))
                n, t = len(bit), len(q.pieces)
                code = np.zeros((n, 8), np.uint8)
                packed_bits = np.packbits(bit, axis=1)
                code[:, : packed_bits.shape[1]] = packed_bits
                who = np.concatenate([np.repeat(np.arange(n), t), who])
                out.append(pa.record_batch({"bucket": pa.array(np.concatenate([q.codes(bit).reshape(-1), where])), "place": pa.array((np.arange(len(who)) >= n * t).astype(np.int64)), "rep": pa.array(ids[i][who]), "print": pa.array(prints[i][who]), "code": pa.array(code.view("<i8").reshape(-1)[who])}))
        return pa.Table.from_batches(out)

    sent = map_batches(classes.select("rep", "print", "vec"), placed, "bucket long, place long, rep long, print long, code long")
    large = work.write(occupied.where(F.col("n") > BUCKET).select("bucket", F.ceil(F.col("n") / BUCKET).alias("blocks")), "large")
    if not large.isEmpty():  # place is twice the block, and one more for a row that only looks up
        blocks = F.coalesce("blocks", F.lit(1))
        homes = sent.join(large, "bucket", "left").withColumn("home", F.when(F.col("place") == 0, F.pmod(F.xxhash64("rep", "print"), blocks)))
        spread = homes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        sent = spread.select("bucket", (2 * F.col("block") + F.when(F.col("home") == F.col("block"), 0).otherwise(1)).cast("long").alias("place"), "rep", "print", "code")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, seen, cut in _whole_groups(batches):
            bucket, place, ids, code = (t[c].to_numpy() for c in ("bucket", "place", "rep", "code"))
            code = code.view(np.uint64)  # of signed numbers numpy would count the bits of the absolute value
            keep = np.full(len(ids), cut)  # a group too large to hold goes on whole
            if not cut:
                most = np.full(len(ids), itq.most_bits)
                for q, i, _ in by_length((bucket >> 24) & ((1 << 24) - 1)):
                    most[i] = q.most_bits
                for p, i in _meetings(bucket, place, seen):
                    close = (np.bitwise_count(code[p] ^ code[i]) <= most[p]) & (ids[p] != ids[i])
                    keep[p[close]] = keep[i[close]] = True
            keep[:seen] = False
            yield from t.filter(pa.array(keep)).select(["bucket", "place", "rep", "print"]).to_batches()
        give_back()

    def reranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links: dict[str, list[np.ndarray]] = {"x": [], "y": [], "nx": [], "ny": []}

        def passed_on() -> pa.RecordBatch:
            x, y, nx, ny = (np.concatenate(links[k]) for k in ("x", "y", "nx", "ny"))
            ids, at = np.unique(np.concatenate([x, y]), return_inverse=True)
            sums = np.bincount(at, weights=np.concatenate([ny, nx])).astype(np.int64)
            a, b = forest(x, y)
            return pa.record_batch({"a": pa.array(np.concatenate([ids, a])), "b": pa.array([None] * len(ids) + b.tolist(), pa.int64()), "n": pa.array(np.concatenate([sums, np.zeros(len(a), np.int64)]))})

        def rerank(q: Itq, t: pa.Table, d: int, seen: int) -> None:
            bucket, place, ids, many = (t[c].to_numpy() for c in ("bucket", "place", "rep", "many"))
            x = _unit(_matrix(t["vec"].combine_chunks(), kind, d))
            bit, square = q.project(x)
            for p, i in _meetings(bucket, place, seen):
                other = ids[p] != ids[i]
                p, i = p[other], i[other]
                step = max(1, (PAIRS << 6) // d)  # pairs of 64 MB of components a side
                close = np.concatenate([np.einsum("ij,ij->i", x[p[a : a + step]], x[i[a : a + step]]) >= least for a in range(0, len(p), step)] or [np.zeros(0, bool)])
                p, i = p[close], i[close]
                if not len(p):
                    continue
                differ = bit[p] != bit[i]
                by_p = np.stack([(differ[:, k] * square[p][:, k]).sum(axis=1) for k in q.pieces], axis=1) <= q.budget
                by_i = np.stack([(differ[:, k] * square[i][:, k]).sum(axis=1) for k in q.pieces], axis=1) <= q.budget
                # The ways to meet in order: by piece, the smaller id looking up first.
                first_p = ids[p] < ids[i]
                ways = np.stack([np.where(first_p[:, None], by_p, by_i), np.where(first_p[:, None], by_i, by_p)], axis=2).reshape(len(p), -1)
                once = ways.argmax(axis=1) == 2 * (bucket[p] >> 48) + ~first_p
                for k, v in (("x", ids[p]), ("y", ids[i]), ("nx", many[p]), ("ny", many[i])):
                    links[k].append(v[once])

        for t, seen, _ in _whole_groups(batches):
            dims = (t["bucket"].to_numpy() >> 24) & ((1 << 24) - 1)
            for q, i, d in by_length(dims):
                rerank(q, t if len(i) == t.num_rows else t.take(pa.array(i)), d, seen if dims[0] == d else 0)
            if sum(map(len, links["x"])) > 1 << 20:
                yield passed_on()
                for v in links.values():
                    v.clear()
        if sum(map(len, links["x"])):
            yield passed_on()
        give_back()

    def met(df: DataFrame) -> DataFrame:
        return df.repartition("bucket", F.shiftright("place", 1)).sortWithinPartitions("bucket", "place")

    partnered = work.write(met(sent).mapInArrow(near, "bucket long, place long, rep long, print long"), "partnered")
    work.drop("occupied", "large")
    found = work.write(met(partnered.join(classes, ["rep", "print"])).select("bucket", "place", "rep", "many", "vec").mapInArrow(reranked, "a long, b long, n long"), "found")
    work.drop("partnered")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    roots = components(work, found.where("b is not null").select("a", "b")).toDF("rep", "root")
    # What a class found, by its vector; rows meet it by the vector's hash, a hot vector without a shuffle.
    told = classes.join(counts, "rep", "left").join(roots, "rep", "left").select("vec", "rep", "root", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).cast("long").alias("n_links"))
    told = work.write(told, "told")
    keyed = vectors.where("vec is not null")
    linked = lookup(work, keyed, told, "vec").select("vec_id", "n_links", F.coalesce("root", "rep").alias("root"))
    alone = vectors.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("root"))
    return linked.unionByName(alone).select("vec_id", "n_links", F.col("root").alias("component_id"), F.coalesce(F.col("vec_id") == F.col("root"), F.lit(True)).alias("kept"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, linked at a cosine of 0.95."""
    return link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), least=0.95)


OP6_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.95),
r as (select vec_id as d, vec_id as m from embeddings union select r.d, l.b from r join l on r.m = l.a),
n as (select a, count(*) as n from l group by a),
c as (select d, min(m) as m from r group by d)
select t.vec_id, coalesce(n.n, 0) as n_links, c.m as component_id, t.vec_id = c.m as kept from embeddings t join c on c.d = t.vec_id left join n on n.a = t.vec_id
"""
