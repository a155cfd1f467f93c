"""Exact top-k by inner product with a three-phase uniform threshold.

The dimensions, turned to the principal axes of a sample, are cut into LISTS groups: in each group a candidate has a local
score, and their sum is its score. No local score exceeds the product of both norms in its group.
Phase 1: every block of candidates gathers bounded local lists, the entries with the largest norms in each group; these
are scored exactly, and the k-th best of a query's offers is a cutoff that its true k-th best cannot fall below.
Phase 2: the cutoff goes with the query to all blocks. Local scores are read group by group; a candidate whose scores so far and
norms in the groups to come stay below the cutoff is dropped, so that what is left is sufficient. Blocks whose largest norms
stay below it are not read, and candidates below every query's cutoff are not sent.
Phase 3: the candidates left are scored exactly in integers, and each block passes on its best k.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphforge.llm.common import Workspace, column, give_back, map_batches

LISTS = 4
#: Queries and candidates of a pair of blocks; a task holds the queries and streams the candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 16384
#: Entries of a local list: at least so many, and one of so many candidates.
LEAST_LISTED, LISTED_OF = 8, 64
#: Queries and candidates that meet in one matrix.
_Q, _C = 256, 4096
#: Rows that the principal axes are found with at most (any orthogonal axes are right), and dimensions up to which they are.
SAMPLE, MOST_TURNED = 4096, 1024
#: Rounding of a score in doubles, as a share of the product of the norms, is below this.
_SLACK = 1e-9
_LONG = 2**63 - 1


def quantised(table: DataFrame) -> DataFrame:
    """vec_id and ints, floor(256 * x) of each component x as doubles; without rows that hold null or a number that is not finite."""
    e = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).where("vec_id is not null and e is not null and not exists(e, x -> x is null or isnan(x) or abs(x * 256) = double('infinity'))")
    return rows.select("vec_id", F.transform("e", lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x * 256).cast("double")).otherwise(x * 256)).alias("ints"))


def exact_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and c, whole numbers held as doubles: int64, or Python integers where that could overflow."""
    if not len(q):
        return np.zeros(0, np.int64)
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return np.einsum("ij,ij->i", q, c).astype(np.int64)
    if most < 2.0**62:
        return np.einsum("ij,ij->i", q.astype(np.int64), c.astype(np.int64))
    return np.array([sum(int(x) * int(y) for x, y in zip(a, b, strict=True)) for a, b in zip(q, c, strict=True)] + [None], object)[:-1]


class Turned:
    """Rows in the turned dimensions, and for each group the norm there and in all groups from it on."""

    def __init__(self, x: np.ndarray, axes: np.ndarray | None, groups: list[np.ndarray]):
        self.scale = max(1.0, float(np.abs(x).max(initial=0)))  # keeps squares finite
        x = x / self.scale
        y = x if axes is None else x @ axes
        self.parts = [y[:, g] for g in groups]
        squares = np.array([(p * p).sum(axis=1) for p in self.parts])
        self.rest = np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])  # rest[g]: norm in groups g, g + 1, ...
        self.norms = np.sqrt(squares)


def sufficient(q: Turned, c: Turned, cutoff: np.ndarray, counts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) places whose score may reach the query's cutoff. `counts` gets the local scores read in each group."""
    cut = (cutoff / q.scale / c.scale)[:, None]
    slack = _SLACK * q.rest[0][:, None] * c.rest[0][None, :]
    alive = q.rest[0][:, None] * c.rest[0][None, :] + slack >= cut
    cols = np.flatnonzero(alive.any(axis=0))
    got = np.zeros((len(cutoff), len(cols)))
    alive, slack = alive[:, cols], slack[:, cols]
    n = len(q.parts)
    for g in range(n):
        if alive.mean() < 0.1 if alive.size else True:
            break
        got += q.parts[g] @ c.parts[g][cols].T
        if counts is not None:
            counts[g] += got.size
        after = q.rest[g + 1][:, None] * c.rest[g + 1][cols][None, :] if g + 1 < n else 0.0
        alive &= got + after + slack >= cut
    else:
        g = n
    r, k = np.nonzero(alive)
    score, margin = got[r, k], slack[r, k]
    k = cols[k]
    for h in range(g, n):  # few are left: pair by pair
        if counts is not None:
            counts[h] += len(r)
        score = score + np.einsum("ij,ij->i", q.parts[h][r], c.parts[h][k])
        after = q.rest[h + 1][r] * c.rest[h + 1][k] if h + 1 < n else 0.0
        ok = score + after + margin >= cut[r, 0]
        r, k, score, margin = r[ok], k[ok], score[ok], margin[ok]
    return r, k


def _dealt(queries: DataFrame, rows: DataFrame, query_blocks: int, row_blocks: int, least: DataFrame | None = None) -> DataFrame:
    """Every block of queries meets every block of candidates: rows with kind 0 (query) before kind 1 within qb and cb.

    `least`: qb, need: the norm that a candidate must have for any query of the block.
    """
    all_q, all_c = (F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (query_blocks, row_blocks))
    left = queries.select("qb", all_c.alias("cb"), F.lit(0).alias("kind"), "vec_id", "cutoff", "vec")
    right = rows.select(all_q.alias("qb"), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(row_blocks)).cast("int").alias("cb"), F.lit(1).alias("kind"), "vec_id", F.lit(None).cast("double").alias("cutoff"), "vec", "norm")
    if least is not None:  # a row a block of queries
        right = right.join(F.broadcast(least), "qb").where(F.col("norm") >= F.col("need") * (1 - _SLACK))
    return left.unionByName(right.select(left.columns)).repartition("qb", "cb").sortWithinPartitions("qb", "cb", "kind", "vec_id")


def top_k(table: DataFrame, query_rows: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k highest inner products over all rows but its own.

    table and query_rows: vec_id, embedding; other columns are not looked at. Components x count as floor(256 * x). Vectors
    that are null or hold null or a number that is not finite (as x or as 256 * x) take no part, nor do rows without vec_id;
    shorter vectors count as filled up with zeros. Ties go to the smaller vec_id; rows that repeat a vec_id are candidates of
    their own, except to the query of that vec_id; a query that is repeated is asked once, with its smallest vector. Fewer than
    k candidates give fewer rows; empty tables give an empty table. Inner products are exact at any size; one beyond the
    range of long is given as the end of that range.
    """
    spark = table.sparkSession
    work = Workspace(spark, "topk")
    rows = quantised(table)
    queries = quantised(query_rows).groupBy("vec_id").agg(F.min("ints").alias("ints"))
    shape = rows.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("dim")).collect()[0]
    asked = queries.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("ints")), F.lit(0)).alias("dim")).collect()[0]
    dim = max(1, shape["dim"], asked["dim"])
    groups = [g for g in np.array_split(np.arange(dim), LISTS) if len(g)]
    query_blocks, row_blocks = max(1, -(-asked["n"] // QUERY_BLOCK)), max(1, -(-shape["n"] // CANDIDATE_BLOCK))

    def packed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = column(batch, "ints")
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        out, norms = [], []
        for a, b in zip(at[:-1], at[1:], strict=True):
            v = np.zeros(dim)
            v[: b - a] = flat[a:b]
            out.append(v.tobytes())
            top = float(np.abs(v).max())
            norms.append(top * float(np.linalg.norm(v / top)) if top else 0.0)
        return pa.record_batch({"vec_id": column(batch, "vec_id"), "vec": pa.array(out, pa.binary()), "norm": pa.array(norms, pa.float64())})

    block_of = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb")
    rows = work.write(map_batches(rows, packed, "vec_id long, vec binary, norm double"), "rows")
    queries = work.write(map_batches(queries, packed, "vec_id long, vec binary, norm double").select("*", block_of), "queries")
    axes = None
    if dim <= MOST_TURNED:
        some = rows.select("vec_id", "vec").orderBy(F.xxhash64("vec_id"), "vec_id", "vec").limit(SAMPLE).toArrow()
        x = np.frombuffer(b"".join(some["vec"].to_pylist()), np.float64).reshape(-1, dim)
        x = x / max(1.0, float(np.abs(x).max(initial=0)))
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]

    def listed(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The local lists of a batch of candidates: of each group the entries with the largest norms."""
        c = Turned(np.frombuffer(b"".join(column(batch, "vec").to_pylist()), np.float64).reshape(-1, dim), axes, groups)
        few = min(batch.num_rows, max(LEAST_LISTED, 2 * k, batch.num_rows // LISTED_OF))
        return batch.take(pa.array(np.unique(np.argpartition(-c.norms, few - 1, axis=1)[:, :few])))

    def blocks(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        at, held_q, held_c, n = None, [], [], 0

        def met() -> Iterator[pa.RecordBatch]:
            if not (held_q and held_c):
                return
            q, c = (pa.Table.from_batches(h).combine_chunks() for h in (held_q, held_c))
            qm, cm = (np.frombuffer(b"".join(t["vec"].to_pylist()), np.float64).reshape(-1, dim) for t in (q, c))
            cut, qid, cid = q["cutoff"].to_numpy(), q["vec_id"].to_numpy(), c["vec_id"].to_numpy()
            turned = Turned(cm, axes, groups)
            for i in range(0, len(qid), _Q):
                part = slice(i, i + _Q)
                if first:
                    r, j = (x.reshape(-1) for x in np.indices((len(qid[part]), len(cid))))
                else:
                    r, j = sufficient(Turned(qm[part], axes, groups), turned, cut[part])
                other = qid[part][r] != cid[j]
                r, j = r[other], j[other]
                step = max(1, (1 << 23) // dim)  # pairs of 64 MB of components a side
                score = np.concatenate([exact_scores(qm[part][r[a : a + step]], cm[j[a : a + step]]) for a in range(0, len(r), step)] or [np.zeros(0, np.int64)])
                order = np.lexsort((cid[j], -score, r))
                r, j, score = r[order], j[order], score[order]
                best = np.arange(len(r)) - np.searchsorted(r, r) < k
                r, j, score = r[best], j[best], score[best]
                if score.dtype == object:
                    score = np.array([max(-_LONG - 1, min(_LONG, s)) for s in score], np.int64)
                yield pa.record_batch({"query_id": pa.array(qid[part][r]), "vec_id": pa.array(cid[j]), "score": pa.array(score)})

        for batch in batches:
            keys = np.stack([batch.column("qb").to_numpy(), batch.column("cb").to_numpy(), batch.column("kind").to_numpy()], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)], strict=True):
                unit = tuple(keys[a, :2])
                if unit != at or n >= _C:
                    yield from met()
                    held_c, n = [], 0
                if unit != at:
                    at, held_q = unit, []
                for s in range(a, b, _C):
                    part = batch.slice(s, min(_C, b - s))
                    if keys[a, 2] == 0:
                        held_q.append(part)
                    else:
                        if n + part.num_rows > _C:
                            yield from met()
                            held_c, n = [], 0
                        held_c.append(part)
                        n += part.num_rows
        yield from met()
        give_back()

    schema = "query_id long, vec_id long, score long"
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    lists = map_batches(rows, listed, "vec_id long, vec binary, norm double")
    offered = _dealt(queries.withColumn("cutoff", F.lit(None).cast("double")), lists, query_blocks, row_blocks).mapInArrow(lambda it: blocks(it, True), schema)
    kth = work.write(offered.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("cutoff")), "cutoffs")
    # A query with fewer than k offers has no cutoff, and takes what there is.
    armed = queries.join(kth, queries["vec_id"] == kth["id"], "left").select("vec_id", "vec", "qb", "norm", F.coalesce("cutoff", F.lit(float("-inf"))).alias("cutoff"))
    armed = work.write(armed, "armed")
    need = F.when((F.col("cutoff") > 0) & (F.col("norm") > 0), F.col("cutoff") / F.col("norm")).otherwise(0.0)
    final = _dealt(armed, rows, query_blocks, row_blocks, armed.groupBy("qb").agg(F.min(need).alias("need"))).mapInArrow(lambda it: blocks(it, False), schema)
    return final.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all embeddings for every vector whose vec_id is divisible by 50."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table, table.where("vec_id % 50 = 0"), k=5)


OP7_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.e, c.e) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
