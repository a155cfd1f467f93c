"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

SuperMinHash gives each element one pseudorandom permutation of the signature's slots; its j-th visit offers the value
j + r with r in [0, 1). A slot that a visit of round j has filled cannot be improved by a later round, so the rounds of a
document stop as soon as all its slots are filled: after one or two for long documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Words, Workspace, column, digest, lookup, map_batches, mix, window_hashes
from glyphforge.llm.components import components

SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
EMPTY = np.uint32(0xFFFFFFFF)
_VALUE_BITS = 25  # the round is kept above these bits
#: Elements whose permutations are held at once.
STEP = 1 << 17
#: Members of one residual bucket that one task compares: rows of a left and of a right block.
LEFT_BLOCK, RIGHT_BLOCK = 256, 1024
#: Verification deals the partners of a document out in lots of this many.
LOT = 64


def shingle_sets(texts: pa.Array, size: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of `size` words of each text; of all its words where there are fewer."""
    words = Words(texts, lower=lower)
    h, first = words.hashes(), words.first
    w = window_hashes(h, size)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(w[a : b - size + 1]))
        else:
            out.append(window_hashes(h[a:b], b - a) if b > a else w[:0])
    return out


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of SLOTS values each; of an empty set, all EMPTY."""
    sig = np.full((len(sets), SLOTS), EMPTY, np.uint32)
    start, lens = 0, np.array([len(s) for s in sets])
    ends = np.cumsum(lens)
    while start < len(sets):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + STEP, "right")))
        if stop == start + 1 and lens[start] > STEP:  # one very large set: by parts, slot-wise least
            for i in range(0, lens[start], STEP):
                part = sets[start][i : i + STEP]
                np.minimum(sig[start], _rounds(part, np.zeros(len(part), np.int64), 1)[0], out=sig[start])
        else:
            sig[start:stop] = _rounds(np.concatenate(sets[start:stop]), np.repeat(np.arange(stop - start), lens[start:stop]), stop - start)
        start = stop
    return sig


def _rounds(elements: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    sig = np.full(n * SLOTS, EMPTY, np.uint32)
    order = np.empty((len(elements), SLOTS), np.uint8)
    order[:] = np.arange(SLOTS, dtype=np.uint8)
    state = elements.copy()
    for j in range(SLOTS):
        if not len(state):
            break
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        at = np.arange(len(state))
        k = j + (((state & np.uint64(0xFFFFFFFF)) * np.uint64(SLOTS - j)) >> np.uint64(32)).astype(np.int64)
        slot = order[at, k]  # a step of Fisher and Yates: the slots visited so far stand before j
        order[at, k] = order[:, j]
        value = np.uint32(j << _VALUE_BITS) | (state >> np.uint64(64 - _VALUE_BITS)).astype(np.uint32)
        np.minimum.at(sig, row * SLOTS + slot, value)
        open_rows = (sig.reshape(n, SLOTS) == EMPTY).any(axis=1)
        stay = open_rows[row]
        if not stay.all():
            state, row, order = state[stay], row[stay], order[stay]
    return sig.reshape(n, SLOTS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of each signature, given as SLOTS 16-bit values: a band is 64 bits, hashed with its number."""
    bands = np.ascontiguousarray(sig).view("<u8")
    return mix(bands + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).view(np.int64)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per row: doc_id, n (set size), fp (128 bits of the set), sig (16 bits of each slot, as bytes); fp and sig null if empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(column(batch, "text"), size)
        low = (superminhash(sets) & np.uint32(0xFFFF)).astype("<u2")
        some = [len(s) > 0 for s in sets]
        return pa.record_batch(
            {
                "doc_id": column(batch, "doc_id"),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "fp": pa.array([digest(s) if ok else None for s, ok in zip(sets, some, strict=True)], pa.binary()),
                "sig": pa.array([x.tobytes() if ok else None for x, ok in zip(low, some, strict=True)], pa.binary()),
            }
        )

    return map_batches(docs, run, "doc_id long, n long, fp binary, sig binary", text="text")


def _banded(classes: DataFrame) -> DataFrame:
    """key, band, doc_id: a row for each band of each class."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sig = np.frombuffer(b"".join(column(batch, "sig").to_pylist()), "<u2").reshape(-1, SLOTS)
        ids = np.repeat(column(batch, "rep").to_numpy(), BANDS)
        return pa.record_batch({"key": pa.array(band_keys(sig).reshape(-1)), "band": pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(sig))), "doc_id": pa.array(ids)})

    return map_batches(classes.select("rep", "sig"), run, "key long, band int, doc_id long")


def verify(work: Workspace, name: str, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * common >= percent * union.

    a's set goes once to each lot of its partners; each partner's set goes along with the pair. A task holds one set of an a
    at a time and streams the partners past it, so that a document with very many partners needs no more memory.
    """
    lot = F.pmod(F.xxhash64("b"), F.greatest(F.lit(1), F.ceil(F.col("many") / LOT)))
    lots = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("many")), "a").select("a", "b", lot.alias("lot"))
    lots = work.write(lots, f"{name}_lots")
    heads = lots.select("a", "lot").distinct().join(sets.toDF("a", "set"), "a").select("a", "lot", F.lit(None).cast("long").alias("b"), "set")
    tails = lots.join(sets.toDF("b", "set"), "b").select("a", "lot", "b", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            out_a, out_b = [], []
            for a, lot, b, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = np.frombuffer(s, np.uint64)
                if (a, lot) != at:
                    at, held = (a, lot), []
                if b is None:
                    held.append(s)
                    continue
                for t in held:
                    small, large = (s, t) if len(s) < len(t) else (t, s)
                    if 100 * len(small) < percent * len(large):
                        continue
                    i = np.searchsorted(large, small)
                    i[i == len(large)] = 0
                    common = int((large[i] == small).sum())
                    if 100 * common >= percent * (len(s) + len(t) - common):
                        out_a.append(a)
                        out_b.append(b)
                        break
            if out_a:
                yield pa.record_batch({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    dealt = heads.unionByName(tails).repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first())
    return work.write(dealt.mapInArrow(run, "a long, b long"), f"{name}_true")


def _sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(column(batch, "text"), size)
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "set": pa.array([s.tobytes() for s in sets], pa.binary())})

    return map_batches(docs.join(wanted.hint("merge"), "doc_id", "left_semi"), run, "doc_id long, set binary", text="text")


def _shared_counts(work: Workspace, sets: DataFrame) -> DataFrame:
    """doc_id, n (set size) and common (shingles that another of these sets has too)."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        ids, out = column(batch, "doc_id").to_numpy(), []
        for i, s in zip(ids, column(batch, "set").to_pylist(), strict=True):
            h = np.frombuffer(s, np.int64)
            out.append(pa.record_batch({"h": pa.array(h), "doc_id": pa.array(np.full(len(h), i, np.int64))}))
        return pa.Table.from_batches(out, pa.schema({"h": pa.int64(), "doc_id": pa.int64()}))

    each = map_batches(sets.select("doc_id", "set"), run, "h long, doc_id long")
    alone = each.groupBy("h").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1").groupBy("doc_id").agg(F.count("*").alias("alone"))
    sizes = sets.select("doc_id", F.expr("octet_length(set) div 8").alias("n")).groupBy("doc_id").agg(F.max("n").alias("n"))
    return sizes.join(alone, "doc_id", "left").select("doc_id", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("common"))


def _residual(members: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components that share a band, as far as their signatures agree in enough slots.

    members: key, band, doc_id, root, sig, n (set size), common (shingles that some other member of any residual bucket has too: no
    more can be in common with a partner), lead (root of the bucket's pivot), many and strays (rows in all, and outside the
    pivot's component). Every stray meets every member of another component: blocks of strays against blocks of members, each pair
    of blocks in a task, where numpy compares them. Only pairs within six standard deviations of the bound are passed on,
    each from one band.
    """
    bound = percent / 100
    least = int(np.floor(SLOTS * (bound - 6 * np.sqrt(bound * (1 - bound) / SLOTS))))
    lefts, rights = F.ceil(F.col("strays") / LEFT_BLOCK), F.ceil(F.col("many") / RIGHT_BLOCK)
    rest = ["doc_id", "root", "n", "common", "band", "sig"]
    left = members.where("root <> lead").select("key", F.pmod(F.xxhash64("doc_id"), lefts).alias("lb"), F.explode(F.sequence(F.lit(0).cast("long"), rights - 1)).alias("rb"), F.lit(True).alias("stray"), *rest)
    right = members.select("key", F.explode(F.sequence(F.lit(0).cast("long"), lefts - 1)).alias("lb"), F.pmod(F.xxhash64("doc_id", F.lit(1)), rights).alias("rb"), F.lit(False).alias("stray"), *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compare(rows: list[tuple]) -> pa.RecordBatch | None:
            ls, rs = [r for r in rows if r[0]], [r for r in rows if not r[0]]
            if not ls or not rs:
                return None
            (li, lr, ln, lc), (ri, rr, rn, rc) = (np.array([r[1:5] for r in side], np.int64).T for side in (ls, rs))
            band = ls[0][5]
            lsig, rsig = (np.frombuffer(b"".join(r[6] for r in side), "<u2").reshape(len(side), SLOTS) for side in (ls, rs))
            lkey, rkey = lsig.view("<u8"), rsig.view("<u8")
            a, b = [], []
            for i in range(len(ls)):
                shared = np.minimum(rc, lc[i])
                ok = np.flatnonzero((rr != lr[i]) & (100 * shared >= percent * (rn + ln[i] - shared)))
                ok = ok[(rsig[ok] == lsig[i]).sum(axis=1) >= least]
                ok = ok[(rkey[ok] == lkey[i]).argmax(axis=1) == band]  # in the first band that they share
                b.append(ri[ok])
                a.append(np.full(len(ok), li[i]))
            a, b = np.concatenate(a), np.concatenate(b)
            return pa.record_batch({"a": np.minimum(a, b), "b": np.maximum(a, b)}) if len(a) else None

        at, held = None, []
        for batch in batches:
            for key, lb, rb, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, lb, rb) != at:
                    out = compare(held)
                    if out is not None:
                        yield out
                    at, held = (key, lb, rb), []
                held.append(tuple(rest))
        out = compare(held)
        if out is not None:
            yield out

    dealt = left.unionByName(right).repartition("key", "lb", "rb").sortWithinPartitions("key", "lb", "rb")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, work: Workspace | None = None) -> DataFrame:
    """Groups of documents whose sets of word shingles have 100 * common >= percent * union.

    docs: doc_id long, text string; other columns are not looked at. Returns doc_id, n_shingles, component_id (smallest
    doc_id that links reach, itself included) and kept (doc_id = component_id), a row for each input row. A text that is null
    or has no words has an empty set and is linked with nothing. Rows that repeat a doc_id and a text get the same result;
    a row whose doc_id is null is linked with nothing: component_id null, kept true. An empty table gives an empty table.

    1. Sets, fingerprints, signatures: one pass over the texts, without a shuffle.
    2. Rows with equal sets collapse to the smallest doc_id (a partial aggregate, so a hot group is small before the shuffle).
    3. In each band's bucket the pivot is the document that meets most others over all bands; the others are verified
       against it on full sets and linked. Large groups of near copies fall into one component here.
    4. Members of a bucket that are still in different components are looked at again. What such a document shares with no
       other of them bounds its similarity to all of them at once, which settles most; the others are compared in blocks by
       that bound and by signature, verified on full sets and linked: so no link is lost that a band shows, and no group is
       expanded into all its pairs.
    A pair at the bound is missed by all 32 bands of 4 rows with a chance of 4e-8 at 80 and 5e-11 at 85.
    """
    spark = docs.sparkSession
    work = work or Workspace(spark, "minhash")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    meta = work.write(signatures(docs, size), "meta")
    known = meta.where("doc_id is not null and fp is not null")
    # Joins as large as the bands are merge joins at every size, so that small tables take the plan of large ones.
    # One shuffle of the signatures, after a partial aggregate: a class keeps its smallest doc_id and that row's signature.
    best = known.groupBy("fp").agg(F.min(F.struct("doc_id", "sig")).alias("c"), F.count("*").alias("rows"))
    classes = work.write(best.select("fp", F.col("c.doc_id").alias("rep"), F.col("c.sig").alias("sig"), "rows"), "classes")
    bands = _banded(classes)
    shared = work.write(bands.groupBy("key").agg(F.count("*").alias("many")).where("many > 1"), "shared")
    members = work.write(bands.join(shared.hint("merge"), "key"), "members")
    work.drop("shared")
    degree = members.groupBy("doc_id").agg(F.sum("many").alias("degree"))
    ranked = work.write(members.select("key", "doc_id").join(degree.hint("merge"), "doc_id"), "ranked")
    pivots = work.write(ranked.groupBy("key").agg(F.min(F.struct(-F.col("degree"), "doc_id")).alias("p")).select("key", F.col("p.doc_id").alias("pivot")), "pivots")
    stars = work.write(ranked.select("key", "doc_id").join(pivots.hint("merge"), "key").where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct(), "stars")
    sets = work.write(_sets_of(docs, ranked.select("doc_id").distinct(), size), "sets")
    work.drop("ranked")
    first = components(work, verify(work, "star", stars, sets, percent), "cc1")
    work.drop("star_lots", "star_true")
    rooted = members.join(first.toDF("doc_id", "root").hint("merge"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    led = pivots.join(first.toDF("pivot", "lead"), "pivot", "left").select("key", F.coalesce("lead", "pivot").alias("lead"))
    rooted = work.write(rooted.join(led.hint("merge"), "key"), "rooted")
    work.drop("members", "pivots")
    mixed = rooted.groupBy("key").agg(F.max((F.col("root") != F.col("lead")).cast("int")).alias("strays")).where("strays > 0")
    unsettled = work.write(rooted.drop("many").join(mixed.select("key").hint("merge"), "key"), "unsettled")
    work.drop("rooted")
    own = sets.join(unsettled.select("doc_id").distinct().hint("merge"), "doc_id")
    common = _shared_counts(work, own).where(100 * F.col("common") >= percent * F.col("n"))
    able = work.write(unsettled.join(common, "doc_id").join(classes.select(F.col("rep").alias("doc_id"), "sig"), "doc_id"), "able")
    work.drop("unsettled")
    size = able.groupBy("key").agg(F.count("*").alias("many"), F.sum((F.col("root") != F.col("lead")).cast("long")).alias("strays")).where("strays > 0")
    left_over = able.join(work.write(size, "size"), "key")
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = work.write(_residual(left_over, percent).join(tried, ["a", "b"], "left_anti"), "more")
    work.drop("able", "size", "stars")
    second = first
    if not more.isEmpty():
        extra = verify(work, "rest", more, sets, percent)
        second = components(work, extra.union(first.select("node", "root")), "cc2")
        work.drop("rest_lots", "rest_true")
    work.drop("sets", "more")
    # Rows meet their class by fingerprint; those without one have a key of their own, and hot classes are not shuffled.
    by_fp = work.write(classes.select(F.col("fp").alias("key"), "rep").join(second.toDF("rep", "root"), "rep", "left").select("key", F.coalesce("root", "rep").alias("root")), "by_fp")
    work.drop("classes")
    keyed = meta.select("doc_id", "n", F.when(F.col("doc_id").isNotNull() & F.col("fp").isNotNull(), F.col("fp")).otherwise(F.concat(F.lit("row "), F.monotonically_increasing_id()).cast("binary")).alias("key"))
    out = lookup(work, keyed, by_fp, "key", "left").withColumn("root", F.coalesce("root", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("root")).alias("component_id"), F.coalesce(F.col("doc_id") == F.col("root"), F.lit(True)).alias("kept"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, linked where 100 * common >= 85 * union."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), percent=85)


OP1_SQL = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (select doc_id, case when len(ws) >= 5 then list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh from w),
u as (select doc_id, md5(unnest(sh)) as g from s),
c as (select a.doc_id as a, b.doc_id as b, count(*) as n from u a join u b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select a, b from c join s x on x.doc_id = a join s y on y.doc_id = b where 100 * n >= 85 * (len(x.sh) + len(y.sh) - n)),
r as (select doc_id as d, doc_id as m from s union select r.d, l.b from r join l on r.m = l.a)
select s.doc_id, cast(len(any_value(s.sh)) as bigint) as n_shingles, min(r.m) as component_id, s.doc_id = min(r.m) as kept from s join r on r.d = s.doc_id group by s.doc_id
"""
