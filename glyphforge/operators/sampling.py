"""Samples and splits by exact counts (O7 to O9). Random order is a hash of a seed and a key, so reruns and partitions agree."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, strip
from glyphforge.operators.columns import ordinals, running_sums
from glyphforge.operators.predicates import TIER_B, conjunction, require_columns
from glyphforge.sources.scratch import written

SPLITS = ("train", "val", "test")
MISSING = "__missing_group__"
#: Rows that a sample gathers in order at most, and bits of a digit where it counts instead.
GATHER, DIGIT = 100_000, 12
#: Turns in which the tag-balanced split deals out tags.
ROUNDS = 32


def allocate(total: int, weights: list[float]) -> list[int]:
    """Largest remainders; ties go to the lower index."""
    whole = sum(weights)
    if whole <= 0:
        raise ValueError("weights must have a positive sum")
    exact = [total * w / whole for w in weights]
    out = [int(x) for x in exact]
    for i in sorted(range(len(weights)), key=lambda i: (out[i] - exact[i], i))[: total - sum(out)]:
        out[i] += 1
    return out


def shuffled(key: list[str], seed: int) -> Column:
    """A portable pseudorandom order: md5 of the seed and the key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(cell(F.col(f"`{c}`")) for c in key)))


def take(df: DataFrame, n: int, key: list[str], seed: int, shuffle: bool = True, gather: int = GATHER) -> DataFrame:
    """The first n rows in shuffled order, or in order of the key (then unique). Of rows of one key any are taken.

    Up to `gather` rows are gathered in order. More are not: counts of leading digits of their order's hash find the digits of the
    n-th row, twelve bits a pass over the key; rows below are taken as they are, and only those of the same digits, `gather`
    at most, are put in order. Rows of one key go on by a hash of all their columns.
    """
    if n <= gather:
        order = [shuffled(key, seed), *key] if shuffle else key
        return df.orderBy(*order).limit(n)
    if not shuffle:
        return ordinals(df, key, "__at").where(F.col("__at") < n).drop("__at")
    first = F.conv(F.substring(shuffled(key, seed), 1, 15), 16, 10).cast("long")
    second = F.shiftrightunsigned(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), 4)
    rows = df.withColumns({"__a": first, "__b": second})
    bound, left = F.lit(True), n
    below = F.lit(False)
    for digits in (F.col("__a"), F.col("__b")):
        for shift in range(48, -1, -DIGIT):
            digit = F.shiftright(digits, shift).bitwiseAND(F.lit((1 << DIGIT) - 1).cast("long"))
            counts = rows.where(bound).groupBy(digit.alias("d")).agg(F.count("*").alias("n")).orderBy("d").collect()  # 2 ** DIGIT rows at most
            at, size = 0, 0
            for at, size in counts:
                if size >= left:
                    break
                left -= size
            below, bound = below | (bound & (digit < at)), bound & (digit == at)
            if not counts or left >= size:
                return rows.where(below | bound).drop("__a", "__b")
            if size <= gather:
                return rows.where(below).unionByName(rows.where(bound).orderBy("__a", *key, "__b").limit(left)).drop("__a", "__b")
    return rows.where(below).unionByName(rows.where(bound).limit(left)).drop("__a", "__b")  # rows equal in all columns


def take_repeated(df: DataFrame, n: int, key: list[str], seed: int) -> DataFrame:
    """n draws with replacement: draw i takes the row whose number is a hash of i."""
    size = df.count()
    if not size:
        return df.limit(0)
    draws = df.sparkSession.range(n).select(F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(size)).alias("__at"))
    return ordinals(df, key, "__at").join(draws, "__at").drop("__at")


def sample_merge(tables: list[DataFrame], weights: list[float], total: int, key: list[str], seed: int = 42, shuffle: bool = True, filters: list[Mapping[str, Any]] | None = None, replacement: bool = False) -> DataFrame:
    """Rows of several tables in the ratio of the weights, `total` in all, columns united. A table that has too few rows
    after the filters raises, unless drawn with replacement."""
    out = None
    for df, n in zip(tables, allocate(total, weights), strict=True):
        require_columns(df, [*key, *(f["column"] for f in filters or ())])
        rows = df.where(conjunction(filters, TIER_B))
        if replacement:
            part = take_repeated(rows, n, key, seed)
        else:
            if (rows.limit(n) if n <= GATHER else rows).count() < n:
                raise ValueError(f"a table has fewer than the {n} rows wanted")
            part = take(rows, n, key, seed, shuffle)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def split_by_ratio(df: DataFrame, key: list[str], groups: list[str] = (), ratio: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42, shuffle: bool = True, out: str = "split") -> DataFrame:
    """Within each group floor(n * r) rows are train, as many val, the rest test; ratios are normalised."""
    require_columns(df, [*key, *groups])
    whole = sum(ratio)
    r = [x / whole for x in ratio]
    rows = df.withColumns({f"__group{i}": cell(F.col(f"`{c}`")) for i, c in enumerate(groups)} | ({"__order": shuffled(key, seed)} if shuffle else {}))
    held = [f"__group{i}" for i in range(len(groups))]
    rows = ordinals(rows, [*(["__order"] if shuffle else []), *key], "__at", held, "__size").drop(*held, "__order")
    train, val = F.floor(F.col("__size") * F.lit(r[0])), F.floor(F.col("__size") * F.lit(r[1]))
    at = F.col("__at")
    return rows.withColumn(out, F.when(at < train, "train").when(at < train + val, "val").otherwise("test")).drop("__at", "__size")


def cut_points(ratio: tuple[float, ...], total: int, have: list[int], left: int) -> list[float]:
    """Where to cut `left` rows of a tag, given the rows of it that each split has, so that each gets what it lacks of `total`."""
    lack = [max(0.0, total * (r / sum(ratio)) - h) for r, h in zip(ratio, have, strict=True)]
    return [left * (sum(lack[: i + 1]) / sum(lack)) for i in range(len(ratio) - 1)]


def split_tag_balanced(df: DataFrame, group: str, balance: list[str], ratio: tuple[float, float, float] = (0.8, 0.1, 0.1), filters: list[Mapping[str, Any]] | None = None, out: str = "split", rounds: int = ROUNDS) -> DataFrame:
    """Whole groups go to train, val or test so that every tag (column and value) comes near the ratio.

    Rows that the filters do not take are dropped; blank groups make one. A group belongs to its rarest tag. Tags take their turns,
    the rarest first (ties by name): a tag's groups are dealt out in the order of a hash, and the sequence is cut where each split
    has what it lacks of the tag, counting what it got with groups of rarer tags. A group goes where its middle row falls. The
    `rounds` - 1 most frequent tags have a round each, all rarer ones are dealt out at once before them. The result depends on
    nothing but the rows and `rounds`. The driver holds counters of at most `rounds` tags.
    """
    require_columns(df, [group, *balance])
    rows = df.where(conjunction(filters, TIER_B)).drop(out)
    gid = F.when(strip(cell(F.col(f"`{group}`"))) == "", MISSING).otherwise(strip(cell(F.col(f"`{group}`"))))
    rows = rows.withColumn("__g", gid)
    if not balance:
        return rows.withColumn(out, F.lit(SPLITS[ratio.index(max(ratio))])).drop("__g")
    tags = F.array(*(F.concat(F.lit(f"{c}_"), F.when(cell(F.col(f"`{c}`")) == "", "None").otherwise(cell(F.col(f"`{c}`")))) for c in balance))
    pairs = written(rows.select("__g", F.explode(tags).alias("t")).groupBy("__g", "t").agg(F.count("*").alias("n")), "pairs")
    totals = written(pairs.groupBy("t").agg(F.sum("n").alias("total")), "totals")
    frequent = sorted(((r.total, r.t) for r in totals.orderBy(F.desc("total"), F.desc("t")).limit(rounds - 1).collect()))  # rounds - 1 rows
    if not frequent:
        return rows.withColumn(out, F.lit(None).cast("string")).drop("__g")
    turn = {t: k for k, (_, t) in enumerate(frequent, 1)}
    known = rows.sparkSession.createDataFrame([(t, n, turn[t]) for n, t in frequent], "t string, total long, turn int")
    # What is frequent is looked up by broadcast; the rest has no tag with more than a `rounds`-th of the pairs.
    # Hashes come first in keys that are sorted by, as strings with a prefix in common take long to compare.
    hashed = lambda df: df.withColumn("__h", F.xxhash64("t"))
    others = hashed(pairs.join(F.broadcast(known.select("t")), "t", "left_anti")).join(hashed(totals), ["__h", "t"]).withColumn("turn", F.lit(0))
    ranked = pairs.join(F.broadcast(known), "t").select("__g", "t", "n", "total", "turn").unionByName(others.select("__g", "t", "n", "total", "turn"))
    own = F.min_by(F.struct("t", "n", "turn"), F.struct("turn", "total", "t"))
    later = F.collect_list(F.when(F.col("turn") > 0, F.struct("turn", "n")))  # a tag a round at most
    groups = ranked.groupBy(F.xxhash64("__g"), "__g").agg(own.alias("own"), later.alias("later")).select("__g", "own.*", "later", F.md5("__g").alias("__order"))
    placed = written(running_sums(groups, F.col("n"), ["__order", "__g"], "before", ["t"], "left").drop("__order"), "placed", by=("turn",))
    middle = F.col("before") + F.col("n") / 2
    have = {k: [0] * len(ratio) for k in turn.values()}
    here = split = _dealt_to(middle, [F.col("left") * F.lit(c) for c in cut_points(ratio, 1, [0] * len(ratio), 1)])
    for k in range(len(frequent) + 1):  # a small job each, over groups that no other round reads
        part = placed.where(F.col("turn") == k)
        if k:
            total = frequent[k - 1][0]
            here = _dealt_to(middle, [F.lit(c) for c in cut_points(ratio, total, have[k], total - sum(have[k]))]) if total > sum(have[k]) else F.lit(0)
            split = F.when(F.col("turn") == k, here).otherwise(split)
        counted = part.select(here.alias("s"), F.explode("later").alias("x")).groupBy("s", "x.turn").agg(F.sum("x.n").alias("n"))
        for r in counted.collect():  # a row for each tag to come and split
            have[r.turn][r.s] += r.n
    assigned = placed.select("__g", F.element_at(F.array(*map(F.lit, SPLITS)), split + 1).alias(out))
    return rows.join(assigned, "__g").drop("__g")


def _dealt_to(middle: Column, cuts: list[Column]) -> Column:
    out = F.lit(len(cuts))
    for k in reversed(range(len(cuts))):
        out = F.when(middle < cuts[k], k).otherwise(out)
    return out
