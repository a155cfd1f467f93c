"""URL filters as a sort-merge range join.

A host's labels, reversed and each ended by a dot, make a key under which a domain and all its subdomains are one interval:
a rule for example.com is the interval from `com.example.` to `com.example/` (the character after the dot). Pages and
rules are cut into ranges of keys at the same bounds, a rule going to every range that its interval meets; within a range
both are sorted by key, and one sweep keeps the stack of rules whose intervals are open. Intervals of domains are nested or
disjoint, so the stack is the chain of domains above a page; the longest of its rules whose path fits gives the verdict.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Pages of a range, about, ranges at most (beyond, ranges grow), and keys sampled for each bound: so the driver's sample is bounded.
RANGE, MOST_RANGES, SAMPLED = 200_000, 4096, 20
#: Verdict of pages that no rule fits.
OTHERWISE = "allow"
#: (host, path, verdict) of the registered query.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or #, A-Z lower-cased; empty if null or without ://."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty if null or without ://."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: Column) -> Column:
    """www.example.com as com.example.www. ; an empty host has an empty key, which no rule's interval holds."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit(".")))


def filter_urls(pages: DataFrame, rules: DataFrame, otherwise: str = OTHERWISE) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    pages: page_id, url; rules: host, path, verdict; other columns are not looked at. A rule fits its host and all subdomains
    if the page's path starts with the rule's; of several the longest host and path wins, then the smallest verdict. Rules
    with a null are left out, repeated rules count once. rule is host and path of the rule, null if none fits; the verdict is
    then `otherwise`. A null url, or one without ://, has an empty host and path, which no rule fits. A null page_id stays
    null; repeated pages are judged alike. Empty tables are fine on either side.
    """
    spark = pages.sparkSession
    work = Workspace(spark, "urls")
    url = F.col("url").cast("string")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    pages = work.write(pages.withColumns({"key": key_of(F.col("host")), "tie": F.xxhash64("path", "page_id")}), "pages")
    rules = rules.select(F.translate(F.col("host"), UPPER, LOWER).alias("host"), F.col("path").alias("path"), F.col("verdict").alias("verdict")).where("host <> '' and path is not null and verdict is not null")
    rules = rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict")).withColumn("key", key_of(F.col("host")))
    # Bounds only balance the work, so a sample of keys does for them; ties within a host are broken by a hash of the page.
    count = pages.count()
    wanted = min(MOST_RANGES, max(1, count // RANGE))
    share = min(1.0, 2.0 * SAMPLED * wanted / max(1, count))
    sample = sorted((r.key, r.tie) for r in pages.select("key", "tie").sample(share, 1).limit(4 * SAMPLED * wanted).collect())
    wanted = max(wanted, spark.sparkContext.defaultParallelism) if count else 1
    bounds = sorted({sample[len(sample) * i // wanted] for i in range(1, wanted)}) if sample else []
    held = spark.sparkContext.broadcast(bounds)  # one entry a range
    low = -(1 << 63)

    def place_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [bisect.bisect_right(held.value, x) for x in zip(b.column("key").to_pylist(), b.column("tie").to_pylist(), strict=True)]
            yield pa.record_batch({"part": pa.array(got, pa.int32()), "key": b.column("key"), "kind": pa.array([1] * b.num_rows, pa.int32()), "page_id": b.column("page_id"), "host": b.column("host"), "path": b.column("path"), "verdict": pa.nulls(b.num_rows, pa.string())})

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, host, path, verdict in zip(*(b.column(c).to_pylist() for c in ("key", "host", "path", "verdict")), strict=True):
                first, last = bisect.bisect_right(held.value, (key, low)), bisect.bisect_right(held.value, (key[:-1] + "/", low))
                rows += [(part, key, 0, None, host, path, verdict) for part in range(first, last + 1)]
            names = ("part", "key", "kind", "page_id", "host", "path", "verdict")
            kinds = (pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=list(names))

    schema = "part int, key string, kind int, page_id long, host string, path string, verdict string"
    placed = pages.mapInArrow(place_pages, schema).unionByName(rules.mapInArrow(place_rules, schema))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []  # stack: (key, {path: (verdict, host)}, lengths of the paths), each key a prefix of the next
        for b in batches:
            out: list[tuple] = []
            for p, key, kind, page_id, host, path, verdict in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != part:
                    part, stack = p, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, {}, []))
                    stack[-1][1][path] = (verdict, host)
                    if len(path) not in stack[-1][2]:
                        bisect.insort(stack[-1][2], len(path))
                    continue
                best = None
                for _, rules_here, lengths in stack:
                    # Of one host the longest path that begins the page's: a lookup for each length, however many rules.
                    for n in reversed(lengths[: bisect.bisect_right(lengths, len(path))]):
                        found = rules_here.get(path[:n])
                        if found is not None:
                            said, rule_host = found
                            if best is None or len(rule_host) + n >= best[0]:
                                best = (len(rule_host) + n, rule_host + path[:n], said)
                            break
                out.append((page_id, host, path, best[1] if best else None, best[2] if best else otherwise))
            if out:
                kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
                yield pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["page_id", "host", "path", "rule", "verdict"])

    dealt = placed.repartition(max(1, len(bounds) + 1), "part").sortWithinPartitions("part", "key", "kind")
    return dealt.mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by RULES."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


OP8_SQL = """
with p as (
  select page_id,
    case when url like '%://%' then translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when url like '%://%' then regexp_extract(url, '://[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
r(rhost, rpath, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m as (
  select p.page_id, p.host, p.path, r.rhost || r.rpath as rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.rhost || r.rpath) desc nulls last) as k
  from p left join r on (p.host = r.rhost or p.host like '%.' || r.rhost) and starts_with(p.path, r.rpath))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from m where k = 1
"""
