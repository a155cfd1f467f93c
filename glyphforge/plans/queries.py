"""Registered queries of the engine's own operators over the driver's tables, each with SQL that gives the same rows.

Stand-ins: parts are labelled texts (p_name, with predictions derived from it), line items are text rows and their boxes,
orders are scenes, page urls are paths, labels.quality and labels.toxic are tags. All tables are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.functions import geometry, hangul, text
from glyphforge.operators import columns, dedup, joins, paths, predicates, sampling, setops, stats
from glyphforge.plans import curate, evaluate, export
from glyphforge.plans.pipeline import Pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _six(c: Column) -> Column:
    return F.round(c, 6)


# ---- scoring -----------------------------------------------------------------------------------------------------------


def _preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    infer = F.when(k == 0, F.col("p_name")).when(k == 1, F.replace("p_name", F.lit("i"), F.lit(""))).when(k == 2, F.concat(F.lit("x"), "p_name")).otherwise(F.upper("p_name"))
    return table(spark, sf_dir, "part").select(F.concat(F.lit("part_"), "p_partkey").alias("text_id"), infer.alias("infer"), F.concat("p_brand", F.lit(" ")).alias("brand"))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels for every part but those of size 50."""
    return table(spark, sf_dir, "part").where("p_size < 50").select(F.concat(F.lit("part_"), "p_partkey").alias("text_id"), F.col("p_name").alias("label"), (F.col("p_size") > 25).cast("string").alias("is_large"), (F.col("p_type") == "PROMO").cast("string").alias("is_promo"))


_SCORED = """
with pred as (
  select 'part_' || p_partkey as text_id, case p_partkey % 4 when 0 then p_name when 1 then replace(p_name, 'i', '') when 2 then 'x' || p_name else upper(p_name) end as infer, p_brand from part),
gold as (select 'part_' || p_partkey as text_id, p_name as label, p_size > 25 as is_large, p_type = 'PROMO' as is_promo from part where p_size < 50),
s as (
  select p.text_id, p.infer, coalesce(g.label, '') as label, g.text_id is not null as known, is_large, is_promo, p_brand,
    replace(g.label, ' ', '') as a, replace(p.infer, ' ', '') as b
  from pred p left join gold g using (text_id)),
scored as (
  select *, case when known then cast(a = b as int) end as is_match,
    case when not known then null when a = b then 1.0::double else 1 - levenshtein(a, b)::double / greatest(length(a), 1, length(b)) end as sim
  from s)
"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.score_predictions(_preds(spark, sf_dir), _gold(spark, sf_dir), ["text_id"])


@query(_SCORED + "select text_id, infer, label, coalesce(is_match, -1) as is_match, round(coalesce(sim, -1), 6) as sim from scored")
def score_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("text_id", "infer", "label", F.coalesce("is_match", F.lit(-1)).alias("is_match"), _six(F.coalesce("gned_sim", F.lit(-1.0))).alias("sim"))


@query(_SCORED + "select count(is_match) as samples, round(avg(is_match), 6) as accuracy, round(avg(sim), 6) as sim from scored")
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.means(_scored(spark, sf_dir)).select("samples", _six(F.col("accuracy")).alias("accuracy"), _six(F.col("gned_sim")).alias("sim"))


@query(_SCORED + """, t as (select 'is_large' as tag, * from scored where is_large union all select 'is_promo', * from scored where is_promo),
k(tag) as (values ('is_large'), ('is_promo'))
select k.tag, count(t.is_match) as samples, round(avg(t.is_match), 6) as accuracy, round(avg(t.sim), 6) as sim from k left join t using (tag) group by k.tag""")  # fmt: skip
def eval_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = evaluate.means_by_tag(_scored(spark, sf_dir), _gold(spark, sf_dir), ["is_large", "is_promo"])
    return out.select("tag", "samples", _six(F.col("accuracy")).alias("accuracy"), _six(F.col("gned_sim")).alias("sim"))


@query(_SCORED + """select count(*) as inference, count(is_match) as matched, count(*) - count(is_match) as unmatched_infer,
 (select count(*) from gold where text_id not in (select text_id from pred)) as unmatched_dataset from scored""")  # fmt: skip
def eval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.coverage(_preds(spark, sf_dir), _gold(spark, sf_dir), ["text_id"])


@query("""with pred as (select doc_id from documents), gold as (select doc_id from labels)
select cast(doc_id as varchar) as text_id from pred where doc_id not in (select doc_id from gold)""")  # fmt: skip
def unmatched_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = lambda n: table(spark, sf_dir, n).select(F.col("doc_id").cast("string").alias("text_id"))
    return joins.uncovered(ids("documents"), ids("labels"))


_GRID = """
with src as (
  select p_partkey, p_name, p_size, 'part_' || p_partkey as text_id, case when p_partkey % 2 = 0 then 'even' else 'odd' end as source from part),
m(regime, model) as (values ('base', 'a'), ('base', 'b'), ('tuned', 'a')),
s as (
  select regime, model, source, text_id, p_size, replace(p_name, ' ', '') as a,
    replace(case model when 'a' then replace(p_name, 'i', '') else case regime when 'base' then upper(p_name) else p_name end end, ' ', '') as b from src, m),
scored as (
  select *, cast(a = b as int) as is_match, case when a = b then 1.0::double else 1 - levenshtein(a, b)::double / greatest(length(a), 1, length(b)) end as sim from s),
d(dataset, source) as (values ('even', 'even'), ('odd', 'odd'), ('all', 'even'), ('all', 'odd')),
r as (select *, '' as challenge from scored join d using (source) union all select *, 'large' from scored join d using (source) where p_size > 25)
select regime, model, dataset, challenge, count(*) as samples, round(avg(is_match), 6) as accuracy, round(avg(sim), 6) as sim from r group by all
"""


@query(_GRID)
def eval_grid_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_size", F.col("p_name").alias("label"), F.concat(F.lit("part_"), "p_partkey").alias("text_id"), F.when(F.col("p_partkey") % 2 == 0, "even").otherwise("odd").alias("source"))
    model_a = F.replace("label", F.lit("i"), F.lit(""))
    runs = [("base", "a", model_a), ("base", "b", F.upper("label")), ("tuned", "a", model_a)]
    preds = setops.union_sources({f"{r}/{m}": rows.withColumns({"regime": F.lit(r), "model": F.lit(m), "infer": e}) for r, m, e in runs}, "run")
    tags = rows.where("p_size > 25").select("source", "text_id", F.lit("large").alias("tag"))
    out = evaluate.grid_summary(evaluate.score(preds), {"even": ["even"], "odd": ["odd"], "all": ["even", "odd"]}, tags)
    return out.select("regime", "model", "dataset", "challenge", "samples", _six(F.col("accuracy")).alias("accuracy"), _six(F.col("gned_sim")).alias("sim"))


@query("""
with s as (
  select p_partkey, substr(p_name, 1, 2) || '□' || substr(p_name, 4) as label,
    case p_partkey % 3 when 0 then p_name when 1 then substr(p_name, 1, 2) || substr(p_name, 4) else p_name || 'ng' end as infer from part),
n as (select *, replace(label, ' ', '') as a, replace(infer, ' ', '') as b from s),
g as (select *, string_split(replace(a, '□', '□□□'), '') as g, string_split(b, '') as p from n),
d as (
  select *, list_reduce(g, lambda prev, t: list_reduce(range(1, len(p) + 1), lambda acc, j: list_append(acc, least(
      prev[j + 1] + case when t = '□' then 0 else 1 end, prev[j] + case when t = '□' or t = p[j] then 0 else 1 end, acc[-1] + 1)),
      [prev[1] + case when t = '□' then 0 else 1 end]), range(0, len(p) + 1))[-1] as dist from g)
select p_partkey, label, infer, cast(regexp_full_match(b, replace(a, '□', '.?')) as int) as is_match,
  round(1 - dist::double / greatest(len(list_filter(g, lambda x: x <> '□')), 1, len(p)), 6) as sim from d
""")
def score_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("p_name"), F.col("p_partkey") % 3
    rest = F.substring(n, 4, 1000)
    label = F.concat(F.substring(n, 1, 2), F.lit("□"), rest)
    infer = F.when(k == 0, n).when(k == 1, F.concat(F.substring(n, 1, 2), rest)).otherwise(F.concat(n, F.lit("ng")))
    out = evaluate.score(table(spark, sf_dir, "part").select("p_partkey", label.alias("label"), infer.alias("infer")))
    return out.select("p_partkey", "label", "infer", "is_match", _six(F.col("gned_sim")).alias("sim"))


_JAMO = """
with s as (
  select p_partkey, chr(44032 + cast(p_partkey * 37 % 11172 as int)) || chr(44032 + cast(p_partkey * 101 % 11172 as int)) as label,
    chr(44032 + cast(p_partkey * 37 % 11172 as int)) || chr(44032 + cast((p_partkey * 101 + p_partkey % 30) % 11172 as int)) as infer from part),
j as (
  select *, list_transform([label, infer], lambda w: array_to_string(list_transform(string_split(w, ''), lambda c:
    substr('ㄱㄲㄴㄷㄸㄹㅁㅂㅃㅅㅆㅇㅈㅉㅊㅋㅌㅍㅎ', (ord(c) - 44032) // 588 + 1, 1) || substr('ㅏㅐㅑㅒㅓㅔㅕㅖㅗㅘㅙㅚㅛㅜㅝㅞㅟㅠㅡㅢㅣ', (ord(c) - 44032) % 588 // 28 + 1, 1)
    || case when (ord(c) - 44032) % 28 > 0 then substr('ㄱㄲㄳㄴㄵㄶㄷㄹㄺㄻㄼㄽㄾㄿㅀㅁㅂㅄㅅㅆㅇㅈㅊㅋㅌㅍㅎ', (ord(c) - 44032) % 28, 1) else '' end), '')) as ls from s),
t as (select *, ls[1] as g, ls[2] as p, string_split(ls[1], '') as ga, string_split(ls[2], '') as pa from j),
d as (
  select *, list_reduce(ga, lambda prev, t: list_reduce(range(1, len(pa) + 1), lambda acc, j: list_append(acc, least(prev[j + 1] + 1, prev[j] + case when t = pa[j] then 0 else 1 end, acc[-1] + 1)),
      [prev[1] + 1]), range(0, len(pa) + 1))[-1] as dist from t)
select p_partkey, label, infer, g as letters, cast(label = infer as int) as is_match, round(1 - dist::double / greatest(len(ga), 1, len(pa)), 6) as sim from d
"""


@query(_JAMO)
def score_hangul_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    syllable = lambda n: F.decode(F.unhex(F.lpad(F.hex(44032 + n % 11172), 4, "0")), "UTF-16BE")
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k, F.concat(syllable(k * 37), syllable(k * 101)).alias("label"), F.concat(syllable(k * 37), syllable(k * 101 + k % 30)).alias("infer"))
    return evaluate.score(rows).select("p_partkey", "label", "infer", hangul.letters(F.col("label")).alias("letters"), "is_match", _six(F.col("gned_sim")).alias("sim"))


# ---- filters -----------------------------------------------------------------------------------------------------------


@query("select * exclude (o_orderdate) from orders where o_orderstatus in ('F', 'O') and o_orderpriority <> '5-LOW'")
def filter_dsl_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.filter_rows(table(spark, sf_dir, "orders"), [{"column": "o_orderstatus", "op": "in", "value": "F, O"}, {"column": "o_orderpriority", "op": "ne", "value": "5-LOW"}], predicates.TIER_A).drop("o_orderdate")


@query("select * exclude (l_shipdate) from lineitem where l_quantity > 25 and not (l_discount >= 0.05) and contains(l_returnflag, 'A')")
def filter_dsl_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.filter_rows(table(spark, sf_dir, "lineitem"), [{"column": "l_quantity", "op": "gt", "value": "25"}, {"column": "l_discount", "op": "gte", "value": 0.05, "exclude": True}, {"column": "l_returnflag", "op": "contains", "value": "A"}]).drop("l_shipdate")


@query(r"select doc_id, source from documents where regexp_matches(text, '\d+\.\d+\.\d+') and not regexp_matches(source, '^src1') and lang not in ('de')")
def filter_dsl_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [{"column": "text", "op": "regex", "value": r"\d+\.\d+\.\d+"}, {"column": "source", "op": "not_regex", "value": "^src1"}, {"column": "lang", "op": "not_in", "values": ["de"]}]
    return predicates.filter_rows(table(spark, sf_dir, "documents"), filters, predicates.TIER_C).select("doc_id", "source")


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text rows with boxes in JSON, some of them not sound."""
    q, k = F.col("l_quantity").cast("int"), F.col("l_partkey") % 7
    flat = lambda *v: F.concat(F.lit("["), F.concat_ws(", ", *(x.cast("string") for x in v)), F.lit("]"))
    x, y, w, h = q - 3, F.col("l_linenumber"), q + 5, F.col("l_suppkey").cast("int") % 9
    points = F.concat(F.lit("["), F.concat_ws(", ", flat(x, y), flat(x + w, y), flat(x + w, y + h), flat(x, y + h)), F.lit("]"))
    box = F.when(k == 0, "").when(k == 1, "none").when(k == 2, "[1, 2, \"a\", 4]").when(k == 3, points).otherwise(flat(x, y, w, h))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", box.alias("bbox"))


_BOXES = """
with b as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_partkey % 7 as k,
    cast(l_quantity as int) - 3 as x, l_linenumber as y, cast(l_quantity as int) + 5 as w, cast(l_suppkey as int) % 9 as h from lineitem),
v as (select *, k >= 3 as fmt from b)
"""


@query(_BOXES + """select case when k = 0 or k = 1 then 'bbox_none' when k in (2, 3) then 'invalid_bbox' else 'nonpositive_bbox' end as reason, count(*) as count
from v where k < 4 or w <= 0 or h <= 0 group by 1""")  # fmt: skip
def filter_drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumnsRenamed({"l_orderkey": "image_id", "l_partkey": "text"})
    return predicates.drop_outliers(rows)[1]


@query("""select case when contains(p_name, 'ring') then 'exclude_keywords' when regexp_matches(p_name, '[0-9]') then 'exclude_digit' else 'stays' end as reason, count(*) as count
from part where contains(p_name || ' ' || p_type, 'e') or contains(p_name || ' ' || p_type, 'ECO') group by 1
union all select 'include_keywords', count(*) from part where not (contains(p_name || ' ' || p_type, 'e') or contains(p_name || ' ' || p_type, 'ECO')) having count(*) > 0""")  # fmt: skip
def filter_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = predicates.keyword_reason(["p_name", "p_type"], ["e", "ECO"], ["ring"], ["digit"])
    return table(spark, sf_dir, "part").groupBy(F.coalesce(reason, F.lit("stays")).alias("reason")).agg(F.count("*").alias("count"))


@query("select url as value from pages where contains(url, 'blog') union all select url from pages where not contains(url, 'blog') and not lower(url) like '%.html'")
def filter_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    yes, no = predicates.split_lines_by_keyword(table(spark, sf_dir, "pages").select(F.col("url").alias("value")), "blog")
    return yes.unionByName(predicates.drop_by_keyword_or_extension(no, extensions=["HTML"]))


@query("""select p_partkey from part where p_brand = 'Brand#2' or (p_size >= 40 and p_type <> 'PROMO')""")
def filter_row_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumns({"big": F.initcap((F.col("p_size") >= 40).cast("string")), "promo": F.upper((F.col("p_type") == "PROMO").cast("string"))})
    return part.where(predicates.row_matches({"p_brand": "Brand#2"}) | predicates.row_matches({"big": True}, {"promo": True})).select("p_partkey")


# ---- columns -----------------------------------------------------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, l_partkey, l_suppkey, case when l_returnflag = 'A' then l_extendedprice / l_quantity else -1 end as ratio from lineitem""")
def arith_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = columns.arithmetic_column(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", "ratio", "/", [{"column": "l_returnflag", "op": "eq", "value": "A"}], None)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce("ratio", F.lit(-1.0)).alias("ratio"))


@query("""select p_partkey, round(case when p_size > 10 then sqrt(p_retailprice) * ln(p_size + 1.0) else floor(p_retailprice / 7.0) end + p_size - 3 * floor(p_size / 3.0), 6) as f,
 round(abs(p_size - 25) ** 2, 6) as g from part""")  # fmt: skip
def formula_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = columns.formula_column(table(spark, sf_dir, "part"), "f", "(sqrt(p_retailprice) * log(x + 1) if x > 10 else p_retailprice // 7) + x % 3", "p_size", None, None)
    return columns.formula_column(part, "g", "abs(p_size - 25) ** 2", None, None, None).select("p_partkey", _six(F.col("f")).alias("f"), _six(F.col("g")).alias("g"))


@query("select o_orderkey, case when o_totalprice > 250000 and o_orderstatus in ('F', 'P') then o_orderpriority else 'none' end as mark from orders")
def fill_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = [{"column": "o_totalprice", "op": "gt", "value": 250000}, {"column": "o_orderstatus", "op": "in", "value": ["F", "P"]}]
    return columns.fill_column(table(spark, sf_dir, "orders"), "mark", filters, source="o_orderpriority", default="none").select("o_orderkey", "mark")


@query("select p_partkey, p_brand || '-' || p_type || '-' || p_size as code from part")
def join_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.join_columns(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"], "code", "-").select("p_partkey", "code")


@query("""select p_partkey as part_id, p_name, 'x' as mark, round(p_size * 2.0, 6) as twice from part where p_size >= 10 and contains(p_name, 'e')""")
def table_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [
        {"op": "filter", "column": "p_size", "filter_op": "gte", "value": 10}, {"op": "filter", "column": "p_name", "filter_op": "contains", "value": "e"},
        {"op": "assign_constant", "column": "mark", "value": "x"}, {"op": "assign_formula", "out_column": "twice", "formula": "p_size * 2", "precision": 6},
        {"op": "rename_columns", "mapping": {"p_partkey": "part_id", "nothing": "here"}}, {"op": "select_columns", "columns": ["part_id", "p_name", "mark", "twice"]},
        {"op": "sort_values", "by": ["p_name", "part_id"], "ascending": [True, False]},
    ]
    return columns.apply_operations(table(spark, sf_dir, "part"), steps)


@query(r"select doc_id, cast(length(text) as int) as chars, cast(length(regexp_replace(text, '\s', '', 'g')) as int) as solid from documents")
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = columns.text_length_column(columns.text_length_column(table(spark, sf_dir, "documents"), "text", "chars"), "text", "solid", True)
    return out.select("doc_id", "chars", "solid")


@query(r"""
with c as (
  select p_partkey, list_transform(string_split(t, ''), lambda x: case when x = ' ' then null when regexp_matches(x, '[A-Za-z]') then 'ENG' when regexp_matches(x, '[0-9]') then 'DIGIT'
    when ord(x) between 44032 and 55203 then 'KOR' else 'SPECIAL' end) as k
  from (select p_partkey, case p_partkey % 3 when 0 then p_brand || chr(44032 + cast(p_partkey % 11172 as int)) when 1 then p_name else chr(44032) || p_name end as t from part)),
o as (select p_partkey, unnest(['ENG', 'DIGIT', 'KOR', 'SPECIAL']) as kind, k from c)
select p_partkey, string_agg(kind, '+' order by list_position(k, kind)) as language from o where list_contains(k, kind) group by p_partkey
""")
def language_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    syllable = lambda n: F.decode(F.unhex(F.lpad(F.hex(44032 + n % 11172), 4, "0")), "UTF-16BE")
    k = F.col("p_partkey")
    t = F.when(k % 3 == 0, F.concat("p_brand", syllable(k))).when(k % 3 == 1, F.col("p_name")).otherwise(F.concat(syllable(F.lit(0)), "p_name"))
    return columns.language_category_column(table(spark, sf_dir, "part").withColumn("t", t), "t", "language").select("p_partkey", "language")


@query(r"""
with w as (select regexp_matches(p_name || ' ' || p_brand, '\s') as spaced, unnest(string_split(p_name || ' ' || p_brand, ' ')) as word from part)
select case when regexp_matches(word, '[A-Za-z]') then 'english_plus' else 'others' end as "group", count(*) as total_count from w where word <> '' group by 1
""")
def word_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.word_group_totals(table(spark, sf_dir, "part").withColumn("t", F.concat_ws(" ", "p_name", "p_brand")), "t")


@query(_BOXES + "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, fmt as is_valid_bbox_format, not (fmt and (x < 0 or y < 0 or w <= 0 or h <= 0)) as is_valid_bbox_value from v")
def bbox_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.validate_bbox(_boxes(spark, sf_dir)).drop("bbox")


@query(_BOXES + "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, cast(w as double) as width, cast(h as double) as height from v where fmt")
def bbox_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir)
    return columns.bbox_size_columns(rows.where(predicates.box_is_readable("bbox"))).drop("bbox")


@query(_BOXES + "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, case when w >= h then floor(w / h) else -floor(h / w) end::bigint as bin from (select * exclude (w, h), w::double as w, h::double as h from v) where fmt and h > 0")
def aspect_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = columns.bbox_size_columns(_boxes(spark, sf_dir).where(predicates.box_is_readable("bbox"))).where("height > 0")
    out = columns.aspect_bin_column(columns.arithmetic_column(rows, precision=None), out="bin")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "bin")


@query(_BOXES + """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, case when fmt then array_to_string([x, y, x + w, y, x + w, y + h, x, y + h], ' ') else '' end as points from v""")
def bbox_to_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = F.transform(F.flatten(geometry.bbox_to_points(F.col("bbox"))), lambda v: v.cast("int").cast("string"))
    return _boxes(spark, sf_dir).withColumn("points", F.coalesce(F.array_join(flat, " "), F.lit(""))).drop("bbox")


@query(_BOXES + "select count(*) as n, sum(w)::bigint as width, sum(h)::bigint as height from v where fmt and h > 0")
def points_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).select(geometry.points_size(F.col("bbox")).alias("s")).where("s is not null")
    return rows.agg(F.count("*").alias("n"), F.sum("s.width").alias("width"), F.sum("s.height").alias("height"))


@query(_BOXES + """select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, greatest(0, least(x, 29)) as "left", greatest(0, least(y, 4)) as top,
 greatest(greatest(0, least(x, 29)) + 1, least(x + w, 30)) as "right", greatest(greatest(0, least(y, 4)) + 1, least(y + h, 5)) as bottom from v where fmt""")  # fmt: skip
def crop_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _boxes(spark, sf_dir).withColumns({"width": F.lit("30"), "height": F.lit("5")})
    out = columns.crop_geometry(rows).where("crop is not null")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", *(F.col(f"crop.{c}").cast("int").alias(c) for c in ("left", "top", "right", "bottom")))


@query("select event_id, value > 2 and value < 12 and user_id % 20 > 3 and user_id % 20 < 15 as inside from events")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    square = F.array(*(F.array(F.lit(x), F.lit(y)) for x, y in ((2.0, 3.0), (12.0, 3.0), (12.0, 15.0), (2.0, 15.0))))
    # Points on the left and lower edges count as inside by the ray's parity; they are moved off the edge.
    inside = geometry.point_in_polygon(F.when(F.col("value") == 2, 1.0).otherwise(F.col("value")), F.when(F.col("user_id") % 20 == 3, 1.0).otherwise((F.col("user_id") % 20).cast("double")), square)
    return table(spark, sf_dir, "events").select("event_id", inside.alias("inside"))


@query("select page_id, array_to_string(list_filter(string_split(url, '/'), lambda x: x <> '')[1:3], '/') as prefix from pages")
def path_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.path_prefix_column(table(spark, sf_dir, "pages"), "url", "prefix", 3).select("page_id", "prefix")


@query(r"""select page_id, regexp_replace(n, '(.)\.[^.]+$', '\1') as stem from (select page_id, regexp_extract(rtrim(url, '/'), '([^/]*)$', 1) as n from pages)""")
def path_stem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.file_stem(F.col("url")).alias("stem"))


@query("select page_id, case when starts_with(url, 'http://') then 'plain' || substr(url, 6) else url end as url from pages")
def path_prefix_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.replace_path_prefix(table(spark, sf_dir, "pages"), "url", "http:", "plain").select("page_id", "url")


@query("select l_orderkey, l_linenumber, l_partkey, 'text_images/' || (l_orderkey // 1000) || '/aihub_' || l_orderkey || '_' || l_linenumber || '.jpg' as image_path from lineitem")
def bucket_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumns({"scene_id": text.prefixed_id(F.col("l_orderkey"), "aihub_")}).withColumn("text_id", text.text_id(F.col("scene_id"), F.col("l_linenumber")))
    return columns.image_path_column(rows, "scene_id", "text_id", root="text_images").select("l_orderkey", "l_linenumber", "l_partkey", "image_path")


@query(r"""select coalesce(nullif(regexp_extract(regexp_extract(url, '([^/]*)$', 1), '.(\.[^.]+)$', 1), ''), '(no_ext)') as extension, count(*) as count from pages group by 1""")
def ext_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.extension_counts(table(spark, sf_dir, "pages"), "url")


@query(r"""select page_id, regexp_replace(url, '(.)\.html$', '\1.htm') as value from pages""")
def ext_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.remap_extensions(table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("value")), {"HTML": "htm"})


# ---- duplicates, distributions, variances ------------------------------------------------------------------------------


@query("select doc_id, lang, source from (select *, row_number() over (partition by text order by doc_id) as k from documents) where k = 1")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.md5("text").alias("h"), "text")
    return dedup.drop_duplicates(docs, ["text"], ["doc_id"]).select("doc_id", "lang", "source")


@query("select o_orderkey, o_custkey from (select *, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as k from orders) where k = 1")
def dedup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicate_ids(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_custkey")


@query("select doc_id, count(*) over (partition by text) = 1 as is_valid from documents")
def dedup_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_flag(table(spark, sf_dir, "documents").select("doc_id", "text"), ["text"]).select("doc_id", "is_valid")


@query("""
with v as (select 'text' as "column", text as value from documents union all select 'source', source from documents union all select 'doc_id', cast(doc_id as varchar) from documents),
c as (select "column", value, count(*) as n from v group by all)
select "column", sum(n)::bigint as row_count, coalesce(sum(n) filter (value <> ''), 0)::bigint as non_empty_count, count(*) as unique_value_count, count(*) filter (n > 1) as duplicate_value_count,
  coalesce(sum(n - 1) filter (n > 1), 0)::bigint as duplicate_row_count, coalesce(sum(n - 1) filter (n > 1), 0) = 0 as is_unique from c group by 1
""")
def dup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_report(table(spark, sf_dir, "documents"), ["text", "source", "doc_id"])


@query("select p_partkey, p_brand || case when k > 1 then '_' || (k - 1) else '' end as p_brand from (select *, row_number() over (partition by p_brand order by p_partkey) as k from part)")
def unique_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.unique_suffix(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", ["p_partkey"])


@query("""select 'event_type' as "column", coalesce(nullif(event_type, ''), '<EMPTY>') as value, count(*) as count from events group by 2
union all select 'props', coalesce(nullif(props, ''), '<EMPTY>'), count(*) from events group by 2""")  # fmt: skip
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.value_distribution(table(spark, sf_dir, "events"), ["event_type", "props"])


_CHARS = r"""
with c as (select unnest(string_split(text, '')) as character from documents),
n as (select character, count(*) as n from c where character <> '' group by 1),
k as (
  select *, case when character in (' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(28), chr(29), chr(30), chr(31), chr(133), chr(160), chr(12288)) then 'space'
    when ord(character) between 44032 and 55203 or ord(character) between 4352 and 4607 or ord(character) between 12592 and 12687 then 'korean'
    when regexp_matches(character, '^[A-Za-z]$') then 'english' when regexp_matches(character, '^[\p{Nd}²³¹]$') then 'digit'
    when regexp_matches(character, '^[\p{P}\p{S}]$') then 'special' else 'other' end as category from n)
"""


@query(_CHARS + "select category, character, n as count from k")
def char_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.char_counts(table(spark, sf_dir, "documents"), "text")


@query(_CHARS + ", f(category) as (values ('korean'), ('english'), ('digit'), ('special'), ('space'), ('other')) select category, coalesce(sum(n), 0)::bigint as total_count from f left join k using (category) group by 1")
def char_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.category_totals(table(spark, sf_dir, "documents"), "text")


@query(r"with w as (select unnest(regexp_split_to_array(text, '\s+')) as word from documents) select cast(length(word) as int) as word_length, count(*) as word_count from w where word <> '' group by 1")
def word_length_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.word_lengths(table(spark, sf_dir, "documents"), "text")


@query(r"""with w as (select lower(unnest(string_split(p_name, ' '))) as word from part)
select 'english_plus' as "group", word, count(*) as count from w where word <> '' group by 2""")  # fmt: skip
def word_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.label_statistics(table(spark, sf_dir, "part"), "p_name", lowercase=True)["words"]


@query("""select count(*) as count, min(l_extendedprice) as min, max(l_extendedprice) as max, round(avg(l_extendedprice), 4) as mean,
 round(var_pop(l_extendedprice), 0) as variance_population, round(var_samp(l_extendedprice), 0) as variance_sample from lineitem""")  # fmt: skip
def variance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.variance(table(spark, sf_dir, "lineitem"), "l_extendedprice")
    return out.withColumns({"mean": F.round("mean", 4), "variance_population": F.round("variance_population", 0), "variance_sample": F.round("variance_sample", 0)})


@query("""
with b(bin_index, bin_left, bin_right) as (values ('0', 0.5::double, 10::double), ('1', 10, 20), ('2', 20, 40), ('below_min', null, 0.5), ('above_max', 40, null)),
n as (select case when l_quantity < 0.5 then 'below_min' when l_quantity > 40 then 'above_max' when l_quantity < 10 then '0' when l_quantity < 20 then '1' else '2' end as bin_index, count(*) as n from lineitem group by 1)
select bin_index, bin_left, bin_right, coalesce(n, 0) as count from b left join n using (bin_index)
""")
def histogram_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", [-2, 10, 20, 40])


@query("""with c as (select event_type, count(*) as n from events group by 1)
select count(*) as category_count, sum(n)::bigint as total_count, round(avg(n), 6) as mean_frequency, round(var_pop(n), 3) as variance_population, round(var_samp(n), 3) as variance_sample from c""")  # fmt: skip
def freq_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.frequency_variance(table(spark, sf_dir, "events"), "event_type")
    return out.withColumns({"mean_frequency": _six(F.col("mean_frequency")), "variance_population": F.round("variance_population", 3), "variance_sample": F.round("variance_sample", 3)})


@query("""with a as (select o_orderpriority as value, count(*) as n from orders where o_orderstatus = 'F' group by 1), b as (select o_orderpriority as value, count(*) as n from orders where o_orderstatus = 'O' group by 1)
select value, coalesce(a.n, 0) as left_count, coalesce(b.n, 0) as right_count from a full join b using (value) where coalesce(a.n, 0) <> coalesce(b.n, 0)""")  # fmt: skip
def count_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return stats.count_differences(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'"), "o_orderpriority")


# ---- joins and sets ----------------------------------------------------------------------------------------------------


@query("""with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) as k from orders)
select c_custkey, coalesce(o_orderpriority, '') as o_orderpriority, coalesce(o_orderstatus, c_mktsegment) as c_mktsegment from customer left join o on o_custkey = c_custkey and k = 1""")  # fmt: skip
def merge_scene_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("c_mktsegment", F.col("o_orderstatus"))
    out = joins.merge_columns(table(spark, sf_dir, "customer"), orders, ["o_orderpriority", "c_mktsegment"], ["o_orderkey"], "o_custkey", "c_custkey")
    return out.select("c_custkey", "o_orderpriority", "c_mktsegment")


@query("""with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) as k from orders)
select c_custkey, coalesce(o_orderstatus, '') as o_orderstatus, case when o_custkey is null then 'missing_scene' else 'ok' end as scene_status from customer left join o on o_custkey = c_custkey and k = 1""")  # fmt: skip
def scene_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scenes = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "scene_id")
    out = joins.attach_scene(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "scene_id"), scenes, ["o_orderkey"], ["o_orderstatus"])
    return out.select(F.col("scene_id").alias("c_custkey"), F.coalesce("o_orderstatus", F.lit("")).alias("o_orderstatus"), "scene_status")


@query("""select documents.doc_id, case when labels.doc_id is null then source when quality = 1 then 'train' else '' end as split, case when toxic = 1 then 'toxic' else lang end as label
from documents left join labels on documents.doc_id = labels.doc_id""")  # fmt: skip
def apply_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("split"), F.col("lang").alias("label"))
    patch = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "train").otherwise("").alias("split"), F.when(F.col("toxic") == 1, "toxic").otherwise("").alias("label"))
    return joins.apply_patch(docs, patch, ["doc_id"], "doc_id")


@query("select (select count(*) from documents) as rows, count(*) as matched, (select count(*) from labels where doc_id not in (select doc_id from documents)) as unmatched_patch_ids from documents join labels using (doc_id)")
def patch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.patch_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id")


@query("""select doc_id, doc_id not in (select doc_id from labels where toxic = 1) as is_valid_crop, case when doc_id in (select doc_id from labels where quality = 1) then 'good' else lang end as mark from documents""")
def mark_by_id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    out = joins.mark_members(table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("mark")), labels.where("toxic = 1"), "doc_id", "doc_id", "is_valid_crop", member=False)
    return joins.fill_members(out, labels.where("quality = 1"), "doc_id", "doc_id", "mark", "good").select("doc_id", "is_valid_crop", "mark")


_PAIRS = r"""
with p as (select regexp_replace(url, '[?#].*$', '') as u from pages),
i as (select u as image_file, replace(replace(u, '/en/', '/xx/'), 'http:', 'https:') as m from p where not u like '%.html'),
l as (select replace(u, '/en/', '/xx/') as m from p where not contains(u, '/de/')),
a as (select *, row_number() over (partition by m order by image_file) as k from i),
b as (select *, row_number() over (partition by m order by m) as k from l)
"""


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    u = F.regexp_replace("url", r"[?#].*$", "")
    p = table(spark, sf_dir, "pages").select(u.alias("value"))
    return p.where(~F.col("value").endswith(".html")), p.where(~F.contains("value", F.lit("/de/"))).select(F.replace("value", F.lit("/en/"), F.lit("/xx/")).alias("value"))


_MAPPING = {"/en/": "/xx/", "http:": "https:"}


@query(_PAIRS + "select image_file, b.m as label_file from a join b using (m, k)")
def pair_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.pair_paths(*_listings(spark, sf_dir), _MAPPING)


@query(_PAIRS + """, x as (select m from i), y as (select m from l)
select 'image' as side, m as path from (select * from x except all select * from y) union all select 'label', m from (select * from y except all select * from x)""")  # fmt: skip
def multiset_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.unpaired_paths(*_listings(spark, sf_dir), _MAPPING).select("side", "path")


@query(_PAIRS + "select coalesce(sum(least(x.n, y.n)), 0)::bigint as matched_count from (select m, count(*) as n from i group by 1) x join (select m, count(*) as n from l group by 1) y using (m)")
def multiset_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, labels = _listings(spark, sf_dir)
    mapped = images.select(text.keyword_mapping(F.col("value"), _MAPPING).alias("value"))
    return setops.multiset_intersection_size(mapped, labels, "value")


@query(r"select regexp_replace(url, '[?#].*$', '') as value from pages where not regexp_replace(url, '[?#].*$', '') in (select replace(regexp_replace(url, '[?#].*$', ''), '/en/', '/xx/') from pages where not contains(regexp_replace(url, '[?#].*$', ''), '/de/')) and not regexp_replace(url, '[?#].*$', '') like '%.html'")
def path_subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.subtract_lines(*_listings(spark, sf_dir))


@query("""with a as (select distinct o_custkey as value from orders where o_orderstatus = 'F'), b as (select distinct o_custkey as value from orders where o_orderstatus = 'P')
select 'left_only' as side, value from a where value not in (select value from b) union all select 'right_only', value from b where value not in (select value from a)""")  # fmt: skip
def set_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return setops.set_differences(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'P'"), "o_custkey")


@query("""select 'customer' as source, c_name as name, cast(c_nationkey as varchar) as nation, c_mktsegment as segment from customer
union all select 'supplier', s_name, cast(s_nationkey as varchar), '' from supplier""")  # fmt: skip
def union_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.lit("customer").alias("source"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("source"), F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"))
    return setops.union_tables([a, b])


_RULES = [("https:/", "secure"), ("http:/", "plain"), ("http://spam-farm.example.org", "spam"), ("https://spam-farm.example.org/en", "spam/english")]


@query(r"""with p as (select page_id, regexp_replace(regexp_replace(url, '/+$', ''), '://', '://') as u from pages),
r(o, t) as (values ('https:/', 'secure'), ('http:/', 'plain'), ('http://spam-farm.example.org', 'spam'), ('https://spam-farm.example.org/en', 'spam/english')),
m as (select p.page_id, u, t || substr(u, length(o) + 1) as v, row_number() over (partition by page_id order by length(o) desc) as k from p join r on u = o or starts_with(u, o || '/'))
select p.page_id, coalesce(m.v, p.u) as url, m.v is not null as remapped from p left join m on m.page_id = p.page_id and k = 1""")  # fmt: skip
def longest_prefix_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(_RULES, "origin_path string, new_path string")
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "/+$", "").alias("url"))
    return joins.longest_prefix(pages, rules, "url").select("page_id", "url", "remapped")


@query(r"""with p as (select distinct regexp_replace(url, '[?#].*$', '') as u from pages),
n as (select u, row_number() over (order by u) as k from p),
e as (select *, 'id_' || lpad(cast(k + 99 as varchar), cast(greatest(6, length(cast(k + 99 as varchar))) as int), '0') as name, regexp_extract(regexp_extract(u, '([^/]*)$', 1), '.(\.[^.]+)$', 1) as ext from n)
select u as origin_path, regexp_extract(u, '^(.*/)', 1) || name || ext as new_path from e
union all select u || '.json', regexp_extract(u, '^(.*/)', 1) || name || '.json' from e where not u like '%/'
union all select u || '.json', u || name from e where u like '%/'""")  # fmt: skip
def global_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.regexp_replace("url", r"[?#].*$", "")
    pairs = table(spark, sf_dir, "pages").select(u.alias("image_file")).distinct().withColumn("label_file", F.concat("image_file", F.lit(".json")))
    return columns.rename_map(pairs, ["image_file"], start=100, padding=6, prefix="id_")


@query(r"""with p as (select url as origin_path, replace(url, '/en/', '/english/') as new_path from pages),
w as (select new_path, count(distinct origin_path) as n from p group by 1)
select origin_path, p.new_path, case when origin_path = p.new_path then 'unchanged' when w.n > 1 or p.new_path in (select url from pages) then 'conflict' else 'rename' end as status from p join w using (new_path)""")  # fmt: skip
def path_mapping_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("value"))
    mapping = pages.select(F.col("value").alias("origin_path"), F.replace("value", F.lit("/en/"), F.lit("/english/")).alias("new_path"))
    return paths.mapping_status(mapping, pages)


@query(r"""with f as (select page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) as n from pages), k as (select *, row_number() over (partition by n order by page_id) as k from f)
select page_id, 'out/' || case when k = 1 then n else regexp_replace(n, '(.)\.[^.]+$', '\1') || '_' || (k - 1) || regexp_extract(n, '.(\.[^.]+)$', 1) end as dst from k""")  # fmt: skip
def copy_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat("page_id", F.lit("|"), F.regexp_replace("url", r"[?#].*$", "")).alias("p"))
    plan = paths.copy_manifest(pages.withColumn("p", F.concat(F.split_part("p", F.lit("|"), F.lit(2)), F.lit(""))).withColumn("src", F.concat("page_id", F.lit("/"), F.regexp_extract("p", "([^/]*)$", 1))), "src", ["page_id"], "out")
    return plan.select(F.split_part("src", F.lit("/"), F.lit(1)).cast("long").alias("page_id"), "dst")


# ---- composites --------------------------------------------------------------------------------------------------------


def _documents_of_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    images = orders.select(F.col("o_orderkey").cast("string").alias("image_id"), F.concat(F.lit("images/"), "o_orderkey", F.lit(".jpg")).alias("image_file"), F.lit("640").alias("width"), F.lit("480").alias("height"), F.col("o_orderdate").cast("date").cast("string").alias("data_captured_date"), F.col("o_orderpriority").alias("light"))
    boxes = _boxes(spark, sf_dir)
    return images, boxes.select(F.col("l_orderkey").cast("string").alias("image_id"), F.col("l_linenumber").cast("string").alias("inner_ann_id"), F.concat(F.lit("text "), "l_partkey").alias("text"), "bbox")


@query("select 'aihub_' || o_orderkey as scene_id, 'aihub' as origin_dataset, 'images/' || o_orderkey || '.jpg' as image_path, 'images/' || o_orderkey || '.jpg' as origin_image_path, '640' as width, '480' as height, cast(o_orderdate::date as varchar) as data_captured_date, o_orderpriority as light from orders")
def scene_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.scene_table(_documents_of_labels(spark, sf_dir)[0])


@query(_BOXES + """, t as (
  select 'aihub_' || l_orderkey || '_' || l_linenumber as text_id, l_orderkey, 'text ' || l_partkey as label, fmt, not (fmt and (x < 0 or y < 0 or w <= 0 or h <= 0)) as ok from v)
select text_id, count(*) as n from t group by 1""")  # fmt: skip
def text_table_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.text_table(_documents_of_labels(spark, sf_dir)[1]).groupBy("text_id").agg(F.count("*").alias("n"))


@query(_BOXES + """, t as (
  select distinct on (l_orderkey, l_linenumber) 'aihub_' || l_orderkey || '_' || l_linenumber as text_id, l_orderkey from v)
select text_id, 'aihub_' || l_orderkey as scene_id, 'text_images/' || (l_orderkey // 1000) || '/' || text_id || '.jpg' as image_path, 'ENG+DIGIT' as language_category, l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F') as is_valid_crop from t""")  # fmt: skip
def standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    images, annotations = _documents_of_labels(spark, sf_dir)
    failed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.concat(F.lit("aihub_"), "o_orderkey").alias("scene"))
    _, texts = curate.standardise(images, annotations)
    return joins.mark_members(texts, failed, "scene_id", "scene", "is_valid_crop", member=False).select("text_id", "scene_id", "image_path", "language_category", "is_valid_crop")


@query("""select doc_id, unnest(list_filter([case when quality = 1 then 'quality' end, case when toxic = 1 then 'toxic' end], lambda x: x is not null)) as tag from labels""")
def explode_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("doc_id", F.col("doc_id").cast("string"))
    return joins.tag_rows(labels, ["quality", "toxic"], "doc_id").select(F.col("doc_id").cast("long").alias("doc_id"), "tag")


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    return table(spark, sf_dir, "part").select(
        F.when(k < 2, " Train").when(k == 2, "VAL").when(k == 3, "test").otherwise("").alias("split"),
        F.concat(F.lit("/data/text_images/"), F.floor(F.col("p_partkey") / 1000), F.lit("/aihub_"), "p_partkey", F.lit(".jpg")).alias("image_path"),
        F.when(F.col("p_size") == 7, "  ").otherwise(F.col("p_name")).alias("label"),
        F.when(F.col("p_size") > 40, "").otherwise(F.concat(F.lit("[0.5, 1, "), F.col("p_size"), F.lit(", 10]"))).alias("points"),
        (F.col("p_type") != "PROMO").cast("string").alias("is_only_korean"), F.when(F.col("p_size") == 8, "").otherwise((F.col("p_size") == 9).cast("string")).alias("is_illegible"),
        (F.col("p_size") > 25).cast("string").alias("KSTR_is_curve"), (F.col("p_brand") == "Brand#2").cast("string").alias("KSTR_is_artistic"),
    )


_EXPORT = """
with e as (
  select p_size, p_brand, case when p_partkey % 5 < 2 then 'train' when p_partkey % 5 = 2 then 'val' when p_partkey % 5 = 3 then 'test' end as split, (p_partkey // 1000) || '/aihub_' || p_partkey || '.jpg' || chr(9) || p_name as line,
    (p_partkey // 1000) || '/' || p_partkey || '.jpg' as filename, p_name from part where p_partkey % 5 < 4 and p_size not in (7, 8, 9) and p_type <> 'PROMO')
"""


@query(_EXPORT + "select split, line from e")
def export_split_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.split_lines(_exported(spark, sf_dir), korean_only=True)


@query(_EXPORT + "select 'KSTR_is_curve' as tag, line from e where p_size > 25 union all select 'KSTR_is_artistic', line from e where p_brand = 'Brand#2'")
def export_tag_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return export.tag_lines(_exported(spark, sf_dir), korean_only=True)


@query(_EXPORT + """select filename, p_name as "text", cast(case when p_size % 2 = 0 then p_size else p_size + 1 end as bigint) as width, 10::bigint as height from e where p_size <= 40""")
def export_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = export.export_rows(_exported(spark, sf_dir), korean_only=True).where("json is not null")
    return rows.select(F.from_json("json", "filename string, text string, width long, height long").alias("j")).select("j.*")


@query("""with s as (select doc_id, lang, row_number() over (partition by lang order by md5('42|' || doc_id), cast(doc_id as varchar)) as k, count(*) over (partition by lang) as n from documents)
select doc_id, lang, case when k <= floor(n * (0.8::double / (0.8::double + 0.1::double + 0.1::double))) then 'train' when k <= floor(n * (0.8::double / (0.8::double + 0.1::double + 0.1::double))) + floor(n * (0.1::double / (0.8::double + 0.1::double + 0.1::double))) then 'val' else 'test' end as split from s""")  # fmt: skip
def split_ratio_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.split_by_ratio(table(spark, sf_dir, "documents").select("doc_id", "lang"), ["doc_id"], ["lang"])


@query("""select * from (select c_name as name, cast(c_nationkey as varchar) as nation from customer order by md5('7|' || c_name), c_name limit 10)
union all select * from (select s_name, cast(s_nationkey as varchar) from supplier order by md5('7|' || s_name), s_name limit 5)""")  # fmt: skip
def sample_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("nation"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").cast("string").alias("nation"))
    return sampling.sample_merge([a, b], [2, 1], 15, ["name"], seed=7)


@query("select o_orderkey, o_custkey from orders qualify row_number() over (order by md5('3|' || o_orderkey), o_orderkey) <= (select count(*) // 2 from orders)")
def sample_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of all orders, found by counts of digits; a hundred rows at most are gathered."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sampling.take(orders, orders.count() // 2, ["o_orderkey"], seed=3, gather=100)


def _split_sql() -> str:
    """The rounds of the split written out: two columns of three and two values make five tags."""
    ctes = ["""
p as (select cast(l_orderkey as varchar) as g, t, count(*) as n from (
  select l_orderkey, 'l_returnflag_' || l_returnflag as t from lineitem union all select l_orderkey, 'l_linestatus_' || l_linestatus from lineitem) group by all),
k as (select t, sum(n) as total, row_number() over (order by sum(n), t) as turn from p group by t),
w as (select p.*, k.total, k.turn, min(k.turn) over (partition by g) as own from p join k using (t)),
b as (select g, own, n, total, coalesce(sum(n) over (partition by own order by md5(g), g rows between unbounded preceding and 1 preceding), 0) as before, sum(n) over (partition by own) as rest from w where turn = own),
s0 as (select '' as g, 0 as s where false)"""]
    for k in range(1, 6):
        ctes.append(f"""
h{k} as (select coalesce(sum(n) filter (s = 0), 0) as a, coalesce(sum(n) filter (s = 1), 0) as b, coalesce(sum(n) filter (s = 2), 0) as c from w join s{k - 1} using (g) where turn = {k}),
l{k} as (select greatest(0.0::double, total * (0.8::double / 1.0::double) - a) as x, greatest(0.0::double, total * (0.1::double / 1.0::double) - h{k}.b) as y, greatest(0.0::double, total * (0.1::double / 1.0::double) - c) as z from h{k}, k where turn = {k}),
s{k} as (
  select * from s{k - 1} union all
  select g, case when before + n / 2.0::double < rest * (x / (x + y + z)) then 0 when before + n / 2.0::double < rest * ((x + y) / (x + y + z)) then 1 else 2 end from b, l{k} where own = {k})""")
    return "with" + ",".join(ctes) + " select l_orderkey, l_linenumber, l_returnflag, l_linestatus, case s when 0 then 'train' when 1 then 'val' else 'test' end as split from lineitem join s5 on cast(l_orderkey as varchar) = g"


@query(_split_sql())
def split_tag_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return sampling.split_tag_balanced(rows, "l_orderkey", ["l_returnflag", "l_linestatus"])


@query("""select p_partkey, p_name, cast(length(p_name) as int) as text_length, 'ENG' as language from part where contains(p_name, 'e') and p_size > 10 and p_name not like '%ring%'""")
def named_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Pipeline("parts")
    p.add("filter", lambda d: predicates.filter_rows(d, [{"column": "p_name", "op": "contains", "value": "e"}, {"column": "p_size", "op": "gt", "value": 10}]))
    p.add("drop", lambda d: predicates.drop_by_keyword_or_extension(d, ["ring"], column="p_name"))
    p.add("length", lambda d: columns.text_length_column(d, "p_name"))
    p.add("skipped", lambda d: d.limit(0), enabled=False)
    p.add("language", lambda d: columns.language_category_column(d, "p_name", "language"))
    return p.run(table(spark, sf_dir, "part")).select("p_partkey", "p_name", "text_length", "language")
