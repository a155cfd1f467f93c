"""More registered queries: tables written by the sinks and read back, folder listings, path plans, splits and their balance.

Files go to the folder that driver and executors share, each query's to one of its own.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.functions import geometry, text
from glyphforge.operators import columns, dedup, joins, paths, predicates, sampling, setops, stats
from glyphforge.plans import curate, evaluate, export
from glyphforge.plans.pipeline import Pipeline
from glyphforge.plans.queries import _BOXES, _SCORED, _boxes, _documents_of_labels, _exported, _EXPORT, _scored, _six, query, table
from glyphforge.sources import csv_ranges, readers, sinks
from glyphforge.sources.scratch import delete_later, shared_dir, written


def _place(spark: SparkSession, name: str) -> str:
    """A path in a folder of its own, which goes when the driver ends."""
    folder = f"{shared_dir(spark)}/glyphforge-files-{uuid.uuid4().hex}"
    delete_later(spark, folder)
    return f"{folder}/{name}"


# ---- readers and sinks -------------------------------------------------------------------------------------------------


@query("""select cast(c_custkey as varchar) as id, c_name || ', "' || c_mktsegment || '"' || chr(10) || 'x' as note, coalesce(nullif(c_mktsegment, 'BUILDING'), '') as segment from customer""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.concat("c_name", F.lit(', "'), "c_mktsegment", F.lit('"\nx'))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), note.alias("note"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    path = _place(spark, "customers.csv")
    sinks.write_csv(rows, path, ["id"], ["id", "note", "segment"])
    sinks.write_csv(readers.read_csv(spark, path), path, ["id"], ["id", "note", "segment"])  # in place
    return readers.read_csv(spark, path)


@query("""select cast(doc_id as varchar) as doc_id, coalesce(text, '') || chr(10) || '"' || coalesce(lang, '') || '", ' || doc_id as note, coalesce(source, '') as source from documents""")
def csv_by_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as one CSV file, read in nine ranges (in more of RANGE_BYTES, where those would be larger), most of
    which begin inside a quoted cell."""
    note = F.concat(F.coalesce("text", F.lit("")), F.lit('\n"'), F.coalesce("lang", F.lit("")), F.lit('", '), "doc_id")
    path = _place(spark, "documents.csv")
    sinks.write_csv(table(spark, sf_dir, "documents").select("doc_id", note.alias("note"), "source"), path, ["doc_id"], ["doc_id", "note", "source"])
    size = spark.read.format("binaryFile").load(path).select("length").collect()[0]["length"]  # one file
    return readers.read_csv(spark, path, range_bytes=min(size // 8, csv_ranges.RANGE_BYTES))


@query("select 'part_' || p_partkey as text_id, p_name as infer from part")
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("a/b/part_"), "p_partkey", F.lit(".jpg")).alias("image_path"), F.col("p_name").alias("label"))
    path = _place(spark, "predictions.txt")
    sinks.write_lines(sinks.label_lines(rows), path, F.col("line"), ["p_partkey"])
    return readers.read_predictions(spark, path).drop(readers.ORDINAL)


@query("select 'part_' || p_partkey as text_id, p_name as infer from part where p_size >= 10")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = lambda *xy: F.concat(F.lit("["), F.concat_ws(", ", *xy), F.lit("]"))
    zero, size = F.lit("0"), F.col("p_size").cast("string")
    points = F.concat(F.lit("["), F.concat_ws(", ", side(zero, zero), side(size, zero), side(size, size), side(zero, size)), F.lit("]"))
    rows = table(spark, sf_dir, "part").where("p_size >= 10").withColumn("json", sinks.label_json(F.concat(F.lit("part_"), "p_partkey", F.lit(".jpg")), F.col("p_name"), points))
    path = _place(spark, "predictions.jsonl")
    sinks.write_lines(rows, path, F.col("json"), ["p_partkey"])
    return readers.read_predictions(spark, path).drop(readers.ORDINAL)


@query("""select p_brand || '/한글 ' || p_partkey || '.txt' as member, strlen(p_name) as size, p_name as content from part where p_size % 5 > 0""")
def archive_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts as members of three archives, read by a task for every hundred; every fifth would leave its folder and is left out."""
    part = table(spark, sf_dir, "part").repartition(3, "p_partkey")
    folder = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("../"), "p_brand")).otherwise(F.col("p_brand"))
    path = _place(spark, "archives")
    sinks.write_archives(part, path, F.concat(folder, F.lit("/한글 "), "p_partkey", F.lit(".txt")), F.col("p_name"))
    return readers.read_archives(spark, path, contents=True, members=100).select("member", "size", F.col("content").cast("string").alias("content"))


@query("select distinct replace(url, '://', '/') as value from pages where url is not null and trim(url) <> ''")
def line_list_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "pages").where("url is not null").select(F.replace("url", F.lit("://"), F.lit("\\")).alias("value")).distinct()
    path = _place(spark, "paths.txt")
    sinks.write_lines(lines, path, F.concat(F.lit("  "), "value"), ["value"], "\r\n", "\r\n")
    return readers.read_lines(spark, path)


def _label_files(spark: SparkSession, sf_dir: str) -> str:
    """A label document for every nation, each a file in a folder of its own."""
    pair = lambda k, v: F.concat(F.lit(f'"{k}": "'), v, F.lit('"'))
    key = F.col("n_nationkey").cast("string")
    doc = F.concat(F.lit('{"images": [{"width": '), key, F.lit(', "height": 7, '), pair("date_captured", F.lit("2020")), F.lit('}], "metadata": {'), pair("light", F.col("n_name")), F.lit('}, "annotations": ['), F.lit('{"id": '), key, F.lit(", "), pair("text", F.col("n_name")), F.lit(', "bbox": [1, 2, 3, '), key, F.lit(']}, {"text": "no id"}]}'))
    path = _place(spark, "labels")
    table(spark, sf_dir, "nation").select(doc.alias("value"), F.col("n_nationkey").alias("n")).write.partitionBy("n").text(path)
    return path


@query("select cast(n_nationkey as varchar) as width, '7' as height, '2020' as data_captured_date, n_name as light from nation")
def label_json_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.images_of(readers.read_label_json(spark, f"{_label_files(spark, sf_dir)}/*/*.txt")).drop("image_id", "label_file")


@query("select cast(n_nationkey as varchar) as inner_ann_id, n_name as text, '[1,2,3,' || n_nationkey || ']' as bbox from nation")
def label_json_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = readers.annotations_of(readers.read_label_json(spark, f"{_label_files(spark, sf_dir)}/*/*.txt")).drop("image_id")
    return found.withColumn("bbox", F.regexp_replace("bbox", r"\s", ""))


@query("select 'n=' || n_nationkey as value from nation")
def folder_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.leaf_dirs(readers.list_files(spark, _label_files(spark, sf_dir), ["txt"]))


@query("select distinct 'part_' || p_partkey as text_id from part where p_size % 3 < 2")
def image_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.element_at(F.array(F.lit(".JPG"), F.lit(".png"), F.lit(".json")), F.col("p_size") % 3 + 1)
    return readers.image_ids(table(spark, sf_dir, "part").select(F.concat(F.lit("x/part_"), "p_partkey", ext).alias("value")))


@query(_SCORED + "select 'samples' as metric, cast(count(*) as varchar) as value from scored union all select 'matches', cast(coalesce(sum(is_match), 0) as varchar) from scored")
def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _scored(spark, sf_dir).agg(F.count("*").alias("samples"), F.coalesce(F.sum(evaluate.MATCH), F.lit(0)).alias("matches"))
    path = _place(spark, "report.csv")
    sinks.write_csv(stats.metric_rows(totals), path, ["metric"], ["metric", "value"])
    return readers.read_csv(spark, path)


@query(_SCORED + "select count(*) as samples, round(coalesce(sum(is_match), 0) / greatest(count(*), 1), 6) as accuracy, round(coalesce(sum(sim), 0) / greatest(count(*), 1), 6) as sim from scored where known")
def eval_file_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _scored(spark, sf_dir).where(F.col(evaluate.MATCH).isNotNull())
    return evaluate.file_means(known).select("samples", _six(F.col("accuracy")).alias("accuracy"), _six(F.col(evaluate.SIMILARITY)).alias("sim"))


# ---- paths, lines, cells -----------------------------------------------------------------------------------------------


_DIRS = """
with f as (select p_brand || '/' || p_type || '/' || p_partkey as f from part),
d as (select distinct p_brand as path from part union all select p_brand || '/' || p_type from part union all select f from f union all select 'empty/' || r_name from region union all select 'gone/' || r_name from region),
s as (select path, case when path in (select f from f) then 'not_dir' when path like 'empty/%' then 'empty' when path like 'gone/%' then 'missing' else 'exists' end as status from d)
"""


def _dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, region = table(spark, sf_dir, "part"), table(spark, sf_dir, "region")
    files = part.select(F.concat_ws("/", "p_brand", "p_type", "p_partkey").alias("value"))
    known = region.select(F.concat(F.lit("empty/"), "r_name").alias("value"))
    dirs = part.select(F.col("p_brand").alias("value")).distinct().union(part.select(F.concat_ws("/", "p_brand", "p_type"))).union(files).union(known).union(region.select(F.concat(F.lit("gone/"), "r_name")))
    return paths.dir_status(dirs, files, known)


@query(_DIRS + "select count(*) filter (status = 'exists') as \"exists\", count(*) filter (status = 'empty') as empty, count(*) filter (status = 'missing') as missing, count(*) filter (status = 'not_dir') as not_dir, count(*) as total from s")
def dir_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.status_counts(_dirs(spark, sf_dir))


@query(_DIRS + "select path, status from s where status <> 'empty'")
def dirs_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setops.partition_by_status(_dirs(spark, sf_dir))[1]


@query("select 'c/' || c_custkey as origin_path, c_nationkey || '/' || c_custkey as new_path from customer")
def mapped_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    old = F.concat(F.lit("c\\"), "c_custkey")
    mapping = customer.select(old.alias("origin_path"), F.concat_ws("/", "c_nationkey", "c_custkey").alias("new_path"))
    return joins.mapped_dirs(customer.select(old.alias("value")), mapping.union(mapping))


@query("select cast(c_custkey as bigint) as _ord, c_name as src, 'new/' || c_custkey as dst from customer")
def zip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").withColumn("_ord", F.col("c_custkey"))
    return joins.zip_lines(customer.select("_ord", F.col("c_name").alias("value")), customer.select("_ord", F.concat(F.lit("new/"), "c_custkey").alias("value")))


@query("select s_name as value from supplier where s_nationkey in (select n_nationkey from nation)")
def listed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    lines = supplier.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select(F.col("s_name").alias("value"))
    return predicates.assert_listed(lines, supplier.select("s_name"))


@query("""select p_partkey, case p_partkey % 3 when 0 then p_name else '' end as shown, case when p_retailprice = floor(p_retailprice) then cast(cast(p_retailprice as bigint) as varchar) end as whole, p_brand as key from part""")
def cell_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 3
    shown = text.to_text(F.when(k == 0, F.concat(F.lit("  "), "p_name", F.lit(" "))).when(k == 1, F.lit(" NaN ")).otherwise(F.lit("none")))
    whole = F.when(F.col("p_retailprice") == F.floor("p_retailprice"), text.format_number(F.col("p_retailprice")))
    return table(spark, sf_dir, "part").select("p_partkey", shown.alias("shown"), whole.alias("whole"), text.before_colon(F.concat("p_brand", F.lit(" : "), "p_type", F.lit(":x"))).alias("key"))


@query(_BOXES + "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, x + w / 2.0::double as cx, y + h / 2.0::double as cy, w::double as w, h::double as h from v where fmt")
def box_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The box as a polygon, as a box again, and as its centre."""
    b = geometry.parse_bbox(F.col("bbox"))
    rows = _boxes(spark, sf_dir).where(predicates.box_is_readable("bbox")).withColumn("b", b)
    rows = rows.withColumn("b", geometry.polygon_to_xywh(geometry.xywh_to_polygon(*(F.col(f"b.{k}") for k in "xywh"))))
    # Boxes without height or width come back as they were: their corners coincide.
    return rows.withColumn("c", geometry.xywh_to_centered(*(F.col(f"b.{k}") for k in "xywh"))).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "c.*")


@query("select p_partkey, p_name from part order by p_partkey limit 10")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", dedup.int_order(F.col("p_partkey").cast("string")).alias("n"))
    return dedup.first_rows(part, ["n"], 10).drop("n")


# ---- curation as a whole -----------------------------------------------------------------------------------------------


@query("""with u as (select distinct regexp_replace(url, '[?#].*$', '') as u from pages where url is not null and not contains(regexp_replace(url, '[?#].*$', ''), '/fr/')),
p as (select u, row_number() over (order by u) as k from u where not contains(u, '/es/')),
e as (select u, regexp_extract(regexp_extract(u, '([^/]*)$', 1), '.(\\.[^.]+)$', 1) as ext, 'id_' || lpad(cast(k as varchar), cast(greatest(6, length(cast(k as varchar))) as int), '0') as name from p)
select 'img/' || u as origin_path, 'img/' || regexp_extract(u, '^(.*/)', 1) || name || ext as new_path from e
union all select 'lab/' || u, 'lab/' || regexp_extract(u, '^(.*/)', 1) || name || ext from e
""")
def path_hygiene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images are all page addresses, labels those without /es/; both without /fr/: pairs get a running number for a name."""
    u = table(spark, sf_dir, "pages").where("url is not null").select(F.regexp_replace("url", r"[?#].*$", "").alias("u")).distinct()
    images, labels = (u.select(F.concat(F.lit(side), "u").alias("value")) for side in ("img/", "lab/"))
    found = curate.path_hygiene(images, labels.where("not contains(value, '/es/')"), {"img/": "lab/"}, ["/fr/"])
    numbered = curate.c.rename_map(found["pairs"], ["image_file"], start=1, padding=6, prefix="id_")
    return numbered.unionByName(found["mapping"].limit(0))


@query("select 'l_returnflag_' || l_returnflag as tag, count(*) as rows, true as balanced from lineitem group by 1")
def tag_split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tag-balanced split by what it promises: whole orders, and every tag within a fiftieth of the ratio."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus")
    out = sampling.split_tag_balanced(rows, "l_orderkey", ["l_returnflag", "l_linestatus"])
    whole = out.groupBy("l_orderkey").agg(F.count_distinct("split").alias("n")).agg(F.coalesce(F.max("n") == 1, F.lit(True)).alias("whole"))
    near = [F.abs(F.count_if(F.col("split") == s) / F.count("*") - r) < 0.02 for s, r in (("train", 0.8), ("val", 0.1), ("test", 0.1))]
    shares = out.groupBy(F.concat(F.lit("l_returnflag_"), "l_returnflag").alias("tag")).agg(F.count("*").alias("rows"), (near[0] & near[1] & near[2]).alias("near"))
    return shares.crossJoin(F.broadcast(whole)).select("tag", "rows", (F.col("near") & F.col("whole")).alias("balanced"))  # one row


@query(_BOXES + """, p as (
  select *, 'text ' || l_partkey as label, case when fmt then '[[' || x::double || ',' || y::double || '],[' || (x + w)::double || ',' || y::double || '],[' || (x + w)::double || ',' || (y + h)::double || '],[' || x::double || ',' || (y + h)::double || ']]' else '' end as points from v),
t as (select * exclude (k), row_number() over (partition by l_orderkey, l_linenumber order by label, points) as k from p)
select 'aihub_' || l_orderkey as scene_id, count(*) as texts, 1::bigint as splits from t where t.k = 1 and fmt and x >= 0 and y >= 0 and w > 0 and h > 0 group by 1""")
def curate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated texts split by whole scenes: texts of each scene, and the number of splits that hold them."""
    images, annotations = _documents_of_labels(spark, sf_dir)
    scenes, texts = curate.standardise(images, annotations)
    out = curate.split(texts, scenes, ["text_id"])
    return out.groupBy("scene_id").agg(F.count_distinct("text_id").alias("texts"), F.count_distinct("split").alias("splits"))


@query("""select 'part_' || p_partkey as text_id, case when p_partkey % 2 = 0 then upper(p_name) else p_name end as label, case when p_partkey % 2 = 0 then 'val' else '' end as split from part""")
def curate_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("text_id", F.concat(F.lit("part_"), "p_partkey"))
    texts = part.select("text_id", F.lit("s").alias("scene_id"), F.col("p_name").alias("label"), F.lit("").alias("split"))
    last = part.where("p_partkey % 2 = 0").select("text_id", F.upper("p_name").alias("label"), F.lit("val").alias("split"), F.lit(2).alias("n"))
    updates = last.union(last.select("text_id", F.lit("old"), F.lit("test"), F.lit(1)))
    return curate.patch(texts, updates, ["n"]).select("text_id", "label", "split")


@query(_EXPORT + "select 'KSTR_is_curve' as tag, split_part(split_part(line, chr(9), 1), '/', 2) as image, split_part(line, chr(9), 2) as label from e where p_size > 25 union all select 'KSTR_is_artistic', split_part(split_part(line, chr(9), 1), '/', 2), split_part(line, chr(9), 2) from e where p_brand = 'Brand#2'")
def tag_lists_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of every challenge tag, written as one folder a tag and read back."""
    path = _place(spark, "tags")
    export.tag_lines(_exported(spark, sf_dir), korean_only=True).withColumnRenamed("line", "value").write.partitionBy("tag").text(path)
    back = spark.read.text(path)
    image, label = F.split_part("value", F.lit("\t"), F.lit(1)), F.split_part("value", F.lit("\t"), F.lit(2))
    return back.select("tag", F.regexp_extract(image, "([^/]*)$", 1).alias("image"), label.alias("label"))


_MOVES = """
with c as (select c_custkey as k, c_custkey % 10 as r, 'd/' || c_custkey as src from customer)
select 5 - r as stage, src, 'd/' || (k + 1) as dst, 'move' as status from c where r < 5
union all select 1, src, src || '.moving', 'move' from c where r = 6 union all select 3, src || '.moving', 'd/' || (k + 1), 'move' from c where r = 6
union all select 2, src, 'd/' || (k - 1), 'move' from c where r = 7 union all select null, src, 'd/' || (k + 1), 'conflict' from c where r = 8
union all select null, src, 'e', 'missing' from c where r = 5
"""


@query("select coalesce(stage, 0)::int as stage, src, dst, status from (" + _MOVES + ")")
def move_plan_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in tens: a chain of five moves, a source that is missing, a circle of two, and a target that stays."""
    customer = table(spark, sf_dir, "customer").withColumn("r", F.col("c_custkey") % 10)
    name = lambda k: F.concat(F.lit("d/"), k)
    key = F.col("c_custkey")
    target = F.when(F.col("r") == 5, "e").when(F.col("r") == 7, name(key - 1)).otherwise(name(key + 1))
    mapping = customer.where("r < 9").select(name(key).alias("origin_path"), target.alias("new_path"))
    return paths.move_plan(mapping, customer.where("r <> 5").select(name(key).alias("value"))).select(F.coalesce("stage", F.lit(0)).alias("stage"), "src", "dst", "status")


_LISTED = """
with p as (select 'in/' || p_brand || '/' || p_type || '/' || p_partkey as path, p_brand as b, p_type as t, p_partkey as k from part)
select case when t = 'PROMO' then 'promo/' || b || '/' || k when b = 'Brand#1' then 'first/' || t || '/' || k else path end as value from p
"""


@query(_LISTED)
def path_list_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list of all parts under the longest rule that fits: of a brand and type, or of a brand."""
    part = table(spark, sf_dir, "part")
    brand, kind = F.concat(F.lit("in/"), "p_brand"), F.concat(F.lit("in/"), "p_brand", F.lit("/"), "p_type")
    rules = part.where("p_type = 'PROMO'").select(kind.alias("origin_path"), F.concat(F.lit("promo/"), "p_brand").alias("new_path")).distinct()
    rules = rules.union(part.where("p_brand = 'Brand#1'").select(brand, F.lit("first")).distinct())
    listed = part.select(F.concat(kind, F.lit("/"), "p_partkey").alias("value"))
    return paths.remap_path_list(listed, rules)[0].select("value")


@query("select row_number() over (order by p_size desc, p_partkey) - 1 as place, p_partkey, p_size from part")
def sorted_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted by two columns, falling and rising; each row carries its place, so that the order is compared."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    done = columns.apply_operations(part, [{"op": "sort_values", "by": ["p_size", "p_partkey"], "ascending": [False, True]}])
    placed = written(done.withColumn("at", F.monotonically_increasing_id()), "sorted")
    return columns.ordinals(placed, ["at"], "place").select("place", "p_partkey", "p_size")


@query("select 'copy/' || p_partkey || '.txt' as value from part where p_size % 3 = 0 union all select 'move/' || p_partkey || '.txt' from part where p_size % 3 = 1")
def files_copied_moved_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file for every part: a third is copied and its source deleted, a third moved, the others deleted by a guarded plan; what is
    left is listed."""
    name = F.concat("p_partkey", F.lit(".txt"))
    # Sources lie in 64 folders, as tasks that make files in one folder wait for each other.
    source = F.concat(F.lit("in/"), F.pmod(F.hash("p_partkey"), F.lit(64)), F.lit("/"), name)
    part = table(spark, sf_dir, "part").select(name.alias("name"), source.alias("source"), (F.col("p_size") % 3).alias("r"))
    root = _place(spark, "tree")
    local = root.removeprefix("file://")
    given = written(part, "names")

    def made(frames):
        for k in range(64):
            os.makedirs(f"{local}/in/{k}", exist_ok=True)
        for f in frames:
            for n, source in zip(f["name"], f["source"], strict=True):
                with open(f"{local}/{source}", "w") as out:
                    out.write(n)
            yield f[["name"]]

    paths.dealt(given).mapInPandas(made, "name string").write.format("noop").mode("overwrite").save()
    for operation, r in (("copy", 0), ("move", 1)):
        plan = given.where(F.col("r") == r).select(F.col("source").alias("src"), F.concat(F.lit(operation + "/"), "name").alias("dst"))
        paths.apply_plan(plan, operation, local, local, dry_run=False).write.format("noop").mode("overwrite").save()
    gone = paths.deletion_plan(given.where("r <> 1").select(F.col("source").alias("value")), must_be_under="in", protected=["copy"])
    paths.apply_plan(gone.where("status = 'delete'").select(F.col("path").alias("src")), "delete", local, dry_run=False).write.format("noop").mode("overwrite").save()
    return readers.list_files(spark, root)


# ---- counters of steps -------------------------------------------------------------------------------------------------


_STEPS = """
with f as (select * from customer where c_acctbal > 0),
l as (select f.*, n_name from f left join (select * from nation where n_regionkey < 3) n on n_nationkey = c_nationkey),
p as (select c_custkey, case when c_mktsegment = 'BUILDING' then 'BUILD' else c_mktsegment end as segment, coalesce(n_name, '') as nation from l),
d as (select distinct segment, nation from p)
select 'input' as step, 'rows' as counter, count(*) as value from customer
union all select 'filter', 'rows', count(*) from f union all select 'filter', 'dropped', (select count(*) from customer) - count(*) from f
union all select 'lookup', 'rows', count(*) from l union all select 'lookup', 'matched', count(n_name) from l union all select 'lookup', 'dropped', 0
union all select 'patch', 'rows', count(*) from l union all select 'patch', 'updated', count(*) filter (c_mktsegment = 'BUILDING') from l union all select 'patch', 'dropped', 0
union all select 'fill', 'rows', count(*) from l union all select 'fill', 'filled', count(*) filter (n_name is null) from l union all select 'fill', 'dropped', 0
union all select 'distinct', 'rows', count(*) from d union all select 'distinct', 'dropped', (select count(*) from p) - count(*) from d
"""


@query(_STEPS)
def step_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five steps on the customers; one action reads the result, and all counters come with it."""
    nation = table(spark, sf_dir, "nation").where("n_regionkey < 3")
    steps = Pipeline("customers")
    steps.add("filter", lambda d: d.where("c_acctbal > 0"))
    steps.add("lookup", lambda d: d.join(nation, F.col("n_nationkey") == F.col("c_nationkey"), "left"), counters={"matched": "n_name is not null"})
    patched = F.when(F.col("c_mktsegment") == "BUILDING", "BUILD").otherwise(F.col("c_mktsegment"))
    steps.add("patch", lambda d: d.withColumn("segment", patched), counters={"updated": "segment <> c_mktsegment"}, drop=("c_mktsegment",))
    steps.add("fill", lambda d: d.withColumn("nation", F.coalesce("n_name", F.lit(""))), counters={"filled": "n_name is null"}, drop=("n_name",))
    steps.add("distinct", lambda d: d.select("segment", "nation").distinct())
    steps.run(table(spark, sf_dir, "customer"), count=True).write.format("noop").mode("overwrite").save()
    return steps.summary_frame(spark)
