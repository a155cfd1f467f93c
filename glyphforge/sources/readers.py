"""Readers: CSV, prediction TSV and JSONL, label JSON, line lists, folder listings, archives.

Every cell is a string and never null; schemas are given, not inferred.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, file_stem, slashes, strip
from glyphforge.sources import archives, csv_ranges, listing
from glyphforge.sources.scratch import ship

ORDINAL = "_ord"
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".bmp", ".webp", ".tif", ".tiff")


def _ordered(df: DataFrame) -> DataFrame:
    """Rows numbered as they stand: by file, then by place; increasing, not gapless."""
    return df.withColumn(ORDINAL, F.monotonically_increasing_id())


_CSV = dict(multiLine=True, escape='"', quote='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def read_csv(spark: SparkSession, path: str, ordinal: bool = False, range_bytes: int = csv_ranges.RANGE_BYTES) -> DataFrame:
    """Header, quotes doubled, line breaks inside quotes; a byte-order mark is passed over; blanks and missing cells are ''.

    Rows end with LF or CRLF; line breaks inside quotes stay as they are. A file is read by a task for every range_bytes
    (`csv_ranges`); the file of the first name, in order, gives the columns' names.
    """
    df = spark.read.options(header=True, **_CSV).csv(path)
    names = [c.lstrip("\ufeff") for c in df.columns]
    rows = csv_ranges.rows_of(spark, path, range_bytes)
    text = F.when(F.endswith("text", F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(F.col("text"))
    cells = F.from_csv(text, ", ".join(f"c{k} string" for k in range(max(1, len(names)))), {k: str(v) for k, v in _CSV.items()})
    named = lambda: (cell(F.col(f"cells.c{k}")).alias(n) for k, n in enumerate(names))
    body = rows.where(~((F.col("start") == 0) & (F.col("row") == 0)) & (text != ""))
    if not ordinal:
        return body.select(cells.alias("cells")).select(*named())
    files = rows.select("file").distinct().select("file", F.row_number().over(Window.orderBy("file")).alias("at"))  # a row a file
    place = (F.col("at") * F.lit(1 << 44) + F.col("start") + F.col("row")).alias(ORDINAL)
    return body.join(files, "file").select(cells.alias("cells"), place).select(*named(), ORDINAL)


def read_lines(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    """`value`, one trimmed path with forward slashes a line; blank lines are passed over."""
    df = spark.read.text(path)
    df = _ordered(df) if ordinal else df
    return df.withColumn("value", slashes(F.regexp_replace("value", "^\ufeff", ""))).where("value <> ''")


def _failing(ok, said: str, value):
    return F.when(ok, value).otherwise(F.raise_error(F.concat(F.lit(said), F.input_file_name())).cast("string"))


def read_predictions_txt(spark: SparkSession, path: str) -> DataFrame:
    """text_id and infer of `path<TAB>text` lines, cut at the first tab; a line without one raises when read."""
    line = F.regexp_replace("value", "^\ufeff", "")
    df = _ordered(spark.read.text(path)).where(strip(line) != "")
    at = F.instr(line, "\t")
    image = _failing(at > 0, "no tab in a line of ", F.substring(line, F.lit(1), at - 1))
    return df.select(file_stem(image).alias("text_id"), strip(F.substring(line, at + 1, F.length(line))).alias("infer"), ORDINAL)


def read_predictions_jsonl(spark: SparkSession, path: str, path_key: str = "filename", infer_key: str = "text") -> DataFrame:
    """S3: text_id and infer of JSON objects, one a line; null counts as ''; a line that is none, or lacks a key, raises when read."""
    line = F.regexp_replace("value", "^\ufeff", "")
    df = _ordered(spark.read.text(path)).where(strip(line) != "")
    m = F.from_json(line, "map<string,string>")
    ok = m.isNotNull() & F.map_contains_key(m, path_key) & F.map_contains_key(m, infer_key)
    return df.select(file_stem(_failing(ok, "bad object or key in ", F.coalesce(F.try_element_at(m, F.lit(path_key)), F.lit("")))).alias("text_id"), strip(F.coalesce(F.try_element_at(m, F.lit(infer_key)), F.lit(""))).alias("infer"), ORDINAL)


def read_predictions(spark: SparkSession, path: str, path_key: str = "filename", infer_key: str = "text") -> DataFrame:
    """By suffix .txt, .jsonl or .csv."""
    low = path.lower().rstrip("/")
    if low.endswith(".txt"):
        return read_predictions_txt(spark, path)
    if low.endswith(".jsonl"):
        return read_predictions_jsonl(spark, path, path_key, infer_key)
    if low.endswith(".csv"):
        return read_csv(spark, path, ordinal=True)
    raise ValueError(f"unknown prediction format: {path}")


LABEL_SCHEMA = "images array<struct<width:string,height:string,date_captured:string>>, metadata map<string,string>, annotations array<struct<id:string,text:string,bbox:string>>"


def read_label_json(spark: SparkSession, path: str) -> DataFrame:
    """One row a label file: label_file, the parsed document (null if it is none)."""
    whole = spark.read.option("wholetext", True).text(path)
    return whole.select(F.col("_metadata.file_path").alias("label_file"), F.from_json("value", LABEL_SCHEMA, {"mode": "PERMISSIVE"}).alias("doc"))


def images_of(labels: DataFrame, keys: Iterable[str] | None = None) -> DataFrame:
    """The image relation: image_id, label_file, width, height, data_captured_date, then the metadata's keys, sorted.

    Without `keys` they are gathered from the data: names of metadata fields, not values.
    """
    good = labels.where("doc.images is not null or doc.annotations is not null")
    keys = sorted(keys if keys is not None else (r.k for r in good.select(F.explode(F.map_keys("doc.metadata")).alias("k")).distinct().collect()))
    first = F.get(F.col("doc.images"), F.lit(0))
    meta = [cell(F.try_element_at(F.col("doc.metadata"), F.lit(k))).alias(k) for k in keys]
    return good.select(file_stem(F.col("label_file")).alias("image_id"), "label_file", cell(first.width).alias("width"), cell(first.height).alias("height"), cell(first.date_captured).alias("data_captured_date"), *meta)


def annotations_of(labels: DataFrame) -> DataFrame:
    """The annotation relation: image_id, inner_ann_id, text, bbox (JSON); annotations without id are dropped."""
    each = labels.select(file_stem(F.col("label_file")).alias("image_id"), F.explode("doc.annotations").alias("a"))
    return each.where("a.id is not null").select("image_id", F.col("a.id").alias("inner_ann_id"), cell(F.col("a.text")).alias("text"), cell(F.col("a.bbox")).alias("bbox"))


def bad_label_files(labels: DataFrame) -> DataFrame:
    return labels.where("doc is null or (doc.images is null and doc.annotations is null)").select("label_file")


def list_files(spark: SparkSession, root: str, extensions: Iterable[str] | None = None) -> DataFrame:
    """`value`, paths of all files below root, relative to it; extensions are taken as they are, case included.

    Tasks list folders, a level of the tree at a time, and write what they find, so the driver holds no names (`listing`).
    """
    out = listing.files_below(spark, root)
    if extensions:
        exts = [e if e.startswith(".") else f".{e}" for e in extensions]
        out = out.where(F.regexp_extract("value", r"[^/](\.[^./]+)$", 1).isin(*exts))
    return out


def leaf_dirs(files: DataFrame) -> DataFrame:
    """Folders that hold files and no folder with files below them, from a listing of files."""
    dirs = files.select(F.regexp_extract("value", "^(.*)/[^/]*$", 1).alias("value")).where("value <> ''").distinct()
    parts = F.split("value", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    inner = dirs.where(F.size(parts) > 1).select(F.explode(above).alias("value")).distinct()
    return dirs.join(inner, "value", "left_anti")


def image_ids(files: DataFrame, extensions: Iterable[str] = IMAGE_EXTENSIONS) -> DataFrame:
    """text_id, the distinct stems of image files, whatever the case of their extension."""
    ext = F.lower(F.regexp_extract("value", r"(\.[^./]+)$", 1))
    return files.where(ext.isin(*extensions)).select(file_stem(F.col("value")).alias("text_id")).distinct()


def read_archives(spark: SparkSession, path: str, contents: bool = False, members: int = archives.MEMBERS) -> DataFrame:
    """Archive, member, size and, if asked for, content of each file in a ZIP archive, or in all below a folder.

    A task reads `members` members, so that a large archive is shared out, or a 64th of an archive that has more than 64 times as many. Members that would leave the target folder
    (absolute, or with ..) are left out; a damaged or encrypted one raises when its content is read.
    """
    ship(spark)
    spark.dataSource.register(archives.ArchiveSource)
    return spark.read.format("zip_members").options(contents=contents, members=members).load(path)
