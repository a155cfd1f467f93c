"""Label lists by split and by challenge tag (Q3, Q8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, is_true, strip, subset_image_path
from glyphforge.operators.predicates import only_korean_legible, require_columns
from glyphforge.plans.evaluate import TAGS
from glyphforge.sources.sinks import label_json

SPLITS = ("train", "val", "test")


def export_rows(df: DataFrame, extra_keep: Column | None = None, korean_only: bool = False) -> DataFrame:
    """The rows of the export with split, path, line (path and label with a tab between) and json (null without a size)."""
    require_columns(df, ["split", "image_path", "label"])
    path, label = subset_image_path(F.col("image_path")), cell(F.col("label"))
    out = df.withColumns({"split": F.lower(strip(cell(F.col("split")))), "__path": path}).where(F.col("split").isin(*SPLITS))
    out = out.where(only_korean_legible()) if korean_only else out
    out = out.where(extra_keep) if extra_keep is not None else out
    out = out.where((F.col("__path") != "") & (strip(label) != ""))
    points = F.col("points") if "points" in df.columns else F.lit("")
    return out.withColumns({"line": F.concat_ws("\t", "__path", label), "json": label_json(F.col("__path"), label, points)}).withColumnRenamed("__path", "path")


def split_lines(df: DataFrame, **options) -> DataFrame:
    """split and line."""
    return export_rows(df, **options).select("split", "line")


def tag_lines(df: DataFrame, tags: list[str] = TAGS, **options) -> DataFrame:
    """tag and line, once for every true tag of a row."""
    rows = export_rows(df, **options)
    each = F.explode(F.array(*(F.when(is_true(F.col(f"`{t}`")), F.lit(t)) for t in tags if t in df.columns))).alias("tag")
    return rows.select(each, "line").where("tag is not null")


def write_exports(df: DataFrame, root: str, **options) -> None:
    """Text and JSON lines of each split below root/split=...; splits without rows have no folder."""
    rows = export_rows(df, **options)
    rows.select("split", F.col("line").alias("value")).write.partitionBy("split").mode("overwrite").text(f"{root}/txt")
    rows.where("json is not null").select("split", F.col("json").alias("value")).write.partitionBy("split").mode("overwrite").text(f"{root}/jsonl")
