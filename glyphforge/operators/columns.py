"""Projections and derived columns (P1 to P21). Every function keeps columns that it does not name."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphforge.functions.formula import compile_formula
from glyphforge.functions.geometry import aspect_bin, bbox_flags, bbox_to_points, crop_box, let, parse_bbox
from glyphforge.functions.text import bucket_path, cell, extension, language_category, path_prefix, prefixed_id, py_float, replace_prefix, slashes, strip, text_id, text_length
from glyphforge.operators.predicates import TIER_A, TIER_B, conjunction, require_columns
from glyphforge.sources.scratch import written

_SYMBOLS = {"+": "add", "sum": "add", "-": "sub", "subtract": "sub", "*": "mul", "times": "mul", "/": "div", "divide": "div"}


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """P1."""
    require_columns(df, columns)
    return df.select(*(F.col(f"`{c}`") for c in columns))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Names that are not there are passed over."""
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def assign_constant(df: DataFrame, column: str, value: Any) -> DataFrame:
    """P3."""
    return df.withColumn(column, F.lit(value))


def _kept(df: DataFrame, out: str) -> Column:
    return F.col(f"`{out}`").cast("double") if out in df.columns else F.lit(None).cast("double")


def _number(df: DataFrame, column: str) -> Column:
    """The double that a cell is; columns of numbers are not spelt out for it."""
    c = F.col(f"`{column}`")
    return c.cast("double") if dict(df.dtypes).get(column) in ("double", "bigint", "int") else py_float(c)


def _rounded(c: Column, precision: int | None) -> Column:
    if precision is None:
        return c
    scale = 10.0**precision
    return F.when(F.abs(c) < 1e15, F.bround(c * scale, 0) / scale).otherwise(c)


def formula_column(df: DataFrame, out: str, formula: str, source: str | None = None, filters: list[Mapping[str, Any]] | None = None, precision: int | None = 6) -> DataFrame:
    """A formula over all columns, and x for `source`. Rows that the filters do not take stay as they are.

    A source cell that is no number raises, as does a result that is not finite.
    """
    names = {c: py_float(F.col(f"`{c}`")) for c in df.columns if c.isidentifier()}
    if source is not None:
        require_columns(df, [source])
        x = py_float(F.col(f"`{source}`"))
        bad = F.raise_error(F.concat(F.lit("not a number: "), cell(F.col(f"`{source}`")))).cast("double")
        names["x"] = F.coalesce(x, bad)
    value = compile_formula(formula, names)
    value = F.when(F.isnan(value) | (F.abs(value) == math.inf), F.raise_error(F.lit("formula: the result is not finite")).cast("double")).otherwise(value)
    return df.withColumn(out, F.when(conjunction(filters, TIER_A), _rounded(value, precision)).otherwise(_kept(df, out)))


def arithmetic_column(df: DataFrame, x: str = "width", y: str = "height", out: str = "aspect_ratio", operation: str = "div", filters: list[Mapping[str, Any]] | None = None, precision: int | None = 6) -> DataFrame:
    """X (+, -, *, /) y; division by zero raises. Rows that the filters do not take stay as they are."""
    op = _SYMBOLS.get(operation, operation)
    if op not in ("add", "sub", "mul", "div"):
        raise ValueError(f"unknown operation {operation}")
    require_columns(df, [x, y])
    a, b = _number(df, x), _number(df, y)
    value = {"add": a + b, "sub": a - b, "mul": a * b, "div": a / b}[op]
    return df.withColumn(out, F.when(conjunction(filters, TIER_A), _rounded(value, precision)).otherwise(_kept(df, out)))


def fill_column(df: DataFrame, out: str, filters: list[Mapping[str, Any]], value: Any = None, source: str | None = None, default: Any = None) -> DataFrame:
    """Value, or the source column, where all filters hold; else the default, or what is there."""
    require_columns(df, [f["column"] for f in filters] + ([source] if source else []))
    then = cell(F.col(f"`{source}`")) if source else F.lit(None if value is None else str(value))
    other = F.lit(str(default)) if default is not None else (cell(F.col(f"`{out}`")) if out in df.columns else F.lit(""))
    return df.withColumn(out, F.when(conjunction(filters, TIER_B), then).otherwise(other))


def join_columns(df: DataFrame, sources: list[str], out: str, delimiter: str = "_", overwrite: bool = True, strict: bool = True, blanks: bool = True) -> DataFrame:
    """Trimmed cells joined; without `blanks`, empty cells are left out; without `strict`, so are missing columns."""
    if strict:
        require_columns(df, sources)
    parts = [strip(cell(F.col(f"`{c}`"))) for c in sources if c in df.columns]
    joined = F.concat_ws(delimiter, *(parts if blanks else [F.when(p != "", p) for p in parts]))
    if not overwrite and out in df.columns:
        joined = F.when(strip(cell(F.col(f"`{out}`"))) == "", joined).otherwise(F.col(f"`{out}`"))
    return df.withColumn(out, joined)


def text_length_column(df: DataFrame, column: str = "text", out: str = "text_length", ignore_space: bool = False, filters: list[Mapping[str, Any]] | None = None) -> DataFrame:
    """P9."""
    require_columns(df, [column])
    old = F.col(f"`{out}`").cast("int") if out in df.columns else F.lit(None).cast("int")
    return df.withColumn(out, F.when(conjunction(filters, TIER_A), text_length(F.col(f"`{column}`"), ignore_space)).otherwise(old))


def language_category_column(df: DataFrame, column: str = "text", out: str = "language_category", ignore_space: bool = True) -> DataFrame:
    """P10."""
    require_columns(df, [column])
    return df.withColumn(out, language_category(F.col(f"`{column}`"), ignore_space))


def validate_bbox(df: DataFrame, bbox: str = "bbox", format_col: str = "is_valid_bbox_format", value_col: str = "is_valid_bbox_value", drop_format: bool = False, drop_value: bool = False) -> DataFrame:
    """Two flags; a box that cannot be read has a valid value."""
    require_columns(df, [bbox])
    read = df.withColumn("__box", bbox_flags(F.col(f"`{bbox}`")))  # parsed once for both
    out = read.withColumns({format_col: F.col("__box.format"), value_col: F.col("__box.value")}).drop("__box")
    out = out.where(F.col(format_col)) if drop_format else out
    return out.where(F.col(value_col)) if drop_value else out


def bbox_size_columns(df: DataFrame, bbox: str = "bbox", width: str = "width", height: str = "height", filters: list[Mapping[str, Any]] | None = None, overwrite: bool = True) -> DataFrame:
    """Width and height of the box; one that cannot be read raises. Without overwrite, rows that have either keep both."""
    require_columns(df, [bbox])
    b = F.coalesce(parse_bbox(F.col(bbox)), F.raise_error(F.lit("bbox cannot be read")).cast("struct<x:double,y:double,w:double,h:double>"))
    take = conjunction(filters, TIER_B)
    if not overwrite:
        there = [strip(cell(F.col(c))) != "" for c in (width, height) if c in df.columns]
        for t in there:
            take = take & ~t
    read = df.withColumns({"__take": take, "__box": F.when(take, b)})  # parsed once for both
    return read.withColumns({width: F.when(F.col("__take"), F.col("__box.w")).otherwise(_kept(df, width)), height: F.when(F.col("__take"), F.col("__box.h")).otherwise(_kept(df, height))}).drop("__take", "__box")


def aspect_bin_column(df: DataFrame, ratio: str = "aspect_ratio", out: str = "linear_aspect_ratio_bin", filters: list[Mapping[str, Any]] | None = None) -> DataFrame:
    """P13."""
    require_columns(df, [ratio])
    old = F.col(f"`{out}`").cast("long") if out in df.columns else F.lit(None).cast("long")
    return df.withColumn(out, F.when(conjunction(filters, TIER_B), aspect_bin(_number(df, ratio))).otherwise(old))


def path_prefix_column(df: DataFrame, path: str = "image_file", out: str = "image_path_prefix_4", tokens: int = 4) -> DataFrame:
    """P14."""
    require_columns(df, [path])
    return df.withColumn(out, path_prefix(F.col(f"`{path}`"), tokens))


def replace_path_prefix(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """P15."""
    require_columns(df, [column])
    return df.withColumn(column, replace_prefix(F.col(f"`{column}`"), old, new))


def image_path_column(df: DataFrame, scene: str = "image_id", item: str = "annotation_id", out: str = "image_path", root: str = "", size: int = 1000, ext: str = "jpg", overwrite: bool = True) -> DataFrame:
    """Bucketed paths; a blank scene or item leaves the row as it is."""
    require_columns(df, [scene, item])
    old = cell(F.col(f"`{out}`")) if out in df.columns else F.lit("")
    blank = (strip(cell(F.col(f"`{scene}`"))) == "") | (strip(cell(F.col(f"`{item}`"))) == "")
    keep = blank if overwrite else blank | (strip(old) != "")
    return df.withColumn(out, F.when(keep, old).otherwise(bucket_path(F.col(f"`{scene}`"), F.col(f"`{item}`"), root, size, ext)))


_SCENE_FIXED = ("image_id", "image_file", "width", "height", "data_captured_date")
_TEXT_FIXED = ("image_id", "inner_ann_id", "text", "bbox")


def scene_table(images: DataFrame, origin: str = "aihub", prefix: str = "aihub_") -> DataFrame:
    """P17, scenes: ids prefixed once, fixed columns first, all others after them."""
    require_columns(images, _SCENE_FIXED)
    extras = [F.col(f"`{c}`") for c in images.columns if c not in _SCENE_FIXED]
    return images.select(prefixed_id(F.col("image_id"), prefix).alias("scene_id"), F.lit(origin).alias("origin_dataset"), F.col("image_file").alias("image_path"), F.col("image_file").alias("origin_image_path"), "width", "height", "data_captured_date", *extras)


def text_table(annotations: DataFrame, origin: str = "aihub", prefix: str = "aihub_") -> DataFrame:
    """P17, texts: text_id is scene and index; points is JSON of four corners, empty if the box cannot be read."""
    require_columns(annotations, _TEXT_FIXED)
    extras = [F.col(f"`{c}`") for c in annotations.columns if c not in _TEXT_FIXED]
    scene = prefixed_id(F.col("image_id"), prefix)
    points = F.coalesce(F.to_json(bbox_to_points(F.col("bbox"))), F.lit(""))
    return annotations.select(text_id(scene, F.col("inner_ann_id")).alias("text_id"), scene.alias("scene_id"), cell(F.col("inner_ann_id")).alias("text_index"), F.lit(origin).alias("origin_dataset"), cell(F.col("text")).alias("label"), points.alias("points"), *extras)


def running_sums(df: DataFrame, weight: Column, order: list[str], out: str, by: list[str] = (), total: str | None = None) -> DataFrame:
    """The sum of `weight` (whole numbers) over the rows before each in the order of `order` (which must be unique), in each group of
    `by` if given, and the group's sum as `total`.

    No task takes all rows, nor all of a group: rows are dealt to ranges of (by, order), which are written once, as each of two
    range exchanges would find bounds of its own; ranges are summed up by themselves, and start where those before them end.
    """
    named = lambda names: [F.col(f"`{c}`") for c in names]
    ranged = written(df.withColumn("__weight", weight.cast("long")).repartitionByRange(*named([*by, *order])).withColumn("__part", F.spark_partition_id()), "ranges")
    keys = {f"__by{i}": F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for i, c in enumerate(by)}
    keys |= {f"__none{i}": F.col(f"`{c}`").isNull() for i, c in enumerate(by)}
    ranged = ranged.withColumns(keys) if keys else ranged
    held = [*keys, "__part"]
    upto = Window.partitionBy(*held).orderBy(*named(order)).rowsBetween(Window.unboundedPreceding, 0)
    inner = ranged.withColumn("__n", F.sum("__weight").over(upto))
    sizes = ranged.groupBy(*held).agg(F.sum("__weight").alias("__size"))  # a row for each range, and for each group in it
    within = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("__size").over(within.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*held, before.alias("__before"), F.sum("__size").over(within).alias("__total"))
    found = inner.join(sizes, held).withColumn(out, F.col("__before") + F.col("__n") - F.col("__weight"))
    return (found.withColumn(total, F.col("__total")) if total else found).drop(*held, "__n", "__weight", "__before", "__total")


def ordinals(df: DataFrame, order: list[str], out: str, by: list[str] = (), total: str | None = None) -> DataFrame:
    """0, 1, ... in the order of `order` (which must be unique), in each group of `by` if given, and the group's size as `total`."""
    return running_sums(df, F.lit(1), order, out, by, total)


def rename_map(pairs: DataFrame, order: list[str], image: str = "image_file", label: str = "label_file", start: int = 1, padding: int = 0, prefix: str = "") -> DataFrame:
    """Two rows (origin_path, new_path) for each pair: a running number for the name, folder and suffix as before."""
    require_columns(pairs, [image, label, *order])
    numbered = ordinals(pairs, order, "__id")
    n = (F.col("__id") + start).cast("string")
    name = F.concat(F.lit(prefix), F.when(F.length(n) < padding, F.lpad(n, padding, "0")).otherwise(n) if padding else n)

    def renamed(c: str) -> Column:
        p = slashes(F.col(f"`{c}`"))
        folder = F.regexp_extract(p, "^(.*/)", 1)
        ext = extension(p)
        return F.struct(p.alias("origin_path"), F.concat(folder, name, F.when(ext == "(no_ext)", "").otherwise(ext)).alias("new_path"))

    return numbered.select(F.inline(F.array(renamed(image), renamed(label))))


def remap_extensions(df: DataFrame, mapping: Mapping[str, str], column: str = "value") -> DataFrame:
    """Extensions replaced, looked up whatever their case; others stay."""
    dotted = lambda e: e if e.startswith(".") else f".{e}"
    table = {dotted(a).lower(): dotted(b) for a, b in mapping.items()}
    c = cell(F.col(f"`{column}`"))
    ext = extension(c)
    lookup = F.create_map(*(F.lit(x) for pair in table.items() for x in pair)) if table else F.create_map().cast("map<string,string>")
    new = F.try_element_at(lookup, F.lower(ext))
    return df.withColumn(column, F.when(new.isNull(), c).otherwise(F.concat(F.substring(c, F.lit(1), F.length(c) - F.length(ext)), new)))


def crop_geometry(df: DataFrame, bbox: str = "bbox", width: str = "width", height: str = "height", out: str = "crop") -> DataFrame:
    """P22 without pixels: the crop box inside the image; null if the box cannot be read or the image has no size."""
    w, h = py_float(F.col(width)).cast("long"), py_float(F.col(height)).cast("long")
    return df.withColumn(out, let(parse_bbox(F.col(bbox)), lambda b: F.when(b.isNotNull() & (w > 0) & (h > 0), crop_box(b, w, h))))


def apply_operations(df: DataFrame, operations: Iterable[Mapping[str, Any]]) -> DataFrame:
    """A list of {"op": ..., ...} steps on one table, in order. Cells stay strings."""
    from glyphforge.operators.dedup import drop_duplicates  # the dedup operators build on this module

    for step in operations:
        op = step["op"]
        if op == "filter":
            name = step.get("filter_op", step.get("operator", "eq"))
            df = df.where(conjunction([{**step, "op": name}], TIER_B))
        elif op == "select_columns":
            df = select_columns(df, step["columns"])
        elif op == "rename_columns":
            df = rename_columns(df, step["mapping"])
        elif op == "sort_values":
            by = step["by"] if isinstance(step["by"], list) else [step["by"]]
            up = step.get("ascending", True)
            ups = up if isinstance(up, list) else [up] * len(by)
            df = df.orderBy(*(F.col(c).asc() if a else F.col(c).desc() for c, a in zip(by, ups, strict=True)))
        elif op == "drop_duplicates":
            df = drop_duplicates(df, step.get("subset") or df.columns, step["order"], step.get("keep", "first"))
        elif op == "assign_constant":
            df = assign_constant(df, step["column"], step["value"])
        elif op == "assign_formula":
            df = formula_column(df, step["out_column"], step["formula"], step.get("source_column"), None, step.get("precision"))
        else:
            raise ValueError(f"unknown operation {op}")
    return df
