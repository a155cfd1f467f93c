"""The filter language as Spark predicates.

A filter is {"column", "op", "value" | "values", "exclude"}; a list of filters is their conjunction. `exclude` negates what
the operator gave. Cells are compared as untrimmed strings; comma-separated values are split and trimmed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.geometry import flat_sizes, let, parse_bbox
from glyphforge.functions.text import cell, extension, has_class, is_false, is_true, py_float, python_regex, strip

TIER_A = ("eq", "ne", "in", "not_in")
TIER_B = (*TIER_A, "gt", "gte", "lt", "lte", "contains", "not_contains")
TIER_C = (*TIER_B, "regex", "not_regex")


def require_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise before any job if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def value_list(value: Any) -> list[str]:
    if value is None:
        return []
    if isinstance(value, str):
        return [x.strip() for x in value.split(",") if x.strip()]
    if isinstance(value, Iterable):
        return [str(x).strip() for x in value if str(x).strip()]
    return [str(value).strip()]


def _number(value: Any) -> float | None:
    try:
        return float(str(value).strip())
    except ValueError:
        return None


def condition(item: Mapping[str, Any], ops: tuple[str, ...] = TIER_C) -> Column:
    """One filter as a predicate that is never null."""
    op = str(item.get("op") or "in").strip().lower()
    if op not in ops:
        raise ValueError(f"unknown operator {op}; known are {', '.join(ops)}")
    c = cell(F.col(f"`{item['column']}`"))
    value = item.get("value", item.get("values"))
    listed = value_list(item.get("values", item.get("value")))
    text = "" if value is None else str(value)
    if op in ("eq", "ne"):
        out = c == text
    elif op in ("in", "not_in"):
        out = c.isin(*listed) if listed else F.lit(False)
    elif op in ("contains", "not_contains"):
        out = F.contains(c, F.lit(text))
    elif op in ("regex", "not_regex"):
        out = c.rlike(python_regex(text))
    else:
        n, left = _number(value), py_float(c)
        compare = {"gt": left > n, "gte": left >= n, "lt": left < n, "lte": left <= n}[op] if n is not None and n == n else F.lit(False)
        out = F.coalesce(compare & ~F.isnan(left), F.lit(False))
    if op in ("ne", "not_in", "not_contains", "not_regex"):
        out = ~out
    return ~out if item.get("exclude") else out


def conjunction(filters: Iterable[Mapping[str, Any]] | None, ops: tuple[str, ...] = TIER_C) -> Column:
    return reduce(lambda a, b: a & b, (condition(f, ops) for f in filters or ()), F.lit(True))


def filter_rows(df: DataFrame, filters: list[Mapping[str, Any]], ops: tuple[str, ...] = TIER_B) -> DataFrame:
    """The rows that all filters take."""
    require_columns(df, (f["column"] for f in filters))
    return df.where(conjunction(filters, ops))


def row_matches(include: Mapping[str, Any], exclude: Mapping[str, Any] | None = None) -> Column:
    """all pairs of include hold, and not all pairs of exclude; booleans are compared by meaning."""

    def holds(column: str, expected: Any) -> Column:
        c = F.col(f"`{column}`")
        if isinstance(expected, bool):
            return is_true(c) if expected else is_false(c)
        if isinstance(expected, list | tuple | set):
            return cell(c).isin(*map(str, expected))
        return cell(c) == str(expected)

    both = reduce(lambda a, b: a & b, (holds(*x) for x in include.items()), F.lit(True))
    if exclude:
        both = both & ~reduce(lambda a, b: a & b, (holds(*x) for x in exclude.items()))
    return both


def split_lines_by_keyword(lines: DataFrame, keyword: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """F8: (lines that hold the keyword, the others)."""
    has = F.contains(cell(F.col(column)), F.lit(keyword))
    return lines.where(has), lines.where(~has)


def drop_by_keyword_or_extension(lines: DataFrame, keywords: Iterable[str] = (), extensions: Iterable[str] = (), column: str = "value") -> DataFrame:
    """without lines that hold a keyword or have one of the extensions, whatever the case."""
    c = cell(F.col(column))
    exts = [e.lower() if e.startswith(".") else f".{e.lower()}" for e in extensions]
    drop = reduce(lambda a, b: a | b, (F.contains(c, F.lit(k)) for k in keywords), extension(c, False).isin(*exts) if exts else F.lit(False))
    return lines.where(~drop)


def outlier_reason(image_id: str = "image_id", text: str = "text", bbox: str = "bbox", drop_missing_id: bool = True, drop_empty_text: bool = True, drop_invalid_bbox: bool = True, drop_nonpositive_bbox: bool = True) -> Column:
    """why a row is dropped, the first reason that holds; null for rows that stay. Only `[x, y, w, h]` counts as a box."""
    raw = strip(cell(F.col(bbox)))
    box = let(raw, flat_sizes)  # null if invalid
    out = F.when(F.lit(drop_missing_id) & (strip(cell(F.col(image_id))) == ""), "missing_image_id")
    out = out.when(F.lit(drop_empty_text) & (strip(cell(F.col(text))) == ""), "empty_text")
    out = out.when(F.lit(drop_invalid_bbox) & F.lower(raw).isin("", "none", "null"), "bbox_none")
    out = out.when(F.lit(drop_invalid_bbox) & box.isNull(), "invalid_bbox")
    return out.when(F.lit(drop_invalid_bbox and drop_nonpositive_bbox) & ((box.w <= 0) | (box.h <= 0)), "nonpositive_bbox")


def drop_outliers(df: DataFrame, **options: Any) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, reason and count of those dropped)."""
    marked = df.withColumn("__reason", outlier_reason(**options))
    # Rows that stay are a group of count 0: a filter on the reason would move below and work it out a second time.
    dropped = marked.groupBy(F.col("__reason").alias("reason")).agg(F.count("__reason").alias("count")).where("count > 0")
    return marked.where("__reason is null").drop("__reason"), dropped


def keyword_reason(columns: Iterable[str], include: Iterable[str] = (), exclude: Iterable[str] = (), exclude_classes: Iterable[str] = ()) -> Column:
    """why the split drops a row, by keywords and character classes of its joined columns; null for rows that stay."""
    text = F.concat_ws(" ", *(cell(F.col(c)) for c in columns))
    include, exclude = list(include), list(exclude)
    out = F.when(~reduce(lambda a, b: a | b, (F.contains(text, F.lit(k)) for k in include)) if include else F.lit(False), "include_keywords")
    out = out.when(reduce(lambda a, b: a | b, (F.contains(text, F.lit(k)) for k in exclude), F.lit(False)), "exclude_keywords")
    for kind in exclude_classes:
        out = out.when(has_class(text, kind), f"exclude_{kind}")
    return out


def only_korean_legible() -> Column:
    """is_only_korean is true and is_illegible is explicitly false; a blank drops the row."""
    return is_true(F.col("is_only_korean")) & is_false(F.col("is_illegible"))


def box_is_readable(column: str) -> Column:
    return parse_bbox(F.col(column)).isNotNull()


def assert_listed(lines: DataFrame, existing: DataFrame, message: str = "paths are missing", column: str = "value", show: int = 10) -> DataFrame:
    """lines, if all are among `existing`; otherwise raises and names some of those that are not."""
    missing = lines.join(existing.select(F.col(existing.columns[0]).alias(column)), column, "left_anti").orderBy(column).limit(show).collect()
    if missing:
        raise RuntimeError(f"{message}: {', '.join(r[column] for r in missing)}")
    return lines
