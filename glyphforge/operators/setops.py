"""Sets and multisets of lines and tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.text import slashes


def subtract_lines(source: DataFrame, remove: DataFrame, column: str = "value") -> DataFrame:
    """Source lines that are not to be removed, repeats kept, blanks dropped; slashes are normalised on both sides."""
    gone = remove.select(slashes(F.col(remove.columns[0])).alias(column)).distinct()
    own = source.withColumn(column, slashes(F.col(f"`{column}`"))).where(F.col(column) != "")
    return own.join(gone, column, "left_anti").select(*source.columns)


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """U2, one way: rows that left has more often, as often as it has them more."""
    return left.exceptAll(right)


def multiset_intersection_size(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """matched_count, the sum over values of the smaller number."""
    a, b = (df.groupBy(F.col(f"`{column}`").alias("v")).agg(F.count("*").alias(n)) for df, n in ((left, "a"), (right, "b")))
    return a.join(b, "v").agg(F.coalesce(F.sum(F.least("a", "b")), F.lit(0)).alias("matched_count"))


def set_differences(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """U4: side and value of what only one of them has."""
    a, b = (df.select(F.col(f"`{column}`").alias("value")).distinct() for df in (left, right))
    only = lambda x, y, side: x.join(y, "value", "left_anti").select(F.lit(side).alias("side"), "value")
    return only(a, b, "left_only").unionByName(only(b, a, "right_only"))


def union_sources(parts: dict[str, DataFrame], name: str = "source") -> DataFrame:
    """All rows of named tables, with their table's name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(name, F.lit(n)) for n, df in parts.items()))


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Tables of different headers: columns in order of first appearance, blanks where a table has none."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return out.na.fill("", [c for c, t in out.dtypes if t == "string"])


def partition_by_status(df: DataFrame, drop: tuple[str, ...] = ("empty",), status: str = "status") -> tuple[DataFrame, DataFrame]:
    """(rows whose status is dropped, the others)."""
    gone = F.col(status).isin(*drop)
    return df.where(gone), df.where(~F.coalesce(gone, F.lit(False)))
