"""Counts, distributions and variances (A1 to A16). All reduce before the shuffle; explodes feed partial aggregates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.text import CATEGORIES, WS, cell, char_category, chars, extension, py_float, strip, word_group, words
from glyphforge.operators.predicates import require_columns

EMPTY = "<EMPTY>"


def value_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """A5: column, value, count; a blank cell counts as <EMPTY>."""
    require_columns(df, columns)
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), cell(F.col(f"`{c}`")).alias("value")) for c in columns))).alias("x")
    value = F.when(F.col("x.value") == "", EMPTY).otherwise(F.col("x.value"))
    return df.select(each).groupBy(F.col("x.column").alias("column"), value.alias("value")).agg(F.count("*").alias("count"))


def char_counts(df: DataFrame, column: str) -> DataFrame:
    """Category, character, count. Characters are counted before they are classified."""
    require_columns(df, [column])
    counts = df.select(F.explode(chars(F.col(f"`{column}`"))).alias("character")).groupBy("character").agg(F.count("*").alias("count"))
    return counts.select(char_category(F.col("character")).alias("category"), "character", "count")


def category_totals(df: DataFrame, column: str) -> DataFrame:
    """Category, total_count for all six categories."""
    fixed = df.sparkSession.createDataFrame([(c,) for c in CATEGORIES], "category string")
    sums = char_counts(df, column).groupBy("category").agg(F.sum("count").alias("total_count"))
    return fixed.join(sums, "category", "left").select("category", F.coalesce("total_count", F.lit(0)).alias("total_count"))


def word_counts(df: DataFrame, column: str, lowercase: bool = False) -> DataFrame:
    """Group, word, count: words by script; in a text with white space pure groups become _plus."""
    require_columns(df, [column])
    c = F.col(f"`{column}`")
    rows = df.select(cell(c).rlike(f"[{WS}]").alias("spaced"), F.explode(words(c)).alias("word"))
    rows = rows.withColumn("word", F.lower("word")) if lowercase else rows
    counts = rows.groupBy("spaced", "word").agg(F.count("*").alias("n"))
    return counts.groupBy(word_group(F.col("word"), F.col("spaced")).alias("group"), "word").agg(F.sum("n").alias("count"))


def word_group_totals(df: DataFrame, column: str, lowercase: bool = False) -> DataFrame:
    """Group, total_count."""
    return word_counts(df, column, lowercase).groupBy("group").agg(F.sum("count").alias("total_count"))


def word_lengths(df: DataFrame, column: str) -> DataFrame:
    """word_length, word_count."""
    require_columns(df, [column])
    each = df.select(F.explode(words(F.col(f"`{column}`"))).alias("word"))
    return each.groupBy(F.length("word").alias("word_length")).agg(F.count("*").alias("word_count"))


def label_statistics(df: DataFrame, column: str, columns: Iterable[str] = (), lowercase: bool = False) -> dict[str, DataFrame]:
    """All of the above by name."""
    out = {"characters": char_counts(df, column), "categories": category_totals(df, column), "words": word_counts(df, column, lowercase), "word_groups": word_group_totals(df, column, lowercase), "word_lengths": word_lengths(df, column)}
    columns = list(columns)
    return out | ({"values": value_distribution(df, columns)} if columns else {})


def numeric(column: str) -> Column:
    """The cell's number; what is none raises."""
    c = F.col(f"`{column}`")
    return F.coalesce(py_float(c), F.raise_error(F.concat(F.lit("not a number: "), cell(c))).cast("double"))


def variance(df: DataFrame, column: str) -> DataFrame:
    """Count, min, max, mean, variance_population, variance_sample of a numeric column; 0 where too few rows define one."""
    require_columns(df, [column])
    x = F.col("x")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.select(numeric(column).alias("x")).agg(F.count("x").alias("count"), F.min(x).alias("min"), F.max(x).alias("max"), zero(F.avg(x)).alias("mean"), zero(F.var_pop(x)).alias("variance_population"), zero(F.var_samp(x)).alias("variance_sample"))


def bin_edges(edges: Iterable[float]) -> list[float]:
    """Sorted distinct edges; a negative one stands for its inverse magnitude."""
    found = sorted({1 / abs(e) if e < 0 else float(e) for e in edges})
    return found if len(found) > 1 else []


def histogram(df: DataFrame, column: str, edges: Iterable[float]) -> DataFrame:
    """A10: bin_index, bin_left, bin_right, count; the last bin is closed, empty bins stay; below_min and above_max at the end."""
    require_columns(df, [column])
    e = bin_edges(edges)
    if not e:
        return df.select(numeric(column).alias("value"))
    x, last = F.col("x"), len(e) - 2
    at = F.when(x < e[0], "below_min").when((x > e[-1]) | F.isnan(x), "above_max")
    for i in range(last + 1):
        at = at.when((x < e[i + 1]) if i < last else (x <= e[i + 1]), str(i))
    counts = df.select(numeric(column).alias("x")).groupBy(at.alias("bin_index")).agg(F.count("*").alias("n"))
    rows = [(str(i), e[i], e[i + 1]) for i in range(last + 1)] + [("below_min", None, e[0]), ("above_max", e[-1], None)]
    fixed = df.sparkSession.createDataFrame(rows, "bin_index string, bin_left double, bin_right double")
    return fixed.join(counts, "bin_index", "left").select("bin_index", "bin_left", "bin_right", F.coalesce("n", F.lit(0)).alias("count"))


def frequency_variance(df: DataFrame, column: str) -> DataFrame:
    """category_count, total_count, mean_frequency, variance_population, variance_sample of a column's value counts."""
    counts = value_distribution(df, [column])
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    n = F.col("count")
    return counts.agg(F.count("*").alias("category_count"), F.coalesce(F.sum(n), F.lit(0)).alias("total_count"), zero(F.avg(n)).alias("mean_frequency"), zero(F.var_pop(n)).alias("variance_population"), zero(F.var_samp(n)).alias("variance_sample"))


def extension_counts(paths: DataFrame, column: str, case_sensitive: bool = True) -> DataFrame:
    """Extension, count; blank lines are passed over."""
    p = F.col(f"`{column}`")
    return paths.where(strip(cell(p)) != "").groupBy(extension(p, case_sensitive).alias("extension")).agg(F.count("*").alias("count"))


def status_counts(df: DataFrame, status: str = "status", statuses: tuple[str, ...] = ("exists", "empty", "missing", "not_dir")) -> DataFrame:
    """One row with the number of each status."""
    return df.agg(*(F.count_if(F.col(status) == s).alias(s) for s in statuses), F.count("*").alias("total"))


def count_differences(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Values whose numbers of rows differ: value, left_count, right_count."""
    a, b = (df.groupBy(cell(F.col(f"`{column}`")).alias("value")).agg(F.count("*").alias(f"{side}_count")) for df, side in ((left, "left"), (right, "right")))
    both = a.join(b, "value", "full_outer").select("value", F.coalesce("left_count", F.lit(0)).alias("left_count"), F.coalesce("right_count", F.lit(0)).alias("right_count"))
    return both.where("left_count <> right_count")


def metric_rows(df: DataFrame) -> DataFrame:
    """A one-row aggregate as metric, value (text)."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns))).alias("x")
    return df.select(each).select("x.*")


