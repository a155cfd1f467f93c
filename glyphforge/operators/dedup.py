"""Duplicates and order-dependent picks (O1 to O3, A12, A13). Order is always an explicit, unique list of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, strip
from glyphforge.operators.columns import ordinals, running_sums
from glyphforge.operators.predicates import require_columns
from glyphforge.sources.scratch import written


def pick(df: DataFrame, keys: list[Column | str], order: list[str], keep: str = "first") -> DataFrame:
    """The first or last row of each key. Spark limits each key to one row before the shuffle too, so that one with very many rows is
    no task's alone; rows are sorted by a hash of the key first, which a comparison of longs tells apart."""
    if keep not in ("first", "last"):
        raise ValueError("keep is first or last")
    named = {f"__k{i}": k for i, k in enumerate(keys) if isinstance(k, Column)}
    names = [f"__k{i}" if isinstance(k, Column) else k for i, k in enumerate(keys)]
    within = Window.partitionBy(F.xxhash64(*names), *names)
    at = within.orderBy(*(F.col(f"`{c}`").asc() if keep == "first" else F.col(f"`{c}`").desc() for c in order))
    return df.withColumns(named).withColumn("__n", F.row_number().over(at)).where("__n = 1").select(*(F.col(f"`{c}`") for c in df.columns))


def drop_duplicate_ids(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """O1: the first row of each trimmed id; rows with a blank id all stay."""
    require_columns(df, [column, *order])
    keyed = df.withColumn("__key", strip(cell(F.col(f"`{column}`"))))
    keyed = keyed.withColumn("__row", F.when(F.col("__key") == "", F.monotonically_increasing_id()))  # a blank id is a key of its own
    return pick(keyed, ["__key", "__row"], order).drop("__key", "__row")


def drop_duplicates(df: DataFrame, subset: list[str], order: list[str], keep: str = "first") -> DataFrame:
    """O2: the first or last row of each tuple of untrimmed cells; blanks count as values."""
    require_columns(df, [*subset, *order])
    return pick(df, [cell(F.col(f"`{c}`")) for c in subset], order, keep)


def duplicate_flag(df: DataFrame, keys: list[str], out: str = "is_valid", skip_empty: bool = False) -> DataFrame:
    """Whether the row's key occurs once; with skip_empty, rows whose keys are all blank are valid."""
    require_columns(df, keys)
    cells = [cell(F.col(f"`{k}`")) for k in keys]
    tagged = df.withColumns({f"__k{i}": c for i, c in enumerate(cells)})
    names = [f"__k{i}" for i in range(len(keys))]
    repeated = tagged.groupBy(*names).agg(F.count("*").alias("__n")).where("__n > 1")
    flag = F.col("__n").isNull()
    if skip_empty:
        blank = F.lit(True)
        for c in cells:
            blank = blank & (strip(c) == "")
        flag = flag | blank
    return tagged.join(repeated, names, "left").withColumn(out, flag).drop(*names, "__n")


def duplicate_report(df: DataFrame, columns: list[str], skip_empty: bool = False) -> DataFrame:
    """Column, row_count, non_empty_count, unique_value_count, duplicate_value_count, duplicate_row_count, is_unique."""
    require_columns(df, columns)
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), cell(F.col(f"`{c}`")).alias("value")) for c in columns))).alias("x")
    counts = df.select(cells).select("x.*").groupBy("column", "value").agg(F.count("*").alias("n"))
    counts = counts.withColumn("counted", F.col("value") != "" if skip_empty else F.lit(True))
    out = counts.groupBy("column").agg(
        F.sum("n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("value") != "", F.col("n"))), F.lit(0)).alias("non_empty_count"),
        F.count_if("counted").alias("unique_value_count"),
        F.count_if(F.col("counted") & (F.col("n") > 1)).alias("duplicate_value_count"),
        F.coalesce(F.sum(F.when(F.col("counted") & (F.col("n") > 1), F.col("n") - 1)), F.lit(0)).alias("duplicate_row_count"),
    )
    return out.withColumn("is_unique", F.col("duplicate_row_count") == 0)


def _children(values: DataFrame) -> DataFrame:
    """of, k, value, first: values that are another one (`of`) with _k behind it; first is where they first occur."""
    k = F.regexp_extract("__v", r"^(?s:.*)_([1-9][0-9]{0,17})$", 1)
    cut = values.withColumn("__k", k).where("__k <> ''")
    named = cut.select(F.expr("left(__v, length(__v) - 1 - length(__k))").alias("of"), F.col("__k").cast("long").alias("k"), F.col("__v").alias("value"), "first")
    return named.join(values.select(F.col("__v").alias("of")), "of")


def unique_suffix(df: DataFrame, column: str, order: list[str]) -> DataFrame:
    """O3: from the second occurrence on a value gets _k, passing over strings that were given out before; blanks stay.

    Rows are numbered within their value, by ranges, so that no value is one task's. A value v meets others only at its children,
    values that are written v_k. When v's numbers reach k, the child has occurred before, and k is passed over; or it comes
    later, finds its name given out, and has all its rows numbered. Which of the two holds depends on the numbers passed over
    below k, and on whether v itself was given out: so children are settled in rounds, until none changes; a round looks at
    one row for each child.
    """
    require_columns(df, [column, *order])
    place = F.struct(*(F.col(f"`{o}`").alias(f"o{i}") for i, o in enumerate(order)))
    numbered = ordinals(df.withColumn("__v", cell(F.col(f"`{column}`"))), order, "__at", ["__v"])
    values = numbered.where("__v <> ''").groupBy("__v").agg(F.min(place).alias("first"))
    children = written(_children(values), "children")
    name = lambda k: F.when((F.col("__v") == "") | (k == 0), F.col("__v")).otherwise(F.concat_ws("_", "__v", k.cast("string")))
    if children.isEmpty():
        return numbered.withColumn(column, name(F.col("__at"))).select(*df.columns)
    rows = numbered.select(F.col("__v").alias("of"), F.col("__at").alias("at"), place.alias("there"))
    rows = written(rows.join(children.select("of").distinct(), "of", "left_semi"), "rows")  # read by every round
    below = Window.partitionBy("of").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)  # distinct values, not rows
    state = children.withColumns({"passed": F.lit(False), "given": F.lit(False)})
    while True:
        given = state.where("given").select(F.col("value").alias("of"), F.lit(1).alias("moved"))
        reached = state.withColumn("before", F.coalesce(F.sum(F.col("passed").cast("long")).over(below), F.lit(0)))
        reached = reached.join(given, "of", "left").withColumn("at", F.col("k") - F.col("before") - F.coalesce("moved", F.lit(0)))
        met = reached.join(rows, ["of", "at"], "left").withColumns({"new_passed": F.coalesce(F.col("first") < F.col("there"), F.lit(False)), "new_given": F.coalesce(F.col("there") < F.col("first"), F.lit(False))})
        met = written(met.select("of", "k", "value", "first", "before", "at", "passed", "given", "new_passed", "new_given"), "state")
        changed = not met.where("passed <> new_passed or given <> new_given").isEmpty()
        state = met.select("of", "k", "value", "first", F.col("new_passed").alias("passed"), F.col("new_given").alias("given"))
        if not changed:
            break
    # A row's number grows by the children that its value's numbers passed over up to it: both in one sequence.
    given = state.where("given").select(F.col("value").alias("__v"), F.lit(1).alias("__moved"))
    involved = written(children.select(F.col("of").alias("__v")).union(children.select("value")).distinct(), "involved")
    apart = numbered.join(involved, "__v").join(given, "__v", "left").withColumns({"__j": F.col("__at") + F.coalesce("__moved", F.lit(0)), "__mark": F.lit(0), "__of": F.col("__at")})
    marks = met.where("passed").select(F.col("of").alias("__v"), (F.col("k") - F.col("before")).alias("__j"), F.lit(1).alias("__mark"), F.col("k").alias("__of"))
    both = apart.unionByName(marks, allowMissingColumns=True).withColumn("__row", 1 - F.col("__mark"))
    counted = running_sums(both, F.col("__mark"), ["__j", "__row", "__of"], "__passed", ["__v"]).where("__mark = 0")
    late = counted.withColumn(column, name(F.when(F.col("__j") > 0, F.col("__j") + F.col("__passed")).otherwise(F.lit(0))))
    plain = numbered.join(involved, "__v", "left_anti").withColumn(column, name(F.col("__at")))
    return plain.select(*df.columns).unionByName(late.select(*df.columns))


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in order."""
    return df.orderBy(*order).limit(n)


def int_order(c: Column) -> Column:
    """A sort key: the integer, 0 where it is none."""
    return F.coalesce(strip(cell(c)).try_cast("long"), F.lit(0).cast("long"))


