"""Keyed lookups (J1 to J11). Build sides first collapse to one row a key; Spark decides by their size whether to broadcast."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, is_true, keyword_mapping, slashes, strip
from glyphforge.operators.predicates import require_columns


def lookup_table(df: DataFrame, key: str, columns: list[str], order: list[str], keep: str = "last") -> DataFrame:
    """One row for each trimmed key that is not blank: __key and `columns` of its first or last row."""
    require_columns(df, [key, *columns, *order])
    at = F.struct(*(F.col(f"`{c}`") for c in order))
    row = F.struct(*(F.col(f"`{c}`").alias(c) for c in columns), F.lit(1).alias("__one"))
    best = (F.max_by if keep == "last" else F.min_by)(row, at).alias("__row")
    return df.where(strip(cell(F.col(f"`{key}`"))) != "").groupBy(strip(cell(F.col(f"`{key}`"))).alias("__key")).agg(best).select("__key", "__row.*").drop("__one")


def join_labels(preds: DataFrame, labels: DataFrame, order: list[str], key: str = "text_id", label: str = "label") -> DataFrame:
    """Predictions with the label of their id, the last one of several; blank where none matches. A label column of
    the predictions is replaced. is_known tells whether the id was found."""
    found = lookup_table(labels, key, [label], order).select("__key", F.col(f"`{label}`").alias("__label"), F.lit(True).alias("__known"))
    out = preds.drop(label).withColumn("__key", strip(cell(F.col(f"`{key}`")))).join(found, "__key", "left")
    return out.withColumn(label, cell(F.col("__label"))).withColumn("is_known", F.coalesce("__known", F.lit(False))).drop("__key", "__label", "__known")


def uncovered(labels: DataFrame, preds: DataFrame, key: str = "text_id") -> DataFrame:
    """Ids of labels that no prediction has."""
    ids = lambda df: df.select(strip(cell(F.col(f"`{key}`"))).alias(key)).where(F.col(key) != "").distinct()
    return ids(labels).join(ids(preds), key, "left_anti")


def merge_columns(annotations: DataFrame, images: DataFrame, columns: list[str], order: list[str], image_key: str = "image_id", key: str = "source_image_id", overwrite: bool = True, strict: bool = False) -> DataFrame:
    """Columns of the first image row of each key; a row without one stays; without overwrite only blanks are filled."""
    require_columns(annotations, [key])
    if strict:
        require_columns(images, columns)
    columns = [c for c in columns if c in images.columns]
    found = lookup_table(images, image_key, columns, order, "first")
    found = found.select("__key", F.lit(True).alias("__found"), *(F.col(f"`{c}`").alias(f"__new_{c}") for c in columns))
    out = annotations.withColumn("__key", strip(cell(F.col(f"`{key}`")))).join(found, "__key", "left")
    for c in columns:
        old = cell(F.col(f"`{c}`")) if c in annotations.columns else F.lit("")
        take = F.col("__found") if overwrite else F.col("__found") & (strip(old) == "")
        out = out.withColumn(c, F.when(take, cell(F.col(f"`__new_{c}`"))).otherwise(old))
    return out.drop("__key", "__found", *(f"__new_{c}" for c in columns))


def apply_patch(texts: DataFrame, patch: DataFrame, order: list[str], key: str = "text_id", split: str = "split", label: str = "label") -> DataFrame:
    """The last patch row of an id overwrites split, even by a blank, if the patch has that column, and label unless blank."""
    require_columns(texts, [key])
    columns = [c for c in (split, label) if c in patch.columns]
    found = lookup_table(patch, key, columns, order).select("__key", F.lit(True).alias("__found"), *(cell(F.col(f"`{c}`")).alias(f"__new_{c}") for c in columns))
    out = texts.withColumn("__key", strip(cell(F.col(f"`{key}`")))).join(found, "__key", "left")
    if split in columns:
        old = cell(F.col(f"`{split}`")) if split in texts.columns else F.lit("")
        out = out.withColumn(split, F.when(F.col("__found"), F.col(f"__new_{split}")).otherwise(old))
    if label in columns:
        old = cell(F.col(f"`{label}`")) if label in texts.columns else F.lit("")
        out = out.withColumn(label, F.when(F.col("__found") & (strip(F.col(f"__new_{label}")) != ""), F.col(f"__new_{label}")).otherwise(old))
    return out.drop("__key", "__found", *(f"__new_{c}" for c in columns))


def patch_counts(texts: DataFrame, patch: DataFrame, key: str = "text_id") -> DataFrame:
    """J5's counters: rows, matched, unmatched_patch_ids."""
    ids = patch.select(strip(cell(F.col(f"`{key}`"))).alias("__key")).where("__key <> ''").distinct()
    own = texts.select(strip(cell(F.col(f"`{key}`"))).alias("__key"))
    rows = own.join(ids.withColumn("__in", F.lit(1)), "__key", "left").select(F.lit(1).alias("r"), F.coalesce("__in", F.lit(0)).alias("m"), F.lit(0).alias("u"))
    both = rows.unionByName(ids.join(own, "__key", "left_anti").select(F.lit(0).alias("r"), F.lit(0).alias("m"), F.lit(1).alias("u")))
    return both.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("r", "rows"), ("m", "matched"), ("u", "unmatched_patch_ids"))))


def attach_scene(texts: DataFrame, scenes: DataFrame, order: list[str], columns: list[str], key: str = "scene_id") -> DataFrame:
    """Columns of the first scene row of the id, and scene_status: ok, blank_id or missing_scene."""
    found = lookup_table(scenes, key, columns, order, "first").withColumn("__found", F.lit(True))
    out = texts.drop(*columns).withColumn("__key", strip(cell(F.col(f"`{key}`")))).join(found, "__key", "left")
    status = F.when(F.col("__key") == "", "blank_id").when(F.col("__found"), "ok").otherwise("missing_scene")
    return out.withColumn("scene_status", status).drop("__key", "__found")


def tag_rows(tags: DataFrame, columns: list[str], key: str = "text_id") -> DataFrame:
    """(id, tag) for every true tag, each once; blank ids have none."""
    require_columns(tags, [key, *columns])
    each = F.explode(F.array(*(F.when(is_true(F.col(f"`{c}`")), F.lit(c)) for c in columns))).alias("tag")
    return tags.select(strip(cell(F.col(f"`{key}`"))).alias(key), each).where(f"tag is not null and {key} <> ''").distinct()


def mark_members(df: DataFrame, ids: DataFrame, key: str, id_column: str, out: str, member: bool = True) -> DataFrame:
    """A boolean whether the trimmed key is among the ids (or is not, with member=False). No row is dropped."""
    listed = ids.select(strip(cell(F.col(f"`{id_column}`"))).alias("__key")).where("__key <> ''").distinct().withColumn("__in", F.lit(True))
    marked = df.withColumn("__key", strip(cell(F.col(f"`{key}`")))).join(listed, "__key", "left")
    return marked.withColumn(out, F.coalesce("__in", F.lit(False)) == F.lit(member)).drop("__key", "__in")


def fill_members(df: DataFrame, ids: DataFrame, key: str, id_column: str, out: str, value: str, overwrite: bool = True) -> DataFrame:
    """The value where the key is among the ids; others, and without overwrite filled cells, stay."""
    old = cell(F.col(f"`{out}`")) if out in df.columns else F.lit("")
    marked = mark_members(df.withColumn("__old", old), ids, key, id_column, "__member")
    take = F.col("__member") if overwrite else F.col("__member") & (strip(F.col("__old")) == "")
    return marked.withColumn(out, F.when(take, F.lit(value)).otherwise(F.col("__old"))).drop("__member", "__old")


def _numbered(paths: DataFrame, mapping: Mapping[str, str], side: str) -> DataFrame:
    p = slashes(F.col(paths.columns[0]))
    rows = paths.select(p.alias(side)).where(F.col(side) != "").withColumn("mapped", keyword_mapping(F.col(side), dict(mapping)))
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy("mapped").orderBy(side)))


def pair_paths(images: DataFrame, labels: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Image and label paths that agree once the mapping is applied to images; the i-th of a path meets the i-th."""
    left = _numbered(images, mapping, "image_file")
    right = _numbered(labels, {}, "label_file").withColumnRenamed("mapped", "__mapped")
    return left.join(right, (left["mapped"] == right["__mapped"]) & (left["__n"] == right["__n"])).select("image_file", "label_file")


def unpaired_paths(images: DataFrame, labels: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Paths without a partner: side, path in mapped form, and origin, the path as it stands."""
    left, right = _numbered(images, mapping, "origin"), _numbered(labels, {}, "origin")
    out = [a.join(b.select("mapped", "__n"), ["mapped", "__n"], "left_anti").select(F.lit(side).alias("side"), F.col("mapped").alias("path"), "origin") for side, a, b in (("image", left, right), ("label", right, left))]
    return out[0].unionByName(out[1])


def mapped_dirs(paths: DataFrame, mapping: DataFrame, origin: str = "origin_path", new: str = "new_path") -> DataFrame:
    """Every path must be an origin of the mapping, and an origin may have one target; otherwise this raises when read."""
    p = slashes(F.col(paths.columns[0]))
    rules = mapping.select(slashes(F.col(origin)).alias("__o"), slashes(F.col(new)).alias("__t")).groupBy("__o").agg(F.min("__t").alias("new_path"), F.count_distinct("__t").alias("__kinds"))
    out = paths.select(p.alias("origin_path")).join(rules, F.col("origin_path") == F.col("__o"), "left")
    fail = F.when(F.col("__o").isNull(), F.raise_error(F.concat(F.lit("no mapping for "), "origin_path")).cast("string")).when(F.col("__kinds") > 1, F.raise_error(F.concat(F.lit("several targets for "), "origin_path")).cast("string"))
    return out.select("origin_path", F.coalesce(fail, F.col("new_path")).alias("new_path"))


def longest_prefix(paths: DataFrame, rules: DataFrame, column: str, origin: str = "origin_path", new: str = "new_path") -> DataFrame:
    """The longest rule that is the path or a folder above it replaces that part; remapped tells whether one did.

    Every path meets its own ancestors by equality, which stays a hash or merge join however many rules there are.
    """
    require_columns(paths, [column])
    p = slashes(F.col(f"`{column}`"))
    parts = F.split(F.col("__p"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    named = paths.withColumn("__p", p)
    # Distinct paths only: many rows may share a path.
    one = named.select("__p").distinct().withColumn("__a", F.explode(above))
    table = rules.select(slashes(F.col(origin)).alias("__a"), slashes(F.col(new)).alias("__t")).where("__a <> ''").groupBy("__a").agg(F.min("__t").alias("__t"))
    best = one.join(table, "__a").groupBy("__p").agg(F.max_by(F.struct("__a", "__t"), F.length("__a")).alias("__r"))
    out = named.join(best, "__p", "left")
    tail = F.substring(F.col("__p"), F.length("__r.__a") + 1, F.length("__p"))
    return out.withColumns({column: F.when(F.col("__r").isNull(), F.col("__p")).otherwise(F.concat(F.col("__r.__t"), tail)), "remapped": F.col("__r").isNotNull()}).drop("__p", "__r")


def zip_lines(old: DataFrame, new: DataFrame, ordinal: str = "_ord", column: str = "value") -> DataFrame:
    """Line i of one list with line i of the other: src, dst. A side without a partner, and a repeated source or target, raise."""
    both = old.select(ordinal, F.col(column).alias("src")).join(new.select(ordinal, F.col(column).alias("dst")), ordinal, "full_outer")

    def fail(c: Column, said: str) -> Column:
        return F.when(c, F.raise_error(F.lit(said)).cast("string"))

    src_n, dst_n = (F.count("*").over(Window.partitionBy(c)) for c in ("src", "dst"))
    checked = both.withColumns({"__s": src_n, "__d": dst_n})
    wrong = F.coalesce(fail(F.col("src").isNull() | F.col("dst").isNull(), "the lists differ in length"), fail(F.col("__s") > 1, "a source is listed twice"), fail(F.col("__d") > 1, "a target is listed twice"))
    return checked.select(ordinal, F.coalesce(wrong, F.col("src")).alias("src"), "dst")
