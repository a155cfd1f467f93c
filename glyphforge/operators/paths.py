"""Path mappings as plans: what a rename, copy or delete would do, as tables.

Files are touched by `apply_plan` alone, which is dry unless told otherwise.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, slashes, strip
from glyphforge.operators.joins import longest_prefix
from glyphforge.operators.predicates import require_columns
from glyphforge.sources.scratch import written


def mapping_status(mapping: DataFrame, existing: DataFrame, origin: str = "origin_path", new: str = "new_path") -> DataFrame:
    """M2: origin_path, new_path and status of each row: invalid, unchanged, already_applied (source gone, target there),
    missing, conflict (target there, or wanted by another row), or rename."""
    require_columns(mapping, [origin, new])
    listed = existing.select(slashes(F.col(existing.columns[0])).alias("__p")).distinct()
    src, dst = listed.toDF("origin_path").withColumn("__src", F.lit(True)), listed.toDF("new_path").withColumn("__dst", F.lit(True))
    rows = mapping.select(slashes(F.col(origin)).alias("origin_path"), slashes(F.col(new)).alias("new_path"))
    wanted = rows.where("origin_path <> '' and new_path <> ''").groupBy("new_path").agg(F.count_distinct("origin_path").alias("__wanted"))
    both = rows.join(src, "origin_path", "left").join(dst, "new_path", "left").join(wanted, "new_path", "left")
    has, there = F.coalesce("__src", F.lit(False)), F.coalesce("__dst", F.lit(False))
    status = F.when((F.col("origin_path") == "") | (F.col("new_path") == ""), "invalid").when(F.col("origin_path") == F.col("new_path"), "unchanged")
    status = status.when(~has & there, "already_applied").when(~has, "missing").when(there | (F.col("__wanted") > 1), "conflict").otherwise("rename")
    return both.select("origin_path", "new_path", status.alias("status"))


def remap_dirs(paths: DataFrame, rules: DataFrame, existing: DataFrame | None = None, column: str = "value") -> DataFrame:
    """M1: every path under the longest fitting rule: origin_path, new_path, status, depth (deepest origins are renamed first)."""
    mapped = longest_prefix(paths.select(slashes(F.col(column)).alias("origin_path")).withColumn("new_path", F.col("origin_path")), rules, "new_path").drop("remapped")
    plan = mapping_status(mapped, existing if existing is not None else paths.select(F.col(column)))
    return plan.withColumn("depth", F.size(F.split("origin_path", "/")))


def _apart(df: DataFrame) -> DataFrame:
    """To be joined by a shuffle: tables of moves are as large as the mapping, and a broadcast would pass the driver in every round."""
    return df.hint("merge")


def move_plan(mapping: DataFrame, existing: DataFrame, origin: str = "origin_path", new: str = "new_path", temporary: str = ".moving") -> DataFrame:
    """M1, mapping_csv: stage, depth, src, dst and status of the moves that a mapping of paths asks for, all of them at once.

    Status is invalid (a side is blank), unchanged, missing (no such source), ambiguous (a source with several targets, or a
    target with several sources), conflict (the target is there and does not move away itself), or move. A move whose target moves
    away comes in a later stage than that one; moves of one stage and depth (of the source) can run side by side, the deepest
    first, so that a folder goes before the one that holds it. Around a circle of names the smallest
    source goes to a temporary name first, and from there to its target at last: so it has two rows. Names that differ in case
    alone make no circle here; a file system that takes them for one sees the target there. Repeated rows count once.

    Stages are found by doubling: a round joins each move with the move that it has been followed to, so a chain of n moves
    takes log2(n) rounds.
    """
    require_columns(mapping, [origin, new])
    rows = mapping.select(slashes(F.col(origin)).alias("src"), slashes(F.col(new)).alias("dst")).distinct()
    there = existing.select(slashes(F.col(existing.columns[0])).alias("src")).distinct().withColumn("__there", F.lit(True))
    valid = (F.col("src") != "") & (F.col("dst") != "")
    asked = rows.where(valid & (F.col("src") != F.col("dst")))
    targets = asked.groupBy("src").agg(F.count("*").alias("__targets"))
    present = asked.join(_apart(there), "src", "left_semi")
    sources = present.groupBy("dst").agg(F.count("*").alias("__sources"))
    told = rows.join(_apart(there), "src", "left").join(_apart(targets), "src", "left").join(_apart(sources), "dst", "left")
    status = F.when(~valid, "invalid").when(F.col("src") == F.col("dst"), "unchanged").when(F.col("__there").isNull(), "missing")
    status = status.when((F.col("__targets") > 1) | (F.col("__sources") > 1), "ambiguous").otherwise("move")
    told = written(told.select("src", "dst", status.alias("status")), "moves")
    moves = told.where("status = 'move'")
    # What a move waits for: the move of what stands at its target. Sources and targets are distinct, so moves form chains and circles.
    ahead = moves.join(_apart(moves.select(F.col("src").alias("dst"), F.lit(True).alias("moves"))), "dst", "left").join(_apart(there.toDF("dst", "there")), "dst", "left")
    blocked = ahead.where("there and moves is null").select("src", F.lit(True).alias("blocked"))
    at = ahead.join(_apart(blocked), "src", "left").select("src", "dst", F.when(F.col("moves"), F.col("dst")).alias("to"), F.lit(1).alias("steps"), F.coalesce("blocked", F.lit(False)).alias("blocked"), F.col("src").alias("least"))
    at = written(at, "chain-1")
    n = at.count()
    for k in range(max(1, n.bit_length())):
        if at.where("to is not null").isEmpty():
            break
        far = at.select(F.col("src").alias("to"), F.col("to").alias("__to"), F.col("steps").alias("__steps"), F.col("blocked").alias("__blocked"), F.col("least").alias("__least"))
        on = at.join(_apart(far), "to", "left").select("src", "dst", F.col("__to").alias("to"), (F.col("steps") + F.coalesce("__steps", F.lit(0))).alias("steps"), (F.col("blocked") | F.coalesce("__blocked", F.lit(False))).alias("blocked"), F.least("least", "__least").alias("least"))
        at = written(on, f"chain{k}")
    # What has not come to an end by now goes round a circle; `least` is its smallest source.
    circle = F.col("to").isNotNull()
    turning = written(at.where(circle).select("src", "dst", "least"), "circles")
    out = at.where(~circle).select(F.when(F.col("blocked"), F.lit(None)).otherwise(F.col("steps")).cast("int").alias("stage"), "src", "dst", F.when(F.col("blocked"), "conflict").otherwise("move").alias("status"))
    if not turning.isEmpty():
        # Opened at the smallest source, a circle is a chain that ends there: its moves follow in the order of that chain.
        opened = turning.where("src <> least")
        order = _chained(opened, n)
        aside = F.concat("src", F.lit(temporary))
        first = turning.where("src = least")
        length = turning.groupBy("least").agg((F.count("*") + 1).cast("int").alias("stage"))
        out = out.unionByName(order.select(F.col("stage") + 1, "src", "dst", F.lit("move").alias("status")).toDF("stage", "src", "dst", "status"))
        out = out.unionByName(first.select(F.lit(1).alias("stage"), "src", aside.alias("dst"), F.lit("move").alias("status")))
        out = out.unionByName(first.join(_apart(length), "least").select("stage", aside.alias("src"), "dst", F.lit("move").alias("status")))
    rest = told.where("status <> 'move'").select(F.lit(None).cast("int").alias("stage"), "src", "dst", "status")
    return out.unionByName(rest).select("stage", F.size(F.split("src", "/")).alias("depth"), "src", "dst", "status")


def _chained(moves: DataFrame, n: int) -> DataFrame:
    """stage (from 1), src, dst of moves that form chains: a move's stage is one more than that of the move of its target."""
    at = moves.join(_apart(moves.select(F.col("src").alias("dst"), F.col("src").alias("to"))), "dst", "left").select("src", "dst", "to", F.lit(1).alias("stage"))
    for k in range(max(1, n.bit_length())):
        at = written(at, f"opened{k}")
        if at.where("to is not null").isEmpty():
            break
        far = at.select(F.col("src").alias("to"), F.col("to").alias("__to"), F.col("stage").alias("__stage"))
        at = at.join(_apart(far), "to", "left").select("src", "dst", F.col("__to").alias("to"), (F.col("stage") + F.coalesce("__stage", F.lit(0))).alias("stage"))
    return at.select("stage", "src", "dst")


def remap_path_list(paths: DataFrame, rules: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """M1, path_list: the list with every path under the longest rule that fits it, in its order, and the plan (as `move_plan`) of the
    rules' folders that the list's paths lie in."""
    mapped = longest_prefix(paths, rules, column)
    named = F.split(slashes(F.col(column)), "/")
    folders = paths.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(named)), lambda k: F.array_join(F.slice(named, 1, k), "/"))).alias("value")).distinct()
    return mapped, move_plan(rules.toDF("origin_path", "new_path"), folders)


def copy_manifest(df: DataFrame, image_path: str, order: list[str], root: str, keep_folders: bool = False) -> DataFrame:
    """Src and dst of files to copy into root. Flat names that occur again get _1, _2, ... before the suffix."""
    require_columns(df, [image_path, *order])
    src = slashes(F.col(image_path))
    rows = df.where(strip(cell(F.col(image_path))) != "").select(src.alias("src"), *(F.col(c).alias(f"__o{i}") for i, c in enumerate(order)))
    base = root.rstrip("/") + "/"
    if keep_folders:
        return rows.select("src", F.concat(F.lit(base), F.regexp_replace("src", "^/+", "")).alias("dst"))
    name = F.regexp_extract("src", "([^/]*)$", 1)
    at = F.row_number().over(Window.partitionBy("__name").orderBy(*(f"__o{i}" for i in range(len(order)))))
    stem, ext = F.regexp_replace("__name", r"(?<=.)\.[^.]+$", ""), F.regexp_extract("__name", r".(\.[^.]+)$", 1)
    numbered = rows.withColumn("__name", name).withColumn("__n", at)
    return numbered.select("src", F.concat(F.lit(base), F.when(F.col("__n") == 1, F.col("__name")).otherwise(F.concat(stem, F.lit("_"), (F.col("__n") - 1).cast("string"), ext))).alias("dst"))


def deletion_plan(paths: DataFrame, must_be_under: str = "", protected: Iterable[str] = (), column: str = "value") -> DataFrame:
    """Path and status: delete, outside (not below must_be_under) or protected (or above something protected)."""
    p = slashes(F.col(column))
    root, kept = must_be_under.replace("\\", "/").rstrip("/"), [x.replace("\\", "/").rstrip("/") for x in protected]
    guard: Column = F.lit(False)
    for k in kept:
        guard = guard | (p == k) | F.startswith(F.lit(k + "/"), F.concat(p, F.lit("/")))
    inside = p.startswith(root + "/") if root else F.lit(True)
    return paths.select(p.alias("path"), F.when(guard, "protected").when(~inside, "outside").otherwise("delete").alias("status"))


def dir_status(dirs: DataFrame, files: DataFrame, known_dirs: DataFrame | None = None, column: str = "value") -> DataFrame:
    """Path and status (exists, empty, missing, not_dir) of folders, against a listing of files and of empty folders."""
    f = files.select(slashes(F.col(files.columns[0])).alias("__f"))
    parts = F.split("__f", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    full = f.where(F.size(parts) > 1).select(F.explode(above).alias("path")).distinct().withColumn("__full", F.lit(True))
    out = dirs.select(slashes(F.col(column)).alias("path")).join(full, "path", "left").join(f.distinct().toDF("path").withColumn("__file", F.lit(True)), "path", "left")
    if known_dirs is not None:
        out = out.join(known_dirs.select(slashes(F.col(known_dirs.columns[0])).alias("path")).distinct().withColumn("__known", F.lit(True)), "path", "left")
    else:
        out = out.withColumn("__known", F.lit(None).cast("boolean"))
    return out.select("path", F.when(F.col("__full"), "exists").when(F.col("__file"), "not_dir").when(F.col("__known"), "empty").otherwise("missing").alias("status"))


def apply_plan(plan: DataFrame, operation: str, source_root: str = "", target_root: str = "", dry_run: bool = True, overwrite: bool = False) -> DataFrame:
    """Copy, move or delete on a file system that all executors mount: src, dst, done (what happened).

    plan: src and, but for delete, dst. Each row is one file; a rerun finds finished moves done. Nothing happens if dry.
    """
    if operation not in ("copy", "move", "delete"):
        raise ValueError(f"unknown operation {operation}")

    def one(src: str, dst: str | None, made: set[str]) -> str:
        a = os.path.join(source_root, src.lstrip("/")) if source_root else src
        b = os.path.join(target_root, dst.lstrip("/")) if dst and target_root else dst
        if operation != "delete" and not os.path.exists(a) and b and os.path.exists(b):
            return "already_applied"
        if not os.path.exists(a):
            return "missing"
        if b and os.path.exists(b) and not overwrite:
            return "exists"
        if dry_run:
            return f"would_{operation}"
        if operation == "delete":
            shutil.rmtree(a) if os.path.isdir(a) else os.remove(a)
        else:
            if os.path.dirname(b) not in made:
                os.makedirs(os.path.dirname(b), exist_ok=True)
                made.add(os.path.dirname(b))
            (shutil.copy2 if operation == "copy" else shutil.move)(a, b)
        return operation

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: set[str] = set()  # folders that this task has made
        for f in frames:
            f["done"] = [one(s, d, made) for s, d in zip(f["src"], f["dst"], strict=True)]
            yield f

    rows = plan.select(cell(F.col("src")).alias("src"), (cell(F.col("dst")) if "dst" in plan.columns else F.lit(None).cast("string")).alias("dst"))
    return dealt(rows).mapInPandas(run, "src string, dst string, done string")


def dealt(rows: DataFrame) -> DataFrame:
    """rows in a partition for every core: operations on files take their time, however few bytes name them."""
    return rows.repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism), *(F.col(f"`{c}`") for c in rows.columns))
