"""Operators whose results SQL over the driver's tables does not show: order, ties, errors, splits, files, streams."""

from __future__ import annotations

import hashlib
import json
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from glyphforge.operators import columns, dedup, joins, paths, predicates, sampling, setops, stats
from glyphforge.plans import curate, evaluate
from glyphforge.plans.pipeline import Pipeline
from glyphforge.sources import archives, listing, readers, scratch, sinks
from glyphforge.streaming import scoring


def frame(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def test_filters(spark):
    df = frame(spark, [(i, v) for i, v in enumerate(["5", "x", "", None, "nan", " 7 ", "a,b"])], "i int, v string")
    take = lambda **f: sorted(r.i for r in predicates.filter_rows(df, [{"column": "v", **f}], predicates.TIER_C).collect())
    assert take(op="gt", value="4") == [0, 5]
    assert take(op="gt", value="4", exclude=True) == [1, 2, 3, 4, 6]
    assert take(op="lt", value="zzz") == [] and take(value="5, x") == [0, 1] and take(op="not_in", value=["5"]) == [1, 2, 3, 4, 5, 6]
    assert take(op="eq", value=None) == [2, 3] and take(op="contains", value="") == list(range(7))
    assert take(op="regex", value=r"^(?P<n>\d)$") == [0] and take(op="eq", value="a,b") == [6]
    with pytest.raises(ValueError, match="operator"):
        predicates.filter_rows(df, [{"column": "v", "op": "regex", "value": "a"}])
    with pytest.raises(ValueError, match="missing"):
        predicates.filter_rows(df, [{"column": "w", "value": "a"}])


def test_keep_rule(spark):
    df = frame(spark, [(1, "True", ""), (2, "True", "False"), (3, "", "False"), (4, "1", "no")], "i int, is_only_korean string, is_illegible string")
    assert sorted(r.i for r in df.where(predicates.only_korean_legible()).collect()) == [2, 4]


def test_assert_listed(spark):
    lines, files = frame(spark, [("a",), ("b",)], "value string"), frame(spark, [("a",)], "value string")
    assert predicates.assert_listed(files, lines).count() == 1
    with pytest.raises(RuntimeError, match="b"):
        predicates.assert_listed(lines, files)


@pytest.mark.parametrize("parts", [1, 7])
def test_dedup(spark, parts):
    rows = [(1, "a"), (2, " a "), (3, ""), (4, None), (5, "b"), (6, "b")]
    df = frame(spark, rows, "i int, v string", parts)
    assert sorted(r.i for r in dedup.drop_duplicate_ids(df, "v", ["i"]).collect()) == [1, 3, 4, 5]
    assert sorted(r.i for r in dedup.drop_duplicates(df, ["v"], ["i"], "last").collect()) == [1, 2, 4, 6]
    assert sorted(r.i for r in dedup.duplicate_flag(df, ["v"]).where("is_valid").collect()) == [1, 2]
    assert sorted(r.i for r in dedup.duplicate_flag(df, ["v"], skip_empty=True).where("is_valid").collect()) == [1, 2, 3, 4]


def suffixed(values: list[str]) -> list[str]:
    used, out = set(), []
    for v in values:
        new, k = v, 0
        while v and new in used:
            k += 1
            new = f"{v}_{k}"
        used.add(new)
        out.append(new)
    return out


def test_unique_suffix(spark):
    rng = random.Random(2)
    for values in (["a", "a", "a_1", "", "a"], ["a_1", "a", "a", "a_1"], [rng.choice(["a", "a_1", "a_1_1", "a_2", "b", "c", ""]) for _ in range(60)]):
        df = frame(spark, list(enumerate(values)), "i int, v string")
        got = {r.i: r.v for r in dedup.unique_suffix(df, "v", ["i"]).collect()}
        assert [got[i] for i in range(len(values))] == suffixed(values)


def test_unique_suffix_of_hot_families(spark):
    """A value with nearly all rows among names that it will meet; families of many names; names that are no numbers."""
    rng = random.Random(12)
    hot = [rng.choice(["a"] * 40 + [f"a_{rng.choice([3, 7, 8, 250, 5000])}", f"a_{rng.choice([7, 9])}_{rng.randrange(1, 3)}", "a_007", "a_", "b"]) for _ in range(3000)]
    many = [rng.choice(["v", "v_1", "v_2", f"v_{rng.randrange(3, 9)}", f"v_1_{rng.randrange(1, 4)}", "v_1_1_1", "_1", ""]) for _ in range(150)]
    for values in (hot, many):
        df = frame(spark, list(enumerate(values)), "i int, v string")
        got = {r.i: r.v for r in dedup.unique_suffix(df, "v", ["i"]).collect()}
        assert [got[i] for i in range(len(values))] == suffixed(values)


def test_first_and_last_wins(spark):
    labels = frame(spark, [(1, "x", "one"), (2, "x ", "two"), (3, "", "none"), (4, "z", None)], "o int, text_id string, label string")
    preds = frame(spark, [("x", "a", "old"), ("y", "b", "old"), ("", "c", "old"), ("z", "d", "old")], "text_id string, infer string, label string")
    got = {r.text_id: (r.label, r.is_known) for r in joins.join_labels(preds, labels, ["o"]).collect()}
    assert got == {"x": ("two", True), "y": ("", False), "": ("", False), "z": ("", True)}
    merged = joins.merge_columns(preds, labels, ["label"], ["o"], "text_id", "text_id")
    assert {r.text_id: r.label for r in merged.collect()} == {"x": "one", "y": "old", "": "old", "z": ""}
    patch = frame(spark, [(1, "x", "", ""), (2, "y", "val", "new")], "o int, text_id string, split string, label string")
    patched = joins.apply_patch(preds.withColumn("split", F.lit("train")), patch, ["o"])
    assert {r.text_id: (r.split, r.label) for r in patched.collect()} == {"x": ("", "old"), "y": ("val", "new"), "": ("train", "old"), "z": ("train", "old")}


def test_pairs(spark):
    images, labels = frame(spark, [("i1",), ("i2",), ("q",)], "value string"), frame(spark, [("k",), ("r",)], "value string")
    mapping = {"i1": "k", "i2": "k"}
    assert [tuple(r) for r in joins.pair_paths(images, labels, mapping).collect()] == [("i1", "k")]
    assert sorted(map(tuple, joins.unpaired_paths(images, labels, mapping).collect())) == [("image", "k", "i2"), ("image", "q", "q"), ("label", "r", "r")]


def test_prefix_rules(spark):
    rules = frame(spark, [("a", "A"), ("a/b", "B"), ("c", "C")], "origin_path string, new_path string")
    df = frame(spark, [("a/b/x",), ("a/bc",), ("a",), ("d/a",), ("c/",)], "p string")
    got = {r.p for r in joins.longest_prefix(df, rules, "p").collect()}
    assert got == {"B/x", "A/bc", "A", "d/a", "C/"}
    with pytest.raises(Exception, match="no mapping"):
        joins.mapped_dirs(frame(spark, [("zz",)], "value string"), rules).collect()


def test_zip(spark):
    a, b = (frame(spark, [(i, f"{s}{i}") for i in range(4)], "_ord int, value string") for s in "ab")
    assert sorted((r.src, r.dst) for r in joins.zip_lines(a, b).collect()) == [(f"a{i}", f"b{i}") for i in range(4)]
    with pytest.raises(Exception, match="differ in length"):
        joins.zip_lines(a, b.where("_ord < 2")).collect()


def test_sets(spark):
    a, b = frame(spark, [("x",), ("x",), ("y\\z",), ("",)], "value string"), frame(spark, [("y/z",), ("x",), ("q",)], "value string")
    assert [r.value for r in setops.subtract_lines(a, b.where("value <> 'x'")).collect()] == ["x", "x"]
    assert setops.multiset_intersection_size(a, b, "value").collect()[0].matched_count == 1
    assert sorted(r.value for r in setops.multiset_difference(a, b).collect()) == ["", "x", "y\\z"]
    wide = setops.union_tables([frame(spark, [("1", "2")], "a string, b string"), frame(spark, [("3", "4")], "c string, a string")])
    assert wide.columns == ["a", "b", "c"] and sorted(map(tuple, wide.collect())) == [("1", "2", ""), ("4", "", "3")]


def test_statistics(spark):
    df = frame(spark, [("1",), ("1",), ("3",)], "v string")
    assert stats.bin_edges([-2, 1, 4]) == [0.5, 1, 4] and stats.bin_edges([1]) == []
    assert {r.bin_index: r["count"] for r in stats.histogram(df, "v", [1, 2, 3]).collect()} == {"0": 2, "1": 1, "below_min": 0, "above_max": 0}
    one = stats.variance(df.limit(1), "v").collect()[0]
    assert (one["count"], one.variance_population, one.variance_sample) == (1, 0.0, 0.0)
    with pytest.raises(Exception, match="not a number"):
        stats.variance(frame(spark, [("q",)], "v string"), "v").collect()
    assert {r.metric: r.value for r in stats.metric_rows(stats.variance(df, "v")).collect()}["count"] == "3"


def test_allocation_and_splits(spark):
    assert sampling.allocate(10, [1, 1, 1]) == [4, 3, 3] and sampling.allocate(0, [1, 2]) == [0, 0]
    df = frame(spark, [(i, "g" if i < 10 else "h") for i in range(11)], "i int, g string")
    out = sampling.split_by_ratio(df, ["i"], ["g"], (8, 1, 1))
    n = {(r.g, r.split): r["count"] for r in out.groupBy("g", "split").count().collect()}
    assert n == {("g", "train"): 8, ("g", "val"): 1, ("g", "test"): 1, ("h", "test"): 1}
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, sampling.split_by_ratio(df.repartition(7), ["i"], ["g"], (8, 1, 1)).collect()))
    drawn = sampling.sample_merge([df, df], [1, 1], 40, ["i"], replacement=True)
    assert drawn.count() == 40
    with pytest.raises(ValueError, match="fewer"):
        sampling.sample_merge([df], [1], 12, ["i"])


def test_tag_balanced_split(spark):
    rng = random.Random(1)
    rows = [(f"s{rng.randrange(200)}", rng.choice("ab"), rng.choice(["x", "x", "x", "y"])) for _ in range(2000)] + [("", "a", "x"), (None, "b", "x")]
    df = frame(spark, rows, "scene string, t string, u string")
    out = sampling.split_tag_balanced(df, "scene", ["t", "u"])
    assert out.count() == len(rows)
    assert out.groupBy("scene").agg(F.count_distinct("split").alias("n")).where("scene <> '' and n > 1").isEmpty()
    for tag in ("t", "u"):
        got = {(r[tag], r.split): r["count"] for r in out.groupBy(tag, "split").count().collect()}
        for v in {k[0] for k in got}:
            total = sum(n for (a, _), n in got.items() if a == v)
            assert got[v, "train"] / total == pytest.approx(0.8, abs=0.05)
    assert sorted(map(str, out.collect())) == sorted(map(str, sampling.split_tag_balanced(df.repartition(5), "scene", ["t", "u"]).collect()))


def test_path_plans(spark):
    mapping = frame(spark, [("a", "b"), ("c", "c"), ("d", "e"), ("f", "g"), ("h", "b2"), ("", "x"), ("i", "z"), ("j", "z")], "origin_path string, new_path string")
    there = frame(spark, [(p,) for p in ("a", "c", "e", "h", "b2", "i", "j")], "value string")
    got = {r.origin_path: r.status for r in paths.mapping_status(mapping, there).collect()}
    assert got == {"a": "rename", "c": "unchanged", "d": "already_applied", "f": "missing", "h": "conflict", "": "invalid", "i": "conflict", "j": "conflict"}
    plan = paths.deletion_plan(frame(spark, [("r/a",), ("r/keep",), ("q",), ("r",)], "value string"), "r", ["r/keep/x"])
    assert {r.path: r.status for r in plan.collect()} == {"r/a": "delete", "r/keep": "protected", "q": "outside", "r": "protected"}
    files = frame(spark, [("d/e/f.txt",)], "value string")
    assert {r.path: r.status for r in paths.dir_status(frame(spark, [("d",), ("d/e",), ("x",), ("n",), ("d/e/f.txt",)], "value string"), files, frame(spark, [("n",)], "value string")).collect()} == {"d": "exists", "d/e": "exists", "x": "missing", "n": "empty", "d/e/f.txt": "not_dir"}


def test_apply_plan(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("x")
    plan = frame(spark, [("a.txt", "sub/b.txt"), ("gone.txt", "c.txt")], "src string, dst string")
    run = lambda **k: {r.src: r.done for r in paths.apply_plan(plan, "copy", f"{tmp_path}/in", f"{tmp_path}/out", **k).collect()}
    assert run() == {"a.txt": "would_copy", "gone.txt": "missing"} and not (tmp_path / "out").exists()
    assert run(dry_run=False)["a.txt"] == "copy" and (tmp_path / "out/sub/b.txt").read_text() == "x"
    assert run(dry_run=False)["a.txt"] == "exists"


def test_csv_round_trip(spark, tmp_path):
    rows = [(0, 'say "hi"', "a,b"), (1, "two\nlines", ""), (2, " padded ", "한글")]
    df = frame(spark, rows, "_ord int, x string, y string")
    path = f"{tmp_path}/t.csv"
    sinks.write_csv(df, path, ["_ord"], ["x", "y"])
    raw = (tmp_path / "t.csv").read_bytes()
    assert raw.startswith(b"\xef\xbb\xbfx,y\r\n") and b'"say ""hi"""' in raw
    got = readers.read_csv(spark, path, ordinal=True)
    assert got.columns == ["x", "y", "_ord"] and [(r.x, r.y) for r in got.orderBy("_ord").collect()] == [r[1:] for r in rows]
    sinks.write_csv(got.where("y <> ''"), path, ["_ord"], ["x", "y"])
    assert readers.read_csv(spark, path).count() == 2


def test_predictions(spark, tmp_path):
    (tmp_path / "p.txt").write_text("﻿a/b_1.jpg\t치킨\n\nc.jpg\tx\ty \n", encoding="utf-8")
    assert [(r.text_id, r.infer) for r in readers.read_predictions(spark, f"{tmp_path}/p.txt").collect()] == [("b_1", "치킨"), ("c", "x\ty")]
    (tmp_path / "p.jsonl").write_text("\n".join(json.dumps(x) for x in ({"filename": "a.jpg", "text": None}, {"filename": "b.jpg", "text": 5})), encoding="utf-8")
    assert [(r.text_id, r.infer) for r in readers.read_predictions(spark, f"{tmp_path}/p.jsonl").collect()] == [("a", ""), ("b", "5")]
    (tmp_path / "bad.txt").write_text("no tab here\n")
    with pytest.raises(Exception, match="no tab"):
        readers.read_predictions(spark, f"{tmp_path}/bad.txt").collect()


def test_label_documents(spark, tmp_path):
    doc = {"images": [{"width": 640, "height": 480, "date_captured": "2020"}], "metadata": {"light": "day", "area": 3}, "annotations": [{"id": 1, "text": "가", "bbox": [1, 2, 3, 4]}, {"text": "no id"}, {"id": 2, "text": None, "bbox": [[0, 0], [1, 0], [1, 1], [0, 1]]}]}
    (tmp_path / "s7.json").write_text(json.dumps(doc), encoding="utf-8")
    (tmp_path / "s8.json").write_text("not json")
    labels = readers.read_label_json(spark, f"{tmp_path}/*.json")
    image = readers.images_of(labels).collect()
    assert [(r.image_id, r.width, r.area, r.light) for r in image] == [("s7", "640", "3", "day")]
    assert [(r.inner_ann_id, r.text) for r in readers.annotations_of(labels).orderBy("inner_ann_id").collect()] == [("1", "가"), ("2", "")]
    assert readers.bad_label_files(labels).count() == 1
    scenes, texts = curate.standardise_documents(labels)
    assert [r.scene_id for r in scenes.collect()] == ["aihub_s7"]
    assert {r.text_id: (r.is_valid_bbox_format, r.language_category) for r in texts.collect()} == {"aihub_s7_1": (True, "KOR"), "aihub_s7_2": (True, "OTHERS")}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_picks_sort_by_hash_and_shrink_before_the_shuffle(spark):
    df = frame(spark, [("a", 2, "x"), ("a", 1, "y"), (" a", 0, "z"), ("", 1, "u"), (" ", 2, "v"), (None, 3, "w"), ("b", None, "n"), ("b", 5, "m")], "id string, o int, v string")
    out = dedup.drop_duplicate_ids(df, "id", ["o"])
    assert sorted(r.v for r in out.collect()) == ["n", "u", "v", "w", "z"] and out.columns == df.columns
    last = dedup.drop_duplicates(df, ["id"], ["o"], keep="last")
    assert sorted(r.v for r in last.collect()) == ["m", "v", "w", "x", "z"]  # null and the empty string are one value
    plan = _plan(out)
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan and "xxhash64" in plan


def test_flags_of_boxes_are_read_before_rows_are_picked(spark):
    images = frame(spark, [("s1", "a/s1.jpg", "640", "480", "2020", "day"), ("s2", "a/s2.jpg", "640", "480", "2020", "night")], "image_id string, image_file string, width string, height string, data_captured_date string, light string")
    boxes = ["[1, 2, 30, 4]", "[[0, 0], [9, 0], [9, 9], [0, 9]]", "none", "[1, 2, -3, 4]", "[1, 2, \"a\", 4]"]
    annotations = frame(spark, [(s, str(i), f"text {i}", b) for s in ("s1", "s2") for i, b in enumerate(boxes)] + [("s1", "0", "z", "none")], "image_id string, inner_ann_id string, text string, bbox string")
    scenes, texts = curate.standardise(images, annotations)
    plan = _plan(texts.where("is_valid_bbox_format and is_valid_bbox_value").select("text_id"))
    assert plan[: plan.index("Window")].count("RLIKE") == 0  # the filter reads two columns, no boxes
    out = curate.split(texts, scenes, ["text_id"])
    rows = {r.text_id: (r.width, r.height, r.aspect_ratio, r.linear_aspect_ratio_bin, r.light) for r in out.collect()}
    assert rows == {f"aihub_{s}_{i}": v + (light,) for s, light in (("s1", "day"), ("s2", "night")) for i, v in enumerate([(30.0, 4.0, 7.5, 7), (9.0, 9.0, 1.0, 1)])}
    assert any("glyphforge-rows" in f for f in out.inputFiles())  # written once, for the tags and for the rows themselves


def test_listings_and_archives(spark, tmp_path):
    import zipfile

    for p in ("a/b/x.jpg", "a/y.PNG", "c/z.txt"):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text("x")
    files = readers.list_files(spark, str(tmp_path))
    assert sorted(r.value for r in files.collect()) == ["a/b/x.jpg", "a/y.PNG", "c/z.txt"]
    assert sorted(r.value for r in readers.leaf_dirs(files).collect()) == ["a/b", "c"]
    assert sorted(r.text_id for r in readers.image_ids(files).collect()) == ["x", "y"]
    assert [r.value for r in readers.list_files(spark, str(tmp_path), ["jpg"]).collect()] == ["a/b/x.jpg"]
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("in/한.txt", "x")
        z.writestr("../out.txt", "x")
    assert [r.member for r in readers.read_archives(spark, f"{tmp_path}/t.zip").collect()] == ["in/한.txt"]
    assert archives.repair_name("가.txt".encode("cp949"), False) == archives.repair_name("가.txt".encode(), True) == "가.txt"


def test_report_example(spark):
    labels = frame(spark, [(1, "a", "치킨", "True", ""), (2, "b", "치킨", "", "")], "o int, text_id string, label string, KSTR_is_curve string, KSTR_is_salient string")
    preds = frame(spark, [("a", "치킨"), ("b", "친친"), ("zz", "x")], "text_id string, infer string")
    scored = evaluate.score_predictions(preds, labels, ["o"])
    m = evaluate.means(scored).collect()[0]
    assert (m.samples, m.accuracy, round(m.gned_sim, 6)) == (2, 0.5, 0.833333)
    c = evaluate.coverage(preds, labels, ["o"]).collect()[0]
    assert tuple(c) == (3, 2, 1, 0)
    by = {r.tag: (r.samples, r.accuracy) for r in evaluate.means_by_tag(scored, labels, ["KSTR_is_curve", "KSTR_is_salient"]).collect()}
    assert by == {"KSTR_is_curve": (1, 1.0), "KSTR_is_salient": (0, None)}
    grid = evaluate.score_predictions(preds, labels, ["o"], unmatched="as_empty")
    assert evaluate.means(grid).collect()[0].samples == 3
    assert evaluate.file_means(scored.limit(0)).collect()[0].accuracy == 0


def test_ordinals_and_names(spark):
    pairs = frame(spark, [(f"d/{i:02d}.jpg", f"l/{i:02d}.json") for i in range(20)], "image_file string, label_file string")
    got = {r.origin_path: r.new_path for r in columns.rename_map(pairs, ["image_file"], start=5, padding=4, prefix="n").collect()}
    assert got == {f"{d}/{i:02d}.{e}": f"{d}/n{i + 5:04d}.{e}" for i in range(20) for d, e in (("d", "jpg"), ("l", "json"))}


def test_column_errors(spark):
    df = frame(spark, [("4", "0", "q")], "width string, height string, bbox string")
    with pytest.raises(Exception, match="ZERO"):
        columns.arithmetic_column(df).collect()
    with pytest.raises(Exception, match="bbox"):
        columns.bbox_size_columns(df).collect()
    with pytest.raises(Exception, match="not a number"):
        columns.formula_column(df, "f", "x + 1", "bbox").collect()


def test_pipeline_steps(spark):
    p = Pipeline("t").add("one", lambda d: d.where("id > 1")).add("off", lambda d: d.limit(0), enabled=False)
    out = p.run(spark.range(5), count=True)
    out.write.format("noop").mode("overwrite").save()
    assert p.counts == {"one": 3} and p.summary() == {"input": {"rows": 5}, "one": {"rows": 3, "dropped": 2}}
    assert p.run(spark.range(5)).count() == 3 and p.summary() == {}
    with pytest.raises(ValueError, match="two steps"):
        p.add("one", lambda d: d)
    with pytest.raises(RuntimeError, match="step bad"):
        Pipeline("t").add("bad", lambda d: d.select("nothing")).run(spark.range(1))


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/p.csv").write_text("text_id,infer\na,치킨\nb,친친\nzz,x\n", encoding="utf-8")
    labels = frame(spark, [(1, "a", "치킨"), (2, "b", "치킨")], "o int, text_id string, label string")
    scored = scoring.score_stream(scoring.read_prediction_stream(spark, f"{tmp_path}/in"), labels, ["o"])
    q = scoring.write_stream(scored.select("text_id", "is_match", "gned_sim"), f"{tmp_path}/out", f"{tmp_path}/state")
    assert q.awaitTermination(120)
    assert {r.text_id: r.is_match for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {"a": 1, "b": 0}
    assert scoring.windowed_means(scored).columns == ["window", "samples", "accuracy", "gned_sim"]


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_ordinals_of_a_million_keys(spark, tmp_path, aqe):
    """Every number once, whatever becomes of the range exchange's partitions."""
    n, before = 1_000_000, spark.conf.get("spark.sql.adaptive.enabled")
    path = str(tmp_path / "keys")
    spark.range(n).select(F.md5(F.col("id").cast("string")).alias("k")).write.parquet(path)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        got = columns.ordinals(spark.read.parquet(path), ["k"], "o")
        least, most, kinds, rows = got.agg(F.min("o"), F.max("o"), F.count_distinct("o"), F.count("*")).first()
        wrong = got.select("o", F.lead("k").over(Window.orderBy("o")).alias("next"), "k").where("next <= k").limit(1).count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert (least, most, kinds, rows, wrong) == (0, n - 1, n, n, 0)


def test_ordinals_within_groups(spark):
    rows = [(g, i) for g, n in ((None, 5), ("", 3), ("hot", 3000), ("b", 1)) for i in range(n)]
    got = columns.ordinals(spark.createDataFrame(rows, "g string, i int").repartition(5), ["i"], "o", ["g"], "n").collect()
    size = {None: 5, "": 3, "hot": 3000, "b": 1}
    assert all(r.o == r.i and r.n == size[r.g] for r in got)
    assert len(got) == len(rows)
    assert columns.ordinals(spark.createDataFrame([], "g string, i int"), ["i"], "o", ["g"], "n").collect() == []


def brute_split(rows, ratio, rounds):
    """Groups' splits by the rule: rows are (group, tags)."""
    pairs: dict = {}
    for g, tags in rows:
        for t in tags:
            pairs[g, t] = pairs.get((g, t), 0) + 1
    total: dict = {}
    for (_, t), n in pairs.items():
        total[t] = total.get(t, 0) + n
    ranked = sorted(total, key=lambda t: (total[t], t))
    late = ranked[max(0, len(ranked) - rounds + 1) :]
    own = {}
    for t in ranked:
        for g, u in pairs:
            if u == t:
                own.setdefault(g, t)
    split: dict = {}
    have = {t: [0, 0, 0] for t in ranked}

    def deal(t, given):
        groups = sorted((g for g in own if own[g] == t), key=lambda g: (hashlib.md5(g.encode()).hexdigest(), g))
        left, at = sum(pairs[g, t] for g in groups), 0
        if not left:
            return
        lack = [max(0.0, (total[t] if t in late else 1) * (r / sum(ratio)) - h) for r, h in zip(ratio, given, strict=True)]
        cuts = [left * (sum(lack[: i + 1]) / sum(lack)) for i in range(2)]
        for g in groups:
            middle = at + pairs[g, t] / 2
            split[g] = sum(middle >= c for c in cuts)
            at += pairs[g, t]

    def count(done):
        for g in done:
            for t in late:
                have[t][split[g]] += pairs.get((g, t), 0)

    for t in ranked:
        if t not in late:
            deal(t, [0, 0, 0])
    count(list(split))
    for t in late:
        before = set(split)
        deal(t, have[t])
        count(set(split) - before)
    return {g: sampling.SPLITS[s] for g, s in split.items()}


@pytest.mark.parametrize(("values", "rounds"), [(3, 32), (60, 8), (60, 32), (4, 2)])
def test_split_tag_balanced_in_rounds(spark, values, rounds):
    """The rule restated; tags of few and many values, more than the rounds, groups of one row and of a third of all."""
    rng = random.Random(values + rounds)
    rows = [(f"g{rng.randrange(150)}" if rng.random() < 0.67 else "hot", f"a{min(rng.randrange(values), rng.randrange(values))}", rng.choice("xy")) for _ in range(1500)]
    df = spark.createDataFrame(rows, "g string, a string, b string")
    want = brute_split([(g, (f"a_{a}", f"b_{b}")) for g, a, b in rows], (0.8, 0.1, 0.1), rounds)
    for part in (2, 7):
        out = sampling.split_tag_balanced(df.repartition(part), "g", ["a", "b"], rounds=rounds).collect()
        assert len(out) == len(rows) and {r.g: r.split for r in out} == want
    assert sampling.split_tag_balanced(df.limit(0), "g", ["a"]).collect() == []
    assert {r.split for r in sampling.split_tag_balanced(df, "g", []).collect()} == {"train"}


@pytest.mark.parametrize("gather", [5, 10_000])
def test_take_without_gathering(spark, gather):
    """The same rows as in order, at every place; rows of one key, and rows equal in all columns, in any choice of them."""
    df = spark.range(3000).withColumn("v", F.col("id") % 7).repartition(3)
    order = [r.id for r in df.orderBy(sampling.shuffled(["id"], 5), "id").collect()]
    for n in (1, 6, 1500, 2999, 3000, 4000):
        assert sorted(r.id for r in sampling.take(df, n, ["id"], 5, gather=gather).collect()) == sorted(order[:n])
    assert sorted(r.id for r in sampling.take(df, 100, ["id"], 5, shuffle=False, gather=gather).collect()) == list(range(100))
    same = spark.range(400).select((F.col("id") % 2).alias("k"), (F.col("id") % 40).alias("v"))
    for n in (77, 201, 399):
        got = [tuple(r) for r in sampling.take(same, n, ["k"], 5, gather=gather).collect()]
        assert len(got) == n and max(got.count(x) for x in set(got)) <= 10
        assert min(sum(k == x for k, _ in got) for x in (0, 1)) == max(0, n - 200)
    assert sampling.take(df.limit(0), 10, ["id"], 5, gather=gather).collect() == []


def test_take_plan(spark):
    out = sampling.take(spark.range(5000), 2500, ["id"], 1, gather=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all(int(k) <= 50 for k in re.findall(r"[lL]imit(?:=| )(\d+)", plan))


def test_move_plan(spark):
    """Chains in order, circles by a temporary name, blocked chains, and what cannot be told; run against a table of names."""
    rng = random.Random(5)
    rules = [("a", "b"), ("b", "c"), ("c", "d"), ("x", "y"), ("y", "x"), ("p", "q"), ("q", "r"), ("s", "t"), ("u", "t"), ("v", "w"), ("v", "z"), ("", "k"), ("m", "m"), ("gone", "new"), ("a", "b")]
    ring = [f"r{k}" for k in range(11)]
    rules += [(ring[k], ring[(k + 1) % 11]) for k in range(11)] + [(f"l{k}", f"l{k + 1}") for k in range(40)]
    rng.shuffle(rules)
    names = {"a", "b", "c", "x", "y", "p", "q", "r", "s", "u", "v", "m", *ring, *(f"l{k}" for k in range(40))}
    out = paths.move_plan(frame(spark, rules, "origin_path string, new_path string"), frame(spark, [(n,) for n in names], "value string")).collect()
    told = {(r.src, r.dst): r.status for r in out}
    assert told["p", "q"] == told["q", "r"] == "conflict" and told["s", "t"] == told["u", "t"] == told["v", "w"] == told["v", "z"] == "ambiguous"
    assert (told["", "k"], told["m", "m"], told["gone", "new"]) == ("invalid", "unchanged", "missing")
    disk = {n: n for n in names}
    moves = [r for r in out if r.status == "move"]
    for stage in sorted({r.stage for r in moves}):
        here = [r for r in moves if r.stage == stage]
        assert not {r.dst for r in here} & set(disk)  # side by side
        for r in here:
            disk[r.dst] = disk.pop(r.src)
    want = {"a": "b", "b": "c", "c": "d", "x": "y", "y": "x"} | {f"l{k}": f"l{k + 1}" for k in range(40)} | {ring[k]: ring[(k + 1) % 11] for k in range(11)}
    assert {v: k for k, v in disk.items()} == {n: want.get(n, n) for n in names}
    listed, plan = paths.remap_path_list(frame(spark, [("a/b/f",), ("a/g",), ("o/f",)], "value string"), frame(spark, [("a", "z"), ("a/b", "y"), ("q", "w")], "origin_path string, new_path string"))
    assert sorted(r.value for r in listed.collect()) == ["o/f", "y/f", "z/g"]
    assert {(r.src, r.status) for r in plan.collect()} == {("a", "move"), ("a/b", "move"), ("q", "missing")}


def test_reasons_without_a_parser(spark):
    """common spellings are read without a JSON parser, and no reason is worked out twice; odd spellings keep their reasons."""
    want = {"[1, 2, 3, 4]": None, " [1,2,3,0]\u3000": "nonpositive_bbox", "[1, 2, 3]": "invalid_bbox", "[1, 2, 3, 4, 0]": None, "[1, 2, -3, 4, 5]": "nonpositive_bbox", '["1", "2", "x", "4"]': "invalid_bbox", '["1", "2", " 3 ", "0"]': "nonpositive_bbox", "[[1, 2], [3, 2], [3, 4], [1, 4]]": "invalid_bbox", "[1,\x0b2,3,4]": "invalid_bbox", "[1, null, 3, 4]": "invalid_bbox", " None ": "bbox_none", "{}": "invalid_bbox", "[1, 2, 3, 1e400]": None}
    df = frame(spark, [("i", "t", b) for b in want], "image_id string, text string, bbox string")
    reason = predicates.outlier_reason()
    assert {r.bbox: r.reason for r in df.select("bbox", reason.alias("reason")).collect()} == want
    dropped = predicates.drop_outliers(df)[1]
    assert {r.reason: r["count"] for r in dropped.collect()} == {"bbox_none": 1, "invalid_bbox": 6, "nonpositive_bbox": 3}
    assert "Filter" not in dropped._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1]


def test_move_plan_without_broadcasts(spark, monkeypatch):
    """no round of a move plan sends its tables through the driver."""
    plans = []
    kept = paths.written
    monkeypatch.setattr(paths, "written", lambda df, name="table", by=(): plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name, by))
    names = [f"f{i}" for i in range(9)]
    rules = [*zip(names[:6], names[1:7], strict=True), ("f7", "f8"), ("f8", "f7")]
    out = paths.move_plan(frame(spark, rules, "origin_path string, new_path string"), frame(spark, [(n,) for n in [*names[:6], "f7", "f8"]], "value string"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert plans and not any("BroadcastHashJoin" in p for p in plans)
    assert {r.src: r.stage for r in out.collect() if r.src in names[:6]} == {f"f{i}": 6 - i for i in range(6)}


def test_file_operations_are_dealt_out(spark, tmp_path):
    """a plan that lies in one partition is carried out by all cores."""
    plan = frame(spark, [(f"a{i}", f"b/{i}") for i in range(40)], "src string, dst string").coalesce(1)
    for i in range(40):
        (tmp_path / f"a{i}").write_text(str(i))
    done = paths.apply_plan(plan, "move", str(tmp_path), str(tmp_path), dry_run=False)
    assert done.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert {r.done for r in done.collect()} == {"move"} and len(list((tmp_path / "b").iterdir())) == 40


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """a listing is read from tables, not from an index of files on the driver; hidden and empty files are in it."""
    names = {"a/b/x.jpg", "a/b/_y", "a/.z", "e%20 é", "a/b/empty", *(f"many/{i}" for i in range(25))}
    for n in names:
        (tmp_path / "t" / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / n).write_text("" if n == "a/b/empty" else "x")
    (tmp_path / "t/none").mkdir()
    (tmp_path / "t/loop").symlink_to(tmp_path / "t")
    monkeypatch.setattr(listing, "BATCH_ROWS", 7)
    found = readers.list_files(spark, f"file://{tmp_path}/t")
    assert sorted(r.value for r in found.collect()) == sorted(names)
    assert all(f.endswith(".parquet") for f in found.inputFiles())
    assert readers.list_files(spark, f"{tmp_path}/t/none").collect() == []
    assert {r.value for r in readers.list_files(spark, f"{tmp_path}/t", ["jpg"]).collect()} == {"a/b/x.jpg"}


def test_scratch_folders_go_entry_by_entry(tmp_path):
    """a folder of many files is deleted without a list of them; what links point to stays."""
    (tmp_path / "kept").mkdir()
    (tmp_path / "kept/f").write_text("x")
    (tmp_path / "t/a/b").mkdir(parents=True)
    for i in range(300):
        (tmp_path / f"t/a/{i}").write_text("x")
    (tmp_path / "t/a/link").symlink_to(tmp_path / "kept")
    scratch._delete_tree(f"{tmp_path}/t")
    assert [p.name for p in tmp_path.iterdir()] == ["kept"] and (tmp_path / "kept/f").exists()
