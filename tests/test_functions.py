"""Text, Hangul, geometry and formula expressions on known vectors."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from glyphforge.functions import formula, geometry, hangul, text


def column(spark, values, expr, kind="string"):
    """The values of an expression over a column v, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}").repartition(3)
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def pairs(spark, rows, expr):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "i int, a string, b string").repartition(3)
    return [r.out for r in df.select("i", expr(F.col("a"), F.col("b")).alias("out")).orderBy("i").collect()]


SPACES = "".join(map(chr, [*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def test_white_space_is_pythons(spark):
    values = [f"{c}a{c}b{c}" for c in SPACES] + ["", None, "​a​"]
    assert column(spark, values, text.strip) == [None if v is None else v.strip() for v in values]
    assert column(spark, values, text.normalize_text) == ["".join((v or "").split()) for v in values]
    assert column(spark, values, text.words) == [(v or "").split() for v in values]


def test_floats_are_pythons(spark):
    values = ["1", " 1.5 ", "-.5", "1.", "1e3", "1_000", "1__0", "inf", "-Infinity", "nan", "1d", "1.5f", "0x10", "", None, "abc", "+2E-2", "_1", "1_"]

    def parsed(v):
        try:
            return float(v)
        except (TypeError, ValueError):
            return None

    got = column(spark, values, text.py_float)
    assert [str(x) for x in got] == [str(parsed(v)) for v in values]


def test_truth(spark):
    values = [" TRUE ", "t", "y", "", "0", "No", None]
    assert column(spark, values, text.to_bool) == [True, True, None, None, False, False, None]


def test_paths(spark):
    values = ["a\\b/gist_12_3.jpg", "x/y.v2.jpg", ".hidden", "a/b/", "noext", ""]
    assert column(spark, values, text.file_stem) == ["gist_12_3", "y.v2", ".hidden", "b", "noext", ""]
    assert column(spark, ["/a//b/c/d/e.jpg"], text.path_prefix) == ["a/b/c/d"]
    assert column(spark, ["images\\x.jpg", "images", "imagesx/y"], lambda c: text.replace_prefix(c, "images", "scene_images")) == ["scene_images/x.jpg", "scene_images", "imagesx/y"]
    assert column(spark, ["/r/text_images/1/a.jpg", "/b.jpg"], text.subset_image_path) == ["1/a.jpg", "b.jpg"]
    assert column(spark, ["1/aihub_7_1.jpg", "gist_2.jpg", "x/other_1.jpg"], text.jsonl_filename) == ["1/7_1.jpg", "2.jpg", "x/other_1.jpg"]
    assert column(spark, ["a.JPG", "b", "c/.x", "d.tar.gz"], text.extension) == [".JPG", "(no_ext)", "(no_ext)", ".gz"]
    assert pairs(spark, [("aihub_61090", "aihub_61090_2")], text.bucket_path) == ["text_images/61/aihub_61090_2.jpg"]
    assert column(spark, ["5", "aihub_5", "", None], lambda c: text.prefixed_id(c, "aihub_")) == ["aihub_5", "aihub_5", "", ""]
    assert column(spark, ["a : b", "c"], text.before_colon) == ["a", "c"]


def test_languages(spark):
    values = ["카페Cafe", "GS25 편의점", "", "ㅋㅋ!", "²", None]
    assert column(spark, values, text.language_category) == ["KOR+ENG", "ENG+DIGIT+KOR", "OTHERS", "KOR+SPECIAL", "DIGIT", "OTHERS"]
    assert column(spark, ["a b"], lambda c: text.language_category(c, False)) == ["ENG+SPACE"]
    assert column(spark, ["한글", "한1", "ab", "ab!", "한ab", "한ab.", "12"], text.word_group) == ["korean", "korean_plus", "english", "english_plus", "korean_english", "korean_english_plus", "others"]
    assert column(spark, list("한ㄱa1① .$　中"), text.char_category) == ["korean", "korean", "english", "digit", "digit", "space", "special", "special", "space", "other"]


def spec_distance(g: str, p: str, w: str) -> int:
    """Smallest cost over all ways to read gold against pred, by the definition."""
    row = list(range(len(p) + 1))
    for t in g:
        free = t == w
        new = [row[0] + (not free)]
        for j in range(1, len(p) + 1):
            new.append(min(row[j] + (not free), row[j - 1] + (not (free or t == p[j - 1])), new[j - 1] + 1))
        row = new
    return row[-1]


def test_languages_need_no_split_into_characters(spark):
    cells = ["가a1!", "!1a가", "²x", "😀９", "\u3000", "a b", " 漢a", "٣é", "x\n1", "", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    found = df.select("i", text.language_category(F.col("c")).alias("a"), text.language_category(F.col("c"), False).alias("b"))
    assert [tuple(r)[1:] for r in found.orderBy("i").collect()] == [
        ("KOR+ENG+DIGIT+SPECIAL",) * 2, ("SPECIAL+DIGIT+ENG+KOR",) * 2, ("DIGIT+ENG",) * 2, ("SPECIAL+DIGIT",) * 2, ("OTHERS", "SPACE"), ("ENG", "ENG+SPACE"),
        ("SPECIAL+ENG", "SPACE+SPECIAL+ENG"), ("DIGIT+SPECIAL",) * 2, ("ENG+DIGIT", "ENG+SPACE+DIGIT"), ("OTHERS",) * 2, ("OTHERS",) * 2,
    ]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_numbers_of_ids(spark):
    ids = ["12", "+5", "-5", "a_7", "a_7-b", "a-7_8x", "1_2_", "x", "", "_3-4\n", "a_99999999999999999999", "3\n_b"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(ids)], "i int, c string")
    assert [r.n for r in df.select("i", text.numeric_id(F.col("c")).alias("n")).orderBy("i").collect()] == [12, 5, -5, 7, 7, 7, 2, 0, 0, 4, 0, 3]


def test_scores_on_known_pairs(spark):
    rows = [("치킨", "치킨"), ("치킨", "친친"), ("퀸 노래방", "퀸노래방"), ("Cafe", "cafe"), ("안녕하□요", "안녕하세요"), ("안녕하□요", "안녕하요"), ("안녕하□요", "안녕하세서요"), ("", ""), ("", "가"), (None, "가"), ("a.c", "abc"), ("a□c", "a\nc"), ("(□", "(x")]
    got = pairs(spark, rows, lambda a, b: F.struct(*(c.alias(n) for c, n in zip(hangul.score_columns(a, b), "ms", strict=True))))
    want = [(1, 1.0), (0, 0.666667), (1, 1.0), (0, 0.75), (1, 1.0), (1, 1.0), (0, 0.928571), (1, 1.0), (0, 0.0), (0, 0.0), (0, 0.666667), (1, 1.0), (1, 1.0)]
    assert [(r.m, round(r.s, 6)) for r in got] == want


def test_wildcard_distance_by_definition(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab□c") for _ in range(rng.randint(0, 6)))
    rows = [(word(), word()) for _ in range(150)]
    assert pairs(spark, rows, hangul.wildcard_distance) == [spec_distance(a, b, "□") for a, b in rows]


def test_wildcard_distance_over_words_of_bits(spark):
    """Texts of none to several words of bits, wildcards first, last and in rows, letters beyond the basic plane."""
    rng = random.Random(9)
    sizes = [0, 1, 61, 62, 63, 123, 124, 125, 190]
    rows = []
    for _ in range(120):
        p = "".join(rng.choice("ab🙂한") for _ in range(rng.choice(sizes)))
        g = list(p) if rng.random() < 0.7 else [rng.choice("ab🙂한□") for _ in range(rng.choice(sizes))]
        for _ in range(rng.randint(0, 12)):
            at = rng.randint(0, len(g))
            g[at : at + rng.randint(0, 3)] = rng.choice(["□", "", "a", "□□□", "bb"])
        rows.append(("".join(g), p))
    for size in (62, 5):
        hangul.BLOCK, kept = size, hangul.BLOCK
        try:
            assert pairs(spark, rows, hangul.wildcard_distance) == [spec_distance(a, b, "□") for a, b in rows]
        finally:
            hangul.BLOCK = kept


def test_letters(spark):
    assert column(spark, ["한", "가", "a□", "힣"], hangul.letters) == ["ㅎㅏㄴ", "ㄱㅏ", "a□□□", "ㅎㅣㅎ"]


def test_boxes(spark):
    values = ["", "[0,0,5,5]", "[-1,0,5,5]", "[0,0,0,5]", "[[0,0],[4,0],[4,2],[0,2]]", '["1","2","3","4",{}]', "[1,2,3]", "null", "[1,2,\"x\",4]", None, "{}"]
    assert column(spark, values, geometry.bbox_format_ok) == [False, True, True, True, True, True, False, False, False, False, False]
    assert column(spark, values, geometry.bbox_value_ok) == [True, True, False, False, True, True, True, True, True, True, True]
    assert column(spark, ["[10,20,30,40]", "[[1,2],[3,4],[5,6],[7,8]]", "[1,2,3]", ""], geometry.bbox_to_points) == [[[10, 20], [40, 20], [40, 60], [10, 60]], [[1, 2], [3, 4], [5, 6], [7, 8]], None, None]
    got = column(spark, ["[0.5,0.5,2,2]", "[0,0,0.2,5]", "x"], geometry.points_size)
    assert [tuple(r) if r else None for r in got] == [(2, 2), None, None]


def test_aspect_bins(spark):
    assert column(spark, [2.5, 1.0, 0.99, 0.5, 0.4], geometry.aspect_bin, "double") == [2, 1, -1, -2, -2]
    with pytest.raises(Exception, match="aspect ratio"):
        column(spark, [0.0], geometry.aspect_bin, "double")


def test_polygons(spark):
    square = F.array(*(F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4))))
    assert column(spark, [1.0, 5.0, -1.0], lambda v: geometry.point_in_polygon(v, F.lit(1.0), square), "double") == [True, False, False]
    small = F.array(*(F.array(F.lit(x), F.lit(y)) for x, y in ((1.0, 1.0), (2.0, 1.0), (2.0, 2.0))))
    assert column(spark, [1.0], lambda v: geometry.polygon_in_polygon(small, square), "double") == [True]


FORMULAS = ["x + 1", "-x ** 2 // 3", "x % 3 - 7 % -3", "sqrt(abs(x)) * pi", "log(x * x + 1, 2) if x > 1 else round(x / 2)", "min(x, 2) + max(x, e)", "floor(x / 2) + ceil(x / 3)", "1 < x <= 3"]


@pytest.mark.parametrize("source", FORMULAS)
def test_formula_is_pythons(spark, source):
    env = {n: getattr(math, n) for n in ("sqrt", "log", "floor", "ceil", "pi", "e")} | {"abs": abs, "min": min, "max": max, "round": round}
    values = [-3.0, 0.5, 1.0, 2.0, 5.0]
    code = compile(source, "formula", "eval")
    want = [float(eval(code, {"__builtins__": {}}, env | {"x": v})) for v in values]  # the test's own constants
    got = column(spark, values, lambda v: formula.compile_formula(source, {"x": v}).cast("double"), "double")
    assert got == pytest.approx(want)


@pytest.mark.parametrize("source", ["x.real", "__import__('os')", "'a'", "x[0]", "lambda: 1", "y + 1", "open(x)"])
def test_formula_rejects(source):
    with pytest.raises((ValueError, SyntaxError)):
        formula.compile_formula(source, {"x": F.lit(1.0)})


def test_formula_errors_raise(spark):
    for source in ("1 / x", "log(x)", "sqrt(x - 1)"):
        with pytest.raises(Exception, match="formula"):
            column(spark, [0.0], lambda v, s=source: formula.compile_formula(s, {"x": v}), "double")
