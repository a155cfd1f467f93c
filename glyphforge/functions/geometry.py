"""Boxes and polygons in JSON text, as Spark columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphforge.functions.text import cell, py_float, strip

_POINTS, _FLAT = "array<array<string>>", "array<string>"
_NUMBER = r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?"
#: The common spellings, four JSON numbers and four pairs of them, which are read without a JSON parser.
_FOUR = rf"^\[\s*{_NUMBER}(?:\s*,\s*{_NUMBER}){{3}}\s*\]$"
_PAIRS = rf"^\[(?:\s*\[\s*{_NUMBER}\s*,\s*{_NUMBER}\s*\]\s*,){{3}}\s*\[\s*{_NUMBER}\s*,\s*{_NUMBER}\s*\]\s*\]$"
#: A list of lists; other lists are flat ones.
_NESTED = r"^\[[ \t\r\n]*\["


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _numbers(c: Column) -> Column:
    """Cells to doubles; null as a whole if one of them is no number."""
    return let(F.transform(c, py_float), lambda n: F.when(~F.exists(n, lambda v: v.isNull()), n))


def _listed(s: Column) -> Column:
    """The numbers of a text that _FOUR or _PAIRS fits."""
    return F.transform(F.split(s, ","), lambda v: F.btrim(v, F.lit("[] \t\n\x0b\f\r")).cast("double"))


def parse_bbox(c: Column) -> Column:
    """G1: struct(x, y, w, h) of `[x, y, w, h]` or of the box around the first four points; null where neither is there."""

    def around(pts: Column) -> Column:
        xs, ys = _numbers(F.transform(pts, lambda p: p[0])), _numbers(F.transform(pts, lambda p: p[1]))

        def box(e: Column) -> Column:
            return F.struct(e[0].alias("x"), e[2].alias("y"), (e[1] - e[0]).alias("w"), (e[3] - e[2]).alias("h"))

        ends = let(xs, lambda x: let(ys, lambda y: F.array(F.array_min(x), F.array_max(x), F.array_min(y), F.array_max(y))))
        return F.when((F.size(pts) == 4) & F.forall(pts, lambda p: F.size(p) >= 2), let(ends, lambda e: F.when(~F.exists(e, lambda v: v.isNull()), box(e))))

    def plain(s: Column) -> Column:
        return let(_numbers(F.slice(F.from_json(s, _FLAT), 1, 4)), lambda n: F.when(F.size(n) == 4, F.struct(*(n[i].alias(k) for i, k in enumerate("xywh")))))

    def four(n: Column) -> Column:
        return F.struct(*(n[i].alias(k) for i, k in enumerate("xywh")))

    def pairs(n: Column) -> Column:
        ends = F.array(*(f(*(n[i] for i in range(start, 8, 2))) for start in (0, 1) for f in (F.least, F.greatest)))
        return let(ends, lambda e: F.struct(e[0].alias("x"), e[2].alias("y"), (e[1] - e[0]).alias("w"), (e[3] - e[2]).alias("h")))

    def other(s: Column) -> Column:
        return F.when(s.rlike(_NESTED), let(F.slice(F.from_json(s, _POINTS), 1, 4), around)).otherwise(plain(s))

    return let(strip(cell(c)), lambda s: F.when(s.rlike(_FOUR), let(_listed(s), four)).when(s.rlike(_PAIRS), let(_listed(s), pairs)).when(s.startswith("["), other(s)))


def flat_sizes(s: Column) -> Column:
    """struct(w, h) of a trimmed `[x, y, w, h]` (what follows is passed over); null for anything else, points too."""

    def four(n: Column) -> Column:
        return F.struct(n[2].alias("w"), n[3].alias("h"))

    def other(n: Column) -> Column:
        return F.when(F.size(n) == 4, F.struct(n[2].alias("w"), n[3].alias("h")))

    pairs = F.when(F.lit(False), F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("h")))
    plain = s.rlike(_FOUR) & ~F.contains(s, F.lit("\x0b")) & ~F.contains(s, F.lit("\f"))  # which are no blanks of JSON
    return F.when(plain, let(_listed(s), four)).when(s.rlike(_PAIRS), pairs).when(s.startswith("["), let(_numbers(F.slice(F.from_json(s, _FLAT), 1, 4)), other))


def bbox_flags(c: Column) -> Column:
    """struct(format, value): whether a box can be read; false only for one that can and has a number that is not finite, a
    negative corner or no area."""

    def odd(b: Column) -> Column:
        loose = lambda v: F.isnan(v) | (F.abs(v) == float("inf"))
        return loose(b.x) | loose(b.y) | loose(b.w) | loose(b.h) | (b.x < 0) | (b.y < 0) | (b.w <= 0) | (b.h <= 0)

    return let(parse_bbox(c), lambda b: F.struct(b.isNotNull().alias("format"), (~F.coalesce(odd(b), F.lit(False))).alias("value")))


def bbox_format_ok(c: Column) -> Column:
    return bbox_flags(c)["format"]


def bbox_value_ok(c: Column) -> Column:
    return bbox_flags(c)["value"]


def bbox_to_points(c: Column) -> Column:
    """Four corner points of `[x, y, w, h]`, or four points as they are; null otherwise."""

    def given(pts: Column) -> Column:
        whole = (F.size(pts) == 4) & F.forall(pts, lambda p: (F.size(p) == 2) & ~F.exists(p, lambda v: v.isNull()))
        return F.when(whole, pts)

    def corners(n: Column) -> Column:
        return F.when(F.size(n) == 4, xywh_to_polygon(n[0], n[1], n[2], n[3]))

    def four(n: Column) -> Column:
        return xywh_to_polygon(*(n[i] for i in range(4)))

    def pairs(n: Column) -> Column:
        return F.array(*(F.array(n[i], n[i + 1]) for i in range(0, 8, 2)))

    def either(s: Column) -> Column:
        nested = let(F.transform(F.from_json(s, _POINTS), lambda p: F.transform(p, py_float)), given)
        flat = let(_numbers(F.from_json(s, _FLAT)), corners)
        return F.when(s.rlike(_FOUR), let(_listed(s), four)).when(s.rlike(_PAIRS), let(_listed(s), pairs)).when(s.rlike(_NESTED), nested).when(s.startswith("["), flat)

    return let(strip(cell(c)), either)


def points_size(c: Column) -> Column:
    """struct(width, height) in whole pixels between half-even rounded edges; null if not positive."""
    edge = lambda v: F.bround(v, 0).cast("long")

    def whole(b: Column) -> Column:
        w, h = edge(b.x + b.w) - edge(b.x), edge(b.y + b.h) - edge(b.y)
        return F.when((b.w > 0) & (b.h > 0) & (w > 0) & (h > 0), F.struct(w.alias("width"), h.alias("height")))

    return let(parse_bbox(c), whole)


def aspect_bin(ratio: Column) -> Column:
    """floor(r) from 1 on, minus floor(1 / r) below; a ratio that is not positive raises."""
    bad = F.raise_error(F.concat(F.lit("aspect ratio is not positive: "), F.coalesce(ratio.cast("string"), F.lit("null"))))
    return F.when(ratio >= 1, F.floor(ratio)).when(ratio > 0, -F.floor(1 / ratio)).otherwise(bad.cast("long"))


def xywh_to_polygon(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.array(F.array(x, y), F.array(x + w, y), F.array(x + w, y + h), F.array(x, y + h))


def polygon_to_xywh(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    x, y = F.array_min(xs), F.array_min(ys)
    return F.struct(x.alias("x"), y.alias("y"), (F.array_max(xs) - x).alias("w"), (F.array_max(ys) - y).alias("h"))


def xywh_to_centered(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct((x + w / 2).alias("cx"), (y + h / 2).alias("cy"), w.alias("w"), h.alias("h"))


def point_in_polygon(x: Column, y: Column, polygon: Column) -> Column:
    """Parity of the edges that a ray to the right crosses."""
    n = F.size(polygon)

    def crossed(inside: Column, i: Column) -> Column:
        a, b = F.get(polygon, i), F.get(polygon, (i + 1) % n)
        ax, ay, bx, by = F.get(a, F.lit(0)), F.get(a, F.lit(1)), F.get(b, F.lit(0)), F.get(b, F.lit(1))
        spans = (ay > y) != (by > y)
        at = (bx - ax) * (y - ay) / F.when(by == ay, F.lit(1.0)).otherwise(by - ay) + ax
        return inside != (spans & (x < at))

    return F.when(n >= 3, F.aggregate(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), F.lit(False), crossed)).otherwise(False)


def polygon_in_polygon(inner: Column, outer: Column) -> Column:
    return F.forall(inner, lambda p: point_in_polygon(p[0], p[1], outer))


def crop_box(bbox: Column, width: Column, height: Column) -> Column:
    """struct(left, top, right, bottom): half-even rounded corners clamped into the image, one pixel at least."""
    edge = lambda v: F.bround(v, 0).cast("long")

    def clamped(b: Column) -> Column:
        left, top = F.greatest(F.lit(0), F.least(edge(b.x), width - 1)), F.greatest(F.lit(0), F.least(edge(b.y), height - 1))
        right, bottom = F.greatest(left + 1, F.least(edge(b.x + b.w), width)), F.greatest(top + 1, F.least(edge(b.y + b.h), height))
        return F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom"))

    return let(bbox, clamped)
