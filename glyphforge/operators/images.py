"""Pixels (P22, G5, S20): crops of text boxes and of polygons. Needs Pillow on the executors; without it these raise."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from glyphforge.operators.columns import crop_geometry


def _pillow():
    try:
        from PIL import Image, ImageDraw
    except ImportError as e:
        raise RuntimeError("image operators need Pillow") from e
    return Image, ImageDraw


def crop_boxes(rows: DataFrame, quality: int = 95) -> DataFrame:
    """text_id, status (ok, bad_box, bad_image) and the JPEG of each box. rows: text_id, content, bbox, width, height."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        image_lib, _ = _pillow()
        for f in frames:
            out = []
            for i, content, crop in zip(f["text_id"], f["content"], f["crop"], strict=True):
                if crop is None:
                    out.append((i, "bad_box", None))
                    continue
                try:
                    image = image_lib.open(io.BytesIO(content)).convert("RGB").crop((crop["left"], crop["top"], crop["right"], crop["bottom"]))
                except OSError:
                    out.append((i, "bad_image", None))
                    continue
                held = io.BytesIO()
                image.save(held, "JPEG", quality=quality)
                out.append((i, "ok", held.getvalue()))
            yield pd.DataFrame(out, columns=["text_id", "status", "image"])

    return crop_geometry(rows).select("text_id", "content", "crop").mapInPandas(run, "text_id string, status string, image binary")


def crop_polygon(content: bytes, points: list[tuple[float, float]]) -> bytes:
    """The box around a polygon, black outside it, as PNG."""
    image_lib, draw_lib = _pillow()
    image = image_lib.open(io.BytesIO(content)).convert("RGB")
    mask = image_lib.new("L", image.size, 0)
    draw_lib.Draw(mask).polygon([tuple(p) for p in points], fill=255)
    black = image_lib.new("RGB", image.size)
    xs, ys = zip(*points, strict=True)
    out = image_lib.composite(image, black, mask).crop((int(min(xs)), int(min(ys)), int(max(xs)) + 1, int(max(ys)) + 1))
    held = io.BytesIO()
    out.save(held, "PNG")
    return held.getvalue()


def draw_polygons(content: bytes, polygons: list[list[tuple[float, float]]], color: str = "red", width: int = 2) -> bytes:
    """An image with the outlines of its texts, as PNG."""
    image_lib, draw_lib = _pillow()
    image = image_lib.open(io.BytesIO(content)).convert("RGB")
    draw = draw_lib.Draw(image)
    for p in polygons:
        draw.line([*map(tuple, p), tuple(p[0])], fill=color, width=width)
    held = io.BytesIO()
    image.save(held, "PNG")
    return held.getvalue()
