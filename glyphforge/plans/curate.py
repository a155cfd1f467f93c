"""From label documents to the scene and text tables, their patches and splits, and the path hygiene before (Q4 to Q7)."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphforge.operators import columns as c
from glyphforge.operators.dedup import drop_duplicate_ids
from glyphforge.operators.joins import apply_patch, mark_members, merge_columns, pair_paths, unpaired_paths
from glyphforge.operators.predicates import drop_by_keyword_or_extension
from glyphforge.operators.sampling import split_tag_balanced
from glyphforge.operators.setops import subtract_lines
from glyphforge.sources.readers import annotations_of, images_of
from glyphforge.sources.scratch import written

VALID_CROP = [{"column": "is_valid_crop", "op": "in", "values": ["True", "true", "TRUE", "1"]}]
TEXT_COLUMNS = ["text_id", "scene_id", "origin_dataset", "image_path", "label", "points", "split"]
# The columns of the standard tables whose tags a split balances, unless the caller names others.
BALANCE = ["length", "linear_aspect_ratio_bin", "dir_path_4", "area", "device", "illuminance", "light", "metaclass", "outline", "weather", "wordcolor", "wordfont", "wordorientation", "wordsize"]


def standardise(images: DataFrame, annotations: DataFrame, crop_errors: DataFrame | None = None, error_id: str = "annotation_id") -> tuple[DataFrame, DataFrame]:
    """Q4: (scenes, texts): ids, first row of each text id, box flags, paths, languages, crop flag. One plan, no files between."""
    scenes = c.scene_table(images)
    texts = c.validate_bbox(c.text_table(annotations), "points")  # before rows are picked: later filters by the flags then read no box again
    texts = drop_duplicate_ids(texts, "text_id", ["scene_id", "text_index", "label", "points"])
    texts = c.image_path_column(texts, "scene_id", "text_id", "image_path", "text_images")
    texts = c.language_category_column(texts, "label")
    if crop_errors is None:
        return scenes, texts.withColumn("is_valid_crop", F.lit(True))
    return scenes, mark_members(texts, crop_errors, "text_id", error_id, "is_valid_crop", member=False)


def standardise_documents(labels: DataFrame, crop_errors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Q4 from label JSON documents as `read_label_json` gives them."""
    images = images_of(labels).withColumn("image_file", F.col("label_file"))
    return standardise(images, annotations_of(labels), crop_errors)


def patch(texts: DataFrame, updates: DataFrame, order: list[str]) -> DataFrame:
    """Q5: the seven columns of the text table with patches applied."""
    have = [x for x in TEXT_COLUMNS if x in texts.columns]
    out = apply_patch(c.select_columns(texts, have), updates, order)
    return out if "split" in out.columns else out.withColumn("split", F.lit(""))


def split(texts: DataFrame, scenes: DataFrame, order: list[str], balance: list[str] = BALANCE, group: str = "scene_id", ratio: tuple[float, float, float] = (0.8, 0.1, 0.1), filters: list[Mapping[str, Any]] | None = None) -> DataFrame:
    """Q6: lengths, aspect ratios and their bins, folder prefixes and scene columns, then the tag-balanced split of whole scenes."""
    filters = VALID_CROP if filters is None else filters
    rows = c.text_length_column(texts.withColumn("is_valid_crop", F.col("is_valid_crop").cast("string")), "label", "length")
    rows = c.bbox_size_columns(rows.where("is_valid_bbox_format and is_valid_bbox_value"), "points")
    rows = c.aspect_bin_column(c.arithmetic_column(rows, "width", "height", "aspect_ratio"))
    paths = c.path_prefix_column(scenes, "origin_image_path", "dir_path_4", 4)
    extra = [x for x in balance if x in paths.columns]
    rows = written(merge_columns(rows, paths, extra, ["scene_id"], "scene_id", "scene_id"), "rows")  # the split reads them twice
    return split_tag_balanced(rows, group, [b for b in balance if b in rows.columns], ratio, filters)


def path_hygiene(images: DataFrame, labels: DataFrame, mapping: Mapping[str, str], keywords: list[str] = (), order: tuple[str, ...] = ("image_file",)) -> dict[str, DataFrame]:
    """Q7: listings without unwanted paths, their pairs and what has no partner, and new names by running number."""
    images, labels = (drop_by_keyword_or_extension(x, keywords) for x in (images, labels))
    alone = unpaired_paths(images, labels, mapping)
    clean_images = subtract_lines(images, alone.where("side = 'image'").select("origin"))
    clean_labels = subtract_lines(labels, alone.where("side = 'label'").select("origin"))
    pairs = pair_paths(clean_images, clean_labels, mapping)
    return {"images": clean_images, "labels": clean_labels, "unmatched": alone, "pairs": pairs, "mapping": c.rename_map(pairs, list(order))}
