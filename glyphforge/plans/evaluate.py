"""Scoring predictions against gold texts (Q1, Q2, A1 to A4)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glyphforge.functions.hangul import WILDCARD, score_columns
from glyphforge.functions.text import cell, to_text
from glyphforge.operators.joins import join_labels, tag_rows, uncovered

MATCH, SIMILARITY = "is_match", "gned_sim"
# The tag columns of the published tables.
TAGS = ("KSTR_is_artistic", "KSTR_is_curve", "KSTR_is_salient", "KSTR_is_incomplete", "KSTR_is_multi_oriented", "KSTR_is_low_visibility")


def score(rows: DataFrame, gold: str = "label", pred: str = "infer", wildcard: str = WILDCARD, ignore_blank: bool = True, lower: bool = False, words_for_nothing: bool = False) -> DataFrame:
    """rows with is_match (0 or 1) and gned_sim. With words_for_nothing, the texts nan and none count as empty (K2)."""
    clean = to_text if words_for_nothing else cell
    match, sim = score_columns(clean(F.col(f"`{gold}`")), clean(F.col(f"`{pred}`")), wildcard, ignore_blank, lower)
    return rows.withColumns({MATCH: match, SIMILARITY: sim})


def score_predictions(preds: DataFrame, labels: DataFrame, order: list[str], key: str = "text_id", unmatched: str = "exclude", **options) -> DataFrame:
    """Q1: predictions with label and scores. unmatched="exclude": ids without a label have no scores (K1); "as_empty": they are
    scored against an empty text, and the texts nan and none count as empty, as in a grid run."""
    if unmatched not in ("exclude", "as_empty"):
        raise ValueError("unmatched is exclude or as_empty")
    joined = join_labels(preds, labels, order, key)
    scored = score(joined, words_for_nothing=unmatched == "as_empty", **options)
    if unmatched == "as_empty":
        return scored
    return scored.withColumns({c: F.when(F.col("is_known"), F.col(c)) for c in (MATCH, SIMILARITY)})


def means(scored: DataFrame, by: list[str | Column] = ()) -> DataFrame:
    """A1: samples, accuracy and mean similarity of the rows that have scores; null without any."""
    return scored.groupBy(*by).agg(F.count(MATCH).alias("samples"), F.avg(MATCH).alias("accuracy"), F.avg(SIMILARITY).alias(SIMILARITY))


def coverage(preds: DataFrame, labels: DataFrame, order: list[str], key: str = "text_id") -> DataFrame:
    """Q1's counts in one row: inference, matched, unmatched_infer, unmatched_dataset."""
    known = join_labels(preds, labels, order, key).select(F.lit(1).alias("i"), F.col("is_known").cast("int").alias("m"), F.lit(0).alias("u"))
    both = known.unionByName(uncovered(labels, preds, key).select(F.lit(0).alias("i"), F.lit(0).alias("m"), F.lit(1).alias("u")))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return both.agg(total("i").alias("inference"), total("m").alias("matched"), (total("i") - total("m")).alias("unmatched_infer"), total("u").alias("unmatched_dataset"))


def means_by_tag(scored: DataFrame, tags: DataFrame, columns: list[str] = TAGS, key: str = "text_id") -> DataFrame:
    """A2: the same for each tag; a row counts for all its tags; tags without samples stay."""
    fixed = scored.sparkSession.createDataFrame([(c,) for c in columns], "tag string")
    joined = scored.join(tag_rows(tags, list(columns), key), key).groupBy("tag").agg(F.count(MATCH).alias("samples"), F.avg(MATCH).alias("accuracy"), F.avg(SIMILARITY).alias(SIMILARITY))
    return fixed.join(joined, "tag", "left").select("tag", F.coalesce("samples", F.lit(0)).alias("samples"), "accuracy", SIMILARITY)


def file_means(scored: DataFrame) -> DataFrame:
    """A4: means over at least one row, so that an empty file gives 0."""
    n = F.greatest(F.count("*"), F.lit(1))
    return scored.agg(F.count("*").alias("samples"), (F.coalesce(F.sum(MATCH), F.lit(0)) / n).alias("accuracy"), (F.coalesce(F.sum(SIMILARITY), F.lit(0.0)) / n).alias(SIMILARITY))


def grid_summary(scored: DataFrame, datasets: Mapping[str, list[str]], tags: DataFrame | None = None, key: str = "text_id", skip_empty: bool = True) -> DataFrame:
    """A3: regime, model, dataset, challenge, samples, accuracy, gned_sim.

    scored: regime, model, source, the key and scores. A dataset is a union of sources; challenge is a tag, or empty for all
    rows. tags: source, key, tag. Without skip_empty, tags without samples stay, with 0 for both means.
    """
    spark = scored.sparkSession
    parts = spark.createDataFrame([(d, s) for d, ss in datasets.items() for s in ss], "dataset string, source string")
    rows = scored.join(F.broadcast(parts), "source")  # as many rows as sources are named
    every = rows.withColumn("challenge", F.lit(""))
    if tags is not None:
        in_set = tags.join(F.broadcast(parts), "source").select("dataset", F.col(key), F.col("tag").alias("challenge")).distinct()
        every = every.unionByName(rows.join(in_set, ["dataset", key]).select(*every.columns))
    out = every.groupBy("regime", "model", "dataset", "challenge").agg(F.count("*").alias("samples"), F.avg(MATCH).alias("accuracy"), F.avg(SIMILARITY).alias(SIMILARITY))
    if skip_empty or tags is None:
        return out
    kinds = tags.select(F.col("tag").alias("challenge")).distinct().withColumn("__one", F.lit(1))
    frame = out.where("challenge = ''").select("regime", "model", "dataset", F.lit(1).alias("__one")).join(kinds, "__one").drop("__one")
    full = frame.unionByName(out.where("challenge = ''").select("regime", "model", "dataset", "challenge"))
    zero = lambda c, v: F.coalesce(c, F.lit(v)).alias(c)
    return full.join(out, ["regime", "model", "dataset", "challenge"], "left").select("regime", "model", "dataset", "challenge", zero("samples", 0), zero("accuracy", 0.0), zero(SIMILARITY, 0.0))
