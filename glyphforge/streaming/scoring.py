"""Scoring predictions as they arrive: a stream of predictions meets a static table of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from glyphforge.functions.text import cell, strip
from glyphforge.operators.joins import lookup_table
from glyphforge.plans.evaluate import MATCH, SIMILARITY, score


def read_prediction_stream(spark: SparkSession, folder: str) -> DataFrame:
    """text_id, infer and at (arrival) from CSV files that appear in a folder."""
    rows = spark.readStream.option("header", True).schema("text_id string, infer string").csv(folder)
    return rows.withColumn("at", F.current_timestamp())


def score_stream(preds: DataFrame, labels: DataFrame, order: list[str], key: str = "text_id", label: str = "label") -> DataFrame:
    """Predictions whose id has a label, scored; the label table is read anew by every micro-batch, not kept as state."""
    found = lookup_table(labels, key, [label], order)
    joined = preds.withColumn("__key", strip(cell(F.col(key)))).join(found, "__key").drop("__key")
    return score(joined, gold=label)


def windowed_means(scored: DataFrame, length: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Means by arrival window; state older than the watermark goes."""
    w = scored.withWatermark("at", late).groupBy(F.window("at", length))
    return w.agg(F.count(MATCH).alias("samples"), F.avg(MATCH).alias("accuracy"), F.avg(SIMILARITY).alias(SIMILARITY))


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All rows that are there, then stop; the checkpoint makes a restart go on where it ended."""
    return df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
