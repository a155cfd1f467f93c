"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages of PASSAGE bytes. Every passage is encoded from the distribution of its bytes and byte
pairs and the share of words that repeat the one before; a gated attention (tanh and sigmoid branches) learns from document labels alone how much each passage counts, and
the weighted passage representation is scored. Nothing but the text enters a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphforge.llm.common import Words, Workspace, column, give_back, map_batches, offsets, ship

PASSAGE = 1024
PAIRS = 256
FEATURES = 256 + PAIRS + 2
HIDDEN, GATE = 32, 16
#: Standardised features are cut off there: a few bytes make rare letters look extreme.
CLIP = 4.0
#: Labelled documents that a model is fitted on at most: those of the smallest hashes of their ids. They take part whole, with at
#: most so many passages in all (62 MB of features): a document that would exceed what is left of these is passed over.
SAMPLE, SAMPLE_PASSAGES = 4000, 30_000


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages of a batch, and first[r]:first[r + 1] those of text r; an empty text has one, of zeros."""
    words = Words(texts, lower=True)
    at, h = words.at, words.hashes()
    data = words.raw
    lens = np.diff(at)
    count = np.maximum(1, -(-lens // PASSAGE))
    first = np.concatenate([[0], np.cumsum(count)])
    n = int(first[-1])
    row = np.repeat(np.arange(len(lens)), lens)
    where = np.arange(len(data)) - at[row]
    of = first[row] + where // PASSAGE
    single = np.bincount(of * 256 + data, minlength=n * 256).reshape(n, 256)
    inner = np.flatnonzero(where[1:] > 0) if len(data) else np.zeros(0, np.int64)
    code = data.astype(np.uint32)
    pair = ((code[inner] * np.uint32(0x9E3779B1) + code[inner + 1] * np.uint32(0x85EBCA6B)) >> np.uint32(24)).astype(np.int64)
    double = np.bincount(of[inner] * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
    again = np.flatnonzero(h[1:] == h[:-1]) + 1
    again = again[row[words.starts[again]] == row[words.starts[again - 1]]]
    repeats = np.bincount(of[words.starts[again]], minlength=n) / np.maximum(1, np.bincount(of[words.starts], minlength=n))
    size = single.sum(axis=1, keepdims=True)
    out = np.concatenate([single / np.maximum(size, 1), double / np.maximum(size, 1), np.log1p(size), repeats[:, None]], axis=1)
    return np.sqrt(out).astype(np.float32), first


class Model:
    """Weights of the encoder (w, b), the gated attention (v, u, a) and the score (c, d), and the features' mean and spread."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {"w": rng.normal(0, FEATURES**-0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "a": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1)}

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        p, start, many = self.p, first[:-1], np.diff(first)
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        e = (t * g) @ p["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), many))
        weight = e / np.repeat(np.add.reduceat(e, start), many)
        z = np.add.reduceat(weight[:, None] * h, start)
        return {"h": h, "t": t, "g": g, "weight": weight, "z": z, "y": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}

    def gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over the documents."""
        f, p, many = self.forward(x, first), self.p, np.diff(first)
        dy = (f["y"] - y) / len(y)
        dz = dy[:, None] * p["c"]
        dz_each = np.repeat(dz, many, axis=0)
        dot = (dz_each * f["h"]).sum(axis=1)
        de = f["weight"] * (dot - np.repeat(np.add.reduceat(f["weight"] * dot, first[:-1]), many))
        dt = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
        dh = f["weight"][:, None] * dz_each + dt @ p["v"].T + dg @ p["u"].T
        dh *= 1 - f["h"] ** 2
        return {"w": x.T @ dh, "b": dh.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "d": dy.sum(keepdims=True)}

    def fit(self, allx: np.ndarray, at: np.ndarray, y: np.ndarray, steps: int = 1200, lot: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> Model:
        """Adam over shuffled lots of documents, about `steps` of them: document i has the passages at[i]:at[i + 1] of allx. The same
        documents in the same order give the same model."""
        n, total, squares = max(1, len(allx)), np.zeros(FEATURES), np.zeros(FEATURES)
        for i in range(0, len(allx), 4096):  # in steps, as a copy in doubles would be twice as large
            part = allx[i : i + 4096].astype(np.float64)
            total, squares = total + part.sum(axis=0), squares + (part * part).sum(axis=0)
        self.mean = total / n
        self.spread = np.maximum(np.sqrt(np.maximum(squares / n - self.mean**2, 0)), 1e-2)
        bags = [allx[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
        rng, m1, m2, step = np.random.default_rng(11), {}, {}, 0
        for _ in range(-(-steps * lot // len(bags))):
            order = rng.permutation(len(bags))
            for i in range(0, len(order), lot):
                some = order[i : i + lot]
                x = np.clip((np.concatenate([bags[k] for k in some]) - self.mean) / self.spread, -CLIP, CLIP)
                first = np.concatenate([[0], np.cumsum([len(bags[k]) for k in some])])
                step += 1
                for k, g in self.gradient(x, first, y[some]).items():
                    g = g + decay * self.p[k]
                    m1[k] = 0.9 * m1.get(k, 0) + 0.1 * g
                    m2[k] = 0.999 * m2.get(k, 0) + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, texts: pa.Array) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        x, first = passages(texts)
        return self.forward(np.clip((x - self.mean) / self.spread, -CLIP, CLIP), first)["y"]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = SAMPLE_PASSAGES) -> Model:
    """A model of labels.quality, from at most `sample` labelled documents, of at most `most` passages in all, outside the
    held-out third.

    Held out are rows whose crc32 of doc_id as text leaves 1 when divided by 3. Labels that are null count for nothing; of
    several labels of a document the mean decides, of several texts the one of the smallest hash; labels of other documents
    are passed over, however many. Without any label all scores are near 0.5.
    """
    work = Workspace(docs.sparkSession, "quality")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality")).where("doc_id is not null and quality is not null and pmod(crc32(cast(doc_id as string)), 3) <> 1")
    there = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("quality")).join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")  # `sample` rows at most
    texts = work.write(texts.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min_by("text", F.xxhash64("text")).alias("text")), "texts")
    sized = texts.select("doc_id", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / PASSAGE)).alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect()  # `sample` rows at most
    taken, left = [], most
    for r in sized:
        if r.n <= left:
            taken.append(r.doc_id)
            left -= r.n

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, first = passages(column(batch, "text"))
        bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "quality": column(batch, "quality"), "bag": pa.array(bags, pa.binary())})

    chosen = texts.where(F.col("doc_id").isin(taken)) if len(taken) < len(sized) else texts
    got = map_batches(chosen, run, "doc_id long, quality double, bag binary", text="text").toArrow()
    work.drop()
    model = Model()
    if not got.num_rows:
        model.p["c"] *= 0
        return model
    got = got.sort_by("doc_id").combine_chunks()
    bags, quality = got["bag"].combine_chunks(), got["quality"].to_numpy()
    allx = np.frombuffer(bags.buffers()[2], np.float32, offset=int(offsets(bags)[0])).reshape(-1, FEATURES)
    at = offsets(bags)
    model.fit(allx, (at - at[0]) // (4 * FEATURES), (quality >= 0.5).astype(float))
    del allx, bags, got
    give_back()
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every whole text, a row for each input row.

    A null text counts as empty; an empty text has a score too. Other columns are not looked at.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({"doc_id": column(batch, "doc_id"), "score": pa.array(model.score(column(batch, "text")), pa.float64())})

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(docs, run, "doc_id long, score double", text="text")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs, all their columns, whose text scores `least` or more."""
    ship(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(column(batch, "text")) >= least))

    return map_batches(docs, run, docs.schema, text="text")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored; the held-out third never took part in fitting."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held = F.coalesce(F.expr("pmod(crc32(cast(doc_id as string)), 3) = 1"), F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
