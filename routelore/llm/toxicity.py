"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A text is lower-cased, its words are joined by single spaces with one at either end, and the windows of ``LOW`` to ``HIGH`` characters
that hold no space but at their ends are hashed into 2^``BITS`` buckets. A feature's value is min(1, ``DENSITY`` * occurrences / words)
times the logarithm of the ratio of the shares of toxic and of clean texts that hold it, each with one text added. A logistic
regression over these values, both classes weighing the same, gives the score.

Training reads a bounded sample of labelled rows: of each class the ``SAMPLE`` ids that are first by digest, whole texts. Of rows with
equal ids the least text is learned from; of an id with both labels toxic counts; null labels and ids teach nothing. Spark extracts the
features and counts texts by bucket and class; the driver sees at most a row a bucket and the features of the sample, those in at
least ``MIN_DOCS`` texts whose ratio is at least ``MIN_RATIO``, and fits the weights. Without both classes every score is 0.5.

Scoring reads whole texts, very long ones in pieces that change no count. Null and empty texts and texts without words have no
features: the intercept scores them. Rows keep their number and order of columns, equal texts have equal scores, an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, map_rows, mix64, with_fields

LOW, HIGH = 3, 7
BITS = 18
SAMPLE = 4_000
MIN_DOCS = 3
MIN_RATIO = 0.5
DENSITY = 60.0
#: Ridge penalty, steps and step size of the fit (gradients scaled by their own history).
RIDGE, STEPS, RATE = 0.003, 120, 0.2
THRESHOLD = 0.7
#: Code points whose windows are hashed at a time.
PIECE = 1 << 19


def _windows(codes: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, bucket) of the windows that begin in the first ``starts`` places, one array a length."""
    space = codes == 32
    wide = codes.astype(np.uint64)
    h, fits = np.zeros(len(wide), np.uint64), np.ones(len(wide), bool)
    for n in range(1, HIGH + 1):
        m = len(wide) - n + 1
        if m <= 0:
            return
        h = h[:m] * np.uint64(0x100000001B3) + wide[n - 1 :] + np.uint64(1)
        fits = fits[:m]
        if n >= 3:
            fits = fits & ~space[n - 2 : n - 2 + m]
        if n >= LOW:
            at = np.flatnonzero(fits[:starts])
            yield at, (mix64(h[at] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int64)


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(code points, their texts' numbers, places where windows begin): many short texts, or part of a long one, at a time."""
    codes, owners, size = [], [], 0
    for row, text in enumerate(texts):
        if not text:
            continue
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(c) > PIECE:
            for a in range(0, len(c), PIECE):
                part = c[a : a + PIECE + HIGH - 1]
                yield part, np.full(len(part), row), PIECE
            continue
        codes.append(c)
        owners.append(np.full(len(c), row))
        size += len(c)
        if size > PIECE:
            yield np.concatenate(codes), np.concatenate(owners), size
            codes, owners, size = [], [], 0
    if codes:
        yield np.concatenate(codes), np.concatenate(owners), size


def features(texts: list[str | None], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value before scaling) of the texts' features, by row and bucket; ``keep`` tells the buckets that matter."""
    words = [(t or "").lower().split() for t in texts]
    lengths = np.array([max(len(w), 1) for w in words], np.float64)
    found: list[np.ndarray] = []
    for codes, owners, starts in _pieces([" " + " ".join(w) + " " if w else "" for w in words]):
        for at, bucket in _windows(codes, starts):
            if keep is not None:
                of_use = keep[bucket]
                at, bucket = at[of_use], bucket[of_use]
            found.append((owners[at] << BITS) | bucket)
    keys, counts = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    rows = keys >> BITS
    return rows, keys & ((1 << BITS) - 1), np.minimum(DENSITY * counts / lengths[rows], 1.0)


@dataclass
class Model:
    """Weight of each bucket (its ratio included) and the intercept."""

    weights: np.ndarray
    intercept: float = 0.0

    def scores(self, texts: list[str | None]) -> np.ndarray:
        rows, buckets, values = features(texts, self.weights != 0)
        return _sigmoid(np.bincount(rows, weights=values * self.weights[buckets], minlength=len(texts)) + self.intercept)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic, text): the bounded training sample, the same on every run."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    known = known.withColumn("h", F.xxhash64("doc_id"))
    first = [known.where(F.col("toxic") == c).orderBy("h", "doc_id").limit(per_class) for c in (0, 1)]
    picked = first[0].unionByName(first[1]).drop("h").checkpoint()  # at most per_class rows a class
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, buckets, _ = features(batch.column("text").to_pylist())
        toxic = np.array(batch.column("toxic"))[rows]
        keys, counts = np.unique(buckets * 2 + toxic, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(keys & 1), pa.array(counts)], names=["bucket", "toxic", "n"])


def ratios(rows: DataFrame) -> tuple[np.ndarray, int, int]:
    """(log-count ratio of each bucket, zero where it is rare or tells little; clean and toxic texts)"""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    counted = rows.select("toxic", "text").mapInArrow(_counted, "bucket long, toxic long, n long")
    on = {c: F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)}
    held = counted.groupBy("bucket").agg(*on.values()).where(F.col("n0") + F.col("n1") >= MIN_DOCS)
    out = np.zeros(1 << BITS)
    for r in held.collect():  # at most a row a bucket
        ratio = np.log((r["n1"] + 1) / (n1 + 2)) - np.log((r["n0"] + 1) / (n0 + 2))
        if abs(ratio) >= MIN_RATIO:
            out[r["bucket"]] = ratio
    return out, n0, n1


def _fit(rows: np.ndarray, buckets: np.ndarray, values: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows; every class weighs one half."""
    share = np.where(toxic == 1, 0.5 / max(toxic.sum(), 1), 0.5 / max((1 - toxic).sum(), 1))
    used, at = np.unique(buckets, return_inverse=True)
    w, b, seen, seen_b = np.zeros(len(used)), 0.0, np.full(len(used), 1e-8), 1e-8
    for _ in range(STEPS):
        miss = (_sigmoid(np.bincount(rows, weights=values * w[at], minlength=len(toxic)) + b) - toxic) * share
        slope, slope_b = np.bincount(at, weights=values * miss[rows], minlength=len(used)) + RIDGE * w, float(miss.sum())
        seen, seen_b = seen + slope * slope, seen_b + slope_b * slope_b
        w, b = w - RATE * slope / np.sqrt(seen), b - RATE * slope_b / np.sqrt(seen_b)
    out = np.zeros(1 << BITS)
    out[used] = w
    return out, b


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> Model:
    """The classifier of the labelled rows: ``docs`` (doc_id, text), ``labels`` (doc_id, toxic)."""
    spark = configure(docs.sparkSession)
    rows = sample(docs, labels, per_class).checkpoint()
    scale, clean, toxic = ratios(rows)
    if not (clean and toxic):
        return Model(np.zeros(1 << BITS))
    shipped = spark.sparkContext.broadcast(scale)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shipped.value
        for batch in batches:
            owner, bucket, value = features(batch.column("text").to_pylist(), ratio != 0)
            value = value * ratio[bucket]
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            parts = list(zip(cut[:-1], cut[1:], strict=True))
            packed = [pa.array([x[a:b].tobytes() for a, b in parts], pa.binary()) for x in (bucket.astype(np.int32), value.astype(np.float32))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *packed], names=["doc_id", "toxic", "buckets", "values"])

    kind = dict(rows.dtypes)["doc_id"]
    taught = sorted(rows.mapInArrow(extract, f"doc_id {kind}, toxic int, buckets binary, values binary").collect(), key=lambda r: r["doc_id"])
    counts = [len(r["buckets"]) // 4 for r in taught]
    buckets = np.frombuffer(b"".join(r["buckets"] for r in taught), np.int32)
    values = np.frombuffer(b"".join(r["values"] for r in taught), np.float32).astype(np.float64)
    weights, intercept = _fit(np.repeat(np.arange(len(taught)), counts), buckets, values, np.array([r["toxic"] for r in taught]))
    return Model(weights * scale, intercept)


def score(spark: SparkSession, df: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with the toxicity of its texts in a new column behind."""
    configure(spark)
    shipped = spark.sparkContext.broadcast(model)  # 2^BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shipped.value.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], names=[*batch.schema.names, into])

    return map_rows(df, run, with_fields(df, (into, "double")))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: CRC-32 of the id's text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def toxicity_query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on)."""
    model = train(docs, labels.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return score(spark, rows, model).drop("text").withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
