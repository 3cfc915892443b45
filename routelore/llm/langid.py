"""Language identification by compression.

For every language a raw-content zstandard dictionary is cut from labelled training texts. A text is encoded
piece by piece, in lower case, under each dictionary; the language whose dictionary makes the smallest total wins, and the
decision is rejected where the relative margin to the runner-up is narrow.

Training reads a bounded sample of labelled rows: per language the ``SAMPLE_DOCS`` rows that are first by digest,
``SAMPLE_CHARS`` characters of each (from a place set by the digest), at most ``DICT_BYTES`` in all. Only languages and digests
are counted and ranked, in ``PARTS`` parts of a language and then over what these have left, so one with most of the rows or a text with very many
copies is no bottleneck; the pieces are then cut from the rows that were picked, and equal ones are merged in every task. The
dictionaries (``DICT_BYTES`` a language) are shipped to the executors with the task; more than ``MAX_LANGS`` languages are refused.

Prediction reads the whole text, in pieces of ``PIECE_BYTES`` bytes so that the dictionary bears on all of it.
Null texts and texts without a letter are ``und`` with score 0. Ties go to the language that is first by name.
Rows keep their number and order of columns; every row is judged by its text alone, equal rows alike; an empty table gives an empty one.
Of the sampled pieces of a language, some 240,000 bytes, the last ``DICT_BYTES`` in the order of their digests make its dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import configure, free_name, join_small, map_rows, named, with_fields

SAMPLE_DOCS = 400
SAMPLE_CHARS = 600
DICT_BYTES = 64_000
MAX_LANGS = 512
#: Parts of a language that are cut to the sample's size before they meet.
PARTS = 32
PIECE_BYTES = 4_096
LEVEL = 6
#: Decisions whose relative margin is below this are rejected by the filtering stage.
MIN_MARGIN = 0.005
LETTER = regex.compile(r"\p{L}")


def sample(docs: DataFrame, text: str = "text", label: str = "lang", per_label: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(lang, h, piece): the bounded training sample of labelled rows, the same on every run.

    Each distinct text counts once, whatever its number of copies."""
    rows = docs.select(F.col(label).alias("lang"), F.col(text).alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    picked = rows.groupBy("lang", "h").agg(F.count("*").alias("n")).select("lang", "h", F.pmod("h", F.lit(PARTS)).alias("part"))
    for by in (["lang", "part"], ["lang"]):  # each part of a language is cut first, then what the parts have left
        rank = W.partitionBy(*by).orderBy("h")
        picked = picked.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= per_label).drop("rank")
    begin = (F.pmod("h", F.greatest(F.length("text") - chars, F.lit(1))) + 1).cast("int")
    pieces = join_small(rows, picked.select("lang", "h").checkpoint(), ["lang", "h"], "inner").select("lang", "h", F.substring(F.col("text"), begin, F.lit(chars)).alias("piece"))
    return pieces.groupBy("lang", "h").agg(F.min("piece").alias("piece"))  # as many rows as were picked


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionary of each language in the labelled rows."""
    configure(docs.sparkSession)
    labels = docs.select(F.col(label).alias("lang")).where("lang is not null").distinct()
    if labels.limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    pieces: dict[str, list[tuple[int, bytes]]] = {}
    for r in sample(docs, text, label).collect():  # SAMPLE_DOCS pieces a language at most
        pieces.setdefault(r["lang"], []).append((r["h"], r["piece"].lower().encode()))
    return {lang: b"\n".join(p for _, p in sorted(found))[-DICT_BYTES:] for lang, found in sorted(pieces.items())}


class Classifier:
    """Encoders of all languages; made once in each task."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.langs = list(dictionaries)
        self.encoders = []
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=PIECE_BYTES, dict_size=DICT_BYTES, min_match=3, write_content_size=0, write_checksum=0, write_dict_id=0)
        for data in dictionaries.values():
            held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=params)
            self.encoders.append(zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress)

    def sizes(self, text: str) -> np.ndarray:
        raw = text.lower().encode()
        pieces = [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]
        return np.array([sum(len(encode(p)) for p in pieces) for encode in self.encoders])

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language or und, relative margin to the runner-up)"""
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        if len(sizes) == 1:
            return self.langs[best], 1.0
        second = np.delete(sizes, best).min()
        return self.langs[best], float((second - sizes[best]) / second)


def predict(spark: SparkSession, df: DataFrame, dictionaries: dict[str, bytes], text: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with the predicted language and its margin in two new columns (underscored where ``df`` has such names)."""
    configure(spark)
    into = (free_name(df, into[0]), free_name(df, into[1]))
    schema = with_fields(df, (into[0], "string"), (into[1], "double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(dictionaries)
        for batch in batches:
            found = [classifier.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[*batch.schema.names, *into])

    return map_rows(df, run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: CRC-32 of the id's text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def language_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected (a letterless text or a margin below ``MIN_MARGIN``)."""
    dictionaries = train(docs.where(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(spark, rows, dictionaries).drop("text").withColumn("rejected", rejected("lang_pred", "score"))


def rejected(lang: str, score: str) -> Column:
    return (F.col(lang) == "und") | (F.col(score) < MIN_MARGIN)


def keep_identified(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents whose language is told with a sufficient margin, in their own columns."""
    dictionaries = train(docs.where(~held_out()))
    into = (free_name(docs, "lang_pred"), free_name(docs, "lang_score"))
    return predict(spark, docs, dictionaries, into=into).where(~rejected(*into)).select(*named(docs.columns))
