"""The corpus pipeline: language ID, near-dedup, decontamination, mixing and sharding of the documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame over all that its predecessor kept; all but the
last return the columns of ``documents``. Every stage reads whole texts of any length, takes null and empty texts and tables,
null and repeated ids and repeated rows, and lets further columns pass through, whatever their names; what becomes of such rows
is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.llm import decontam, langid, mixing, near_copies, sharding
from routelore.llm.common import configure, read, stash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty texts with them), and those whose language is not told with a sufficient margin.

    Of languages that pack a text equally well the first by name counts, with a margin of zero, so ties go. A row is judged by its
    text alone: repeated rows stay or go together. Without any labelled row nothing is identified, so all go."""
    return langid.keep_identified(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every near-duplicate group: the one with the smallest doc_id, null ids last, the lesser text at a tie.

    Of repeated rows one stays. Texts without words (null and empty ones with them) are copies of each other."""
    return near_copies.keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain an item of the benchmark.

    Items of a null id count like any other, those without words never. A row is judged by its text alone, so repeated rows stay or
    go together; null and empty texts stay, and with an empty benchmark all do."""
    return decontam.drop_contaminated(spark, docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats the documents of small sources, as target weights ask for; no document goes.

    Null sources are one source; texts without words weigh one token. Equal rows share their copies, and are told apart by number
    only. Places in the order are MD5 digests, so there are no ties."""
    return mixing.mix_rows(spark, docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds each document's slot and shard behind all its columns (as _slot and _shard where these names are taken).

    Equal ids share a shard, null ids one of their own."""
    return sharding.assign_shards(spark, docs, F.col("doc_id"), sharding.shard_names())


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix_sources", mix_sources), ("shard", shard)]

#: Compression and fingerprints cannot be said in SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written before the next reads it."""
    configure(spark)
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs)
    return docs
