"""Extensions on Structured Streaming (the batch operators cover the parity work): continuous ingest and running counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.functions import text
from routelore.sources.pointer import resolve


def raw_stream(spark: SparkSession, folder: str, id_pointer: str, input_pointer: str, rules: list[tuple[str, str]], byte_limit: int) -> DataFrame:
    """Rows of a continuously fed folder of JSONL files: projected, redacted, checked; state tells what is wrong."""
    lines = spark.readStream.option("lineSep", "\n").text(folder)
    found = lines.select(resolve(F.col("value"), id_pointer).alias("i"), resolve(F.col("value"), input_pointer).alias("t"))
    rows = found.select(F.col("i.value").alias("id"), text.redact(F.col("t.value"), rules).alias("input"), F.when((F.col("i.state") != "found") | (F.col("t.state") != "found"), "unresolved").alias("state"))
    return rows.withColumn("state", F.coalesce("state", F.when(text.blank(F.col("id")), "blank id"), F.when(~text.within_bytes(F.col("input"), byte_limit), "too long"), F.lit("ok")))


def first_of_each_id(rows: DataFrame, time: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of an id, for ids that come again within the delay; state is bounded by the watermark."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])


def running_distribution(rows: DataFrame, time: str = "ts", window: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows per route and window."""
    return rows.withWatermark(time, delay).groupBy(F.window(time, window), "route").agg(F.count("*").alias("n"))
