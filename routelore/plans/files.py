"""Queries over files: documents are written as JSON lines and scanned again as raw and as labeled inputs."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routelore.operators import registry
from routelore.plans.registry import BYTE_LIMIT, EMAIL, query, read
from routelore.sources import artifacts, jsonl
from routelore.sources.configs import RESERVED


def written(spark: SparkSession, rows: DataFrame) -> str:
    """A folder of JSON lines in the shared folder of the cluster (on a local master without one: a temporary folder), gone when the driver ends."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{base or tempfile.gettempdir()}/lines-{uuid.uuid4().hex}"
    artifacts.write_jsonl(rows.select("doc_id", F.to_json(F.struct(*[c for c in rows.columns if c != "doc_id"])).alias("value")), path, "value", ["doc_id"])

    def remove() -> None:
        with contextlib.suppress(Exception):  # the session may have ended before
            artifacts.remove(spark, path)

    atexit.register(remove)
    return path


def _raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    meta = F.struct(F.col("doc_id").cast("string").alias("a/b"), F.col("source").alias("src"))
    path = written(spark, read(spark, sf_dir, "documents").select("doc_id", meta.alias("meta"), F.col("text").alias("body")))
    return jsonl.scan_raw(spark, path, "/meta/a~1b", "/body", {"src": "/meta/src"}, [("/input", EMAIL, "[email]"), ("src", "^src", "source src")], BYTE_LIMIT, RESERVED)


_REDACTED = f"WITH r AS (SELECT doc_id, source, regexp_replace(text, '{EMAIL}', '[email]', 'g') AS input, row_number() OVER (ORDER BY doc_id) AS line FROM documents)"


@query(f"{_REDACTED} SELECT CAST(doc_id AS VARCHAR) AS id, sha256(input) AS input, regexp_replace(source, '^src', 'source src') AS src, line FROM r WHERE strlen(input) BETWEEN 1 AND {BYTE_LIMIT}")
def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows projected by pointers, redacted by ordered rules and checked, with their source line in the metadata."""
    rows, _ = _raw(spark, sf_dir)
    metadata = F.from_json("metadata", f"src string, {RESERVED} struct<source_line:long>")
    return rows.select("id", F.sha2("input", 256).alias("input"), metadata["src"].alias("src"), metadata[RESERVED]["source_line"].alias("line"))


@query(f"""{_REDACTED} SELECT 'input has more than {BYTE_LIMIT} bytes' AS message, count(*) AS n FROM r WHERE strlen(input) > {BYTE_LIMIT} HAVING count(*) > 0
UNION ALL SELECT 'id and input must be non-empty strings', count(*) FROM r WHERE input = '' HAVING count(*) > 0""")
def raw_scan_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = _raw(spark, sf_dir)
    return bad.groupBy("message").agg(F.count("*").alias("n"))


_ROUTES = [registry.Route("en", properties={"n": "integer"}, required=("n",)), registry.Route("fr", properties={"n": "integer"})]


def _labeled(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    route = F.struct(F.col("lang").alias("name"), F.struct(F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("n")).alias("arguments"))
    path = written(spark, read(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("id"), F.col("text").alias("input"), route.alias("route")))
    return jsonl.scan_examples(spark, path, registry.registry(spark, _ROUTES))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, sha256(text) AS input, lang AS route, CASE WHEN doc_id % 7 <> 0 THEN 'integer ' || doc_id END AS n FROM documents WHERE text <> '' AND (lang = 'fr' OR (lang = 'en' AND doc_id % 7 <> 0))")
def example_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _labeled(spark, sf_dir)
    n = F.element_at("arguments", "n")
    return rows.select("id", F.sha2("input", 256).alias("input"), "route", F.concat_ws(" ", n["kind"], n["text"]).alias("n")).withColumn("n", F.when(F.col("n") != "", F.col("n")))


@query("""SELECT message, count(*) AS n FROM (SELECT CASE WHEN text = '' THEN 'input must be a non-empty string' WHEN lang NOT IN ('en', 'fr') THEN 'unknown_route' WHEN lang = 'en' AND doc_id % 7 = 0 THEN 'invalid_arguments: missing required argument n' END AS message FROM documents)
WHERE message IS NOT NULL GROUP BY message""")
def example_scan_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = _labeled(spark, sf_dir)
    return bad.groupBy("message").agg(F.count("*").alias("n"))
