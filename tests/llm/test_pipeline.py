import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from routelore.llm import queries

from .conftest import DOCS, make_docs, words

SMALL = "/root/testdata/sf0.001"


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SMALL).cache()
        seen[name] = docs.count()
        if name != "shard":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "mix_sources":
            assert docs.select("doc_id").distinct().count() == before.count()
        else:
            assert docs.count() <= before.count()
    assert seen["language_id"] > 190 and 150 < seen["near_dedup"] < 200 and seen["shard"] == seen["mix_sources"]
    ran = corpus_pipeline.run(spark, SMALL)
    assert ran.exceptAll(docs).count() == 0 and docs.exceptAll(ran).count() == 0


def test_empty_and_odd_documents(spark, rng, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for texts in ([], [None, "", words(rng, 30), words(rng, 30)]):
        make_docs(spark, texts, source=None).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() <= len(texts)


NAMES = ["group", "key", "row", "node", "lang_pred", "lang_score", "item_id", "shared", "given", "rows", "slot", "shard", "__row", "__group", "at", "copy", "digest", "k", "a.b"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES])
def test_stages_take_odd_rows_and_clashing_names(spark, rng, tmp_path, stage):
    spark.createDataFrame([(1, words(rng, 20)), (None, words(rng, 9))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    long = words(rng, 60_000)
    rows = [(i, t, "en" if i % 2 else "de", "s" if i % 3 else None, 0) for i, t in enumerate([words(rng, 40), words(rng, 40), long, long + " more", "", "é" * 200_000, words(rng, 300)])]
    rows += [rows[0], rows[0], (None, None, None, None, None), (None, words(rng, 30), "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    plain = sorted(repr((r.doc_id, hash(r.text))) for r in stage(spark, docs, str(tmp_path)).collect())
    wide = docs.select("*", *[F.lit(f"{i}").alias(name) for i, name in enumerate(NAMES)])
    out = stage(spark, wide, str(tmp_path))
    assert out.columns[: len(wide.columns)] == wide.columns
    found = out.collect()
    assert sorted(repr((r.doc_id, hash(r.text))) for r in found) == plain and all(r[5:24] == tuple(map(str, range(19))) for r in found)
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_registered_queries():
    names = queries.queries()
    assert "pipeline" in __spark_entry__.queries() and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert set(queries.oracle_sql()) <= set(names)
