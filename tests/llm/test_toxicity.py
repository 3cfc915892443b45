import numpy as np
import pytest
from pyspark.sql import functions as F

from routelore.llm import queries, toxicity

from .conftest import make_docs, words

SMALL = "/root/testdata/sf0.01"


def test_features_equal_a_plain_count(monkeypatch, rng):
    texts = ["Ab  c\tabc ABC", None, "", " \n", words(rng, 12), "é" * 50 + " x", "zzzzzzzzzzzz " * 20, "\U0001f600\U0001f601\U0001f602 a"]
    whole = toxicity.features(texts)
    monkeypatch.setattr(toxicity, "PIECE", 16)
    for a, b in zip(whole, toxicity.features(texts), strict=True):
        assert (a == b).all()
    for row, text in enumerate(texts):
        held = (text or "").lower().split()
        line, grams = " " + " ".join(held) + " ", []
        for n in range(toxicity.LOW, toxicity.HIGH + 1):
            grams += [line[i : i + n] for i in range(len(line) - n + 1) if " " not in line[i + 1 : i + n - 1]] if held else []
        mine = whole[0] == row
        assert mine.sum() == len(set(grams))  # no two of these share a bucket
        counts = sorted(min(toxicity.DENSITY * grams.count(g) / len(held), 1.0) for g in set(grams))
        assert np.allclose(sorted(whole[2][mine]), counts)


def planted(rng, n):
    """Clean and toxic texts; toxic ones hold words that begin in a certain way."""
    out = []
    for i in range(n):
        text, bad = words(rng, rng.choice([5, 40, 400])).split(), i % 4 == 0
        if bad:
            for at in range(0, len(text), 8):
                text[at] = f"grub{rng.choice(['ly', 'ous', 'est'])}"
        out.append((" ".join(text), int(bad)))
    return out


def test_held_out_rows(spark, rng):
    rows = planted(rng, 600)
    docs = make_docs(spark, [t for t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity_query(spark, docs, labels).collect()}
    held = [i for i in out if out[i].held_out]
    assert len(out) == 600 and 100 < len(held) < 300
    assert all(out[i].predicted == rows[i][1] for i in held) and all(0 <= r.score <= 1 for r in out.values())
    # labels of held-out rows, and everything but the text, change nothing
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.toxicity_query(spark, docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}), other)
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in out.items()}


def test_accuracy_on_the_small_table(spark):
    out = queries.op13_toxicity(spark, SMALL)
    known = out.join(spark.read.parquet(f"{SMALL}/labels.parquet"), "doc_id").where("held_out")
    hit, said, toxic = known.agg(F.sum(F.col("toxic") * F.col("predicted")), F.sum("predicted"), F.sum("toxic")).first()
    assert hit >= 0.9 * said and hit >= 0.6 * toxic  # some 270 rows teach here, in four languages
    assert out.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


@pytest.mark.parametrize("labelled", [[], [(0, None), (None, 1)], [(0, 1), (3, 1)], [(0, 0), (3, 1)]])
def test_odd_rows(spark, rng, labelled):
    texts = ["", None, "same words here", "same words here", "x" * 1_000_000, words(rng, 30_000), "\n\t"]
    docs = make_docs(spark, texts, ids=[1, None, 0, 0, 3, 4, 5])
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    out = toxicity.toxicity_query(spark, docs, labels)
    assert out.count() == len(texts) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert out.where("doc_id = 0").select("score").distinct().count() == 1
    assert toxicity.toxicity_query(spark, docs.limit(0), labels).count() == 0
    wide = docs.select("*", F.lit(1).alias("a.b"), F.lit(2).alias("h"))
    assert toxicity.score(spark, wide, toxicity.train(docs, labels), into="s").columns == [*wide.columns, "s"]
