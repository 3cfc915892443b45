import re

from routelore.llm import decontam

from .conftest import make_docs, words


def brute(docs, items):
    """Word windows compared as lists, with nothing of the operator's own."""
    split = lambda t: re.findall(r"\w+", (t or "").lower())
    out = []
    for d, t in docs:
        w = split(t)
        for i, x in items:
            v = split(x)
            n = min(5, len(v))
            mine = []
            for k in range(len(v) - n + 1):
                if n and v[k : k + n] not in mine:
                    mine.append(v[k : k + n])
            there = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            shared = sum(tuple(m) in there for m in mine)
            if mine and 10 * shared >= 8 * len(mine):
                out.append((d, i, shared, len(mine)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark, rng):
    items = [(i, words(rng, n)) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 14, 30, 60, 61, 200])]
    items += [(90, ""), (91, None), (92, "what is 7 plus"), (93, "Capital of France"), (94, "no no no no no no no no"), (None, words(rng, 12))]
    texts = [None, "", words(rng, 2000), words(rng, 4), "w1x", "he asked: What is 7, plus eight? the capital of france of course", "the capital of spain", "no " * 40]
    for _, x in items[:14] + items[-1:]:
        w = x.split()
        texts += [words(rng, 800) + " " + x.upper() + " " + words(rng, 900), words(rng, 30) + " " + " ".join(w[: max(1, len(w) // 2)]), x]
        changed = list(w)
        changed[len(w) // 2] = "other"
        texts.append(words(rng, 100) + " " + " ".join(changed) + " " + words(rng, 100))
    texts.append(texts[-2])
    got = decontam.contained_items(spark, make_docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(list(enumerate(texts)), items)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and {i for _, i, *_ in want} >= {*range(14), 92, 93, 94, None}


def test_filter_keeps_clean_rows_and_columns(spark, rng, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 2)  # several blocks of the query set
    items = spark.createDataFrame([(i, words(rng, 20)) for i in range(5)] + [(None, words(rng, 20))], "item_id long, text string")
    leaks = {r.item_id: r.text for r in items.collect()}
    df = make_docs(spark, ["clean " + words(rng, 50), "a " + leaks[3] + " b", None, "", "of no id " + leaks[None]]).withColumnRenamed("source", "item_id")
    kept = decontam.drop_contaminated(spark, df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 3]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contained_items(spark, make_docs(spark, ["a b c d e f"]), none).count() == 0
    assert decontam.contained_items(spark, make_docs(spark, []), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0
