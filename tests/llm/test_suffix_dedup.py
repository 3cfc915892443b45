import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from routelore.llm import common, suffix_dedup

from .conftest import make_docs, words


def brute(texts: list[str | None]) -> list[tuple]:
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            w = b[k : k + 100]
            if w in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng: random.Random) -> list[str | None]:
    base, passage = [words(rng, 120) for _ in range(12)], words(rng, 40)
    texts: list[str | None] = [None, "", "short", *base, base[3], base[4][:300] + words(rng, 10) + base[4][300:]]
    texts += [words(rng, 20) + " " + passage + " " + words(rng, 20) for _ in range(25)]
    texts += ["ab" * 300, "a" * 500, "né" * 200, base[5] * 2, "x" * 99, "x" * 100]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("large", [2_000, 5])
def test_equals_brute_force(spark, rng, monkeypatch, large):
    monkeypatch.setattr(suffix_dedup, "LARGE", large)
    texts = corpus(rng)
    got = suffix_dedup.dedup(spark, make_docs(spark, texts).repartition(5)).collect()
    assert [tuple(r)[1:] for r in sorted(got)] == brute(texts)


def test_null_and_repeated_ids(spark, rng):
    t = words(rng, 60)
    df = make_docs(spark, [t, t, words(rng, 60), t], ids=[1, 1, 2, None])
    got = suffix_dedup.dedup(spark, df).collect()
    assert len(got) == 4 and sum(r.n_removed == 0 for r in got) == 2
    assert next(r for r in got if r.doc_id is None).n_removed == 0  # null ids come first


def test_empty_table_and_kept_text(spark):
    assert suffix_dedup.dedup(spark, make_docs(spark, [])).count() == 0
    t = "q" * 150
    kept = suffix_dedup.dedup(spark, make_docs(spark, [t]), keep_text=True).first().kept
    assert kept == b"q"  # all but the first window's first byte is covered by a later start


def test_factors_against_definition():
    r = np.random.default_rng(3)
    rows = r.integers(97, 99, (60, suffix_dedup.LENGTH), dtype=np.uint8)
    rows[:, 5:] = rows[0, 5:]
    bucket = np.repeat([0, 1], 30)
    want = []
    for i in range(60):
        common = [next((k for k in range(100) if rows[i, k] != rows[j, k]), 100) for j in range(i) if bucket[i] == bucket[j]]
        want.append(max(common, default=0))
    assert suffix_dedup.factors(bucket, rows).tolist() == want


def sorted_batches(batches, by, size):
    t = pa.Table.from_batches(list(batches))
    return t.sort_by([(c, "ascending") for c in by]).to_batches(max_chunksize=size) if t.num_rows else []


def in_process(texts, size, salts=None):
    """All steps on Arrow batches of ``size`` rows, without Spark: (document, start, count) of the copies."""
    docs = pa.table({"doc": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    found = pa.Table.from_batches(suffix_dedup._buckets(iter(sorted_batches(suffix_dedup._anchors(iter(docs.to_batches(max_chunksize=size))), ["gram"], size)))).to_pylist()
    out = [(r["doc"], r["start"], r["count"]) for r in found if not r["bucket"]]
    asked = {}
    for r in found:
        if r["bucket"]:
            asked.setdefault(r["doc"], []).append({"gram": r["gram"], "start": r["start"], "count": r["count"], "salts": salts or 0})
    if not asked:
        return out
    kind = pa.list_(pa.struct([("gram", pa.int64()), ("start", pa.int32()), ("count", pa.int32()), ("salts", pa.int32())]))
    rows = pa.table({"doc": pa.array(list(asked), pa.int64()), "text": pa.array([texts[d] for d in asked], pa.string()), "asked": pa.array(list(asked.values()), kind)})
    order = ["gram", "doc", "start"]
    left = pa.Table.from_batches(suffix_dedup._suffixes(iter(sorted_batches(suffix_dedup._fetch(iter(rows.to_batches(max_chunksize=size))), order, size))))
    again = left.filter(pa.compute.is_valid(left["bytes"]))
    assert salts or not again.num_rows
    out += [(r["doc"], r["start"], r["count"]) for r in left.to_pylist() if r["bytes"] is None]
    if again.num_rows:
        windows = sorted_batches(suffix_dedup._windows(iter(again.to_batches(max_chunksize=size))), order, size)
        out += [(r["doc"], r["start"], r["count"]) for r in pa.Table.from_batches(suffix_dedup._suffixes(iter(windows))).to_pylist()]
    return out


def covered(texts, runs):
    gone = [bytearray(len((t or "").encode())) for t in texts]
    for doc, start, count in runs:
        gone[doc][start : start + count + 99] = b"\1" * (count + 99)
    return [bytes(g) for g in gone]


@pytest.mark.parametrize("salts", [None, 1, 3])
@pytest.mark.parametrize("blind", [False, True])
def test_steps_equal_brute_force_whatever_hashes_and_sizes(monkeypatch, salts, blind):
    """With ``blind`` every minimizer hash is the same, so all segments meet in one bucket: hashes only decide what is compared."""
    r = random.Random(11)
    pieces = [words(r, n) for n in (20, 30, 40, 60)] + ["a" * 150, "\0" * 130, "ab\0" * 60, "né" * 70]
    for case in range(4):
        texts = ["".join(r.choice([*pieces, words(r, 5), "\0", " "]) for _ in range(r.randrange(6))) for _ in range(14)] + [None, "x" * 99]
        for name, value in (("PIECE", [1 << 20, 250][case % 2]), ("REDUCED", [8 << 20, 900, 3000][case % 3]), ("SEGMENTS", [50_000, 6][case % 2]), ("WINDOWS", [100_000, 40][case // 2])):
            monkeypatch.setattr(suffix_dedup, name, value)
        if blind:
            monkeypatch.setattr(suffix_dedup, "mix64", lambda x: x * np.uint64(0))
        seen, want = set(), []
        for t in texts:
            b = (t or "").encode()
            gone = bytearray(len(b))
            for k in range(len(b) - 99):
                if b[k : k + 100] in seen:
                    gone[k : k + 100] = b"\1" * 100
                seen.add(b[k : k + 100])
            want.append(bytes(gone))
        assert covered(texts, in_process(texts, [3, 100][case % 2], salts)) == want
        assert any(map(any, want))


def test_stashed_tables_leave_no_shuffle_files(spark):
    common.configure(spark)
    held = lambda: {b for b in map(str, spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks())) if b.startswith("shuffle_")}
    before = held()
    kept = common.stash(spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")))
    assert not held() - before and spark.conf.get(common.CLEANUP) == "false"
    assert sorted((r.k, r.n) for r in kept.collect()) == [(k, 143 - (k == 6)) for k in range(7)]
