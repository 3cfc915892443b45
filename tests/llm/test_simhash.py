import random

import numpy as np
import xxhash

from routelore.llm import near_copies, simhash
from routelore.llm.components import connected_components

from .conftest import make_docs, words


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in lower.translate(str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))).split(" ") if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, radius):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (int(fps[i]) ^ int(fps[j])).bit_count() <= radius and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


def planted(rng: random.Random, n: int, balls: int, size: int) -> list[int]:
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(balls):
        x = rng.getrandbits(64)
        for _ in range(size):
            x ^= 1 << rng.randrange(64) if rng.random() < 0.7 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            out.append(x)
    return list(dict.fromkeys(out))


def check_components(spark, fps):
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    prints = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    simhash.configure(spark)
    got = {r.fp: r.component_id for r in simhash.components(spark, prints).collect()}
    assert [got[x] for x in signed] == brute_components(fps, 2)


def test_components_equal_brute_force(spark, rng):
    check_components(spark, planted(rng, 300, 6, 25))


def test_large_groups_are_dealt_again(spark, rng, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE", 8)
    monkeypatch.setattr(simhash, "TILE", 4)
    check_components(spark, planted(rng, 40, 2, 60) + [0, 1, 3, 2**63])


def test_query_rows(spark, rng):
    t = words(rng, 50)
    texts = [None, "", " \n", "One", "one", "a b", t, t.upper(), t + " more", words(rng, 70_000)]
    got = {r.doc_id: r for r in simhash.simhash_query(spark, make_docs(spark, texts)).collect()}
    assert [int(got[i].fingerprint, 16) for i in range(10)] == [brute_fingerprint(t) for t in texts]
    assert got[2].component_id == 0 and got[4].component_id == 3 and got[7].component_id == 6


def test_repeated_and_null_ids_and_no_rows(spark):
    df = make_docs(spark, ["x y z", "x y z", "x y z"], ids=[5, 5, None])
    assert [r.component_id for r in simhash.simhash_query(spark, df).collect()] == [5, 5, 5]
    assert simhash.simhash_query(spark, make_docs(spark, [])).count() == 0


def test_long_chains_settle(spark):
    simhash.configure(spark)
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_stage_keeps_one_of_each_group(spark, rng):
    base = [words(rng, 150) for _ in range(30)]
    near = [b.replace(b.split()[75], "changed", 1) for b in base[:10]]
    texts = [*base, *near, base[0], None, "", "  "]
    df = make_docs(spark, texts).withColumnRenamed("source", "group")
    kept = near_copies.keep_one(spark, df.repartition(4))
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [*range(30), 41]
    twice = make_docs(spark, [base[0], base[0], near[0], base[1]], ids=[3, 3, None, 4])
    assert sorted(r.doc_id for r in near_copies.keep_one(spark, twice).collect()) == [3, 4]
    assert near_copies.keep_one(spark, make_docs(spark, [])).count() == 0


def test_stage_tiles_lose_no_link(spark, rng, monkeypatch):
    monkeypatch.setattr(near_copies, "STORED", 7)
    monkeypatch.setattr(near_copies, "STAR", 7)
    base = words(rng, 100).split()
    texts = []
    for _ in range(40):
        w = list(base)
        w[rng.randrange(100)] = "changed"
        texts.append(" ".join(w))
    texts += [words(rng, 100) for _ in range(20)]
    assert sorted(r.doc_id for r in near_copies.keep_one(spark, make_docs(spark, texts)).collect()) == [0, *range(40, 60)]


def edited(rng, text, changes):
    w = text.split()
    for k in rng.sample(range(len(w)), changes):
        w[k] = f"e{rng.randrange(10**9)}"
    return " ".join(w)


def brute_kept(texts):
    """Smallest place of every component of exact five-word-shingle similarities of 0.8 or more."""
    sets, label = [], list(range(len(texts)))
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a and 5 * len(a & b) >= 4 * len(a | b)):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return sorted(set(label))


def test_stage_decides_by_shingle_similarity(spark, rng, monkeypatch):
    texts = ["", words(rng, 3)]
    for n in (8, 9, 12, 20, 50, 100, 300, 600):
        for k in range(6):
            texts.append(words(rng, n))
            texts += [edited(rng, texts[-1], c) for c in range(1, max(2, n // 25))]  # similarities on both sides of 0.8
            texts.append(" ".join(texts[-1].split()[: n - n // 5 + k % 3]))
    want = brute_kept(texts)
    assert 100 < len(want) < len(texts) - 50
    assert sorted(r.doc_id for r in near_copies.keep_one(spark, make_docs(spark, texts)).collect()) == want
    monkeypatch.setattr(near_copies, "BLOCK_MEMBERS", 2)
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", 500)
    assert sorted(r.doc_id for r in near_copies.keep_one(spark, make_docs(spark, texts)).collect()) == want
