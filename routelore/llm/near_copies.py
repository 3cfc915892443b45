"""The filtering stage of SimHash near-dedup: one document of every group of texts whose shingle sets are similar by 0.8 or more.

A text is the set of its distinct shingles of five words (A-Z in lower case; fewer words: one shingle of all; no words
or null: the empty set). Texts with equal sets are one node, known by its smallest doc_id. Two nodes link where the Jaccard
similarity of their sets is ``SIMILAR`` or more, and groups are the components of the links.

1. Blocks. Fingerprints of four 64-bit words tell similar texts apart from others, but no cut of their bits brings most pairs at 0.8
   together, so nodes are dealt by ``BANDS`` keys of ``ROWS`` minima of hash permutations each. A pair at 0.8 shares no
   key with a chance of (1 - 0.8 ** 4) ** 16 = 2e-4, and less above.
2. Stars. In every block each node is compared with the smallest one: if the fingerprints differ by no more than
   ``RADIUS`` bits, by their exact sets. So a group of near copies is joined by as many comparisons as it has members, whatever
   its size; a block of two nodes needs no more. The members of a star are dealt over salts.
3. Mixed blocks. Only where the nodes of a block are not yet in one component, its fingerprints are compared in full by
   tiles: exclusive-or and bit counts, skipping pairs of tiles whose population counts differ beyond ``FIRST_RADIUS``, pairs
   that are joined already and sizes that can't reach the similarity. A tile emits a spanning forest, never all pairs. The
   sets of what this joins are then compared exactly, block by block, and every link found.

The fingerprint filter loses a pair at 0.8 with a chance of 3e-6 by the angle formula: the expected distance at a similarity s is
256 / pi * acos(2s / (1 + s)) = 39 bits, with a deviation of 5.7. Work grows with the square only of nodes that share a key without
being near copies of its smallest node.

Rows whose ids are null or repeated: all rows are numbered in the order of id (null last) and text, and the first of a
group is kept. Texts of any length are read whole. Columns of any name pass through, and an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, free_name, join_small, mix64, named, stash, with_fields
from .components import connected_components
from .simhash import SEED, TILE, Forest, fingerprint, shingle_hashes, tile_links, words_of

WORDS, SIMILAR = 5, 0.8
BANDS, ROWS = 16, 4
HASHES, RADIUS, FIRST_RADIUS = 4, 72, 24
#: Members of a stored tile, compared in parts of simhash.TILE; members of a star under one salt.
STORED, STAR = 8_192, 2_048
#: Shingles and members of a block whose sets are compared exactly.
BLOCK_SHINGLES, BLOCK_MEMBERS = 262_144, 2_048
#: Ids that may be broadcast, of eight bytes each; beyond it the texts are shuffled once.
BROADCAST_IDS = 1_000_000
_STEPS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SEEDS = np.arange(HASHES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
WIDE = [f"f{k}" for k in range(HASHES)]


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct five-word shingles."""
    return np.unique(shingle_hashes(words_of(text), WORDS))


def wide_fingerprint(hashes: np.ndarray) -> list[int]:
    """Four words of fingerprint over a set of shingles."""
    return [fingerprint(mix64(hashes + _SEEDS[k]) if k else hashes) for k in range(HASHES)]


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for every band of minima; none of an empty set."""
    if not len(hashes):
        return np.zeros(0, np.uint64)
    minima = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for k in range(0, len(hashes), 4_096):  # long texts piece by piece
        part = (hashes[k : k + 4_096] ^ _STEPS[:, None]) * (_STEPS[:, None] | np.uint64(1))
        minima = np.minimum(minima, part.min(axis=1))
    keys = _STEPS[:BANDS].copy()  # bands have different keys
    for row in mix64(minima).reshape(BANDS, ROWS).T:
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            h = shingle_set(text)
            raw = h.tobytes()
            digest = np.array([xxhash.xxh64_intdigest(raw, SEED), xxhash.xxh64_intdigest(raw, SEED + 1)], np.uint64).view(np.int64).tolist()
            rows.append((*digest, np.array(wide_fingerprint(h), np.uint64).view(np.int64).tolist(), len(h), band_keys(h).view(np.int64)))
        d0, d1, words, sizes, keys = zip(*rows, strict=True) if rows else ((), (), (), (), ())
        wide = [pa.array([w[k] for w in words], pa.int64()) for k in range(HASHES)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(d0, pa.int64()), pa.array(d1, pa.int64()), *wide, pa.array(sizes, pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))], names=["doc_id", "d0", "d1", *WIDE, "size", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_set(t).view(np.int64) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"])


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, shingles) of the texts asked for (node)."""
    rows = join_small(docs.select(F.col("doc_id").alias("node"), "text"), nodes.checkpoint(), "node", "inner")
    return stash(rows.select("node", "text").mapInArrow(_sets, "node long, shingles array<long>"))


def _similar(shared: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Are the shared elements 4/5 or more of the union, for sets of so many elements together?"""
    return 9 * shared >= 4 * total


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by pivot and salt, the pivot's own set first: members whose set is similar to the pivot's."""
    held = None
    for batch in batches:
        pivots, nodes, sets = np.asarray(batch.column("pivot")), np.asarray(batch.column("node")), batch.column("shingles")
        sizes = np.asarray(sets.value_lengths()).astype(np.int64)
        flat, at = np.asarray(sets.flatten()), np.r_[0, np.cumsum(sizes)]
        links = []
        cuts = np.r_[0, np.flatnonzero((pivots[1:] != pivots[:-1]) | (nodes[1:] == pivots[1:])) + 1, len(pivots)] if len(pivots) else [0]
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            if nodes[begin] == pivots[begin]:
                held = np.sort(flat[at[begin] : at[begin + 1]])
                begin += 1
            if begin < end:
                part = flat[at[begin] : at[end]]
                there = held[np.minimum(np.searchsorted(held, part), len(held) - 1)] == part
                shared = np.add.reduceat(there.astype(np.int64), at[begin:end] - at[begin])
                links += [(int(pivots[begin]), int(n)) for n in nodes[begin:end][_similar(shared, sizes[begin:end] + len(held))]]
        a, b = zip(*links, strict=True) if links else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _near(x: str, y: str) -> str:
    """SQL: are fingerprints and sizes of two structs near?"""
    bits = " + ".join(f"bit_count({x}.{w} ^ {y}.{w})" for w in WIDE)
    return f"{bits} <= {RADIUS} and least({x}.size, {y}.size) >= {SIMILAR} * greatest({x}.size, {y}.size)"


def star_links(docs: DataFrame, nodes: DataFrame, blocks: DataFrame, keyed: DataFrame) -> DataFrame:
    """(a, b): the nodes of every block that are similar to the block's smallest one."""
    print_of = lambda name: nodes.select(F.col("node").alias(name), F.struct(*WIDE, "size").alias(f"{name}_print"))
    edges = keyed.join(blocks, "key").where("node <> pivot").select("node", "pivot").distinct().checkpoint()
    edges = join_small(edges.join(print_of("node"), "node"), print_of("pivot").join(edges.select("pivot").distinct(), "pivot", "left_semi").checkpoint(), "pivot", "inner")
    edges = edges.where(_near("node_print", "pivot_print")).select("node", "pivot").checkpoint()
    salts = edges.groupBy("pivot").agg(F.ceil(F.count("*") / F.lit(STAR)).cast("int").alias("salts")).checkpoint()
    sets = sets_of(docs, edges.select("node").unionByName(salts.select(F.col("pivot").alias("node"))).distinct())
    members = join_small(edges, salts, "pivot", "inner").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).select("pivot", "salt", "node")
    centres = salts.select("pivot", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.col("pivot").alias("node"))
    rows = members.unionByName(centres).join(sets, "node").withColumn("own", F.expr("node <> pivot"))
    rows = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "own", "node").select("pivot", "node", "shingles")
    return rows.mapInArrow(_stars, "a long, b long")


def _members(column: pa.Array) -> tuple[np.ndarray, ...]:
    """(nodes, labels, fingerprints, sizes) of a stored tile, in order of the first word's population count."""
    flat = column.flatten()
    nodes, labels, sizes = (np.asarray(flat.field(c)) for c in ("node", "label", "size"))
    words = np.stack([np.asarray(flat.field(c)) for c in WIDE], axis=1).view(np.uint64)
    order = np.bitwise_count(words[:, 0]).argsort(kind="stable")
    return nodes[order], labels[order], words[order], sizes[order]


def _links(nodes: np.ndarray, links: list[tuple[int, int]]) -> pa.RecordBatch:
    x, y = (np.array(z, np.int64) for z in (zip(*links, strict=True) if links else ((), ())))
    return pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[y])], names=["a", "b"])


def _compare_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            same = batch.column("same")[k].as_py()
            nodes, labels, words, sizes = _members(batch.column("a").slice(k, 1))
            half = len(nodes)
            if not same:
                more = _members(batch.column("b").slice(k, 1))
                nodes, labels, words, sizes = (np.concatenate(x) for x in zip((nodes, labels, words, sizes), more, strict=True))
            n, counts, forest = len(nodes), np.bitwise_count(words[:, 0]).astype(np.int64), Forest(len(nodes))
            for i in range(0, half, TILE):
                end = min(i + TILE, half)
                for j in range(i if same else half, n, TILE):
                    if counts[j] - counts[end - 1] > FIRST_RADIUS:
                        break
                    if counts[i] - counts[min(j + TILE, n) - 1] > FIRST_RADIUS or len(np.unique(np.r_[labels[i:end], labels[j : j + TILE]])) == 1:
                        continue
                    tile_links(words[i:end], words[j : j + TILE], RADIUS, forest, i, j, FIRST_RADIUS, (sizes[i:end], sizes[j : j + TILE]), (labels[i:end], labels[j : j + TILE]), SIMILAR)
            yield _links(nodes, forest.links)


def _tile_pairs(tiles: DataFrame, counts: DataFrame, key: str, near: str) -> DataFrame:
    """(a, b, same): every pair of tiles of a block that may hold partners, a row each.

    ``tiles`` has key, band, tile and members, ``counts`` the number of tiles by key and band; ``near`` lists as SQL the bands to compare with."""
    other = counts.select(key, F.col("band").alias("band2"), F.col("tiles").alias("tiles2"))
    pairs = counts.withColumn("band2", F.explode(F.expr(near))).join(other, [key, "band2"])
    pairs = pairs.withColumn("tile", F.explode(F.expr("sequence(0, tiles - 1)"))).where("band <> band2 or tile < tiles2")
    pairs = pairs.withColumn("tile2", F.explode(F.expr("sequence(if(band = band2, tile, 0), tiles2 - 1)"))).select(key, "band", "tile", "band2", "tile2")
    left, right = tiles.withColumnRenamed("members", "a"), tiles.select(key, F.col("band").alias("band2"), F.col("tile").alias("tile2"), F.col("members").alias("b"))
    pairs = pairs.join(left, [key, "band", "tile"]).join(right, [key, "band2", "tile2"])  # an empty tile has no row
    return pairs.select("a", "b", F.expr("band = band2 and tile = tile2").alias("same")).repartition(F.xxhash64(F.col("a")[0]["node"], F.col("b")[0]["node"]))


def mixed_links(docs: DataFrame, nodes: DataFrame, keyed: DataFrame, stars: DataFrame) -> DataFrame:
    """(a, b): links that connect all that is similar in blocks whose nodes are not in one component of ``stars`` (node, root)."""
    labelled = keyed.join(stars, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root").checkpoint()
    mixed = labelled.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"), F.bit_xor(F.xxhash64("node")).alias("who"), F.min("node").alias("first"))
    mixed = mixed.where("n > 2 and low <> high").groupBy("n", "who", "first").agg(F.min("key").alias("key"))  # blocks with the same members count once
    mixed = mixed.select("key", F.lit(0).alias("band"), F.ceil(F.col("n") / F.lit(STORED)).cast("int").alias("tiles")).checkpoint()
    members = labelled.join(mixed, "key").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    members = members.join(nodes.select("node", *WIDE, "size"), "node")
    tiles = members.groupBy("key", "band", "tile").agg(F.collect_list(F.struct("node", "label", *WIDE, "size")).alias("members")).checkpoint()
    candidates = connected_components(_tile_pairs(tiles, mixed, "key", "array(0)").mapInArrow(_compare_tiles, "a long, b long"))

    inside = candidates.unionByName(candidates.select(F.col("root").alias("node"), "root")).distinct().withColumnRenamed("root", "group")
    inside = inside.join(labelled.select("node", "label").distinct(), "node").join(nodes.select("node", "size"), "node")
    inside = inside.withColumn("band", F.floor(F.log(F.greatest(F.col("size"), F.lit(1)).cast("double")) / F.log(F.lit(1 / SIMILAR))).cast("int")).checkpoint()
    blocks = inside.groupBy("group", "band").agg(F.ceil(F.greatest(F.sum("size") / F.lit(BLOCK_SHINGLES), F.count("*") / F.lit(BLOCK_MEMBERS))).cast("int").alias("tiles")).checkpoint()
    rows = inside.join(blocks, ["group", "band"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).join(sets_of(docs, inside.select("node")), "node")
    tiles = rows.groupBy("group", "band", "tile").agg(F.collect_list(F.struct("node", "label", "shingles")).alias("members")).checkpoint()
    return _tile_pairs(tiles, blocks, "group", "array(band, band + 1)").mapInArrow(_compare_sets, "a long, b long")


def similar_links(sets: list[np.ndarray], labels: np.ndarray, half: int, same: bool) -> list[tuple[int, int]]:
    """Spanning forest of the pairs of similar sets with different labels; those of the first ``half`` with the others, or all.

    Shared elements are counted for one set against all, over the lists of sets that hold each element."""
    n, sizes, forest = len(sets), np.array([len(s) for s in sets], np.int64), Forest(len(sets))
    forest.label = np.unique(labels, return_inverse=True)[1]
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.repeat(np.arange(n), sizes)[ids.argsort(kind="stable")]
    counts, at = np.bincount(ids), np.r_[0, np.cumsum(sizes)]
    starts = np.cumsum(counts) - counts
    for x in range(half):
        first = x + 1 if same else half
        apart = forest.label[first:] != forest.label[x]
        if not apart.any():
            continue
        mine = ids[at[x] : at[x + 1]]
        lengths = counts[mine]
        places = np.repeat(starts[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        shared = np.bincount(held[places], minlength=n)[first:]
        forest.join(x, first + np.flatnonzero(apart & _similar(shared, sizes[x] + sizes[first:])))
    return forest.links


def _compare_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            same, sides = batch.column("same")[k].as_py(), [batch.column(c).slice(k, 1).flatten() for c in "ab"]
            sides = sides[:1] if same else sides
            nodes, labels = (np.concatenate([np.asarray(s.field(c)) for s in sides]) for c in ("node", "label"))
            sets = [np.asarray(x.values) for s in sides for x in s.field("shingles")]
            yield _links(nodes, similar_links(sets, labels, len(sides[0]), same))


def later_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id) of all documents but the smallest of each group.  Ids are distinct."""
    configure(spark)
    rows = docs.select("doc_id", "text")
    prints = stash(rows.mapInArrow(_sketched, with_fields(rows.select("doc_id"), ("d0", "long"), ("d1", "long"), *[(c, "long") for c in WIDE], ("size", "long"), ("keys", "array<long>"))))
    nodes = stash(prints.groupBy("d0", "d1", "size").agg(F.min("doc_id").alias("node"), *[F.first(c).alias(c) for c in (*WIDE, "keys")]))  # all alike but for the id
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    blocks = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("pivot")).where("n > 1").select("key", "pivot").checkpoint()
    keyed = stash(keyed.join(blocks.select("key"), "key"))
    stars = star_links(docs, nodes, blocks, keyed).checkpoint()
    more = mixed_links(docs, nodes, keyed, connected_components(stars))
    firsts = nodes.select("node").join(connected_components(stars.unionByName(more)).select("node"), "node", "left_anti")
    return prints.select("doc_id").join(firsts.withColumnRenamed("node", "doc_id"), "doc_id", "left_anti")


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every near-duplicate group: the one with the smallest doc_id (null last)."""
    odd = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if odd.limit(1).count():  # ids don't tell rows apart
        key = free_name(docs, "row")
        rows = stash(docs.orderBy(F.col("doc_id").asc_nulls_last(), "text").withColumn(key, F.monotonically_increasing_id()))
    else:
        key, rows = "doc_id", docs
    later = later_copies(spark, rows.select(F.col(key).cast("long").alias("doc_id"), "text")).withColumnRenamed("doc_id", key).checkpoint()
    return join_small(rows, later, key, "left_anti", BROADCAST_IDS).select(*named(docs.columns))
