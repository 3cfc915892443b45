"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items and documents are sets of shingles of ``WORDS`` lower-case words; an item of fewer words is one shingle of them all,
and is looked for among the document's runs of so many words. An item is contained in a document when
at least ``THRESHOLD`` of its distinct shingles are in it. A short item inside a long document has next to no Jaccard
similarity with the whole of it, so items are partitioned by size into classes (1, 2, at most 4, 8, 16, ... shingles). The minimum
of one shingle is the shingle itself under any permutation, so the first class is looked up as it is. For the class of size u a document is seen as windows of 2u shingles, one every u. Any run of u shingles
lies in one window, where the similarity to a contained item is high enough for MinHash. One pass computes the
minima of ``PERMUTATIONS`` hash permutations over runs as long as the smallest class; those of larger windows are minima of these.
A document is a candidate for an item when they share a minimum in some window. With a similarity of at least
0.8(u/2) / (2u + 0.2u/2) > 0.19 the chance to miss an item that is contained in one window is below 0.81 ** 48 = 4e-5;
items of one shingle are never missed.
Every candidate is then verified: distinct shingles of the item that are in the whole document, by their text.

Items are a stated query set: Spark works out their minima, and the driver orders them and hands them to the executors in blocks of at most
``BLOCK_ITEMS`` rows and ``BLOCK_CHARS`` characters, one pass over the documents a block; no task builds anything, and the shingles of an item are
made where it is a candidate. Texts are never shuffled, a document of any length is searched whole and judged by itself,
so hot sources and copies skew nothing. Texts without words have no shingle and are in no pair. Nulls are empty texts; items whose
id is null are searched like any other. Repeated rows give repeated pairs, ties at the threshold count, and without documents or items there is no pair.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, map_rows, mix64, with_fields

WORDS = 5
THRESHOLD = 0.8
PERMUTATIONS = 48
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 32_000_000
TOKEN = re.compile(r"\w+")
TOP = np.uint64(2**64 - 1)


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


def shingles_of(words: list[str], n: int = WORDS) -> list[str]:
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


class WordHashes:
    """64-bit hashes of words, kept for words seen before (up to a bound)."""

    def __init__(self, bound: int = 500_000) -> None:
        self.known, self.bound = {}, bound

    def shingles(self, words: list[str], n: int = WORDS) -> np.ndarray:
        """Hash of every shingle, in order."""
        known = self.known
        try:
            x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            if len(known) > self.bound:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
            x = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        x = mix64(x)
        out = np.zeros(max(0, len(x) - n + 1), np.uint64)
        for k in range(n):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += x[k : k + len(out)]
        return mix64(out)


def permuted(h: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Well-mixed hashes in another order: xor with a seed, times an odd number made from it."""
    return (h ^ seed) * (seed | np.uint64(1))


def seeds(n: int = PERMUTATIONS) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Described(NamedTuple):
    """An item as it is searched for."""

    id: int | None
    text: str
    #: Words of its shingles, distinct shingles, and their minima under all permutations.
    length: int
    size: int
    minima: bytes


def describe(id_: int | None, text: str | None, hashes: WordHashes, n: int = WORDS) -> Described:
    words = words_of(text)
    length = max(1, min(n, len(words)))
    hashed = np.unique(hashes.shingles(words, length))
    # one shingle is its own minimum
    minima = hashed if len(hashed) <= 1 else permuted(hashed[None, :], seeds()[:, None]).min(axis=1)
    return Described(id_, text or "", length, len(set(shingles_of(words, length))), minima.tobytes())


class Index:
    """The minima of the items of each size class in order, as the tasks read them."""

    def __init__(self, items: list[Described], n: int = WORDS, threshold: float = THRESHOLD) -> None:
        self.n, self.threshold, self.seeds = n, threshold, seeds()
        self.ids, self.texts, self.lengths, sizes = [x.id for x in items], [x.text for x in items], [x.length for x in items], [x.size for x in items]
        self.sizes = sizes
        #: Items of one shingle by its words: (sorted hashes, item numbers).
        self.single: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for m in {m for m, k in zip(self.lengths, sizes, strict=True) if k == 1}:
            mine = np.array([j for j, k in enumerate(sizes) if k == 1 and self.lengths[j] == m])
            keys = np.array([np.frombuffer(items[j].minima, np.uint64)[0] for j in mine], np.uint64)
            self.single[m] = (np.sort(keys), mine[keys.argsort(kind="stable")])
        self.classes: dict[int, tuple[list[np.ndarray], list[np.ndarray]]] = {}
        for u in sorted({self._class(k) for k in sizes if k > 1}):
            mine = [j for j, k in enumerate(sizes) if k > 1 and self._class(k) == u]
            minima = np.stack([np.frombuffer(items[j].minima, np.uint64) for j in mine])
            order = minima.argsort(axis=0, kind="stable")
            self.classes[u] = ([minima[order[:, p], p] for p in range(PERMUTATIONS)], [np.array(mine)[order[:, p]] for p in range(PERMUTATIONS)])
        self.hashes, self.sets = WordHashes(), {}  # of a task

    def shingles(self, j: int) -> frozenset[str]:
        """The distinct shingles of an item, kept for items that were candidates before (up to a bound)."""
        if j not in self.sets:
            if len(self.sets) >= 2_000:
                self.sets.clear()
            self.sets[j] = frozenset(shingles_of(words_of(self.texts[j]), self.lengths[j]))
        return self.sets[j]

    @staticmethod
    def _class(size: int) -> int:
        return 1 << (size - 1).bit_length()

    @staticmethod
    def _hits(owner: np.ndarray, values: np.ndarray, keys: np.ndarray, items: np.ndarray, found: set[tuple[int, int]]) -> None:
        """Adds (owner, item) of every value that is among the sorted keys."""
        lo = np.searchsorted(keys, values, "left")
        hit = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == values))
        for w in hit.tolist():
            j = int(lo[w])
            while j < len(keys) and keys[j] == values[w]:
                found.add((int(owner[w]), int(items[j])))
                j += 1

    def candidates(self, texts: list[list[str]]) -> set[tuple[int, int]]:
        """(text, item) numbers that share a window minimum."""
        found: set[tuple[int, int]] = set()
        for m, (keys, items) in self.single.items():
            hashed = [self.hashes.shingles(w, m) for w in texts]
            self._hits(np.repeat(np.arange(len(texts)), [len(h) for h in hashed]), np.concatenate(hashed), keys, items, found)
        if not self.classes:
            return found
        hashed = [self.hashes.shingles(w, self.n) for w in texts]
        used = [k for k, h in enumerate(hashed) if len(h)]
        if not used:
            return found
        smallest, largest = min(self.classes), max(self.classes)
        runs = [-(-len(hashed[k]) // smallest) for k in used]  # each text is padded to whole runs
        total = sum(runs)
        flat = np.zeros(total * smallest, np.uint64)
        pad = np.ones(total * smallest, bool)
        at = 0
        for k, r in zip(used, runs, strict=True):
            flat[at * smallest : at * smallest + len(hashed[k])] = hashed[k]
            pad[at * smallest : at * smallest + len(hashed[k])] = False
            at += r
        # runs are joined in pairs inside each text, level by level, in the same way for every permutation
        own, u, levels = np.repeat(np.array(used), runs), smallest, []
        while True:
            same = own[1:] == own[:-1]
            first = np.flatnonzero(np.r_[True, ~same])
            place = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
            even = np.flatnonzero(place % 2 == 0)
            after = np.minimum(even + 1, len(own) - 1)
            levels.append((u, own, np.flatnonzero(same), even, np.where(own[after] == own[even], after, even)))
            if u >= largest:
                break
            own, u = own[even], u * 2
        for p in range(PERMUTATIONS):
            v = permuted(flat, self.seeds[p])
            v[pad] = TOP
            level = v.reshape(-1, smallest).min(axis=1)
            for u, own, paired, even, after in levels:
                if u in self.classes:
                    window = level.copy()
                    window[paired] = np.minimum(level[paired], level[paired + 1])
                    self._hits(own, window, *(x[p] for x in self.classes[u]), found)
                level = np.minimum(level[even], level[after])
        return found

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text number, item id, shared shingles, item's shingles) of every verified pair."""
        words = [words_of(t) for t in texts]
        out, held = [], {}
        for k, j in sorted(self.candidates(words)):
            if (k, m := self.lengths[j]) not in held:
                if held and next(iter(held))[0] != k:
                    held = {}  # one text's sets at a time
                held[k, m] = frozenset(shingles_of(words[k], m))
            shared = len(self.shingles(j) & held[k, m])
            if shared >= self.threshold * self.sizes[j] - 1e-9:
                out.append((k, self.ids[j], shared, self.sizes[j]))
        return out


def item_blocks(items: DataFrame, n: int = WORDS) -> Iterator[list[Described]]:
    """Blocks of the query set, of bounded rows and characters, described by the executors and read one partition at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            rows = [describe(i, t, hashes, n) for i, t in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            kinds = (batch.schema.field("item_id").type, pa.string(), pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(Described._fields))

    rows = items.select("item_id", "text")
    described = rows.mapInArrow(run, f"id {dict(rows.dtypes)['item_id']}, text string, length int, size long, minima binary")
    block, chars = [], 0
    for r in described.toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(r["text"]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append(Described(r["id"], r["text"], r["length"], r["size"], bytes(r["minima"])))
        chars += len(r["text"])
    yield block


#: Texts that are searched together; bounds the arrays of a task.
GROUP_CHARS = 600_000


def _grouped(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > GROUP_CHARS:
            yield begin, k
            begin, size = k, 0
        size += len(t or "")
    if begin < len(texts):
        yield begin, len(texts)


def contained_items(spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles) of all items contained in documents, one row a pair."""
    configure(spark)
    rows, out = docs.select("doc_id", "text"), None
    for block in item_blocks(items, n):
        held = spark.sparkContext.broadcast(Index(block, n, threshold))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                for begin, end in _grouped(texts):
                    found = index.search(texts[begin:end])
                    if found:
                        k, item, shared, size = (pa.array(x, pa.int64()) for x in zip(*found, strict=True))
                        yield pa.RecordBatch.from_arrays([ids.slice(begin, end - begin).take(k), item, shared, size], names=["doc_id", "item_id", "shared", "item_shingles"])

        found = rows.mapInArrow(run, with_fields(rows.select("doc_id"), ("item_id", "long"), ("shared", "long"), ("item_shingles", "long")))
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, n: int = WORDS) -> DataFrame:
    """The rows of ``docs`` that contain no item, in their own columns; each is judged where it lies."""
    configure(spark)
    schema = docs.schema
    for block in item_blocks(items, n):
        held = spark.sparkContext.broadcast(Index(block, n, threshold))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                texts = batch.column("text").to_pylist()
                keep = np.ones(len(texts), bool)
                for begin, end in _grouped(texts):
                    keep[[begin + k for k, *_ in index.search(texts[begin:end])]] = False
                yield batch.filter(pa.array(keep))

        docs = map_rows(docs, run, schema)
    return docs


def decontam_query(spark: SparkSession, docs: DataFrame, items: DataFrame) -> DataFrame:
    return contained_items(spark, docs, items).withColumn("containment", F.col("shared") / F.col("item_shingles"))
