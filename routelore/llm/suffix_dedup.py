"""Suffix-array dedup: remove every byte that a string of ``LENGTH`` bytes covers which also starts earlier.

"Earlier" is a smaller document, or an earlier start in the same one; only later copies go, the first stays.

The suffix order of a corpus is too large to be sorted as a whole, and most suffixes have no equal. So it is
built where there are copies, bucket by bucket. Hashes only say which suffixes meet; what is a copy is always read from bytes,
by the longest previous factor.

1. Anchors. Each window of LENGTH bytes has a minimizer: of its substrings of ``GRAM`` bytes the one with the least
   hash (the leftmost of equals). Equal windows have equal minimizers at equal places, so a copy can only be among windows
   whose minimizers are equal. The windows of one minimizer form a segment of at most 2 * LENGTH - GRAM bytes; there
   is one about every LENGTH - GRAM over 2 bytes. Every task first builds the suffix array of those segments of its texts whose
   minimizers it has seen twice, and takes out the segments that have an earlier copy.
2. Buckets. Segments meet by their minimizer, as a few numbers each. A minimizer with one segment is done.
3. Suffix arrays. The bytes of all other segments are fetched. In each bucket a sparse suffix array, of the suffixes that begin
   segments, is sorted, with longest common prefixes of neighbours. The previous and the next smaller position in suffix order give
   the longest previous factor: where it reaches the end of the segment, all its windows are copies. Of the segments that are
   left, all suffixes that begin a window are sorted by their first LENGTH bytes, and a window is a copy if its factor reaches LENGTH.
   Buckets of more than ``LARGE`` segments (the edges of a passage that very many documents share) are dealt
   again by whole windows, after every task has reduced equal windows to their earliest; equal windows of such a bucket are
   reduced again and again while they come in, so that a window of any number of documents takes little memory.
4. Removal. The windows found go back to their documents, where spans are merged and the other bytes are kept.

Texts are taken as UTF-8 bytes; null texts are empty, and texts shorter than LENGTH keep all bytes. If ids are null or
repeated, rows are ordered by id (null first) and digest of the text, and each row is a document of its own; among equal rows any may be the
earlier one, which changes no digest. Texts of any length are cut into pieces that overlap by a window. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, join_small, mix64, stash, text_bytes, with_fields

LENGTH = 100
GRAM = 32
#: Bytes that are hashed at once, and bytes whose segments are reduced together in a task.
PIECE = 1 << 20
REDUCED = 8 << 20
#: Segments of a bucket above which it is dealt by whole windows.
LARGE = 2_000
#: Windows that one suffix array holds.
WINDOWS = 100_000
#: Segments that one sparse suffix array holds, and the bytes of the longest segment.
SEGMENTS, WIDEST = 50_000, 2 * LENGTH - GRAM

_RANDOM = np.random.default_rng(20_240)
TABLE = _RANDOM.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + _RANDOM.integers(0, 2, 256, dtype=np.uint64)
ODD = _RANDOM.integers(0, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _doubled(h: np.ndarray, step: int, odd: np.uint64) -> np.ndarray:
    out = h[:-step] * odd
    out += h[step:]
    return out


def segments(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document number, start of its first window, windows, minimizer hash) of all segments of the documents that lie in
    ``raw`` one after another."""
    n = len(raw)
    if n < LENGTH:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64))
    h, step = TABLE[raw], 1
    for k in range(5):  # hashes of 2, 4, 8, 16 and 32 bytes
        h = _doubled(h, step, ODD[k])
        step *= 2
        if k == 2:
            h ^= h >> np.uint64(31)
    windows = n - LENGTH + 1
    gram = h ^ (h >> np.uint64(32))
    gram *= ODD[7]
    low = (gram & HIGH) | np.arange(len(gram), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:windows], low[width - have : width - have + windows])
    at = (low & LOW).astype(np.int64)
    # windows that cross the end of a document do not count
    edge = np.zeros(windows + 1, np.int32)
    long = np.diff(offsets) >= LENGTH
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(edge[:-1]) > 0
    turn = np.r_[True, at[1:] != at[:-1]]
    starts = np.flatnonzero(valid & (turn | ~np.r_[False, valid[:-1]]))
    ends = np.flatnonzero(valid & (np.r_[turn[1:], True] | ~np.r_[valid[1:], False]))
    doc = np.searchsorted(offsets, starts, "right") - 1
    return doc, starts - offsets[doc], ends - starts + 1, mix64(gram[at[starts]])


def _pieces(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of documents of some ``size`` bytes; a longer document is a run by itself (and is cut by ``_anchors``)."""
    begin = 0
    while begin < len(offsets) - 1:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1)
        yield begin, end
        begin = end


def _runs(doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same windows with adjacent runs of a document joined."""
    if not len(doc):
        return doc, start, count
    order = np.lexsort((start, doc))
    doc, start, count = doc[order], start[order], count[order]
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + count[:-1])])
    return doc[first], start[first], np.add.reduceat(count, first)


#: A run of copies has a negative number of windows.
ANCHORS = "gram long, doc long, start int, windows int"
FOUND = "doc long, start int, count int, gram long, bucket boolean"


def _batch(columns: dict[str, tuple[np.ndarray, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v).cast(t) for v, t in columns.values()], names=list(columns))


def _padded(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The segments at ``begin``, a row each, filled up with zeros; WIDEST bytes follow the last one in ``raw``."""
    rows = np.lib.stride_tricks.sliding_window_view(raw, WIDEST)[begin]
    rows[np.arange(WIDEST) >= length[:, None]] = 0
    return rows


def _copied(bucket: np.ndarray, rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Segments, in text order within their buckets, that begin some earlier segment or are one."""
    return factors(bucket, rows, length) >= length


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the texts; those with an earlier copy in the task are given as copies."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def reduced() -> pa.RecordBatch:
        raw = np.concatenate([*[h[0] for h in held], np.zeros(WIDEST, np.uint8)])
        base = np.cumsum([0, *[len(h[0]) for h in held[:-1]]])
        begin = np.concatenate([h[1] + b for h, b in zip(held, base, strict=True)])
        doc, start, count, gram = (np.concatenate(x) for x in zip(*[h[2:] for h in held], strict=True))
        gram = gram.view(np.int64)
        order = np.lexsort((start, doc, gram))
        doc, start, count, gram, begin = (x[order] for x in (doc, start, count, gram, begin))
        same = np.r_[False, gram[1:] == gram[:-1]]
        shared = np.flatnonzero(same | np.r_[same[1:], False])
        copy = np.zeros(len(doc), bool)
        bucket = np.cumsum(~same[shared])
        cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(shared)]
        at = 0
        while at < len(cuts) - 1:  # some buckets at a time
            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + SEGMENTS, "right")) - 1)
            part = shared[cuts[at] : cuts[to]]
            length = count[part] + LENGTH - 1
            copy[part] = _copied(bucket[cuts[at] : cuts[to]], _padded(raw, begin[part], length), length)
            at = to
        d, s, c = _runs(doc[copy], start[copy], count[copy])
        spread = mix64(d.view(np.uint64) ^ (s.astype(np.uint64) << np.uint64(40))).view(np.int64)  # copies go anywhere, not to their hot bucket
        return _batch({"gram": (np.r_[gram[~copy], spread], pa.int64()), "doc": (np.r_[doc[~copy], d], pa.int64()), "start": (np.r_[start[~copy], s], pa.int32()), "windows": (np.r_[count[~copy], -c], pa.int32())})

    for batch in batches:
        ids = np.asarray(batch.column("doc"))
        raw, offsets = text_bytes(batch.column("text"))
        for begin, end in _pieces(offsets, PIECE):
            whole, ends = raw[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin]
            for first in range(0, len(whole), PIECE) if end == begin + 1 else [0]:  # a long document: PIECE windows at a time
                piece, own = (whole[first : first + PIECE + LENGTH - 1], None) if end == begin + 1 else (whole, ends)
                own = np.array([0, len(piece)]) if own is None else own
                doc, start, count, gram = segments(piece, own)
                held.append((piece, own[doc] + start, ids[begin + doc], start + first, count, gram))
                size += len(piece)
                if size >= REDUCED:
                    yield reduced()
                    held, size = [], 0
    if held and size:
        yield reduced()


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by minimizer: the runs of copies, and the segments whose minimizer others have too."""
    open_: tuple | None = None  # the last segment, and if it has a neighbour before

    def out(rows: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        doc, start, count, gram, bucket = (np.concatenate(x) for x in zip(*rows, strict=True))
        return _batch({"doc": (doc, pa.int64()), "start": (start, pa.int32()), "count": (count, pa.int32()), "gram": (gram, pa.int64()), "bucket": (bucket, pa.bool_())})

    for batch in batches:
        g, d, s, c = (np.asarray(batch.column(x)).astype(np.int64) for x in ("gram", "doc", "start", "windows"))
        run = c < 0
        rows = [(d[run], s[run], -c[run], np.zeros(run.sum(), np.int64), np.zeros(run.sum(), bool))]
        g, d, s, c = (x[~run] for x in (g, d, s, c))
        if len(g):
            before = np.zeros(len(g), bool)
            if open_ is not None:
                g, d, s, c = (np.r_[v, x] for v, x in zip(open_[:4], (g, d, s, c), strict=True))
                before = np.r_[open_[4], before]
            before[1:] |= g[1:] == g[:-1]
            shared = before.copy()
            shared[:-1] |= g[1:] == g[:-1]
            open_ = (g[-1], d[-1], s[-1], c[-1], before[-1])
            shared[-1] = False
            rows.append((d[shared], s[shared], c[shared], g[shared], np.ones(shared.sum(), bool)))
        yield out(rows)
    if open_ is not None and open_[4]:
        yield out([tuple(np.array([x]) for x in (open_[1], open_[2], open_[3], open_[0], True))])


def factors(bucket: np.ndarray, rows: np.ndarray, length: np.ndarray | None = None) -> np.ndarray:
    """Longest previous factor, up to the width of ``rows``, of suffixes in text order (by bucket, then document and start).

    ``rows`` has the suffixes' first bytes, a row each, of which ``length`` count.  The suffix array is the stable order of bucket and
    bytes, so equal ones stay in text order; longest common prefixes are those of neighbours.  From each suffix the search for a
    smaller position jumps over suffixes that were passed already, keeping the least common prefix on its way."""
    n, width = rows.shape
    keyed = np.concatenate([bucket.astype(">u4").view(np.uint8).reshape(n, 4), rows], axis=1)
    order = np.ascontiguousarray(keyed).view(f"S{4 + width}").ravel().argsort(kind="stable")
    same = keyed[order[1:]] == keyed[order[:-1]]
    common = np.maximum(np.where(same.all(axis=1), 4 + width, same.argmin(axis=1)) - 4, 0)
    if length is not None:
        common = np.minimum(common, np.minimum(length[order[1:]], length[order[:-1]]))
    best = np.zeros(n, np.int64)
    for position, prefix in ((order, np.r_[0, common]), (order[::-1], np.r_[0, common[::-1]])):
        to, shared = np.arange(n) - 1, prefix.astype(np.int64)
        while True:
            going = np.flatnonzero((to >= 0) & (shared > 0))
            going = going[position[to[going]] > position[going]]
            if not len(going):
                break
            passed = to[going]
            shared[going] = np.minimum(shared[going], shared[passed])
            to[going] = to[passed]
        shared[to < 0] = 0
        best[position] = np.maximum(best[position], shared)
    return best


BYTES = "gram long, doc long, start int, count int, large boolean, bytes binary"
#: Runs of copies have no bytes; segments of large buckets that are left have theirs.
LEFT = "doc long, start int, count int, bytes binary"


def _segment_rows(gram: np.ndarray, doc: np.ndarray, start: np.ndarray, count: np.ndarray, large: np.ndarray, data: list[bytes | None]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    return pa.RecordBatch.from_arrays([*(pa.array(x).cast(t) for x, t in zip((gram, doc, start, count, large), kinds, strict=True)), pa.array(data, pa.binary())], names=["gram", "doc", "start", "count", "large", "bytes"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments asked for; those of large buckets meet in parts of it first."""
    for batch in batches:
        asked = batch.column("asked")
        raw, offsets = text_bytes(batch.column("text"))
        row = np.repeat(np.arange(len(asked)), np.asarray(asked.value_lengths()))
        flat = asked.flatten()
        gram, start, count, salts = (np.asarray(flat.field(c)).astype(np.int64) for c in ("gram", "start", "count", "salts"))
        doc = np.asarray(batch.column("doc"))[row]
        salt = mix64(doc.view(np.uint64)) % np.maximum(salts, 1).astype(np.uint64)
        key = np.where(salts > 0, mix64(gram.view(np.uint64) ^ (salt + np.uint64(1)) * ODD[6]).view(np.int64), gram)
        begin = offsets[row] + start
        data = raw.tobytes()
        yield _segment_rows(key, doc, start, count, salts > 0, [data[b : b + c + LENGTH - 1] for b, c in zip(begin.tolist(), count.tolist(), strict=True)])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments cut into windows, keyed by their content; of equal windows in a batch the earliest, the others as runs of copies."""
    for batch in batches:
        doc, start, count = (np.asarray(batch.column(c)).astype(np.int64) for c in ("doc", "start", "count"))
        data = batch.column("bytes").to_pylist()
        owner = np.repeat(np.arange(len(doc)), count)
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        at = start[owner] + shift
        firsts: dict[bytes, int] = {}
        again = []
        for k in np.lexsort((at, doc[owner])).tolist():
            window = data[owner[k]][shift[k] : shift[k] + LENGTH]
            if window in firsts:
                again.append(k)
            else:
                firsts[window] = k
        first = np.array(list(firsts.values()), np.int64)
        key = np.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True) for w in firsts], np.int64)
        again = np.array(again, np.int64)
        d, s, n = _runs(doc[owner[again]], at[again], np.ones(len(again), np.int64))
        columns = [np.r_[x, y] for x, y in zip((key, doc[owner[first]], at[first], np.ones(len(first), np.int64)), (mix64(d.view(np.uint64)).view(np.int64), d, s, n), strict=True)]
        yield _segment_rows(*columns, np.zeros(len(columns[0]), bool), [*firsts, *[None] * len(d)])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over segments sorted by bucket, document and start: the runs of windows that are copies by their factors.  Of the parts of
    large buckets only whole segments are taken out, and those that are left are given with their bytes."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]] = []
    size = 0
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())

    def batch_of(doc: np.ndarray, start: np.ndarray, count: np.ndarray, more: list[tuple] | None = None) -> pa.RecordBatch:
        d, s, c, data = more or ((), (), (), [])
        columns = (np.r_[doc, d], np.r_[start, s], np.r_[count, c], [*[None] * len(doc), *data])
        return pa.RecordBatch.from_arrays([pa.array(x).cast(t) if t != pa.binary() else pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["doc", "start", "count", "bytes"])

    def arrays(parts: list) -> tuple[np.ndarray, ...]:
        gram, doc, start, count = (np.concatenate([p[i] for p in parts]) for i in range(4))
        data = [b for p in parts for b in p[4]]
        return gram, doc, start, count, np.frombuffer(b"".join([*data, bytes(WIDEST)]), np.uint8), np.cumsum(np.r_[0, gram[1:] != gram[:-1]]), data

    def solved(parts: list) -> pa.RecordBatch:
        gram, doc, start, count, text, bucket, data = arrays(parts)
        large = np.concatenate([p[5] for p in parts])
        length = count + LENGTH - 1
        base = np.cumsum(length) - length
        whole = _copied(bucket, _padded(text, base, length), length)
        later = np.flatnonzero(~whole & large)
        left = np.flatnonzero(~whole & ~large)
        alone = np.bincount(bucket[left], minlength=bucket[-1] + 1) == 1  # nothing is left to compare it with
        left = left[~alone[bucket[left]]]
        owner = np.repeat(left, count[left])
        shift = np.arange(len(owner)) - np.repeat(np.cumsum(count[left]) - count[left], count[left])
        d, s, c = doc[whole], start[whole], count[whole]
        if len(owner):
            rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[base[owner] + shift]
            copy = np.flatnonzero(factors(bucket[owner], rows) >= LENGTH)
            d, s, c = np.r_[d, doc[owner[copy]]], np.r_[s, start[owner[copy]] + shift[copy]], np.r_[c, np.ones(len(copy), np.int64)]
        return batch_of(*_runs(d, s, c), (doc[later], start[later], count[later], [data[k] for k in later.tolist()]))

    def thinned(parts: list) -> tuple[pa.RecordBatch, list]:
        """Windows of one bucket that have an earlier one in it, and the others."""
        gram, doc, start, count, text, bucket, data = arrays(parts)
        copy = factors(bucket, text[:-WIDEST].reshape(-1, LENGTH)) >= LENGTH
        kept = np.flatnonzero(~copy)
        return batch_of(*_runs(doc[copy], start[copy], count[copy])), [(gram[kept], doc[kept], start[kept], count[kept], [data[k] for k in kept.tolist()], np.zeros(len(kept), bool))]

    for batch in batches:
        given = np.asarray(batch.column("bytes").is_null())
        columns = [np.asarray(batch.column(c)).astype(np.int64) for c in ("gram", "doc", "start", "count")]
        large = np.asarray(batch.column("large"))[~given]
        if given.any():
            yield batch_of(*(c[given] for c in columns[1:]))
        data = batch.column("bytes").filter(pa.array(~given)).to_pylist()
        columns = [c[~given] for c in columns]
        gram = columns[0]
        begin = 0
        # whole buckets are solved together, as many as fit
        for cut in [*(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), len(gram)]:
            if begin == 0 and cut and held and held[-1][0][-1] != gram[0] and size >= WINDOWS:
                yield solved(held)
                held, size = [], 0
            if cut > begin:
                held.append((*(c[begin:cut] for c in columns), data[begin:cut], large[begin:cut]))
                size += int(columns[3][begin:cut].sum())
                begin = cut
            if size >= WINDOWS and cut < len(gram):
                yield solved(held)
                held, size = [], 0
        if size >= 2 * WINDOWS and len(gram) and all((p[3] == 1).all() and (p[0] == gram[-1]).all() and not p[5].any() for p in held):  # one bucket of whole windows
            found, held = thinned(held)
            size = int(sum(p[3].sum() for p in held))
            yield found
    if held:
        yield solved(held)


def _kept(raw: bytes, start: np.ndarray, count: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed spans of a document, and what is left of it."""
    order = start.argsort(kind="stable")
    begin, end = start[order], (start + count + LENGTH - 1)[order]
    reach = np.maximum.accumulate(end)
    first = np.flatnonzero(np.r_[True, begin[1:] > reach[:-1]])
    spans = list(zip(begin[first].tolist(), reach[np.r_[first[1:] - 1, len(reach) - 1]].tolist(), strict=True))
    kept, at = [], 0
    for b, e in spans:
        kept.append(raw[at:b])
        at = e
    return spans, b"".join([*kept, raw[at:]])


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """(doc, doc_id, text), and if doc is not the id itself: ids that are null or repeated are replaced by a number
    in order of id and text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if not odd.limit(1).count():
        return rows.select(F.col("doc_id").alias("doc"), "doc_id", "text"), False
    return stash(rows.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text").select(F.monotonically_increasing_id().alias("doc"), "doc_id", "text")), True


def copies(texts: DataFrame) -> DataFrame:
    """(doc, start, count): all windows of ``texts`` (doc, text) that have an earlier copy, in runs."""
    anchors = texts.mapInArrow(_anchors, ANCHORS).repartition(F.col("gram")).sortWithinPartitions("gram")
    found = stash(anchors.mapInArrow(_buckets, FOUND))
    wanted = found.where("bucket")
    large = wanted.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("gram", F.ceil(F.col("n") / F.lit(LARGE)).cast("int").alias("salts")).checkpoint()
    wanted = join_small(wanted, large, "gram").withColumn("salts", F.coalesce("salts", F.lit(0)))
    asked = wanted.groupBy("doc").agg(F.collect_list(F.struct("gram", "start", "count", "salts")).alias("asked"))
    fetched = texts.join(asked, "doc").mapInArrow(_fetch, BYTES)

    def factored(rows: DataFrame) -> DataFrame:
        return rows.repartition(F.col("gram")).sortWithinPartitions("gram", "doc", "start").mapInArrow(_suffixes, LEFT)

    done = found.where("not bucket").select("doc", "start", "count")
    out = factored(fetched)
    if large.limit(1).count():
        out = stash(out)
        done = done.unionByName(factored(out.where("bytes is not null").mapInArrow(_windows, BYTES)).drop("bytes"))
    return done.unionByName(out.where("bytes is null").drop("bytes"))


def dedup(spark: SparkSession, docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``keep_text`` the bytes that are kept."""
    configure(spark)
    rows, renumbered = numbered(docs)
    texts = rows.select("doc", "text")
    spans = copies(texts).groupBy("doc").agg(F.collect_list(F.struct("start", "count")).alias("spans"))
    joined = texts.join(spans, "doc", "left")
    extra = [("kept", "binary")] if keep_text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans")
            raw, offsets = text_bytes(batch.column("text"))
            data = raw.tobytes()
            flat = spans.flatten()
            start, count = (np.asarray(flat.field(c)).astype(np.int64) for c in ("start", "count"))
            sizes = np.asarray(spans.value_lengths().fill_null(0))
            ends = np.cumsum(sizes)
            out = []
            for k in range(batch.num_rows):
                text, a, b = data[offsets[k] : offsets[k + 1]], int(ends[k] - sizes[k]), int(ends[k])
                found, kept = _kept(text, start[a:b], count[a:b]) if b > a else ([], text)
                out.append((len(text), len(text) - len(kept), len(found), hashlib.sha256(kept).hexdigest(), kept if keep_text else None))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            arrays = [batch.column("doc"), *(pa.array(x, t) for x, t in zip(columns, kinds, strict=False))]
            if keep_text:
                arrays, names = [*arrays, pa.array(columns[4], pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    out = joined.mapInArrow(run, with_fields(rows.select("doc"), ("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("kept_sha256", "string"), *extra))
    if renumbered:
        return out.join(rows.select("doc", "doc_id"), "doc").select("doc_id", *[c for c in out.columns if c != "doc"])
    return out.withColumnRenamed("doc", "doc_id")
