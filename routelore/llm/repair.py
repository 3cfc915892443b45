"""Repair of conversation structure at the least cost, as time-major dynamic programming over many conversations at once.

A conversation is its rows by turn (null turns first; rows of one turn by the MD5 digest of role and text). Its first fault marks a row:
blank (no character but white space), duplicate (role and text were seen earlier), truncated (the last character that is not
white space is none of ``.!?``). Roles count by their initials. Edits make the initials an optional s and then pairs ua, or nothing:
keep costs 0, rerole to user or assistant 2, delete 3 (the only edit of blank and duplicate rows), insert an empty user or
assistant turn 2; a truncated row that stays adds 1. Of equally cheap repairs the one whose edit initials are least in ASCII wins.

Two passes over rows dealt by conversation and sorted there. The first sees a digest, an initial and a fault a row: a task buckets the conversations it
meets by length, updates the costs of the four states of all conversations of a bucket turn by turn from the end, keeps them, and
traces the edits from the start, both vectorised over the conversations. The second streams the texts past the
edits and writes the repaired turns. So a task holds some ``BUFFER`` narrow rows or one conversation of them (about 100 bytes a turn
while it is traced), never its texts: one conversation may have any share of all rows, though its own rows do run
through one task in each pass, as the order of a conversation (and the digest over it) asks for.

Null roles and texts count as one space; a role without an initial among s, u, a can't be kept. Repeated rows are duplicates. Null
conversation ids are one conversation. An empty table gives an empty one. Further columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, run_starts

WHITE = "\t\n\x0b\x0c\r "
#: Narrow rows that a task gathers before it works out whole conversations, and cells of one bucket's matrix.
BUFFER = 65_536
CELLS = 1 << 20
START, OPENED, ASKED, ANSWERED = range(4)
#: What an inserted or reroled turn leads to from each state: user but after a user, whom the assistant answers.
NEXT = np.array([ASKED, ASKED, ANSWERED, ASKED])
FAR = 1 << 29
#: State after keeping a row of initial (other, s, u, a) in each state; -1: not allowed.
KEEP = np.array([[-1, -1, -1, -1], [OPENED, -1, -1, -1], [ASKED, ASKED, -1, ASKED], [-1, -1, ANSWERED, -1]])
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _backward(kind: np.ndarray, fault: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Costs to the end, [turn, conversation, state], of a bucket given time-major."""
    turns, many = kind.shape
    cost = np.empty((turns + 1, many, 4), np.int32)
    cost[turns] = [0, FAR, FAR, 0]
    _with_inserts(cost[turns])
    for t in range(turns - 1, -1, -1):
        after = cost[t + 1]
        late = (fault[t] == TRUNCATED)[:, None]
        bound = ((fault[t] == BLANK) | (fault[t] == DUPLICATE))[:, None]
        to = KEEP[kind[t]]
        kept = np.where(to < 0, FAR, np.take_along_axis(after, np.maximum(to, 0), 1))
        stay = np.minimum(kept, after[:, NEXT] + 2) + late
        now = np.minimum(after + 3, np.where(bound, FAR, stay))
        _with_inserts(now)
        cost[t] = np.where((t < lengths)[:, None], now, after)
    return cost


def _with_inserts(cost: np.ndarray) -> None:
    """Lower the costs of states from which inserted turns lead on more cheaply."""
    asked, answered = cost[:, ASKED].copy(), cost[:, ANSWERED].copy()
    cost[:, ASKED] = np.minimum(asked, answered + 2)
    cost[:, ANSWERED] = np.minimum(answered, asked + 2)
    for s in (START, OPENED):
        cost[:, s] = np.minimum(cost[:, s], cost[:, ASKED] + 2)


def _trace(cost: np.ndarray, kind: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Edit initials, [slot, conversation], zero where a slot is empty: two slots for inserts before each turn and one for its edit."""
    turns, many = kind.shape
    out = np.zeros((3 * turns + 2, many), np.uint8)
    every, state = np.arange(many), np.zeros(many, np.int64)
    for t in range(turns + 1):
        todo = (t < lengths) if t < turns else np.ones(many, bool)
        for slot in range(3 if t < turns else 2):
            best = cost[t, every, state]
            if t < turns:
                gone = todo & (cost[t + 1, every, state] + 3 == best)
                out[3 * t + slot, gone] = ord("D")
                todo &= ~gone
            added = todo & (cost[t, every, NEXT[state]] + 2 == best)
            out[3 * t + slot, added] = ord("I")
            state = np.where(added, NEXT[state], state)
            if t == turns:
                continue
            rest = todo & ~added
            to = KEEP[kind[t], state]
            # a kept row leads on at the same remaining cost, but for the fee of a truncated one, which a reroled one pays as well
            straight = np.where(to < 0, FAR, cost[t + 1, every, np.maximum(to, 0)])
            kept = rest & (straight <= cost[t + 1, every, NEXT[state]] + 2)
            changed = rest & ~kept
            out[3 * t + slot, kept], out[3 * t + slot, changed] = ord("K"), ord("R")
            state = np.where(kept, to, np.where(changed, NEXT[state], state))
            todo &= added
    return out


def edits(kind: np.ndarray, fault: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(least cost, edit initials) of conversations whose rows lie one behind the other, beginning at ``begins`` (the end included)."""
    sizes = np.diff(begins)
    costs, found = np.zeros(len(sizes), np.int64), [b""] * len(sizes)
    bucket = np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for width in np.unique(bucket[sizes > 0]):
        members = np.flatnonzero((bucket == width) & (sizes > 0))
        step = max(1, CELLS >> int(width))
        for some in (members[i : i + step] for i in range(0, len(members), step)):
            turns, lengths = int(sizes[some].max()), sizes[some]
            at = np.minimum(begins[some] + np.minimum(np.arange(turns)[:, None], lengths - 1), len(kind) - 1)
            cost = _backward(kind[at], fault[at], lengths)
            slots = _trace(cost, kind[at], lengths).T
            filled = slots != 0
            letters, ends = slots[filled].tobytes(), np.cumsum(filled.sum(1))
            costs[some] = cost[0, :, START]
            for k, a, b in zip(some, [0, *ends[:-1]], ends, strict=True):
                found[k] = letters[a:b]
    return costs, found


def _duplicates(conv: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Rows whose digest is that of an earlier row of their conversation."""
    order = np.lexsort((digest[:, 1], digest[:, 0], conv))
    same = (conv[order][1:] == conv[order][:-1]) & (digest[order][1:] == digest[order][:-1]).all(1)
    out = np.zeros(len(conv), bool)
    out[order[1:][same]] = True
    return out


def _reports(ids: pa.Array, begins: np.ndarray, rows: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each conversation: its counts, cost and edits."""
    many = len(begins) - 1
    conv = np.repeat(np.arange(many), np.diff(begins))
    held = rows["present"]
    conv, kind, fault, turn, known, digest = (x[held] for x in (conv, rows["kind"], rows["fault"], rows["turn"], rows["known"], rows["digest"]))
    fault = np.where((fault != BLANK) & _duplicates(conv, digest), DUPLICATE, fault)
    counts = {f: np.bincount(conv[fault == f], minlength=many) for f in (BLANK, DUPLICATE, TRUNCATED)}
    joined = conv[1:] == conv[:-1]
    legal = ((kind[:-1] == 1) & (kind[1:] == 2)) | ((kind[:-1] == 2) & (kind[1:] == 3)) | ((kind[:-1] == 3) & (kind[1:] == 2))
    illegal = np.bincount(conv[1:][joined & ~legal], minlength=many)
    by, of = turn[known], conv[known]  # sorted by turn
    first, last = np.searchsorted(of, np.arange(many)), np.searchsorted(of, np.arange(many), "right")
    some = last > first
    changes = np.bincount(of[1:][(of[1:] == of[:-1]) & (by[1:] != by[:-1])], minlength=many)
    gaps = np.zeros(many, np.int64)
    gaps[some] = by[last[some] - 1] - by[first[some]] - changes[some]
    cost, audit = edits(kind, fault, np.searchsorted(conv, np.arange(many + 1)))
    values = np.stack([gaps, counts[BLANK], counts[DUPLICATE], counts[TRUNCATED], illegal, cost], 1)
    return pa.RecordBatch.from_arrays([ids, pa.array(values.tolist(), pa.list_(pa.int64())), pa.array([a.decode() for a in audit], pa.string())], names=["conv_id", "counts", "audit"])


def _report_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Works out whole conversations as soon as enough rows have come by; the last one waits for its end."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def whole(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal waiting, size
        table = pa.Table.from_batches(waiting).combine_chunks()
        batch = table.to_batches()[0]
        begins = np.append(run_starts(batch.column("conv_id")), batch.num_rows)
        if not last:
            if len(begins) < 3:  # one conversation, still going on
                waiting = [batch]
                return
            begins = begins[:-1]
        end = int(begins[-1])
        done, waiting = batch.slice(0, end), [batch.slice(end)] if end < batch.num_rows else []
        size = sum(b.num_rows for b in waiting)
        rows = {c: done.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "fault", "present")}
        rows["known"] = done.column("turn").is_valid().to_numpy(zero_copy_only=False)
        rows["turn"] = done.column("turn").fill_null(0).to_numpy(zero_copy_only=False)
        rows["digest"] = np.frombuffer(b"".join(done.column("digest").to_pylist()), np.uint64).reshape(-1, 2)
        yield _reports(done.column("conv_id").take(pa.array(begins[:-1])), begins, rows)

    limit = BUFFER
    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
            size += batch.num_rows
        if size >= limit:
            yield from whole(False)
            limit = max(BUFFER, 2 * size)  # a conversation that goes on is looked at again when it has doubled
    if waiting:
        yield from whole(True)


def _marked(turns: DataFrame, present: Column) -> DataFrame:
    """The rows with what the edits depend on; rows that are not present only name their conversation."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), present.alias("present"))
    bare = F.rtrim("text", F.lit(WHITE))
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("*", kind.cast("int").alias("kind"), fault.cast("int").alias("fault"), digest.alias("digest"))


def report(spark: SparkSession, turns: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, counts, audit): a row for each conversation; ``counts`` are ``COUNTS`` in order."""
    configure(spark)
    rows = _marked(turns, F.lit(True) if present is None else present).select("conv_id", "turn", "digest", "kind", "fault", "present")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest")
    return dealt.mapInArrow(_report_rows, f"conv_id {dict(rows.dtypes)['conv_id']}, counts array<long>, audit string")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads each conversation's report and then its rows; writes the report at position 0 and the repaired turns behind it."""
    conv, audit, at, behind, state, place = None, "", 0, 0, START, 0
    names = ["conv_id", "position", "edit", "role", "text", "counts"]
    schema = None

    def turn(edit: str, role: str, text: str) -> tuple:
        nonlocal state, place
        place += 1
        if edit == "K":
            state = int(KEEP[{"s": 1, "u": 2, "a": 3}[role[0]], state])
        else:
            state = int(NEXT[state])
            role = "user" if state == ASKED else "assistant"
        return (conv, place, edit, role, text, None)

    for batch in batches:
        if schema is None:
            schema = pa.schema([pa.field("conv_id", batch.schema.field("conv_id").type), ("position", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), ("counts", pa.list_(pa.int64()))])
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "counts", "role", "text")), strict=True):
            if row[1] is not None:
                conv, audit, at, state, place = row[0], row[3], 0, START, 0
                behind = len(audit.rstrip("I"))  # turns from here on are inserted behind the last row
                out.append((conv, 0, audit, None, None, row[1]))
            else:
                while audit[at] == "I":
                    out.append(turn("I", "", ""))
                    at += 1
                if audit[at] != "D":
                    out.append(turn(audit[at], row[2], row[3]))
                at += 1
            if at == behind:
                out.extend(turn("I", "", "") for _ in audit[behind:])
        columns = [list(c) for c in zip(*out, strict=True)] or [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _replayed(spark: SparkSession, turns: DataFrame, present: Column | None) -> DataFrame:
    """Reports (position 0) and repaired turns, dealt by conversation and in order there."""
    held = F.lit(True) if present is None else present
    heads = report(spark, turns, present).select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), F.lit(b"").alias("digest"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), "counts")
    rows = _marked(turns, held).where("present").select("conv_id", F.lit(1).alias("place"), F.col("turn").cast("long"), "digest", "role", "text", F.lit(None).cast("array<long>").alias("counts"))
    dealt = heads.unionByName(rows).repartition("conv_id").sortWithinPartitions("conv_id", "place", "turn", "digest")
    return dealt.select("conv_id", "counts", "role", "text").mapInArrow(_replay, f"conv_id {dict(rows.dtypes)['conv_id']}, position long, edit string, role string, text string, counts array<long>")


def repair(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of the repaired conversations, counted from 1, each with the edit that made it (K, R or I).

    ``turns`` has the columns conv_id, turn, role and text."""
    return _replayed(spark, turns, None).where("position > 0").drop("counts")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes each conversation's ``role:text`` lines as they pass."""
    head, digest = None, None

    def packed(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        kinds = [kind, pa.list_(pa.int64()), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["conv_id", "counts", "audit", "repaired_sha256"])

    kind = pa.int64()
    for batch in batches:
        kind, out = batch.schema.field("conv_id").type, []
        for conv, place, edit, role, text, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if place:
                digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                continue
            if head:
                out.append((*head, digest.hexdigest()))
            head, digest = (conv, counts, edit), hashlib.sha256()
        yield packed(out, kind)
    if head:
        yield packed([(*head, digest.hexdigest())], kind)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with the faults that the CRC-32 of conversation and turn asks for, and ``present``, false where a row was dropped."""
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(key) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("fate") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fate") != 0).alias("present"), copies.alias("copy")).drop("copy")


def repair_query(spark: SparkSession, turns: DataFrame) -> DataFrame:
    """Every conversation's counts, cost, edits and the digest of its repair, after damage."""
    rows = damaged(turns)
    found = _replayed(spark, rows, F.col("present"))
    out = found.mapInArrow(_digests, f"conv_id {dict(rows.dtypes)['conv_id']}, counts array<long>, audit string, repaired_sha256 string")
    return out.select("conv_id", *[F.col("counts")[i].alias(c) for i, c in enumerate(COUNTS)], "audit", "repaired_sha256")
