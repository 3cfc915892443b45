"""Secret scans with corpus-wide ownership frequency.

Scan. Each whole text is searched for base candidates of three kinds (assign, access, hex) and for further ones:
well-known credential formats, private key blocks and long random-looking tokens. Spans are code points, end exclusive.

Ownership. The digests of all candidate values are aggregated over the corpus: in how many distinct
repositories and from how many distinct owners does a value come? A value that more than ``MAX_OWNERS`` owners
share, or that is in more than ``MAX_REPOSITORIES`` repositories, is a widely copied example; any other looks live: it is specific to its
owner. Nothing but these counts decides: a value that holds a word such as ``example`` is only flagged, as a real secret may hold it too.

Result. Base spans are always reported. The further spans are reported when their value looks live. ``live`` and ``copied``
list the spans of either verdict, base ones too, n_live and n_copied count them, and ``flagged`` lists those with a placeholder word. Null
texts are empty, texts of any length are scanned whole, equal starts are listed by kind, an empty table gives an empty one. Rows with equal id and
text get equal results. The aggregation is by (value, repository, owner) first, so copies of one secret are combined before the shuffle;
the verdicts go back to the candidates by a join in which values of more than ``HOT`` candidates, as counted, are dealt over salts.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import configure, join_small, named, with_fields

#: Most distinct owners of a value that still counts as owner-specific.
MAX_OWNERS = 2
#: Most distinct repositories of such a value.
MAX_REPOSITORIES = 4
#: Candidates of a value under one salt.
HOT = 10_000

#: Base kinds, in the order in which equal starts are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Public formats of credentials.
FORMATS = {
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "gitlab": r"glpat-[A-Za-z0-9_-]{20,}",
    "google": r"AIza[A-Za-z0-9_-]{35}",
    "jwt": r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
    "pem": r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "stripe": r"[rs]k_live_[A-Za-z0-9]{16,}",
}
FORMAT = re.compile("|".join(f"(?P<{k}>{v})" for k, v in FORMATS.items()))
#: Whole runs of any length; those that hold a digit are judged by their entropy.
LONG = re.compile(r"[A-Za-z0-9+/_-]{24,}")
DIGIT = re.compile(r"[0-9]")
MIN_ENTROPY = 3.6
KINDS = ["assign", "access", "hex", *FORMATS, "random"]
RANK = {k: i for i, k in enumerate(KINDS)}
#: Words that flag a value beside its verdict.
PLACEHOLDER = re.compile(r"example|sample|dummy|test|your|changeme|placeholder|xxxx|1234567", re.IGNORECASE)

CANDIDATE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("value_key", pa.binary()), ("placeholder", pa.bool_())])
CANDIDATE_DDL = "array<struct<kind:string,start:bigint,stop:bigint,value_key:binary,placeholder:boolean>>"
#: Bytes of the digests that stand for values and texts while they are shuffled.
KEY = 16


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


class Taken:
    """Spans joined into disjoint ones, to look up if a place is free."""

    def __init__(self, spans: list[tuple[str, int, int, str]]) -> None:
        self.starts, self.stops = [], []
        for start, stop in sorted((s, e) for _, s, e, _ in spans):
            if self.stops and start < self.stops[-1]:
                self.stops[-1] = max(self.stops[-1], stop)
            else:
                self.starts.append(start)
                self.stops.append(stop)

    def free(self, start: int, stop: int) -> bool:
        k = bisect_left(self.starts, stop)  # the last span that begins before stop
        return k == 0 or self.stops[k - 1] <= start


def scan(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, stop, value) of all candidates of a text, base kinds and further ones."""
    found = [("assign", m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    taken = Taken(found)
    further = [x for m in FORMAT.finditer(text) if taken.free(*(x := (m.lastgroup, m.start(), m.end(), m[0]))[1:3])]
    taken = Taken(found + further)
    further += [("random", m.start(), m.end(), m[0]) for m in LONG.finditer(text) if DIGIT.search(m[0]) and taken.free(m.start(), m.end()) and entropy(m[0]) >= MIN_ENTROPY]
    return sorted(found + further, key=lambda x: (x[1], RANK[x[0]]))


def _key(value: str) -> bytes:
    return hashlib.sha256(value.encode()).digest()[:KEY]


def candidates(spark: SparkSession, df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with the column candidates and the text's digest as row_key."""
    configure(spark)
    keep = [c for c in df.columns if c != text]
    schema = with_fields(df.select(*named(keep)), ("candidates", CANDIDATE_DDL), ("row_key", "binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            rows = [[{"kind": k, "start": s, "stop": e, "value_key": _key(v), "placeholder": bool(PLACEHOLDER.search(v))} for k, s, e, v in scan(t)] for t in texts]
            keys = [_key(t) if r else b"" for t, r in zip(texts, rows, strict=True)]  # texts without candidates are not joined
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(rows, pa.list_(CANDIDATE)), pa.array(keys, pa.binary())], names=[*keep, "candidates", "row_key"])

    return df.mapInArrow(run, schema)


def ownership(found: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """value_key, repositories, owners: distinct counts over the whole corpus."""
    each = found.select(F.explode("candidates").alias("c"), repository.alias("repository"), owner.alias("owner")).select("c.value_key", "repository", "owner")
    return each.distinct().groupBy("value_key").agg(F.count_distinct("repository").alias("repositories"), F.count_distinct("owner").alias("owners"))


def _spans(array: str) -> Column:
    return F.concat_ws(",", F.transform(F.col(array), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))))


def scan_secrets(spark: SparkSession, docs: DataFrame, repository: Column, owner: Column, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, live, copied, flagged.

    ``docs`` has doc_id and text, and what ``repository`` and ``owner`` read."""
    rows = docs.select("doc_id", repository.alias("repository"), owner.alias("owner"), "text")
    found = candidates(spark, rows).checkpoint()
    each = found.where(F.size("candidates") > 0).select("doc_id", "row_key", F.explode("candidates").alias("c")).select("doc_id", "row_key", "c.*").distinct()
    hot = each.groupBy("value_key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("value_key", F.ceil(F.col("n") / F.lit(HOT)).cast("int").alias("salts")).checkpoint()
    salts = F.coalesce("salts", F.lit(1))
    owners = join_small(ownership(found, F.col("repository"), F.col("owner")), hot, "value_key").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    each = join_small(each, hot, "value_key").withColumn("salt", F.pmod(F.xxhash64("doc_id", "row_key", "start"), salts).cast("int")).drop("salts")
    each = each.join(owners, ["value_key", "salt"])
    is_base = F.col("kind").isin("assign", "access", "hex")
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    spans_where = lambda c: F.array_sort(F.collect_list(F.when(c, F.struct("start", rank.alias("rank"), "kind", "stop"))))
    per_doc = each.groupBy("doc_id", "row_key").agg(spans_where(is_base | live).alias("shown"), spans_where(live).alias("live"), spans_where(~live).alias("copied"), spans_where(F.col("placeholder")).alias("flagged"))
    per_doc = per_doc.select(
        F.col("doc_id").alias("id"), F.col("row_key").alias("key"), _spans("shown").alias("spans"), F.size("live").alias("n_live"), F.size("copied").alias("n_copied"),
        _spans("live").alias("live"), _spans("copied").alias("copied"), _spans("flagged").alias("flagged"),
    )
    base = F.filter("candidates", lambda c: c["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("candidates", lambda c: c["kind"] == kind)).cast("long")
    all_rows = found.withColumn("base", base).select(
        "doc_id", "row_key", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"), F.sha2(_spans("base"), 256).alias("base_sha256"),
    )
    with_any, without = all_rows.where("row_key <> X''"), all_rows.where("row_key = X''")
    joined = with_any.join(per_doc, with_any["doc_id"].eqNullSafe(per_doc["id"]) & (with_any["row_key"] == per_doc["key"]), "left")
    joined = joined.unionByName(without, allowMissingColumns=True)
    text_of = lambda c: F.coalesce(c, F.lit("")).alias(c)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text_of("spans"), zero("n_live"), zero("n_copied"), text_of("live"), text_of("copied"), text_of("flagged"))


def secrets_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The corpus names no owners apart from its sources: the source is the owner, its part in a language the repository."""
    return scan_secrets(spark, docs, F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))), F.coalesce("source", F.lit("")))
