"""Scalar text functions of the curation pipeline, as Column expressions where Spark can say them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routelore.functions.batches import bounded

#: Characters that begin a spreadsheet formula, and the shapes of timestamps.
CSV_FORMULA = r"^[=+\-@\t\r\n]"
RFC_3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
RFC_3339_UTC = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"


def strip(text: Column) -> Column:
    """Without leading and trailing white space as Python's str.strip sees it, in Java's syntax."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return text.isNull() | (strip(text) == "")


def normalize_text(text: str) -> str:
    return " ".join(unicodedata.normalize("NFKC", text).casefold().split())


@F.pandas_udf(T.StringType())
def _normalize(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in texts:
        yield series.map(normalize_text, na_action="ignore")


def normalize(text: Column | str) -> Column:
    """NFKC, case folding and space folding: the text that counts as equal for leakage."""
    bounded(SparkSession.active())
    return _normalize(text)


def java_replacement(template: str) -> str:
    """A Python replacement template in Java's syntax: ``\\1`` and ``\\g<name>`` are references, ``$`` is itself."""
    escaped = template.replace("$", r"\$")
    escaped = re.sub(r"\\g<(\d+)>|\\(\d)", lambda m: f"${m[1] or m[2]}", escaped)
    return re.sub(r"\\g<([A-Za-z]\w*)>", r"${\1}", escaped)


def redact(text: Column, rules: list[tuple[str, str]]) -> Column:
    """(pattern, Python replacement template) rules, each applied to what the rules before it left."""
    for pattern, template in rules:
        text = F.regexp_replace(text, pattern, java_replacement(template))
    return text


def within_bytes(text: Column, limit: int) -> Column:
    """UTF-8 size, limit included."""
    return F.octet_length(text) <= F.lit(limit)


def csv_cell(cell: Column) -> Column:
    """A leading quote keeps a spreadsheet from taking the cell for a formula."""
    return F.when(cell.rlike(CSV_FORMULA), F.concat(F.lit("'"), cell)).otherwise(cell)


def row_sha256(line: Column) -> Column:
    """Digest of a line with its line feed."""
    return F.sha2(F.concat(line, F.lit("\n")), 256)


def valid_timestamp(text: Column, utc_only: bool = False) -> Column:
    return F.coalesce(text.rlike(RFC_3339_UTC if utc_only else RFC_3339) & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def timestamp_text(ts: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def valid_endpoint(url: Column) -> Column:
    """http or https with a host, and without user, query or fragment."""
    part = lambda name: F.try_parse_url(url, F.lit(name))
    return F.coalesce(part("PROTOCOL").isin("http", "https") & (part("HOST") != "") & part("USERINFO").isNull() & part("QUERY").isNull() & part("REF").isNull(), F.lit(False))


def rate(n: Column, of: Column, empty: float | None = None) -> Column:
    """n / of, and ``empty`` where of is zero."""
    found = F.try_divide(n.cast("double"), of.cast("double"))
    return found if empty is None else F.coalesce(found, F.lit(empty))


def same_rate(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-12)
