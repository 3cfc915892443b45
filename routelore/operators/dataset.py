"""Dataset identity, leakage, coverage, distribution and separation. Violations are rows, not exceptions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelore.functions.text import blank
from routelore.operators.registry import small

PARTITIONS = ["train", "validation", "test"]
#: Parts whose coverage may be asked for.
MAX_PARTS = 10_000


class DatasetError(ValueError):
    """The first violation of a dataset, raised at the edge of the API."""


def zero_filled(counts: DataFrame, routes: DataFrame, on: str, values: list[str]) -> DataFrame:
    """Every registered route with its counts (at most a row a route), zero where it has none."""
    known = routes.select("pos", F.col("name").alias("__name"))
    joined = known.join(counts, F.col("__name") == F.col(on), "left")
    return joined.select("pos", F.col("__name").alias("name"), *[F.coalesce(F.col(v), F.lit(0)).cast("long").alias(v) for v in values])


def distribution(examples: DataFrame, routes: DataFrame, part: str = "part", route: str = "route") -> DataFrame:
    """pos, name, total and a count for each partition, for every registered route."""
    counts = examples.groupBy(F.col(route).alias("__route")).agg(F.count("*").alias("total"), *[F.count_if(F.col(part) == p).alias(p) for p in PARTITIONS])
    return zero_filled(counts, routes, "__route", ["total", *PARTITIONS])


def coverage_gaps(examples: DataFrame, routes: DataFrame, parts: DataFrame, part: str = "part", route: str = "route") -> DataFrame:
    """(part, route) that no example covers: one row for each of at most MAX_PARTS parts and each route is looked up."""
    parts = parts.select(F.col(part)).distinct()
    if parts.limit(MAX_PARTS + 1).count() > MAX_PARTS:
        raise ValueError(f"more than {MAX_PARTS} parts")
    want = parts.join(small(routes, routes.select("pos", F.col("name").alias(route))), how="cross")
    have = examples.groupBy(part, route).agg(F.count("*").alias("n"))
    return want.join(have, [part, route], "left").where(F.coalesce("n", F.lit(0)) == 0).select(part, "pos", route)


def too_small_groups(examples: DataFrame, routes: DataFrame, least: int = 3, route: str = "route") -> DataFrame:
    """Registered routes with fewer rows than a split needs."""
    counts = examples.groupBy(F.col(route).alias("__route")).agg(F.count("*").alias("n"))
    return zero_filled(counts, routes, "__route", ["n"]).where(F.col("n") < least)


def first_declared(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Rows that repeat a key (nulls don't), with the place where it was first declared.

    The first place is a partial aggregate joined back, so a hot key is combined before the shuffle and the join can be
    split; no window holds a whole key."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    place = F.struct(*order)
    first = rows.where(present).groupBy(*key).agg(F.min(place).alias("first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    return rows.join(first, key).where(place > F.col("first"))


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys declared more than once: how often, beyond the first."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def validate(examples: DataFrame, normalized: Column, routes: DataFrame | None = None) -> DataFrame:
    """Violations of rows with part_pos, source, line, id and input, first one first.

    Of a row, a blank id comes before a repeated one, and this before a repeated normalized input. With routes, uncovered
    (partition, route) pairs follow in partition-major order (rows need part and route too)."""
    rows = examples.withColumn("normalized", normalized)
    bad_id = rows.where(blank(F.col("id"))).select("part_pos", "line", F.lit(0).alias("rank"), "source", F.lit("id").alias("path"), F.lit("id must be a non-blank string").alias("message"), F.lit("give the row an id").alias("correction"))
    good = rows.where(~blank(F.col("id")))
    place = lambda what: F.concat(F.lit(f"duplicate {what}; first declared at "), F.col("first.source"), F.lit(":"), F.col("first.line").cast("string"))
    order = ["part_pos", "line", "source"]
    by_id = first_declared(good, ["id"], order).select("part_pos", "line", F.lit(1).alias("rank"), "source", F.lit("id").alias("path"), place("id").alias("message"), F.lit("use a distinct id").alias("correction"))
    by_text = first_declared(good, ["normalized"], order).select("part_pos", "line", F.lit(2).alias("rank"), "source", F.lit("input").alias("path"), place("normalized input").alias("message"), F.lit("remove or change the input").alias("correction"))
    found = bad_id.unionByName(by_id).unionByName(by_text)
    if routes is not None:
        parts = examples.groupBy("part_pos", "part").agg(F.min("source").alias("source"))
        gaps = coverage_gaps(examples, routes, parts).join(parts, "part")
        found = found.unionByName(gaps.select((F.lit(1_000_000) + F.col("part_pos")).cast("int").alias("part_pos"), F.col("pos").cast("long").alias("line"), F.lit(3).alias("rank"), "source", F.lit("route").alias("path"), F.concat(F.lit("no example of route "), "route").alias("message"), F.lit("add an example").alias("correction")))
    return found.orderBy("part_pos", "line", "rank")


def require_valid(violations: DataFrame) -> None:
    """Raise the first violation, if there is any."""
    first = violations.limit(1).collect()
    if first:
        v = first[0]
        raise DatasetError(f"{v['source']}:{v['line']}: {v['path']}: {v['message']} ({v['correction']})")


def separation(regression: DataFrame, children: DataFrame, normalized: str = "normalized", id_: str = "id") -> DataFrame:
    """Replay rows that share an id or a normalized input with any child row."""
    by_id = regression.join(children.select(id_), id_, "left_semi").select(id_, F.lit("id").alias("reason"))
    by_text = regression.join(children.select(normalized), normalized, "left_semi").select(id_, F.lit("input").alias("reason"))
    return by_id.unionByName(by_text)
