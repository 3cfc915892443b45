"""Evaluation reports over scored rows.

A scored row has ord, expected, predicted (null where the output is invalid), category (null where valid) and
arguments_ok (whether the arguments equal the gold ones). Every rate has all gold rows as its denominator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routelore.functions.text import rate, same_rate
from routelore.operators.dataset import zero_filled

#: Categories of invalid output, in report order.
CATEGORIES = ["missing_function_call", "malformed_function_call", "invalid_argument_syntax", "unknown_route", "invalid_arguments"]
THRESHOLDS = ["valid_decision_rate", "route_accuracy", "argument_accuracy"]
RATES = {"valid_decision_rate": "valid_decisions", "route_accuracy": "route_correct", "argument_accuracy": "argument_correct"}


def valid() -> Column:
    return F.col("category").isNull() & F.col("predicted").isNotNull()


def route_correct() -> Column:
    return valid() & (F.col("expected") == F.col("predicted"))


def argument_correct() -> Column:
    return route_correct() & F.col("arguments_ok")


def metrics(scored: DataFrame) -> DataFrame:
    found = scored.agg(F.count("*").alias("examples"), F.count_if(valid()).alias("valid_decisions"), F.count_if(route_correct()).alias("route_correct"), F.count_if(argument_correct()).alias("argument_correct"))
    return found.select("*", *[rate(F.col(n), F.col("examples")).alias(r) for r, n in RATES.items()])


def route_metrics(scored: DataFrame, routes: DataFrame) -> DataFrame:
    """Support, predictions, true positives, precision and recall of every registered route (null where undefined).

    One pass: each row votes for its expected and its predicted route, and votes are summed by route."""
    hit = F.when(route_correct(), 1).otherwise(0)
    votes = F.array(
        F.struct(F.col("expected").alias("route"), F.lit(1).alias("support"), F.lit(0).alias("predictions"), hit.alias("true_positives")),
        F.struct(F.when(valid(), F.col("predicted")).alias("route"), F.lit(0).alias("support"), F.lit(1).alias("predictions"), F.lit(0).alias("true_positives")),
    )
    counted = scored.select(F.explode(votes).alias("v")).select("v.*").where("route is not null").groupBy("route").agg(*[F.sum(c).alias(c) for c in ("support", "predictions", "true_positives")])
    out = zero_filled(counted, routes, "route", ["support", "predictions", "true_positives"])
    return out.select("pos", "name", "support", "predictions", "true_positives", rate(F.col("true_positives"), F.col("predictions")).alias("precision"), rate(F.col("true_positives"), F.col("support")).alias("recall"))


def confusion(scored: DataFrame) -> DataFrame:
    """(expected, predicted, n) of valid outputs."""
    return scored.where(valid()).groupBy("expected", "predicted").agg(F.count("*").alias("n"))


def confusion_maps(scored: DataFrame, routes: DataFrame) -> DataFrame:
    """Every registered route with its map of predictions, empty where it has none."""
    maps = confusion(scored).groupBy("expected").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("predicted", "n")))).alias("predicted"))
    known = routes.select("pos", F.col("name").alias("expected"))
    return known.join(maps, "expected", "left").select("pos", "expected", F.coalesce("predicted", F.create_map().cast("map<string,bigint>")).alias("predicted"))


def invalid_counts(scored: DataFrame) -> DataFrame:
    """All categories in report order, zero where none."""
    spark = scored.sparkSession
    names = spark.createDataFrame(list(enumerate(CATEGORIES)), "pos int, category string")
    found = scored.where("category is not null").groupBy("category").agg(F.count("*").alias("n"))
    return names.join(found, "category", "left").select("pos", "category", F.coalesce("n", F.lit(0)).alias("count"))


def representatives(scored: DataFrame, redact: bool = False, shown: list[str] | None = None) -> DataFrame:
    """The first failure in input order of every (expected, predicted, category); a right route with wrong arguments is one.

    The first is found by a partial aggregate, so a signature with most of the rows is no hot group."""
    shown = shown or []
    sign = ["expected", "predicted", "category"]
    failed = scored.where(~F.coalesce(argument_correct(), F.lit(False))).withColumn("predicted", F.when(valid(), F.col("predicted")))
    first = failed.groupBy(*sign).agg(F.min_by(F.struct("ord", *shown), "ord").alias("row"))
    out = first.select(*sign, "row.*")
    return out.withColumns({c: F.lit(None).cast(out.schema[c].dataType) for c in shown}) if redact else out


def gates(report: DataFrame, minimums: dict[str, float]) -> DataFrame:
    """(name, minimum, actual, passed, all_passed) of the three thresholds; equality passes."""
    rows = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(n).alias("name"), F.lit(float(minimums[n])).alias("minimum"), F.col(n).alias("actual"), (F.col(n) >= F.lit(float(minimums[n]))).alias("passed")) for i, n in enumerate(THRESHOLDS)])
    out = report.select(rows.alias("r")).withColumn("all_passed", F.forall("r", lambda x: x["passed"]))
    return out.select(F.explode("r").alias("x"), "all_passed").select("x.*", "all_passed")


def comparison(parent: DataFrame, child: DataFrame, max_route_drop: float = 0.0, max_argument_drop: float = 0.0, parent_passed: bool = True, child_passed: bool = True) -> DataFrame:
    """One row: accuracy drops from parent to child, and whether both passed and no drop exceeds its limit."""
    p = parent.select(F.col("route_accuracy").alias("pr"), F.col("argument_accuracy").alias("pa"))
    both = p.join(F.broadcast(child.select(F.col("route_accuracy").alias("cr"), F.col("argument_accuracy").alias("ca"))), how="cross")  # two one-row reports
    drops = both.select((F.col("pr") - F.col("cr")).alias("route_drop"), (F.col("pa") - F.col("ca")).alias("argument_drop"))
    ok = F.lit(parent_passed and child_passed) & (F.col("route_drop") <= max_route_drop) & (F.col("argument_drop") <= max_argument_drop)
    return drops.withColumn("passed", ok)


def added_recall(routes_report: DataFrame, added: list[str]) -> DataFrame:
    """One row: recall is exactly 1 for every added route (an undefined one fails)."""
    return routes_report.where(F.col("name").isin(added)).agg(((F.count("*") == len(added)) & F.coalesce(F.every(F.col("recall").eqNullSafe(F.lit(1.0))), F.lit(not added))).alias("passed"))


def reconcile(report: DataFrame, matrix: DataFrame, invalid: DataFrame) -> DataFrame:
    """One row of booleans: the tables of a report agree with its metrics."""
    m = matrix.agg(F.sum("n").alias("valid"), F.sum(F.when(F.col("expected") == F.col("predicted"), F.col("n")).otherwise(0)).alias("diagonal"))
    i = invalid.agg(F.sum("count").alias("invalid"))
    one = report.join(F.broadcast(m), how="cross").join(F.broadcast(i), how="cross")  # one-row tables
    zero = lambda c: F.coalesce(c, F.lit(0))
    return one.select(
        (zero("valid") == F.col("valid_decisions")).alias("confusion_total"), (zero("diagonal") == F.col("route_correct")).alias("confusion_diagonal"),
        (zero("invalid") == F.col("examples") - F.col("valid_decisions")).alias("invalid_total"), same_rate(F.col("route_accuracy"), F.col("route_correct") / F.col("examples")).alias("rate"),
    )


def align(examples: DataFrame, completions: DataFrame) -> DataFrame:
    """Examples with their completions by position; differing counts are an error."""
    n, m = examples.count(), completions.count()
    if not n or n != m:
        raise ValueError(f"{n} examples and {m} completions")
    return examples.join(completions, "ord")

