"""Route registries and the validation of decisions against them."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_DDL = "pos int, name string, description string, properties map<string,string>, required array<string>"
PRIMITIVES = ("string", "integer", "number", "boolean")
#: A registry is a small dimension table; its size is checked when it is made, so it may be broadcast.
MAX_ROUTES = 100_000
ARGUMENTS_DDL = "map<string,struct<kind:string,text:string>>"


@dataclass(frozen=True)
class Route:
    name: str
    description: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError("a route needs a name")
        if any(not p for p in self.properties) or any(k not in PRIMITIVES for k in self.properties.values()):
            raise ValueError(f"properties of {self.name!r} must be named primitives")
        if len(set(self.required)) != len(self.required) or not set(self.required) <= set(self.properties):
            raise ValueError(f"required arguments of {self.name!r} must be distinct properties")


def registry(spark: SparkSession, routes: Iterable[Route]) -> DataFrame:
    """The ordered registry: at least one route, names distinct."""
    routes = list(routes)
    names = [r.name for r in routes]
    if not routes or len(set(names)) != len(names):
        raise ValueError("a registry has one route at least, and distinct names")
    if len(routes) > MAX_ROUTES:
        raise ValueError(f"a registry has at most {MAX_ROUTES} routes")
    out = spark.createDataFrame([(i, r.name, r.description, dict(r.properties), list(r.required)) for i, r in enumerate(routes)], REGISTRY_DDL)
    out._routes = len(routes)  # so that it need not be counted again
    return out


def small(routes: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``routes``, or ``of`` that was selected from it, to be broadcast: a registry of any other making is counted first."""
    if getattr(routes, "_routes", None) is None:
        n = routes.limit(MAX_ROUTES + 1).count()
        if n > MAX_ROUTES:
            raise ValueError(f"a registry has at most {MAX_ROUTES} routes")
        routes._routes = n
    return F.broadcast(routes if of is None else of)


def names_registry(spark: SparkSession, names: list[str]) -> DataFrame:
    return registry(spark, [Route(n) for n in names])


def _matches(kind: Column, wanted: Column) -> Column:
    return (kind == wanted) | ((wanted == "number") & (kind == "integer"))


def argument_errors(arguments: Column, properties: Column, required: Column) -> Column:
    """All errors in order: missing (declared order), unknown, wrong primitive (both in argument order)."""
    given = F.map_keys(arguments)
    missing = F.transform(F.array_except(required, given), lambda n: F.concat(F.lit("missing required argument "), n))
    unknown = F.transform(F.filter(given, lambda n: ~F.map_contains_key(properties, n)), lambda n: F.concat(F.lit("unknown argument "), n))
    entries = F.filter(F.map_entries(arguments), lambda e: F.map_contains_key(properties, e["key"]) & ~_matches(e["value"]["kind"], F.element_at(properties, e["key"])))
    wrong = F.transform(entries, lambda e: F.concat(F.lit("argument "), e["key"], F.lit(" must be "), F.element_at(properties, e["key"]), F.lit(", not "), e["value"]["kind"]))
    return F.concat(missing, unknown, wrong)


def argument_corrections(arguments: Column, properties: Column, required: Column) -> Column:
    """What to change, in the same order as the errors: add, remove, set."""
    given = F.map_keys(arguments)
    add = F.transform(F.array_except(required, given), lambda n: F.concat(F.lit("add "), n))
    remove = F.transform(F.filter(given, lambda n: ~F.map_contains_key(properties, n)), lambda n: F.concat(F.lit("remove "), n))
    entries = F.filter(F.map_entries(arguments), lambda e: F.map_contains_key(properties, e["key"]) & ~_matches(e["value"]["kind"], F.element_at(properties, e["key"])))
    return F.concat(add, remove, F.transform(entries, lambda e: F.concat(F.lit("set "), e["key"], F.lit(" to a "), F.element_at(properties, e["key"]))))


def validate_decisions(rows: DataFrame, routes: DataFrame, route: str = "route", arguments: str = "arguments") -> DataFrame:
    """``rows`` with category (null, unknown_route or invalid_arguments), errors and corrections."""
    known = routes.select(F.col("name").alias("__name"), F.col("properties").alias("__properties"), F.col("required").alias("__required"))
    joined = rows.join(small(routes, known), F.col(route) == F.col("__name"), "left")
    found = joined.withColumn("errors", F.when(F.col("__name").isNotNull(), argument_errors(F.col(arguments), F.col("__properties"), F.col("__required"))))
    found = found.withColumn("corrections", F.when(F.col("__name").isNotNull(), argument_corrections(F.col(arguments), F.col("__properties"), F.col("__required"))))
    category = F.when(F.col("__name").isNull(), "unknown_route").when(F.size("errors") > 0, "invalid_arguments")
    return found.withColumn("category", category).withColumn("detail", F.concat_ws("; ", "errors")).drop("__name", "__properties", "__required")


def candidate_validation(status: Column, category: Column) -> Column:
    """Local validation of a candidate: a rejected one is the provider's, else the decision's category."""
    return F.when(status == "rejected", "provider_rejected").otherwise(category)


def registry_change(parent: DataFrame, child: DataFrame) -> DataFrame:
    """(pos, old, new, state): the parent must be an exact ordered prefix of the child; state is retained, added or changed."""
    p = parent.select("pos", F.col("name").alias("old"), F.struct("description", F.array_sort(F.map_entries("properties")).alias("p"), "required").alias("ps"))
    c = child.select("pos", F.col("name").alias("new"), F.struct("description", F.array_sort(F.map_entries("properties")).alias("p"), "required").alias("cs"))
    state = F.when(F.col("old").isNull(), "added").when(F.col("old").eqNullSafe(F.col("new")) & F.col("ps").eqNullSafe(F.col("cs")), "retained").otherwise("changed")
    return p.join(c, "pos", "full_outer").select("pos", "old", "new", state.alias("state"))


def arguments_equal(a: Column, b: Column) -> Column:
    """Equality of argument maps whatever their order; numbers are equal by value, integer or not."""
    def canonical(m: Column) -> Column:
        return F.array_sort(F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("k"), F.when(e["value"]["kind"].isin("integer", "number"), "number").otherwise(e["value"]["kind"]).alias("t"), F.when(e["value"]["kind"].isin("integer", "number"), F.regexp_replace(e["value"]["text"], r"\.0+$", "")).otherwise(e["value"]["text"]).alias("v"))))
    return canonical(a) == canonical(b)
