"""The register side: which rows count, and organisations rolled up by normalised name.

A rolled-up column keeps first-seen order, so every row carries a position (`pos`), and the
collected structs are sorted by it; nothing depends on the order of partitions. Hot names are
reduced per task first: positions are kept once per value, not once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions import names, values

COLUMNS = ("Organisation Name", "Town/City", "County", "Type & Rating", "Route")
SHORT = ("name", "town", "county", "rating", "route")
OUTPUT = ("Organisation Name", "org_name_normalised", "has_multiple_towns", "has_multiple_counties", "Town/City", "County", "Type & Rating", "Route", "raw_name_variants")


def coerce(df: DataFrame, mapping: dict[str, str] | None = None, pos: str | None = None) -> DataFrame:
    """Five stripped text columns under short names, and `pos`: what the column `pos` says, a number or any struct
    that orders the rows, else their order as they are read."""
    mapping = mapping or dict(zip(SHORT, COLUMNS))
    placed = pos is not None and isinstance(df.schema[pos].dataType, StructType)
    place = F.col(f"`{pos}`") if placed else F.col(f"`{pos}`").cast("long") if pos else F.monotonically_increasing_id()
    return df.select(*[names.strip_column(values.text(F.col(f"`{mapping[s]}`"))).alias(s) for s in SHORT], place.alias("pos"))


def firsts(df: DataFrame, pos: str = "pos") -> DataFrame:
    """df without rows that differ from an earlier one in position only: a rolled-up register is the same without."""
    return df.groupBy(*[c for c in df.columns if c != pos]).agg(F.min(pos).alias(pos))


def is_skilled_worker(route: Column) -> Column:
    return names.strip(route) == "Skilled Worker"


def is_a_rated(rating: Column) -> Column:
    return F.lower(rating).contains("a rating")


def eligible(rows: DataFrame) -> DataFrame:
    return rows.filter(is_skilled_worker(F.col("route")) & is_a_rated(F.col("rating")))


def rollup(rows: DataFrame, normalise: Callable[[Column], Column] = names.normalise) -> DataFrame:
    """One row per normalised name, arrays in first-seen order, sorted by nobody yet. Rows that differ in
    position only count by the first, before any name is normalised, once: a row's position goes along as a
    field of its own, without a name ("")."""
    keyed = firsts(rows.select(*SHORT, "pos")).withColumn("norm", normalise(F.col("name")))
    field = lambda s, value: F.struct(F.lit(s).alias("field"), value.alias("value"), F.col("pos"))
    long_ = keyed.select("norm", F.inline(F.array(field("", F.isnull("pos").cast("string")), *[field(s, F.col(s)) for s in SHORT])))
    once = long_.filter((F.col("value") != "") & (F.lower("value") != "nan")).groupBy("norm", "field", "value").agg(F.min("pos").alias("pos"))
    of = lambda s, x: F.when(F.col("field") == s, x)
    lists = [F.transform(F.array_sort(F.collect_list(of(s, F.struct("pos", "value")))), lambda x: x["value"]).alias(f"{s}_list") for s in SHORT]
    listed = once.groupBy("norm").agg(F.min(of("", F.struct("pos"))).alias("first"), *lists)
    return listed.select("norm", F.col("first.pos").alias("pos"), *[f"{s}_list" for s in SHORT])


def register(rows: DataFrame, normalise: Callable[[Column], Column] = names.normalise) -> DataFrame:
    """Eligible rows rolled up, under short output names."""
    up = rollup(eligible(rows), normalise)
    return up.select(
        F.coalesce(F.try_element_at("name_list", F.lit(1)), F.lit("")).alias("org_name"),
        F.col("norm").alias("org_norm"),
        (F.size("town_list") > 1).alias("has_multiple_towns"),
        (F.size("county_list") > 1).alias("has_multiple_counties"),
        F.array_join("town_list", " | ").alias("town"),
        F.array_join("county_list", " | ").alias("county"),
        F.array_join(F.array_sort("rating_list"), " | ").alias("rating"),
        F.array_join(F.array_sort("route_list"), " | ").alias("route"),
        F.array_join("name_list", " | ").alias("raw_name_variants"),
        "pos",
    )


def stats(rows: DataFrame, normalise: Callable[[Column], Column] = names.normalise) -> DataFrame:
    """One row of counts: total, skilled, A rated, filtered, raw names, organisations, merged."""
    yes = is_skilled_worker(F.col("route")) & is_a_rated(F.col("rating"))
    counted = rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_skilled_worker(F.col("route"))).alias("skilled_rows"),
        F.count_if(is_a_rated(F.col("rating"))).alias("a_rated_rows"),
        F.count_if(yes).alias("filtered_rows"),
        F.count_distinct(F.when(yes, F.col("name"))).alias("unique_names"),
        F.count_distinct(F.when(yes, normalise(F.col("name")))).alias("organisations"),
    )
    return counted.withColumn("merged", F.col("unique_names") - F.col("organisations"))


def top_values(rows: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values with their counts; ties in order of first appearance."""
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"), F.min("pos").alias("first_pos"))
    return counted.orderBy(F.desc("n_rows"), "first_pos").limit(n)
