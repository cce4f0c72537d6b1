"""Catalogues as relations: weights by a code's prefix, places by parts of an address.

A profile or an alias file of a few dozen entries is compiled into the expression (`scoring.sic_score`,
`shortlist.in_place`). Here entries are rows of a table, so their number doesn't touch the plan: each distinct
text is expanded to the parts that can be an entry, and these meet the entries by an equal key. Only lengths that
entries have are expanded; they are the one thing that comes to the driver, at most as many as the longest
entry has characters. Results go back to rows by their text, which a join can split where one text is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import ConflictingRowsError
from tessera.functions import names, values
from tessera.operators.scoring import BASELINE, HIGH, LOW, Profile
from tessera.operators.shortlist import Location
from tessera.stored import stored

WEIGHTS = "prefix string, positive double, negative double, nth long"
TERMS = "place string, kind string, term string"


def weights(spark: SparkSession, p: Profile) -> DataFrame:
    """A profile's catalogue as a table: a prefix, its weights or null, and the place of the negative one."""
    order = list(p.sic_negative)
    given = dict.fromkeys([*p.sic_positive, *order])
    return spark.createDataFrame([(k, p.sic_positive.get(k), p.sic_negative.get(k), order.index(k) if k in p.sic_negative else None) for k in given], WEIGHTS)


def terms(spark: SparkSession, known: list[Location]) -> DataFrame:
    """Locations as a table of terms: kind region (in a region or locality), locality, or postcode (how one begins)."""
    return spark.createDataFrame([(k.canonical, kind, t) for k in known for kind, found in (("region", k.regions), ("locality", k.localities), ("postcode", k.postcodes)) for t in found], TERMS)


def _lengths(entries: DataFrame, column: str) -> list[int]:
    return sorted(r[0] for r in entries.select(F.length(column)).distinct().collect() if r[0] is not None)


def _parts(texts: DataFrame, column: str, lengths: list[int], inside: Column) -> DataFrame:
    """texts with each `_part` of one of the lengths: where `inside`, from any character on, else from the first."""
    n = texts.withColumn("_n", F.explode(F.array(*[F.lit(k) for k in lengths]))).filter(F.length(column) >= F.col("_n"))
    starts = F.when(inside, F.sequence(F.lit(1), F.length(column) - F.col("_n") + 1)).otherwise(F.array(F.lit(1)))
    return n.withColumn("_i", F.explode(starts)).withColumn("_part", F.substring(F.col(column), F.col("_i"), F.col("_n"))).drop("_n", "_i")


def sic_scores(rows: DataFrame, codes: str, catalogue: DataFrame, name: str = "sic_tech_score") -> DataFrame:
    """rows with the score of the codes in column `codes`, as `sic_score` has it, by a catalogue of any size.

    Codes are taken in order: the score rises to the greatest positive weight whose prefix fits, then the fitting
    negative weights are added by nth. Prefixes that repeat stop the step; null prefixes and weights are none; an
    empty prefix fits every code. Rows without codes, or with an empty catalogue, have the base score.
    """
    catalogue = catalogue.filter(F.col("prefix").isNotNull())
    twice = catalogue.groupBy("prefix").count().filter("count > 1").orderBy("prefix").limit(5).collect()
    if twice:
        raise ConflictingRowsError(str([r["prefix"] for r in twice]))
    lengths = _lengths(catalogue, "prefix")
    base = F.lit(min(max(BASELINE, LOW), HIGH))
    if not lengths:
        return rows.withColumn(name, base)
    texts = stored(rows.select(values.text(F.col(codes)).alias("_codes")).distinct(), "codes")
    listed = texts.select("_codes", F.posexplode(values.sic_list(F.col("_codes"))).alias("_at", "_code"))
    heads = _parts(listed.select("_code").distinct(), "_code", lengths, F.lit(False))
    fits = heads.join(catalogue, F.col("_part") == F.col("prefix")).groupBy("_code").agg(
        F.max("positive").alias("_best"), F.array_sort(F.collect_list(F.when(F.col("negative").isNotNull(), F.struct("nth", "negative")))).alias("_minus")
    )  # at most one row a length
    step = lambda s, x: F.aggregate(x["_minus"], F.greatest(s, x["_best"]), lambda t, m: t + m["negative"])
    found = listed.join(fits, "_code").groupBy("_codes").agg(F.array_sort(F.collect_list(F.struct("_at", "_best", "_minus"))).alias("_hits"))
    scores = found.select("_codes", values.clamp(F.aggregate("_hits", F.lit(BASELINE), step), LOW, HIGH).alias("_score"))
    out = rows.join(scores, values.text(F.col(codes)) == F.col("_codes"), "left")
    return out.withColumn(name, F.coalesce("_score", base)).drop("_codes", "_score")


def located(rows: DataFrame, places: DataFrame, region: str = "ch_address_region", locality: str = "ch_address_locality", postcode: str = "ch_address_postcode") -> DataFrame:
    """rows with each `place` they lie in, as `in_place` has it for one: once a row and place, however many terms
    fit. Terms are stripped and compared without case; null and empty ones, and null parts of addresses, fit nothing."""
    tidy = places.select("place", "kind", F.when(F.col("kind") == "postcode", F.upper(names.strip(F.col("term")))).otherwise(F.lower(names.strip(F.col("term")))).alias("term"))
    tidy = tidy.filter("term <> '' AND kind IN ('region', 'locality', 'postcode')").distinct()
    lengths = _lengths(tidy, "term")
    if not lengths:
        return rows.withColumn("place", F.lit(None).cast("string")).filter(F.lit(False))
    key = lambda: F.struct(F.col(region).alias("r"), F.col(locality).alias("l"), F.col(postcode).alias("p"))
    kinds = F.array(*[F.struct(F.lit(k).alias("_kind"), t.alias("_text")) for k, t in (("region", F.lower(region)), ("region", F.lower(locality)), ("locality", F.lower(locality)), ("postcode", F.upper(postcode)))])
    addresses = stored(rows.select(region, locality, postcode).distinct().select(key().alias("_address"), F.inline(kinds)).filter(F.col("_text").isNotNull()), "addresses")
    parts = _parts(addresses.select("_kind", "_text").distinct(), "_text", lengths, F.col("_kind") != "postcode").distinct()
    hits = parts.join(tidy, (F.col("_part") == F.col("term")) & (F.col("_kind") == F.col("kind"))).select("_kind", "_text", "place").distinct()
    where = addresses.join(hits, ["_kind", "_text"]).select("_address", "place").distinct()
    return rows.join(where, key().eqNullSafe(F.col("_address"))).drop("_address")
