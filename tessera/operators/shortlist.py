"""Shortlisting scored rows by score, size, place, and free search filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.errors import InvalidValueError, NotAvailableError
from tessera.functions import values

SCORE = 0.55
EXPLAIN = ("org_name", "ch_company_number", "ch_company_name", "ch_sic_codes", "employee_count", "employee_count_source", "employee_count_snapshot_date", "sic_tech_score", "is_active_score", "company_age_score", "company_type_score", "name_keyword_score", "role_fit_score", "role_fit_bucket")
_COUNT = r"^[1-9][0-9]*\z"


@dataclass(frozen=True)
class Location:
    """A place by its names; terms are lower case, postcode prefixes upper case."""

    canonical: str
    aliases: tuple[str, ...] = ()
    regions: tuple[str, ...] = ()
    localities: tuple[str, ...] = ()
    postcodes: tuple[str, ...] = ()


@dataclass(frozen=True)
class GeoFilter:
    regions: tuple[str, ...] = ()
    localities: tuple[str, ...] = ()
    postcodes: tuple[str, ...] = ()


def _terms(found: Iterable[str], upper: bool = False) -> tuple[str, ...]:
    tidy = (t.strip() for t in found)
    return tuple(dict.fromkeys(t.upper() if upper else t.lower() for t in tidy if t))


def locations(payload: dict) -> list[Location]:
    """Locations of an alias file's content."""
    return [Location(x["canonical_name"].strip(), _terms(x["aliases"]), _terms(x["regions"]), _terms(x["localities"]), _terms(x["postcode_prefixes"], True)) for x in payload["locations"]]


def resolve(query: str | None, known: Sequence[Location]) -> Location | None:
    """The first location one of whose names is the query."""
    target = (query or "").strip().lower()
    return next((k for k in known if target and target in (k.canonical.lower(), *k.aliases, *k.regions, *k.localities)), None)


def geo_filter(region: str | None, postcodes: Sequence[str], known: Sequence[Location]) -> GeoFilter:
    if not region and not postcodes:
        return GeoFilter()
    place = resolve(region, known) or Location("")
    return GeoFilter(_terms([region or "", *place.regions]), _terms(place.localities), _terms([*postcodes, *place.postcodes], True))


def in_place(f: GeoFilter) -> Column:
    """Any term fits; a filter without terms fits all."""
    region, locality, postcode = F.lower("ch_address_region"), F.lower("ch_address_locality"), F.upper("ch_address_postcode")
    tests = [F.contains(region, F.lit(t)) | F.contains(locality, F.lit(t)) for t in f.regions]
    tests += [F.contains(locality, F.lit(t)) for t in f.localities]
    tests += [F.startswith(postcode, F.lit(t)) for t in f.postcodes]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(True)


def by_score(rows: DataFrame, least: float = SCORE) -> DataFrame:
    return rows.filter((F.col("role_fit_score") >= least) & F.col("role_fit_bucket").isin("strong", "possible"))


def by_size(rows: DataFrame, least: int | None, include_unknown: bool = False) -> DataFrame:
    """Rows with a known employee count of at least `least`; counts that aren't numbers stop the
    step. Without a minimum nothing is looked at."""
    if least is None:
        return rows
    n = F.col("employee_count")
    bad = rows.filter((n != "") & ~n.rlike(_COUNT)).select("employee_count").distinct().orderBy("employee_count").limit(3).collect()
    if bad:
        raise InvalidValueError("employee_count", [r[0] for r in bad])
    enough = F.coalesce(n.try_cast("long") >= least, F.lit(False))
    return rows.filter(enough | (n == "") if include_unknown else enough)


def shortlist(rows: DataFrame, least: float = SCORE, min_employees: int | None = None, include_unknown: bool = False, place: GeoFilter = GeoFilter()) -> DataFrame:
    return by_size(by_score(rows, least), min_employees, include_unknown).filter(in_place(place))


def explain(rows: DataFrame) -> DataFrame:
    return rows.select(*EXPLAIN)


def search(rows: DataFrame, keyword: str | None = None, sector: str | None = None, region: str | None = None, size: str | None = None) -> DataFrame:
    """Rows that meet all given filters; at least one is needed. keyword: part of a name; sector: a
    code's prefix; region: part of a region or locality; size: a band."""
    if not any((keyword, sector, region, size)):
        raise NotAvailableError("search needs a keyword, sector, region or size")
    if keyword:
        rows = rows.filter(F.contains(F.lower("ch_company_name"), F.lit(keyword.lower())) | F.contains(F.lower("org_name"), F.lit(keyword.lower())))
    if sector:
        rows = rows.filter(F.exists(values.sic_list(F.col("ch_sic_codes")), lambda x: F.startswith(x, F.lit(sector))))
    if region:
        rows = rows.filter(in_place(GeoFilter(regions=_terms([region]))))
    if size:
        rows = rows.filter(values.size_band(values.positive_int(F.col("employee_count"))) == size)
    return rows
