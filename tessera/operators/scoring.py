"""Rule scoring: a profile is compiled to Column expressions; rows never leave the JVM."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.errors import ConflictingRowsError, InvalidValueError
from tessera.functions import names, values
from tessera.operators.asof import asof_join

BASELINE, LOW, HIGH = 0.10, 0.0, 0.5
UNKNOWN_TYPE = 0.03


@dataclass(frozen=True)
class Profile:
    """Weights of one kind of role. age_bands: (years at least, score), highest first."""

    name: str
    job_type: str
    sic_positive: dict[str, float]
    sic_negative: dict[str, float]
    keyword_positive: tuple[str, ...]
    keyword_negative: tuple[str, ...]
    type_weights: dict[str, float]
    age_bands: tuple[tuple[float, float], ...]
    age_unknown: float = 0.05
    positive_per_match: float = 0.05
    positive_cap: float = 0.15
    negative_per_match: float = 0.05
    negative_cap: float = 0.10
    active: float = 0.10
    inactive: float = 0.0
    strong: float = 0.55
    possible: float = 0.35
    signals: dict = field(default_factory=dict)  # validated, not used in scores


def sic_score(codes: Column, p: Profile) -> Column:
    """Codes in order: the running score rises to a matching positive weight, then matching
    negative weights are added; clamped once at the end."""
    best = lambda x: F.greatest(*[F.when(F.startswith(x, F.lit(k)), F.lit(v)) for k, v in p.sic_positive.items()], F.lit(-9.0), F.lit(None).cast("double"))

    def step(score: Column, x: Column) -> Column:
        score = F.greatest(score, best(x))
        for k, v in p.sic_negative.items():
            score = score + F.when(F.startswith(x, F.lit(k)), F.lit(v)).otherwise(F.lit(0.0))
        return score

    return values.clamp(F.aggregate(codes, F.lit(BASELINE), step), LOW, HIGH)


def age_score(created: Column, as_of: Column, p: Profile) -> Column:
    """created: ISO text. Blank, unreadable or later than as_of: unknown."""
    day = F.when(created.rlike(r"^\d{4}-\d{2}-\d{2}\z"), created.try_cast("date"))
    years = values.years_between(day, as_of)
    out = F.when(years.isNull(), F.lit(p.age_unknown))
    for least, score in p.age_bands:
        out = out.when(years >= F.lit(least), F.lit(score))
    return out.otherwise(F.lit(p.age_unknown))


def type_score(kind: Column, p: Profile) -> Column:
    key = names.strip(F.lower(values.text(kind)))
    out = F.lit(UNKNOWN_TYPE)
    for k, v in p.type_weights.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def keyword_score(name: Column, p: Profile) -> Column:
    w = values.words(name)
    hits = lambda k: F.size(F.array_intersect(w, F.array(*[F.lit(x) for x in k]))).cast("double")
    return F.least(F.lit(p.positive_cap), hits(p.keyword_positive) * F.lit(p.positive_per_match)) - F.least(F.lit(p.negative_cap), hits(p.keyword_negative) * F.lit(p.negative_per_match))


def status_score(status: Column, p: Profile) -> Column:
    return F.when(F.lower(values.text(status)) == "active", F.lit(p.active)).otherwise(F.lit(p.inactive))


def bucket(total: Column, p: Profile) -> Column:
    return F.when(total >= F.lit(p.strong), "strong").when(total >= F.lit(p.possible), "possible").otherwise("unlikely")


def features(rows: DataFrame, p: Profile, as_of: Column) -> DataFrame:
    """The five features, their clamped sum and its bucket beside the enriched columns."""
    name = F.coalesce(F.nullif(F.col("ch_company_name"), F.lit("")), F.col("org_name"))
    rows = rows.withColumns({
        "sic_tech_score": sic_score(values.sic_list(F.col("ch_sic_codes")), p),
        "is_active_score": status_score(F.col("ch_company_status"), p),
        "company_age_score": age_score(F.col("ch_date_of_creation"), as_of, p),
        "company_type_score": type_score(F.col("ch_company_type"), p),
        "name_keyword_score": keyword_score(name, p),
    })
    total = F.col("sic_tech_score") + F.col("is_active_score") + F.col("company_age_score") + F.col("company_type_score") + F.col("name_keyword_score")
    rows = rows.withColumn("role_fit_score", values.clamp(total, 0.0, 1.0))
    return rows.withColumn("role_fit_bucket", bucket(F.col("role_fit_score"), p))


def employee_conflicts(counts: DataFrame) -> DataFrame:
    """Company numbers whose repeated rows differ."""
    rest = [c for c in counts.columns if c != "company_number"]
    return counts.groupBy("company_number").agg(F.count_distinct(F.struct(*rest)).alias("n_versions")).filter("n_versions > 1")


def employee_lookup(counts: DataFrame) -> DataFrame:
    """One row per company number; numbers whose rows differ stop the step."""
    bad = employee_conflicts(counts).orderBy("company_number").limit(5).collect()
    if bad:
        raise ConflictingRowsError(str([r["company_number"] for r in bad]))
    return counts.dropDuplicates(["company_number"])


def attach_employees(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Employee counts by company number; '' where there is none. AQE broadcasts the lookup where
    its measured size allows that, and sorts and merges otherwise."""
    side = lookup.select(names.strip(F.col("company_number")).alias("_number"), "employee_count", "employee_count_source", "employee_count_snapshot_date")
    joined = rows.join(side, names.strip(F.col("ch_company_number")) == F.col("_number"), "left").drop("_number")
    return joined.withColumns({c: values.text(F.col(c)) for c in ("employee_count", "employee_count_source", "employee_count_snapshot_date")})


def attach_employees_as_of(rows: DataFrame, history: DataFrame, day: str) -> DataFrame:
    """Employee counts by company number as they were on each row's day (a column of rows): of the snapshot that
    holds then, by `valid_from`; '' where there is none."""
    counts = ("employee_count", "employee_count_source", "employee_count_snapshot_date")
    keyed = rows.drop(*counts).withColumn("_number", F.nullif(names.strip(F.col("ch_company_number")), F.lit("")))
    known = history.withColumn("_number", names.strip(F.col("company_number")))
    out = asof_join(keyed, known, "_number", day, "valid_from", list(counts), "year").drop("_number")
    return out.withColumns({c: values.text(F.col(c)) for c in counts})


def bad_scores(rows: DataFrame, column: str = "match_score") -> DataFrame:
    """(value, n_rows): what the column has beside numbers, blanks as '<empty>'."""
    t = names.strip(values.text(F.col(column)))
    bad = rows.filter(t.try_cast("double").isNull()).select(F.when(t == "", "<empty>").otherwise(t).alias("value"))
    return bad.groupBy("value").agg(F.count(F.lit(1)).alias("n_rows"))


def check_scores(rows: DataFrame, column: str = "match_score") -> None:
    """Raise with up to five sorted samples if the column has anything but numbers."""
    bad = bad_scores(rows, column).orderBy("value").limit(5).collect()
    if bad:
        raise InvalidValueError(column, [r["value"] for r in bad])


def scored(enriched: DataFrame, p: Profile, as_of: Column, lookup: DataFrame) -> DataFrame:
    """Features and employee counts; order with order_scored() where order matters."""
    return attach_employees(features(enriched, p, as_of), lookup)


def order_scored(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.desc("role_fit_score"), F.desc(F.col("match_score").cast("double")), "org_name")
