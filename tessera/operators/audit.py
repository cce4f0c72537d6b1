"""Data-quality metrics of the match outputs and the checks on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.errors import AuditError
from tessera.functions import names, values


#: Metrics that have to be 0.
STRUCTURE = (
    "duplicate_org_enriched", "duplicate_org_unmatched", "overlap_org_between_sets",
    "missing_ch_company_number", "missing_ch_company_name", "missing_match_score", "missing_score_name_similarity",
)


@dataclass(frozen=True)
class Thresholds:
    low_similarity: float = 0.60
    max_low_similarity: int = 300
    near_cutoff: float = 0.70
    max_near: int = 1500
    max_non_active: int = 3000
    max_shared_numbers: int = 2000


def duplicate_count(df: DataFrame, key: Column, alias: str) -> DataFrame:
    """One row: how many rows are beyond the first of their key."""
    return df.groupBy(key.alias("k")).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias(alias))


def shared_rows(df: DataFrame, key: Column, alias: str) -> DataFrame:
    """One row: how many rows share their non-blank key with others."""
    return df.filter(key != "").groupBy(key.alias("k")).count().filter("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias(alias))


def metrics(enriched: DataFrame, unmatched: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """One row of fourteen metrics. Everything is aggregated per key before it meets."""
    org = names.strip(values.text(F.col("org_name")))
    blank = lambda c: F.count_if(names.strip(values.text(F.col(c))) == "")
    left = enriched.agg(
        F.count(F.lit(1)).alias("enriched_rows"), blank("ch_company_number").alias("missing_ch_company_number"), blank("ch_company_name").alias("missing_ch_company_name"),
        blank("match_score").alias("missing_match_score"), blank("score_name_similarity").alias("missing_score_name_similarity"),
        F.count_if(F.col("score_name_similarity").cast("double") < t.low_similarity).alias("low_similarity_matches"),
        F.count_if(names.strip(F.lower(values.text(F.col("ch_company_status")))) != "active").alias("non_active_matches"),
    )
    right = unmatched.agg(F.count(F.lit(1)).alias("unmatched_rows"), F.count_if(F.col("best_candidate_score").cast("double") >= t.near_cutoff).alias("near_threshold_unmatched"))
    overlap = enriched.select(org.alias("k")).distinct().join(unmatched.select(org.alias("k")).distinct(), "k", "left_semi").agg(F.count(F.lit(1)).alias("overlap_org_between_sets"))
    out = left.crossJoin(right)  # one row each, as all that follow
    number = names.strip(values.text(F.col("ch_company_number")))
    for more in (duplicate_count(enriched, org, "duplicate_org_enriched"), duplicate_count(unmatched, org, "duplicate_org_unmatched"), overlap, shared_rows(enriched, number, "non_unique_company_number_rows")):
        out = out.crossJoin(more)
    return out.withColumn("total_rows", F.col("enriched_rows") + F.col("unmatched_rows"))


def check_structure(m: dict) -> None:
    """Raise if organisations repeat, are in both outputs, or key fields are missing."""
    for key, said in (("duplicate_org_enriched", "organisations repeat among the matched"), ("duplicate_org_unmatched", "organisations repeat among the unmatched"), ("overlap_org_between_sets", "organisations are matched and unmatched")):
        if m[key]:
            raise AuditError(said)
    missing = [k.removeprefix("missing_") for k in STRUCTURE if k.startswith("missing_") and m[k]]
    if missing:
        raise AuditError(f"key fields are missing: {missing}")


def _limits(t: Thresholds) -> dict[str, int]:
    return {"low_similarity_matches": t.max_low_similarity, "non_active_matches": t.max_non_active, "non_unique_company_number_rows": t.max_shared_numbers, "near_threshold_unmatched": t.max_near}


def breaches(m: dict, t: Thresholds = Thresholds()) -> list[str]:
    return [f"{k}: {m[k]} > {most}" for k, most in _limits(t).items() if m[k] > most]


def findings(m: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """check_structure() and breaches() as a relation, for the metrics of any number of runs: per row of m
    and check the columns of m that name the run (run...), kind, name, value, the most that passes, and whether it failed."""
    checks = [("structure", k, 0) for k in STRUCTURE] + [("threshold", k, most) for k, most in _limits(t).items()]
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("name"), F.col(k).cast("long").alias("value"), F.lit(most).cast("long").alias("most")) for kind, k, most in checks])
    other = [c for c in m.columns if c.startswith("run")]
    out = m.select(*other, F.explode(rows).alias("x")).select(*other, "x.*")
    return out.withColumn("failed", F.col("value") > F.col("most"))


def differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two results has more often than the other; none means equal results."""
    return a.exceptAll(b).unionByName(b.exceptAll(a))
