"""Checks of what was written: snapshots, outputs, repeated and resumed runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import NotDeterministicError, OutputError, RegistryUriMismatchError, ResumeError, SnapshotError
from tessera.operators import audit, register, registry
from tessera.plans.refresh import ARTEFACTS, SCHEMA
from tessera.sources import digests, employees, ledger, snapshots, tables

_ORG = ("org_name", "org_norm", "has_multiple_towns", "has_multiple_counties", "town", "county", "rating", "route", "raw_name_variants")
_SCORES = ("score_name_similarity", "score_locality_bonus", "score_region_bonus", "score_status_bonus")
ENRICHED = (
    *_ORG, "match_status", "match_score", "match_confidence", "match_query_used", *_SCORES, "ch_company_number", "ch_company_name", "ch_company_status", "ch_company_type", "ch_date_of_creation", "ch_sic_codes",
    "ch_address_locality", "ch_address_region", "ch_address_postcode",
)
UNMATCHED = (*_ORG, "match_status", "match_error", "best_candidate_score", "best_candidate_title", "best_candidate_company_number")
CANDIDATES = ("org_name", "rank", *(f"candidate_{x}" for x in ("company_number", "title", "status", "locality", "region", "postcode", "score")), *_SCORES, "query_used")
FEATURES = ("sic_tech_score", "is_active_score", "company_age_score", "company_type_score", "name_keyword_score", "role_fit_score", "role_fit_bucket")
EMPLOYEES = ("employee_count", "employee_count_source", "employee_count_snapshot_date")
SCORED = (*ENRICHED, *EMPLOYEES, *FEATURES)
EXPLAIN = ("Organisation Name", "ch_company_number", "ch_company_name", "ch_sic_codes", *EMPLOYEES, *FEATURES)
#: Output tables by folder: format and columns.
OUTPUTS = {"enriched": ("parquet", ENRICHED), "unmatched": ("parquet", UNMATCHED), "candidates": ("parquet", CANDIDATES), "checkpoint": ("parquet", ("org_name",)), "scored": ("parquet", SCORED), "shortlist": ("csv", ("Organisation Name", *SCORED[9:])), "shortlist_explain": ("csv", EXPLAIN)}
# The report of a match run, its keys and types, and what its status can be.
REPORT = {
    "status": str, "error_message": str, "generated_at_utc": str, "run_started_at_utc": str, "run_finished_at_utc": str, "run_duration_seconds": float, "register_path": str, "out_dir": str, "batch_size": int, "batch_start": int,
    "batch_count": int | None, "batch_range": dict | None, "overall_batch_range": dict | None, "total_register_orgs": int, "total_unprocessed_at_start": int, "total_batches_at_start": int, "total_batches_overall": int,
    "selected_batches": int, "processed_in_run": int, "processed_total": int, "remaining": int, "resume_command": str,
}
STATUSES = ("complete", "error", "interrupted")
MATCH_OUTPUTS = ("candidates", "enriched", "unmatched", "checkpoint")


def table(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    """An output table: of the match step's, all finished runs."""
    if kind == "csv":
        return tables.read_csv(spark, path, na_cells=False)
    out_dir, _, name = path.rpartition("/")
    return ledger.read(spark, out_dir, name) if name in MATCH_OUTPUTS else spark.read.parquet(path)


def snapshot_errors(spark: SparkSession, root: str, datasets: tuple[str, ...] = tuple(ARTEFACTS)) -> list[str]:
    """What is wrong with the latest snapshots: artefacts, manifest and columns."""
    columns = {"register": register.OUTPUT, "registry": registry.CLEAN, "employee_count": employees.COLUMNS}
    wrong = []
    for dataset in datasets:
        try:
            folder = snapshots.latest(spark, root, dataset)
            got = snapshots.read_json(spark, f"{folder}/manifest.json")
        except (SnapshotError, json.JSONDecodeError) as e:
            wrong.append(f"{dataset}: {e}")
            continue
        if not isinstance(got, dict):
            wrong.append(f"{dataset}: the manifest is no object")
            continue
        wrong += [f"{dataset}: {f} is missing" for f in ARTEFACTS[dataset].values() if not tables.exists(spark, f"{folder}/{f}")]
        wrong += [f"{dataset}: the manifest lacks {k}" for k in snapshots.MANIFEST if k not in got]
        expect = {"dataset": dataset, "snapshot_date": folder.rsplit("/", 1)[-1], "schema_version": SCHEMA[dataset]}
        wrong += [f"{dataset}: {k} is {got.get(k)!r}, not {v!r}" for k, v in expect.items() if got.get(k) != v]
        counts, artefacts = got.get("row_counts"), got.get("artefacts")
        wrong += [f"{dataset}: row_counts.{k} is no number" for k in ("raw", "clean") if not isinstance(counts, dict) or not isinstance(counts.get(k), int) or isinstance(counts.get(k), bool)]
        wrong += [f"{dataset}: artefacts.{k} is missing" for k in ARTEFACTS[dataset] if not isinstance(artefacts, dict) or not isinstance(artefacts.get(k), str) or not artefacts[k].strip()]
        if tables.exists(spark, f"{folder}/clean.csv"):
            clean = tables.read_csv(spark, f"{folder}/clean.csv", na_cells=False)
            wrong += [f"{dataset}: clean.csv lacks {c}" for c in sorted(set(columns[dataset]) - set(clean.columns))]
            if dataset == "registry" and "uri" in clean.columns and "company_number" in clean.columns:
                try:
                    registry.check_uris(clean)
                except RegistryUriMismatchError as e:
                    wrong.append(f"{dataset}: addresses and numbers differ: {e}")
            if isinstance(counts, dict) and counts.get("clean") != clean.count():
                wrong.append(f"{dataset}: clean.csv has another number of rows")
    return wrong


def check_report(report: dict) -> str:
    """A match report's status; another shape is an error."""
    if not isinstance(report, dict):
        raise OutputError("the report is no object")
    bad = [k for k, t in REPORT.items() if k not in report or isinstance(report[k], bool) or not isinstance(float(report[k]) if t is float and isinstance(report[k], int) else report[k], t)]
    if bad:
        raise OutputError(f"the report lacks or misstates {bad}")
    if report["status"] not in STATUSES:
        raise OutputError(f"status {report['status']!r} is none of {STATUSES}")
    return report["status"]


def check_outputs(spark: SparkSession, out_dir: str) -> str:
    """All output tables with their columns, and the report; its status."""
    if not tables.exists(spark, out_dir):
        raise OutputError(f"{out_dir} doesn't exist")
    for name, (kind, columns) in OUTPUTS.items():
        path = f"{out_dir}/{name}"
        if not tables.exists(spark, path):
            raise OutputError(f"{path} is missing")
        if missing := sorted(set(columns) - set(table(spark, path, kind).columns)):
            raise OutputError(f"{path} lacks {missing}")
    if not tables.exists(spark, f"{out_dir}/resume_report.json"):
        raise OutputError(f"{out_dir}/resume_report.json is missing")
    try:
        return check_report(snapshots.read_json(spark, f"{out_dir}/resume_report.json"))
    except json.JSONDecodeError as e:
        raise OutputError(f"{out_dir}/resume_report.json: {e}") from e


def check_equal_runs(spark: SparkSession, first: str, second: str, names: tuple[str, ...] = ("enriched", "unmatched", "candidates", "checkpoint")) -> None:
    """Two runs over equal inputs wrote equal rows."""
    for name in names:
        a, b = (table(spark, f"{d}/{name}", OUTPUTS[name][0]) for d in (first, second))
        if sorted(a.columns) != sorted(b.columns):
            raise NotDeterministicError(f"{name}: other columns")
        if rows := digests.differences(a, b.select(*a.columns)).limit(3).collect():
            raise NotDeterministicError(f"{name}: {rows}")


def check_nothing_left(report: dict) -> None:
    """A run again after a complete one found nothing to do."""
    if check_report(report) != "complete":
        raise ResumeError(f"status is {report['status']}")
    for k in ("processed_in_run", "remaining"):
        if report[k]:
            raise ResumeError(f"{k} is {report[k]}")


def check_audit(spark: SparkSession, out_dir: str, limits: audit.Thresholds = audit.Thresholds()) -> list[str]:
    """Thresholds that a match run's outputs exceed; wrong structure is an error."""
    enriched, unmatched = (table(spark, f"{out_dir}/{n}") for n in ("enriched", "unmatched"))
    m = audit.metrics(enriched.withColumn("org_name", F.col("org_name")), unmatched, limits).first().asDict()
    audit.check_structure(m)
    return audit.breaches(m, limits)
