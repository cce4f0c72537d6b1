"""Employee-count snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import InvalidValueError, SnapshotError
from tessera.functions import names, values
from tessera.operators.asof import history
from tessera.operators.registry import require
from tessera.operators.scoring import employee_lookup
from tessera.sources import snapshots, tables

COLUMNS = ("company_number", "employee_count", "employee_count_source", "employee_count_snapshot_date")


def canonical(df: DataFrame) -> DataFrame:
    """Stripped cells, counts as plain numbers; blank keys, counts below 1 or other dates than ISO
    stop the step."""
    t = require(df, COLUMNS, "employee counts").select(*[names.strip(values.text(F.col(c))).alias(c) for c in COLUMNS])
    n = values.positive_int(F.col("employee_count"))
    bad = t.filter(n.isNull() | (F.col("company_number") == "") | ~F.col("employee_count_snapshot_date").rlike(r"^\d{4}-\d{2}-\d{2}\z")).limit(3).collect()
    if bad:
        raise InvalidValueError("employee counts", [str(tuple(r)) for r in bad])
    return t.withColumn("employee_count", n.cast("string"))


def load_history(spark: SparkSession, root: str, dataset: str = "employee_count") -> DataFrame:
    """All committed snapshots' counts, each one row per company, with `valid_from`: the snapshot's day."""
    parts = []
    for folder in snapshots.dated(spark, root, dataset):
        clean = snapshots.read_json(spark, f"{folder}/manifest.json")["artefacts"]["clean"]
        parts.append((employee_lookup(canonical(tables.read_csv(spark, f"{folder}/{clean}"))), F.lit(folder.rsplit("/", 1)[-1])))
    return history(*parts)


def load(spark: SparkSession, root: str, dataset: str = "employee_count") -> DataFrame:
    """The latest snapshot's counts, one row per company; its manifest has to fit."""
    folder = snapshots.latest(spark, root, dataset)
    m = snapshots.read_json(spark, f"{folder}/manifest.json")
    if m.get("dataset") != dataset or m.get("schema_version") != "employee_count_v1" or not {"raw", "clean"} <= set(m.get("artefacts", {})):
        raise SnapshotError(f"{folder}: the manifest doesn't fit")
    counts = canonical(tables.read_csv(spark, f"{folder}/{m['artefacts']['clean']}"))
    if m.get("row_counts", {}).get("clean") != counts.count():
        raise SnapshotError(f"{folder}: the manifest counts other rows")
    return employee_lookup(counts)
