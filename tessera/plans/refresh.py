"""Snapshots from end to end: a source is acquired into a staging folder, cleaned there, described by a
manifest and moved to its dated place in one step. A step that fails leaves no dated snapshot."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.errors import MissingInputError, PendingNotFoundError, PipelineError
from tessera.operators import links, register, registry
from tessera.sources import snapshots, tables
from tessera.sources.http import Client
from tessera.sources.snapshots import Staged

#: What each dataset's snapshot holds, by the key its manifest has it under.
ARTEFACTS = {
    "register": {"raw": "raw.csv", "clean": "clean.csv", "register_stats": "register_stats.json", "manifest": "manifest.json"},
    "registry": {"raw": "raw.csv", "clean": "clean.csv", "index_tokens": "index_tokens", "profiles": "profiles", "manifest": "manifest.json"},
    "employee_count": {"raw": "raw.csv", "clean": "clean.csv", "manifest": "manifest.json"},
}
SCHEMA = {"register": "register_v1", "registry": "registry_v1", "employee_count": "employee_count_v1"}


def discover(spark: SparkSession, dataset: str, page: str, url: str, client: Client | None = None) -> str:
    """The source that a page links to: the best .csv link, or the newest archive for a registry. page: a
    file on any Hadoop file system, or an address that the client fetches."""
    fetched = client is not None and page.startswith(("http://", "https://"))
    if not fetched and not tables.exists(spark, page):
        raise MissingInputError(page)
    html = client.fetch(page).text() if fetched else spark.read.text(page, wholetext=True).first()[0]
    found = links.extract_links(spark.createDataFrame([(0, url or (page if fetched else ""), html)], "key long, url string, html string"), "key", "url", "html")
    return links.the_archive_link(found) if dataset == "registry" else links.the_best_link(found)


def acquire(spark: SparkSession, root: str, dataset: str, source: str, client: Client | None = None, now: datetime | None = None) -> Staged:
    """Copy a source (a file on any Hadoop file system, or an address that the client fetches) into a new
    staging folder. Its name's date, else the day of now, dates the snapshot."""
    now = now or datetime.now(UTC)
    staged = snapshots.start(spark, root, dataset, snapshots.date_of(source.rsplit("/", 1)[-1], now))
    target = f"{staged.staging}/raw{'.zip' if source.lower().split('?')[0].endswith('.zip') else '.csv'}"
    try:
        fetched = client is not None and source.startswith(("http://", "https://"))
        n = tables.write_chunks(spark, target, client.chunks(source)) if fetched else tables.copy(spark, source, target)
        if target.endswith(".zip"):
            tables.unzip(spark, target, f"{staged.staging}/raw.csv")
        snapshots.write_pending(spark, staged, source, now, n)
    except BaseException:
        snapshots.discard(spark, staged)
        raise
    return staged


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    """df, and how many rows of it were seen once it was written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: seen.get["n"]


def _clean_register(spark: SparkSession, folder: str) -> tuple[int, int]:
    from tessera.plans import steps

    rows = register.coerce(registry.require(tables.read_csv(spark, f"{folder}/raw.csv"), register.COLUMNS, "register"))
    return steps.write_register(spark, rows, f"{folder}/clean.csv", f"{folder}/register_stats.json")


def _clean_registry(spark: SparkSession, folder: str) -> tuple[int, int]:
    from tessera.plans import steps

    raw, n_raw = _counted(registry.require(tables.read_csv(spark, f"{folder}/raw.csv", na_cells=False, position="pos"), registry.BULK.values(), "registry"))
    rows = registry.clean(raw)
    out, n_clean = _counted(rows.drop("pos"))
    tables.write_csv(out, f"{folder}/clean.csv", mode="errorifexists")
    tables.write_index(registry.token_index(rows), f"{folder}/index_tokens")
    tables.write_profiles(registry.companies(rows).drop("pos"), f"{folder}/profiles")
    steps.write_match_index(spark.read.parquet(f"{folder}/profiles").drop("bucket"), f"{folder}/{steps.MATCH_INDEX}")
    return n_raw(), n_clean()


def _clean_employees(spark: SparkSession, folder: str) -> tuple[int, int]:
    from tessera.sources import employees

    raw, n_raw = _counted(tables.read_csv(spark, f"{folder}/raw.csv"))
    out, n_clean = _counted(employees.canonical(raw))
    tables.write_csv(out, f"{folder}/clean.csv", mode="errorifexists")
    return n_raw(), n_clean()


CLEANERS = {"register": _clean_register, "registry": _clean_registry, "employee_count": _clean_employees}


def clean(spark: SparkSession, root: str, dataset: str, command_line: str = "", now: datetime | None = None) -> str:
    """Clean what was acquired last, write the manifest and commit; the snapshot's folder."""
    pending = snapshots.latest_pending(spark, root, dataset)
    if pending is None:
        raise PendingNotFoundError(f"{dataset} in {root}: nothing was acquired")
    staged, state = pending
    folder = staged.staging
    for name in (*ARTEFACTS[dataset].values(), "match_index"):  # what an earlier try left
        if name != "raw.csv":
            fs, p = tables.filesystem(spark, f"{folder}/{name}")
            fs.delete(p, True)
    n_raw, n_clean = CLEANERS[dataset](spark, folder)
    found = snapshots.manifest(
        dataset=dataset, date=staged.date, source_url=state["source_url"], downloaded=datetime.fromisoformat(state["downloaded_at_utc"]), updated=now or datetime.now(UTC), schema_version=SCHEMA[dataset],
        sha_raw=tables.file_digest(spark, f"{folder}/raw.csv"), sha_clean=tables.table_digest(tables.read_csv(spark, f"{folder}/clean.csv", na_cells=False)), bytes_raw=state["bytes_raw"],
        row_counts={"raw": n_raw, "clean": n_clean}, artefacts=dict(ARTEFACTS[dataset]), command_line=command_line,
    )
    fs, p = tables.filesystem(spark, f"{folder}/pending.json")
    state_text = snapshots.read_json(spark, f"{folder}/pending.json")
    fs.delete(p, True)
    try:
        snapshots.write_json(spark, f"{folder}/manifest.json", found)
        snapshots.commit(spark, staged)
    except PipelineError:
        snapshots.write_json(spark, f"{folder}/pending.json", state_text)  # it can be committed later
        raise
    return staged.final


def refresh(spark: SparkSession, root: str, dataset: str, source: str, client: Client | None = None, command_line: str = "") -> str:
    acquire(spark, root, dataset, source, client)
    return clean(spark, root, dataset, command_line)
