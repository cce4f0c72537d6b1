"""Dated snapshots on any Hadoop file system: staged writes, atomic commits, latest lookups."""

from __future__ import annotations

import json
import os
import re
import uuid
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from tessera.errors import SnapshotError, SnapshotExistsError, SnapshotFileMissingError, SnapshotNotFoundError, SnapshotTimeError
from tessera.sources.tables import filesystem

DATE = re.compile(r"20\d{2}-\d{2}-\d{2}")
MANIFEST = ("dataset", "snapshot_date", "source_url", "downloaded_at_utc", "last_updated_at_utc", "schema_version", "sha256_hash_raw", "sha256_hash_clean", "bytes_raw", "row_counts", "artefacts", "git_sha", "tool_version", "command_line")


@dataclass(frozen=True)
class Staged:
    dataset: str
    date: str
    staging: str
    final: str


def date_of(source_name: str, downloaded: datetime) -> str:
    """The date in a file name, else the UTC day of the download, which must know its zone."""
    if found := DATE.search(source_name):
        return found[0]
    if downloaded.tzinfo is None:
        raise SnapshotTimeError("the download time has no time zone")
    return downloaded.astimezone(UTC).date().isoformat()


def start(spark: SparkSession, root: str, dataset: str, date: str) -> Staged:
    final = f"{root.rstrip('/')}/{dataset}/{date}"
    fs, p = filesystem(spark, final)
    if fs.exists(p):
        raise SnapshotExistsError(final)
    staging = f"{root.rstrip('/')}/{dataset}/.tmp-{uuid.uuid4().hex}"
    fs.mkdirs(filesystem(spark, staging)[1])
    return Staged(dataset, date, staging, final)


def commit(spark: SparkSession, s: Staged) -> None:
    fs, final = filesystem(spark, s.final)
    if fs.exists(final):
        raise SnapshotExistsError(s.final)
    if not fs.rename(filesystem(spark, s.staging)[1], final):
        raise SnapshotError(f"{s.staging} can't be moved to {s.final}")


def write_json(spark: SparkSession, path: str, payload: dict) -> None:
    fs, p = filesystem(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(payload, indent=2, sort_keys=True).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        raise SnapshotFileMissingError(path)
    stream = fs.open(p)
    try:
        text = bytes(stream.readAllBytes())
    finally:
        stream.close()
    return json.loads(text) if text else {}


def manifest(*, dataset: str, date: str, source_url: str, downloaded: datetime, updated: datetime, schema_version: str, sha_raw: str, sha_clean: str, bytes_raw: int, row_counts: dict, artefacts: dict, command_line: str) -> dict:
    found = (dataset, date, source_url, downloaded.isoformat(), updated.isoformat(), schema_version, sha_raw, sha_clean, int(bytes_raw), row_counts, artefacts, os.getenv("GIT_SHA", "").strip() or "unknown", "0.1.0", command_line)
    return dict(zip(MANIFEST, found))


def write_pending(spark: SparkSession, s: Staged, source_url: str, downloaded: datetime, bytes_raw: int) -> None:
    write_json(spark, f"{s.staging}/pending.json", {"snapshot_date": s.date, "source_url": source_url, "downloaded_at_utc": downloaded.isoformat(), "bytes_raw": int(bytes_raw)})


def _marked(spark: SparkSession, root: str, dataset: str, name: str) -> list[tuple[str, int]]:
    fs, p = filesystem(spark, f"{root.rstrip('/')}/{dataset}")
    folders = [s.getPath().toString() for s in (fs.listStatus(p) if fs.exists(p) else []) if s.isDirectory()]
    found = []
    for folder in folders:
        _, mark = filesystem(spark, f"{folder}/{name}")
        if fs.exists(mark):
            found.append((folder, fs.getFileStatus(mark).getModificationTime()))
    return found


def dated(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """The committed snapshots, by date, those of one date by the time of their manifest."""
    found = [(f.rsplit("/", 1)[-1], m, f) for f, m in _marked(spark, root, dataset, "manifest.json") if DATE.fullmatch(f.rsplit("/", 1)[-1])]
    if not found:
        raise SnapshotNotFoundError(f"{dataset} in {root}")
    return [f for *_, f in sorted(found)]


def latest(spark: SparkSession, root: str, dataset: str) -> str:
    """The committed snapshot with the latest date, of these the latest manifest."""
    return dated(spark, root, dataset)[-1]


def latest_file(spark: SparkSession, root: str, dataset: str, name: str) -> str:
    path = f"{latest(spark, root, dataset)}/{name}"
    fs, p = filesystem(spark, path)
    if not fs.exists(p):
        raise SnapshotFileMissingError(path)
    return path


def latest_pending(spark: SparkSession, root: str, dataset: str) -> tuple[Staged, dict] | None:
    """The staged acquisition with the latest date; unreadable states are passed over."""
    found = []
    for folder, modified in _marked(spark, root, dataset, "pending.json"):
        try:
            state = read_json(spark, f"{folder}/pending.json")
            if DATE.fullmatch(state["snapshot_date"]) and datetime.fromisoformat(state["downloaded_at_utc"]).tzinfo and int(state["bytes_raw"]) >= 0:
                found.append((state["snapshot_date"], modified, folder, state))
        except (KeyError, TypeError, ValueError):
            continue
    if not found:
        return None
    date, _, folder, state = max(found, key=lambda x: x[:2])
    return Staged(dataset, date, folder, f"{root.rstrip('/')}/{dataset}/{date}"), state


def discard(spark: SparkSession, s: Staged) -> None:
    """Remove what a failed acquisition left."""
    fs, p = filesystem(spark, s.staging)
    fs.delete(p, True)
