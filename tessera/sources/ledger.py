"""The ledger of runs: which of the folders `<output>/run=<id>` hold results.

A run claims an id: a number one above all others, and random digits, as two that claim at once may find
the same number and not every file system creates a file only once. Nobody else ever writes to its folders.
When all its outputs are written, `_runs/<id>.<key>.done` appears in one step, and with it the rows of all
outputs at once. A run that fails leaves its claim without that: its rows are never read, and a repeated
run takes another id. So no run can write over another one's rows, whatever the register, the number
of rows or the way in (batch or stream).

An organisation that several runs have matched belongs to the last of them, in all outputs. Runs that leave out
what they saw done can't overlap; the ledger says of each run which others it saw, and only where that
doesn't settle it a join with the runs' checkpoints decides. compact() puts the rows of many runs, such as
a stream's batches, into one run that takes their place.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import LedgerError, RunExistsError
from tessera.sources import snapshots
from tessera.sources.tables import exists as fs_exists
from tessera.sources.tables import filesystem

FOLDER = "_runs"


@dataclass(frozen=True)
class Run:
    """id; key: what a repeated run of the same work has in common with it; saw: the runs whose
    organisations it left out; replaces: the runs whose rows it holds."""

    id: str
    key: str
    saw: tuple[str, ...] = ()
    replaces: tuple[str, ...] = ()
    inputs: dict = field(default_factory=dict)


def _listed(spark: SparkSession, out_dir: str) -> dict[str, dict[str, tuple[str, str]]]:
    """Claims and finished runs: by id, the file and the digest of its key."""
    fs, p = filesystem(spark, f"{out_dir}/{FOLDER}")
    out: dict[str, dict[str, tuple[str, str]]] = {"claim": {}, "done": {}}
    for s in fs.listStatus(p) if fs.exists(p) else []:
        id_, *digest, kind = s.getPath().getName().split(".")
        if kind in out and id_:
            out[kind][id_] = (s.getPath().toString(), "".join(digest))
    return {k: dict(sorted(v.items())) for k, v in out.items()}


def _digest(key: str) -> str:
    return hashlib.sha256(key.encode()).hexdigest()[:16]


def _claim_path(out_dir: str, id_: str) -> str:
    return f"{out_dir}/{FOLDER}/{id_}.claim"


def _run(spark: SparkSession, path: str) -> Run:
    x = snapshots.read_json(spark, path)
    return Run(x["id"], x["key"], tuple(x["saw"]), tuple(x["replaces"]), x["inputs"])


def claim(spark: SparkSession, out_dir: str, key: str = "") -> str:
    """An id that no other run has or had, in order after all that are there."""
    last = max(_listed(spark, out_dir)["claim"], default="r-")
    id_ = f"r{int(last[1:].partition('-')[0] or -1) + 1:010d}-{uuid.uuid4().hex[:12]}"
    snapshots.write_json(spark, _claim_path(out_dir, id_), {"key": key})
    return id_


def finish(spark: SparkSession, out_dir: str, run: Run) -> None:
    """Make a run's rows readable, all at once."""
    if not fs_exists(spark, _claim_path(out_dir, run.id)):
        raise LedgerError(f"run {run.id} of {out_dir} was never claimed")
    final = f"{out_dir}/{FOLDER}/{run.id}.{_digest(run.key)}.done"
    fs, p = filesystem(spark, final)
    if run.id in _listed(spark, out_dir)["done"]:
        raise RunExistsError(final)
    written = f"{out_dir}/{FOLDER}/.tmp-{uuid.uuid4().hex}"
    snapshots.write_json(spark, written, asdict(run))
    if not fs.rename(filesystem(spark, written)[1], p):
        raise LedgerError(f"{written} can't be moved to {final}")


def runs(spark: SparkSession, out_dir: str) -> list[Run]:
    """Finished runs whose rows count, by id."""
    found = [_run(spark, path) for path, _ in _listed(spark, out_dir)["done"].values()]
    gone = {n for r in found for n in r.replaces}
    return [r for r in found if r.id not in gone]


def finished(spark: SparkSession, out_dir: str, key: str) -> bool:
    """Whether a run with this key has finished, replaced or not."""
    return any(d == _digest(key) for _, d in _listed(spark, out_dir)["done"].values())


def folders(out_dir: str, name: str, ids: list[str]) -> list[str]:
    return [f"{out_dir}/{name}/run={n}" for n in ids]


def rows_of(spark: SparkSession, out_dir: str, name: str, ids: list[str]) -> DataFrame:
    """Rows of an output as the given runs wrote them, with `run`."""
    if not ids:
        raise LedgerError(f"no finished run in {out_dir}")
    return spark.read.option("basePath", f"{out_dir}/{name}").parquet(*folders(out_dir, name, ids))


def apart(found: list[Run]) -> bool:
    """Whether no two of these runs can have matched the same organisation: each saw all before it."""
    saw = lambda r, e: e.id in r.saw or (e.replaces and set(e.replaces) <= set(r.saw))
    return all(saw(r, e) for k, r in enumerate(found) for e in found[:k])


def read(spark: SparkSession, out_dir: str, name: str, key: str = "org_name", ledger: str = "checkpoint") -> DataFrame:
    """An output over all finished runs: of each organisation the rows of the last run that matched it."""
    found = runs(spark, out_dir)
    ids = [r.id for r in found]
    rows = rows_of(spark, out_dir, name, ids)
    if apart(found):
        return rows.drop("run")
    last = rows_of(spark, out_dir, ledger, ids).groupBy(key).agg(F.max("run").alias("run"))
    return rows.join(last, [key, "run"], "left_semi").select(*[c for c in rows.columns if c != "run"])


def compact(spark: SparkSession, out_dir: str, names: tuple[str, ...]) -> Run | None:
    """Put the rows of all finished runs into one that replaces them; None where there is one at most."""
    found = runs(spark, out_dir)
    if len(found) < 2:
        return None
    id_ = claim(spark, out_dir, "compact")
    for name in names:
        read(spark, out_dir, name).write.mode("error").parquet(f"{out_dir}/{name}/run={id_}")
    seen = {n for r in found for n in (r.id, *r.saw)}  # runs that finish meanwhile stay beside it
    whole = Run(id_, f"compact {id_}", tuple(sorted(seen)), tuple(sorted({n for r in found for n in (r.id, *r.replaces)})))
    finish(spark, out_dir, whole)
    return whole


def sweep(spark: SparkSession, out_dir: str, names: tuple[str, ...], older_than_hours: float = 48.0) -> list[str]:
    """Delete the folders of runs that were claimed so long ago and never finished, and of replaced runs; their
    ids. The claims stay, so that numbers go on."""
    listed, now = _listed(spark, out_dir), time.time()
    kept = {r.id for r in runs(spark, out_dir)}
    gone = []
    for id_, (path, _) in listed["claim"].items():
        fs, p = filesystem(spark, path)
        age = (now - fs.getFileStatus(p).getModificationTime() / 1000) / 3600
        if id_ in kept or (id_ not in listed["done"] and age < older_than_hours):
            continue
        if any([fs.delete(filesystem(spark, f)[1], True) for name in names for f in folders(out_dir, name, [id_])]):
            gone.append(id_)
    return gone
