"""The steps as lazy plans, and their artefacts at the edges.

A run of the match step writes its part of each output under run=<id>. The ledger deals ids and
says which runs are finished; outputs are read through it only (see sources.ledger).
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import stored
from tessera.errors import ConfigError, MissingInputError
from tessera.functions import values
from tessera.operators import matching, register, registry, resume, scoring, shortlist
from tessera.operators.scoring import Profile
from tessera.operators.shortlist import GeoFilter
from tessera.sources import bucketed, employees, ledger, profiles, snapshots, tables
from tessera.sources.config import Config

MATCH_INDEX = "match_index"
OUTPUTS = ("candidates", "enriched", "unmatched", "checkpoint")


@dataclass
class Matched:
    """The match step's tables; all hang on one stored ranking."""

    candidates: DataFrame
    enriched: DataFrame
    unmatched: DataFrame
    checkpoint: DataFrame
    ranking: DataFrame

    def release(self) -> None:
        """Delete the ranking; the tables can't be read after that."""
        stored.release(self.ranking)


def match(orgs: DataFrame, clean_registry: DataFrame | matching.Index, min_score: float = matching.MIN_SCORE, max_candidates: int = matching.MAX_CANDIDATES) -> Matched:
    """Variants, blocking, similarity, ranking and acceptance in one plan. The ranked candidates are
    written to the shared folder, as four outputs read them. The first two are in order of names."""
    if isinstance(clean_registry, matching.Index):
        clean_registry = matching.restricted(clean_registry, matching.query_variants(orgs))
    top = stored.stored(matching.top_candidates(orgs, clean_registry, max_candidates), "ranking")
    with_best = matching.best(orgs, top)
    return Matched(
        matching.candidate_rows(top).orderBy("org_name", "rank"), matching.enriched(with_best, clean_registry, min_score).orderBy("org_name"), matching.unmatched(with_best, min_score).orderBy("org_name"),
        orgs.select("org_name").orderBy("org_name"), top,
    )


def score(enriched: DataFrame, profile: Profile, as_of: str, lookup: DataFrame) -> DataFrame:
    return scoring.scored(enriched, profile, F.lit(as_of).cast("date"), lookup)


def _no_employees(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "company_number string, employee_count string, employee_count_source string, employee_count_snapshot_date string")


def _orgs(spark: SparkSession, path: str) -> DataFrame:
    raw = registry.require(tables.read_csv(spark, path), register.OUTPUT, "match")
    c = lambda n: F.col(f"`{n}`")
    return raw.select(c("Organisation Name").alias("org_name"), c("org_name_normalised").alias("org_norm"), "has_multiple_towns", "has_multiple_counties", c("Town/City").alias("town"), c("County").alias("county"), c("Type & Rating").alias("rating"), c("Route").alias("route"), "raw_name_variants")


def register_path(spark: SparkSession, cfg: Config) -> str:
    """The rolled-up register: what run_register wrote, else the latest snapshot's."""
    built = f"{cfg.out_dir}/register"
    return built if tables.exists(spark, built) else snapshots.latest_file(spark, cfg.snapshot_root, "register", "clean.csv")


def write_match_index(companies_: DataFrame, path: str) -> None:
    """The index that matching reads, in buckets: words and their numbers of sets by token, numbers by set of
    words, companies by number. Every join of matching finds the registry's side dealt as it needs it."""
    spark = companies_.sparkSession
    bucketed.write(registry.described(companies_), f"{path}/companies", "company_number")
    made = matching.index(bucketed.read(spark, f"{path}/companies"), matching.PER_PART)
    for name, key in (("postings", "slot"), ("frequency", "token"), ("numbers", "words")):
        bucketed.write(getattr(made, name), f"{path}/{name}", key)


def read_match_index(spark: SparkSession, path: str) -> matching.Index:
    return matching.Index(*(bucketed.read(spark, f"{path}/{n}") for n in ("postings", "frequency", "numbers", "companies")))


def companies(spark: SparkSession, cfg: Config) -> DataFrame | matching.Index:
    """Companies to match with: the given table, the index that run_registry wrote, or the latest snapshot's."""
    if cfg.source_kind != "file":
        raise ConfigError(f"matching takes a file source, not {cfg.source_kind!r}")
    if cfg.registry_path and not cfg.registry_path.lower().endswith((".csv", ".zip")):
        if not tables.exists(spark, cfg.registry_path):
            raise MissingInputError(cfg.registry_path)
        return spark.read.parquet(cfg.registry_path).drop("bucket")
    here = tables.exists(spark, f"{cfg.out_dir}/registry_profiles")
    folder = cfg.out_dir if here else snapshots.latest(spark, cfg.snapshot_root, "registry")
    if tables.exists(spark, f"{folder}/{MATCH_INDEX}"):
        return read_match_index(spark, f"{folder}/{MATCH_INDEX}")
    path = f"{folder}/registry_profiles" if here else snapshots.latest_file(spark, cfg.snapshot_root, "registry", "profiles")
    return spark.read.parquet(path).drop("bucket")


LONG = {"org_name": "Organisation Name", "org_norm": "org_name_normalised", "town": "Town/City", "county": "County", "rating": "Type & Rating", "route": "Route"}


def long_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in LONG.items() if k in df.columns})


def write_register(spark: SparkSession, rows: DataFrame, out: str, stats_path: str, mode: str = "errorifexists") -> tuple[int, int]:
    """The rolled-up register of coerced rows and its statistics; rows before and after."""
    up = register.register(rows).orderBy("org_norm").drop("pos")
    tables.write_csv(long_names(up.withColumns({c: values.text_bool(F.col(c)) for c in ("has_multiple_towns", "has_multiple_counties")})), out, mode)
    counted = register.stats(rows).first().asDict()
    for c in ("town", "county"):
        counted[f"top_{c}"] = [[r[c], r["n_rows"]] for r in register.top_values(register.eligible(rows), c).collect()]
    snapshots.write_json(spark, stats_path, counted)
    return counted["total_rows"], counted["organisations"]


def run_register(spark: SparkSession, cfg: Config) -> str:
    """Raw register -> rolled-up register and its statistics."""
    rows = register.coerce(tables.read_register(spark, cfg.register_path, register.COLUMNS, "pos"), pos="pos")  # a folder's files in order of names
    out = f"{cfg.out_dir}/register"
    write_register(spark, rows, out, f"{cfg.out_dir}/register_stats.json", "overwrite")
    return out


def run_registry(spark: SparkSession, cfg: Config) -> tuple[str, str]:
    """Bulk registry -> clean table, token index, profiles (one row per company with what matching reads of its
    names, so that no match run takes them apart again) and the match step's own index."""
    zipped = cfg.registry_path.lower().endswith(".zip")
    raw = tables.read_zip(spark, cfg.registry_path, f"{cfg.out_dir}/staging", "pos") if zipped else tables.read_csv(spark, cfg.registry_path, na_cells=False, position="pos")
    out, index = f"{cfg.out_dir}/registry", f"{cfg.out_dir}/registry_index"
    registry.clean(registry.require(raw, registry.BULK.values(), "registry")).write.mode("errorifexists").parquet(out)
    rows = spark.read.parquet(out)
    tables.write_index(registry.token_index(rows), index)
    tables.write_profiles(registry.companies(rows).drop("pos"), f"{cfg.out_dir}/registry_profiles")
    write_match_index(spark.read.parquet(f"{cfg.out_dir}/registry_profiles").drop("bucket"), f"{cfg.out_dir}/{MATCH_INDEX}")
    return out, index


def done(spark: SparkSession, out_dir: str, orgs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The organisations that finished runs have matched, and the ids of these runs."""
    ids = [r.id for r in ledger.runs(spark, out_dir)]
    return (ledger.rows_of(spark, out_dir, "checkpoint", ids) if ids else orgs.limit(0)).select("org_name"), tuple(ids)


def write_run(got: Matched, out_dir: str, run: str) -> None:
    """A claimed run's part of each output. Only its claimant writes there, so what is there is an error."""
    for name in OUTPUTS:
        getattr(got, name).write.mode("error").parquet(f"{out_dir}/{name}/run={run}")


def add_run(orgs: DataFrame, companies_: DataFrame, out_dir: str, key: str, saw: tuple[str, ...], min_score: float = matching.MIN_SCORE, max_candidates: int = matching.MAX_CANDIDATES, **inputs) -> str:
    """Match organisations and add them to the outputs as one run, whole or not at all."""
    spark = orgs.sparkSession
    id_ = ledger.claim(spark, out_dir, key)
    orgs = resume.keep_first(orgs, ["org_name"], [F.col(c) for c in orgs.columns if c != "org_name"])
    got = match(orgs, companies_, min_score, max_candidates)
    try:
        write_run(got, out_dir, id_)
    finally:
        got.release()
    ledger.finish(spark, out_dir, ledger.Run(id_, key, saw, inputs=inputs))
    return id_


ORDER = {"candidates": ("org_name", "rank"), "enriched": ("org_name",), "unmatched": ("org_name",), "checkpoint": ("org_name",)}


def output(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """An output of the match step over all finished runs, in its order."""
    return ledger.read(spark, out_dir, name).orderBy(*ORDER[name])


def _range(first: int, count: int) -> dict | None:
    return {"start": first, "end": first + count - 1} if count else None


def run_match(spark: SparkSession, cfg: Config, resume_run: bool = True) -> dict:
    """Match what no earlier run has matched, or all again (which replaces what earlier runs say of the same
    organisations and leaves others), add the outputs, report what was done."""
    started, clock = datetime.now(UTC), time.monotonic()
    source = register_path(spark, cfg)
    orgs = _orgs(spark, source)
    matched, saw = done(spark, cfg.out_dir, orgs) if resume_run else (orgs.select("org_name").limit(0), ())
    matched = resume.processed(matched)
    counted = resume.counters(orgs, matched, cfg.batch_size).first().asDict()
    overall = -(-counted["total_rows"] // cfg.batch_size)
    report = {
        "status": "complete", "error_message": "", "register_path": source, "out_dir": cfg.out_dir, "run_started_at_utc": started.isoformat(), "batch_size": cfg.batch_size, "batch_start": cfg.batch_start, "batch_count": cfg.batch_count,
        "total_register_orgs": counted["total_rows"], "total_unprocessed_at_start": counted["unprocessed"], "total_batches_at_start": counted["batches"], "total_batches_overall": overall,
        "resume_command": f"python -m tessera.cli build match --out-dir {cfg.out_dir} --batch-size {cfg.batch_size}",
    }
    selected = max(0, counted["batches"] - cfg.batch_start + 1)
    selected = selected if cfg.batch_count is None else min(selected, cfg.batch_count)
    before = overall - counted["batches"]
    report |= {"selected_batches": selected, "batch_range": _range(cfg.batch_start, selected), "overall_batch_range": _range(before + cfg.batch_start, selected)}
    in_run, failed = 0, None
    try:
        part = stored.stored(resume.batches(resume.pending(orgs, matched), ["org_name"], cfg.batch_size, cfg.batch_start, cfg.batch_count).drop("place", "batch"), "part")
        in_run = part.count()
        if in_run or not ledger.runs(spark, cfg.out_dir):
            add_run(part, companies(spark, cfg), cfg.out_dir, f"match {started.isoformat()}", saw, cfg.min_match_score, cfg.max_candidates, register=source, organisations=counted["total_rows"])
        stored.release(part)
    except BaseException as e:
        failed, in_run = e, 0
        report |= {"status": "interrupted" if isinstance(e, KeyboardInterrupt) else "error", "error_message": str(e)[:1000]}
    ended = datetime.now(UTC)
    total = resume.processed(done(spark, cfg.out_dir, orgs)[0]).count()
    report |= {
        "processed_in_run": in_run, "processed_total": total, "remaining": counted["remaining"] - in_run, "generated_at_utc": ended.isoformat(), "run_finished_at_utc": ended.isoformat(),
        "run_duration_seconds": round(time.monotonic() - clock, 3),
    }
    snapshots.write_json(spark, f"{cfg.out_dir}/resume_report.json", report)
    if failed is not None:
        raise failed
    return report


def compact(spark: SparkSession, cfg: Config) -> str:
    """Put all finished runs, such as a stream's many batches, into one; delete what no reader needs."""
    made = ledger.compact(spark, cfg.out_dir, OUTPUTS)
    gone = ledger.sweep(spark, cfg.out_dir, OUTPUTS)
    return f"run {made.id if made else 'none'}, deleted {gone}"


def run_score(spark: SparkSession, cfg: Config) -> str:
    rows = ledger.read(spark, cfg.out_dir, "enriched")
    scoring.check_scores(rows)
    catalogue, default = profiles.load(spark, cfg.profile_path or None)
    lookup = employees.load(spark, cfg.employees_path) if cfg.employees_path else _no_employees(spark)
    as_of = cfg.as_of or spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").first()[0]
    out = f"{cfg.out_dir}/scored"
    scoring.order_scored(score(rows, profiles.resolve(catalogue, default, cfg.profile_name), as_of, lookup)).write.mode("overwrite").parquet(out)
    return out


def run_shortlist(spark: SparkSession, cfg: Config) -> str:
    rows = spark.read.parquet(f"{cfg.out_dir}/scored")
    known = shortlist.locations(snapshots.read_json(spark, cfg.aliases_path)) if cfg.aliases_path else []
    place = shortlist.geo_filter(cfg.region or None, cfg.postcodes, known) if cfg.region or cfg.postcodes else GeoFilter()
    kept = scoring.order_scored(shortlist.shortlist(rows, cfg.score_threshold, cfg.min_employees, cfg.include_unknown_size, place))
    out = f"{cfg.out_dir}/shortlist"
    tables.write_csv(long_names(kept), out)
    tables.write_csv(long_names(shortlist.explain(kept)), f"{cfg.out_dir}/shortlist_explain")
    return out


def run_pipeline(spark: SparkSession, cfg: Config, resume_run: bool = True) -> str:
    """match -> score -> shortlist."""
    run_match(spark, cfg, resume_run)
    run_score(spark, cfg)
    return run_shortlist(spark, cfg)
