"""Command line: python -m tessera.cli <group> <command>, or search."""

from __future__ import annotations

import argparse
import shlex
import sys

from pyspark.sql import SparkSession

from tessera.errors import NotAvailableError, PipelineError
from tessera.logs import progress
from tessera.operators import shortlist
from tessera.plans import refresh, steps, validate
from tessera.sources import config, http, snapshots

VERSION = "0.2.0"
BUILD = {"register": steps.run_register, "registry": steps.run_registry, "match": steps.run_match, "score": steps.run_score, "shortlist": steps.run_shortlist, "compact": steps.compact, "all": steps.run_pipeline}
#: Commands of earlier releases and what to call instead.
RENAMED = {"extract": "refresh register", "transform-register": "build register", "transform-enrich": "build match", "transform-score": "build score", "usage-shortlist": "build shortlist", "run-all": "build all"}
#: Settings of this session for inputs of any size: small tables keep all cores busy, large ones are
#: split by measured sizes.
SESSION = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k", "spark.sql.session.timeZone": "UTC"}


def _settings(p: argparse.ArgumentParser) -> None:
    p.add_argument("--config", help="a TOML file with [tessera]")
    for name in ("snapshot-root", "register-path", "registry-path", "employees-path", "out-dir", "profile-path", "profile-name", "aliases-path", "region", "postcodes", "as-of"):
        p.add_argument(f"--{name}")
    for name in ("max-candidates", "min-employees", "batch-size", "batch-start", "batch-count"):
        p.add_argument(f"--{name}", type=int)
    for name in ("min-match-score", "score-threshold"):
        p.add_argument(f"--{name}", type=float)
    p.add_argument("--include-unknown-size", action="store_const", const=True)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("--version", action="version", version=VERSION)
    groups = p.add_subparsers(dest="group", required=True)

    def group(name: str, commands, about: str) -> dict[str, argparse.ArgumentParser]:
        inner = groups.add_parser(name, help=about).add_subparsers(dest="command", required=True)
        made = {c: inner.add_parser(c) for c in commands}
        for m in made.values():
            _settings(m)
        return made

    for m in group("refresh", refresh.ARTEFACTS, "acquire and clean a dataset as a dated snapshot").values():
        m.add_argument("--source", help="a file on any file system, or an address")
        m.add_argument("--page", help="a page that links to the source")
        m.add_argument("--url", default="", help="where the page lies, for relative links")
        m.add_argument("--only", choices=["all", "acquire", "clean"], default="all")
    build = group("build", BUILD, "run a step")
    for name in ("match", "all"):
        build[name].add_argument("--no-resume", action="store_true")
    checks = group("validate", ("snapshots", "outputs", "audit", "runs", "resume"), "check what was written")
    checks["runs"].add_argument("--other-dir", required=True, help="outputs of another run over equal inputs")
    for m in group("links", ("csv", "zip"), "find a source on a saved page").values():
        m.add_argument("--page", required=True)
        m.add_argument("--url", default="")
    search = groups.add_parser("search", help="search scored companies")
    _settings(search)
    for name in ("keyword", "sector", "size"):
        search.add_argument(f"--{name}")
    return p


_OWN = ("group", "command", "config", "source", "only", "no_resume", "other_dir", "page", "url", "keyword", "sector", "size")


def _refresh(spark: SparkSession, cfg: config.Config, a: dict) -> str:
    if a["only"] == "clean" and (a["source"] or a["page"]):
        raise NotAvailableError("a source has no meaning with --only clean")
    if a["only"] != "clean":
        if not a["source"] and not a["page"]:
            raise NotAvailableError("--source or --page is needed")
        client = http.Client(http.urllib_transport())
        source = a["source"] or refresh.discover(spark, a["command"], a["page"], a["url"], client)
        staged = refresh.acquire(spark, cfg.snapshot_root, a["command"], source, client)
        if a["only"] == "acquire":
            return staged.staging
    return refresh.clean(spark, cfg.snapshot_root, a["command"], shlex.join(sys.argv))


def _validate(spark: SparkSession, cfg: config.Config, a: dict) -> int:
    wrong: list[str] = []
    if a["command"] == "snapshots":
        wrong = validate.snapshot_errors(spark, cfg.snapshot_root)
    elif a["command"] == "outputs":
        print(validate.check_outputs(spark, cfg.out_dir))
    elif a["command"] == "audit":
        wrong = validate.check_audit(spark, cfg.out_dir)
    elif a["command"] == "runs":
        validate.check_equal_runs(spark, cfg.out_dir, a["other_dir"])
    else:
        validate.check_nothing_left(snapshots.read_json(spark, f"{cfg.out_dir}/resume_report.json"))
    print("\n".join(wrong) or "nothing is wrong")
    return int(bool(wrong))


def run(spark: SparkSession, cfg: config.Config, a: dict) -> int:
    if a["group"] == "refresh":
        print(_refresh(spark, cfg, a))
    elif a["group"] == "build":
        more = {"resume_run": not a["no_resume"]} if a["command"] in ("match", "all") else {}
        print(BUILD[a["command"]](spark, cfg, **more))
    elif a["group"] == "validate":
        return _validate(spark, cfg, a)
    elif a["group"] == "links":
        print(refresh.discover(spark, "registry" if a["command"] == "zip" else "register", a["page"], a["url"]))
    else:
        rows = spark.read.parquet(f"{cfg.out_dir}/scored")
        shortlist.explain(shortlist.search(rows, a["keyword"], a["sector"], cfg.region or None, a["size"])).show(50, False)
    return 0


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    try:
        if argv and argv[0] in RENAMED:
            raise NotAvailableError(f"{argv[0]} is now called {RENAMED[argv[0]]}")
        a = {k: None for k in _OWN} | vars(parser().parse_args(argv))
        cfg = config.load({k: v for k, v in a.items() if k not in _OWN}, a["config"])
        builder = SparkSession.builder.appName(f"tessera {a['group']} {a['command'] or ''}".strip())
        for k, v in SESSION.items():
            builder = builder.config(k, v)
        with progress(" ".join(filter(None, (a["group"], a["command"])))):
            return run(builder.getOrCreate(), cfg, a)
    except PipelineError as e:
        print(f"{type(e).__name__}: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
