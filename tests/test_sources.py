import json
import random
import zipfile
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tessera import cli, errors
from tessera.operators import register, registry
from tessera.operators import audit, matching
from tessera.plans import refresh, steps, validate
from tessera.sources import archives, bucketed, cache, companies, config, employees, http, ledger, payloads, profiles, records, snapshots, tables
from tessera.streaming import microbatch


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿ name,x \r\n"A ""q"" Ltd",N/A\r\nB,"1\n2"\r\n'.encode())
    got = [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "a.csv")).collect()]
    assert got == [('A "q" Ltd', ""), ("B", "1\n2")]
    assert tables.read_csv(spark, str(tmp_path / "a.csv"), na_cells=False).first()["x"] == "N/A"
    assert tables.newest_csv(spark, str(tmp_path)).endswith("a.csv")
    with pytest.raises(errors.MissingInputError):
        tables.newest_csv(spark, str(tmp_path / "none"))
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("d.csv", "a,b\n1,2\n")
    assert tuple(tables.read_zip(spark, str(tmp_path / "z.zip"), str(tmp_path / "st")).first()) == ("1", "2")
    df = tables.read_csv(spark, str(tmp_path / "a.csv"))
    tables.write_csv(df, str(tmp_path / "o"), columns=("x", "name", "y"))
    tables.append_csv(df, str(tmp_path / "o"), columns=("x", "name", "y"))
    assert tables.read_csv(spark, str(tmp_path / "o")).count() == 4
    import hashlib

    assert tables.file_digest(spark, str(tmp_path / "a.csv")) == hashlib.sha256((tmp_path / "a.csv").read_bytes()).hexdigest()
    (tmp_path / "plain.csv").write_text("a,b\n" + "".join(f'{i},"x ""{i}"""\n' for i in range(500)))
    assert not tables.quoted_breaks(spark, str(tmp_path / "plain.csv")) and tables.quoted_breaks(spark, str(tmp_path / "a.csv"))
    got = tables.read_csv(spark, str(tmp_path / "plain.csv"), position="pos").orderBy("pos").collect()
    assert [r["a"] for r in got] == [str(i) for i in range(500)] and got[7]["b"] == 'x "7"'
    digest = tables.table_digest(df)
    assert digest == tables.table_digest(df.repartition(3).select("x", "name")) != tables.table_digest(df.union(df))
    assert tables.copy(spark, str(tmp_path / "plain.csv"), str(tmp_path / "c/copy.csv")) == (tmp_path / "plain.csv").stat().st_size
    with pytest.raises(errors.MissingInputError):
        tables.unzip(spark, str(tmp_path / "plain.csv"), str(tmp_path / "u.csv"))


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    now = datetime(2026, 2, 7, 1, tzinfo=UTC)
    assert snapshots.date_of("x-2026-02-06.csv", now) == "2026-02-06" and snapshots.date_of("x", now) == "2026-02-07"
    with pytest.raises(errors.SnapshotError):
        snapshots.date_of("x", datetime(2026, 1, 1))
    with pytest.raises(errors.SnapshotNotFoundError):
        snapshots.latest(spark, root, "employee_count")
    s = snapshots.start(spark, root, "employee_count", "2026-02-06")
    snapshots.write_pending(spark, s, "http://x", now, 3)
    assert snapshots.latest_pending(spark, root, "employee_count")[0].staging.endswith(s.staging.rsplit("/", 1)[1])
    d = tmp_path / "employee_count" / s.staging.rsplit("/", 1)[1]
    (d / "clean.csv").write_text("company_number,employee_count,employee_count_source,employee_count_snapshot_date\n1,0012,s,2026-02-06\n")
    m = snapshots.manifest(dataset="employee_count", date="2026-02-06", source_url="u", downloaded=now, updated=now, schema_version="employee_count_v1", sha_raw="", sha_clean="", bytes_raw=1, row_counts={"raw": 1, "clean": 1}, artefacts={"raw": "raw.csv", "clean": "clean.csv"}, command_line="t")
    snapshots.write_json(spark, f"{s.staging}/manifest.json", m)
    snapshots.commit(spark, s)
    assert snapshots.latest(spark, root, "employee_count").endswith("2026-02-06")
    with pytest.raises(errors.SnapshotExistsError):
        snapshots.start(spark, root, "employee_count", "2026-02-06")
    assert employees.load(spark, root).first()["employee_count"] == "12"
    assert validate.snapshot_errors(spark, root, ("employee_count",)) == ["employee_count: raw.csv is missing", "employee_count: artefacts.manifest is missing"]
    assert validate.snapshot_errors(spark, root, ("register",)) != []
    with pytest.raises(errors.SnapshotFileMissingError):
        snapshots.latest_file(spark, root, "employee_count", "none.csv")


def bulk(tmp_path, rows, name="bulk-2026-02-01.csv"):
    heads = list(registry.BULK.values())
    (tmp_path / name).write_text(",".join(f" {h}" for h in heads) + "\n" + "".join(",".join((BULK | r).get(h, "") for h in heads) + "\n" for r in rows))
    return str(tmp_path / name)


def test_refresh(spark, tmp_path):
    root = str(tmp_path / "snapshots")
    other = {"CompanyName": "BETA LTD", "CompanyNumber": "22222222", "URI": "http://x.example/company/22222222"}
    source = bulk(tmp_path, [{}, {"CompanyName": "LATER LTD"}, other])
    with pytest.raises(errors.PendingNotFoundError):
        refresh.clean(spark, root, "registry")
    staged = refresh.acquire(spark, root, "registry", source)
    assert staged.date == "2026-02-01" and snapshots.latest_pending(spark, root, "registry")[1]["bytes_raw"] > 0
    final = refresh.clean(spark, root, "registry", "by hand")
    m = snapshots.read_json(spark, f"{final}/manifest.json")
    assert m["row_counts"] == {"raw": 3, "clean": 3} and m["command_line"] == "by hand" and len(m["sha256_hash_raw"]) == 64 and snapshots.latest_pending(spark, root, "registry") is None
    assert validate.snapshot_errors(spark, root, ("registry",)) == []
    got = {r["company_number"]: r for r in spark.read.parquet(f"{final}/profiles").collect()}
    assert got["11111111"]["company_name"] == "ACME SOFTWARE LTD" and got["11111111"]["title_tokens"] == ["acme", "later", "software"] and len(got) == 2
    with pytest.raises(errors.SnapshotExistsError):
        refresh.refresh(spark, root, "registry", source)
    with zipfile.ZipFile(tmp_path / "bulk-2026-03-01.zip", "w") as z:
        z.write(bulk(tmp_path, [other], "inner.csv"), "inner.csv")
    final = refresh.refresh(spark, root, "registry", str(tmp_path / "bulk-2026-03-01.zip"))
    assert final.endswith("2026-03-01") and snapshots.latest(spark, root, "registry").endswith("2026-03-01")
    bad = bulk(tmp_path, [{"URI": "http://x.example/company/9"}], "bulk-2026-04-01.csv")
    with pytest.raises(Exception, match="differ"):
        refresh.refresh(spark, root, "registry", bad)
    assert snapshots.latest(spark, root, "registry").endswith("2026-03-01") and snapshots.latest_pending(spark, root, "registry") is not None
    with pytest.raises(errors.MissingInputError):
        refresh.acquire(spark, root, "register", str(tmp_path / "none.csv"))
    assert snapshots.latest_pending(spark, root, "register") is None
    client = http.Client(lambda url, timeout: http.Response(200, {}, iter([b"Organisation Name,Town/City,County,", b"Type & Rating,Route\nAcme Ltd,York,,A rating,Skilled Worker\n"])), pace=http.Pace(0, 0))
    final = refresh.refresh(spark, root, "register", "http://x.example/list-2026-02-02.csv", client)
    assert tables.read_csv(spark, f"{final}/clean.csv").first()["org_name_normalised"] == "acme" and validate.snapshot_errors(spark, root, ("register",)) == []
    (tmp_path / "counts.csv").write_text("company_number,employee_count,employee_count_source,employee_count_snapshot_date\n1,0012,s,2026-02-06\n")
    refresh.refresh(spark, root, "employee_count", str(tmp_path / "counts.csv"))
    assert validate.snapshot_errors(spark, root) == [] and employees.load(spark, root).first()["employee_count"] == "12"


def test_profiles():
    catalogue, default = profiles.SHIPPED, profiles.DEFAULT
    assert profiles.resolve(catalogue, default).name == "tech" and profiles.resolve(catalogue, default, "care_support").name == "care_support"
    with pytest.raises(errors.ProfileError):
        profiles.resolve(catalogue, default, "x")
    p = {"name": "t", "job_type": "j", "sector_signals": {}, "location_signals": {}, "size_signals": {" a ": -1}, "sic_positive_prefixes": {"62": 0.5}, "sic_negative_prefixes": {"86": -0.2}, "keyword_positive": ["a"], "keyword_negative": [], "keyword_weights": {"positive_per_match": 0.05, "positive_cap": 0.1, "negative_per_match": 0.05, "negative_cap": 0.1}, "company_status_scores": {"active": 0.1, "inactive": 0}, "company_age_scores": {"unknown": 0.05, "bands": [{"min_years": 2, "score": 0.1}, {"min_years": 0, "score": 0.0}]}, "company_type_weights": {}, "bucket_thresholds": {"strong": 0.5, "possible": 0.3}}
    got, name = profiles.parse({"schema_version": 1, "default_profile": "t", "profiles": [p]})
    assert got[name].sic_positive == {"62": 0.5} and got[name].signals["size_signals"] == {"a": -1.0}
    fine = {"keyword_positive": [" Cloud "], "company_status_scores": {"active": 1, "inactive": -1}, "sic_positive_prefixes": {"62": -0.5}, "company_type_weights": {"ltd": -1}, "company_age_scores": {"unknown": -0.5, "bands": [{"min_years": 2, "score": -1}, {"min_years": 2, "score": 0.0}]}}
    assert profiles.parse({"schema_version": 1, "default_profile": " t ", "profiles": [p | fine]})[0]["t"].keyword_positive == ("cloud",)
    for wrong in ({"schema_version": 2}, {"schema_version": True}, {"profiles": []}, {"profiles": [p, p]}, {"default_profile": "u"}, {"more": 1}):
        with pytest.raises(errors.ProfileError):
            profiles.parse({"schema_version": 1, "default_profile": "t", "profiles": [p]} | wrong)
    nested = ({"keyword_weights": p["keyword_weights"] | {"x": 1}}, {"keyword_positive": [" "]}, {"keyword_positive": "a"}, {"sector_signals": {" ": 0}}, {"company_age_scores": {"unknown": 0, "bands": []}}, {"company_age_scores": {"unknown": 0, "bands": [{"min_years": -1, "score": 0}]}}, {"job_type": 3}, {"bucket_thresholds": {"strong": 0.5}})
    for wrong in nested:
        with pytest.raises(errors.ProfileError):
            profiles.parse({"schema_version": 1, "default_profile": "t", "profiles": [p | wrong]})
    lacking = dict(p)
    del lacking["job_type"]
    with pytest.raises(errors.ProfileError, match="missing keys"):
        profiles.parse({"schema_version": 1, "default_profile": "t", "profiles": [lacking]})
    for wrong in ({"name": ""}, {"extra": 1}, {"sic_positive_prefixes": {"62": 1.5}}, {"bucket_thresholds": {"strong": 0.3, "possible": 0.3}}, {"company_age_scores": {"unknown": 0, "bands": [{"min_years": 0, "score": 0}, {"min_years": 2, "score": 0}]}}):
        with pytest.raises(errors.ProfileError):
            profiles.parse({"schema_version": 1, "default_profile": "t", "profiles": [p | wrong]})


def test_config(tmp_path):
    (tmp_path / "c.toml").write_text('[tessera]\nscore_threshold = 0.4\npostcodes = ["M", "EC"]\n')
    c = config.load({"batch_size": 10, "region": None}, str(tmp_path / "c.toml"), {"TESSERA_SCORE_THRESHOLD": "0.3", "TESSERA_REGION": "x", "TESSERA_INCLUDE_UNKNOWN_SIZE": "yes"})
    assert (c.score_threshold, c.postcodes, c.batch_size, c.region, c.include_unknown_size) == (0.4, ("M", "EC"), 10, "x", True)
    (tmp_path / "d.toml").write_text("[tessera]\nnope = 1\n")
    for k, text in enumerate(("schema_version = 2\n", '[tessera]\nregion = " "\n', "[tessera]\nbatch_size = 0\n", '[tessera]\nregion = "a,b"\n', '[tessera]\nsource_kind = "x"\n', "[other]\n", "[tessera\n")):
        (tmp_path / f"e{k}.toml").write_text(text)
        with pytest.raises(errors.ConfigError):
            config.load({}, str(tmp_path / f"e{k}.toml"), {})
    for bad in (lambda: config.load({}, str(tmp_path / "d.toml"), {}), lambda: config.load({}, None, {"TESSERA_BATCH_SIZE": "x"}), lambda: config.load({}, None, {"TESSERA_INCLUDE_UNKNOWN_SIZE": "maybe"})):
        with pytest.raises(errors.ConfigError):
            bad()


def _small_splits(spark, n):
    return {"spark.sql.files.maxPartitionBytes": str(n), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "64"}


@pytest.mark.parametrize("size, end", [(64, "\n"), (300, "\r\n"), (1 << 20, "\n")])
def test_quoted_breaks_in_many_tasks(spark, tmp_path, size, end):
    """Records over many splits equal those of Spark's reader of whole files, whatever the cells hold."""
    rng = random.Random(size)
    bits = ["a", "bc", '"', ",", "\n", '""', " ", "é", "\n\n", ',"', "x" * 90, 'say ""hi""']
    for f in range(3):
        rows = [f"id,note,more{end}"]
        for k in range(120):
            cells = ["".join(rng.choices(bits, k=rng.randrange(6))) for _ in range(2)]
            cells = [rng.choice(['"' + c.replace('"', '""') + '"', c.translate(str.maketrans("", "", '",\n')), '5" pipe']) for c in cells]
            rows.append(f"{f}-{k},{cells[0]},{cells[1]}{end}" + (end if rng.random() < 0.1 else ""))
        (tmp_path / f"f{f}.csv").write_text("".join(rows), newline="")
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path)).fillna("").collect()
    kept = {k: spark.conf.get(k, None) for k in _small_splits(spark, size)}
    for k, v in _small_splits(spark, size).items():
        spark.conf.set(k, v)
    try:
        df = tables.read_csv(spark, str(tmp_path), na_cells=False, position="pos")
        got, tasks = df.collect(), records.lines(spark, str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((r["id"], r["note"], r["more"]) for r in got) == sorted(tuple(r) for r in want)
    order = [r["id"] for r in sorted(got, key=lambda r: r["pos"])]
    assert order == [f"{f}-{k}" for f in range(3) for k in range(120)] and tasks > (20 if size < 1000 else 0)


def test_archive_members_in_tasks_of_their_own(spark, tmp_path):
    rows = {f"m{k}.CSV": "id,note\r\n" + "".join(f'{k}-{i},"a\n""b"" {i}"\r\n' for i in range(50 * (k + 1))) for k in range(4)}
    for name, method in (("a.zip", zipfile.ZIP_DEFLATED), ("b.zip", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(tmp_path / name, "w", method) as z:
            z.writestr("folder/", "")
            z.writestr("read.me", "x")
            for member, text in rows.items():
                z.writestr(member, text)
    lines = archives.zip_lines(spark, str(tmp_path / "a.zip"))
    assert lines.rdd.getNumPartitions() == 4 and lines.count() == sum(t.count("\n") for t in rows.values())
    every = tables.read_zip(spark, str(tmp_path), str(tmp_path / "staging"), every=True).collect()
    assert sorted((r["id"], r["note"]) for r in every) == sorted(2 * [(f"{k}-{i}", f'a\n"b" {i}') for k in range(4) for i in range(50 * (k + 1))])
    first = tables.read_zip(spark, f"file:{tmp_path}/b.zip", str(tmp_path / "staging"), position="pos")
    assert [r["id"] for r in first.orderBy("pos").collect()] == [f"0-{i}" for i in range(50)]
    assert archives.reachable("hdfs://x/a.zip") and archives.reachable("/a:b.zip") and not archives.reachable("viewfs://store/a.zip")
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(errors.MissingInputError):
        tables.read_zip(spark, str(tmp_path / "none.zip"), str(tmp_path / "staging"))


@pytest.mark.parametrize("store", ["file:", "viewfs://archives/in"])
def test_every_member_in_any_store(spark, tmp_path, store):
    names = ["a.csv", "a.csv", "B.CSV", "c.csv"]  # two of the same name
    want = []
    for name, method in (("x.zip", zipfile.ZIP_DEFLATED), ("y y.zip", zipfile.ZIP_STORED)):
        with zipfile.ZipFile(tmp_path / name, "w", method) as z:
            z.writestr("folder/", "")
            z.writestr("read.me", "x\n" * 99)
            for k, member in enumerate(names):
                rows = [(f"{name}-{k}-{i}", f'a\n"b", {i}\r\n' * (i % 7)) for i in range(40 * (k + 1))]
                with pytest.warns(UserWarning) if k == 1 else nullcontext():
                    z.writestr(member, "id,note\r\n" + "".join('{},"{}"\r\n'.format(i, n.replace('"', '""')) for i, n in rows))
                want += rows
    root = f"{store}{tmp_path}"
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.archives.link./in", "file:///")
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.maxRecordsPerFile")}
    try:
        for k, v in zip(kept, ("999", "0", "50")):
            spark.conf.set(k, v)
        got = tables.read_zip(spark, root, f"{root}/staging", every=True).collect()
        one = tables.read_zip(spark, f"{root}/y y.zip", f"{root}/staging", "pos", every=True).orderBy("pos").collect()
        first = tables.read_zip(spark, f"{root}/x.zip", f"{root}/staging", "pos").orderBy("pos").collect()
        dealt = archives.spark_lines(spark, root)
        assert dealt.rdd.getNumPartitions() == 8 and sorted(map(tuple, dealt.select("value").collect())) == sorted(map(tuple, archives.zip_lines(spark, str(tmp_path)).select("value").collect()))
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted((r["id"], r["note"]) for r in got) == sorted(want)
    assert [r["id"] for r in one] == [i for i, _ in want if i.startswith("y")] and [r["id"] for r in first] == [i for i, _ in want if i.startswith("x.zip-0-")]
    with zipfile.ZipFile(tmp_path / "none.zip", "w") as z:
        z.writestr("a.txt", "x")
    with pytest.raises(errors.MissingInputError):
        tables.read_zip(spark, f"{root}/none.zip", f"{root}/staging")
    bad = (tmp_path / "y y.zip").read_bytes().replace(b"y y.zip-2-7,", b"y y.zip-2-8,")
    (tmp_path / "none.zip").write_bytes(bad)
    with pytest.raises(Exception, match="CRC-32"):
        tables.read_zip(spark, f"{root}/none.zip", f"{root}/staging", every=True)


def test_states_between_lines():
    after = records.inside_after
    assert not after('5" pipe,3', False) and after('a,"b', False) and after('"b""', False) and not after('"b"x,c', False)
    assert after("no quote", True) and not after('end"', True) and after('end","again', True) and not after('end"",more",', True) and after('""', True)


BULK = {"CompanyName": "ACME SOFTWARE LTD", "CompanyNumber": "11111111", "CompanyCategory": "ltd", "CompanyStatus": "Active", "IncorporationDate": "01/01/2015", "SICCode.SicText_1": "62020 - IT", "RegAddress.PostTown": "London", "RegAddress.County": "Greater London", "RegAddress.PostCode": "EC1", "URI": "http://x.example/company/11111111"}


def test_end_to_end(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "r.csv").write_text(",".join(register.COLUMNS) + "\nAcme Software Ltd,London,Greater London,A rating,Skilled Worker\nUnknown Thing,York,,A rating,Skilled Worker\n")
    heads = list(registry.BULK.values())
    (tmp_path / "b.csv").write_text(",".join(f" {h}" for h in heads) + "\n" + ",".join(BULK.get(h, "") for h in heads) + "\n")
    cfg = config.Config(register_path=str(raw), registry_path=str(tmp_path / "b.csv"), out_dir=str(tmp_path / "out"), as_of="2026-02-10")
    steps.run_register(spark, cfg)
    clean, index = steps.run_registry(spark, cfg)
    assert tables.read_index(spark, index).count() == 2
    cfg = config.Config(**{**cfg.__dict__, "registry_path": clean})
    steps.run_pipeline(spark, cfg)
    got = tables.read_csv(spark, f"{cfg.out_dir}/shortlist").collect()
    assert [r["Organisation Name"] for r in got] == ["Acme Software Ltd"]
    assert validate.check_outputs(spark, cfg.out_dir) == "complete" and validate.check_audit(spark, cfg.out_dir) == []
    assert validate.check_audit(spark, cfg.out_dir, audit.Thresholds(max_near=-1)) != []
    first = snapshots.read_json(spark, f"{cfg.out_dir}/resume_report.json")
    assert (first["processed_in_run"], first["remaining"], first["batch_range"], first["selected_batches"]) == (2, 0, {"start": 1, "end": 1}, 1)
    with pytest.raises(errors.ResumeError):
        validate.check_nothing_left(first)
    again = steps.run_match(spark, cfg)
    assert (again["processed_in_run"], again["remaining"], again["batch_range"]) == (0, 0, None)
    validate.check_nothing_left(again)
    assert json.loads(spark.read.text(f"{cfg.out_dir}/register_stats.json", wholetext=True).first()[0])["organisations"] == 2
    other = config.Config(**{**cfg.__dict__, "out_dir": str(tmp_path / "other"), "registry_path": f"{cfg.out_dir}/registry_profiles", "batch_size": 1, "batch_count": 1})
    steps.run_register(spark, other)
    left = steps.run_match(spark, other)
    assert (left["processed_in_run"], left["remaining"], left["overall_batch_range"]) == (1, 1, {"start": 1, "end": 1})
    with pytest.raises(errors.NotDeterministicError):
        validate.check_equal_runs(spark, cfg.out_dir, other.out_dir)
    assert steps.run_match(spark, other)["overall_batch_range"] == {"start": 2, "end": 2}
    validate.check_equal_runs(spark, cfg.out_dir, other.out_dir)
    broken = config.Config(**{**other.__dict__, "registry_path": str(tmp_path / "nothing"), "out_dir": str(tmp_path / "broken")})
    steps.run_register(spark, broken)
    with pytest.raises(errors.MissingInputError):
        steps.run_match(spark, broken)
    assert snapshots.read_json(spark, f"{broken.out_dir}/resume_report.json")["status"] == "error"
    with pytest.raises(errors.OutputError):
        validate.check_outputs(spark, broken.out_dir)
    with pytest.raises(errors.OutputError):
        validate.check_report(again | {"status": "fine"})
    q = microbatch.match_stream(spark, str(raw), clean, str(tmp_path / "stream"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert q.exception() is None and steps.output(spark, str(tmp_path / "stream"), "enriched").count() == 1


@pytest.mark.parametrize("stops_after", ["candidates", "checkpoint"])
def test_crash_between_writes(spark, tmp_path, monkeypatch, stops_after):
    """A batch that fails after any of its writes and is repeated adds nothing twice and loses nothing."""
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "r.csv").write_text(",".join(register.COLUMNS) + "\nAcme Ltd,London,,A rating,Skilled Worker\nUnknown Thing,York,,A rating,Skilled Worker\n")
    clean = str(tmp_path / "clean")
    spark.createDataFrame([("11111111", "ACME LTD", "active", "ltd", "", "", "London", "", "", "")], ", ".join(f"{c} string" for c in registry.CLEAN)).write.parquet(clean)
    write = steps.write_run

    def failing(got, out_dir, run):
        for name in steps.OUTPUTS[: steps.OUTPUTS.index(stops_after) + 1]:
            getattr(got, name).write.mode("error").parquet(f"{out_dir}/{name}/run={run}")
        raise RuntimeError("lost")

    monkeypatch.setattr(steps, "write_run", failing)
    q = microbatch.match_stream(spark, str(raw), clean, out, str(tmp_path / "cp"))
    with pytest.raises(Exception, match="lost"):
        q.awaitTermination(120)
    monkeypatch.setattr(steps, "write_run", write)
    microbatch.match_stream(spark, str(raw), clean, out, str(tmp_path / "cp")).awaitTermination(120)
    assert [steps.output(spark, out, n).count() for n in steps.OUTPUTS] == [1, 1, 1, 2]
    (raw / "s.csv").write_text(",".join(register.COLUMNS) + "\nAcme Ltd,London,,A rating,Skilled Worker\nNew One,York,,A rating,Skilled Worker\n")
    microbatch.match_stream(spark, str(raw), clean, out, str(tmp_path / "cp")).awaitTermination(120)
    assert [steps.output(spark, out, n).count() for n in steps.OUTPUTS] == [1, 1, 2, 3]


COMPANIES = ", ".join(f"{c} string" for c in registry.CLEAN)


def org_table(spark, *names_):
    rows = [(n, n.lower(), "False", "False", "London", "", "A rating", "Skilled Worker", n) for n in names_]
    return spark.createDataFrame(rows, "org_name string, org_norm string, has_multiple_towns string, has_multiple_counties string, town string, county string, rating string, route string, raw_name_variants string")


def put_register(spark, cfg, *names_):
    tables.write_csv(steps.long_names(org_table(spark, *names_)), f"{cfg.out_dir}/register")


@pytest.fixture
def runs_cfg(spark, tmp_path):
    clean = str(tmp_path / "clean")
    spark.createDataFrame([("11111111", "ACME LTD", "active", "ltd", "", "", "London", "", "", ""), ("22222222", "BETA WORKS", "active", "ltd", "", "", "London", "", "", "")], COMPANIES).write.parquet(clean)
    return config.Config(registry_path=clean, out_dir=str(tmp_path / "out"), as_of="2026-02-10")


def held(spark, cfg):
    return [sorted(r["org_name"] for r in steps.output(spark, cfg.out_dir, n).select("org_name").collect()) for n in ("enriched", "unmatched", "checkpoint")]


def test_registers_one_after_the_other(spark, runs_cfg):
    """Another register, a smaller one and the first again: nothing that was matched is lost, however many
    organisations there are; the report counts all of them."""
    put_register(spark, runs_cfg, "Acme", "Nobody One")
    steps.run_match(spark, runs_cfg)
    put_register(spark, runs_cfg, "Beta Works", "Nobody Two")  # as many as the first, none of them done
    second = steps.run_match(spark, runs_cfg)
    assert (second["processed_in_run"], second["processed_total"], second["remaining"]) == (2, 4, 0)
    put_register(spark, runs_cfg, "Acme")
    assert steps.run_match(spark, runs_cfg)["processed_in_run"] == 0
    every = [["Acme", "Beta Works"], ["Nobody One", "Nobody Two"], ["Acme", "Beta Works", "Nobody One", "Nobody Two"]]
    assert held(spark, runs_cfg) == every
    assert len(ledger.runs(spark, runs_cfg.out_dir)) == 2 and ledger.apart(ledger.runs(spark, runs_cfg.out_dir))
    steps.run_score(spark, runs_cfg)
    assert spark.read.parquet(f"{runs_cfg.out_dir}/scored").count() == 2


def test_failed_runs_leave_nothing(spark, runs_cfg, monkeypatch):
    put_register(spark, runs_cfg, "Acme", "Nobody One")
    write = steps.write_run
    for k in (1, len(steps.OUTPUTS)):

        def failing(got, out_dir, run, k=k):
            for name in steps.OUTPUTS[:k]:
                getattr(got, name).write.mode("error").parquet(f"{out_dir}/{name}/run={run}")
            raise RuntimeError("lost")

        monkeypatch.setattr(steps, "write_run", failing)
        with pytest.raises(RuntimeError):
            steps.run_match(spark, runs_cfg)
        report = snapshots.read_json(spark, f"{runs_cfg.out_dir}/resume_report.json")
        assert (report["status"], report["processed_in_run"], report["processed_total"], report["remaining"]) == ("error", 0, 0, 2)
        with pytest.raises(errors.LedgerError):
            steps.output(spark, runs_cfg.out_dir, "enriched")
    monkeypatch.setattr(steps, "write_run", write)
    steps.run_match(spark, runs_cfg)
    assert held(spark, runs_cfg) == [["Acme"], ["Nobody One"], ["Acme", "Nobody One"]]
    assert ledger.sweep(spark, runs_cfg.out_dir, steps.OUTPUTS) == [] and len(ledger.sweep(spark, runs_cfg.out_dir, steps.OUTPUTS, 0)) == 2
    assert held(spark, runs_cfg) == [["Acme"], ["Nobody One"], ["Acme", "Nobody One"]]


def test_matched_again_replaces(spark, runs_cfg):
    """Without resuming, or in two runs that didn't see each other, the last run's word on an organisation
    counts in all outputs; other organisations stay."""
    put_register(spark, runs_cfg, "Acme", "Beta Works")
    steps.run_match(spark, runs_cfg)
    put_register(spark, runs_cfg, "Acme", "Nobody One")
    strict = config.Config(**{**runs_cfg.__dict__, "min_match_score": 2.0})
    steps.run_match(spark, strict, resume_run=False)
    assert not ledger.apart(ledger.runs(spark, runs_cfg.out_dir))
    assert held(spark, runs_cfg) == [["Beta Works"], ["Acme", "Nobody One"], ["Acme", "Beta Works", "Nobody One"]]
    assert steps.run_match(spark, runs_cfg)["processed_in_run"] == 0
    assert steps.compact(spark, runs_cfg).startswith("run r0000000002-") and steps.compact(spark, runs_cfg) == "run none, deleted []"
    assert held(spark, runs_cfg) == [["Beta Works"], ["Acme", "Nobody One"], ["Acme", "Beta Works", "Nobody One"]]
    put_register(spark, runs_cfg, "Beta Works", "Nobody Two")
    assert steps.run_match(spark, runs_cfg)["processed_in_run"] == 1 and held(spark, runs_cfg)[1] == ["Acme", "Nobody One", "Nobody Two"]


def test_match_index(spark, tmp_path, runs_cfg, monkeypatch):
    """Matching over the stored index: the same rows; the registry's side is read as it lies, and of the words'
    buckets only those of the words that are asked for. Its folder can be moved."""
    folder, moved = str(tmp_path / "index"), str(tmp_path / "moved")
    rows = [(f"{k:08d}", f"Word{k} Other{k % 7} Ltd", "active", "ltd", "", "", "London", "", "", "") for k in range(300)]
    registry_ = spark.createDataFrame(rows, COMPANIES)
    monkeypatch.setattr(matching, "PER_PART", 10)  # Other1 and its like take several slots
    steps.write_match_index(registry.companies(registry_), folder)
    assert steps.read_match_index(spark, folder).frequency.agg(F.max("parts")).first()[0] == 5
    fs, p = tables.filesystem(spark, folder)
    fs.rename(p, tables.filesystem(spark, moved)[1])
    orgs = org_table(spark, "Word3 Other3", "Word5 Other0 Ltd", "Nothing")
    known = steps.read_match_index(spark, moved)
    want = matching.top_candidates(orgs, registry_)
    cut = matching.restricted(known, matching.query_variants(orgs))
    got = matching.top_candidates(orgs, cut)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect())) and got.count() > 0
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = matching.candidates(matching.query_variants(orgs), cut)._jdf.queryExecution().executedPlan().toString()
        joined = cut.companies.join(orgs.select(F.lit("00000003").alias("company_number"), "org_name"), "company_number")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # an exchange straight above a scan of the registry would deal the index anew
    shapes = [line.strip(" +-:*()0123456789") for line in (plan + joined).splitlines()]
    for k, line in enumerate(shapes):
        if line.startswith("FileScan parquet") and ("tessera_" in line or "moved" in line):
            above = next(x for x in reversed(shapes[:k]) if not x.startswith(("Project", "Filter", "ColumnarToRow", "Sort")))
            assert not above.startswith("Exchange"), (above, line)
    assert "SelectedBucketsCount" in plan
    with pytest.raises(errors.MissingInputError):
        bucketed.read(spark, str(tmp_path / "nothing"))
    assert matching.restricted(known, spark.createDataFrame([(f"a{k} b{k}",) for k in range(matching.LOOKED_UP)], "variant string")) is known


def test_claims(spark, tmp_path):
    """Of many that claim at once each gets an id of its own; a run is finished once, and only if claimed."""
    out = str(tmp_path)
    first = ledger.claim(spark, out)
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: ledger.claim(spark, out), range(24)))
    assert len({*got, first}) == 25 and min(got) > first
    ledger.finish(spark, out, ledger.Run(first, "a"))
    assert ledger.finished(spark, out, "a") and not ledger.finished(spark, out, "b")
    with pytest.raises(errors.RunExistsError):
        ledger.finish(spark, out, ledger.Run(first, "b"))
    with pytest.raises(errors.LedgerError):
        ledger.finish(spark, out, ledger.Run("r9", "b"))


def test_streams_and_batches_share_an_output(spark, tmp_path, runs_cfg):
    """Two streams with their own checkpoints and a batch run: their numbers don't meet. A checkpoint folder that is
    made anew starts with batch 0 again and loses nothing."""
    raw, head = tmp_path / "raw", ",".join(register.COLUMNS) + "\n"
    raw.mkdir()
    (raw / "r.csv").write_text(head + "Acme,London,,A rating,Skilled Worker\n")
    put_register(spark, runs_cfg, "Beta Works")
    steps.run_match(spark, runs_cfg)
    for k in (0, 1):
        (raw / f"s{k}.csv").write_text(head + f"Nobody {k},York,,A rating,Skilled Worker\n")
        microbatch.match_stream(spark, str(raw), runs_cfg.registry_path, runs_cfg.out_dir, str(tmp_path / f"cp{k}")).awaitTermination(120)
    put_register(spark, runs_cfg, "Beta Works", "Nobody Two")
    steps.run_match(spark, runs_cfg)
    assert held(spark, runs_cfg) == [["Acme", "Beta Works"], ["Nobody 0", "Nobody 1", "Nobody Two"], ["Acme", "Beta Works", "Nobody 0", "Nobody 1", "Nobody Two"]]


def test_payloads(spark):
    good = '{"items": [{"title": "A", "company_number": null, "address": {"locality": "York"}}, {"company_status": "active", "address": null}]}'
    rows = spark.createDataFrame([(1, good), (2, "{}"), (3, '{"items": null}')], "k int, p string")
    got = [(r["k"], r["nth"], r["title"], r["company_number"], r["company_status"], tuple(r["address"])) for r in payloads.search_items(rows, "p", "k").collect()]
    assert got == [(1, 0, "A", "", "", ("York", "", "")), (1, 1, "", "", "active", ("", "", ""))]
    for bad in ('{"items": [{"title": 3}]}', '{"items": {"a": 1}}', '{"items": [{"address": "x"}]}', "no json"):
        with pytest.raises(Exception):
            payloads.search_items(spark.createDataFrame([(bad,)], "p string"), "p").collect()
    rows = spark.createDataFrame([('{"company_name": "A", "sic_codes": ["1", " ", 2]}',), ('{"sic_codes": "1, 2;3"}',), ('{"sic_codes": null, "registered_office_address": {"region": "Kent"}}',), ('{"sic_codes": 5}',)], "p string").coalesce(1)
    assert [(r["company_name"], r["sic_codes"], r["registered_office_address"]["region"]) for r in payloads.profiles(rows, "p").collect()] == [("A", ["1", "2"], ""), ("", ["1", "2", "3"], ""), ("", [], "Kent"), ("", [], "")]
    typed = spark.createDataFrame([('{"a": 1}',)], "p string").select(payloads.validated(tables.F.col("p"), "a int").alias("v")).first()
    assert typed["v"]["a"] == 1
    with pytest.raises(Exception):
        spark.createDataFrame([('{"a": "x"}',)], "p string").select(payloads.validated(tables.F.col("p"), "a int").alias("v")).collect()


class Server:
    """A transport that answers what it is told, and a clock that only sleeping moves."""

    def __init__(self, *answers):
        self.answers, self.now, self.asked, self.slept = list(answers), 0.0, [], []

    def __call__(self, url, timeout):
        self.asked.append(url)
        got = self.answers.pop(0)
        if isinstance(got, Exception):
            raise got
        status, headers, body = got
        return http.Response(status, headers, iter([body.encode()]))

    def sleep(self, seconds):
        self.slept.append(round(seconds, 3))
        self.now += seconds

    def client(self, **how):
        clock = lambda: self.now
        return http.Client(self, http.Pace(how.pop("per_minute", 0), how.pop("gap", 0.0), clock, self.sleep), http.Circuit(how.pop("threshold", 5), 60.0, clock), http.Retries(jitter=0.0), **how)


def test_http_guard_rails(spark, tmp_path):
    s = Server((503, {}, ""), TimeoutError("slow"), (429, {"Retry-After": "7"}, ""), (200, {}, '{"a": 1}'))
    store = cache.JsonCache(spark, str(tmp_path / "cache"))
    c = s.client(cache=store)
    assert c.get_json("u", "k") == {"a": 1} and s.slept == [0.5, 1.0, 7.0] and len(s.asked) == 4
    assert c.get_json("u", "k") == {"a": 1} and len(s.asked) == 4 and store.has("k") and not store.has("l") and store.get("l") is None
    for status, kind in ((401, errors.AuthenticationError), (403, errors.AuthenticationError), (404, errors.HttpError)):
        s = Server((status, {}, "<p>no\n  way</p>"))
        with pytest.raises(kind, match="<p>no way"):
            s.client().get_json("u")
        assert len(s.asked) == 1
    s = Server(*[(429, {}, "")] * 4)
    with pytest.raises(errors.RateLimitedError):
        s.client().get_json("u")
    s = Server(*[(404, {}, "")] * 2, (404, {}, ""), (200, {}, "{}"))
    c = s.client(threshold=2)
    for _ in range(2):
        with pytest.raises(errors.HttpError):
            c.get_json("u")
    with pytest.raises(errors.CircuitOpenError):
        c.get_json("u")
    s.now += 61
    with pytest.raises(errors.HttpError):  # the trial fails and opens it again
        c.get_json("u")
    with pytest.raises(errors.CircuitOpenError):
        c.get_json("u")
    s.now += 61
    assert c.get_json("u") == {} and c.circuit.failures == 0
    for body in ("[1]", "no"):
        with pytest.raises(errors.PayloadError):
            Server((200, {}, body)).client().get_json("u")
    s = Server(*[(200, {}, "{}")] * 5)
    c = s.client(per_minute=2, gap=1.0)
    for _ in range(5):
        c.get_json("u")
    assert s.slept == [1.0, 59.0, 1.0, 59.0]
    assert http.retry_after({"retry-after": "Wed, 21 Oct 2026 07:28:10 GMT"}, datetime(2026, 10, 21, 7, 28, tzinfo=UTC)) == 10 and http.retry_after({"Retry-After": "soon"}) is None


def test_company_sources(spark, tmp_path):
    row = lambda n, t: (n, t, "active", "ltd", "", "62020", "York", "", "YO1", "")
    spark.createDataFrame([row("1", "ACME LTD"), row("2", "ACME ALPHA"), row("3", "ALPHA")], ", ".join(f"{c} string" for c in registry.CLEAN)).write.parquet(str(tmp_path / "c"))
    s = companies.company_source(spark, "file", str(tmp_path / "c"))
    assert [r["title"] for r in s.search("Acme Alpha")] == ["ACME ALPHA"] and [r["company_number"] for r in s.search("acme")] == ["1", "2"] and s.search("!") == []
    assert s.profile(" 1 ")["sic_codes"] == ["62020"]
    with pytest.raises(errors.MissingProfileRowError):
        s.profile("9")
    server = Server((200, {}, '{"items": [{"title": "A", "company_number": "1"}]}'), (200, {}, '{"company_name": "A", "sic_codes": "1;2"}'))
    a = companies.company_source(spark, "api", client=server.client(), base="http://x.example/")
    assert a.search("A & B")[0]["title"] == "A" and a.profile("1")["sic_codes"] == ["1", "2"]
    assert server.asked == ["http://x.example/search/companies?q=A%20%26%20B&items_per_page=10", "http://x.example/company/1"]
    for kind, path, error in (("file", "", errors.MissingSettingError), ("file", str(tmp_path / "no"), errors.MissingInputError), ("api", "", errors.MissingSettingError), ("ftp", "", errors.SourceKindError)):
        with pytest.raises(error):
            companies.company_source(spark, kind, path)
    keyed = companies.cache_keys(spark.createDataFrame([(" Acme ",)], "n string"), "search", "n").first()["cache_key"]
    assert keyed == companies.ApiSource.key("search", "ACME") and matching.TOP == 3


def test_cli(spark, tmp_path, capsys):
    assert cli.main(["extract"]) == 2 and "refresh register" in capsys.readouterr().err
    root = str(tmp_path / "s")
    source = bulk(tmp_path, [{}])
    assert cli.main(["refresh", "registry", "--snapshot-root", root, "--source", source, "--only", "acquire"]) == 0
    assert cli.main(["refresh", "registry", "--snapshot-root", root, "--only", "clean"]) == 0
    assert cli.main(["refresh", "registry", "--snapshot-root", root, "--only", "clean", "--source", source]) == 2
    assert cli.main(["refresh", "registry", "--snapshot-root", root]) == 2
    assert cli.main(["validate", "snapshots", "--snapshot-root", root]) == 1 and "register" in capsys.readouterr().out
    (tmp_path / "p.html").write_text('<a href="BasicCompanyDataAsOneFile-2026-02-01.zip">x</a><a href="http://y/register.csv">sponsor register</a>')
    assert cli.main(["links", "csv", "--page", str(tmp_path / "p.html"), "--url", "http://x.example/"]) == 0 and "http://y/register.csv" in capsys.readouterr().out
    assert cli.main(["links", "zip", "--page", str(tmp_path / "p.html"), "--url", "http://x.example/"]) == 0 and "http://x.example/Basic" in capsys.readouterr().out
    with zipfile.ZipFile(tmp_path / "BasicCompanyDataAsOneFile-2026-02-01.zip", "w") as z:
        z.write(source, "x.csv")
    assert cli.main(["refresh", "registry", "--snapshot-root", str(tmp_path / "found"), "--page", str(tmp_path / "p.html"), "--url", f"file://{tmp_path}/"]) == 0
    assert snapshots.latest(spark, str(tmp_path / "found"), "registry").endswith("2026-02-01")
    raw, out = tmp_path / "raw.csv", str(tmp_path / "out")
    raw.write_text(",".join(register.COLUMNS) + "\nAcme Software Ltd,London,Greater London,A rating,Skilled Worker\n")
    where = ["--snapshot-root", root, "--out-dir", out]
    assert cli.main(["build", "register", "--register-path", str(raw), *where]) == 0 and cli.main(["build", "all", "--as-of", "2026-02-10", *where]) == 0
    assert cli.main(["validate", "outputs", *where]) == 0 and cli.main(["validate", "audit", *where]) == 0 and cli.main(["validate", "runs", "--other-dir", out, *where]) == 0
    assert cli.main(["validate", "resume", *where]) == 2 and cli.main(["build", "match", *where]) == 0 and cli.main(["validate", "resume", *where]) == 0
    assert cli.main(["search", "--keyword", "software", *where]) == 0 and cli.main(["search", *where]) == 2
    with pytest.raises(SystemExit):
        cli.main(["validate", "runs"])


def test_logs(capsys):
    import logging

    from tessera import logs

    log = logs.logger("tessera.test")
    assert logs.logger("tessera.test") is log and len(log.handlers) == 1 and log.handlers[0].formatter.converter(0).tm_hour == 0
    with pytest.raises(ValueError), logs.progress("step"):
        raise ValueError
    assert logging.getLogger("tessera").handlers


def test_texts_in_files_of_a_size(spark, tmp_path, monkeypatch):
    """More text gives more files, not larger ones; every row is in them."""
    from tessera.plans import queries

    spark.range(400).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ä b\n"), 50).alias("text"), F.lit("en").alias("lang")).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "PER_FILE", 10_000)
    folder = queries._texts(spark, str(tmp_path))
    assert len(list((tmp_path.__class__(folder.removeprefix("file:")) / "csv").glob("part-*.csv"))) == 10
    assert tables.read_csv(spark, f"{folder}/csv", na_cells=False).count() == 400
