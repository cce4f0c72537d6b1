"""The driver's queries over the views: one or more per operator."""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import names, values
from tessera.operators import asof, audit, dealing, links, matching, prefixes, register, registry, resume, scoring, shortlist, summaries
from tessera.plans import refresh, steps, validate, views
from tessera.sources import companies, config, digests, employees, ledger, payloads, profiles, snapshots, tables
from tessera.stored import shared_dir, stored
from tessera.streaming import microbatch, state

AS_OF = "2026-02-10"
#: Locations in the shape of an alias file, for the driver's nations and regions.
LOCATIONS = [
    shortlist.Location("Northern area", ("north", "northern"), ("asia",), ("nation_3", "nation_17"), ("EC7",)),
    shortlist.Location("Europe", ("eu",), ("europe",), (), ()),
]


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _coerced(raw: DataFrame) -> DataFrame:
    return register.coerce(raw, dict(zip(register.SHORT, register.SHORT)), "pos")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return _coerced(views.view(spark, d, views.REGISTER))


def _orgs(spark: SparkSession, d: str) -> DataFrame:
    return register.register(_coerced(dealing.spread(register.firsts(views.view(spark, d, views.REGISTER))))).drop("pos")


def _clean(spark: SparkSession, d: str, strict: bool = True) -> DataFrame:
    return registry.clean(views.view(spark, d, views.REGISTRY), views.REGISTRY_COLUMNS, strict)


def _index(clean: DataFrame) -> matching.Index:
    """Companies and what matching reads of them: written."""
    return matching.index(stored(registry.companies(clean), "companies"), most=matching.MAX_CANDIDATES, keep=stored)


def _inputs(spark: SparkSession, d: str) -> tuple[DataFrame, matching.Index]:
    """Organisations and companies as the steps before matching leave them: written."""
    return stored(_orgs(spark, d), "register"), _index(_clean(spark, d))


def _top(spark: SparkSession, d: str) -> DataFrame:
    return matching.top_candidates(*_inputs(spark, d))


def _matched(spark: SparkSession, d: str) -> steps.Matched:
    """All outputs of the match step over one stored ranking."""
    return steps.match(*_inputs(spark, d))


def _best(spark: SparkSession, d: str) -> DataFrame:
    orgs, companies_ = _inputs(spark, d)
    return matching.best(orgs, matching.top_candidates(orgs, companies_))


def _enriched(spark: SparkSession, d: str) -> DataFrame:
    orgs, companies_ = _inputs(spark, d)
    return matching.enriched(matching.best(orgs, matching.top_candidates(orgs, companies_)), companies_)


def _unmatched(spark: SparkSession, d: str) -> DataFrame:
    return matching.unmatched(_best(spark, d))


def _employees(spark: SparkSession, d: str) -> DataFrame:
    return views.view(spark, d, views.EMPLOYEES)


def _scored(spark: SparkSession, d: str, profile: scoring.Profile = profiles.TECH) -> DataFrame:
    return scoring.scored(_enriched(spark, d), profile, F.lit(AS_OF).cast("date"), scoring.employee_lookup(_employees(spark, d)))


def _slim(df: DataFrame) -> DataFrame:
    return df.select("org_name", "ch_company_number", "match_score", "employee_count", "sic_tech_score", "is_active_score", "company_age_score", "company_type_score", "name_keyword_score", "role_fit_score", "role_fit_bucket")


# -- register -----------------------------------------------------------------------------------


def q_register_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _orgs(spark, d).orderBy("org_norm")


def q_register_stats(spark: SparkSession, d: str) -> DataFrame:
    return register.stats(_rows(spark, d))


def q_top_towns(spark: SparkSession, d: str) -> DataFrame:
    return register.top_values(register.eligible(_rows(spark, d)), "town")


def _summaries(spark: SparkSession, d: str) -> list[str]:
    """Summaries of the register's rows as three snapshots, by position."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/summaries-{uuid.uuid4().hex}"
    for k in range(3):
        summaries.write(_rows(spark, d).filter(F.col("pos") % 3 == k), f"{folder}/{k}", k)
    return [f"{folder}/{k}" for k in range(3)]


def q_merged_stats(spark: SparkSession, d: str) -> DataFrame:
    """Counts of three snapshots together, from their summaries."""
    return summaries.stats(spark, _summaries(spark, d))


def q_merged_top_towns(spark: SparkSession, d: str) -> DataFrame:
    return summaries.top_values(spark, _summaries(spark, d), "town").withColumn("first_snapshot", F.col("first_snapshot").cast("long"))


def q_eligible(spark: SparkSession, d: str) -> DataFrame:
    return register.eligible(_rows(spark, d))


def q_normalise(spark: SparkSession, d: str) -> DataFrame:
    return _rows(spark, d).select("pos", "name", names.normalise(F.col("name")).alias("norm"), names.sort_key(F.col("name")).alias("sort_key"))


def q_normalise_documents(spark: SparkSession, d: str) -> DataFrame:
    n = names.normalise(F.col("text"))
    return _table(spark, d, "documents").select("doc_id", F.length(n).cast("long").alias("n_norm"), F.md5(n).alias("norm_md5"))


def q_variants(spark: SparkSession, d: str) -> DataFrame:
    return matching.query_variants(_rows(spark, d).select(F.col("name").alias("org_name")).distinct()).select("org_name", F.col("variant_index").cast("long").alias("variant_index"), "variant")


# -- registry -----------------------------------------------------------------------------------


def q_registry_clean(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d)


def q_token_index(spark: SparkSession, d: str) -> DataFrame:
    return registry.token_index(_clean(spark, d))


def q_restricted_index(spark: SparkSession, d: str) -> DataFrame:
    wanted = _rows(spark, d).select(F.explode(names.tokens(F.col("name"))).alias("token")).distinct()
    return registry.restrict_index(registry.token_index(_clean(spark, d)), wanted)


def q_uri_check(spark: SparkSession, d: str) -> DataFrame:
    """Every seventeenth company's address is made to name another number."""
    c = _clean(spark, d, strict=False)
    c = c.withColumn("uri", F.when(F.col("company_number").cast("long") % 17 == 0, F.concat("uri", F.lit("9"))).otherwise(F.col("uri")))
    return c.groupBy(registry.uri_matches(F.col("uri"), F.col("company_number")).alias("fits")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_similarity(spark: SparkSession, d: str) -> DataFrame:
    a = _orgs(spark, d).select("org_norm").distinct()
    pairs = a.withColumn("word", F.explode(F.split("org_norm", " "))).join(registry.companies(_clean(spark, d)).select("title_norm").distinct().withColumn("word", F.explode(F.split("title_norm", " "))), "word")
    return matching.name_similarities(pairs)


# -- matching -----------------------------------------------------------------------------------


def q_block_candidates(spark: SparkSession, d: str) -> DataFrame:
    orgs, companies_ = _inputs(spark, d)
    return matching.candidates(matching.query_variants(orgs), companies_)


def q_match_top3(spark: SparkSession, d: str) -> DataFrame:
    out = _top(spark, d)
    return out.select("org_name", F.col("rank").cast("long").alias("cand_rank"), "company_number", "variant", "hits", "total", "name_similarity", "locality_bonus", "region_bonus", "status_bonus", matching.confidence(F.col("total")).alias("confidence"))


def q_candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    return matching.candidate_rows(_top(spark, d)).withColumn("rank", F.col("rank").cast("long")).withColumnRenamed("rank", "cand_rank").orderBy("org_name", "cand_rank")


def q_enriched(spark: SparkSession, d: str) -> DataFrame:
    return _enriched(spark, d)


def q_unmatched(spark: SparkSession, d: str) -> DataFrame:
    return _unmatched(spark, d)


def q_profile_errors(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of every third company are withheld, by their status."""
    kept = _clean(spark, d).filter(F.col("company_status") == "active")
    return matching.profile_errors(_best(spark, d), kept)


# -- scoring ------------------------------------------------------------------------------------


def _by_company(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d)


def q_sic_score(spark: SparkSession, d: str) -> DataFrame:
    codes = values.sic_list(F.col("sic_codes"))
    return _by_company(spark, d).select("company_number", "sic_codes", scoring.sic_score(codes, profiles.TECH).alias("tech_score"), scoring.sic_score(codes, profiles.CARE).alias("care_score"))


def q_prefix_scores(spark: SparkSession, d: str) -> DataFrame:
    """Parts' numbers as codes against a catalogue in which every customer's number is a prefix."""
    n, codes = F.col("c_custkey"), [(F.col("p_partkey") * k).cast("string") for k in (1, 7)]
    weight = lambda rest, x: F.when(rest, x / F.lit(64.0))
    catalogue = _table(spark, d, "customer").select(n.cast("string").alias("prefix"), weight(n % 3 != 0, n % 29).alias("positive"), weight(n % 3 == 0, -(n % 7)).alias("negative"), n.alias("nth"))
    parts = _table(spark, d, "part").select("p_partkey", F.concat_ws("; ", *codes, F.col("p_size").cast("string")).alias("codes"))
    return prefixes.sic_scores(parts, "codes", catalogue, "score").select("p_partkey", F.round("score", 6).alias("score"))


def q_sic_relation(spark: SparkSession, d: str) -> DataFrame:
    """The shipped profiles' scores, from their catalogues as tables."""
    rows = _by_company(spark, d).select("company_number", "sic_codes")
    for name, p in (("tech_score", profiles.TECH), ("care_score", profiles.CARE)):
        rows = prefixes.sic_scores(rows, "sic_codes", prefixes.weights(spark, p), name)
    return rows


def q_located(spark: SparkSession, d: str) -> DataFrame:
    """Companies in each nation and region, by what their addresses say."""
    n, r = _table(spark, d, "nation"), _table(spark, d, "region")
    term = lambda df, place, kind, t: df.select(F.col(place).alias("place"), F.lit(kind).alias("kind"), t.alias("term"))
    given = term(r, "r_name", "region", F.col("r_name")).union(term(n, "n_name", "locality", F.col("n_name"))).union(term(n, "n_name", "postcode", F.concat(F.lit("ec"), F.col("n_nationkey").cast("string"))))
    rows = prefixes.located(_clean(spark, d), given, "address_region", "address_locality", "address_postcode")
    return rows.groupBy("place").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("company_number").alias("n_companies"))


def q_alias_file(spark: SparkSession, d: str) -> DataFrame:
    """The same places from an alias file."""
    path = f"{shared_dir(spark).rstrip('/')}/tessera/files-{uuid.uuid4().hex}/aliases.json"
    place = lambda name, regions, localities, codes: {"canonical_name": name, "aliases": [], "regions": regions, "localities": localities, "postcode_prefixes": codes}
    found = [place(r["r_name"], [r["r_name"]], [], []) for r in _table(spark, d, "region").collect()]  # 5 and 25 rows at any size
    found += [place(n["n_name"], [], [f" {n['n_name']} "], [f"ec{n['n_nationkey']}"]) for n in _table(spark, d, "nation").collect()]
    snapshots.write_json(spark, path, {"locations": found})
    given = prefixes.terms(spark, shortlist.locations(snapshots.read_json(spark, path)))
    rows = prefixes.located(_clean(spark, d), given, "address_region", "address_locality", "address_postcode")
    return rows.groupBy("place").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("company_number").alias("n_companies"))


def q_age_score(spark: SparkSession, d: str) -> DataFrame:
    return _by_company(spark, d).select("company_number", "date_of_creation", scoring.age_score(F.col("date_of_creation"), F.lit(AS_OF).cast("date"), profiles.TECH).alias("age_score"))


def q_type_status_score(spark: SparkSession, d: str) -> DataFrame:
    return _by_company(spark, d).select("company_number", scoring.type_score(F.col("company_type"), profiles.TECH).alias("type_score"), scoring.status_score(F.col("company_status"), profiles.TECH).alias("status_score"))


def q_keyword_score(spark: SparkSession, d: str) -> DataFrame:
    return _by_company(spark, d).select("company_number", scoring.keyword_score(F.col("company_name"), profiles.TECH).alias("tech_score"), scoring.keyword_score(F.col("company_name"), profiles.CARE).alias("care_score"))


def q_scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.order_scored(_slim(_scored(spark, d)))


def q_scored_care(spark: SparkSession, d: str) -> DataFrame:
    return _slim(_scored(spark, d, profiles.CARE))


def q_employee_join(spark: SparkSession, d: str) -> DataFrame:
    rows = _clean(spark, d).select(F.col("company_number").alias("ch_company_number"))
    return scoring.attach_employees(rows, scoring.employee_lookup(_employees(spark, d)))


def q_employee_files(spark: SparkSession, d: str) -> DataFrame:
    """The same join with a committed snapshot that was acquired from a file."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/files-{uuid.uuid4().hex}"
    tables.write_csv(_employees(spark, d).distinct().coalesce(1), f"{folder}/raw")  # one file is what a snapshot acquires
    fs, p = tables.filesystem(spark, f"{folder}/raw")
    refresh.refresh(spark, f"{folder}/snapshots", "employee_count", next(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".csv")))
    return scoring.attach_employees(_clean(spark, d).select(F.col("company_number").alias("ch_company_number")), employees.load(spark, f"{folder}/snapshots"))


def q_catalogue_file(spark: SparkSession, d: str) -> DataFrame:
    """Scores by a profile of a catalogue file that holds the shipped ones."""

    def entry(p: scoring.Profile) -> dict:
        share = {k: getattr(p, k) for k in ("positive_per_match", "positive_cap", "negative_per_match", "negative_cap")}
        signals = {k: {} for k in ("sector_signals", "location_signals", "size_signals")}
        return signals | {
            "name": p.name, "job_type": p.job_type, "sic_positive_prefixes": p.sic_positive, "sic_negative_prefixes": p.sic_negative, "keyword_positive": list(p.keyword_positive), "keyword_negative": list(p.keyword_negative),
            "company_type_weights": p.type_weights, "keyword_weights": share, "company_status_scores": {"active": p.active, "inactive": p.inactive}, "bucket_thresholds": {"strong": p.strong, "possible": p.possible},
            "company_age_scores": {"unknown": p.age_unknown, "bands": [{"min_years": a, "score": x} for a, x in p.age_bands]},
        }

    path = f"{shared_dir(spark).rstrip('/')}/tessera/files-{uuid.uuid4().hex}/catalogue.json"
    snapshots.write_json(spark, path, {"schema_version": profiles.SCHEMA_VERSION, "default_profile": profiles.CARE.name, "profiles": [entry(profiles.TECH), entry(profiles.CARE)]})
    p = profiles.resolve(*profiles.load(spark, path))
    codes, name = values.sic_list(F.col("sic_codes")), F.col("company_name")
    return _by_company(spark, d).select("company_number", scoring.sic_score(codes, p).alias("care_score"), scoring.keyword_score(name, p).alias("word_score"), scoring.type_score(F.col("company_type"), p).alias("type_score"), scoring.status_score(F.col("company_status"), p).alias("status_score"))


def q_employees_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Counts of two snapshots, the later one without some companies, on days before, between and after them."""
    number = F.col("company_number").cast("long")
    first = _employees(spark, d).distinct()
    later = first.filter(number % 3 != 0).withColumns({"employee_count": (F.col("employee_count").cast("int") + 1).cast("string"), "employee_count_snapshot_date": F.lit("2026-05-01")})
    days = F.element_at(F.array(*[F.lit(x) for x in ("2026-02-05", "2026-02-06", "2026-04-30", "2026-05-02")]), (number % 4 + 1).cast("int"))
    rows = _clean(spark, d).select(F.col("company_number").alias("ch_company_number"), days.cast("date").alias("day"))
    return scoring.attach_employees_as_of(rows, asof.history((first, F.lit("2026-02-06")), (later, F.lit("2026-05-01"))), "day").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def q_asof_join(spark: SparkSession, d: str) -> DataFrame:
    """With every order the price of its customer's latest order of the highest priority until then."""
    o = _table(spark, d, "orders")
    urgent = o.filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey", F.col("o_orderdate").alias("valid_from"), F.col("o_totalprice").alias("urgent_price"))
    return asof.asof_join(o.select("o_orderkey", "o_custkey", "o_orderdate"), urgent, "o_custkey", "o_orderdate", "valid_from", ["urgent_price"]).select("o_orderkey", "o_custkey", "urgent_price")


def q_employee_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Counts by nation and customer segment as if they were one company's versions."""
    c = _table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("company_number"), F.col("c_mktsegment").alias("employee_count"))
    return scoring.employee_conflicts(c)


def q_size_bands(spark: SparkSession, d: str) -> DataFrame:
    n = values.positive_int(F.col("employee_count"))
    return _employees(spark, d).groupBy(values.size_band(n).alias("band")).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(n).alias("employees"))


# -- shortlist ----------------------------------------------------------------------------------


def q_shortlist(spark: SparkSession, d: str) -> DataFrame:
    return shortlist.explain(shortlist.shortlist(_scored(spark, d)))


def q_shortlist_size(spark: SparkSession, d: str) -> DataFrame:
    return _slim(shortlist.shortlist(_scored(spark, d), 0.35, 1000))


def q_shortlist_size_unknown(spark: SparkSession, d: str) -> DataFrame:
    return _slim(shortlist.shortlist(_scored(spark, d), 0.35, 1000, True))


def q_shortlist_geo(spark: SparkSession, d: str) -> DataFrame:
    return _slim(shortlist.shortlist(_scored(spark, d), 0.35, place=shortlist.geo_filter(" Northern ", ["ec12"], LOCATIONS)))


def q_search(spark: SparkSession, d: str) -> DataFrame:
    return _slim(shortlist.search(_scored(spark, d), keyword="software", sector="62", region="nation_1"))


# -- audit, resume, shapes ----------------------------------------------------------------------


def q_audit(spark: SparkSession, d: str) -> DataFrame:
    m = _matched(spark, d)
    return audit.metrics(stored(m.enriched, "audited"), stored(m.unmatched, "audited"))  # read four times each


def q_audit_findings(spark: SparkSession, d: str) -> DataFrame:
    """Every check on the outputs with some organisations twice, under limits that some metrics exceed."""
    m = _matched(spark, d)
    enriched = stored(m.enriched, "audited")
    twice = enriched.unionByName(enriched.filter(F.length("org_name") % 7 == 0))
    return audit.findings(audit.metrics(twice, stored(m.unmatched, "audited")), audit.Thresholds(max_low_similarity=1, max_near=2, max_non_active=3, max_shared_numbers=4))


def q_bad_scores(spark: SparkSession, d: str) -> DataFrame:
    """Customers' balances with words and blanks among them, read as scores."""
    k = F.col("c_custkey") % 3
    mixed = F.when(k == 0, F.col("c_acctbal").cast("string")).when(k == 1, F.concat(F.lit(" "), "c_mktsegment")).otherwise(" ")
    return scoring.bad_scores(_table(spark, d, "customer").select(mixed.alias("match_score")))


def q_determinism(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the ranking, and rows that differ once the inputs are dealt otherwise."""
    c = ["org_name", "company_number", "total"]
    a = stored(_top(spark, d).select(*c), "ranking")
    b = matching.top_candidates(stored(_orgs(spark, d).repartition("town"), "register"), _index(_clean(spark, d).repartition("company_name"))).select(*c)
    differ = audit.differences(a, b).agg(F.count(F.lit(1)).alias("n_differences"))
    return a.agg(F.count(F.lit(1)).alias("n_rows")).crossJoin(differ)  # one row each


def q_differences(spark: SparkSession, d: str) -> DataFrame:
    """The ranking against itself without companies whose numbers end in 3."""
    a = stored(_top(spark, d).select("org_name", "company_number", "total"), "ranking")
    return audit.differences(a, a.filter(~F.endswith("company_number", F.lit("3"))))


def q_stored_differences(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a stored table, against ones of which some are dearer, some are gone and some are there twice."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/digests-{uuid.uuid4().hex}"
    o, k = _table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), F.col("o_orderkey")
    other = o.filter(k % 701 != 0).withColumn("o_totalprice", F.when(k % 503 == 0, F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")))
    digests.write(o, f"{folder}/first")
    digests.write(other.union(o.filter(k % 601 == 0)), f"{folder}/second")
    return digests.stored_differences(spark, f"{folder}/first", f"{folder}/second")


def q_repeated_numbers(spark: SparkSession, d: str) -> DataFrame:
    """The ranking over a registry in which each seventh row repeats the number of the one before."""
    pos = F.col("company_number").cast("long")
    twice = _clean(spark, d).withColumn("pos", pos)
    twice = twice.withColumn("company_number", F.when(F.col("pos") % 7 == 0, F.lpad((F.col("pos") - 1).cast("string"), 8, "0")).otherwise(F.col("company_number")))
    return matching.top_candidates(stored(_orgs(spark, d), "register"), _index(twice)).select("org_name", F.col("rank").cast("long").alias("cand_rank"), "company_number", "title", "hits", "total")


def q_disjoint(spark: SparkSession, d: str) -> DataFrame:
    """Organisations in both outputs, after some matched ones were planted among the unmatched."""
    m = _matched(spark, d)
    matched = m.enriched.select("org_name")
    planted = matched.filter(F.length("org_name") % 7 == 0)
    return matched.intersect(m.unmatched.select("org_name").union(planted))


def _done(spark: SparkSession, d: str) -> DataFrame:
    """Organisations of several towns count as processed."""
    return _orgs(spark, d).filter("has_multiple_towns").select("org_name")


def q_resume_pending(spark: SparkSession, d: str) -> DataFrame:
    orgs = _orgs(spark, d)
    return resume.pending(orgs, resume.processed(_done(spark, d), orgs.filter(F.length("org_name") % 5 == 0)))


def q_resume_counters(spark: SparkSession, d: str) -> DataFrame:
    return resume.counters(_orgs(spark, d), _done(spark, d), 25)


def q_batches(spark: SparkSession, d: str) -> DataFrame:
    return resume.batches(_orgs(spark, d).select("org_name"), ["org_name"], 25, start=2, count=5).select("org_name", "batch")


def q_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The first register row of every normalised name."""
    return resume.keep_first(_rows(spark, d).select(names.normalise(F.col("name")).alias("norm"), "pos", "name"), ["norm"], [F.col("pos")])


def q_latest_snapshot(spark: SparkSession, d: str) -> DataFrame:
    e = _table(spark, d, "events").select("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", "event_type")
    return resume.latest(e, "user_id", "day", "event_id")


def q_links(spark: SparkSession, d: str) -> DataFrame:
    return links.extract_links(_table(spark, d, "pages"), "page_id", "url", "html").groupBy("key").agg(F.count(F.lit(1)).alias("n_links"), F.min("text").alias("first_text"), F.max("text").alias("last_text"))


def q_best_link(spark: SparkSession, d: str) -> DataFrame:
    found = links.extract_links(_table(spark, d, "pages"), "page_id", "url", "html")
    return links.best_links(found, r"(?i)/[a-z]", {"the": 2, "on": 1, "en": 1}).select(F.col("key").alias("page_id"), F.col("score").cast("long").alias("score"), "n_tied")


def q_archive_links(spark: SparkSession, d: str) -> DataFrame:
    """Customers as pages whose orders are links: dated archives, one without date, other archives, no archives."""
    k, name = F.col("o_orderkey") % 4, "https://example.org/BasicCompanyDataAsOneFile"
    dated = F.concat(F.lit(f"{name}-20"), F.date_format("o_orderdate", "yy-MM"), F.lit("-01.zip"))
    href = F.when(k == 0, dated).when(k == 1, f"{name.lower()}.zip").when(k == 2, "https://example.org/other.ZIP").otherwise("https://example.org/")
    return links.archive_links(_table(spark, d, "orders").select(F.col("o_custkey").alias("key"), href.alias("href")))


def q_text_table(spark: SparkSession, d: str) -> DataFrame:
    """Missing-value cells, coerced to a fixed set of columns."""
    s = _table(spark, d, "part").select(F.when(F.col("p_size") % 7 == 0, "N/A").otherwise(F.col("p_type")).alias("kind"), F.col("p_brand").alias("brand"))
    s = s.select(values.na_to_blank(F.col("kind")).alias("kind"), "brand")
    return resume.coerce(s, ("brand", "kind", "remark")).groupBy("brand", "kind", "remark").agg(F.count(F.lit(1)).alias("n_rows"))


def q_stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windowed counts that arrivals() has kept once a stream of the events has ended."""
    path = f"{shared_dir(spark).rstrip('/')}/tessera/stream-{uuid.uuid4().hex}"
    events = spark.readStream.schema(_table(spark, d, "events").schema).parquet(f"{d}/events*.parquet")
    here = F.current_timezone()  # the table's times have no zone; they are taken as UTC
    events = events.withColumn("ts", F.convert_timezone(F.lit("UTC"), here, F.col("ts")).cast("timestamp"))
    kept = microbatch.arrivals(events, window="1 day")
    query = kept.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/state").foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{path}/out")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{path}/out").select(F.date_format(F.to_utc_timestamp("window_start", here), "yyyy-MM-dd").alias("day"), "event_type", "n")


def _dealt_events(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """The events as a stream of files that each span all times, and a last file with one later row of no one; a file
    is a batch. And the folder."""
    path = f"{shared_dir(spark).rstrip('/')}/tessera/stream-{uuid.uuid4().hex}"
    # the table's times have no zone; they are taken as UTC
    events = _table(spark, d, "events").select("event_id", F.convert_timezone(F.lit("UTC"), F.current_timezone(), "ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    events.repartition(5, "event_id").write.parquet(f"{path}/in")
    last = events.agg((F.max("ts") + F.expr("INTERVAL 1000 DAYS")).alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"), F.lit("").alias("event_type"), F.lit(0.0).alias("value"))
    last.coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in"), path


def q_stream_first(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each user by time, from a stream whose files are out of order; as of a table by SQL."""
    stream, path = _dealt_events(spark, d)
    kept = state.keep_first(stream, "user_id", "ts", "event_id", "400 days")
    query = kept.writeStream.outputMode("append").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).format("parquet").start(f"{path}/out")
    query.awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{path}/out").select("user_id", "event_id", F.date_format(F.to_utc_timestamp("ts", F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "event_type", "value")


def q_stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Each user's sessions, events less than six hours apart, from the same stream."""
    stream, path = _dealt_events(spark, d)
    kept = state.sessions(stream, "user_id", "ts", "6 hours", "400 days")
    query = kept.writeStream.outputMode("append").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).format("parquet").start(f"{path}/out")
    query.awaitTermination()
    at = lambda c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return spark.read.schema(kept.schema).parquet(f"{path}/out").select("user_id", at("first_time"), at("last_time"), "n")


# -- values, payloads, snapshots and files --------------------------------------------------------


def q_cache_key(spark: SparkSession, d: str) -> DataFrame:
    return companies.cache_keys(_rows(spark, d).select("pos", "name"), "search", "name").select("pos", "cache_key")


def q_round(spark: SparkSession, d: str) -> DataFrame:
    """Four digits of any numbers, and of numbers that lie in the middle."""
    x = F.col("l_discount") * F.col("l_tax") + F.col("l_quantity") / F.lit(7.0)
    tie = F.col("l_orderkey") % 64 / F.lit(32768.0)
    return _table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", values.round_half_even(x).alias("rounded"), values.round_half_even(tie).alias("tied"))


def q_snapshot_date(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("list 2026-01-0"), (1 + F.col("o_orderkey") % 9).cast("string"), F.lit(".csv"))).otherwise("list.csv")
    return _table(spark, d, "orders").select("o_orderkey", values.snapshot_date(name, F.col("o_orderdate")).alias("day"))


def q_profile_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Companies as JSON profiles, codes as a list or as one text, names and addresses missing here and
    there, and back."""
    c = _clean(spark, d)
    n, codes = F.col("company_number").cast("long"), F.col("sic_codes")
    listed = F.concat(F.lit("["), F.array_join(F.transform(values.sic_list(codes), lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ","), F.lit("]"))
    quoted = lambda x: F.to_json(F.struct(x.alias("v")))
    field = lambda x: F.regexp_extract(quoted(x), r"^\{\"v\":(.*)\}$", 1)
    payload = F.concat(
        F.lit('{"company_name": '), F.when(n % 5 == 0, "null").otherwise(field(F.col("company_name"))), F.lit(', "type": '), field(F.col("company_type")),
        F.lit(', "sic_codes": '), F.when(n % 2 == 0, listed).otherwise(field(codes)), F.when(n % 4 == 0, "").otherwise(F.concat(F.lit(', "registered_office_address": {"locality": '), field(F.col("address_locality")), F.lit("}"))), F.lit("}"),
    )
    got = payloads.profiles(c.select("company_number", payload.alias("payload")), "payload", "company_number")
    address = F.col("registered_office_address")
    return got.select("company_number", "company_name", F.col("type").alias("company_type"), F.array_join("sic_codes", "|").alias("codes"), address["locality"].alias("locality"), address["region"].alias("region"))


def q_search_payloads(spark: SparkSession, d: str) -> DataFrame:
    """Companies of a place as the JSON answer of a search, and back."""
    shown = registry.search_view(_clean(spark, d)).select("company_number", "title", "company_status", "address")
    found = shown.groupBy(F.col("address.locality").alias("place")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("company_number", "title", "company_status", "address"))).alias("items"))).alias("payload"))
    return payloads.search_items(found, "payload", "place").select("place", F.col("nth").cast("long").alias("nth"), "title", "company_number", "company_status")


def _bulk_file(spark: SparkSession, d: str, folder: str) -> str:
    """The registry view as a bulk file with its headers."""
    raw = views.view(spark, d, views.REGISTRY)
    given = [F.col(views.REGISTRY_COLUMNS[k]).alias(f" {h}") if k in views.REGISTRY_COLUMNS else F.lit("").alias(f" {h}") for k, h in registry.BULK.items()]
    tables.write_csv(raw.select(*given).coalesce(1), f"{folder}/bulk")
    fs, p = tables.filesystem(spark, f"{folder}/bulk")
    return next(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".csv"))


def _committed(spark: SparkSession, d: str) -> tuple[str, str]:
    """A folder with a committed snapshot of the registry, and the snapshot."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/files-{uuid.uuid4().hex}"
    return folder, refresh.refresh(spark, f"{folder}/snapshots", "registry", _bulk_file(spark, d, folder))


def write_inputs(spark: SparkSession, d: str) -> config.Config:
    """Everything that the steps read, as files: committed snapshots and a raw register."""
    folder, _ = _committed(spark, d)
    tables.write_csv(steps.long_names(views.view(spark, d, views.REGISTER).orderBy("pos").select(*[F.col(a).alias(b) for a, b in zip(register.SHORT, register.COLUMNS)])), f"{folder}/raw/list.csv")
    tables.write_csv(_employees(spark, d).distinct().coalesce(1), f"{folder}/employees")
    fs, p = tables.filesystem(spark, f"{folder}/employees")
    source = next(s.getPath().toString() for s in fs.listStatus(p) if s.getPath().getName().endswith(".csv"))
    refresh.refresh(spark, f"{folder}/snapshots", "employee_count", source)
    return config.Config(snapshot_root=f"{folder}/snapshots", register_path=f"{folder}/raw/list.csv", employees_path=f"{folder}/snapshots", out_dir=f"{folder}/out", as_of=AS_OF, batch_size=1 << 30)


def q_snapshot_clean(spark: SparkSession, d: str) -> DataFrame:
    """The clean table of a snapshot that was acquired from a file, cleaned and committed."""
    return tables.read_csv(spark, f"{_committed(spark, d)[1]}/clean.csv", na_cells=False)


def q_snapshot_counts(spark: SparkSession, d: str) -> DataFrame:
    """What such a snapshot's manifest says, its index and profiles, and what the validator finds wrong."""
    folder, final = _committed(spark, d)
    counts = snapshots.read_json(spark, f"{final}/manifest.json")["row_counts"]
    wrong = validate.snapshot_errors(spark, f"{folder}/snapshots", ("registry",))
    index, profiles_ = tables.read_index(spark, f"{final}/index_tokens"), spark.read.parquet(f"{final}/profiles")
    out = index.agg(F.count(F.lit(1)).alias("n_index")).crossJoin(profiles_.agg(F.count(F.lit(1)).alias("n_profiles")))  # one row each
    return out.select(F.lit(counts["raw"]).cast("long").alias("n_raw"), F.lit(counts["clean"]).cast("long").alias("n_clean"), "n_index", "n_profiles", F.lit(len(wrong)).cast("long").alias("n_wrong"))


def q_pipeline_files(spark: SparkSession, d: str) -> DataFrame:
    """The shortlist that the steps write, from files to files: snapshot, register, match, score, shortlist."""
    cfg = write_inputs(spark, d)
    steps.run_register(spark, cfg)
    out = steps.run_pipeline(spark, cfg)
    validate.check_outputs(spark, cfg.out_dir)
    return tables.read_csv(spark, out, na_cells=False).select(F.col("Organisation Name").alias("org_name"), "ch_company_number", "role_fit_bucket")


#: Bytes of text in a file, as one task writes it and one reads a member of an archive.
PER_FILE = 1 << 26


def _texts(spark: SparkSession, d: str) -> str:
    """All documents as CSV files, with line breaks in cells, four at least and of about PER_FILE; the folder."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/texts-{uuid.uuid4().hex}"
    docs = _table(spark, d, "documents")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tables.write_csv(docs.select(F.col("doc_id").cast("string"), "text", "lang").repartition(max(4, -(-size // PER_FILE)), "doc_id"), f"{folder}/csv")
    return folder


def _read_back(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def q_quoted_breaks(spark: SparkSession, d: str) -> DataFrame:
    """Texts with line breaks, quotes and commas through CSV files and back."""
    return _read_back(tables.read_csv(spark, f"{_texts(spark, d)}/csv", na_cells=False))


def q_newest_file(spark: SparkSession, d: str) -> DataFrame:
    """Of a folder's CSV files the one written last, whatever the names; its columns are required."""
    folder = f"{shared_dir(spark).rstrip('/')}/tessera/registers-{uuid.uuid4().hex}"
    c = _table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    for name, part in (("b.csv", F.col("c_nationkey") < 10), ("a.csv", F.col("c_nationkey") >= 10), ("c.txt", F.lit(True))):
        tables.write_csv(c.filter(part), f"{folder}/{name}")
    return tables.read_register(spark, folder, ("c_custkey", "c_name")).select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", F.col("c_nationkey").cast("int").alias("c_nationkey"))


def q_archive(spark: SparkSession, d: str) -> DataFrame:
    """The same through an archive of several members."""
    folder = _texts(spark, d)
    tables.write_zip(spark, f"{folder}/csv", f"{folder}/texts.zip")
    fs, p = tables.filesystem(spark, f"{folder}/csv")
    fs.delete(p, True)  # the archive has it all
    return _read_back(tables.read_zip(spark, f"{folder}/texts.zip", f"{folder}/staging", every=True))


def q_match_runs(spark: SparkSession, d: str) -> DataFrame:
    """What several runs leave together: one register, then another one in its place, a run that dies between
    its writes, the first register again, and all runs put into one."""
    cfg = write_inputs(spark, d)
    half = F.crc32(names.normalise(F.col("`Organisation Name`")).cast("binary")) % 2
    raw = tables.read_csv(spark, cfg.register_path, na_cells=False, position="pos")
    for k in (0, 1):
        tables.write_csv(raw.filter(half == k).orderBy("pos").drop("pos"), f"{cfg.register_path[:-4]}-{k}.csv")
    cfgs = [dataclasses.replace(cfg, register_path=f"{cfg.register_path[:-4]}-{k}.csv") for k in (0, 1)]
    for k in (0, 1, 0):
        steps.run_register(spark, cfgs[k])
        steps.run_match(spark, cfgs[k])
        lost = ledger.claim(spark, cfg.out_dir, "lost")
        spark.createDataFrame([("nobody",)], "org_name string").write.parquet(f"{cfg.out_dir}/enriched/run={lost}")
    steps.compact(spark, cfg)
    m, u = steps.output(spark, cfg.out_dir, "enriched"), steps.output(spark, cfg.out_dir, "unmatched")
    return m.select("org_name", "match_status", F.col("match_score").alias("score"), F.col("ch_company_number").alias("number")).union(u.select("org_name", "match_status", "best_candidate_score", "best_candidate_company_number"))


QUERIES = {k: v for k, v in list(globals().items()) if k.startswith("q_")}
