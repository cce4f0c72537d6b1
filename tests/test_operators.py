import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera import errors
from tessera.operators import asof, audit, dealing, links, matching, prefixes, register, registry, resume, scoring, shortlist, summaries
from tessera.plans import queries, steps
from tessera.sources import config, profiles, tables
from tessera.stored import stored

RAW = [
    ("Acme Ltd", "London", "Greater London", "A rating", "Skilled Worker"),
    ("ACME Limited", "Leeds", "", "A rating", "Skilled Worker"),
    ("Beta plc", "London", "Greater London", "Provisional A rating", " Skilled Worker "),
    ("Gamma", "York", "nan", "A rating", "Skilled Worker"),
    ("Delta", "York", "", "A Rating", "Skilled Worker"),
    ("Epsilon", "York", "", "B rating", "Skilled Worker"),
    ("Zeta", "York", "", "A rating", "skilled worker"),
]


def rows(spark, raw=RAW):
    return register.coerce(spark.createDataFrame([(*r, i) for i, r in enumerate(raw)], "name string, town string, county string, rating string, route string, pos long").repartition(3), dict(zip(register.SHORT, register.SHORT)), "pos")


def test_register(spark):
    got = {r["org_norm"]: r.asDict() for r in register.register(rows(spark)).collect()}
    assert set(got) == {"acme", "beta", "gamma", "delta"}
    a = got["acme"]
    assert (a["org_name"], a["town"], a["county"], a["raw_name_variants"]) == ("Acme Ltd", "London | Leeds", "Greater London", "Acme Ltd | ACME Limited")
    assert a["has_multiple_towns"] and not a["has_multiple_counties"] and got["gamma"]["county"] == ""
    s = register.stats(rows(spark)).first()
    assert (s["total_rows"], s["skilled_rows"], s["a_rated_rows"], s["filtered_rows"], s["unique_names"], s["organisations"], s["merged"]) == (7, 6, 6, 5, 5, 4, 1)
    assert [tuple(r)[:2] for r in register.top_values(register.eligible(rows(spark)), "town", 2).collect()] == [("London", 2), ("York", 2)]


def test_register_blank_names_are_one_organisation(spark):
    got = register.register(rows(spark, [("Ltd", "a", "", "A rating", "Skilled Worker"), ("", "b", "", "A rating", "Skilled Worker")])).collect()
    assert len(got) == 1 and got[0]["org_norm"] == "" and got[0]["org_name"] == "Ltd"


CH = [
    ("11111111", "ACME LTD", "active", "ltd", "2015-01-01", "62020", "London", "Greater London", "EC1A 1BB", ""),
    ("22222222", "ACME ALPHA LTD", "active", "ltd", "2015-01-01", "62020;86101", "Leeds", "", "LS1", ""),
    ("33333333", "ALPHA LTD", "dissolved", "plc", "", "", "York", "", "YO1", ""),
]


def clean(spark):
    return spark.createDataFrame(CH, ", ".join(f"{c} string" for c in registry.CLEAN))


def test_two_tokens_need_two_hits(spark):
    v = spark.createDataFrame([("Acme Alpha",), ("Acme",)], "variant string")
    got = {(r["variant"], r["company_number"]) for r in matching.candidates(v, registry.companies(clean(spark))).collect()}
    assert got == {("Acme Alpha", "22222222"), ("Acme", "11111111"), ("Acme", "22222222")}
    assert matching.candidates(v, registry.companies(clean(spark)), 1).count() == 2


def brute_candidates(asked, companies, most):
    """Hits by looking at every pair; numbers repeat, their words add up."""
    words = {}
    for number, tokens in companies:
        words.setdefault(number, set()).update(tokens)
    out = set()
    for variant, tokens in asked.items():
        hits = sorted((-len(tokens & w), n) for n, w in words.items() if n and len(tokens & w) >= (2 if len(tokens) >= 2 else 1))
        out |= {(variant, n, -h) for h, n in hits[:most]}
    return out


def test_blocking_without_the_usual_word(spark):
    import random

    r = random.Random(7)
    vocabulary = [f"w{k}" for k in range(25)]
    weights = [40 / (k + 1) for k in range(25)]
    name = lambda: " ".join(dict.fromkeys(r.choices(vocabulary, weights, k=r.randint(1, 5))))
    titles = [(f"{r.randint(0, 150):04d}" if k % 9 else "", name()) for k in range(200)]
    asked = {name() for _ in range(60)} | {"w0", "nothing", "nothing w3", "nothing else", ""}
    rows_ = spark.createDataFrame([(n, t, k) for k, (n, t) in enumerate(titles)], "company_number string, company_name string, pos long").repartition(3)
    v = spark.createDataFrame([(a,) for a in asked], "variant string")
    for most in (500, 3):
        got = {tuple(x) for x in matching.candidates(v, registry.companies(rows_), most).collect()}
        assert got == brute_candidates({a: set(a.split()) for a in asked}, [(n, t.split()) for n, t in titles], most)


def test_first_row_of_a_repeated_number(spark):
    again = [("11111111", "BRAVO LTD", "dissolved", "plc", "", "", "Hull", "", "HU1", ""), ("", "ACME", "active", "", "", "", "", "", "", "")]
    twice = clean(spark).unionByName(spark.createDataFrame(again, clean(spark).schema)).coalesce(1).withColumn("pos", F.monotonically_increasing_id()).repartition(3)
    got = {x["company_number"]: x for x in registry.companies(twice).collect()}
    assert set(got) == {"11111111", "22222222", "33333333"} and got["11111111"]["company_name"] == "ACME LTD" and got["11111111"]["title_tokens"] == ["acme", "bravo"]
    orgs = spark.createDataFrame([("Acme Ltd", "London", "Greater London"), ("Bravo", "", "")], "org_name string, town string, county string")
    m = steps.match(orgs, twice)
    e = m.enriched.collect()
    assert [(x["org_name"], x["ch_company_name"], x["ch_company_status"]) for x in e] == [("Acme Ltd", "ACME LTD", "active")]
    assert sorted((x["org_name"], x["rank"]) for x in m.candidates.collect()) == [("Acme Ltd", 1), ("Acme Ltd", 2), ("Bravo", 1)]
    assert registry.companies(registry.companies(twice)).count() == 3


def test_top_of_each_variant_is_enough(spark):
    orgs = spark.createDataFrame([("Acme T/A Alpha", "York", ""), ("Alpha (Acme)", "", ""), ("Acme Alpha - Acme", "Leeds", "")], "org_name string, town string, county string")
    more = spark.createDataFrame([(f"9{k:07d}", f"ACME {'ALPHA ' * (k % 3)}X{k % 5} LTD", "active", "ltd", "", "", "York" if k % 2 else "Leeds", "", "", "") for k in range(40)], clean(spark).schema)
    all_ = clean(spark).unionByName(more)
    key = lambda df: sorted(map(str, df.select("org_name", "rank", "variant", "company_number", "total").collect()))
    assert key(matching.top_candidates(orgs, all_)) == key(matching.ranked(matching.scored_candidates(orgs, all_)))


def test_match_outputs(spark):
    orgs = spark.createDataFrame([("Acme Ltd", "London", "Greater London"), ("Alpha", "York | Hull", ""), ("Nobody Here", "", "")], "org_name string, town string, county string")
    m = steps.match(orgs, clean(spark))
    e = {r["org_name"]: r for r in m.enriched.collect()}
    assert set(e) == {"Acme Ltd"} or set(e) == {"Acme Ltd", "Alpha"}
    a = e["Acme Ltd"]
    assert a["ch_company_number"] == "11111111" and a["match_score"] == 1.0 and a["score_locality_bonus"] == 0.08 and a["match_confidence"] == "high"
    u = {r["org_name"]: r for r in m.unmatched.collect()}
    assert u["Nobody Here"]["best_candidate_score"] is None and u["Nobody Here"]["best_candidate_title"] == ""
    assert set(e) | set(u) == {"Acme Ltd", "Alpha", "Nobody Here"} and not set(e) & set(u)
    lost = matching.profile_errors(matching.best(orgs, matching.ranked(matching.scored_candidates(orgs, clean(spark)))), clean(spark).filter("company_number <> '11111111'")).collect()
    assert [r["match_status"] for r in lost if r["org_name"] == "Acme Ltd"] == ["profile_error"]


def test_early_stop_and_double_ranks(spark):
    orgs = spark.createDataFrame([("Acme T/A Alpha", "", "")], "org_name string, town string, county string")
    got = [(r["variant_index"], r["company_number"]) for r in matching.scored_candidates(orgs, clean(spark)).collect()]
    assert {i for i, _ in got} >= {0}


def test_registry_clean(spark):
    names_ = list(registry.BULK.values())
    row = ["ACME LTD", "11111111", "Private Limited Company", "Active", "11/09/2012", "62020 - IT", "", "", "", "London", "Kent", "EC1", "http://x.example/doc/company/11111111/"]
    df = spark.createDataFrame([row], ", ".join(f"`{c}` string" for c in names_))
    r = registry.clean(df).first()
    assert (r["company_type"], r["date_of_creation"], r["sic_codes"], r["company_status"]) == ("private-limited-company", "2012-09-11", "62020", "active")
    bad = spark.createDataFrame([[*row[:-1], "http://x.example/doc/company/2"]], df.schema)
    with pytest.raises(Exception, match="differ"):
        registry.clean(bad).collect()
    with pytest.raises(errors.RegistryUriMismatchError):
        registry.check_uris(registry.clean(bad, strict=False))
    with pytest.raises(errors.MissingColumnsError):
        registry.require(df.drop("URI"), names_, "registry")
    ix = {tuple(x) for x in registry.token_index(clean(spark)).collect()}
    assert ("a", "acme", "11111111") in ix and ("a", "alpha", "33333333") in ix and len(ix) == 4
    assert registry.restrict_index(registry.token_index(clean(spark)), spark.createDataFrame([("acme",)], "token string")).count() == 2
    assert registry.search_view(clean(spark)).first()["address"]["locality"] == "London" and registry.profile_view(clean(spark)).collect()[1]["sic_codes"] == ["62020", "86101"]


def features(spark, **kw):
    base = {"org_name": "x", "ch_company_name": "Acme Software", "ch_sic_codes": "62020", "ch_company_status": "active", "ch_date_of_creation": "2015-01-01", "ch_company_type": "ltd"} | kw
    return scoring.features(spark.createDataFrame([base]), profiles.TECH, F.lit("2026-02-10").cast("date")).first()


def test_scores(spark):
    r = features(spark)
    assert (r["sic_tech_score"], r["is_active_score"], r["company_age_score"], r["company_type_score"]) == (0.5, 0.1, 0.12, 0.08) and r["name_keyword_score"] == pytest.approx(0.05)
    assert r["role_fit_bucket"] == "strong"
    assert features(spark, ch_sic_codes="62020;86101")["sic_tech_score"] == pytest.approx(0.25)
    assert features(spark, ch_sic_codes="86101;62020")["sic_tech_score"] == pytest.approx(0.5)
    assert features(spark, ch_sic_codes="")["sic_tech_score"] == pytest.approx(0.1)
    assert [features(spark, ch_date_of_creation=d)["company_age_score"] for d in ("", "soon", "2030-01-01", "2025-12-01", "2023-01-01")] == [0.05, 0.05, 0.05, 0.02, 0.07]
    assert features(spark, ch_company_type="public-limited-company")["company_type_score"] == 0.03
    assert features(spark, ch_company_name="", org_name="Care Home")["name_keyword_score"] == pytest.approx(-0.05)


def test_employees(spark):
    counts = spark.createDataFrame([("1", "5", "s", "d"), ("1", "5", "s", "d"), ("2", "7", "s", "d")], "company_number string, employee_count string, employee_count_source string, employee_count_snapshot_date string")
    rows_ = spark.createDataFrame([(" 1 ",), ("9",)], "ch_company_number string")
    got = {r["ch_company_number"]: r["employee_count"] for r in scoring.attach_employees(rows_, scoring.employee_lookup(counts)).collect()}
    assert got == {" 1 ": "5", "9": ""}
    with pytest.raises(errors.ConflictingRowsError):
        scoring.employee_lookup(counts.union(spark.createDataFrame([("2", "8", "s", "d")], counts.schema)))
    with pytest.raises(errors.InvalidValueError, match="<empty>"):
        scoring.check_scores(spark.createDataFrame([("",), ("1.5",), ("x",)], "match_score string"))


def scored(spark):
    data = [("a", 0.7, "strong", "1200", "Manchester", "Salford", "M1"), ("b", 0.6, "possible", "200", "", "Leeds", "LS1"), ("c", 0.4, "possible", "", "", "", ""), ("d", 0.9, "unlikely", "", "", "", ""), ("e", 0.8, "strong", "", "", "salford", "")]
    return spark.createDataFrame(data, "org_name string, role_fit_score double, role_fit_bucket string, employee_count string, ch_address_region string, ch_address_locality string, ch_address_postcode string")


def names_of(df):
    return sorted(r["org_name"] for r in df.collect())


def test_shortlist(spark):
    s = scored(spark)
    assert names_of(shortlist.shortlist(s, 0.5)) == ["a", "b", "e"]
    assert names_of(shortlist.shortlist(s, 0.5, 1000)) == ["a"]
    assert names_of(shortlist.shortlist(s, 0.5, 1000, True)) == ["a", "e"]
    bad = s.withColumn("employee_count", F.when(F.col("org_name") == "a", "abc").otherwise(F.col("employee_count")))
    with pytest.raises(errors.InvalidValueError):
        shortlist.shortlist(bad, 0.5, 1000)
    assert names_of(shortlist.shortlist(bad, 0.5)) == ["a", "b", "e"]
    known = shortlist.locations({"locations": [{"canonical_name": "Manchester", "aliases": ["Greater Manchester"], "regions": ["Manchester"], "localities": ["Salford"], "postcode_prefixes": ["m"]}]})
    place = shortlist.geo_filter("greater manchester", [], known)
    assert place == shortlist.GeoFilter(("greater manchester", "manchester"), ("salford",), ("M",))
    assert names_of(shortlist.shortlist(s, 0.5, place=place)) == ["a", "e"]
    assert shortlist.shortlist(s.limit(0), 0.5, place=place).count() == 0
    assert shortlist.geo_filter(None, [], known) == shortlist.GeoFilter()
    with pytest.raises(errors.NotAvailableError):
        shortlist.search(s)


def test_audit(spark):
    e = spark.createDataFrame([("a", "1", "A", "0.9", "0.5", "active"), ("b", "1", "B", "0.8", "0.9", "closed"), ("a", "2", "C", "0.8", "0.9", "active")], "org_name string, ch_company_number string, ch_company_name string, match_score string, score_name_similarity string, ch_company_status string")
    u = spark.createDataFrame([("b", "0.71"), ("c", None)], "org_name string, best_candidate_score string")
    m = audit.metrics(e, u).first().asDict()
    assert (m["total_rows"], m["duplicate_org_enriched"], m["overlap_org_between_sets"], m["low_similarity_matches"], m["non_active_matches"], m["non_unique_company_number_rows"], m["near_threshold_unmatched"]) == (5, 1, 1, 1, 1, 2, 1)
    with pytest.raises(errors.AuditError):
        audit.check_structure(m)
    assert audit.breaches(m) == [] and audit.breaches(m, audit.Thresholds(max_non_active=0)) != []
    rows = spark.createDataFrame([m]).withColumn("run", F.lit("r1"))
    for t in (audit.Thresholds(), audit.Thresholds(max_non_active=0)):
        found = audit.findings(rows, t).filter("failed AND kind = 'threshold'").collect()
        assert [f"{r['name']}: {r['value']} > {r['most']}" for r in found] == audit.breaches(m, t) and all(r["run"] == "r1" for r in found)
    assert audit.findings(rows).count() == len(audit.STRUCTURE) + 4 and audit.findings(rows.filter("false")).count() == 0
    assert audit.differences(e, e).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_audit_joins_outputs_once(spark):
    """All metrics read the outputs as written; none joins the ranking with companies again."""
    read = queries.q_audit(spark, "/root/testdata/sf0.001").inputFiles()
    assert read and all("/audited-" in f for f in read)


def test_cap_keeps_the_first_numbers(spark):
    """With generic words the cap by sets and by numbers gives what ranking all pairs does."""
    rows = [(f"{(k * 7919) % 5000:08d}", f"Alpha Beta Gamma{k % 40}" if k % 3 else f"Alpha Beta {k % 2}x Delta") for k in range(600)]
    rows = [(n, t, *["" for _ in registry.CLEAN[2:]]) for n, t in rows]
    companies = registry.companies(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in registry.CLEAN)))
    asked = ["Alpha Beta", "Beta Gamma3 Alpha", "Delta", "Alpha", "Zeta Alpha", "Gamma7 Delta Beta"]
    tokens = {n: set(t.lower().split()) for n, t, *_ in rows}
    for cap in (1, 7, 50, 10_000):
        want = set()
        for v in asked:
            q = set(v.lower().split())
            met = sorted((-len(q & t), n) for n, t in tokens.items() if len(q & t) >= min(2, len(q)))
            want |= {(v, n, -h) for h, n in met[:cap]}
        got = matching.candidates(spark.createDataFrame([(v,) for v in asked], "variant string"), companies, cap)
        assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_asof_join(spark):
    """Ties, rows before all snapshots, keys or times that are missing, repeated rows, any period."""
    left = [(1, "a", "2026-01-05"), (1, "a", "2026-01-05"), (2, "a", "2025-12-31"), (3, "a", "2026-07-01"), (4, "b", "2026-07-01"), (5, None, "2026-07-01"), (6, "a", None), (7, "c", "2026-01-01"), (8, "a", "2026-01-01")]
    right = [("a", "2026-01-01", 10), ("a", "2026-01-05", 20), ("a", "2026-01-05", 15), ("a", "2026-01-06", None), ("a", "2026-02-01", 30), ("c", "2026-01-02", 5), (None, "2026-01-01", 9), ("b", None, 8)]
    a = spark.createDataFrame(left, "id int, k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    b = spark.createDataFrame(right, "k string, since string, v int").withColumn("since", F.col("since").cast("date"))
    want = sorted([(1, 20), (1, 20), (2, None), (3, 30), (4, None), (5, None), (6, None), (7, None), (8, 10)], key=str)
    for period in ("day", "month", "year"):
        got = asof.asof_join(a, b, "k", "t", "since", ["v"], period)
        assert sorted(((r["id"], r["v"]) for r in got.collect()), key=str) == want
        assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert asof.asof_join(a.limit(0), b, "k", "t", "since", ["v"]).count() == 0


def test_resume(spark):
    r = spark.createDataFrame([(f"o{i:02d}", i) for i in range(10)], "org_name string, n int").repartition(4)
    done = resume.processed(r.filter("n < 3"), r.filter("n < 2"))
    left = resume.pending(r, done)
    assert left.count() == 7
    got = {x["org_name"]: x["batch"] for x in resume.batches(left, ["org_name"], 3, 2, 1).collect()}
    assert got == {"o06": 2, "o07": 2, "o08": 2}
    c = resume.counters(r, done, 3).first()
    assert (c["total_rows"], c["processed"], c["unprocessed"], c["batches"], c["remaining"]) == (10, 3, 7, 3, 7)
    dup = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k string, p int, v string")
    assert {x["k"]: x["v"] for x in resume.keep_first(dup, ["k"], [F.col("p")]).collect()} == {"a": "x", "b": "z"}
    assert {x["k"]: x["v"] for x in resume.latest(dup, "k", "p").collect()} == {"a": "y", "b": "z"}
    assert resume.coerce(dup, ("v", "w")).columns == ["v", "w"]


def test_links(spark):
    html = '<a href="/x/register.csv">Licensed  sponsors</a><a>no</a><a href="/y.csv">other</a><a href="z.html">worker</a>'
    page = spark.createDataFrame([(1, "https://e.example/p", html)], "k long, url string, html string")
    found = links.extract_links(page, "k", "url", "html")
    assert [(r["href"], r["text"]) for r in found.orderBy("nth").collect()][0] == ("https://e.example/x/register.csv", "Licensed sponsors")
    assert links.the_best_link(found) == "https://e.example/x/register.csv"
    with pytest.raises(errors.LinkNotFoundError):
        links.the_best_link(found, links.ZIP)
    two = spark.createDataFrame([("http://e/BasicCompanyDataAsOneFile-2026-01-01.zip",), ("http://e/BasicCompanyDataAsOneFile-2026-02-01.zip",)], "href string")
    assert links.the_archive_link(two).endswith("2026-02-01.zip")
    with pytest.raises(errors.AmbiguousLinkError):
        links.the_best_link(spark.createDataFrame([(1, "a.csv", ""), (1, "b.csv", "")], "key long, href string, text string"))


def test_archive_links_of_many_pages(spark):
    """Each page against the rule for one page."""
    deal, base = random.Random(9), "http://e/BasicCompanyDataAsOneFile"
    some = [f"{base}-2026-01-01.zip", f"{base}-2026-02-01.zip", f"{base}-2026-02-01.ZIP?x", f"{base}.zip", "http://e/basiccompanydataasonefile.zip", "http://e/o.zip", "http://e/p.html", None]
    pages = [(k, deal.choice(some)) for k in range(24) for _ in range(deal.randrange(1, 4))] + [(30, some[3])]
    df = spark.createDataFrame(pages, "key long, href string")
    got = {r["key"]: (r["href"], r["status"]) for r in links.archive_links(df).collect()}
    seen = set()
    for k in {p[0] for p in pages}:
        try:
            expect = (links.the_archive_link(df.filter(F.col("key") == k)), "found")
        except (errors.AmbiguousLinkError, errors.LinkNotFoundError) as e:
            expect = (None, "ambiguous" if isinstance(e, errors.AmbiguousLinkError) else "missing")
        assert got[k] == expect, (k, [p for p in pages if p[0] == k])
        seen.add(expect[1])
    assert seen == {"found", "ambiguous", "missing"} and len(got) == len({p[0] for p in pages})


def test_catalogue_of_ten_thousand_prefixes(spark):
    """Against the fold by hand, with codes that repeat, are empty, null, long or lists of many."""
    deal = random.Random(5)
    order = [f"{k:0{4 + k % 2}d}" for k in range(10_000)]
    deal.shuffle(order)
    catalogue = [(k, deal.choice([None, deal.randrange(40) / 64]), deal.choice([None, -deal.randrange(9) / 64]), n) for n, k in enumerate(order)] + [("", None, -1 / 128, 10_000), (None, 9.0, None, 3)]
    lists = [";".join(str(deal.randrange(10**5)) for _ in range(deal.randrange(6))) for _ in range(300)] + [None, "", " ; ", "7" * 5000, "1234;1234", "1234;1234"]
    by = {c[0]: c for c in catalogue if c[0] is not None}

    def score(codes):
        s = 0.1
        for x in [c.strip() for c in (codes or "").split(";") if c.strip()]:
            fit = [by[x[:n]] for n in range(6) if n <= len(x) and x[:n] in by]
            s = max([s, *[f[1] for f in fit if f[1] is not None]])
            for f in sorted(fit, key=lambda f: f[3]):
                s += f[2] or 0.0
        return min(max(s, 0.0), 0.5)

    table = spark.createDataFrame(catalogue, prefixes.WEIGHTS)
    given = spark.createDataFrame(list(enumerate(lists)), "id long, codes string").repartition(3)
    got = {r["id"]: r["score"] for r in prefixes.sic_scores(given, "codes", table, "score").collect()}
    assert got == {k: score(x) for k, x in enumerate(lists)}
    assert {r["score"] for r in prefixes.sic_scores(given, "codes", table.limit(0), "score").collect()} == {0.1}
    assert prefixes.sic_scores(given.limit(0), "codes", table, "score").count() == 0
    with pytest.raises(errors.ConflictingRowsError):
        prefixes.sic_scores(given, "codes", table.union(table.filter("nth = 5")))


def test_located_as_by_filter(spark):
    known = [shortlist.Location("a", (), ("north",), ("york", "o"), ("EC1", "N")), shortlist.Location("b", (), ("orth east",), (), ()), shortlist.Location("c", (), (), ("york",), ("NE1 2AB",))]
    given = [(k, *x) for k, x in enumerate([("North East", "York", "ec12 1aa"), (None, "north hill", None), ("", "", ""), (None, None, None), ("south", "leeds", "NE1 2AB"), ("North East", "York", "ec12 1aa"), ("York", "x", "e1")])]
    df = spark.createDataFrame(given, "id long, ch_address_region string, ch_address_locality string, ch_address_postcode string").repartition(3)
    found = prefixes.located(df, prefixes.terms(spark, known).union(spark.createDataFrame([("a", "region", " "), ("a", "region", None)], prefixes.TERMS)))
    got = sorted((r["place"], r["id"]) for r in found.collect())
    expect = sorted((k.canonical, r["id"]) for k in known for r in df.filter(shortlist.in_place(shortlist.GeoFilter(k.regions, k.localities, k.postcodes))).collect())
    assert got == expect and expect
    assert prefixes.located(df, prefixes.terms(spark, known).limit(0)).columns == [*df.columns, "place"]


def test_summaries_merge(spark, tmp_path):
    """Statistics of parts from their summaries equal those of all rows, with an empty snapshot among them."""
    raw = RAW + [("Acme Ltd", "York", None, "A rating", "Skilled Worker"), ("Ltd", "", "", "A rating", "Skilled Worker")]
    whole = rows(spark, raw)
    paths = [f"{tmp_path}/{k}" for k in range(4)]
    for k, part in enumerate(("pos < 3", "pos BETWEEN 3 AND 5", "pos > 100", "pos > 5")):
        summaries.write(whole.filter(part), paths[k], k)
    expect = register.stats(whole).first().asDict()
    assert summaries.stats(spark, paths).first().asDict() == expect
    assert summaries.stats(spark, paths[2:3]).first()["total_rows"] == 0
    about = summaries.estimates(spark, paths).first()
    assert (about["names"], about["organisations"], about["total_rows"]) == (expect["unique_names"], expect["organisations"], expect["total_rows"])
    top = [tuple(r)[:2] for r in register.top_values(register.eligible(whole), "town").collect()]
    assert [tuple(r)[:2] for r in summaries.top_values(spark, paths, "town").collect()] == top
    summaries.write(whole.filter("pos < 3"), paths[0], 0)  # again
    assert summaries.stats(spark, paths).first().asDict() == expect
    with pytest.raises(errors.MissingInputError):
        summaries.stats(spark, [])


def test_candidates_list_few_numbers(spark):
    """However many companies share a set of words, and sets share words, few more numbers are listed than are kept;
    and of those that score alike only the first can be ranked."""
    rows = [(f"{(k * 7919) % 6000:08d}", f"Alpha Beta Gamma{k % 20}", "active" if k % 40 < 20 else "closed", *["" for _ in registry.CLEAN[3:]]) for k in range(6000)]
    all_ = registry.companies(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in registry.CLEAN)))
    known = matching.index(all_, most=100)
    got = matching.candidates(spark.createDataFrame([("Alpha Beta",)], "variant string"), known, 100)
    assert sorted(r["company_number"] for r in got.collect()) == [f"{k:08d}" for k in range(100)]
    nodes, listed = [got._jdf.queryExecution().executedPlan()], []
    while nodes:
        x = nodes.pop()
        if x.nodeName() == "AdaptiveSparkPlan":
            nodes.append(x.executedPlan())
        elif x.nodeName().endswith("QueryStage"):
            nodes.append(x.plan())
        nodes += [x.children().apply(k) for k in range(x.children().size())]
        if x.nodeName() == "Generate" and "listed" in x.toString():
            listed.append(x.metrics().apply("numOutputRows").value())
    assert listed and 100 <= max(listed) <= 2 * 100 + 20
    orgs = spark.createDataFrame([("Alpha Beta Gamma3", "", "")], "org_name string, town string, county string")
    key = lambda df: sorted(map(str, df.select("org_name", "rank", "variant", "company_number", "title", "status", "total").collect()))
    assert key(matching.top_candidates(orgs, known, 100)) == key(matching.ranked(matching.scored_candidates(orgs, all_, 100)))
    with pytest.raises(ValueError):
        matching.candidates(spark.createDataFrame([("Alpha",)], "variant string"), known, 101)


def test_blocks_of_numbers(spark):
    nth = [1, 2, 3, 4, 5, 8, 9, 4095, 4096, 4097, 8192, 8193, 12288, 12289]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in nth], "n int").coalesce(1).select(matching._block(F.col("n"))).collect()]
    assert got == [0, 1, 2, 2, 3, 3, 4, 12, 12, 13, 13, 14, 14, 15] == [matching._last_block(n) for n in nth]


def test_companies_of_one_file_are_many_tasks(spark):
    """A file of short rows is one partition; its companies are taken apart in all of them."""
    one = clean(spark).coalesce(1)
    assert registry.companies(one).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r["title_norm"] for r in registry.companies(one).collect()) == ["acme", "acme alpha", "alpha"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_views_are_cleaned_in_many_tasks(spark):
    for made in (queries._clean, queries._rows):
        assert made(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_views_are_dealt_before_they_are_wide(spark):
    """The table's few columns go through the shuffle by its key, not the view's many texts."""
    for made in (queries._clean, queries._rows):
        plan = made(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "RepartitionByExpression [p_partkey" in plan and plan.count("Repartition") == 1


def test_no_file_per_partition_and_task(spark):
    """As many partitions as Spark writes file by file are one more; few, or more than that, are left as they are."""
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for asked, dealt in ((before, int(before)), ("200", 201), ("300", 300)):
            spark.conf.set(key, asked)
            assert dealing.dealt(spark.range(10), "id").rdd.getNumPartitions() == dealt
    finally:
        spark.conf.set(key, before)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_steps_on_few_rows_are_dealt_thinly(spark):
    """with many shuffle partitions only whole tables are dealt over all of them, not each step after another."""
    key, before = "spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for asked, thin in (("200", 50), ("2000", 500)):
            spark.conf.set(key, asked)
            assert queries._rows(spark, "/root/testdata/sf0.001").rdd.getNumPartitions() == thin
            plan = matching.candidates(spark.createDataFrame([("acme alpha",)], "variant string"), matching.index(registry.companies(clean(spark)), most=10), 10)._jdf.queryExecution().optimizedPlan().toString()
            dealt = [int(n) for n in re.findall(r"RepartitionByExpression .*\], (\d+)", plan)]
            assert dealt.count(thin) == 3 and set(dealt) <= {thin, dealing.width(spark)}
    finally:
        spark.conf.set(key, before)


def test_one_sort_a_company_and_one_pass_over_names(spark):
    """a company's first row and words come from one sort; the register's names are normalised in one branch."""
    shape = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    found = shape(registry.companies(clean(spark)))
    assert "Aggregate" not in found and found.count("Window [") == 1
    assert "Join" not in shape(register.rollup(rows(spark)))


def test_register_positions_without_a_name(spark):
    """a name that no field keeps ("nan") still has its position, an unknown position goes first."""
    raw = [("nan", "", "nan", "", "", 5), ("nan", "York", "", "", "", 3), ("Acme", "", "", "", "", 7), ("acme", "", "", "", "", None)]
    given = spark.createDataFrame(raw, "name string, town string, county string, rating string, route string, pos long")
    got = {r["norm"]: r.asDict() for r in register.rollup(given, F.lower).collect()}
    assert (got["nan"]["pos"], got["nan"]["name_list"], got["nan"]["town_list"], got["nan"]["county_list"]) == (3, [], ["York"], [])
    assert (got["acme"]["pos"], got["acme"]["name_list"]) == (None, ["acme", "Acme"])


def test_sets_come_from_faces(spark):
    """An index groups companies once: its sets are read from the stored faces and are those of all companies."""
    read = {}

    def keep(df, name):
        read[name] = df.inputFiles()
        return stored(df, name)

    known = registry.companies(clean(spark).union(clean(spark).withColumn("company_number", F.concat(F.lit("0"), F.substring("company_number", 1, 7)))))
    made = matching.index(known, most=10, keep=keep)
    assert read["sets"] and all("/faces-" in f for f in read["sets"])
    assert {(r["words"], r["least"]) for r in made.postings.select("words", "least").collect()} == {("acme", "01111111"), ("acme alpha", "02222222"), ("alpha", "03333333")}


def test_register_counts_equal_rows_once(spark):
    """A row that comes again later, in other white space too, changes nothing of the register and goes before
    names are normalised."""
    again = RAW + [(f" {r[0]}", *r[1:]) for r in RAW[::-1]] + RAW[::-1]
    a, b = ({tuple(map(str, r)) for r in register.rollup(rows(spark, x), F.lower).collect()} for x in (RAW, again))
    assert a == b
    assert sorted(r["pos"] for r in register.firsts(rows(spark, again)).collect()) == list(range(len(RAW)))


def test_register_of_many_files_is_in_order_of_their_names(spark, tmp_path):
    """Spark reads the largest file first; first-seen order follows the names."""
    (tmp_path / "list.csv").mkdir()
    head = ",".join(register.COLUMNS)
    for k, names in enumerate((["Acme Ltd"], ["ACME Limited", "Beta plc", "Gamma and a longer name"])):
        (tmp_path / "list.csv" / f"part-{k}.csv").write_text("\n".join([head, *[f"{n},London,,A rating,Skilled Worker" for n in names]]) + "\n")
    out = steps.run_register(spark, config.Config(register_path=str(tmp_path / "list.csv"), out_dir=str(tmp_path / "out")))
    got = {r["org_name_normalised"]: r["raw_name_variants"] for r in tables.read_csv(spark, out).collect()}
    assert got["acme"] == "Acme Ltd | ACME Limited" and len(got) == 3
