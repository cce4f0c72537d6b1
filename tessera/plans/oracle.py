"""The queries again as plain SQL for an independent engine. Nothing but the text of the input views is
taken from the engine; all values that decide a result are stated here again."""

from __future__ import annotations

from types import SimpleNamespace

from tessera.plans import views

#: Suffixes, size bands, the day and the two shipped profiles, as the contract has them.
_SUFFIXES = (
    "private limited company|public limited company|limited liability partnership|community interest company|limited|ltd|plc|llp|cic|incorporated|inc|corporation|corp|company|co|group|holdings|uk|international|intl"
)
_BAND_TOPS = ((10, "micro"), (50, "small"), (250, "medium"), (999, "large"))
AS_OF = "2026-02-10"
_TYPES = {"ltd": 0.08, "private-limited-company": 0.08, "public limited company": 0.05, "plc": 0.05, "llp": 0.06, "limited-partnership": 0.04, "community-interest-company": 0.02, "charitable-incorporated-organisation": 0.01}
_AGES = ((10, 0.12), (5, 0.10), (2, 0.07), (1, 0.04), (0, 0.02))
TECH = SimpleNamespace(
    sic_positive={"620": 0.5, "631": 0.4, "582": 0.35, "611": 0.25, "612": 0.25, "619": 0.2, "721": 0.2, "722": 0.15, "711": 0.15},
    sic_negative={"861": -0.25, "862": -0.2, "869": -0.15, "871": -0.25, "872": -0.25, "873": -0.25, "879": -0.25, "412": -0.15, "411": -0.1, "432": -0.1, "439": -0.1, "561": -0.2, "562": -0.2, "551": -0.15},
    keyword_positive="software digital tech technology data ai cloud cyber app platform saas fintech healthtech edtech devops analytics machine learning automation".split(),
    keyword_negative="care nursing recruitment staffing construction cleaning security catering restaurant hotel".split(),
    type_weights=_TYPES,
    age_bands=_AGES,
)
CARE = SimpleNamespace(
    sic_positive={"861": 0.4, "862": 0.4, "869": 0.35, "871": 0.5, "872": 0.5, "873": 0.5, "879": 0.4, "881": 0.35},
    sic_negative={"620": -0.25, "631": -0.2, "582": -0.2, "611": -0.15, "612": -0.15, "619": -0.15},
    keyword_positive="care nursing health support homecare clinic medical".split(),
    keyword_negative="software digital tech technology cloud platform saas".split(),
    type_weights=_TYPES,
    age_bands=_AGES,
)


def _r4(x: str) -> str:
    """Four digits by the exact binary value, ties to even, as printing does it."""
    return f"CAST(printf('%.4f', {x}) AS DOUBLE)"


def _norm(x: str) -> str:
    """names.normalise() of ASCII text."""
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9_\s]', ' ', 'g'), '\b(?:{_SUFFIXES})\b', ' ', 'g'), '\s+', ' ', 'g'))"


def _norm_any(x: str) -> str:
    """names.normalise() of any text. Words' borders are consumed, so each removal runs twice."""
    out = rf"regexp_replace(lower(coalesce({x}, '')), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    pattern = rf"(^|[^\p{{L}}\p{{N}}_])(?:{_SUFFIXES})($|[^\p{{L}}\p{{N}}_])"
    for _ in range(2):
        out = rf"regexp_replace({out}, '{pattern}', '\1 \2', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


def _tokens(norm: str) -> str:
    return f"list_sort(list_distinct(list_filter(string_split({norm}, ' '), lambda t: length(t) >= 2)))"


def _key(norm: str) -> str:
    return f"array_to_string(list_sort(string_split({norm}, ' ')), ' ')"


def _bucket(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '^[a-z]') THEN substr({x}, 1, 1) WHEN regexp_matches({x}, '^[0-9]') THEN '0-9' ELSE '_' END"


def _similarity(a: str, b: str) -> str:
    jaccard = f"len(list_intersect(string_split({a}, ' '), string_split({b}, ' ')))::DOUBLE / greatest(1, len(list_distinct(list_concat(string_split({a}, ' '), string_split({b}, ' ')))))"
    count = lambda s: f"length({s}) - length(replace({s}, ch, ''))"
    shared = f"coalesce(list_sum(list_transform(list_filter(list_distinct(string_split({a}, '')), lambda ch: ch <> ''), lambda ch: least({count(a)}, {count(b)}))), 0)"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE 0.6::DOUBLE * ({jaccard}) + 0.4::DOUBLE * ({shared}::DOUBLE / greatest(length({a}), length({b}), 1)) END"


def _variants(x: str) -> str:
    marks = (r"\bt/a\b", r"\btrading\s+as\b", r"\bt\.a\.\b", r"\bdba\b")
    after = ", ".join(f"nullif(trim(regexp_extract({x}, '(?is){m}(.*)', 1)), '')" for m in marks)
    before = "CASE " + " ".join(f"WHEN regexp_matches({x}, '(?i){m}') THEN trim(regexp_extract({x}, '(?is)^(.*?){m}', 1))" for m in marks) + " ELSE '' END"
    outside = rf"trim(regexp_replace({x}, '\([^)]*\)', '', 'g'))"
    return (
        f"list_concat([trim({x})], CASE WHEN coalesce({after}) IS NOT NULL THEN [coalesce({after}), {before}] ELSE [] END,"
        f" CASE WHEN {outside} <> '' AND {outside} <> trim({x}) THEN [{outside}] ELSE [] END,"
        rf" list_filter(list_transform(regexp_extract_all({x}, '\(([^)]+)\)', 1), lambda b: trim(b)), lambda b: length(b) > 2),"
        rf" list_filter(list_transform(regexp_split_to_array({x}, '\s+[-/|]\s+'), lambda b: trim(b)), lambda b: b <> '' AND b <> trim({x})))"
    )


def _listed(field: str, order: str) -> str:
    return f"{field}s AS (SELECT norm, string_agg({field}, ' | ' ORDER BY {order}) AS listed, count(*) AS n, arg_min({field}, p) AS first FROM (SELECT norm, {field}, min(pos) AS p FROM elig WHERE {field} <> '' GROUP BY norm, {field}) GROUP BY norm)"


_P: dict[str, str] = {
    "reg_v": views.sql(views.REGISTER),
    "elig": f"SELECT *, {_norm('name')} AS norm FROM reg_v WHERE route = 'Skilled Worker' AND lower(rating) LIKE '%a rating%'",
}
_REG = "reg_v AS (" + _P["reg_v"] + "), elig AS (" + _P["elig"] + "), " + ", ".join([_listed("name", "p"), _listed("town", "p"), _listed("county", "p"), _listed("rating", "rating"), _listed("route", "route")]) + """,
org AS (SELECT names.first AS org_name, norm AS org_norm, towns.n > 1 AS has_multiple_towns, countys.n > 1 AS has_multiple_counties, towns.listed AS town, countys.listed AS county,
  ratings.listed AS rating, routes.listed AS route, names.listed AS raw_name_variants FROM names JOIN towns USING (norm) JOIN countys USING (norm) JOIN ratings USING (norm) JOIN routes USING (norm))"""
_SIC = lambda c: f"CASE WHEN contains({c}, ' - ') THEN trim(substr({c}, 1, instr({c}, ' - ') - 1)) ELSE trim({c}) END"
_CLEAN = f"""ch_v AS ({views.sql(views.REGISTRY)}),
clean AS (SELECT number AS company_number, trim(name) AS company_name, lower(trim(status)) AS company_status,
  regexp_replace(trim(regexp_replace(lower(category), '[^a-z0-9]+', ' ', 'g')), ' +', '-', 'g') AS company_type,
  CASE WHEN trim(incorporated) = '' THEN '' ELSE strftime(coalesce(try_strptime(incorporated, '%Y-%m-%d'), try_strptime(incorporated, '%d/%m/%Y')), '%Y-%m-%d') END AS date_of_creation,
  array_to_string(list_filter([{_SIC('sic1')}, {_SIC('sic2')}], lambda x: x <> ''), ';') AS sic_codes,
  town AS address_locality, county AS address_region, postcode AS address_postcode, uri FROM ch_v)"""
_VAR = f"""vlist AS (SELECT org_name, {_variants('org_name')} AS vs FROM (SELECT DISTINCT org_name FROM org)),
vnorm AS (SELECT org_name, vs, list_transform(vs, lambda v: {_norm('v')}) AS ns FROM vlist),
vkept AS (SELECT org_name, list_transform(list_filter(generate_series(1, len(vs)), lambda i: i = 1 OR (ns[i] <> '' AND list_position(ns, ns[i]) = i))[1:5], lambda i: vs[i]) AS vs FROM vnorm),
variants AS (SELECT org_name, unnest(generate_series(0, len(vs) - 1)) AS variant_index, unnest(vs) AS variant FROM vkept)"""
_BLOCK = f"""asked AS (SELECT DISTINCT variant, {_tokens(_norm('variant'))} AS tokens FROM variants),
asked_token AS (SELECT variant, len(tokens) AS n, unnest(tokens) AS token FROM asked),
idx AS (SELECT DISTINCT unnest({_tokens(_norm('company_name'))}) AS token, company_number FROM clean),
hits AS (SELECT variant, company_number, count(*) AS hits FROM asked_token JOIN idx USING (token) GROUP BY variant, company_number HAVING count(*) >= CASE WHEN any_value(n) >= 2 THEN 2 ELSE 1 END),
found AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY variant ORDER BY hits DESC, company_number) <= 500)"""
_N = {k: _norm(k) for k in ("org_name", "town", "county", "company_name", "address_locality", "address_region")}
_POOL = f"""named AS (SELECT org_name, {_N['org_name']} AS org_norm, {_N['town']} AS town_norm, {_N['county']} AS county_norm FROM org),
place AS (SELECT company_number, company_name AS title, {_N['company_name']} AS title_norm, company_status AS status, address_locality AS locality, address_region AS region, address_postcode AS postcode,
  {_N['address_locality']} AS locality_norm, {_N['address_region']} AS region_norm FROM clean),
raw AS (SELECT * FROM variants JOIN found USING (variant) JOIN named USING (org_name) JOIN place USING (company_number)),
keyed AS (SELECT org_norm, title_norm, {_key('org_norm')} AS a, {_key('title_norm')} AS b FROM (SELECT DISTINCT org_norm, title_norm FROM raw)),
sims AS (SELECT org_norm, title_norm, {_similarity('a', 'b')} AS name_similarity FROM keyed),
bonus AS (SELECT *, CASE WHEN town_norm <> '' AND (contains(locality_norm, town_norm) OR contains(region_norm, town_norm)) THEN 0.08::DOUBLE ELSE 0.0::DOUBLE END AS locality_bonus,
  CASE WHEN county_norm <> '' AND contains(region_norm, county_norm) THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS region_bonus, CASE WHEN status = 'active' THEN 0.05::DOUBLE ELSE 0.0::DOUBLE END AS status_bonus
  FROM raw JOIN sims USING (org_norm, title_norm)),
total AS (SELECT *, least(1.0::DOUBLE, name_similarity + locality_bonus + region_bonus + status_bonus) AS total FROM bonus),
early AS (SELECT *, min(CASE WHEN total >= 0.85::DOUBLE THEN variant_index END) OVER (PARTITION BY org_name) AS stop FROM total),
top AS (SELECT *, row_number() OVER (PARTITION BY org_name ORDER BY total DESC, variant_index, hits DESC, company_number) AS cand_rank FROM early WHERE stop IS NULL OR variant_index <= stop QUALIFY cand_rank <= 3)"""
_BAND = lambda x: f"CASE WHEN {x} >= 0.85::DOUBLE THEN 'high' WHEN {x} >= 0.72::DOUBLE THEN 'medium' ELSE 'low' END"
_OUT = f"""best AS (SELECT * FROM top WHERE cand_rank = 1),
org_cols AS (SELECT * FROM org),
enriched AS (SELECT o.*, 'matched' AS match_status, {_r4('b.total')} AS match_score, {_BAND('b.total')} AS match_confidence, b.variant AS match_query_used, {_r4('b.name_similarity')} AS score_name_similarity,
  {_r4('b.locality_bonus')} AS score_locality_bonus, {_r4('b.region_bonus')} AS score_region_bonus, {_r4('b.status_bonus')} AS score_status_bonus, b.company_number AS ch_company_number,
  coalesce(nullif(c.company_name, ''), b.title) AS ch_company_name, coalesce(nullif(c.company_status, ''), b.status) AS ch_company_status, c.company_type AS ch_company_type, c.date_of_creation AS ch_date_of_creation,
  c.sic_codes AS ch_sic_codes, coalesce(nullif(c.address_locality, ''), b.locality) AS ch_address_locality, coalesce(nullif(c.address_region, ''), b.region) AS ch_address_region, coalesce(nullif(c.address_postcode, ''), b.postcode) AS ch_address_postcode
  FROM org_cols o JOIN best b USING (org_name) JOIN clean c ON c.company_number = b.company_number WHERE b.total >= 0.72::DOUBLE),
unmatched AS (SELECT o.*, 'unmatched' AS match_status, '' AS match_error, {_r4('b.total')} AS best_candidate_score, coalesce(b.title, '') AS best_candidate_title, coalesce(b.company_number, '') AS best_candidate_company_number
  FROM org_cols o LEFT JOIN best b USING (org_name) WHERE b.total IS NULL OR b.total < 0.72::DOUBLE)"""


def _sic(codes: str, p) -> str:
    best = "greatest(acc, " + ", ".join(f"CASE WHEN starts_with(x, '{k}') THEN {v}::DOUBLE ELSE -9.0::DOUBLE END" for k, v in p.sic_positive.items()) + ")"
    minus = " ".join(f"+ CASE WHEN starts_with(x, '{k}') THEN {v}::DOUBLE ELSE 0.0::DOUBLE END" for k, v in p.sic_negative.items())
    return f"greatest(0.0::DOUBLE, least(0.5::DOUBLE, list_reduce(list_filter(list_transform(string_split(replace({codes}, ',', ';'), ';'), lambda z: trim(z)), lambda z: z <> ''), lambda acc, x: {best} {minus}, 0.1::DOUBLE)))"


def _age(created: str) -> str:
    years = f"(date_diff('day', try_cast(nullif({created}, '') AS DATE), DATE '{AS_OF}') / 365.25::DOUBLE)"
    return f"CASE WHEN try_cast(nullif({created}, '') AS DATE) IS NULL THEN 0.05::DOUBLE " + " ".join(f"WHEN {years} >= {a} THEN {s}::DOUBLE" for a, s in TECH.age_bands) + " ELSE 0.05::DOUBLE END"


def _type(kind: str) -> str:
    return f"CASE lower(trim({kind})) " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in TECH.type_weights.items()) + " ELSE 0.03::DOUBLE END"


def _keywords(name: str, p) -> str:
    hits = lambda k: f"len(list_intersect(regexp_extract_all(lower({name}), '[a-z0-9_]+'), [{', '.join(repr(x) for x in k)}]))"
    return f"(least(0.15::DOUBLE, {hits(p.keyword_positive)} * 0.05::DOUBLE) - least(0.1::DOUBLE, {hits(p.keyword_negative)} * 0.05::DOUBLE))"


def _status(status: str) -> str:
    return f"CASE WHEN lower({status}) = 'active' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END"


_EC = f"ec AS (SELECT DISTINCT * FROM ({views.sql(views.EMPLOYEES)}))"


def _score(p) -> str:
    name = "coalesce(nullif(ch_company_name, ''), org_name)"
    return f"""{_EC},
feature AS (SELECT e.*, coalesce(ec.employee_count, '') AS employee_count, coalesce(ec.employee_count_source, '') AS employee_count_source, coalesce(ec.employee_count_snapshot_date, '') AS employee_count_snapshot_date,
  {_sic('ch_sic_codes', p)} AS sic_tech_score, {_status('ch_company_status')} AS is_active_score, {_age('ch_date_of_creation')} AS company_age_score, {_type('ch_company_type')} AS company_type_score, {_keywords(name, p)} AS name_keyword_score
  FROM enriched e LEFT JOIN ec ON ec.company_number = trim(e.ch_company_number)),
summed AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, sic_tech_score + is_active_score + company_age_score + company_type_score + name_keyword_score)) AS role_fit_score FROM feature),
scored AS (SELECT *, CASE WHEN role_fit_score >= 0.55::DOUBLE THEN 'strong' WHEN role_fit_score >= 0.35::DOUBLE THEN 'possible' ELSE 'unlikely' END AS role_fit_bucket FROM summed)"""


_SLIM = "org_name, ch_company_number, match_score, employee_count, sic_tech_score, is_active_score, company_age_score, company_type_score, name_keyword_score, role_fit_score, role_fit_bucket"
_MATCH = f"WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK}, {_POOL}, {_OUT}"
_TECH, _CARE = f"{_MATCH}, {_score(TECH)}", f"{_MATCH}, {_score(CARE)}"
_FIT = "role_fit_bucket IN ('strong', 'possible')"
_BANDS = "CASE " + " ".join(f"WHEN n <= {top} THEN '{b}'" for top, b in _BAND_TOPS) + " ELSE 'mega' END"
_PART_KIND = "CASE WHEN p_size % 7 = 0 THEN '' ELSE p_type END"

_PLAIN = lambda x: f"replace(replace({x}, '&amp;', '&'), '&quot;', '\"')"
_ANCHORS = rf"""found AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS origin, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*href="[^"]+"[^>]*>.*?</a>')) AS x FROM pages),
anchor AS (SELECT page_id, origin || {_PLAIN('regexp_extract(x, \'href="([^"]+)"\', 1)')} AS href, trim(regexp_replace({_PLAIN("regexp_replace(x, '<[^>]*>', '', 'g')")}, '\s+', ' ', 'g')) AS text FROM found)"""

SQL: dict[str, str] = {
    "q_register_rollup": f"WITH {_REG} SELECT * FROM org",
    "q_register_stats": f"""WITH reg_v AS ({_P['reg_v']}), flag AS (SELECT *, route = 'Skilled Worker' AS s, lower(rating) LIKE '%a rating%' AS a FROM reg_v)
SELECT count(*) AS total_rows, count(*) FILTER (WHERE s) AS skilled_rows, count(*) FILTER (WHERE a) AS a_rated_rows, count(*) FILTER (WHERE s AND a) AS filtered_rows,
  count(DISTINCT name) FILTER (WHERE s AND a) AS unique_names, count(DISTINCT {_norm('name')}) FILTER (WHERE s AND a) AS organisations,
  count(DISTINCT name) FILTER (WHERE s AND a) - count(DISTINCT {_norm('name')}) FILTER (WHERE s AND a) AS merged FROM flag""",
    "q_top_towns": f"WITH reg_v AS ({_P['reg_v']}), elig AS ({_P['elig']}) SELECT town, count(*) AS n_rows, min(pos) AS first_pos FROM elig GROUP BY town ORDER BY n_rows DESC, first_pos LIMIT 10",
    "q_eligible": f"WITH reg_v AS ({_P['reg_v']}) SELECT name, town, county, rating, route, pos FROM reg_v WHERE route = 'Skilled Worker' AND lower(rating) LIKE '%a rating%'",
    "q_merged_stats": f"""WITH reg_v AS ({_P['reg_v']}), flag AS (SELECT *, route = 'Skilled Worker' AS s, lower(rating) LIKE '%a rating%' AS a FROM reg_v)
SELECT count(*) AS total_rows, count(*) FILTER (WHERE s) AS skilled_rows, count(*) FILTER (WHERE a) AS a_rated_rows, count(*) FILTER (WHERE s AND a) AS filtered_rows,
  count(DISTINCT name) FILTER (WHERE s AND a) AS unique_names, count(DISTINCT {_norm('name')}) FILTER (WHERE s AND a) AS organisations,
  count(DISTINCT name) FILTER (WHERE s AND a) - count(DISTINCT {_norm('name')}) FILTER (WHERE s AND a) AS merged FROM flag""",
    "q_merged_top_towns": f"WITH reg_v AS ({_P['reg_v']}), elig AS ({_P['elig']}) SELECT town, count(*) AS n_rows, min([pos % 3, pos])[1] AS first_snapshot, min([pos % 3, pos])[2] AS first_pos FROM elig GROUP BY town ORDER BY n_rows DESC, first_snapshot, first_pos LIMIT 10",
    "q_normalise": f"WITH reg_v AS ({_P['reg_v']}), n AS (SELECT pos, name, {_norm('name')} AS norm FROM reg_v) SELECT pos, name, norm, {_key('norm')} AS sort_key FROM n",
    "q_normalise_documents": f"WITH n AS (SELECT doc_id, {_norm_any('text')} AS norm FROM documents) SELECT doc_id, length(norm) AS n_norm, md5(norm) AS norm_md5 FROM n",
    "q_variants": f"WITH reg_v AS ({_P['reg_v']}), org AS (SELECT DISTINCT name AS org_name FROM reg_v), {_VAR} SELECT org_name, variant_index, variant FROM variants",
    "q_registry_clean": f"WITH {_CLEAN} SELECT * FROM clean",
    "q_token_index": f"WITH {_CLEAN}, idx AS (SELECT DISTINCT unnest({_tokens(_norm('company_name'))}) AS token, company_number FROM clean) SELECT {_bucket('token')} AS bucket, token, company_number FROM idx",
    "q_restricted_index": f"WITH reg_v AS ({_P['reg_v']}), {_CLEAN}, idx AS (SELECT DISTINCT unnest({_tokens(_norm('company_name'))}) AS token, company_number FROM clean), wanted AS (SELECT DISTINCT unnest({_tokens(_norm('name'))}) AS token FROM reg_v) SELECT {_bucket('token')} AS bucket, token, company_number FROM idx WHERE token IN (SELECT token FROM wanted)",
    "q_uri_check": f"WITH {_CLEAN} SELECT CAST(company_number AS BIGINT) % 17 <> 0 AS fits, count(*) AS n_rows FROM clean GROUP BY fits",
    "q_similarity": f"""WITH {_REG}, {_CLEAN}, a AS (SELECT DISTINCT org_norm FROM org), b AS (SELECT DISTINCT {_norm('company_name')} AS title_norm FROM clean),
pair AS (SELECT org_norm, title_norm, {_key('org_norm')} AS a, {_key('title_norm')} AS b FROM (SELECT DISTINCT org_norm, title_norm FROM (SELECT org_norm, unnest(string_split(org_norm, ' ')) AS w FROM a) JOIN (SELECT title_norm, unnest(string_split(title_norm, ' ')) AS w FROM b) USING (w)))
SELECT org_norm, title_norm, {_similarity('a', 'b')} AS name_similarity FROM pair""",
    "q_block_candidates": f"WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK} SELECT * FROM found",
    "q_match_top3": f"WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK}, {_POOL} SELECT org_name, cand_rank, company_number, variant, hits, total, name_similarity, locality_bonus, region_bonus, status_bonus, {_BAND('total')} AS confidence FROM top",
    "q_candidate_rows": f"WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK}, {_POOL} SELECT org_name, cand_rank, company_number AS candidate_company_number, title AS candidate_title, status AS candidate_status, locality AS candidate_locality, region AS candidate_region, postcode AS candidate_postcode, {_r4('total')} AS candidate_score, {_r4('name_similarity')} AS score_name_similarity, {_r4('locality_bonus')} AS score_locality_bonus, {_r4('region_bonus')} AS score_region_bonus, {_r4('status_bonus')} AS score_status_bonus, variant AS query_used FROM top",
    "q_enriched": f"{_MATCH} SELECT * FROM enriched",
    "q_unmatched": f"{_MATCH} SELECT * FROM unmatched",
    **{q: "SELECT doc_id, coalesce(lang, '') AS lang, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS text_md5 FROM documents" for q in ("q_quoted_breaks", "q_archive")},
    "q_employees_as_of": f"""WITH {_CLEAN}, first AS (SELECT DISTINCT * FROM ({views.sql(views.EMPLOYEES)})),
hist AS (SELECT company_number, employee_count, employee_count_source, employee_count_snapshot_date, DATE '2026-02-06' AS d FROM first
  UNION ALL SELECT company_number, CAST(CAST(employee_count AS INT) + 1 AS VARCHAR), employee_count_source, '2026-05-01', DATE '2026-05-01' FROM first WHERE CAST(company_number AS BIGINT) % 3 <> 0),
r AS (SELECT company_number AS ch_company_number, CAST(['2026-02-05', '2026-02-06', '2026-04-30', '2026-05-02'][1 + CAST(company_number AS BIGINT) % 4] AS DATE) AS day FROM clean)
SELECT r.ch_company_number, strftime(r.day, '%Y-%m-%d') AS day, coalesce(h.employee_count, '') AS employee_count, coalesce(h.employee_count_source, '') AS employee_count_source, coalesce(h.employee_count_snapshot_date, '') AS employee_count_snapshot_date
FROM r ASOF LEFT JOIN hist h ON r.ch_company_number = h.company_number AND r.day >= h.d""",
    "q_asof_join": """WITH u AS (SELECT o_custkey, o_orderdate, max(o_totalprice) AS urgent_price FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL)
SELECT o.o_orderkey, o.o_custkey, u.urgent_price FROM orders o ASOF LEFT JOIN u ON o.o_custkey = u.o_custkey AND o.o_orderdate >= u.o_orderdate""",
    "q_match_runs": f"{_MATCH} SELECT org_name, match_status, match_score AS score, ch_company_number AS number FROM enriched UNION ALL SELECT org_name, match_status, best_candidate_score, best_candidate_company_number FROM unmatched",
    "q_profile_errors": f"{_MATCH} SELECT o.*, 'profile_error' AS match_status, 'no profile of ' || b.company_number AS match_error, {_r4('b.total')} AS best_candidate_score, b.title AS best_candidate_title, b.company_number AS best_candidate_company_number FROM org o JOIN best b USING (org_name) JOIN clean c ON c.company_number = b.company_number WHERE b.total >= 0.72::DOUBLE AND c.company_status <> 'active'",
    "q_sic_score": f"WITH {_CLEAN} SELECT company_number, sic_codes, {_sic('sic_codes', TECH)} AS tech_score, {_sic('sic_codes', CARE)} AS care_score FROM clean",
    "q_sic_relation": f"WITH {_CLEAN} SELECT company_number, sic_codes, {_sic('sic_codes', TECH)} AS tech_score, {_sic('sic_codes', CARE)} AS care_score FROM clean",
    "q_prefix_scores": """WITH cat AS (SELECT CAST(c_custkey AS VARCHAR) AS prefix, CASE WHEN c_custkey % 3 <> 0 THEN (c_custkey % 29) / 64.0::DOUBLE END AS plus, CASE WHEN c_custkey % 3 = 0 THEN -(c_custkey % 7) / 64.0::DOUBLE END AS minus FROM customer),
code AS (SELECT p_partkey, unnest([CAST(p_partkey AS VARCHAR), CAST(p_partkey * 7 AS VARCHAR), CAST(p_size AS VARCHAR)]) AS code, unnest([1, 2, 3]) AS nth FROM part),
head AS (SELECT p_partkey, nth, code, unnest(list_transform(range(1, 1 + length(code)), lambda k: code[1:k])) AS prefix FROM code),
hit AS (SELECT p_partkey, nth, coalesce(max(plus), -9) AS plus, coalesce(sum(minus), 0) AS minus FROM head LEFT JOIN cat USING (prefix) GROUP BY ALL),
wide AS (SELECT p_partkey, max(plus) FILTER (nth = 1) AS p1, max(minus) FILTER (nth = 1) AS m1, max(plus) FILTER (nth = 2) AS p2, max(minus) FILTER (nth = 2) AS m2, max(plus) FILTER (nth = 3) AS p3, max(minus) FILTER (nth = 3) AS m3 FROM hit GROUP BY p_partkey)
SELECT p_partkey, round(greatest(0.0::DOUBLE, least(0.5::DOUBLE, greatest(greatest(greatest(0.1::DOUBLE, p1) + m1, p2) + m2, p3) + m3)), 6) AS score FROM wide""",
    "q_located": f"""WITH {_CLEAN}, term AS (SELECT r_name AS place, 'region' AS kind, lower(r_name) AS term FROM region UNION ALL SELECT n_name, 'locality', lower(n_name) FROM nation UNION ALL SELECT n_name, 'postcode', 'EC' || n_nationkey FROM nation),
fits AS (SELECT DISTINCT place, company_number FROM clean JOIN term ON (kind <> 'postcode' AND contains(lower(address_locality), term)) OR (kind = 'region' AND contains(lower(address_region), term)) OR (kind = 'postcode' AND starts_with(upper(address_postcode), term)))
SELECT place, count(*) AS n_rows, count(*) AS n_companies FROM fits GROUP BY place""",
    "q_alias_file": f"""WITH {_CLEAN}, term AS (SELECT r_name AS place, 'region' AS kind, lower(r_name) AS term FROM region UNION ALL SELECT n_name, 'locality', lower(n_name) FROM nation UNION ALL SELECT n_name, 'postcode', 'EC' || n_nationkey FROM nation),
fits AS (SELECT DISTINCT place, company_number FROM clean JOIN term ON (kind <> 'postcode' AND contains(lower(address_locality), term)) OR (kind = 'region' AND contains(lower(address_region), term)) OR (kind = 'postcode' AND starts_with(upper(address_postcode), term)))
SELECT place, count(*) AS n_rows, count(*) AS n_companies FROM fits GROUP BY place""",
    "q_age_score": f"WITH {_CLEAN} SELECT company_number, date_of_creation, {_age('date_of_creation')} AS age_score FROM clean",
    "q_type_status_score": f"WITH {_CLEAN} SELECT company_number, {_type('company_type')} AS type_score, {_status('company_status')} AS status_score FROM clean",
    "q_keyword_score": f"WITH {_CLEAN} SELECT company_number, {_keywords('company_name', TECH)} AS tech_score, {_keywords('company_name', CARE)} AS care_score FROM clean",
    "q_catalogue_file": f"WITH {_CLEAN} SELECT company_number, {_sic('sic_codes', CARE)} AS care_score, {_keywords('company_name', CARE)} AS word_score, {_type('company_type')} AS type_score, {_status('company_status')} AS status_score FROM clean",
    "q_scored": f"{_TECH} SELECT {_SLIM} FROM scored",
    "q_scored_care": f"{_CARE} SELECT {_SLIM} FROM scored",
    "q_employee_files": f"WITH {_CLEAN}, {_EC} SELECT clean.company_number AS ch_company_number, coalesce(employee_count, '') AS employee_count, coalesce(employee_count_source, '') AS employee_count_source, coalesce(employee_count_snapshot_date, '') AS employee_count_snapshot_date FROM clean LEFT JOIN ec USING (company_number)",
    "q_employee_join": f"WITH {_CLEAN}, {_EC} SELECT clean.company_number AS ch_company_number, coalesce(employee_count, '') AS employee_count, coalesce(employee_count_source, '') AS employee_count_source, coalesce(employee_count_snapshot_date, '') AS employee_count_snapshot_date FROM clean LEFT JOIN ec USING (company_number)",
    "q_employee_conflicts": "SELECT CAST(c_nationkey AS VARCHAR) AS company_number, count(DISTINCT c_mktsegment) AS n_versions FROM customer GROUP BY 1 HAVING count(DISTINCT c_mktsegment) > 1",
    "q_size_bands": f"WITH e AS (SELECT CAST(employee_count AS INT) AS n FROM ({views.sql(views.EMPLOYEES)})) SELECT {_BANDS} AS band, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS employees FROM e GROUP BY band",
    "q_shortlist": f"{_TECH} SELECT org_name, ch_company_number, ch_company_name, ch_sic_codes, employee_count, employee_count_source, employee_count_snapshot_date, sic_tech_score, is_active_score, company_age_score, company_type_score, name_keyword_score, role_fit_score, role_fit_bucket FROM scored WHERE role_fit_score >= 0.55::DOUBLE AND {_FIT}",
    "q_shortlist_size": f"{_TECH} SELECT {_SLIM} FROM scored WHERE role_fit_score >= 0.35::DOUBLE AND {_FIT} AND try_cast(nullif(employee_count, '') AS BIGINT) >= 1000",
    "q_shortlist_size_unknown": f"{_TECH} SELECT {_SLIM} FROM scored WHERE role_fit_score >= 0.35::DOUBLE AND {_FIT} AND (employee_count = '' OR try_cast(nullif(employee_count, '') AS BIGINT) >= 1000)",
    "q_shortlist_geo": f"{_TECH} SELECT {_SLIM} FROM scored WHERE role_fit_score >= 0.35::DOUBLE AND {_FIT} AND (contains(lower(ch_address_region), 'northern') OR contains(lower(ch_address_locality), 'northern') OR contains(lower(ch_address_region), 'asia') OR contains(lower(ch_address_locality), 'asia') OR contains(lower(ch_address_locality), 'nation_3') OR contains(lower(ch_address_locality), 'nation_17') OR starts_with(upper(ch_address_postcode), 'EC12') OR starts_with(upper(ch_address_postcode), 'EC7'))",
    "q_search": f"{_TECH} SELECT {_SLIM} FROM scored WHERE (contains(lower(ch_company_name), 'software') OR contains(lower(org_name), 'software')) AND len(list_filter(string_split(ch_sic_codes, ';'), lambda x: starts_with(x, '62'))) > 0 AND (contains(lower(ch_address_region), 'nation_1') OR contains(lower(ch_address_locality), 'nation_1'))",
    "q_audit": f"""{_MATCH}, e AS (SELECT count(*) AS enriched_rows, count(*) FILTER (WHERE ch_company_number = '') AS missing_ch_company_number, count(*) FILTER (WHERE ch_company_name = '') AS missing_ch_company_name,
  count(*) FILTER (WHERE match_score IS NULL) AS missing_match_score, count(*) FILTER (WHERE score_name_similarity IS NULL) AS missing_score_name_similarity, count(*) FILTER (WHERE score_name_similarity < 0.6::DOUBLE) AS low_similarity_matches,
  count(*) FILTER (WHERE ch_company_status <> 'active') AS non_active_matches, count(*) - count(DISTINCT org_name) AS duplicate_org_enriched FROM enriched),
u AS (SELECT count(*) AS unmatched_rows, count(*) FILTER (WHERE best_candidate_score >= 0.7::DOUBLE) AS near_threshold_unmatched, count(*) - count(DISTINCT org_name) AS duplicate_org_unmatched FROM unmatched),
o AS (SELECT count(*) AS overlap_org_between_sets FROM (SELECT org_name FROM enriched INTERSECT SELECT org_name FROM unmatched)),
n AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS non_unique_company_number_rows FROM (SELECT count(*) AS c FROM enriched WHERE ch_company_number <> '' GROUP BY ch_company_number HAVING count(*) > 1))
SELECT *, enriched_rows + unmatched_rows AS total_rows FROM e, u, o, n""",
    "q_audit_findings": f"""{_MATCH}, twice AS (SELECT * FROM enriched UNION ALL SELECT * FROM enriched WHERE length(org_name) % 7 = 0), v AS (
SELECT 'structure' AS kind, 'duplicate_org_enriched' AS name, count(*) - count(DISTINCT org_name) AS value, 0 AS most FROM twice
UNION ALL SELECT 'structure', 'duplicate_org_unmatched', count(*) - count(DISTINCT org_name), 0 FROM unmatched
UNION ALL SELECT 'structure', 'overlap_org_between_sets', count(*), 0 FROM (SELECT org_name FROM twice INTERSECT SELECT org_name FROM unmatched)
UNION ALL SELECT 'structure', 'missing_ch_company_number', count(*) FILTER (WHERE ch_company_number = ''), 0 FROM twice
UNION ALL SELECT 'structure', 'missing_ch_company_name', count(*) FILTER (WHERE ch_company_name = ''), 0 FROM twice
UNION ALL SELECT 'structure', 'missing_match_score', count(*) FILTER (WHERE match_score IS NULL), 0 FROM twice
UNION ALL SELECT 'structure', 'missing_score_name_similarity', count(*) FILTER (WHERE score_name_similarity IS NULL), 0 FROM twice
UNION ALL SELECT 'threshold', 'low_similarity_matches', count(*) FILTER (WHERE score_name_similarity < 0.6::DOUBLE), 1 FROM twice
UNION ALL SELECT 'threshold', 'near_threshold_unmatched', count(*) FILTER (WHERE best_candidate_score >= 0.7::DOUBLE), 2 FROM unmatched
UNION ALL SELECT 'threshold', 'non_active_matches', count(*) FILTER (WHERE ch_company_status <> 'active'), 3 FROM twice
UNION ALL SELECT 'threshold', 'non_unique_company_number_rows', coalesce(sum(c), 0), 4 FROM (SELECT count(*) AS c FROM twice WHERE ch_company_number <> '' GROUP BY ch_company_number HAVING count(*) > 1))
SELECT kind, name, CAST(value AS BIGINT) AS value, CAST(most AS BIGINT) AS most, value > most AS failed FROM v""",
    "q_bad_scores": """WITH m AS (SELECT CASE c_custkey % 3 WHEN 0 THEN CAST(c_acctbal AS VARCHAR) WHEN 1 THEN c_mktsegment ELSE '' END AS v FROM customer)
SELECT CASE WHEN v = '' THEN '<empty>' ELSE v END AS value, count(*) AS n_rows FROM m WHERE try_cast(v AS DOUBLE) IS NULL GROUP BY 1""",
    "q_newest_file": "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey >= 10",
    "q_determinism": f"WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK}, {_POOL} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differences FROM top",
    "q_differences": f"""WITH {_REG}, {_CLEAN}, {_VAR}, {_BLOCK}, {_POOL}, a AS (SELECT org_name, company_number, total FROM top), b AS (SELECT * FROM a WHERE company_number NOT LIKE '%3')
(SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
    "q_repeated_numbers": f"""WITH {_REG}, {_CLEAN}, twice AS (SELECT * REPLACE (CASE WHEN CAST(company_number AS BIGINT) % 7 = 0 THEN lpad(CAST(CAST(company_number AS BIGINT) - 1 AS VARCHAR), 8, '0') ELSE company_number END AS company_number), CAST(company_number AS BIGINT) AS pos FROM clean),
once AS (SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY company_number ORDER BY pos) = 1), {_VAR}, {_BLOCK.replace("FROM clean", "FROM twice")}, {_POOL.replace("FROM clean", "FROM once")}
SELECT org_name, cand_rank, company_number, title, hits, total FROM top""",
    "q_disjoint": f"{_MATCH} SELECT org_name FROM enriched INTERSECT (SELECT org_name FROM unmatched UNION SELECT org_name FROM enriched WHERE length(org_name) % 7 = 0)",
    "q_resume_pending": f"WITH {_REG} SELECT * FROM org WHERE NOT has_multiple_towns AND length(org_name) % 5 <> 0",
    "q_resume_counters": f"WITH {_REG}, n AS (SELECT count(*) AS total_rows, count(*) FILTER (WHERE has_multiple_towns) AS processed, count(*) FILTER (WHERE NOT has_multiple_towns) AS unprocessed FROM org) SELECT *, CAST(ceil(unprocessed / 25.0) AS BIGINT) AS batches, greatest(0, total_rows - processed) AS remaining FROM n",
    "q_batches": f"WITH {_REG}, n AS (SELECT org_name, (row_number() OVER (ORDER BY org_name) - 1) // 25 + 1 AS batch FROM org) SELECT * FROM n WHERE batch >= 2 AND batch < 7",
    "q_keep_first": f"WITH reg_v AS ({_P['reg_v']}) SELECT {_norm('name')} AS norm, pos, name FROM reg_v QUALIFY row_number() OVER (PARTITION BY norm ORDER BY pos) = 1",
    "q_cache_key": f"WITH reg_v AS ({_P['reg_v']}) SELECT pos, 'search:' || substr(sha256(lower(trim(name))), 1, 16) AS cache_key FROM reg_v",
    "q_round": "SELECT l_orderkey, l_linenumber, CAST(printf('%.4f', l_discount * l_tax + l_quantity / 7.0::DOUBLE) AS DOUBLE) AS rounded, CAST(printf('%.4f', l_orderkey % 64 / 32768.0::DOUBLE) AS DOUBLE) AS tied FROM lineitem",
    "q_snapshot_date": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '2026-01-0' || CAST(1 + o_orderkey % 9 AS VARCHAR) ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders",
    "q_profile_payloads": f"""WITH {_CLEAN} SELECT company_number, CASE WHEN CAST(company_number AS BIGINT) % 5 = 0 THEN '' ELSE company_name END AS company_name, company_type, array_to_string(list_filter(string_split(sic_codes, ';'), lambda x: x <> ''), '|') AS codes,
  CASE WHEN CAST(company_number AS BIGINT) % 4 = 0 THEN '' ELSE address_locality END AS locality, '' AS region FROM clean""",
    "q_search_payloads": f"WITH {_CLEAN}, n AS (SELECT address_locality AS place, company_number, company_name AS title, company_status, row_number() OVER (PARTITION BY address_locality ORDER BY company_number) - 1 AS nth FROM clean) SELECT place, nth, title, company_number, company_status FROM n",
    "q_snapshot_clean": f"WITH {_CLEAN} SELECT * FROM clean",
    "q_snapshot_counts": f"WITH {_CLEAN}, idx AS (SELECT DISTINCT unnest({_tokens(_norm('company_name'))}) AS token, company_number FROM clean) SELECT (SELECT count(*) FROM clean) AS n_raw, (SELECT count(*) FROM clean) AS n_clean, (SELECT count(*) FROM idx) AS n_index, (SELECT count(*) FROM clean) AS n_profiles, CAST(0 AS BIGINT) AS n_wrong",
    "q_pipeline_files": f"{_TECH} SELECT org_name, ch_company_number, role_fit_bucket FROM scored WHERE role_fit_score >= 0.55::DOUBLE AND {_FIT}",
    "q_latest_snapshot": "SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) = 1",
    "q_text_table": f"SELECT p_brand AS brand, {_PART_KIND} AS kind, '' AS remark, count(*) AS n_rows FROM part GROUP BY 1, 2, 3",
    "q_stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "q_stream_first": "SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at, event_type, value FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
    "q_stream_sessions": """WITH e AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOURS THEN 0 ELSE 1 END AS begins FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
s AS (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_time, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_time, count(*) AS n FROM s GROUP BY user_id, session""",
    "q_stored_differences": """WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders),
b AS (SELECT * REPLACE (CASE WHEN o_orderkey % 503 = 0 THEN o_totalprice + 1.0::DOUBLE ELSE o_totalprice END AS o_totalprice) FROM o WHERE o_orderkey % 701 <> 0 UNION ALL SELECT * FROM o WHERE o_orderkey % 601 = 0),
u AS (SELECT *, 1 AS x, 0 AS y FROM o UNION ALL SELECT *, 0, 1 FROM b)
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(sum(x) AS BIGINT) AS n_first, CAST(sum(y) AS BIGINT) AS n_second FROM u GROUP BY ALL HAVING sum(x) <> sum(y)""",
    "q_archive_links": """WITH l AS (SELECT o_custkey AS key, o_orderkey % 4 AS k, '20' || strftime(o_orderdate, '%y-%m') || '-01' AS day FROM orders),
d AS (SELECT key, day, count(*) AS c FROM l WHERE k = 0 GROUP BY key, day QUALIFY row_number() OVER (PARTITION BY key ORDER BY day DESC) = 1),
m AS (SELECT key, count(*) FILTER (k = 1) AS c FROM l GROUP BY key), n AS (SELECT m.key, d.day, coalesce(d.c, m.c) AS c FROM m LEFT JOIN d ON d.key = m.key)
SELECT key, CASE WHEN c <> 1 THEN NULL WHEN day IS NULL THEN 'https://example.org/basiccompanydataasonefile.zip' ELSE 'https://example.org/BasicCompanyDataAsOneFile-' || day || '.zip' END AS href,
  CASE WHEN c = 1 THEN 'found' WHEN c > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM n""",
    "q_links": f"WITH {_ANCHORS} SELECT page_id AS key, count(*) AS n_links, min(text) AS first_text, max(text) AS last_text FROM anchor GROUP BY page_id",
    "q_best_link": f"""WITH {_ANCHORS}, said AS (SELECT page_id, lower(href || ' ' || text) AS x FROM anchor WHERE regexp_matches(href, '(?i)/[a-z]')),
scored AS (SELECT page_id, CASE WHEN contains(x, 'the') THEN 2 ELSE 0 END + CASE WHEN contains(x, 'on') THEN 1 ELSE 0 END + CASE WHEN contains(x, 'en') THEN 1 ELSE 0 END AS score FROM said),
top AS (SELECT page_id, score, count(*) AS n_tied, max(score) OVER (PARTITION BY page_id) AS best FROM scored GROUP BY page_id, score) SELECT page_id, CAST(score AS BIGINT) AS score, n_tied FROM top WHERE score = best""",
}
