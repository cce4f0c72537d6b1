"""Matching organisations with companies: token blocking, similarity, ranking, acceptance.

Blocking runs over distinct sets of words, not over companies, and never joins on a query's most
frequent word: a company that has two of its words has one of the others. Each pair is made by the
first other word that both have, so no pair is made twice and nothing is grouped after the join;
hits are counted on the pair itself. Companies are joined in only after the minimum of hits.

A set's numbers lie in blocks that double. Before any number is listed, the blocks of a variant are counted in
order, and none is read that begins behind the place where enough numbers are complete: at most about twice
as many numbers are listed as are kept, however many companies share a set or sets share words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import names, values
from tessera.operators import registry
from tessera.operators.dealing import dealt, thinly

MAX_CANDIDATES = 500
TOP = 3
EARLY_STOP = 0.85
MIN_SCORE = 0.72
HIGH, MEDIUM = 0.85, 0.72
LOCALITY, REGION, ACTIVE = 0.08, 0.05, 0.05


def _asked(orgs: DataFrame, *keep: str) -> DataFrame:
    paired = orgs.select("org_name", *keep, names.variant_pairs(F.col("org_name")).alias("pairs"))
    found = paired.select("org_name", *keep, names.distinct_variants(F.col("pairs")).alias("found"))
    return found.select("org_name", *keep, F.posexplode(names.clean_variants(F.col("found"), F.col("org_name"))).alias("variant_index", "variant"))


def query_variants(orgs: DataFrame) -> DataFrame:
    """(org_name, variant_index, variant) of register rows (org_name)."""
    return _asked(orgs)


@dataclass(frozen=True)
class Index:
    """What matching reads of a registry. postings: slot (a word, and which of its parts), words (a distinct set of
    words as text), title_tokens (the set), least (its least company number); frequency: token, n (sets that have it),
    parts; numbers: words, block (see _block), first, last, n, listed (company_number, same: the least number of the set whose company scores
as this one does); companies: registry.companies(), best with registry.described(). most: numbers of a set beyond so many are left out. faces: same, and what scores need of such companies,
each once; else companies are asked."""

    postings: DataFrame
    frequency: DataFrame
    numbers: DataFrame
    companies: DataFrame
    most: int | None = None
    faces: DataFrame | None = None


#: What decides a company's scores beside its set of words.
FACE = ("title_norm", "address_locality", "address_region", "company_status")
#: Blocks of a set's numbers double up to so many.
BLOCK = 1 << 12
#: Up to so many words are looked up by value, which prunes the index's buckets.
LOOKED_UP = 2000
#: A word that more sets have is dealt to several slots of a stored index.
PER_PART = 1 << 16


def _slot(token: Column, part: Column) -> Column:
    return F.concat_ws("/", token, part.cast("string"))


def _block(nth: Column) -> Column:
    """The block of a set's nth number from 1: 1, 2, 3-4, 5-8 and so on up to BLOCK, then BLOCK each."""
    doubling = F.when(nth == 1, 0).otherwise(F.length(F.bin((nth - 1).cast("long"))))
    return F.when(nth <= BLOCK, doubling).otherwise(BLOCK.bit_length() - 2 + F.ceil(nth / BLOCK)).cast("int")


def _last_block(n: int) -> int:
    """_block() of one place."""
    return (n - 1).bit_length() if n <= BLOCK else BLOCK.bit_length() - 2 - (-n // BLOCK)


def index(companies: DataFrame, per_part: int | None = None, most: int | None = None, keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> Index:
    """The index of registry.companies(), derived as it is read. per_part: the most sets of a slot, for tables in
    which a slot's rows lie together; without it a word is one slot, which joins can split as they run. most: how many
    numbers of a set can be asked for. keep: what to do with sets and numbers, which are read several times."""
    face = [c for c in FACE if c in companies.columns]  # blocking alone wants none
    worded = companies.select(F.array_join("title_tokens", " ").alias("words"), "company_number", *face).filter("words <> ''")
    # companies that score alike are grouped once: sets and their least numbers come from these
    alike = keep(_faces(worded.groupBy("words", *face).agg(F.min("company_number").alias("company_number")), "words"), "faces") if len(face) == len(FACE) else None
    least = worded.groupBy("words").agg(F.min("company_number").alias("least")) if alike is None else alike.groupBy("words").agg(F.min("same").alias("least"))
    sets = keep(least, "sets").withColumn("title_tokens", F.split("words", " "))
    postings = sets.withColumn("token", F.explode("title_tokens"))
    parts = F.lit(1) if per_part is None else F.ceil(F.count(F.lit(1)) / per_part)
    frequency = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n"), parts.cast("int").alias("parts"))
    placed = postings.withColumn("part", F.lit(0)) if per_part is None else postings.join(frequency, "token").withColumn("part", F.pmod(F.xxhash64("words"), F.col("parts")))
    nth = F.row_number().over(Window.partitionBy("words").orderBy("company_number"))
    # all numbers of a set are dealt evenly; where few are kept, tasks leave out the others before they are sent
    first = (dealt(worded, "words") if most is None else worded).withColumn("nth", nth)
    first = (first if most is None else first.filter(F.col("nth") <= most)).withColumn("same", F.min("company_number").over(Window.partitionBy("words", *face)))
    listed = F.array_sort(F.collect_list(F.struct("company_number", "same"))).alias("listed")
    faces = alike.drop("words") if alike is not None else None
    numbers = first.groupBy("words", _block(F.col("nth")).alias("block")).agg(F.min("company_number").alias("first"), F.max("company_number").alias("last"), F.count(F.lit(1)).alias("n"), listed)
    return Index(placed.select(_slot(F.col("token"), F.col("part")).alias("slot"), "words", "title_tokens", "least"), frequency, keep(numbers, "numbers"), companies, most, faces)


def _faces(companies: DataFrame, *keep: str) -> DataFrame:
    return registry.described(companies).select(*keep, F.col("company_number").alias("same"), F.col("company_status").alias("face_status"), "locality_norm", "region_norm", "title_words", "title_letters")


def restricted(known: Index, variants: DataFrame, most: int = LOOKED_UP) -> Index:
    """A stored index cut down to the words of a few variants: only these words' buckets are read."""
    asked = variants.select(F.explode(names.tokens(F.col("variant"))).alias("token")).distinct()
    words = [r[0] for r in asked.limit(most + 1).collect()]
    if len(words) > most:
        return known
    found = known.frequency.filter(F.col("token").isin(words))
    parts = found.select("token", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    slots = [r[0] for r in parts.select(_slot(F.col("token"), F.col("part"))).limit(most + 1).collect()]
    return replace(known, frequency=found, postings=known.postings.filter(F.col("slot").isin(slots)) if len(slots) <= most else known.postings)


def candidates(variants: DataFrame, companies: DataFrame | Index, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """(variant, company_number, hits): companies that share enough tokens with a variant, at most
    max_candidates by (hits desc, number). Two hits are needed where a variant has two tokens.
    companies: those of registry.companies(), or an index of them.

    Before any company is looked up, a variant keeps so many sets by (hits desc, least number): each set before another
    has a number that goes before all of the other's, so no more can come in. Then it keeps the blocks of these that
    begin before the first max_candidates numbers are complete."""
    return _found(variants, companies if isinstance(companies, Index) else index(companies, most=max_candidates), max_candidates).drop("same")


def _found(variants: DataFrame, known: Index, max_candidates: int) -> DataFrame:
    """candidates() with `same`."""
    if known.most is not None and known.most < max_candidates:
        raise ValueError(f"the index holds {known.most} numbers of a set, {max_candidates} are asked for")
    asked = variants.select("variant").distinct().withColumn("asked", names.tokens(F.col("variant")))
    met_words = asked.select("variant", "asked", F.explode("asked").alias("token")).join(known.frequency, "token")
    usual = met_words.groupBy("variant", "asked").agg(F.max(F.struct("n", "token"))["token"].alias("usual"), F.collect_list(F.struct("token", "parts")).alias("had"))  # a name's words
    # a word that no company has can be probed for nothing, so the usual one is the most frequent of those that some have
    several = F.size("asked") >= 2
    probes = usual.select("variant", "asked", F.when(several, F.array_remove("asked", F.col("usual"))).otherwise(F.col("asked")).alias("probes"), "had")
    probes = probes.select("variant", "asked", "probes", F.explode(F.filter("had", lambda x: F.array_contains("probes", x["token"]))).alias("x"))
    probes = probes.select("variant", "asked", "probes", F.col("x.token").alias("token"), F.explode(F.sequence(F.lit(0), F.col("x.parts") - 1)).alias("part"))
    probes = thinly(probes.withColumn("slot", _slot(F.col("token"), F.col("part"))).drop("part"))
    common = F.size(F.array_intersect("asked", "title_tokens"))
    once = F.array_intersect("probes", "title_tokens")[0] == F.col("token")
    met = probes.join(known.postings, "slot").filter(once & (common >= F.when(several, 2).otherwise(1))).select("variant", "words", "least", common.cast("long").alias("hits"))
    met = thinly(met, "variant")
    nth_set = F.row_number().over(Window.partitionBy("variant").orderBy(F.desc("hits"), "least"))
    met = met.withColumn("nth_set", nth_set).filter(F.col("nth_set") <= max_candidates).drop("nth_set", "least")
    blocks = known.numbers.filter(F.col("block") <= _last_block(max_candidates))
    counted = met.join(blocks.drop("listed"), "words").withColumn("place", -F.col("hits"))
    before = F.sum("n").over(Window.partitionBy("variant").orderBy("place", "last").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.withColumn("needed", F.coalesce(before, F.lit(0)) < max_candidates)
    end = F.max(F.when(F.col("needed"), F.struct("place", F.col("last").alias("number")))).over(Window.partitionBy("variant"))
    read = counted.withColumn("end", end).filter(F.struct("place", F.col("first").alias("number")) <= F.col("end"))
    read = read.groupBy("variant", "words", "hits").agg(F.max("block").alias("reach"))  # a set's first blocks
    found = thinly(read, "words").join(blocks.select("words", "block", "listed"), "words").filter(F.col("block") <= F.col("reach"))
    found = thinly(found.select("variant", "hits", F.inline("listed")), "variant")
    nth = F.row_number().over(Window.partitionBy("variant").orderBy(F.desc("hits"), "company_number"))
    return found.withColumn("nth", nth).filter(F.col("nth") <= max_candidates).select("variant", "company_number", "hits", "same")


def name_similarities(pairs: DataFrame) -> DataFrame:
    """(org_norm, title_norm, name_similarity), each distinct pair once."""
    return names.similarities(pairs.select("org_norm", "title_norm").distinct(), "org_norm", "title_norm", "name_similarity")


def bonuses(town_norm: Column, county_norm: Column, locality_norm: Column, region_norm: Column, status: Column) -> dict[str, Column]:
    near = (town_norm != "") & (F.contains(locality_norm, town_norm) | F.contains(region_norm, town_norm))
    same = (county_norm != "") & F.contains(region_norm, county_norm)
    return {
        "locality_bonus": F.when(near, F.lit(LOCALITY)).otherwise(F.lit(0.0)),
        "region_bonus": F.when(same, F.lit(REGION)).otherwise(F.lit(0.0)),
        "status_bonus": F.when(F.lower(status) == "active", F.lit(ACTIVE)).otherwise(F.lit(0.0)),
    }


def confidence(total: Column) -> Column:
    return F.when(total >= HIGH, "high").when(total >= MEDIUM, "medium").otherwise("low")


def _pool(orgs: DataFrame, clean_registry: DataFrame | Index, max_candidates: int, top: int | None = None) -> tuple[DataFrame, Index]:
    """Every searched candidate of every variant with its scores, and the index; with `top`, ranked() of them. Names and
    places are taken apart before any join, those of companies that score alike once."""
    known = clean_registry if isinstance(clean_registry, Index) else index(registry.companies(clean_registry), most=max_candidates)
    described = orgs.select("org_name", names.normalise(F.col("org_name")).alias("org_norm"), names.normalise(F.col("town")).alias("town_norm"), names.normalise(F.col("county")).alias("county_norm"))
    described = names.with_similarity_keys(described, "org_norm", "org_words", "org_letters")
    asked = _asked(described, *described.columns[1:])
    found = _found(query_variants(orgs), known, max_candidates)
    if top is not None:
        alike = F.row_number().over(Window.partitionBy("variant", "same").orderBy("company_number"))
        found = found.withColumn("alike", alike).filter(F.col("alike") <= top)
    faces = known.faces if known.faces is not None else _faces(known.companies)
    pool = thinly(found.select("variant", "hits", "company_number", "same").join(asked, "variant"), "same").join(faces, "same")
    pool = pool.withColumn("name_similarity", names.similarity_of(F.col("org_words"), F.col("org_letters"), F.col("title_words"), F.col("title_letters")))
    pool = pool.withColumns(bonuses(F.col("town_norm"), F.col("county_norm"), F.col("locality_norm"), F.col("region_norm"), F.col("face_status")))
    pool = pool.withColumn("total", F.least(F.lit(1.0), F.col("name_similarity") + F.col("locality_bonus") + F.col("region_bonus") + F.col("status_bonus")))
    pool = thinly(pool.select("org_name", "org_norm", "variant_index", "variant", "hits", "company_number", "name_similarity", "locality_bonus", "region_bonus", "status_bonus", "total"), "org_name")
    if top is not None:
        each = Window.partitionBy("org_name", "variant_index").orderBy(F.desc("total"), F.desc("hits"), "company_number")
        pool = _stopped(pool.withColumn("nth", F.row_number().over(each)).filter(F.col("nth") <= top).drop("nth"))
        pool = ranked(pool, top)
    return pool, known


def _shown(pool: DataFrame, known: Index) -> DataFrame:
    """pool with what a search shows of its companies."""
    shown = known.companies.select(
        "company_number", "title_norm", F.col("company_name").alias("title"), F.col("company_status").alias("status"), F.col("address_locality").alias("locality"),
        F.col("address_region").alias("region"), F.col("address_postcode").alias("postcode"),
    )
    given = ["title_norm", "title", "status", "locality", "region", "postcode"]
    found = pool.join(shown, "company_number")
    at = pool.columns.index("company_number") + 1
    return found.select(*pool.columns[:at], *given, *pool.columns[at:])


def _stopped(pool: DataFrame) -> DataFrame:
    """Without variants after the first that reaches EARLY_STOP."""
    stop = F.min(F.when(F.col("total") >= EARLY_STOP, F.col("variant_index"))).over(Window.partitionBy("org_name"))
    return pool.withColumn("stop", stop).filter(F.col("stop").isNull() | (F.col("variant_index") <= F.col("stop"))).drop("stop")


def scored_candidates(orgs: DataFrame, clean_registry: DataFrame | Index, max_candidates: int = MAX_CANDIDATES) -> DataFrame:
    """All searched candidates of every organisation with their scores; variants after the first
    that reaches EARLY_STOP are left out. orgs: org_name, town, county, and any other columns."""
    pool, known = _pool(orgs, clean_registry, max_candidates)
    return _shown(_stopped(pool), known)


def top_candidates(orgs: DataFrame, clean_registry: DataFrame | Index, max_candidates: int = MAX_CANDIDATES, top: int = TOP) -> DataFrame:
    """ranked() of scored_candidates(). Only the best `top` of each variant can come in, and its best one
    says whether it stops the search. Of companies that score alike these are the first by number, and
    only those that come in are looked up."""
    return _shown(*_pool(orgs, clean_registry, max_candidates, top))


def ranked(pool: DataFrame, top: int = TOP) -> DataFrame:
    """The best candidates of each organisation with `rank` from 1. A company that two variants
    find takes two ranks."""
    order = Window.partitionBy("org_name").orderBy(F.desc("total"), "variant_index", F.desc("hits"), "company_number")
    return pool.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def candidate_rows(top: DataFrame) -> DataFrame:
    """The audit table of candidates, scores rounded for display."""
    r = lambda c: values.round_half_even(F.col(c))
    return top.select("org_name", "rank", F.col("company_number").alias("candidate_company_number"), F.col("title").alias("candidate_title"), F.col("status").alias("candidate_status"), F.col("locality").alias("candidate_locality"), F.col("region").alias("candidate_region"), F.col("postcode").alias("candidate_postcode"), r("total").alias("candidate_score"), r("name_similarity").alias("score_name_similarity"), r("locality_bonus").alias("score_locality_bonus"), r("region_bonus").alias("score_region_bonus"), r("status_bonus").alias("score_status_bonus"), F.col("variant").alias("query_used"))


def best(orgs: DataFrame, top: DataFrame) -> DataFrame:
    """Every organisation with its first candidate, where it has one, as `b_` columns."""
    first = top.filter(F.col("rank") == 1)
    first = first.select("org_name", *[F.col(c).alias(f"b_{c}") for c in ("company_number", "title", "status", "locality", "region", "postcode", "total", "name_similarity", "locality_bonus", "region_bonus", "status_bonus", "variant")])
    return orgs.join(first, "org_name", "left")


def accepted(c: DataFrame, min_score: float = MIN_SCORE) -> Column:
    """Unrounded total at the minimum or above, and a company number."""
    return F.coalesce((c["b_total"] >= min_score) & (c["b_company_number"] != ""), F.lit(False))


def enriched(with_best: DataFrame, clean_registry: DataFrame | Index, min_score: float = MIN_SCORE) -> DataFrame:
    """Accepted organisations with their company's profile; blank profile values fall back to what
    the search showed. A best match without a profile stops the job."""
    companies = clean_registry.companies if isinstance(clean_registry, Index) else registry.companies(clean_registry)
    profile = companies.select(F.col("company_number").alias("p_number"), *[F.col(c).alias(f"p_{c}") for c in registry.CLEAN[1:9]])
    keep = [c for c in with_best.columns if not c.startswith("b_")]
    joined = with_best.filter(accepted(with_best, min_score)).join(profile, F.col("b_company_number") == F.col("p_number"), "left")
    number = F.when(F.col("p_number").isNull(), F.raise_error(F.concat(F.lit("no profile of "), "b_company_number")).cast("string")).otherwise(F.col("b_company_number"))
    fall = lambda p, b: F.coalesce(F.nullif(F.col(p), F.lit("")), F.col(b))
    r = lambda c: values.round_half_even(F.col(c))
    return joined.select(
        *keep, F.lit("matched").alias("match_status"), r("b_total").alias("match_score"), confidence(F.col("b_total")).alias("match_confidence"), F.col("b_variant").alias("match_query_used"),
        r("b_name_similarity").alias("score_name_similarity"), r("b_locality_bonus").alias("score_locality_bonus"), r("b_region_bonus").alias("score_region_bonus"), r("b_status_bonus").alias("score_status_bonus"),
        number.alias("ch_company_number"), fall("p_company_name", "b_title").alias("ch_company_name"), fall("p_company_status", "b_status").alias("ch_company_status"), F.col("p_company_type").alias("ch_company_type"),
        F.col("p_date_of_creation").alias("ch_date_of_creation"), F.col("p_sic_codes").alias("ch_sic_codes"), fall("p_address_locality", "b_locality").alias("ch_address_locality"), fall("p_address_region", "b_region").alias("ch_address_region"), fall("p_address_postcode", "b_postcode").alias("ch_address_postcode"),
    )


def unmatched(with_best: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The other organisations, with the best candidate they had."""
    keep = [c for c in with_best.columns if not c.startswith("b_")]
    rest = with_best.filter(~accepted(with_best, min_score))
    return rest.select(*keep, F.lit("unmatched").alias("match_status"), F.lit("").alias("match_error"), values.round_half_even(F.col("b_total")).alias("best_candidate_score"), F.coalesce("b_title", F.lit("")).alias("best_candidate_title"), F.coalesce("b_company_number", F.lit("")).alias("best_candidate_company_number"))


def profile_errors(with_best: DataFrame, clean_registry: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Accepted organisations whose company has no profile, as rows instead of an error."""
    keep = [c for c in with_best.columns if not c.startswith("b_")]
    known = clean_registry.select(F.col("company_number").alias("b_company_number")).distinct()
    lost = with_best.filter(accepted(with_best, min_score)).join(known, "b_company_number", "left_anti")
    return lost.select(*keep, F.lit("profile_error").alias("match_status"), F.concat(F.lit("no profile of "), "b_company_number").alias("match_error"), values.round_half_even(F.col("b_total")).alias("best_candidate_score"), F.col("b_title").alias("best_candidate_title"), F.col("b_company_number").alias("best_candidate_company_number"))
