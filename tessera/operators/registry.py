"""The registry side: cleaning the bulk table and the inverted token index over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import MissingColumnsError, RegistryUriMismatchError
from tessera.functions import names, values
from tessera.operators.dealing import dealt

CLEAN = ("company_number", "company_name", "company_status", "company_type", "date_of_creation", "sic_codes", "address_locality", "address_region", "address_postcode", "uri")
#: Where the cleaner finds its input; the headers of the bulk file, trimmed.
BULK = {
    "name": "CompanyName", "number": "CompanyNumber", "category": "CompanyCategory", "status": "CompanyStatus", "date": "IncorporationDate",
    "sic1": "SICCode.SicText_1", "sic2": "SICCode.SicText_2", "sic3": "SICCode.SicText_3", "sic4": "SICCode.SicText_4",
    "town": "RegAddress.PostTown", "county": "RegAddress.County", "postcode": "RegAddress.PostCode", "uri": "URI",
}


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def require(df: DataFrame, columns, step: str) -> DataFrame:
    """df, if it has the columns; others are welcome."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise MissingColumnsError(step, missing)
    return df


def uri_matches(uri: Column, number: Column) -> Column:
    """An absolute address whose path ends in /company/<number>."""
    path = F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#;]+([^?#;]*)", 1)
    return uri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+") & F.endswith(F.regexp_replace(path, r"/+\z", ""), F.concat(F.lit("/company/"), number))


def clean(raw: DataFrame, columns: dict[str, str] = BULK, strict: bool = True) -> DataFrame:
    """Ten canonical text columns, and `pos` where the rows have it. strict: a date or address that can't
    be right stops the job."""
    kept = ["pos"] if "pos" in raw.columns else []
    cells = raw.select(*[names.strip_column(values.text(F.col(f"`{v}`"))).alias(f"_{k}") for k, v in columns.items()], *kept)  # once a cell
    c = {k: F.col(f"_{k}") for k in columns}
    sics = [c[k] for k in ("sic1", "sic2", "sic3", "sic4") if k in c]
    out = cells.select(
        c["number"].alias("company_number"),
        c["name"].alias("company_name"),
        F.lower(c["status"]).alias("company_status"),
        values.slug(c["category"]).alias("company_type"),
        (values.strict_date if strict else values.parsed_date)(c["date"]).alias("date_of_creation"),
        values.sic_codes(*sics).alias("sic_codes"),
        c["town"].alias("address_locality"),
        c["county"].alias("address_region"),
        c["postcode"].alias("address_postcode"),
        c["uri"].alias("uri"),
        *kept,
    )
    if strict:
        fine = uri_matches(F.col("uri"), F.col("company_number"))
        out = out.withColumn("uri", F.when(fine, F.col("uri")).otherwise(F.raise_error(F.concat(F.lit("address and number differ: "), "company_number", F.lit(" "), "uri")).cast("string")))
    return out


def check_uris(clean_: DataFrame) -> None:
    """Raise with a few samples if any row's address doesn't name its number."""
    bad = clean_.filter(~uri_matches(F.col("uri"), F.col("company_number"))).select("company_number", "uri").limit(3).collect()
    if bad:
        raise RegistryUriMismatchError(str([tuple(r) for r in bad]))


def companies(clean_: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """One row per company number: the first of its rows by `order` (`pos` where the table has it and
    nothing is given, else all columns), with `title_norm`, and in `title_tokens` the words of all its
    rows' names, as an index by number holds them. Rows without a number can't be found and go. A
    table that has these columns already (see plans.steps.run_registry) is taken as it is."""
    if "title_tokens" in clean_.columns:
        return clean_
    by = list(order) or ["pos"] if "pos" in clean_.columns else list(order)
    rest = [c for c in clean_.columns if c not in by and c != "company_number"]
    keyed = dealt(clean_.filter(F.col("company_number") != ""), "company_number").withColumn("_norm", names.normalise(F.col("company_name")))
    # one sort a number: its first row, and beside it the names of all its rows
    rows = Window.partitionBy("company_number").orderBy(*by, *rest, "_norm")
    every = F.collect_set("_norm").over(rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    one = keyed.withColumns({"_nth": F.row_number().over(rows), "_norms": F.array_join(every, " ")}).filter(F.col("_nth") == 1)
    return one.select(*clean_.columns, names.tokens_of_normalised(F.col("_norms")).alias("title_tokens"), F.col("_norm").alias("title_norm"))


def described(companies_: DataFrame) -> DataFrame:
    """companies() with what matching compares: words and letters of names, normalised places."""
    if "title_words" in companies_.columns:
        return companies_
    out = companies_.withColumns({"locality_norm": names.normalise(F.col("address_locality")), "region_norm": names.normalise(F.col("address_region"))})
    return names.with_similarity_keys(out, "title_norm", "title_words", "title_letters")


def token_index(clean_: DataFrame) -> DataFrame:
    """(bucket, token, company_number), each pair once."""
    found = clean_.filter(F.col("company_number") != "").select(F.explode(names.tokens(F.col("company_name"))).alias("token"), "company_number").distinct()
    return found.select(names.bucket(F.col("token")).alias("bucket"), "token", "company_number")


def restrict_index(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Index rows of the wanted tokens (a column `token`). The wanted buckets become a pruning join
    of their own, so a partitioned index reads only their folders."""
    buckets = wanted.select(names.bucket(F.col("token")).alias("bucket")).distinct()
    return index.join(buckets, "bucket", "left_semi").join(wanted.select("token").distinct(), "token", "left_semi").dropDuplicates(["token", "company_number"])


def search_view(clean_: DataFrame) -> DataFrame:
    """What a search shows of a company."""
    return clean_.select("company_number", F.col("company_name").alias("title"), "company_status", F.struct(F.col("address_locality").alias("locality"), F.col("address_region").alias("region"), F.col("address_postcode").alias("postal_code")).alias("address"))


def profile_view(clean_: DataFrame) -> DataFrame:
    """A company's profile, its codes as an array."""
    return clean_.select(
        "company_number", "company_name", "company_status", F.col("company_type").alias("type"), "date_of_creation", values.sic_list(F.col("sic_codes")).alias("sic_codes"),
        F.struct(F.col("address_locality").alias("locality"), F.col("address_region").alias("region"), F.col("address_postcode").alias("postal_code")).alias("registered_office_address"),
    )
