"""JSON payloads of company searches and profiles as typed rows, by variant functions.

What is absent or null is ''; a value of another type than its contract's stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import values
from tessera.functions.names import strip

ADDRESS = ("locality", "region", "postal_code")


def validated(payload: Column, schema: str) -> Column:
    """A JSON text as a value of the schema; one that doesn't parse or fit stops the job."""
    return F.from_json(payload, schema, {"mode": "FAILFAST"})


def _kind(v: Column, path: str) -> Column:
    """The type at a path: null where nothing is there, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _wrong(path: str, kind: Column) -> Column:
    return F.raise_error(F.concat(F.lit(f"{path}: not a "), F.lit("value of its contract but "), kind))


def text_at(v: Column, path: str) -> Column:
    kind = _kind(v, path)
    return F.when(kind.isNull() | (kind == "VOID"), "").when(kind == "STRING", F.try_variant_get(v, path, "string")).otherwise(_wrong(path, kind).cast("string"))


def _object_at(v: Column, path: str) -> Column:
    """A variant that is an object, or null."""
    kind = _kind(v, path)
    none = F.lit(None).cast("variant")
    return F.when(kind.isNull() | (kind == "VOID"), none).when(F.startswith(kind, F.lit("OBJECT")), F.try_variant_get(v, path, "variant")).otherwise(F.parse_json(_wrong(path, kind).cast("string")))


def codes_at(v: Column, path: str) -> Column:
    """A list of codes, or one text separated by ';' or ','; blanks and nulls go, other types are none."""
    kind = _kind(v, path)
    listed = F.filter(F.transform(F.coalesce(F.try_variant_get(v, path, "array<string>"), F.array().cast("array<string>")), lambda x: strip(values.text(x))), lambda x: x != "")
    return F.when(F.startswith(kind, F.lit("ARRAY")), listed).when(kind == "STRING", values.sic_list(F.try_variant_get(v, path, "string"))).otherwise(F.array().cast("array<string>"))


def _address(v: Column, path: str) -> Column:
    return F.struct(*[F.coalesce(text_at(_object_at(v, path), f"$.{x}"), F.lit("")).alias(x) for x in ADDRESS])


def search_items(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    """The items of search payloads, `nth` from 0: title, company_number, company_status, address."""
    v = F.parse_json(F.col(payload))
    items = rows.select(*keep, v.alias("_v"))
    kind = _kind(F.col("_v"), "$.items")
    listed = F.when(kind.isNull() | (kind == "VOID"), F.array().cast("array<variant>")).when(F.startswith(kind, F.lit("ARRAY")), F.try_variant_get("_v", "$.items", "array<variant>"))
    listed = listed.otherwise(F.array(F.parse_json(_wrong("$.items", kind).cast("string"))))
    items = items.select(*keep, F.posexplode(listed).alias("nth", "_item"))
    i = F.col("_item")
    return items.select(*keep, "nth", *[text_at(i, f"$.{c}").alias(c) for c in ("title", "company_number", "company_status")], _address(i, "$.address").alias("address"))


def profiles(rows: DataFrame, payload: str, *keep: str) -> DataFrame:
    """Profile payloads: name, status, type, date, codes as an array, and the address."""
    p = rows.select(*keep, F.parse_json(F.col(payload)).alias("_v"))
    v = F.col("_v")
    return p.select(*keep, *[text_at(v, f"$.{c}").alias(c) for c in ("company_name", "company_status", "type", "date_of_creation")], codes_at(v, "$.sic_codes").alias("sic_codes"), _address(v, "$.registered_office_address").alias("registered_office_address"))
