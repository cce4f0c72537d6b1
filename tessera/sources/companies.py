"""Where companies are looked up one by one: a snapshot's tables, or a JSON API. Batch matching takes
neither, see operators.matching."""

from __future__ import annotations

import hashlib
import json
from typing import Protocol
from urllib.parse import quote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tessera.errors import MissingInputError, MissingProfileRowError, MissingSettingError, SourceKindError
from tessera.functions import values
from tessera.operators import matching, registry
from tessera.sources import payloads, tables
from tessera.sources.http import Client


class CompanySource(Protocol):
    def search(self, query: str) -> list[Row]:
        """What a search finds, best first: company_number, title, company_status, address."""

    def profile(self, number: str) -> Row:
        """A company's profile."""


class TableSource:
    """Companies of registry.companies()."""

    def __init__(self, companies: DataFrame, most: int = matching.MAX_CANDIDATES):
        self.companies, self.most = registry.companies(companies), most

    def search(self, query: str) -> list[Row]:
        asked = self.companies.sparkSession.createDataFrame([(query,)], "variant string")
        found = matching.candidates(asked, self.companies, self.most)
        return found.join(registry.search_view(self.companies), "company_number").orderBy(F.desc("hits"), "company_number").drop("variant", "hits").collect()

    def profile(self, number: str) -> Row:
        got = registry.profile_view(self.companies.filter(F.col("company_number") == number.strip())).first()
        if got is None:
            raise MissingProfileRowError(number)
        return got


class ApiSource:
    def __init__(self, spark: SparkSession, client: Client, base: str, limit: int):
        self.spark, self.client, self.base, self.limit = spark, client, base.rstrip("/"), limit

    @staticmethod
    def key(prefix: str, *parts: str) -> str:
        """As values.cache_key() of the lower-cased parts."""
        return f"{prefix}:{hashlib.sha256('|'.join(p.strip().lower() for p in parts).encode()).hexdigest()[:16]}"

    def _rows(self, payload: dict) -> DataFrame:
        return self.spark.createDataFrame([(json.dumps(payload),)], "payload string")

    def search(self, query: str) -> list[Row]:
        got = self.client.get_json(f"{self.base}/search/companies?q={quote(query)}&items_per_page={self.limit}", self.key("search", query, str(self.limit)))
        return payloads.search_items(self._rows(got), "payload").orderBy("nth").drop("nth").collect()

    def profile(self, number: str) -> Row:
        got = self.client.get_json(f"{self.base}/company/{number}", self.key("profile", number))
        return payloads.profiles(self._rows(got), "payload").first()


def company_source(spark: SparkSession, kind: str, path: str = "", client: Client | None = None, base: str = "", limit: int = 10, most: int = matching.MAX_CANDIDATES) -> CompanySource:
    if kind == "file":
        if not path:
            raise MissingSettingError("registry_path")
        if not tables.exists(spark, path):
            raise MissingInputError(path)
        return TableSource(spark.read.parquet(path), most)
    if kind == "api":
        if client is None or not base:
            raise MissingSettingError("an API source needs a client and an address")
        return ApiSource(spark, client, base, limit)
    raise SourceKindError(kind)


def cache_keys(rows: DataFrame, prefix: str, column: str) -> DataFrame:
    """rows with `cache_key`, as ApiSource.key() makes it of one part."""
    return rows.withColumn("cache_key", values.cache_key(prefix, F.lower(F.trim(F.col(column)))))
