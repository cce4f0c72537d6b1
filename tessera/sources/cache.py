"""A key-value cache of JSON objects as files on any Hadoop file system."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession

from tessera.errors import PayloadError
from tessera.sources import snapshots, tables


class JsonCache:
    """One file per key, named by the key's SHA-256."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, key: str) -> str:
        return f"{self.folder}/{hashlib.sha256(key.encode()).hexdigest()}.json"

    def has(self, key: str) -> bool:
        return tables.exists(self.spark, self.path(key))

    def get(self, key: str) -> dict | None:
        if not self.has(key):
            return None
        try:
            got = snapshots.read_json(self.spark, self.path(key))
        except json.JSONDecodeError as e:
            raise PayloadError(f"{key}: {e}") from e
        if not isinstance(got, dict):
            raise PayloadError(f"{key}: the cache holds no object")
        return got

    def set(self, key: str, value: dict) -> None:
        snapshots.write_json(self.spark, self.path(key), value)
