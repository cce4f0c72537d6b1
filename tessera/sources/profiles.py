"""Scoring profiles: the shipped ones and strict loading of catalogues."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from tessera.errors import ProfileError, ProfileNotFoundError
from tessera.operators.scoring import Profile
from tessera.sources import tables
from tessera.sources.snapshots import read_json

#: Fixed values of the shipped profiles.
_TYPES = {"ltd": 0.08, "private-limited-company": 0.08, "public limited company": 0.05, "plc": 0.05, "llp": 0.06, "limited-partnership": 0.04, "community-interest-company": 0.02, "charitable-incorporated-organisation": 0.01}
_AGES = ((10.0, 0.12), (5.0, 0.10), (2.0, 0.07), (1.0, 0.04), (0.0, 0.02))
TECH = Profile(
    "tech", "software_engineering",
    {"620": 0.5, "631": 0.4, "582": 0.35, "611": 0.25, "612": 0.25, "619": 0.2, "721": 0.2, "722": 0.15, "711": 0.15},
    {"861": -0.25, "862": -0.2, "869": -0.15, "871": -0.25, "872": -0.25, "873": -0.25, "879": -0.25, "412": -0.15, "411": -0.1, "432": -0.1, "439": -0.1, "561": -0.2, "562": -0.2, "551": -0.15},
    ("software", "digital", "tech", "technology", "data", "ai", "cloud", "cyber", "app", "platform", "saas", "fintech", "healthtech", "edtech", "devops", "analytics", "machine", "learning", "automation"),
    ("care", "nursing", "recruitment", "staffing", "construction", "cleaning", "security", "catering", "restaurant", "hotel"),
    _TYPES, _AGES,
)
CARE = Profile(
    "care_support", "care_support",
    {"861": 0.4, "862": 0.4, "869": 0.35, "871": 0.5, "872": 0.5, "873": 0.5, "879": 0.4, "881": 0.35},
    {"620": -0.25, "631": -0.2, "582": -0.2, "611": -0.15, "612": -0.15, "619": -0.15},
    ("care", "nursing", "health", "support", "homecare", "clinic", "medical"),
    ("software", "digital", "tech", "technology", "cloud", "platform", "saas"),
    _TYPES, _AGES,
)
SHIPPED = {p.name: p for p in (TECH, CARE)}
DEFAULT = "tech"
#: What the parts of a profile hold. Numbers have a range; maps go from text to numbers.
_SIGNED, _SHARE, _YEARS = (-1.0, 1.0), (0.0, 1.0), (0.0, float("inf"))
_MAPS = ("sector_signals", "location_signals", "size_signals", "sic_positive_prefixes", "sic_negative_prefixes", "company_type_weights")
_WORDS = ("keyword_positive", "keyword_negative")
_PARTS = {
    "keyword_weights": {"positive_per_match": _SHARE, "positive_cap": _SHARE, "negative_per_match": _SHARE, "negative_cap": _SHARE},
    "company_status_scores": {"active": _SIGNED, "inactive": _SIGNED},
    "bucket_thresholds": {"strong": _SHARE, "possible": _SHARE},
}
SCHEMA_VERSION = 1


def _object(value, keys, where: str) -> dict:
    """A mapping with exactly these keys."""
    if not isinstance(value, dict):
        raise ProfileError(f"{where}: not an object")
    if extra := sorted(set(value) - set(keys)):
        raise ProfileError(f"{where}: unknown keys {extra}")
    if missing := sorted(set(keys) - set(value)):
        raise ProfileError(f"{where}: missing keys {missing}")
    return value


def _number(value, span: tuple[float, float], where: str) -> float:
    if isinstance(value, bool) or not isinstance(value, int | float) or not span[0] <= value <= span[1]:
        raise ProfileError(f"{where}: {value!r} is not between {span[0]:g} and {span[1]:g}")
    return float(value)


def _text(value, where: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ProfileError(f"{where}: {value!r} is no text")
    return value.strip()


def _signals(value, where: str) -> dict[str, float]:
    if not isinstance(value, dict):
        raise ProfileError(f"{where}: not an object")
    return {_text(k, where): _number(v, _SIGNED, f"{where}.{k}") for k, v in value.items()}


def _list(value, where: str) -> list:
    if not isinstance(value, list | tuple):
        raise ProfileError(f"{where}: not a list")
    return list(value)


def _profile(raw, where: str) -> Profile:
    raw = _object(raw, {"name", "job_type", *_MAPS, *_WORDS, *_PARTS, "company_age_scores"}, where)
    maps = {k: _signals(raw[k], f"{where}.{k}") for k in _MAPS}
    words = {k: tuple(_text(w, f"{where}.{k}").lower() for w in _list(raw[k], f"{where}.{k}")) for k in _WORDS}
    parts = {part: {k: _number(v, _PARTS[part][k], f"{where}.{part}.{k}") for k, v in _object(raw[part], _PARTS[part], f"{where}.{part}").items()} for part in _PARTS}
    age = _object(raw["company_age_scores"], ("unknown", "bands"), f"{where}.company_age_scores")
    bands = []
    for band in _list(age["bands"], f"{where}.company_age_scores.bands"):
        band = _object(band, ("min_years", "score"), f"{where}.company_age_scores.bands")
        bands.append((_number(band["min_years"], _YEARS, f"{where}.min_years"), _number(band["score"], _SIGNED, f"{where}.score")))
    if not bands or any(a[0] < b[0] for a, b in zip(bands, bands[1:])):
        raise ProfileError(f"{where}: age bands are missing or ascend")
    weights, status, levels = (parts[k] for k in _PARTS)
    if levels["strong"] <= levels["possible"]:
        raise ProfileError(f"{where}: strong is not above possible")
    return Profile(
        _text(raw["name"], f"{where}.name"), _text(raw["job_type"], f"{where}.job_type"), maps["sic_positive_prefixes"], maps["sic_negative_prefixes"], words["keyword_positive"], words["keyword_negative"], maps["company_type_weights"],
        tuple(bands), _number(age["unknown"], _SIGNED, f"{where}.unknown"), *(weights[k] for k in _PARTS["keyword_weights"]), status["active"], status["inactive"], levels["strong"], levels["possible"],
        {k: maps[k] for k in ("sector_signals", "location_signals", "size_signals")},
    )


def parse(payload) -> tuple[dict[str, Profile], str]:
    """The profiles of a catalogue by name, and the default one's name. Unknown, missing or mistyped
    entries, values out of range, ascending bands, repeated names and an absent default are errors."""
    payload = _object(payload, ("schema_version", "default_profile", "profiles"), "catalogue")
    if isinstance(payload["schema_version"], bool) or payload["schema_version"] != SCHEMA_VERSION:
        raise ProfileError(f"catalogue: schema_version is {payload['schema_version']!r}, not {SCHEMA_VERSION}")
    found = [_profile(raw, f"profiles.{i}") for i, raw in enumerate(_list(payload["profiles"], "profiles"))]
    out = {p.name: p for p in found}
    if not found or len(out) < len(found):
        raise ProfileError("catalogue: no profiles, or two of one name")
    default = _text(payload["default_profile"], "default_profile")
    if default not in out:
        raise ProfileError(f"the default profile {default!r} is not in the catalogue")
    return out, default


def load(spark: SparkSession, path: str | None) -> tuple[dict[str, Profile], str]:
    if not path:
        return SHIPPED, DEFAULT
    if not tables.exists(spark, path):
        raise ProfileNotFoundError(path)
    try:
        return parse(read_json(spark, path))
    except json.JSONDecodeError as e:
        raise ProfileError(f"{path}: {e}") from e


def resolve(catalogue: dict[str, Profile], default: str, name: str | None = None) -> Profile:
    wanted = (name or "").strip() or default
    if wanted not in catalogue:
        raise ProfileNotFoundError(f"no profile {wanted!r}; there are {sorted(catalogue)}")
    return catalogue[wanted]
