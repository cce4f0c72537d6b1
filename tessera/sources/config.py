"""Settings: command line before file before environment before defaults."""

from __future__ import annotations

import os
import tomllib
from collections.abc import Mapping
from dataclasses import dataclass, fields

from tessera.errors import ConfigError


@dataclass(frozen=True)
class Config:
    snapshot_root: str = "data/cache/snapshots"
    register_path: str = ""
    registry_path: str = ""
    source_kind: str = "file"
    api_base: str = ""
    search_limit: int = 10
    employees_path: str = ""
    out_dir: str = "data/processed"
    max_candidates: int = 500
    min_match_score: float = 0.72
    score_threshold: float = 0.55
    profile_path: str = ""
    profile_name: str = ""
    aliases_path: str = ""
    region: str = ""
    postcodes: tuple[str, ...] = ()
    min_employees: int | None = None
    include_unknown_size: bool = False
    batch_size: int = 250
    batch_start: int = 1
    batch_count: int | None = None
    as_of: str = ""


_MANY = float("inf")
_RANGES = {"min_match_score": (0, 1), "score_threshold": (0, 1), "max_candidates": (1, _MANY), "search_limit": (1, _MANY), "batch_size": (1, _MANY), "batch_start": (1, _MANY), "batch_count": (1, _MANY), "min_employees": (1, _MANY)}
_TRUE, _FALSE = ("true", "1", "yes", "on"), ("false", "0", "no", "off")


def _value(name: str, raw):
    kind = {f.name: f.type for f in fields(Config)}.get(name)
    if kind is None:
        raise ConfigError(f"unknown setting {name}")
    try:
        if kind == "bool":
            word = str(raw).strip().lower()
            if word not in _TRUE + _FALSE:
                raise ValueError
            return word in _TRUE
        if kind.startswith("int"):
            return None if raw in (None, "") else int(raw)
        if kind == "float":
            return float(raw)
        if kind.startswith("tuple"):
            return tuple(x.strip() for x in (raw.split(",") if isinstance(raw, str) else raw) if x.strip())
        return str(raw)
    except (TypeError, ValueError) as e:
        raise ConfigError(f"{name}: {raw!r} is not a {kind}") from e


def load(cli: Mapping | None = None, path: str | None = None, env: Mapping[str, str] | None = None) -> Config:
    """cli: given options only. path: a TOML file with [tessera]; unknown keys are errors. env:
    TESSERA_<SETTING>."""
    found: dict = {}
    for f in fields(Config):
        if (raw := (os.environ if env is None else env).get(f"TESSERA_{f.name.upper()}")) is not None:
            found[f.name] = _value(f.name, raw)
    if path:
        try:
            with open(path, "rb") as file:  # a settings file lies beside the driver
                content = tomllib.load(file)
        except (OSError, tomllib.TOMLDecodeError) as e:
            raise ConfigError(f"{path}: {e}") from e
        if content.pop("schema_version", 1) != 1:
            raise ConfigError(f"{path}: another schema_version than 1")
        if set(content) - {"tessera"}:
            raise ConfigError(f"{path}: unknown sections {sorted(set(content) - {'tessera'})}")
        if blank := [k for k, v in content.get("tessera", {}).items() if isinstance(v, str) and not v.strip()]:
            raise ConfigError(f"{path}: blank values of {blank}")
        found |= {k: _value(k, v) for k, v in content.get("tessera", {}).items()}
    found |= {k: _value(k, v) for k, v in (cli or {}).items() if v is not None}
    cfg = Config(**found)
    for name, (low, high) in _RANGES.items():
        value = getattr(cfg, name)
        if value is not None and not low <= value <= high:
            raise ConfigError(f"{name}: {value} is not between {low:g} and {high:g}")
    if "," in cfg.region:
        raise ConfigError("region: one only")
    if cfg.source_kind not in ("file", "api"):
        raise ConfigError(f"source_kind: {cfg.source_kind!r} is neither file nor api")
    return cfg
