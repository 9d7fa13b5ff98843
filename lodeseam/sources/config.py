"""Configuration: sources, taxonomy and pilots, validated on the driver, as dimension tables."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession

from ..functions import vocabulary as V

SOURCE_FIELDS = ["id", "name", "base_url", "type", "country", "language", "priority", "notes"]
HTTP = re.compile(r"(?i)^\s*https?://(?![^/?#]*[@\s])(\[[0-9a-f:.]+\]|[^/?#:\[\]]+)(:[0-9]*)?([/?#]|\s*$)")


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def _phrases(values: object, what: str) -> None:
    _need(isinstance(values, list) and all(isinstance(v, str) and v.strip() for v in values), f"{what}: a list of non-empty strings is needed")


def _grades(d: dict, what: str) -> None:
    lo, hi = d.get("grade_min"), d.get("grade_max")
    _need(type(lo) is int and type(hi) is int and 1 <= lo <= hi <= 13, f"{what}: grades from 1 to 13 are needed")


def check_sources(data: object) -> list[dict]:
    """The list of sources, or ValueError."""
    _need(isinstance(data, dict) and isinstance(data.get("sources"), list), "sources: a mapping with a list is needed")
    seen: set[str] = set()
    for s in data["sources"]:
        _need(isinstance(s, dict) and isinstance(s.get("id"), str) and bool(s["id"]), "every source needs an id")
        _need(s["id"] not in seen, f"source {s['id']} is there twice")
        seen.add(s["id"])
        _need(all(type(s.get(flag)) is bool for flag in ("enabled", "verified")), f"source {s['id']}: enabled and verified have to be true or false")
        base = s.get("base_url", "")
        _need(isinstance(base, str) and (not base or bool(HTTP.match(base))) and (bool(base) or not (s["enabled"] and s["verified"])), f"source {s['id']}: base_url has to be an HTTP(S) URL")
    return data["sources"]


def check_taxonomy(config: object) -> dict:
    """The taxonomy, or ValueError."""
    _need(isinstance(config, dict) and isinstance(config.get("domains"), dict), "subjects: a mapping with domains is needed")
    for domain, d in config["domains"].items():
        _need(isinstance(d, dict) and isinstance(d.get("subjects"), list), f"domain {domain}: a list of subjects is needed")
        for s in d["subjects"]:
            _need(isinstance(s, dict) and isinstance(s.get("name"), str) and bool(s["name"]), f"domain {domain}: every subject needs a name")
            _phrases(s.get("aliases", []), f"subject {s['name']}")
            _grades(s, f"subject {s['name']}")
    _need(isinstance(config.get("education_levels"), dict), "education_levels: a mapping is needed")
    for level, d in config["education_levels"].items():
        _need(isinstance(d, dict), f"level {level}: a mapping is needed")
        _grades(d, f"level {level}")
        _phrases(d.get("aliases", []), f"level {level}")
    markers = config.get("grade_markers", {})
    _need(isinstance(markers, dict) and set(markers) <= {"before_number", "after_number"}, "grade_markers: before_number and after_number are known")
    for place, values in markers.items():
        _phrases(values, f"grade markers {place}")
    return config


def load(sources_path: str, subjects_path: str) -> tuple[list[dict], dict]:
    """Both YAML files, read and validated."""
    import yaml

    with open(sources_path, encoding="utf-8") as a, open(subjects_path, encoding="utf-8") as b:
        return check_sources(yaml.safe_load(a) or {}), check_taxonomy(yaml.safe_load(b) or {})


def sources_table(spark: SparkSession, sources: list[dict]) -> DataFrame:
    schema = ", ".join(f"{f} string" for f in SOURCE_FIELDS) + ", enabled boolean, verified boolean"
    return spark.createDataFrame([tuple(str(s.get(f, "")) for f in SOURCE_FIELDS) + (s["enabled"], s["verified"]) for s in sources], schema)


def subjects_table(spark: SparkSession, config: dict) -> DataFrame:
    """ord, domain, subject, phrase: each subject's name and aliases, one a row."""
    rows = [(domain, s["name"], p) for domain, d in config["domains"].items() for s in d["subjects"] for p in [s["name"], *s.get("aliases", [])]]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "ord int, domain string, subject string, phrase string")


def levels_table(spark: SparkSession, config: dict) -> DataFrame:
    rows = [(i, n, d["grade_min"], d["grade_max"], d.get("aliases", V.DEFAULT_LEVEL_ALIASES.get(n, []))) for i, (n, d) in enumerate(config["education_levels"].items())]
    return spark.createDataFrame(rows, "ord int, level string, lo int, hi int, aliases array<string>")


def check_pilots(text: str) -> dict[str, str]:
    """doc_id -> title of a pilot annotation file's text, or ValueError."""
    data = json.loads(text)
    _need(isinstance(data, dict) and data.get("schema_version") == V.PILOT_SCHEMA and isinstance(data.get("pilots"), list), "pilots: unknown schema")
    out: dict[str, str] = {}
    for p in data["pilots"]:
        _need(isinstance(p, dict) and isinstance(p.get("doc_id"), str) and bool(re.fullmatch(V.ID_PATTERN[1:-1], p["doc_id"])) and isinstance(p.get("title"), str) and bool(p["title"].strip()) and p["doc_id"] not in out, "pilots: an invalid or repeated annotation")
        out[p["doc_id"]] = p["title"]
    return out


def pilots_table(spark: SparkSession, pilots: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(pilots.items()), "doc_id string, title string")
