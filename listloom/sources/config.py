"""YAML source configuration: top-level groups of {name, url, enabled}."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.schema import SOURCES

GROUPS = ("sources", "test_sources")


def _entries(path: str) -> list[tuple[int, str, str | None, str, bool | None]]:
    import yaml

    if not Path(path).exists():
        raise FileNotFoundError(f"no configuration file at {path}")
    config = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    return [(i, group, item.get("name"), item["url"], item.get("enabled")) for group in GROUPS for i, item in enumerate(config.get(group) or [])]


def sources_frame(spark: SparkSession, path: str) -> DataFrame:
    """The configuration as a table; source_idx counts within a group."""
    return spark.createDataFrame(_entries(path), SOURCES)


def enabled_sources(sources: DataFrame, group: str = "sources") -> DataFrame:
    """(source_idx, url) of a group's sources that are not switched off."""
    return sources.where((F.col("grp") == group) & F.coalesce("enabled", F.lit(True))).select("source_idx", "url")


def load_sources(path: str, group: str = "sources") -> list[str]:
    """The urls of a group's enabled sources, in order; a missing group has none. A missing file raises FileNotFoundError."""
    return [url for _, grp, _, url, enabled in _entries(path) if grp == group and (True if enabled is None else enabled)]
