"""The merge: sources to lines to rules to one deduplicated, ordered list."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.operators.classify import classify
from listloom.operators.dedup import deduplicate, survivors
from listloom.operators.relations import conflicts
from listloom.operators.stats import summary_of
from listloom.sources.lists import readable, read_lines
from listloom.storage import delete, shared_folder, stored


@dataclass
class MergeResult:
    """rules: the merged list; parsed: what it was made of; found: parsed by key; stats and conflicts as far as they were asked for."""

    rules: DataFrame
    parsed: DataFrame
    found: DataFrame | None = None
    stats: dict[str, Any] = field(default_factory=dict)
    conflicts: DataFrame | None = None
    folders: list[str] = field(default_factory=list)

    def keep(self, df: DataFrame) -> DataFrame:
        """df as a stored table, until release()."""
        self.folders.append(shared_folder(df.sparkSession))
        return stored(df, self.folders[-1])

    def release(self) -> None:
        """Delete the stored tables; what was read from them is gone. Without this they go when the driver ends."""
        while self.folders:
            delete(self.rules.sparkSession, self.folders.pop())

    def summary(self) -> DataFrame:
        """The counts of this merge as one row: those before it are summed up by key already."""
        return summary_of(self.found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_before")), self.rules)

    def ordered(self) -> DataFrame:
        """The rules in order: block, allow, comments, each by first appearance."""
        return self.rules.orderBy("type_rank", "pos")


def merge_lines(lines: DataFrame) -> MergeResult:
    """The merge of rule lines (source_idx, source, line_no, line), without statistics.

    Lines are read, classified and shuffled once; the survivors are stored, and only coverage is left to be computed.
    """
    parsed = classify(lines)
    result = MergeResult(parsed, parsed)
    result.found = result.keep(survivors(parsed))
    result.rules = deduplicate(parsed, result.found)
    return result


def merge(spark: SparkSession, sources: list[str], return_stats: bool = False, detect_conflicts: bool = False, concurrent: bool = True, timeout: float = 30, raw_conflicts: bool = False, max_workers: int | None = None) -> MergeResult:
    """Merge lists from files and urls.

    Sources that cannot be read are left out. Rows keep the order of sources and lines, which is one of the orders in
    which sources can arrive. concurrent reads a source as often as it is named and counts every one as processed; without
    it a name is read once and only what was read counts. sources_succeeded counts what was read in either case.
    detect_conflicts implies statistics and looks at the merged rules, with raw_conflicts at all parsed ones. max_workers
    bounds the tasks that fetch at one time. What was fetched is stored, so rules and statistics come from one reading.
    """
    if not isinstance(sources, list):
        raise TypeError(f"sources is a list, not {type(sources).__name__}")
    began = time.time()
    kept = MergeResult(None, None)
    read = kept.keep(read_lines(spark, sources if concurrent else list(dict.fromkeys(sources)), timeout, max_workers))
    result = merge_lines(readable(read))
    result.folders += kept.folders
    result.rules = result.keep(result.rules)
    if return_stats or detect_conflicts:
        ok = readable(read, lines=False).count()
        stats = result.summary().first().asDict()
        stats["elapsed_time"] = time.time() - began
        stats |= {"sources_processed": len(sources) if concurrent else ok, "sources_total": len(sources), "sources_succeeded": ok}
        if detect_conflicts:
            result.conflicts = result.keep(conflicts(result.parsed if raw_conflicts else result.rules).orderBy("domain"))
            stats["conflict_count"] = result.conflicts.count()
        result.stats = stats
    return result


def failures(spark: SparkSession, sources: list[str], timeout: float = 30) -> DataFrame:
    """(source_idx, source, error) of sources that cannot be read."""
    failed = read_lines(spark, sources, timeout).where(F.col("error").isNotNull())
    return failed.groupBy("source_idx", "source").agg(F.min("error").alias("error"))
