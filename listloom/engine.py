"""A library interface over Python lists, for programs that hold rules and not DataFrames."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from listloom.operators.classify import classify
from listloom.operators.dedup import deduplicate
from listloom.operators.relations import conflicts
from listloom.plans.merge import MergeResult, merge
from listloom.plans.report import Report
from listloom.schema import ALLOW, BLOCK, LINES
from listloom.sources.lists import fetch, read_contents, read_lines, readable
from listloom.storage import stored


@dataclass(eq=False)
class Rule:
    """A rule. Equal rules have equal normalized domains and types."""

    raw: str
    domain: str
    type: str
    wildcard: bool
    source: str

    @property
    def normalized_domain(self) -> str:
        return self.domain.lower().removeprefix("*.")

    def is_equivalent_to(self, other: object) -> bool:
        return isinstance(other, Rule) and (self.normalized_domain, self.type) == (other.normalized_domain, other.type)

    def is_subdomain_of(self, other: object) -> bool:
        if not isinstance(other, Rule) or not {self.type, other.type} <= {BLOCK, ALLOW} or not other.wildcard:
            return False
        return self.normalized_domain == other.normalized_domain or self.normalized_domain.endswith("." + other.normalized_domain)

    __eq__ = is_equivalent_to

    def __hash__(self) -> int:
        return hash((self.normalized_domain, self.type))

    def __str__(self) -> str:
        return self.raw


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rule objects as a table, in the order of the list."""
    if not isinstance(rules, list):
        raise TypeError(f"rules is a list, not {type(rules).__name__}")
    rows = [(r.raw, r.domain, r.type, r.wildcard, r.source, r.normalized_domain, i) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, "raw string, domain string, type string, wildcard boolean, source string, normalized_domain string, ordinal bigint")


def report(spark: SparkSession, rules: list[Rule], stats: dict[str, Any] | None = None) -> Report:
    """A report on a plain list of rules."""
    return Report(rules_frame(spark, rules), stats)


def _rules(df: DataFrame, *order: str) -> list[Rule]:
    return [Rule(*row) for row in df.orderBy(*order).select("raw", "domain", "type", "wildcard", "source").toLocalIterator()]


class LineParser:
    """Parses lines by classify(). skip_unsupported=False keeps cosmetic lines as comments, line by line only."""

    def __init__(self, spark: SparkSession, skip_unsupported: bool = True, profile: str = "full"):
        self.spark, self.skip_unsupported, self.profile = spark, skip_unsupported, profile

    def _parse(self, lines: list[str], source: str, keep: bool) -> list[Rule]:
        rows = self.spark.createDataFrame([(0, source, i, line) for i, line in enumerate(lines)], LINES)
        return _rules(classify(rows, keep, self.profile), "ordinal")

    def parse_line(self, line: str, source: str = "unknown") -> Rule | None:
        return next(iter(self._parse([line or ""], source, not self.skip_unsupported)), None)

    def parse_lines(self, lines: list[str], source: str = "unknown") -> list[Rule]:
        return self._parse(lines, source, not self.skip_unsupported)

    def parse_text(self, text: str, source: str = "unknown") -> list[Rule]:
        return self._parse(text.splitlines(), source, keep=False)


class Engine:
    """Fetches, parses, deduplicates and merges. max_workers bounds the tasks that fetch at one time, whatever the session has."""

    def __init__(self, spark: SparkSession, timeout: float = 30, max_workers: int = 10):
        if max_workers < 1:
            raise ValueError("max_workers is at least 1")
        self.spark, self.timeout, self.max_workers = spark, timeout, max_workers
        self.parser = LineParser(spark)

    def fetch_source(self, source: str) -> str:
        return fetch(source, self.timeout)

    def fetch_sources(self, sources: list[str]) -> dict[str, str]:
        """Texts of the sources that could be read."""
        return {r["source"]: r["content"] for r in read_contents(self.spark, sources, self.timeout, self.max_workers).where("error IS NULL").orderBy("source_idx").toLocalIterator()}

    def fetch_and_parse(self, sources: list[str]) -> list[Rule]:
        """Rules of the sources that could be read; a source counts as often as it is named."""
        read = stored(read_lines(self.spark, sources, self.timeout, self.max_workers))
        return _rules(classify(readable(read)), "ordinal")

    def deduplicate(self, rules: list[Rule]) -> list[Rule]:
        df = rules_frame(self.spark, rules)
        return _rules(deduplicate(df), "type_rank", "pos") if rules else []

    def detect_conflicts(self, rules: list[Rule]) -> list[dict[str, Any]]:
        """Domains both blocked and allowed, in their order, with the rules of each side."""
        made = lambda xs: [Rule(x["raw"], x["domain"], x["type"], x["wildcard"], x["source"]) for x in xs]
        return [{"domain": r["domain"], "block_rules": made(r["block_rules"]), "allow_rules": made(r["allow_rules"])} for r in conflicts(rules_frame(self.spark, rules)).orderBy("domain").toLocalIterator()]

    def merged(self, sources: list[str], **how: Any) -> MergeResult:
        return merge(self.spark, sources, timeout=self.timeout, max_workers=self.max_workers, **how)

    def merge(self, sources: list[str], return_stats: bool = False, detect_conflicts: bool = False, concurrent_parse: bool = True) -> list[Rule] | dict[str, Any]:
        """The merged rules as a list; with statistics or conflicts, a dictionary of rules, stats and conflicts."""
        found = self.merged(sources, return_stats=return_stats, detect_conflicts=detect_conflicts, concurrent=concurrent_parse)
        try:
            return self._out(found, return_stats or detect_conflicts)
        finally:
            found.release()

    def _out(self, found: MergeResult, with_stats: bool) -> list[Rule] | dict[str, Any]:
        rules = _rules(found.rules, "type_rank", "pos")
        if not with_stats:
            return rules
        out: dict[str, Any] = {"rules": rules, "stats": found.stats}
        if found.conflicts is not None:
            made = lambda xs: [Rule(x["raw"], x["domain"], x["type"], x["wildcard"], x["source"]) for x in xs]
            out["conflicts"] = [{"domain": r["domain"], "block_rules": made(r["block_rules"]), "allow_rules": made(r["allow_rules"])} for r in found.conflicts.toLocalIterator()]
        return out
