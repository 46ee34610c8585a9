"""Reports: small aggregates come to the driver and are rendered there."""

from __future__ import annotations

import json
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.functions import shortened
from listloom.operators.stats import distribution, top, type_distribution

FORMATS = {"markdown": "md", "text": "txt", "json": "json"}
#: The two tables of a Markdown report, as heading, head, rule, column and the mark around its values.
TABLES = [
    ("## Source Distribution", "| Source | Rule Count |", "|--------|------------|", "source", ""),
    ("## Top Domains", "| Domain | Count |", "|--------|-------|", "domain", "`"),
]


class Report:
    """A report on merged rules (with columns type_rank and pos, or ordinal) and their statistics."""

    def __init__(self, rules: DataFrame, stats: dict[str, Any] | None = None):
        self.rules = rules
        self.stats = stats or {}
        if {"type_rank", "pos"} <= set(rules.columns):
            self.rules = rules.withColumn("place", F.struct("type_rank", "pos"))  # first appearance in the merged list
            self.order = "place"
        else:
            self.order = "ordinal"

    def _sections(self) -> list[tuple[str, str]]:
        """Headline figures as (label, text), formatted once for all kinds of report."""
        s = self.stats
        return [
            ("before", str(s.get("total_before", "N/A"))),
            ("after", str(s.get("total_after", "N/A"))),
            ("rate", f"{s.get('dedup_rate', 0):.1f}%"),
            ("processed", str(s.get("sources_processed", 0))),
            ("sources", str(s.get("sources_total", 0))),
            ("time", f"{s.get('elapsed_time', 0):.3f}"),
            ("block", str(s.get("block_count", 0))),
            ("allow", str(s.get("allow_count", 0))),
            ("comment", str(s.get("comment_count", 0))),
        ]

    def markdown(self, title: str = "Rules Merge Report") -> str:
        """Summary, ten largest sources and domains, and all types."""
        out = [f"# {title}", "", f"**Generated:** {datetime.now(UTC):%Y-%m-%d %H:%M:%S} UTC", "", "## Summary", ""]
        if self.stats:
            v = dict(self._sections())
            out += [
                f"- **Total Rules (before dedup):** {v['before']}", f"- **Total Rules (after dedup):** {v['after']}",
                f"- **Deduplication Rate:** {v['rate']}", f"- **Sources Processed:** {v['processed']} / {v['sources']}",
                f"- **Processing Time:** {v['time']} seconds", "", "### Rule Breakdown", "",
                f"- **Block Rules:** {v['block']}", f"- **Allow Rules:** {v['allow']}", f"- **Comments:** {v['comment']}", "",
            ]
            if "conflict_count" in self.stats:
                out += [f"- **Conflicts Detected:** {self.stats['conflict_count']}", ""]
        for heading, head, rule, column, mark in TABLES:
            rows = top(self.rules, column, self.order)
            rows = rows.select((shortened(column) if column == "source" else rows[column]).alias("label"), "count").collect()
            if rows:
                out += [heading, "", head, rule, *(f"| {mark}{r['label']}{mark} | {r['count']} |" for r in rows), ""]
        out += ["## Rule Types Distribution", ""]
        out += [f"- **{r['type'].capitalize()}:** {r['count']} ({r['percent']:.1f}%) {r['bar']}" for r in type_distribution(self.rules, self.order).collect()]
        return "\n".join([*out, ""])

    def json(self) -> dict[str, Any]:
        """Statistics and the whole distributions by source and type."""
        by = {c: {r[c]: r["count"] for r in distribution(self.rules, c, self.order).orderBy("first").collect()} for c in ("source", "type")}
        return {
            "generated_at": datetime.now(UTC).replace(tzinfo=None).isoformat(),
            "summary": {"total_rules": sum(by["type"].values()), **self.stats},
            "distributions": {"by_source": by["source"], "by_type": by["type"]},
        }

    def text(self) -> str:
        """Summary and breakdown."""
        out = ["=" * 60, "Rules Merge Report", "=" * 60, f"Generated: {datetime.now(UTC):%Y-%m-%d %H:%M:%S} UTC", ""]
        if self.stats:
            v = dict(self._sections())
            shown = [("Total Rules (before)", v["before"]), ("Total Rules (after)", v["after"]), ("Deduplication Rate", v["rate"]), ("Sources", f"{v['processed']}/{v['sources']}"), ("Processing Time", f"{v['time']}s")]
            out += ["SUMMARY", "-" * 40, *(f"{k + ':':<21} {x}" for k, x in shown), "", "RULE BREAKDOWN", "-" * 40]
            out += [*(f"{k + ':':<13} {v[x]}" for k, x in (("Block Rules", "block"), ("Allow Rules", "allow"), ("Comments", "comment"))), ""]
        return "\n".join(out)

    def save(self, path: str, form: str = "markdown") -> None:
        """Write the report, in one of FORMATS, to a file of the driver; its folder is made if needed."""
        if form not in FORMATS:
            raise ValueError(f"unknown format: {form}")
        content = json.dumps(self.json(), indent=2) if form == "json" else getattr(self, form)()
        Path(path).parent.mkdir(parents=True, exist_ok=True)
        Path(path).write_text(content, encoding="utf-8")
