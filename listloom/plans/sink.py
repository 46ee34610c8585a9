"""Writing a merged list."""

from __future__ import annotations

from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listloom.storage import stored


def header(stats: dict[str, Any] | None, total: int | None = None) -> list[str]:
    """The comment lines above a merged list."""
    out = ["! Merged Filter Rules", f"! Generated: {datetime.now(UTC).replace(tzinfo=None).isoformat()}Z"]
    if stats:
        total = stats.get("total_after", 0) if total is None else total
        out += [f"! Sources: {stats.get('sources_processed', 0)}/{stats.get('sources_total', 0)}", f"! Total rules: {total}"]
        out += [f"! Deduplication rate: {stats.get('dedup_rate', 0):.1f}%", f"! Processing time: {stats.get('elapsed_time', 0):.2f}s"]
        if stats.get("conflict_count", 0) > 0:
            out.append(f"! Conflicts detected: {stats['conflict_count']}")
    return [*out, "!"]


def write_rules(rules: DataFrame, path: str, stats: dict[str, Any] | None = None) -> int:
    """Write the rules in order, below a header, to one file of the driver; how many they were.

    The cluster sorts; the driver streams the sorted partitions, one at a time, and never holds the list.
    """
    lines = rules.orderBy("type_rank", "pos").select("raw")
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.writelines(f"{line}\n" for line in header(stats))
        for row in lines.toLocalIterator(prefetchPartitions=True):
            f.write(f"{row['raw']}\n")
            n += 1
    return n


def write_rules_distributed(rules: DataFrame, path: str) -> None:
    """Write the rules in order as text part files in any store that Spark writes: the files' names give their order."""
    rules.orderBy("type_rank", "pos").select("raw").write.mode("overwrite").text(path)


def report_path(output: str, suffix: str) -> str:
    return str(Path(output).with_suffix(f".report.{suffix}"))


def numbered(rules: DataFrame) -> DataFrame:
    """rules with out_pos, their place from 0 in the merged order, without bringing them into one task.

    Ranges of the order are sorted apart; the numbers of rows before a range come from one count for each range.
    """
    n = int(rules.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rules.repartitionByRange(n, "type_rank", "pos").withColumn("_range", F.spark_partition_id()))
    ends = dealt.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = ends.select("_range", (F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")).alias("_before"))  # a row for each range
    place = F.row_number().over(Window.partitionBy("_range").orderBy("type_rank", "pos"))
    return dealt.withColumn("_place", place).join(before, "_range").withColumn("out_pos", F.col("_before") + F.col("_place") - 1).drop("_range", "_place", "_before")
