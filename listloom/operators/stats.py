"""Counts and distributions of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listloom.functions import bar, percentage, reduction
from listloom.schema import ALLOW, BLOCK, COMMENT


def summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: total_before, total_after, dedup_rate, block_count, allow_count, comment_count. Types of other names are in no count."""
    return summary_of(before.agg(F.count("*").alias("total_before")), after)


def summary_of(before: DataFrame, after: DataFrame) -> DataFrame:
    """summary() where total_before is known: before has it, in one row."""
    counts = [F.count_if(F.col("type") == kind).alias(f"{kind}_count") for kind in (BLOCK, ALLOW, COMMENT)]
    made = after.agg(F.count("*").alias("total_after"), *counts)
    both = made.select(before.select(F.col("total_before").cast("bigint")).scalar().alias("total_before"), "*")
    return both.select("total_before", "total_after", reduction("total_before", "total_after").alias("dedup_rate"), "block_count", "allow_count", "comment_count")


def distribution(rules: DataFrame, column: str, order: str = "ordinal") -> DataFrame:
    """(column, count, first): rules by a column; first is the place of its first rule, by which ties are ordered."""
    return rules.groupBy(column).agg(F.count("*").alias("count"), F.min(order).alias("first"))


def top(rules: DataFrame, column: str, order: str = "ordinal", n: int = 10) -> DataFrame:
    """The n largest counts of a distribution, ties by first appearance. Domains count block and allow rules only, as they are written."""
    if column == "domain":
        rules = rules.where(F.col("type").isin(BLOCK, ALLOW))
    return distribution(rules, column, order).orderBy(F.desc("count"), "first").limit(n)


def type_distribution(rules: DataFrame, order: str = "ordinal") -> DataFrame:
    """(type, count, first, percent, bar) by descending count."""
    by = distribution(rules, "type", order)
    total = F.sum("count").over(Window.partitionBy())  # over one row for each type
    shares = by.withColumn("percent", percentage("count", total))
    return shares.select("type", "count", "first", "percent", bar("percent").alias("bar")).orderBy(F.desc("count"), "first")
