"""Relations between rules: conflicts, equivalence, and subdomains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.functions import label_suffixes
from listloom.schema import ALLOW, BLOCK

_RULE = ["ordinal", "raw", "domain", "type", "wildcard", "source"]


def conflict_domains(rules: DataFrame) -> DataFrame:
    """(domain, block_count, allow_count) of normalized domains that are both blocked and allowed: the intersection of both key sets."""
    count = lambda kind: F.count_if(F.col("type") == kind)
    both = rules.groupBy(F.col("normalized_domain").alias("conflict")).agg(count(BLOCK).alias("block_count"), count(ALLOW).alias("allow_count"))
    return both.where("block_count > 0 AND allow_count > 0").select(F.col("conflict").alias("domain"), "block_count", "allow_count")


def conflicts(rules: DataFrame) -> DataFrame:
    """(domain, block_rules, allow_rules), each list in the order of the input.

    Counts decide first, on narrow rows; only the rules of conflicting domains are then gathered. On deduplicated rules
    each list has one rule.
    """
    domains = conflict_domains(rules).select(F.col("domain").alias("conflict"))
    of = rules.join(domains, F.col("normalized_domain") == F.col("conflict"), "left_semi")
    listed = lambda kind: F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.struct(*_RULE))))
    grouped = of.groupBy(F.col("normalized_domain").alias("conflict")).agg(listed(BLOCK).alias("block_rules"), listed(ALLOW).alias("allow_rules"))
    return grouped.select(F.col("conflict").alias("domain"), "block_rules", "allow_rules")


def equivalent_pairs(rules: DataFrame) -> DataFrame:
    """(type, normalized_domain, first, other): each later rule of a key with the key's first one, which is linear in the rules."""
    heads = rules.groupBy("type", "normalized_domain").agg(F.min("ordinal").alias("first"))
    later = rules.select("type", "normalized_domain", F.col("ordinal").alias("other"))
    return later.join(heads, ["type", "normalized_domain"]).where("other > first").select("type", "normalized_domain", "first", "other")


def subdomain_pairs(rules: DataFrame) -> DataFrame:
    """(type, domain, wild_type, wild_domain): distinct block or allow keys and the wildcard keys, of either type, that they lie under.

    A wildcard key lies under itself.
    """
    real = rules.where(F.col("type").isin(BLOCK, ALLOW))
    wild = real.where("wildcard").select(F.col("type").alias("wild_type"), F.col("normalized_domain").alias("wild_domain")).distinct()
    all_keys = real.select("type", F.col("normalized_domain").alias("key")).distinct()
    below = all_keys.select("type", "key", F.explode(label_suffixes("key")).alias("wild_domain"))
    return below.join(wild, "wild_domain").select("type", F.col("key").alias("domain"), "wild_type", "wild_domain")
