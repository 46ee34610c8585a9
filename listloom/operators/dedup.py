"""Deduplication: one rule for each type and domain, wildcards preferred, and none that a wildcard covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.schema import ALLOW, BLOCK, COMMENT, RULE_COLUMNS, TYPE_RANK

KINDS = list(TYPE_RANK)


def keys(rules: DataFrame) -> DataFrame:
    """(type, normalized_domain, pos, win, wildcard) for each block or allow key.

    pos is the ordinal of the key's first rule, its place in the result; win that of the surviving rule, the first
    wildcard or else the first. A hash aggregation over three narrow columns, partial before its shuffle, so a domain with
    a large share of all lines is one row a task.
    """
    wild = F.min(F.when(F.col("wildcard"), F.col("ordinal")))
    found = rules.where(F.col("type").isin(KINDS)).groupBy("type", "normalized_domain").agg(F.min("ordinal").alias("pos"), wild.alias("w"))
    return found.select("type", "normalized_domain", "pos", F.coalesce("w", "pos").alias("win"), F.col("w").isNotNull().alias("wildcard"))


def covered(found: DataFrame) -> DataFrame:
    """(type, normalized_domain) of the keys without wildcard that lie under a wildcard key of their type.

    A key's suffixes of as many labels as some wildcard has are looked up among the wildcards: equi-joins only, in place of
    a comparison of all pairs. Spark broadcasts the wildcards if their measured size allows and shuffles otherwise.
    """
    wildcards = found.where("wildcard").select("type", F.col("normalized_domain").alias("suffix"))
    # a subquery of one row; a suffix of more labels than a key has is the key, which is no wildcard
    labels = wildcards.agg(F.collect_set(F.size(F.split("suffix", r"\."))).alias("labels")).scalar()
    plain = found.where("NOT wildcard").select("type", "normalized_domain", labels.alias("labels"))
    looked = plain.select("type", "normalized_domain", F.explode(F.transform("labels", lambda n: F.call_function("substring_index", F.col("normalized_domain"), F.lit("."), -n))).alias("suffix"))
    return looked.join(wildcards, ["type", "suffix"], "left_semi").select("type", "normalized_domain").distinct()


def distinct_comments(rules: DataFrame) -> DataFrame:
    """(raw, ordinal): the first of each distinct text of rules that are neither block nor allow."""
    return rules.where(~F.col("type").isin(KINDS)).groupBy("raw").agg(F.min("ordinal").alias("ordinal"))


def _slots(rules: DataFrame) -> DataFrame:
    """Each rule as the only one of its slot: (kind, key, pos, rank, rule, n). Rules that are neither block nor allow have their text as key."""
    real = F.col("type").isin(KINDS)
    # a wildcard's rank is below any other's
    rank = F.when(real & F.col("wildcard"), F.col("ordinal").bitwiseOR(F.lit(-(1 << 63)))).otherwise(F.col("ordinal"))
    own = ("type", "normalized_domain")  # these are the key of a real rule
    rule = F.struct(*(F.when(~real, F.col(c)).alias(c) if c in own else F.col(c) for c in RULE_COLUMNS))
    return rules.select(F.when(real, F.col("type")).alias("kind"), F.when(real, F.col("normalized_domain")).otherwise(F.col("raw")).alias("key"), F.col("ordinal").alias("pos"), rank.alias("rank"), rule.alias("rule"), F.lit(1).cast("bigint").alias("n"))


def gathered(slots: DataFrame) -> DataFrame:
    """One row for each slot: its first place, its best rule, and how many rules it had. Slots that are gathered again, with others, give what all their rules give."""
    best = [F.min("pos").alias("pos"), F.min("rank").alias("rank"), F.min_by("rule", "rank").alias("rule"), F.sum("n").alias("n")]
    return slots.groupBy("kind", "key").agg(*best)


def survivors(rules: DataFrame) -> DataFrame:
    """(kind, key, pos, rank, rule, n): the first wildcard of each key, or else its first rule, and the first of each comment.

    The whole rule travels with its key, so this is one scan and one shuffle, and a key with a large share of all lines is
    one row a task.
    """
    return gathered(_slots(rules))


def deduplicate(rules: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The surviving rules, with type_rank and pos, by which a merged list is ordered.

    rules has RULE_COLUMNS. found are their survivors(), stored by the caller where there are many: coverage reads them too.
    """
    found = survivors(rules) if found is None else found
    of = found.where("kind IS NOT NULL").select(F.col("kind").alias("type"), F.col("key").alias("normalized_domain"), "rule.wildcard")
    gone = covered(of).select(F.col("type").alias("kind"), F.col("normalized_domain").alias("key"))
    rank = F.when(F.col("kind") == BLOCK, TYPE_RANK[BLOCK]).when(F.col("kind") == ALLOW, TYPE_RANK[ALLOW]).otherwise(len(TYPE_RANK))
    known = {"type": F.coalesce("kind", "rule.type").alias("type"), "normalized_domain": F.coalesce("rule.normalized_domain", "key").alias("normalized_domain")}
    return found.join(gone, ["kind", "key"], "left_anti").select(rank.alias("type_rank"), "pos", *(known[c] if c in known else F.col(f"rule.{c}") for c in RULE_COLUMNS))


def type_of_rank(rank: int) -> str:
    return {v: k for k, v in TYPE_RANK.items()}.get(rank, COMMENT)
