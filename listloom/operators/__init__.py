"""The dataflow operators: classify, deduplicate, relate, and count rules."""

from listloom.operators.classify import classify, split_lines
from listloom.operators.dedup import covered, deduplicate, distinct_comments, gathered, keys, survivors
from listloom.operators.relations import conflict_domains, conflicts, equivalent_pairs, subdomain_pairs
from listloom.operators.stats import distribution, summary, top

__all__ = [
    "classify", "conflict_domains", "conflicts", "covered", "deduplicate", "distinct_comments", "distribution",
    "equivalent_pairs", "gathered", "keys", "split_lines", "subdomain_pairs", "summary", "survivors", "top",
]
