"""Quality rules with risk-controlled thresholds.

Every rule rejects a document whose value, a whole number per thousand, is above a cutoff. Cutoffs come from labelled
documents and not from taste: in each stratum (language), the cutoffs are tried from the most lenient to the strictest,
each for all rules at once, and a cutoff stands only while the exact binomial test rejects the hypothesis that the rules
together throw out more than the allowed share of good documents. Copies are no independent draws, so a distinct text
counts once in its stratum. The error level is divided over the strata (Bonferroni; along the cutoffs the fixed order
needs no further correction). Strata with too few labels to certify anything share the cutoff of one pooled stratum; if
all labels together are too few, nothing is rejected. The guarantee is about good documents that pass the base rules.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.llm.common import map_texts, ship, stored

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\r\x0b\f"
#: Base rule: fewer words, or a larger percentage of words in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Share of a stratum's good documents that the method may reject, and the chance that this fails anywhere.
RISK, DELTA = 0.02, 0.05
#: Rules by name, as the value per thousand that a document has.
RULES = {
    "symbols": ("n_symbols", "n_words"),
    "repeated_words": ("n_repeat_words", "n_words"),
    "repeated_lines": ("n_dup_lines", "n_lines"),
    "exclamations": ("n_exclaim", "n_words"),
    "capitals": ("n_upper", "n_letters"),
}
#: Cutoffs per thousand, from lenient to strict.
CUTOFFS = (4000, 3000, 2500, 2000, 1500, 1250, 1000, 900, 800, 700, 600, 500, 450, 400, 350, 300, 250, 200, 150, 100)
FEATURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_exclaim bigint, n_upper bigint, n_letters bigint"
_POWERS = [pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in a window of so many words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.uint64, len(words))
    if len(seen) == len(words):
        return 0
    mixed = (ids + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    rolled = np.zeros(n, np.uint64)
    for k, power in enumerate(_POWERS[:window]):
        rolled += mixed[k : n + k] * np.uint64(power)
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    maybe = np.zeros(n, bool)
    maybe[order[1:][same]] = maybe[order[:-1][same]] = True
    places: dict[bytes, list[int]] = {}
    for i in np.flatnonzero(maybe).tolist():  # equal sums are checked: only equal windows count
        places.setdefault(ids[i : i + window].tobytes(), []).append(i)
    edges = np.zeros(len(words) + 1, np.int64)
    for at in places.values():
        if len(at) > 1:
            edges[at] += 1
            edges[np.asarray(at) + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measures(text: str) -> tuple[int, ...]:
    """FEATURES of a whole text. Words are runs of characters other than ASCII white space."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    letters = sum(map(str.isalpha, text)) if upper else 1
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        text.count("!"),
        upper,
        letters,
    )


def measured(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep and FEATURES of every row; a null text has no words."""

    def rows() -> Callable[[list], list[tuple]]:
        return lambda texts: [measures(x or "") for x in texts]

    return map_texts(df, text, keep, FEATURES, rows)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def worst() -> Column:
    """A document's greatest value over all rules: some rule rejects it at a cutoff if this is above it."""
    return F.greatest(*map(value, RULES))


def value(rule: str) -> Column:
    """A document's value for a rule, per thousand."""
    part, whole = RULES[rule]
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * 1000 / F.col(whole))).otherwise(0).cast("bigint")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exactly, term by term in logarithms."""
    if k >= n:
        return 1.0
    at = lambda i: math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    return min(1.0, math.fsum(map(at, range(k + 1))))


def certified(rejected: list[int], n: int, share: float, level: float) -> int | None:
    """The last cutoff's index, in their order, up to which the test rejects "more than share of the good are thrown out"; none: None."""
    last = None
    for i, k in enumerate(rejected):
        if k > share * n or binomial_tail(k, n, share) > level:
            break
        last = i
    return last


def enough(n: int, risk: float, level: float) -> bool:
    """Whether so many good texts certify something, if none of them is rejected."""
    return (1 - risk) ** n <= level


def last_cutoff(bins: list[int], risk: float, level: float) -> int | None:
    """The index of the last cutoff that stands for good texts counted by how many cutoffs they pass."""
    return certified([sum(bins[: i + 1]) for i in range(len(CUTOFFS))], sum(bins), risk, level)


def pooled(small: list[int] | None, everything: list[int], own: list[int | None], risk: float, level: float) -> int | None:
    """The pooled stratum's cutoff index, from the bins of the strata too small for one, of all strata, and the others' cutoffs."""
    if small is not None:
        return last_cutoff(small if enough(sum(small), risk, level) else everything, risk, level)
    # at the most lenient of the cutoffs, no stratum loses more than its share, and so no mixture of them
    return None if None in own else min(own, default=None)


def joint(counts: dict[str | None, list[int]], risk: float = RISK, delta: float = DELTA) -> dict[str | None, int | None]:
    """Each stratum's cutoff, None for none, from its good texts by how many cutoffs they pass under every rule.

    The key None is the pooled stratum, for all strata that are no key: those too small for zero rejected texts to
    certify anything, and those without labels. Its labels are the small strata's or, if these too are too few, all.
    """
    level = delta / max(1, len(counts))  # the pool takes the place of at least one stratum, so there are no more tests
    found = {name: last_cutoff(bins, risk, level) for name, bins in counts.items() if name is not None and enough(sum(bins), risk, level)}
    added = lambda rows: [sum(x) for x in zip(*rows, strict=True)] or [0] * (len(CUTOFFS) + 1)
    small = [bins for name, bins in counts.items() if name not in found]
    found[None] = pooled(added(small) if small else None, added(counts.values()), list(found.values()), risk, level)
    return {name: None if i is None else CUTOFFS[i] for name, i in found.items()}


def calibrate(labelled: DataFrame, risk: float = RISK, delta: float = DELTA) -> tuple[DataFrame, int | None]:
    """joint() on the cluster, for any number of strata: a stored table (__s, __cutoff), and the pooled stratum's cutoff.

    labelled: (s, v), a row for each good text that passes the base rules, v its worst value. To the driver come single
    rows of sums.
    """
    spark = labelled.sparkSession
    n_bins = len(CUTOFFS) + 1
    # bin b passes the first b cutoffs and no other
    cell = labelled.select("s", sum((F.col("v") <= c).cast("int") for c in CUTOFFS).alias("bin"))
    sums = [F.coalesce(F.sum((F.col("bin") == b).cast("bigint")), F.lit(0)).alias(f"b{b}") for b in range(n_bins)]
    counts = stored(cell.groupBy("s").agg(*sums).select("s", F.array(*[f"b{b}" for b in range(n_bins)]).alias("bins")))
    level = delta / max(1, counts.count())
    least = next(n for n in itertools.count() if enough(n, risk, level)) if 0 < risk < 1 else 0
    total = F.aggregate("bins", F.lit(0).cast("bigint"), lambda a, x: a + x)
    own = F.col("s").isNotNull() & (total >= least)
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [last_cutoff(bins, risk, level) for bins in batch.column(1).to_pylist()]
            cutoffs = pa.array([None if i is None else CUTOFFS[i] for i in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), cutoffs], ["__s", "__cutoff"])

    cutoffs = stored(counts.where(own).mapInArrow(run, "__s string, __cutoff bigint"))
    each = [F.coalesce(F.sum(F.col("bins")[b]), F.lit(0)) for b in range(n_bins)]
    small, everything = counts.where(~own).agg(F.count("*"), *each).first(), counts.agg(*each).first()
    some = cutoffs.agg(F.count("*").alias("n"), F.count("__cutoff").alias("known"), F.max("__cutoff").alias("most")).first()
    known = [] if not some["n"] else [None] if some["known"] < some["n"] else [CUTOFFS.index(some["most"])]
    pool = pooled(list(small)[1:] if small[0] else None, list(everything), known, risk, level)
    return cutoffs, None if pool is None else CUTOFFS[pool]


def judged(features: DataFrame, labels: DataFrame, stratum: str = "lang", doc_id: str = "doc_id", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """features, with __h for a hash of the text, with base_failed and kept. labels: (doc_id, quality); a text is good if no label of its documents is 0 and one is 1."""
    known = labels.where("quality IS NOT NULL").groupBy(F.col(doc_id).alias("__id")).agg(F.min("quality").alias("__q"))
    labelled = features.where(~base_failed()).join(known, features[doc_id] == F.col("__id"))
    texts = labelled.groupBy(F.col(stratum).cast("string").alias("s"), "__h").agg(F.min("__q").alias("q"), F.first(worst()).alias("v")).where("q = 1")
    cutoffs, pool = calibrate(texts.select("s", "v"), risk, delta)
    both = features.join(cutoffs, F.col(stratum).cast("string") == F.col("__s"), "left")
    rejected = F.coalesce(worst() > F.when(F.col("__s").isNull(), F.lit(pool).cast("bigint")).otherwise(F.col("__cutoff")), F.lit(False))
    return both.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & ~rejected).drop("__s", "__cutoff", "__h")


def quality_rules(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(doc_id, stratum, FEATURES, base_failed, kept) of every row of docs.

    Null and empty texts have no words and fail the base rules. A null stratum is pooled with the small and the unlabelled
    ones. Repeated rows give repeated results and count once among the labelled; labels of a doc_id, and of a text, are
    combined; rows without labels, and empty tables, calibrate nothing.
    """
    features = stored(measured(docs.withColumn("__h", F.xxhash64(F.col(f"`{text}`"))), [doc_id, stratum, "__h"], text))
    return judged(features, labels, stratum, doc_id, risk, delta)


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """The rows of docs that quality_rules() keeps, with the columns of docs, measured in one pass."""
    whole = docs.select(F.col(f"`{doc_id}`").alias("__doc"), F.col(f"`{stratum}`").alias("__stratum"), F.col(f"`{text}`").alias("__text"), F.xxhash64(F.col(f"`{text}`")).alias("__h"), F.struct("*").alias("__row"))
    features = stored(measured(whole, ["__doc", "__stratum", "__h", "__row"], "__text"))
    named = labels.select(F.col(doc_id).alias("__doc"), "quality")
    return judged(features, named, "__stratum", "__doc").where("kept").select("__row.*")
