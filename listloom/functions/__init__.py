"""Scalar functions as column expressions, which fuse into generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listloom.schema import LINE_BITS, WHITE_SPACE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(line: Column | str) -> Column:
    """The line without white space at its ends."""
    return F.btrim(_col(line), F.lit(WHITE_SPACE))


def is_wildcard(domain: Column | str) -> Column:
    return F.startswith(_col(domain), F.lit("*."))


def normalize_domain(domain: Column | str) -> Column:
    """Lower case, without one leading "*."."""
    low = F.lower(_col(domain))
    return F.when(is_wildcard(low), F.substring(low, 3, 1 << 30)).otherwise(low)


def label_suffixes(domain: Column | str) -> Column:
    """Every suffix of whole labels, the domain itself first."""
    labels = F.split(_col(domain), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def same_rule(domain: Column, kind: Column, other_domain: Column, other_kind: Column) -> Column:
    """Two rules are equal if their normalized domains and types are."""
    return (domain == other_domain) & (kind == other_kind)


def is_subdomain(domain: Column, kind: Column, other: Column, other_kind: Column, other_wildcard: Column) -> Column:
    """A block or allow rule lies under a wildcard block or allow rule, whatever their types: equal, or below a label."""
    real = kind.isin("block", "allow") & other_kind.isin("block", "allow")
    return real & other_wildcard & ((domain == other) | F.endswith(domain, F.concat(F.lit("."), other)))


def ordinal(source_idx: Column | str, line_no: Column | str) -> Column:
    """One number in the order of sources and lines. A line number beyond its bits is an error, not another source's."""
    line = _col(line_no).cast("bigint")
    place = F.shiftleft(_col(source_idx).cast("bigint"), LINE_BITS).bitwiseOR(line)
    return F.when(line >= 1 << LINE_BITS, F.raise_error(F.lit(f"a line number is at most {(1 << LINE_BITS) - 1}")).cast("bigint")).otherwise(place)


def shortened(label: Column | str) -> Column:
    """A label of 50 characters or more, cut to 47 and three dots."""
    c = _col(label)
    return F.when(F.length(c) < 50, c).otherwise(F.concat(F.substring(c, 1, 47), F.lit("...")))


def percentage(count: Column | str, total: Column | str) -> Column:
    """count of total in per cent; 0 of nothing."""
    return F.when(_col(total) > 0, _col(count) / _col(total) * 100).otherwise(F.lit(0.0))


def reduction(before: Column | str, after: Column | str) -> Column:
    """By how many per cent after is less than before; 0 of nothing."""
    return F.when(_col(before) > 0, (F.lit(1) - _col(after) / _col(before)) * 100).otherwise(F.lit(0.0))


def bar(percent: Column | str) -> Column:
    """A block character for each full five per cent."""
    return F.repeat(F.lit("█"), F.floor(_col(percent) / 5).cast("int"))


def capitalized(word: Column | str) -> Column:
    return F.concat(F.upper(F.substring(_col(word), 1, 1)), F.lower(F.substring(_col(word), 2, 1 << 30)))
