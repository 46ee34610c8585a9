"""From lines to rules: one projection of built-in expressions, no Python in the data path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.functions import is_wildcard, normalize_domain, ordinal, strip
from listloom.schema import ALLOW, BLOCK, COMMENT, LINE_BREAK, WHITE_CLASS

#: Fixed patterns of the formats. A domain between the marks of a filter rule holds neither "/", "^" nor white space; here
#: that of ASCII, which is far faster to look for than all of it. A hosts file's name follows white space and holds none.
FILTER = r"^(?:@@)?\|\|([^/^\t-\r\x1c-\x20]+)\^"
ASCII_WHITE, ANY_WHITE = r"[\t-\r\x1c-\x20]", f"[{WHITE_CLASS}]"
LOCAL_IPS = ("0.0.0.0", "127.0.0.1")
#: Possessive, so that names of thousands of labels do not exhaust the matcher's stack.
PLAIN = r"^(?:[a-zA-Z0-9][-a-zA-Z0-9]*+\.)++[a-zA-Z]{2,}$"
COSMETIC = r"^#@?#"
LOCAL = ["localhost", "localhost.localdomain"]
#: Which formats a profile reads: all, or only filter rules and comments.
PROFILES = ("full", "filters")


def split_lines(contents: DataFrame) -> DataFrame:
    """Lines (source_idx, source, line_no, line) of whole texts (source_idx, source, content); a null content has none.

    A final line break ends the last line and begins no other. Lines of a long text leave their task through the next
    shuffle; repartition() before expensive work that has none.
    """
    parts = F.split("content", LINE_BREAK)
    lines = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return contents.select("source_idx", "source", F.posexplode(lines).alias("line_no", "line")).withColumn("line_no", F.col("line_no").cast("bigint"))


def _wide_white(c: Column) -> Column:
    """Whether there is white space beyond ASCII."""
    return (F.octet_length(c) != F.length(c)) & c.rlike(ANY_WHITE)


def classify(lines: DataFrame, keep_unsupported: bool = False, profile: str = "full") -> DataFrame:
    """Rules (raw, domain, type, wildcard, source, normalized_domain, ordinal, fmt) of lines; other lines drop out.

    Formats are tried in a fixed order and the first that fits decides: comment, cosmetic (dropped, or kept as a comment
    with keep_unsupported), allow, block, hosts file (its local names end the search without a rule), plain domain. fmt
    names the format. Profile "filters" reads comments, allow and block only.
    """
    if profile not in PROFILES:
        raise ValueError(f"profile is one of {', '.join(PROFILES)}")
    c = F.col("c")
    base = lines.select("source", ordinal("source_idx", "line_no").alias("ordinal"), strip("line").alias("c"))  # an empty line fits no format
    marked = F.startswith(c, F.lit("||")) | F.startswith(c, F.lit("@@||"))
    base = base.withColumn("f", F.when(marked, F.regexp_extract(c, FILTER, 1)).otherwise(""))
    base = base.withColumn("filter", F.when(_wide_white(F.col("f")), "").otherwise(F.col("f")))
    if profile == "full":  # what follows the address, and the name in it
        rest = F.when(F.startswith(c, F.lit(LOCAL_IPS[0])), F.substring(c, len(LOCAL_IPS[0]) + 1, 1 << 30)).when(F.startswith(c, F.lit(LOCAL_IPS[1])), F.substring(c, len(LOCAL_IPS[1]) + 1, 1 << 30))
        base = base.withColumn("rest", rest).withColumn("name", strip("rest"))
        name = F.col("name")
        one = (name != F.col("rest")) & ~name.rlike(ASCII_WHITE) & ~_wide_white(name)
        base = base.withColumn("host", F.when(name.isNotNull() & one, name))

    def rule(kind: str, fmt: str, domain, raw=c):
        return F.struct(raw.alias("raw"), domain.alias("domain"), F.lit(kind).alias("type"), (is_wildcard(domain) if fmt != "plain" else F.lit(False)).alias("wildcard"), F.lit(fmt).alias("fmt"))

    none = F.lit(None)
    out = F.when(F.startswith(c, F.lit("!")), rule(COMMENT, "comment", F.lit("")))
    if profile == "full":
        out = out.when(F.startswith(c, F.lit("#")) & c.rlike(COSMETIC), rule(COMMENT, "cosmetic", F.lit("")) if keep_unsupported else none)
    out = out.when((F.col("filter") != "") & F.startswith(c, F.lit("@@")), rule(ALLOW, "allow", F.col("filter")))
    out = out.when(F.col("filter") != "", rule(BLOCK, "block", F.col("filter")))
    if profile == "full":
        host = F.col("host")
        out = out.when(host.isNotNull(), F.when(~F.lower(host).isin(LOCAL), rule(BLOCK, "hosts", host)))
        out = out.when(c.rlike(PLAIN), rule(BLOCK, "plain", F.lower(c), F.concat(F.lit("||"), F.lower(c), F.lit("^"))))
    # explode(array(x)) is x, computed once, where a projection would be repeated for each field
    rules = base.select("source", "ordinal", F.explode(F.array(out)).alias("r")).where("r IS NOT NULL")
    return rules.select("r.raw", "r.domain", "r.type", "r.wildcard", "source", normalize_domain("r.domain").alias("normalized_domain"), "ordinal", "r.fmt")
