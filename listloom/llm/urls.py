"""URL filters: rules first, then empirical-Bayes reputation of hosts, in DataFrame operations only.

Labelled page outcomes (bad or not) are counted by host; without labels of their own, the pages of hosts that a rule
names are labelled, bad where the rules block them and good where they do not. A host's rate of bad pages has a beta prior around its registered
domain's rate, that one around its suffix's, and that one around the overall rate; the priors' strengths come from the
data, by moments, at each level. A host is blocked if its posterior mean less BOUND posterior standard deviations, below
which by Cantelli's inequality the rate lies with a chance of at most 1 / (1 + BOUND^2), is above LIMIT. Little evidence
thus allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listloom.functions import label_suffixes
from listloom.llm.common import shared_folder, stored

ALLOW, BLOCK = "allow", "block"
BOUND, LIMIT = 3.0, 0.5
#: Least and greatest strength of a prior, in pages.
STRENGTHS = (1.0, 1000.0)
#: Labels before a two-letter country that belong to its suffix, where no table of suffixes is given.
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]
#: So many rules are an expression over each url; more are a table that is joined by host.
MOST_RULES = 200
IP = r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$"


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both are empty for null or without "://"."""
    u = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    rest = F.when(F.contains(u, F.lit("://")), F.substr(u, F.instr(u, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def with_rules(base: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """base, which has host and path, with r, the longest rule (verdict, host, path) that fits as struct(rule, verdict), null if none, and named, whether a rule has its host or one above it.

    Of equally long rules the one that is greater as a text counts. Any number of rules: beyond MOST_RULES each distinct
    host gets the list of those that name it, by equi-joins on label suffixes, and pages only look into their host's list.
    """
    kind = "struct<rule:string,verdict:string>"
    if len(rules) <= MOST_RULES:
        found, named = F.lit(None).cast(kind), F.lit(False)
        for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
            on = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
            found = F.when(on & F.startswith("path", F.lit(path)), F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
            named = named | on
        return base.withColumn("r", found).withColumn("named", named)
    table = stored(base.sparkSession.createDataFrame([(host, len(host + path), host + path, path, verdict) for verdict, host, path in set(rules)], "above string, size int, rule string, path string, verdict string"))
    hosts = base.select("host").distinct().select("host", F.explode(label_suffixes("host")).alias("above"))
    listed = hosts.join(table, "above").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("size", "rule", "path", "verdict")), asc=False).alias("rules"))
    both = base.join(stored(listed), "host", "left").withColumn("named", F.col("rules").isNotNull())
    first = F.get(F.filter("rules", lambda x: F.startswith("path", x["path"])), F.lit(0))
    return both.withColumn("r", F.when(first.isNotNull(), F.struct(first["rule"].alias("rule"), first["verdict"].alias("verdict")))).drop("rules")


def host_name(host: str = "host") -> Column:
    """A host without user information and port, as the levels above it need it."""
    bare = F.regexp_replace(F.col(host), "^.*@", "")
    return F.when(F.startswith(bare, F.lit("[")), F.regexp_extract(bare, r"^(\[[^\]]*\]?)", 1)).otherwise(F.regexp_replace(bare, r":[^:]*$", ""))


def levels(host: str = "host") -> tuple[Column, Column]:
    """Registered domain and suffix of a host name, by SECOND_LEVEL. An IP address is both, whole."""
    name = host_name(host)
    parts = F.split(name, r"\.")
    long = (F.size(parts) >= 3) & (F.length(F.get(parts, F.size(parts) - 1)) == 2) & F.get(parts, F.size(parts) - 2).isin(SECOND_LEVEL)
    ip = name.rlike(IP)
    domain = F.when(ip, name).when(long, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return domain, F.when(ip, name).when(long, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))


def with_levels(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """hosts, a row for each host, with domain and suffix: by levels(), or by the longest suffix of the table suffixes (suffix) that the host ends in, by the last label without one."""
    if suffixes is None:
        domain, suffix = levels()
        return hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    name = host_name()
    tails = hosts.where(~name.rlike(IP)).select("host", F.posexplode(label_suffixes(name)).alias("_at", "suffix"))
    known = tails.join(suffixes.select("suffix").distinct(), "suffix").groupBy("host").agg(F.min("_at").alias("_at"))
    labels = F.split(name, r"\.")
    at = F.when(name.rlike(IP), 0).otherwise(F.coalesce("_at", F.size(labels) - 1))
    cut = lambda k: F.array_join(F.slice(labels, k + 1, F.size(labels)), ".")
    return hosts.join(known, "host", "left").withColumn("domain", cut(F.greatest(at - 1, F.lit(0)))).withColumn("suffix", cut(at)).drop("_at")


def reputation(outcomes: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """(host, n, bad, mean, bound) for every host of outcomes (host, bad): bad is 1, 0, or null for a page without label. suffixes: as for with_levels().

    Counts are aggregated before they are shuffled, so a host with a third of all pages is one row a task. Domains and
    suffixes are tables of counts too, joined as their size allows; only sums for the overall rate and the priors'
    strengths come to the driver.
    """
    folder = shared_folder(outcomes.sparkSession)
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("bad"))
    hosts = stored(with_levels(hosts, suffixes).select("host", "domain", "suffix", "n", "bad"), f"{folder}/hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)

    def strength(groups: DataFrame) -> float:
        spread = groups.where("n > 0").agg(F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("m"), F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2)).alias("v")).first()
        least, most = STRENGTHS
        return most if not spread["v"] else min(most, max(least, spread["m"] / spread["v"] - 1))

    def level(groups: DataFrame, name: str) -> tuple[DataFrame, float]:
        groups = stored(groups, f"{folder}/{name}")
        k = strength(groups)
        return groups.withColumn("mean", (F.col("bad") + k * F.col("prior")) / (F.col("n") + k)), k

    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    by_suffix, _ = level(hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall)), "suffixes")
    by_domain = hosts.groupBy("domain", "suffix").agg(*counts).join(by_suffix.select("suffix", F.col("mean").alias("prior")), "suffix")
    by_domain, _ = level(by_domain, "domains")
    by_host, k = level(hosts.join(by_domain.select("domain", F.col("mean").alias("prior")), "domain"), "reputation")
    mean, weight = F.col("mean"), F.col("n") + F.lit(k)
    return by_host.select("host", "n", "bad", "mean", (mean - BOUND * F.sqrt(mean * (1 - mean) / (weight + 1))).alias("bound"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url", outcomes: DataFrame | None = None, suffixes: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, host_pages, host_bad, host_rate, host_bound) of every row of pages.

    outcomes (url, bad) are labelled pages; None takes the pages of hosts that a rule names, bad if the rules block them
    and good if they allow them or say nothing of their path. host_pages and host_bad count the host's labelled and bad
    pages; host_rate and host_bound are its shrunk rate and the bound of its posterior, in parts per million. A null url
    has an empty host and path; such rows share one host. Of rules that fit, the longest counts. Repeated rows count and
    are judged each; other columns are left out.
    """
    host, path = host_and_path(url)
    base = with_rules(pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path")), rules)
    if outcomes is None:
        known = base.select("host", F.when(F.col("named"), F.coalesce(F.col("r.verdict") == BLOCK, F.lit(False)).cast("int")).alias("bad"))
    else:
        known = outcomes.select(host_and_path("url")[0].alias("host"), F.col("bad").cast("int").alias("bad")).unionByName(base.select("host", F.lit(None).cast("int").alias("bad")))
    million = lambda c: F.round(F.col(c) * 1_000_000).cast("bigint")
    by_host = reputation(known, suffixes).select("host", F.col("n").alias("host_pages"), F.col("bad").alias("host_bad"), million("mean").alias("host_rate"), million("bound").alias("host_bound"), F.when(F.col("bound") > LIMIT, BLOCK).otherwise(ALLOW).alias("by_host"))
    out = base.join(stored(by_host), "host", "left")
    return out.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", "by_host").alias("verdict"), "host_pages", "host_bad", "host_rate", "host_bound")


def keep_allowed(pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """The rows of pages whose verdict is allow, with the columns of pages."""
    row = pages.select(F.struct("*").alias("__row"), F.col(f"`{url}`").alias("__url"))
    return judge(row, rules, "__row", "__url").where(F.col("verdict") == ALLOW).select("page_id.*")
