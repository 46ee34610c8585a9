"""The queries of the library's own operators, over rule lines derived from the test tables, and their SQL for DuckDB."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from contextlib import ExitStack, redirect_stdout
from io import StringIO
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom import operators as op
from listloom.engine import Engine, Rule, report
from listloom.functions import bar, capitalized, percentage, same_rule, shortened
from listloom.operators.stats import type_distribution as types
from listloom.plans.merge import merge, merge_lines
from listloom.plans.report import Report
from listloom.plans.sink import numbered, report_path, write_rules
from listloom.sources.config import enabled_sources, sources_frame
from listloom.sources.lists import fetch, read_contents, read_lines, readable
from listloom.storage import shared_folder, stored

CONFIG = str(Path(__file__).resolve().parents[1] / "config" / "example_sources.yaml")

_HOST = "regexp_extract(url,'^[a-z]+://([^/?#]+)',1)"
_BASE = "regexp_replace(host,'^(blog|m|www)[.]','')"
#: A rule line of every format, in turn, for each page. The expression is the same in Spark and DuckDB.
_LINE = """CASE page_id % 11
  WHEN 0 THEN concat('||',host,'^')            WHEN 1 THEN concat('||*.',base,'^')
  WHEN 2 THEN concat('@@||',host,'^')          WHEN 3 THEN concat('0.0.0.0 ',host)
  WHEN 4 THEN upper(host)                      WHEN 5 THEN concat('  127.0.0.1   ',upper(host),'  ')
  WHEN 6 THEN concat('! list ',cast(page_id % 5 AS varchar(10)))
  WHEN 7 THEN concat('@@||*.',base,'^')        WHEN 8 THEN concat('||',host,'^$third-party')
  WHEN 9 THEN concat('##.',host)               ELSE concat('||',host,'/path^') END"""
_SOURCE = "concat('feed_', cast(page_id % 4 AS varchar(10)))"
_BULK = """CASE WHEN l_suppkey % 20 = 0 AND l_partkey % 97 = 0
 THEN concat('||*.s',cast(l_suppkey AS varchar(20)),'.example.com^')
 ELSE concat('||p',cast(l_partkey AS varchar(20)),'.s',cast(l_suppkey AS varchar(20)),'.example.com^') END"""


_PLACE = "l_orderkey * 8 + l_linenumber"


def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id", f"{_HOST} AS host").selectExpr("page_id", "host", f"{_BASE} AS base")
    return pages.selectExpr("0 AS source_idx", f"{_SOURCE} AS source", "page_id AS line_no", f"{_LINE} AS line")


def bulk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule lines of lineitem, in the order of orders. The table may be one row group, so lines are dealt out before work."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_suppkey", "l_partkey", f"{_PLACE} AS line_no")
    dealt = rows.repartition(spark.sparkContext.defaultParallelism, "l_orderkey")
    return dealt.selectExpr("0 AS source_idx", "'bulk' AS source", "line_no", f"{_BULK} AS line")


def _rules(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return op.classify(rule_lines(spark, sf_dir), **how)


def classify_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir)


def classify_format_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).groupBy("fmt").agg(F.count("*").alias("n"))


def classify_keep_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir, keep_unsupported=True).select("ordinal", "type", "fmt", "raw")


def classify_filters_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir, profile="filters").select("ordinal", "type", "domain", "wildcard")


def split_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose lines end in every way that a line can end."""
    texts = rule_lines(spark, sf_dir).select(F.col("line_no").cast("int").alias("source_idx"), "source", F.concat("line", F.lit("\u000b"), F.upper("line"), F.lit("\r\n"), "source", F.lit("\u0085"), F.lit(" "), "line", F.lit("\n")).alias("content"))
    return op.split_lines(texts)


def normalize_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).select("ordinal", "domain", "normalized_domain")


def dedup_exact_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).where("type <> 'comment'").groupBy("type", "normalized_domain").agg(F.count("*").alias("n"))


def dedup_wildcard_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keys(_rules(spark, sf_dir))


def comment_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_comments(_rules(spark, sf_dir))


def coverage_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.covered(op.keys(_rules(spark, sf_dir)))


def _kept(rules: DataFrame) -> DataFrame:
    found = stored(op.keys(rules))
    return found.join(op.covered(found), ["type", "normalized_domain"], "left_anti").select("type", "normalized_domain", "wildcard")


def coverage_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(_rules(spark, sf_dir))


def merge_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_lines(rule_lines(spark, sf_dir)).rules


def merge_rendered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(merge_rules(spark, sf_dir)).select("out_pos", "raw")


def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_lines(rule_lines(spark, sf_dir)).summary()


def conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicts among merged rules, the rules of each side joined in order."""
    found = op.conflicts(merge_rules(spark, sf_dir))
    return found.select("domain", F.array_join("block_rules.raw", " ").alias("block_rules"), F.array_join("allow_rules.raw", " ").alias("allow_rules"))


def conflicts_before_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.conflict_domains(_rules(spark, sf_dir))


def conflict_domains_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _rules(spark, sf_dir)
    side = lambda kind: rules.where(F.col("type") == kind).select(F.col("normalized_domain").alias("domain"))
    return side("block").intersect(side("allow"))


def equivalent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.equivalent_pairs(_rules(spark, sf_dir).where("type <> 'comment'"))


def subdomain_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.subdomain_pairs(_rules(spark, sf_dir))


def source_distribution_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top(_rules(spark, sf_dir), "source").select("source", F.col("count").alias("n"), "first")


def top_domains_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.top(_rules(spark, sf_dir), "domain").select("domain", F.col("count").alias("n"), "first")


def type_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return types(merge_rules(spark, sf_dir)).select("type", F.col("count").alias("n"), "percent", "bar")


def source_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source's rules and their share among those of its type."""
    rules = _rules(spark, sf_dir)
    by = rules.groupBy("source", "type").agg(F.count("*").alias("n"))
    total = rules.groupBy("type").agg(F.count("*").alias("total"))
    shares = by.join(total, "type").withColumn("percent", percentage("n", "total"))
    return shares.select("source", "type", "n", "percent", F.length(bar("percent")).cast("bigint").alias("bar_cells"))


def sources_enabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enabled_sources(sources_frame(spark, CONFIG))


def merge_duplicate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a merge that names one source twice: read each time it is named, or once."""
    lines = rule_lines(spark, sf_dir)
    again = lines.where("source = 'feed_0'").withColumn("source_idx", F.lit(1))
    twice, once = merge_lines(lines.unionByName(again)), merge_lines(lines)
    rows = [m.summary().select(F.lit(name).alias("mode"), "total_before", "total_after") for name, m in (("concurrent", twice), ("sequential", once))]
    return rows[0].unionByName(rows[1])


def bulk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.keys(op.classify(bulk_lines(spark, sf_dir)))


def bulk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged rules themselves: which line of each key survives, and its place."""
    return merge_lines(bulk_lines(spark, sf_dir)).rules


def bulk_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(op.classify(bulk_lines(spark, sf_dir)))


def bulk_merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_lines(bulk_lines(spark, sf_dir)).summary()


def truncate_source_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rule_lines(spark, sf_dir)
    return lines.select("line_no", shortened(F.concat("source", F.lit("/"), "line", F.lit("/"), "line")).alias("label"))


# --- files, urls, reports: what the library does on the driver, as rows ------------------------------------------------


def _files(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The rule lines of each feed in a file of the driver, and a file that is no UTF-8; paths by name."""
    folder = Path(urlsplit(shared_folder(spark)).path)
    folder.mkdir(parents=True)
    out = {"broken": str(folder / "broken")}
    (folder / "broken").write_bytes(b"||a.com^\n\xff\n")
    with ExitStack() as files:
        opened = {}
        for row in rule_lines(spark, sf_dir).orderBy("source", "line_no").toLocalIterator():
            if (name := row["source"]) not in opened:
                out[name] = str(folder / name)
                opened[name] = files.enter_context(open(out[name], "w", encoding="utf-8"))
            opened[name].write(row["line"] + "\n")
    return out


def _named(df: DataFrame) -> DataFrame:
    """df with sources by the names of their files."""
    return df.withColumn("source", F.substring_index("source", "/", -1))


def _numbered(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(lines)), "n bigint, line string")


def fetch_one_by_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _files(spark, sf_dir)
    rows = []
    for name in sorted(files):
        try:
            rows.append((name, hashlib.sha256(fetch(files[name]).encode()).hexdigest()))
        except ValueError:  # UnicodeDecodeError is one
            rows.append((name, None))
    return spark.createDataFrame(rows, "source string, sha256 string")


def fetch_concurrently(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of which one is missing, one is broken, and one is named twice and read once."""
    files = _files(spark, sf_dir)
    read = read_contents(spark, [*files.values(), files["feed_0"], files["feed_0"] + "-missing"])
    return _named(read).select("source", F.sha2("content", 256).alias("sha256"), F.length("content").cast("bigint").alias("n_chars"), F.col("error").isNotNull().alias("failed"))


def fetch_and_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of files, where failed ones have none and one that is named twice counts twice."""
    files = _files(spark, sf_dir)
    read = readable(stored(read_lines(spark, [files["feed_1"], files["broken"], files["feed_0"], files["feed_1"]], max_workers=2)))
    return _named(op.classify(read)).select("source", "raw", "domain", "type", "wildcard", (F.col("ordinal") / (1 << 40)).cast("int").alias("source_idx"))


def engine_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engine.merge() of all feeds, as a list of rules."""
    files = _files(spark, sf_dir)
    rules = Engine(spark, timeout=5, max_workers=2).merge([files[f"feed_{k}"] for k in range(4)])
    return _numbered(spark, [str(r) for r in rules])


def merge_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a merge with a missing source and one named twice, concurrent and not."""
    files = _files(spark, sf_dir)
    sources, rows = [files["feed_0"], files["feed_1"], files["feed_0"], files["feed_1"] + "-missing"], []
    for mode in (True, False):
        found = merge(spark, sources, detect_conflicts=True, concurrent=mode)
        s = found.stats
        rows.append((mode, s["sources_processed"], s["sources_total"], s["sources_succeeded"], s["total_before"], s["total_after"], s["conflict_count"], s["elapsed_time"] > 0))
        found.release()
    return spark.createDataFrame(rows, "concurrent boolean, processed int, total int, succeeded int, total_before bigint, total_after bigint, conflict_count bigint, timed boolean")


def parse_text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of whole texts, one a feed."""
    texts = rule_lines(spark, sf_dir).groupBy("source").agg(F.array_join(F.sort_array(F.collect_list(F.struct("line_no", "line")))["line"], "\r\n").alias("content"))
    return op.classify(op.split_lines(texts.withColumn("source_idx", F.substring("source", 6, 9).cast("int")))).select("source", "raw", "type", "ordinal")


def written_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a written list, without its time of writing."""
    found = merge_lines(rule_lines(spark, sf_dir))
    stats = found.summary().first().asDict() | {"sources_processed": 4, "sources_total": 4, "elapsed_time": 1.5, "conflict_count": 2}
    path = Path(_files(spark, sf_dir)["broken"]).with_name("merged.txt")
    write_rules(found.rules, str(path), stats)
    return _numbered(spark, [x for x in path.read_text(encoding="utf-8").splitlines() if not x.startswith("! Generated")])


def _report(spark: SparkSession, sf_dir: str) -> Report:
    found = merge_lines(rule_lines(spark, sf_dir))
    return Report(found.rules, found.summary().first().asDict() | {"sources_processed": 3, "sources_total": 4, "elapsed_time": 1.5, "conflict_count": 2})


def report_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a Markdown report, saved and read again, without its time."""
    path = Path(_files(spark, sf_dir)["broken"]).with_name("merged.txt")
    _report(spark, sf_dir).save(report_path(str(path), "md"))
    return _numbered(spark, [x for x in path.with_name("merged.report.md").read_text(encoding="utf-8").splitlines() if x and not x.startswith("**Generated")])


def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, [x for x in _report(spark, sf_dir).text().splitlines() if x and not x.startswith("Generated")])


def report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of a JSON report."""
    made = _report(spark, sf_dir).json()
    rows = [("summary", k, float(v)) for k, v in made["summary"].items()]
    rows += [(by, k, float(v)) for by, counts in made["distributions"].items() for k, v in counts.items()]
    return spark.createDataFrame(rows, "part string, name string, value double")


def report_of_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type in a report on a plain list of rules."""
    rules = [Rule(*r) for r in _rules(spark, sf_dir).orderBy("ordinal").select("raw", "domain", "type", "wildcard", "source").toLocalIterator()]
    made = report(spark, rules).json()
    return spark.createDataFrame(list(made["distributions"]["by_type"].items()), "type string, n bigint")


def command_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the command line prints first and writes, and its exit code; a configuration that is missing exits with 1."""
    from listloom.cli import main

    files = _files(spark, sf_dir)
    out = Path(files["broken"]).with_name("deep") / "out.txt"
    said = StringIO()
    with redirect_stdout(said):
        codes = [main(["-s", *(files[f"feed_{k}"] for k in range(4)), "-o", str(out), "--report", "--report-format", "json"]), main(["-c", str(out) + "-missing", "-q"])]
    first = said.getvalue().splitlines()[0].rpartition(" of ")[0]
    return _numbered(spark, [*map(str, codes), first, str(out.with_name("out.report.json").exists()), *(x for x in out.read_text(encoding="utf-8").splitlines() if not x.startswith("!"))])


def argument_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from listloom.cli import arguments

    named = arguments().parse_args(["-s", "a.txt", "https://lists.example.com/b.txt", "--max-workers", "3"])
    return spark.createDataFrame([(i, s, named.timeout, named.max_workers) for i, s in enumerate(named.sources)], "n int, source string, timeout int, max_workers int")


def test_sources_enabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enabled_sources(sources_frame(spark, CONFIG), "test_sources")


def rule_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule beside the first one of its domain: whether they are the same rule, and its text."""
    rules = _rules(spark, sf_dir)
    first = rules.groupBy(F.col("normalized_domain").alias("nd")).agg(F.min_by("type", "ordinal").alias("first_type"))
    both = rules.join(first, rules.normalized_domain == first.nd)
    same = same_rule(F.col("normalized_domain"), F.col("type"), F.col("nd"), F.col("first_type"))
    return both.select("ordinal", same.alias("same"), F.col("raw").alias("text"))


def capitalized_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rules(spark, sf_dir).select(F.upper("type").alias("type")).distinct().select(capitalized("type").alias("name"))


_QUERIES = [
    classify_lines, classify_format_counts, classify_keep_unsupported, classify_filters_only, split_content, normalize_domain,
    dedup_exact_keys, dedup_wildcard_preference, comment_dedup, coverage_removed, coverage_kept, merge_rules, merge_rendered_lines,
    merge_stats, conflicts, conflicts_before_dedup, conflict_domains_intersect, equivalent_pairs, subdomain_pairs,
    source_distribution_top10, top_domains_top10, type_distribution, source_shares, sources_enabled, merge_duplicate_sources,
    bulk_dedup, bulk_coverage, bulk_merge, bulk_merge_stats, truncate_source_label, fetch_one_by_one, fetch_concurrently, fetch_and_parse,
    engine_merge, merge_source_counts, parse_text_rules, written_list, report_markdown, report_text, report_json, report_of_list,
    command_line, argument_sources, test_sources_enabled, rule_identity, capitalized_types,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


# --- SQL ---------------------------------------------------------------------------------------------------------------

_LINES_SQL = f"p AS (SELECT page_id, {_HOST} AS host FROM pages), b AS (SELECT page_id, host, {_BASE} AS base FROM p), lines AS (SELECT page_id AS line_no, {_SOURCE} AS source, {_LINE} AS line FROM b)"


def _classified(lines: str, name: str = "rules", keep: bool = False, filters: bool = False, where: str = "true") -> str:
    """CTEs that end in the rules of table lines."""
    rest = "" if filters else " WHEN h <> '' THEN CASE WHEN lower(h) NOT IN ('localhost', 'localhost.localdomain') THEN 'hosts' END WHEN pl THEN 'plain'"
    cosmetic = "" if filters else f" WHEN regexp_matches(c, '^#@?#') THEN {repr('cosmetic') if keep else 'NULL'}"
    return rf"""
{name}_c AS (SELECT line_no, source, trim(line) AS c FROM {lines} WHERE {where}),
{name}_x AS (SELECT *, regexp_extract(c, '^@@\|\|([^/^\s]+)\^', 1) AS a, regexp_extract(c, '^\|\|([^/^\s]+)\^', 1) AS b,
  regexp_extract(c, '^(?:0\.0\.0\.0|127\.0\.0\.1)\s+(\S+)$', 1) AS h, regexp_matches(c, '^([a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{{2,}}$') AS pl FROM {name}_c WHERE c <> ''),
{name}_f AS (SELECT *, CASE WHEN starts_with(c, '!') THEN 'comment'{cosmetic} WHEN a <> '' THEN 'allow' WHEN b <> '' THEN 'block'{rest} END AS fmt FROM {name}_x),
{name}_d AS (SELECT *, CASE fmt WHEN 'allow' THEN a WHEN 'block' THEN b WHEN 'hosts' THEN h WHEN 'plain' THEN lower(c) ELSE '' END AS domain FROM {name}_f WHERE fmt IS NOT NULL),
{name} AS (SELECT CASE WHEN fmt = 'plain' THEN '||' || domain || '^' ELSE c END AS raw, domain,
  CASE WHEN fmt IN ('comment', 'cosmetic') THEN 'comment' WHEN fmt = 'allow' THEN 'allow' ELSE 'block' END AS type,
  fmt <> 'plain' AND starts_with(domain, '*.') AS wildcard, source, regexp_replace(lower(domain), '^\*\.', '') AS normalized_domain,
  CAST(line_no AS BIGINT) AS ordinal, fmt FROM {name}_d)"""


def _deduplicated(rules: str = "rules") -> str:
    return f"""
keys AS (SELECT type, normalized_domain, min(ordinal) AS pos, coalesce(min(ordinal) FILTER (wildcard), min(ordinal)) AS win, bool_or(wildcard) AS wildcard
  FROM {rules} WHERE type <> 'comment' GROUP BY ALL),
covered AS (SELECT type, normalized_domain FROM keys k WHERE NOT wildcard AND EXISTS (SELECT 1 FROM keys w WHERE w.wildcard AND w.type = k.type
  AND (w.normalized_domain = k.normalized_domain OR ends_with(k.normalized_domain, '.' || w.normalized_domain)))),
kept AS (SELECT * FROM keys k WHERE NOT EXISTS (SELECT 1 FROM covered c WHERE c.type = k.type AND c.normalized_domain = k.normalized_domain)),
winners AS (SELECT win AS ordinal, CASE type WHEN 'block' THEN 0 ELSE 1 END AS type_rank, pos FROM kept
  UNION ALL SELECT min(ordinal), 2, min(ordinal) FROM {rules} WHERE type = 'comment' GROUP BY raw),
merged AS (SELECT type_rank, pos, raw, domain, type, wildcard, source, normalized_domain, ordinal FROM {rules} JOIN winners USING (ordinal))"""


def oracle_sql() -> dict[str, str]:
    rules = f"WITH {_LINES_SQL},{_classified('lines')}"
    merged = f"{rules},{_deduplicated()}"
    bulk = f"WITH lines AS (SELECT {_PLACE} AS line_no, 'bulk' AS source, {_BULK} AS line FROM lineitem),{_classified('lines')},"
    # the wildcards of the bulk lines are one label below the plain names, so the SQL can look them up by equality
    bulk += r"""
keys AS (SELECT type, normalized_domain, min(ordinal) AS pos, coalesce(min(ordinal) FILTER (wildcard), min(ordinal)) AS win, bool_or(wildcard) AS wildcard FROM rules GROUP BY ALL),
kept AS (SELECT * FROM keys k WHERE k.wildcard OR NOT EXISTS (SELECT 1 FROM keys w WHERE w.wildcard AND w.normalized_domain = regexp_replace(k.normalized_domain, '^[^.]+\.', '')))"""
    counts = "count(*) FILTER (type = 'block') AS block_count, count(*) FILTER (type = 'allow') AS allow_count, count(*) FILTER (type = 'comment') AS comment_count"
    both = f"SELECT normalized_domain AS domain, {counts.split(', count(*) FILTER (type = ' + chr(39) + 'comment')[0]} FROM %s GROUP BY 1 HAVING bool_or(type = 'block') AND bool_or(type = 'allow')"
    top = "SELECT {0}, count(*) AS n, min(ordinal) AS first FROM rules {1} GROUP BY 1 ORDER BY n DESC, first LIMIT 10"
    out = {
        "classify_lines": f"{rules} SELECT * FROM rules",
        "classify_format_counts": f"{rules} SELECT fmt, count(*) AS n FROM rules GROUP BY 1",
        "classify_keep_unsupported": f"WITH {_LINES_SQL},{_classified('lines', keep=True)} SELECT ordinal, type, fmt, raw FROM rules",
        "classify_filters_only": f"WITH {_LINES_SQL},{_classified('lines', filters=True)} SELECT ordinal, type, domain, wildcard FROM rules",
        "split_content": rf"""WITH {_LINES_SQL}, t AS (SELECT CAST(line_no AS INTEGER) AS source_idx, source, regexp_split_to_array(concat(line, chr(11), upper(line), chr(13), chr(10), source, chr(133), chr(8232), line), '\r\n|[\n-\r\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS l FROM lines)
SELECT source_idx, source, CAST(i - 1 AS BIGINT) AS line_no, l[i] AS line FROM (SELECT source_idx, source, l, unnest(generate_series(1, len(l))) AS i FROM t)""",
        "normalize_domain": f"{rules} SELECT ordinal, domain, normalized_domain FROM rules",
        "dedup_exact_keys": f"{rules} SELECT type, normalized_domain, count(*) AS n FROM rules WHERE type <> 'comment' GROUP BY ALL",
        "dedup_wildcard_preference": f"{merged} SELECT * FROM keys",
        "comment_dedup": f"{rules} SELECT raw, min(ordinal) AS ordinal FROM rules WHERE type = 'comment' GROUP BY raw",
        "coverage_removed": f"{merged} SELECT type, normalized_domain FROM covered",
        "coverage_kept": f"{merged} SELECT type, normalized_domain, wildcard FROM kept",
        "merge_rules": f"{merged} SELECT * FROM merged",
        "merge_rendered_lines": f"{merged} SELECT row_number() OVER (ORDER BY type_rank, pos) - 1 AS out_pos, raw FROM merged",
        "merge_stats": f"{merged} SELECT (SELECT count(*) FROM rules) AS total_before, count(*) AS total_after, (1 - count(*) / (SELECT count(*) FROM rules)) * 100 AS dedup_rate, {counts} FROM merged",
        "conflicts": f"{merged} SELECT b.normalized_domain AS domain, b.raw AS block_rules, a.raw AS allow_rules FROM merged b JOIN merged a ON a.normalized_domain = b.normalized_domain AND b.type = 'block' AND a.type = 'allow'",
        "conflicts_before_dedup": f"{rules} {both % 'rules'}",
        "conflict_domains_intersect": f"{rules} SELECT normalized_domain AS domain FROM rules WHERE type = 'block' INTERSECT SELECT normalized_domain FROM rules WHERE type = 'allow'",
        "equivalent_pairs": f"{rules} SELECT type, normalized_domain, first, ordinal AS other FROM (SELECT *, min(ordinal) OVER (PARTITION BY type, normalized_domain) AS first FROM rules WHERE type <> 'comment') WHERE ordinal > first",
        "subdomain_pairs": f"""{rules}, k AS (SELECT DISTINCT type, normalized_domain AS domain FROM rules WHERE type <> 'comment'), w AS (SELECT DISTINCT type AS wild_type, normalized_domain AS wild_domain FROM rules WHERE wildcard AND type <> 'comment')
SELECT type, domain, wild_type, wild_domain FROM k JOIN w ON domain = wild_domain OR ends_with(domain, '.' || wild_domain)""",
        "source_distribution_top10": f"{rules} {top.format('source', '')}",
        "top_domains_top10": f"{rules} {top.format('domain', 'WHERE type <> ' + chr(39) + 'comment' + chr(39))}",
        "type_distribution": f"{merged} SELECT type, n, n / total * 100 AS percent, repeat('█', CAST(floor(n / total * 100 / 5) AS BIGINT)) AS bar FROM (SELECT type, count(*) AS n, (SELECT count(*) FROM merged) AS total FROM merged GROUP BY type)",
        "source_shares": f"{rules} SELECT source, type, n, n / total * 100 AS percent, CAST(floor(n / total * 100 / 5) AS BIGINT) AS bar_cells FROM (SELECT source, type, count(*) AS n FROM rules GROUP BY ALL) JOIN (SELECT type, count(*) AS total FROM rules GROUP BY ALL) USING (type)",
        "sources_enabled": "SELECT CAST(i AS INTEGER) AS source_idx, url FROM (VALUES (0, 'https://lists.example.com/ads.txt'), (1, 'https://lists.example.com/tracking.txt')) t(i, url)",
        "merge_duplicate_sources": f"{merged} SELECT 'concurrent' AS mode, (SELECT count(*) FROM rules) + (SELECT count(*) FROM rules WHERE source = 'feed_0') AS total_before, (SELECT count(*) FROM merged) AS total_after UNION ALL SELECT 'sequential', (SELECT count(*) FROM rules), (SELECT count(*) FROM merged)",
        "bulk_dedup": f"{bulk} SELECT * FROM keys",
        "bulk_merge": f"{bulk}, r AS (SELECT DISTINCT * FROM rules) SELECT 0 AS type_rank, pos, raw, domain, type, wildcard, source, normalized_domain, ordinal FROM kept k JOIN r USING (type, normalized_domain, wildcard) WHERE r.ordinal = k.win",
        "bulk_coverage": f"{bulk} SELECT type, normalized_domain, wildcard FROM kept",
        "bulk_merge_stats": f"{bulk} SELECT (SELECT count(*) FROM rules) AS total_before, count(*) AS total_after, (1 - count(*) / (SELECT count(*) FROM rules)) * 100 AS dedup_rate, {counts} FROM kept",
        "truncate_source_label": f"WITH {_LINES_SQL}, l AS (SELECT line_no, concat(source, '/', line, '/', line) AS s FROM lines) SELECT line_no, CASE WHEN length(s) < 50 THEN s ELSE substr(s, 1, 47) || '...' END AS label FROM l",
    }
    return out | _files_sql(rules, merged)


def _files_sql(rules: str, merged: str) -> dict[str, str]:
    """SQL of the queries that go through files. A feed's file holds its lines in order."""
    first = "source IN ('feed_0', 'feed_1')"
    feeds = f"WITH {_LINES_SQL}, f AS (SELECT source, string_agg(line || chr(10), '' ORDER BY line_no) AS content FROM lines GROUP BY source)"
    # the merged rules of lines in the order of feeds: a feed's number comes before its lines'
    in_files = f"WITH {_LINES_SQL.replace('page_id AS line_no', '(page_id % 4) * 1000000000 + page_id AS line_no')},{_classified('lines')},{_deduplicated()}"
    two = f"WITH {_LINES_SQL},{_classified('lines', where=first)},{_deduplicated()}"
    both = "(SELECT count(*) FROM merged b JOIN merged a USING (normalized_domain) WHERE b.type = 'block' AND a.type = 'allow')"
    kinds = {k: f"(SELECT count(*) FROM merged WHERE type = '{k}')" for k in ("block", "allow", "comment")}
    before, after = "(SELECT count(*) FROM rules)", "(SELECT count(*) FROM merged)"
    rate = f"printf('%.1f', (1 - {after} / {before}) * 100) || '%'"

    def numbered(parts: list[str]) -> str:
        """Lines of several selects (i, line), in order, numbered from 0."""
        rows = " UNION ALL ".join(f"SELECT {k} AS part, i, line FROM ({p})" for k, p in enumerate(parts))
        return f"SELECT row_number() OVER (ORDER BY part, i) - 1 AS n, line FROM ({rows})"

    def fixed(*lines: str) -> str:
        """A select of lines, each an SQL expression."""
        return " UNION ALL ".join(f"SELECT {i} AS i, {x} AS line" for i, x in enumerate(lines))

    written = "SELECT row_number() OVER (ORDER BY type_rank, pos) AS i, raw AS line FROM merged"
    top = "SELECT row_number() OVER (ORDER BY c DESC, p) AS i, '| {2}' || v || '{2} | ' || c || ' |' AS line FROM (SELECT {1} AS v, count(*) AS c, min(type_rank * 1000000000000 + pos) AS p FROM merged {0} GROUP BY 1 ORDER BY c DESC, p LIMIT 10)"
    types = f"SELECT row_number() OVER (ORDER BY c DESC, p) AS i, '- **' || upper(type[1]) || type[2:] || ':** ' || c || ' (' || printf('%.1f', c / {after} * 100) || '%) ' || repeat('█', CAST(floor(c / {after} * 100 / 5) AS BIGINT)) AS line FROM (SELECT type, count(*) AS c, min(type_rank * 1000000000000 + pos) AS p FROM merged GROUP BY type)"
    markdown = [
        fixed("'# Rules Merge Report'", "'## Summary'", f"'- **Total Rules (before dedup):** ' || {before}", f"'- **Total Rules (after dedup):** ' || {after}", f"'- **Deduplication Rate:** ' || {rate}", "'- **Sources Processed:** 3 / 4'", "'- **Processing Time:** 1.500 seconds'", "'### Rule Breakdown'", f"'- **Block Rules:** ' || {kinds['block']}", f"'- **Allow Rules:** ' || {kinds['allow']}", f"'- **Comments:** ' || {kinds['comment']}", "'- **Conflicts Detected:** 2'", "'## Source Distribution'", "'| Source | Rule Count |'", "'|--------|------------|'"),
        top.format("", "source", ""), fixed("'## Top Domains'", "'| Domain | Count |'", "'|--------|-------|'"), top.format("WHERE type <> 'comment'", "domain", "`"), fixed("'## Rule Types Distribution'"), types,
    ]
    text = fixed("repeat('=', 60)", "'Rules Merge Report'", "repeat('=', 60)", "'SUMMARY'", "repeat('-', 40)", f"'Total Rules (before): ' || {before}", f"'Total Rules (after):  ' || {after}", f"'Deduplication Rate:   ' || {rate}", "'Sources:              3/4'", "'Processing Time:      1.500s'", "'RULE BREAKDOWN'", "repeat('-', 40)", f"'Block Rules:  ' || {kinds['block']}", f"'Allow Rules:  ' || {kinds['allow']}", f"'Comments:     ' || {kinds['comment']}")
    summary = [("total_rules", after), ("total_before", before), ("total_after", after), ("dedup_rate", f"(1 - {after} / {before}) * 100"), *((f"{k}_count", x) for k, x in kinds.items()), ("sources_processed", "3"), ("sources_total", "4"), ("elapsed_time", "1.5"), ("conflict_count", "2")]
    listed = " || ', ' || ".join(f"{x} || ' {k}'" for k, x in kinds.items())
    printed = ["'0'", "'1'", f"'Total rules: ' || {after} || ' (' || {listed} || ')'", "'True'"]
    unmarked = written + " WHERE NOT starts_with(raw, '!')"
    head = ["'! Merged Filter Rules'", "'! Sources: 4/4'", f"'! Total rules: ' || {after}", f"'! Deduplication rate: ' || {rate}", "'! Processing time: 1.50s'", "'! Conflicts detected: 2'", "'!'"]
    return {
        "fetch_one_by_one": f"{feeds} SELECT source, sha256(content) AS sha256 FROM f UNION ALL SELECT 'broken', NULL",
        "fetch_concurrently": f"{feeds} SELECT source, sha256(content) AS sha256, CAST(length(content) AS BIGINT) AS n_chars, false AS failed FROM f UNION ALL SELECT x, NULL, NULL, true FROM (VALUES ('broken'), ('feed_0-missing')) t(x)",
        "fetch_and_parse": f"{rules} SELECT r.source, raw, domain, type, wildcard, CAST(i AS INTEGER) AS source_idx FROM rules r JOIN (VALUES ('feed_1', 0), ('feed_0', 2), ('feed_1', 3)) t(source, i) USING (source)",
        "engine_merge": f"{in_files} {numbered([written])}",
        "merge_source_counts": f"{two} SELECT true AS concurrent, 4 AS processed, 4 AS total, 3 AS succeeded, {before} + (SELECT count(*) FROM rules WHERE source = 'feed_0') AS total_before, {after} AS total_after, {both} AS conflict_count, true AS timed UNION ALL SELECT false, 2, 4, 2, {before}, {after}, {both}, true",
        "parse_text_rules": f"WITH {_LINES_SQL}, n AS (SELECT source, (page_id_4 * 1099511627776) + row_number() OVER (PARTITION BY source ORDER BY line_no) - 1 AS line_no, line FROM (SELECT *, line_no % 4 AS page_id_4 FROM lines)),{_classified('n')} SELECT source, raw, type, ordinal FROM rules",
        "written_list": f"{merged} {numbered([fixed(*[repr(x) for x in ('! Merged Filter Rules', '! Sources: 4/4')], f'{chr(39)}! Total rules: {chr(39)} || {after}', f'{chr(39)}! Deduplication rate: {chr(39)} || {rate}', *[repr(x) for x in ('! Processing time: 1.50s', '! Conflicts detected: 2', '!')]), written])}",
        "report_markdown": f"{merged} {numbered(markdown)}",
        "report_text": f"{merged} {numbered([text])}",
        "report_json": f"{merged} " + " UNION ALL ".join([*(f"SELECT 'summary' AS part, '{k}' AS name, CAST({x} AS DOUBLE) AS value" for k, x in summary), *(f"SELECT 'by_{c}', {c}, CAST(count(*) AS DOUBLE) FROM merged GROUP BY {c}" for c in ("source", "type"))]),
        "report_of_list": f"{rules} SELECT type, count(*) AS n FROM rules GROUP BY type",
        "command_line": f"{in_files} {numbered([fixed(repr('0'), repr('1'), f'{chr(39)}Total rules: {chr(39)} || {after} || {chr(39)} ({chr(39)} || {kinds[chr(98) + chr(108) + chr(111) + chr(99) + chr(107)]} || {chr(39)} block, {chr(39)} || {kinds[chr(97) + chr(108) + chr(108) + chr(111) + chr(119)]} || {chr(39)} allow, {chr(39)} || {kinds[chr(99) + chr(111) + chr(109) + chr(109) + chr(101) + chr(110) + chr(116)]} || {chr(39)} comment){chr(39)}', repr('True')), written.replace('FROM merged', 'FROM merged WHERE NOT starts_with(raw, ' + repr('!') + ')')])}",
        "argument_sources": "SELECT CAST(n AS INTEGER) AS n, source, 60 AS timeout, 3 AS max_workers FROM (VALUES (0, 'a.txt'), (1, 'https://lists.example.com/b.txt')) t(n, source)",
        "test_sources_enabled": "SELECT CAST(i AS INTEGER) AS source_idx, url FROM (VALUES (0, 'https://lists.example.com/small.txt')) t(i, url)",
        "rule_identity": f"{rules}, f AS (SELECT normalized_domain, arg_min(type, ordinal) AS first_type FROM rules GROUP BY 1) SELECT ordinal, type = first_type AS same, raw AS text FROM rules JOIN f USING (normalized_domain)",
        "capitalized_types": f"{rules} SELECT DISTINCT upper(type[1]) || type[2:] AS name FROM rules",
    }
