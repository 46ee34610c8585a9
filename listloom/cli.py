"""Command line: python -m listloom -s SOURCE... | -c CONFIG."""

from __future__ import annotations

import argparse
import logging
import sys
from pathlib import Path

from listloom.plans.merge import merge
from listloom.plans.report import FORMATS, Report
from listloom.plans.sink import report_path, write_rules
from listloom.sources.config import load_sources

VERSION = "0.1.0"
log = logging.getLogger("listloom")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="listloom", description="Merge filter lists from several sources.")
    sources = parser.add_mutually_exclusive_group(required=True)
    sources.add_argument("--sources", "-s", nargs="+", help="files and urls to merge")
    sources.add_argument("--config", "-c", help="YAML file that names the sources")
    parser.add_argument("--output", "-o", default="merged_rules.txt", help="file to write (%(default)s)")
    parser.add_argument("--report", "-r", action="store_true", help="write a report beside it")
    parser.add_argument("--report-format", choices=list(FORMATS), default="markdown")
    parser.add_argument("--detect-conflicts", action="store_true", help="look for domains both blocked and allowed")
    parser.add_argument("--no-concurrent", action="store_true", help="read each named source once, however often it is named")
    parser.add_argument("--timeout", type=int, default=60, help="seconds that a url may take")
    parser.add_argument("--max-workers", type=int, default=10, help="sources read at one time")
    said = parser.add_mutually_exclusive_group()
    said.add_argument("--verbose", "-v", action="store_true")
    said.add_argument("--quiet", "-q", action="store_true")
    parser.add_argument("--version", action="version", version=f"%(prog)s {VERSION}")
    return parser


def _session(max_workers: int):
    from pyspark.sql import SparkSession

    found = SparkSession.getActiveSession()
    return found or SparkSession.builder.appName("listloom").config("spark.master", f"local[{max_workers}]").config("spark.ui.enabled", "false").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    """Exit code 1 for a configuration that cannot be read, no sources, an interruption or any failure; else 0."""
    args = arguments().parse_args(argv)
    level = logging.WARNING if args.quiet else logging.DEBUG if args.verbose else logging.INFO
    logging.basicConfig(level=logging.WARNING, format="%(levelname)s listloom: %(message)s")
    log.setLevel(level)
    try:
        sources = load_sources(args.config) if args.config else args.sources
    except Exception as e:  # noqa: BLE001
        log.error("The configuration cannot be read: %s", e)
        return 1
    if not sources:
        log.error("No sources are given.")
        return 1
    try:
        result = merge(_session(args.max_workers), sources, return_stats=True, detect_conflicts=args.detect_conflicts, concurrent=not args.no_concurrent, timeout=args.timeout, max_workers=args.max_workers)
        stats = result.stats
        log.info("%s rules became %s (%.1f%% fewer) in %.2f s", stats["total_before"], stats["total_after"], stats["dedup_rate"], stats["elapsed_time"])
        if result.conflicts is not None:
            for row in result.conflicts.select("domain").toLocalIterator():
                log.warning("Conflict: %s", row["domain"])
        Path(args.output).parent.mkdir(parents=True, exist_ok=True)
        write_rules(result.rules, args.output, stats)
        if args.report:
            Report(result.rules, stats).save(report_path(args.output, FORMATS[args.report_format]), args.report_format)
        if not args.quiet:
            kinds = ", ".join(f"{stats[f'{kind}_count']} {kind}" for kind in ("block", "allow", "comment"))
            print(f"Total rules: {stats['total_after']} ({kinds}) of {stats['total_before']}, in {stats['elapsed_time']:.1f} s")
            print(f"Written to {Path(args.output).absolute()}")
        result.release()
    except KeyboardInterrupt:
        log.info("Interrupted.")
        return 1
    except Exception as e:  # noqa: BLE001
        log.error("The merge failed: %s", e, exc_info=args.verbose)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
