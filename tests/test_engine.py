import http.server
import json
import threading

import oracle
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from listloom import Engine, LineParser, Report, Rule
from listloom.functions import bar, capitalized, is_subdomain, label_suffixes, percentage, reduction, shortened
from listloom.operators import classify, conflicts, deduplicate, keys, split_lines, summary
from listloom.plans import merge, merge_lines, write_rules
from listloom.plans.sink import numbered
from listloom.schema import LINES

EDGES = [
    ("0.0.0.0 Ads.com", ("0.0.0.0 Ads.com", "Ads.com", "block", False)),
    ("127.0.0.1\tads.com", ("127.0.0.1\tads.com", "ads.com", "block", False)),
    ("0.0.0.0 localhost", None),
    ("127.0.0.1 LOCALHOST.localdomain", None),
    ("0.0.0.0 a.com # note", None),
    ("0.0.0.0 a.com b.com", None),
    ("0.0.0.0 0.0.0.0", ("0.0.0.0 0.0.0.0", "0.0.0.0", "block", False)),
    ("0.0.0.0 *.x.com", ("0.0.0.0 *.x.com", "*.x.com", "block", True)),
    ("Plain.Example.COM", ("||plain.example.com^", "plain.example.com", "block", False)),
    ("1.2.3.4", None),
    ("a_b.com", None),
    ("x.xn--p1ai", None),
    ("a.com.", None),
    ("##.ad", None),
    ("#@#.ad", None),
    ("a.com##.ad", None),
    ("||a.com^$third-party", ("||a.com^$third-party", "a.com", "block", False)),
    ("||a.com/p^", None),
    ("||a.com", None),
    ("# note", None),
    ("[Header 2.0]", None),
    ("||*ads.com^", ("||*ads.com^", "*ads.com", "block", False)),
    ("||*.*.x.com^", ("||*.*.x.com^", "*.*.x.com", "block", True)),
    (" ||a.com^ ", ("||a.com^", "a.com", "block", False)),
    ("||a b.com^", None),
    ("﻿! Title", None),
    ("!#if", ("!#if", "", "comment", False)),
    ("@@||*.ok.com^", ("@@||*.ok.com^", "*.ok.com", "allow", True)),
    ("", None),
    ("   ", None),
]


def lines(spark, texts, source="s"):
    return spark.createDataFrame([(0, source, i, x) for i, x in enumerate(texts)], LINES)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).select("raw", "domain", "type", "wildcard").collect()]


def test_formats(spark):
    got = {r["ordinal"]: (r["raw"], r["domain"], r["type"], r["wildcard"]) for r in classify(lines(spark, [x for x, _ in EDGES])).collect()}
    for i, (line, expected) in enumerate(EDGES):
        assert got.get(i) == expected == oracle.parse(line), line


def test_profiles_and_unsupported(spark):
    texts = ["##.ad", "a.com", "0.0.0.0 b.com", "||c.com^", "! x"]
    assert [r[1] for r in rows(classify(lines(spark, texts), profile="filters"), "ordinal")] == ["c.com", ""]
    assert rows(classify(lines(spark, texts), keep_unsupported=True), "ordinal")[0] == ("##.ad", "", "comment", False)
    with pytest.raises(ValueError):
        classify(lines(spark, texts), profile="other")


def test_long_names_and_clashing_columns(spark):
    name = "a." * 5000 + "com"
    df = lines(spark, [name]).withColumn("raw", F.lit(1)).withColumn("c", F.lit(2)).withColumn("type", F.lit("x"))
    assert rows(classify(df), "ordinal")[0][1] == name


def test_empty_and_null_lines(spark):
    assert classify(lines(spark, [])).count() == 0
    assert classify(lines(spark, [None, None])).count() == 0
    assert deduplicate(classify(lines(spark, []))).count() == 0


def test_line_breaks(spark):
    text = "a\x0bb\x0cc\x85d e f\x1cg\x1dh\x1ei\r\nj\rk\nl\n\nm\n"
    got = split_lines(spark.createDataFrame([(0, "s", text), (1, "s", ""), (2, "s", None)], "source_idx int, source string, content string"))
    assert [r["line"] for r in got.where("source_idx = 0").orderBy("line_no").collect()] == text.splitlines()
    assert got.where("source_idx > 0").count() == 0


def test_survivors_and_places(spark):
    texts = ["a.com", "||*.a.com^", "b.com", "||*.x.com^", "||*.a.x.com^", "||q.x.com^", "@@||q.x.com^", "! c", "! c", "||B.com^$x"]
    merged = merge_lines(lines(spark, texts))
    assert [r[0] for r in rows(merged.rules, "type_rank", "pos")] == ["||*.a.com^", "||b.com^", "||*.x.com^", "||*.a.x.com^", "@@||q.x.com^", "! c"]
    assert conflicts(merged.rules).count() == 0 and conflicts(merged.parsed).count() == 1
    assert [r["out_pos"] for r in numbered(merged.rules).orderBy("type_rank", "pos").collect()] == list(range(6))
    both = {(r["normalized_domain"]): (r["pos"], r["win"], r["wildcard"]) for r in keys(merged.parsed).where("type = 'block'").collect()}
    assert both["a.com"] == (0, 1, True) and both["b.com"] == (2, 2, False)


LABEL = st.sampled_from(["a", "b", "ads", "com", "net"])
DOMAIN = st.lists(LABEL, min_size=1, max_size=4).map(".".join)
LINE = st.one_of(DOMAIN.map("||{}^".format), DOMAIN.map("||*.{}^".format), DOMAIN.map("@@||{}^".format), DOMAIN.map("@@||*.{}^".format), DOMAIN.map("0.0.0.0 {}".format), DOMAIN, st.sampled_from(["! a", "! b", "x", ""]))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(LINE, min_size=1, max_size=60))
def test_against_plain_python(spark, texts):
    merged = merge_lines(lines(spark, texts))
    parsed = [r for r in map(oracle.parse, texts) if r]
    assert rows(merged.parsed, "ordinal") == parsed
    kept = rows(merged.rules, "type_rank", "pos")
    assert kept == oracle.deduplicate(parsed)
    again = deduplicate(merged.rules.drop("type_rank", "pos"))
    assert sorted(rows(again, "type_rank", "pos")) == sorted(kept)


def test_scalars(spark):
    r = spark.range(1).select(
        shortened(F.lit("x" * 49)).alias("a"), shortened(F.lit("x" * 50)).alias("b"), bar(F.lit(99.9)).alias("c"), capitalized(F.lit("bLOCK")).alias("d"),
        percentage(F.lit(1), F.lit(8)).alias("e"), reduction(F.lit(0), F.lit(0)).alias("f"), label_suffixes(F.lit("a.b.c")).alias("g"),
        is_subdomain(F.lit("x.a.com"), F.lit("block"), F.lit("a.com"), F.lit("allow"), F.lit(True)).alias("h"),
        is_subdomain(F.lit("xa.com"), F.lit("block"), F.lit("a.com"), F.lit("allow"), F.lit(True)).alias("i"),
    ).first()
    assert tuple(r) == ("x" * 49, "x" * 47 + "...", "█" * 19, "Block", 12.5, 0.0, ["a.b.c", "b.c", "c"], True, False)


def test_rule_objects():
    a, b = Rule("||Ads.com^", "Ads.com", "block", False, "s"), Rule("||*.ads.com^", "*.ads.com", "block", True, "t")
    assert a == b and hash(a) == hash(b) and str(a) == "||Ads.com^" and a != "x"
    assert Rule("", "x.ads.com", "allow", False, "").is_subdomain_of(b) and not b.is_subdomain_of(a)
    assert not Rule("! c", "", "comment", False, "").is_subdomain_of(b)


def test_library(spark):
    engine, parser = Engine(spark), LineParser(spark)
    text = "||ads.com^\n\n! Comment\ninvalid line\n@@||ads.com^\n||*.tracker.com^"
    rules = parser.parse_text(text, "s")
    assert [(r.type, r.domain, r.wildcard) for r in rules] == [("block", "ads.com", False), ("comment", "", False), ("allow", "ads.com", False), ("block", "*.tracker.com", True)]
    assert parser.parse_line("nothing here") is None and LineParser(spark, skip_unsupported=False).parse_line("##.x").type == "comment"
    assert len(engine.deduplicate(rules + rules)) == 4 and engine.deduplicate([]) == []
    assert [c["domain"] for c in engine.detect_conflicts(rules)] == ["ads.com"]
    for wrong in ("x", None):
        with pytest.raises(TypeError):
            engine.deduplicate(wrong)
        with pytest.raises(TypeError):
            engine.merge(wrong)
    with pytest.raises(ValueError):
        engine.fetch_source("  ")
    assert engine.merge([]) == []


class Handler(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        ok = self.path == "/ok.txt"
        self.send_response(200 if ok else 404)
        self.send_header("Content-Type", "text/plain; charset=utf-8")
        self.end_headers()
        self.wfile.write("||web.com^\n||*.näh.com^\n".encode() if ok else b"no")

    def log_message(self, *args):
        pass


def test_sources_merge_reports_and_files(spark, tmp_path):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    good, bad = tmp_path / "a.txt", tmp_path / "bad.txt"
    good.write_text("||a.com^\n||a.com^\n@@||*.web.com^\n! note\n||x.a.com^\n", encoding="utf-8")
    bad.write_bytes(b"||bad.com^\n\xff\xfe\n")
    sources = [str(good), f"{url}/ok.txt", f"{url}/missing", str(bad), str(good)]
    try:
        found = merge(spark, sources, detect_conflicts=True)
        once = merge(spark, sources, return_stats=True, concurrent=False)
    finally:
        server.shutdown()
    assert [r["raw"] for r in found.ordered().collect()] == ["||a.com^", "||x.a.com^", "||web.com^", "||*.näh.com^", "@@||*.web.com^", "! note"]
    s = found.stats
    assert (s["total_before"], s["total_after"], s["sources_processed"], s["sources_total"], s["sources_succeeded"], s["conflict_count"]) == (12, 6, 5, 5, 3, 1)
    assert (once.stats["total_before"], once.stats["sources_processed"]) == (7, 2)
    out = tmp_path / "merged.txt"
    assert write_rules(found.rules, str(out), s) == 6
    written = out.read_text(encoding="utf-8").splitlines()
    assert written[2:7] == ["! Sources: 5/5", "! Total rules: 6", "! Deduplication rate: 50.0%", written[5], "! Conflicts detected: 1"] and written[7] == "!" and len(written) == 14
    report = Report(found.rules, s)
    md = report.markdown()
    assert "- **Block:** 4 (66.7%) █████████████" in md and "| `a.com` | 1 |" in md and "- **Conflicts Detected:** 1" in md
    made = report.json()
    assert made["distributions"]["by_type"] == {"block": 4, "allow": 1, "comment": 1} and made["summary"]["total_rules"] == 6
    assert "Deduplication Rate:   50.0%" in report.text() and "Comments:     1" in report.text()
    for form in ("markdown", "text", "json"):
        report.save(str(tmp_path / "deep" / form), form)
    assert json.loads((tmp_path / "deep" / "json").read_text())["summary"]["allow_count"] == 1
    with pytest.raises(ValueError):
        report.save(str(tmp_path / "x"), "html")


def test_configuration(spark, tmp_path):
    from listloom.sources import enabled_sources, load_sources, sources_frame

    path = tmp_path / "s.yaml"
    path.write_text("sources:\n - {name: a, url: u1}\n - {name: b, url: u2, enabled: false}\n - {name: c, url: u3, enabled: true}\ntest_sources:\n - {name: t, url: u4}\n")
    assert load_sources(str(path)) == ["u1", "u3"] and load_sources(str(path), "test_sources") == ["u4"]
    assert [r["url"] for r in enabled_sources(sources_frame(spark, str(path))).orderBy("source_idx").collect()] == ["u1", "u3"]
    path.write_text("other: 1\n")
    assert load_sources(str(path)) == []
    with pytest.raises(FileNotFoundError):
        load_sources(str(tmp_path / "none.yaml"))


def test_files_in_any_store(spark, tmp_path):
    from listloom.sources.lists import read_files

    (tmp_path / "a.txt").write_bytes("﻿! t\n||a.com^".encode())
    (tmp_path / "b.txt").write_bytes(b"\xff")
    found = {r["source"].rsplit("/", 1)[1]: (r["content"], r["error"]) for r in read_files(spark, [str(tmp_path)]).collect()}
    assert found["a.txt"] == ("﻿! t\n||a.com^", None) and found["b.txt"][0] is None and "invalid UTF-8" in found["b.txt"][1]


def test_command_line(spark, tmp_path, capsys):
    from listloom.cli import main

    src, out = tmp_path / "l.txt", tmp_path / "out" / "m.txt"
    src.write_text("||a.com^\n@@||a.com^\n")
    assert main(["-s", str(src), "-o", str(out), "--report", "--report-format", "json", "--detect-conflicts"]) == 0
    assert out.read_text().splitlines()[-2:] == ["||a.com^", "@@||a.com^"] and (tmp_path / "out" / "m.report.json").exists()
    assert "Total rules: 2" in capsys.readouterr().out
    assert main(["-c", str(tmp_path / "none.yaml")]) == 1
    (tmp_path / "empty.yaml").write_text("sources: []\n")
    assert main(["-c", str(tmp_path / "empty.yaml")]) == 1


def test_stream(spark, tmp_path):
    from listloom.streaming import remerge

    lines(spark, ["||a.com^", "||x.a.com^"]).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema(LINES).parquet(str(tmp_path / "in"))
    run = lambda: remerge(stream, str(tmp_path / "rules"), str(tmp_path / "ck"), lambda df, n: seen.append(sorted(r["raw"] for r in df.collect()))).awaitTermination()
    run()
    spark.createDataFrame([(1, "t", 0, "||*.a.com^")], LINES).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert seen == [["||a.com^", "||x.a.com^"], ["||*.a.com^"]]


def test_summary_of_nothing(spark):
    none = classify(lines(spark, []))
    assert tuple(summary(none, none).first()) == (0, 0, 0.0, 0, 0, 0)


def test_coverage_is_no_theta_join(spark):
    plan = deduplicate(classify(lines(spark, ["a.com"])))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_large_files_are_read_in_ranges(spark, tmp_path, monkeypatch):
    """Several tasks read a file, and together they find the lines that one finds; a byte that is no UTF-8 fails the file."""
    import random

    from listloom.sources import lists

    rng = random.Random(6)
    ends = ["\n", "\n", "\n", "\r\n", "\x0b", "\x85", "\u2028", "\r", "\n\n", "\x1c"]
    text = "".join(f"||h{i}{rng.choice(['é', '', '日本', 'x' * 300])}.com^{rng.choice(ends)}" for i in range(600)) + "||last.com^"
    good, bad = tmp_path / "good.txt", tmp_path / "bad.txt"
    good.write_bytes(text.encode())
    bad.write_bytes(text.encode() + b"\n\xff\n" + text.encode())
    for size, piece in ((997, 64), (1, 1), (5000, 5000), (1 << 20, 100)):
        monkeypatch.setattr(lists, "RANGE", size)
        monkeypatch.setattr(lists, "PIECE", piece)
        reader = lists._Reader([str(good), str(bad)], 1, False, None)
        found, failed, tasks = [], set(), reader.partitions()
        for part in tasks if size > 1 else tasks[: len(text.encode())]:
            for batch in reader.read(part):
                for r in batch.to_pylist():
                    if r["error"]:
                        failed.add(r["source_idx"])
                    elif r["line"] is not None and r["source_idx"] == 0:
                        found.append((r["line_no"], r["line"]))
        numbers = [n for n, _ in sorted(found)]
        assert [x for _, x in sorted(found)] == text.splitlines() and len(set(numbers)) == len(numbers), size
        assert len(tasks) > 10 or size > 5000 - 1
        assert size == 1 or failed == {1}
    monkeypatch.undo()
    bounded = lists._Reader([str(good)] * 9, 1, False, 4).partitions()
    assert len(bounded) == 4 and sorted(p[0] for b in bounded for p in b.parts) == list(range(9))
    assert lists.read_lines(spark, [str(good), str(bad), "none"], max_workers=2).rdd.getNumPartitions() == 2


def test_failed_sources_leave_no_lines(spark):
    from listloom.sources import readable

    rows = [(0, "a", 0, "x", None), (0, "a", None, None, None), (1, "b", 0, "y", None), (1, "b", None, None, "E"), (1, "b", 900, "z", None), (1, "b", None, None, None), (2, "a", None, None, None)]
    read = spark.createDataFrame(rows, "source_idx int, source string, line_no bigint, line string, error string")
    assert [(r["source_idx"], r["line"]) for r in readable(read).collect()] == [(0, "x")]
    assert sorted(r["source_idx"] for r in readable(read, lines=False).collect()) == [0, 2]


def test_survivors_are_gathered_again(spark):
    """Merging in parts gives what merging at once gives, counts included, and no number of a line runs into another source."""
    from pyspark.errors import PySparkException

    from listloom.operators import gathered, survivors

    texts = ["a.com", "||*.a.com^", "b.com", "! c", "||b.com^$x", "! c", "||q.a.com^", "@@||b.com^", "||*.B.com^"] * 3
    whole = classify(lines(spark, texts))
    parts = [survivors(whole.where(f"ordinal % 3 = {k}")) for k in range(3)]
    again = gathered(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    take = lambda df: sorted(map(str, df.collect()))
    assert take(again) == take(survivors(whole)) and sum(r["n"] for r in again.collect()) == len(texts)
    far = spark.createDataFrame([(0, "s", 1 << 40, "a.com")], LINES)
    with pytest.raises(PySparkException):
        classify(far).collect()
    plan = survivors(whole)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_reports_and_workers_of_plain_lists(spark, tmp_path):
    from listloom import engine

    path = tmp_path / "l.txt"
    path.write_text("||a.com^\n||a.com^\n! c\n")
    with pytest.raises(ValueError):
        Engine(spark, max_workers=0)
    rules = Engine(spark, max_workers=1).fetch_and_parse([str(path), str(path)])
    assert [r.raw for r in rules] == ["||a.com^", "||a.com^", "! c"] * 2
    made = engine.report(spark, rules, {"total_before": 6})
    assert made.json()["distributions"]["by_type"] == {"block": 4, "comment": 2} and "| `a.com` | 4 |" in made.markdown()
    assert engine.report(spark, []).json()["summary"]["total_rules"] == 0
