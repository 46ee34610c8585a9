import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from listloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), len(covered)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "É#", "\n", "a b a b a b a b a b", "\xa0", "\x1c", "|", "\n\n", "c\t"]), max_size=40).map(" ".join))
def test_measures(text):
    assert quality.measures(text)[:5] == slow(text)


def test_binomial_bounds():
    for n, k, p in ((10, 0, 0.1), (50, 3, 0.1), (500, 2, 0.02), (7, 7, 0.5)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.binomial_tail(k, n, p), exact, rel_tol=1e-9)
    assert quality.certified([0, 0, 1, 40], 1000, 0.01, 0.01) == 2
    assert quality.certified([0, 0, 0], 100, 0.01, 0.01) is None


def test_risk_is_kept():
    """Over many draws, the certified cutoff seldom rejects more than the share of the good."""
    rng, wrong = random.Random(3), 0
    for _ in range(200):
        bins = sorted(rng.random() for _ in range(800))
        cuts = [1 - i / 100 for i in range(1, 12)]  # cutoff i truly rejects i / 100
        last = quality.certified([sum(v > c for v in bins) for c in cuts], len(bins), 0.05, 0.1)
        wrong += last is not None and last + 1 > 5
    assert wrong <= 0.1 * 200 + 10


def docs(spark, n=3000):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [f"w{rng.randrange(10**6)}" + ("%%%" if bad else "") for _ in range(40)]
        rows.append((i, " ".join(words), "en" if i % 3 else None))
        labels.append((i, 0 if bad else 1))
    return rows, spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_rejects_what_the_labels_call_bad(spark):
    rows, labels = docs(spark, 10_000)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, labels, risk=0.05).collect()}
    assert all(got[i] == (i % 5 != 0) for i in got)
    few = quality.quality_rules(df.limit(60), labels, risk=0.05)
    assert few.where("NOT kept").count() == 0  # too few labels certify nothing: 48 good ones, where one stratum needs 59


def test_cases(spark):
    rows, labels = docs(spark, 30)
    rows += [(100, None, "en"), (101, "", None), (102, "only few words", "en"), (None, "same same " * 200, "de"), (0, rows[0][1], "en"), (103, "x" * 300_000, "en")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "doc_id bigint, text string, lang string, n_words int, quality string")
    out = quality.quality_rules(df, labels)
    got = [r for r in out.collect()]
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[100]["n_words"] == 0 and by[100]["base_failed"] and by[101]["base_failed"] and by[102]["base_failed"]
    assert by[None]["n_repeat_words"] == 400 and by[None]["base_failed"] and not by[None]["kept"]
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and kept.count() == 31
    assert quality.quality_rules(df.limit(0), labels).count() == 0
    assert quality.quality_rules(df, labels.limit(0)).where("kept").count() == 31


def test_few_labels_certify_jointly_and_by_the_pool(spark):
    """At the production risk: strata of 300 and of 217 good labels have their own cutoff, small and unlabelled ones the pool's."""
    rows, labels = [], []
    for lang, good in (("es", 300), ("fr", 217), ("de", 120), ("it", 110)):
        for i in range(good + 20):
            bad = i >= good
            rows.append((len(rows), " ".join(f"w{len(rows)}x{k}" + ("%%%" if bad else "") for k in range(40)), lang))
            labels.append((len(rows) - 1, 0 if bad else 1))
    rows += [(-1, "%%% " * 3 + " ".join(f"v{k}!!!" for k in range(40)), None), (-2, " ".join(f"v{k}#" for k in range(40)), "pt"), (-3, " ".join(f"v{k}" for k in range(40)), "pt")]
    df, table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, table).collect()}
    assert all(got[i] == (q == 1) for i, q in labels) and not got[-1] and not got[-2] and got[-3]
    bins = lambda n, at=len(quality.CUTOFFS): [n if i == at else 0 for i in range(len(quality.CUTOFFS) + 1)]
    strict = quality.CUTOFFS[-1]
    assert quality.joint({"a": bins(217), "b": bins(217), "c": bins(217), "d": bins(216)}) == {"a": strict, "b": strict, "c": strict, None: strict}
    assert quality.joint({"a": bins(300, 0), "b": bins(300)}) == {"a": None, "b": strict, None: None}  # a loses its good documents at every cutoff
    assert quality.joint({"a": bins(90), "b": bins(90)}) == {None: None} and quality.joint({}) == {None: None}


def test_copies_count_once(spark):
    """216 good texts certify nothing among four strata, with however many copies; one more does."""
    def judged(n):
        text = lambda i, bad: " ".join(f"w{i}x{k}" + ("%%%" if bad else "") for k in range(40))
        rows = [(i, text(i % n, False), "es") for i in range(2000)] + [(5000 + i, text(5000 + i, True), "es") for i in range(20)]
        rows += [(6000 + i, text(6000, False), lang) for i, lang in enumerate(("de", "fr", "it"))]
        labels = [(r[0], 0 if 5000 <= r[0] < 6000 else 1) for r in rows]
        # a text of which one copy is called bad is not good
        df = spark.createDataFrame([*rows, (7000, text(0, False), "es")] if n > 217 else rows, "doc_id bigint, text string, lang string")
        labels = [*labels, (7000, 0)] if n > 217 else labels
        return quality.quality_rules(df, spark.createDataFrame(labels, "doc_id bigint, quality int")).where("NOT kept").count()

    assert judged(213) == 0 and judged(217) == 20 and judged(218) == 20


def test_calibration_on_the_cluster_is_the_plain_one(spark):
    """For more strata than any list holds, of sizes around what a cutoff of their own needs."""
    rng = random.Random(9)
    for strata, n in ((260, 40), (3, 500), (4, 217), (1, 10), (0, 0)):
        rows = [(f"s{k}" if k else None, rng.choice([0, 0, 0, 0, 0, 0, 0, 0, 120, 400, 5000] if k % 3 else [0])) for k in range(strata) for _ in range(rng.randint(n // 2, 2 * n))]
        counts = {}
        for s, v in rows:
            counts.setdefault(s, [0] * (len(quality.CUTOFFS) + 1))[sum(v <= c for c in quality.CUTOFFS)] += 1
        expected = quality.joint(counts, 0.1, 0.05)
        table, pool = quality.calibrate(spark.createDataFrame(rows, "s string, v bigint"), 0.1, 0.05)
        assert {r["__s"]: r["__cutoff"] for r in table.collect()} | {None: pool} == expected
