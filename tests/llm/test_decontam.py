import hashlib
import random
import re
import time

from listloom.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def slow(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - 12)):
            if w:
                windows.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[x]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def run(spark, docs, items):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id bigint, text string, pos int, tid int")
    found = decontam.contamination(df, spark.createDataFrame(items, "item_id bigint, text string"))
    return df, [tuple(r)[:1] + tuple(r)[2:] for r in found.collect()]


def test_against_plain_python(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)] + ["Élan", "É", "été", "the", "of", "A1"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([1, 2, 5, 13, 14, 20, 40]))) for i in range(12)]
    items += [(50, items[3][1].upper()), (51, None), (52, "..."), (53, ""), (9, items[5][1])]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, 3)
            parts += ["-".join(w[a:]).upper(), text(rng.randint(0, 200))]
        docs.append((i, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "!?"), docs[0], (103, docs[1][1]), (104, " ".join([docs[2][1]] * 60))]
    df, got = run(spark, docs, items)
    assert sorted(got) == sorted(slow(docs, items))
    kept = decontam.keep_clean(df, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d[0] for d, s in zip(docs, slow(docs, items), strict=True) if not s[5])


def test_empty_tables_and_missing_ids(spark):
    docs, items = [(1, "a b c"), (None, "a b c"), (None, None)], [(1, "a b c")]
    got = sorted(run(spark, docs, items)[1], key=str)
    assert [g[:3] for g in got] == [(1, 3, 3), (None, 0, 0), (None, 3, 3)]
    df, table = spark.createDataFrame([(*r, 1) for r in [*docs, (0, "a b c"), (0, "a b d")]], "doc_id bigint, text string, d int"), spark.createDataFrame(items, "item_id bigint, text string")
    assert sorted(((r["doc_id"], r["text"]) for r in decontam.keep_clean(df, table).collect()), key=str) == [(0, "a b d"), (None, None)]
    assert [g[2] for g in run(spark, docs, [])[1]] == [0, 0, 0]
    assert run(spark, [], items)[1] == []


def test_proximity(spark):
    item = "alpha beta gamma delta"
    docs = [(1, item), (2, "alpha x beta gamma delta"), (3, "delta gamma beta alpha"), (4, "alpha beta gamma"), (5, "alpha x x x x beta gamma delta")]
    df, items = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(7, item)], "item_id bigint, text string")
    near = lambda slop: sorted({(r["doc_id"], r["item_id"]) for r in decontam.phrases(df, items, slop).collect()})
    assert near(0) == [(1, "7")]
    assert near(1) == [(1, "7"), (2, "7")]


def test_main_path_is_native(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    plan = decontam.contamination(df, spark.createDataFrame([(1, "a")], "item_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_repeated_words_cost_their_number(spark):
    """A document and an item of one word each, thousands of times; a phrase with a period; one word as an item."""
    run(spark, [(1, "a")], [(1, "a")])  # compiled
    docs = [(1, "same " * 20_000), (2, "x y z " * 7000), (3, "the cat " * 9000), (4, "same other " * 20)]
    items = [(1, "same " * 5000), (2, "y z x " * 1500), (3, "the"), (4, "z x y")]
    began = time.time()
    got = {g[0]: g for g in run(spark, docs, items)[1]}
    took = time.time() - began
    assert [got[i][1:4] for i in (1, 2, 3, 4)] == [(20_000, 20_000, 1), (21_000, 21_000, 2), (18_000, 9000, 1), (40, 0, 0)]
    assert took < 40, took
