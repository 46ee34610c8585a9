"""The pipeline against the brute-force parts of its stages, and the registered queries over the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from listloom.llm import quality, queries
from listloom.llm.simhash import fingerprint


def test_stages(spark, sf_dir, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "language_id", "near_dedup", "decontamination", "byte_bpe"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = [dict(texts)]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "byte_bpe":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            rows = docs.collect()
            kept.append({r["doc_id"]: r["text"] for r in rows})
            assert len(rows) == len(kept[-1]) and all(texts[i] == t for i, t in kept[-1].items())
    _, good, known, once, clean = kept
    fails = lambda m: m[0] < 20 or 100 * m[4] > 30 * m[0]
    assert set(good) == {i for i, t in texts.items() if not fails(quality.measures(t))}  # too few labels for cutoffs here
    assert set(known) <= set(good) and len(known) >= 0.97 * len(good)
    prints = {i: fingerprint(t) % (1 << 64) for i, t in known.items()}
    parent = {i: i for i in known}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(known)
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4 and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert set(once) == {i for i in ids if find(i) == i}
    from test_decontam import slow

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(clean) == {r[0] for r in slow(list(once.items()), items) if not r[5]}
    assert {r["doc_id"] for r in docs.collect()} == set(clean)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == set(clean)


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in got.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr(tuple(r[c] for c in names)) for r in df.collect()) == sorted(map(repr, got.fetchall()))


def test_one_query_for_each_operator():
    numbers = sorted(int(q[2:].split("_")[0]) for q in queries.queries())
    assert numbers == list(range(1, 11))


def test_nulls_repeats_and_clashing_columns(spark, sf_dir, tmp_path):
    """Rows that every stage must stand, beside ordinary ones, and what becomes of them."""
    plain = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").collect()]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").where("size(split(text, ' ')) >= 30").first()["text"]
    english = next(r[1] for r in plain if r[2] == "en" and len(r[1]) > 2000 and quality.measures(r[1])[4] == 0)
    words = english.split()
    own = lambda k: " ".join(words[k:] + words[:k])  # noqa: E731  other shingles at the seams only, so near copies
    extra = [
        (None, None, None, None, None), (900_001, None, "en", "s", 0), (900_002, "", None, None, 0), (900_003, "too short", "en", "s", 9),
        (None, english, "en", "s", 1), (900_004, item, "en", "s", 1), (None, item, None, None, 1),
        (900_005, own(7) * 40, None, "s", 1),  # long, and rejected for its repeated words
        plain[0], plain[0], plain[1],
    ]
    rows = [(*r, 1, "q", 2) for r in plain + extra]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int, kept string, fp int"
    folder = tmp_path / "sf"
    spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").write.parquet(str(folder / f"{name}.parquet"))
    docs, kept = spark.read.parquet(str(folder / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(folder))
        if name != "byte_bpe":
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append([r["doc_id"] for r in docs.collect()])
    good, _, once, clean, last = kept
    assert not {900_001, 900_002, 900_003, 900_005} & set(good) and good.count(None) == 2  # null texts fail, null ids do not
    assert len(once) == len(set(once)) and None not in once  # each group leaves one, and these rows are copies
    assert 900_004 not in clean and sorted(last) == sorted(clean)
    plainly = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert set(last) == plainly  # the others are judged as they are without these rows
    empty = tmp_path / "empty"
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(folder / f"{name}.parquet")).limit(0).write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
