import random
import zlib

from listloom.llm import langid

SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it".split(), "fr": "é è eau oi eux ment tion ai qu ou ç la le ê en que au re an de".split(), "de": "ch ei sch ung en er ge ver ü ä ö ß lich keit zu st be auf ein pf".split()}


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choices(list(SYLLABLES), [3, 2, 1])[0]
        words = ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(rng.randint(15, 200))]
        rows.append((i, " ".join(words), lang))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_held_out_accuracy(spark):
    rows, df = table(spark)
    got = {r["doc_id"]: r for r in langid.languages(df).collect()}
    for i, _, _ in rows:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i]["score"] <= 1
    held = [(got[i]["lang_pred"] == lang, got[i]["accepted"]) for i, _, lang in rows if got[i]["held_out"]]
    assert sum(ok for ok, _ in held) >= 0.97 * len(held) and sum(a for _, a in held) >= 0.95 * len(held)


def test_held_out_rows_and_labels_are_no_inputs(spark):
    rows, df = table(spark, 200)
    changed = [(i, t, None if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    other = spark.createDataFrame(changed, df.schema)
    take = lambda d: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in langid.languages(d).collect())
    assert take(df) == take(other)


def test_cases(spark):
    rows, df = table(spark, 200)
    more = spark.createDataFrame([(900, None, "en"), (901, "", None), (902, "123 !? \n", "fr"), (None, rows[0][1], rows[0][2]), (903, "zz", None), (904, rows[0][1] * 400, None), (0, *rows[0][1:])], df.schema)
    both = df.unionByName(more).selectExpr("*", "1 AS score", "2 AS accepted")
    got = langid.languages(both).collect()
    assert len(got) == 207
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and not by[i]["accepted"] for i in (900, 901, 902))
    assert by[904]["lang_pred"] == rows[0][2] and by[903]["lang_pred"] in SYLLABLES and by[None]["held_out"] is False
    kept = langid.keep_identified(both)
    assert kept.columns == both.columns and kept.count() >= 195
    assert langid.languages(df.limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.languages(df.selectExpr("doc_id", "text", "cast(null AS string) AS lang")).collect()} == {"und"}


def test_every_label_is_learned(spark):
    """Copies of one text, more labels than any list holds, and texts of other lengths than the preferred ones."""
    rng = random.Random(4)
    english, german = "the quick brown fox jumps over the lazy dog and then rests " * 4, lambda: " ".join(rng.choices(["der", "hund", "läuft", "über", "straße", "und", "schläft", "danach", "lange"], k=30))
    rows = [(i, english, "en") for i in range(3000)] + [(5000 + i, german(), "de") for i in range(300)]
    rows += [(6000 + i, f"kurz{i} ça", "short") for i in range(40)] + [(7000, "ő" * 9000 + " ű", "long"), (7001, "ő" * 9000 + " ű", "long"), (7002, "ő" * 9000 + " ű", "long")]
    rows += [(8000 + 10 * k + j, f"word{chr(97 + k % 26)}{chr(97 + k // 26)} " * 20, f"l{k}") for k in range(80) for j in range(4)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = dict(langid.learn(df))
    assert set(found) == {lang for _, _, lang in rows}
    assert all(0 < len(x) <= langid.DICTIONARY for x in found.values())
    got = {r["doc_id"]: r["lang_pred"] for r in langid.languages(df.where("lang IN ('en', 'de')")).collect()}
    assert all(got[i] == lang for i, _, lang in rows if lang in ("en", "de"))


def test_letters():
    assert langid.letters("½ ² ٣ Ⅷ 12_!") == b"" and langid.letters("\u0301") == b"" and langid.letters("") == b""
    assert langid.letters("A1b_C") == b"a b c" and langid.letters("नमस्ते दुनिया!").decode() == "नमस्ते दुनिया"
    assert langid.Model((("en", b"abc"), ("de", b"xyz"))).predict("½ ²") == ("und", 0.0, False)
