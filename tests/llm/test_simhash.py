import re

import numpy as np
import xxhash

from listloom.llm import simhash
from listloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_print(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: min(groups[find(i)]) for i in range(len(ids))}


def test_fingerprints():
    for text in ("", " \n", "One", "one two three", "Éa B c d e f", "a b c d " * 50, "x\xa0y z\x85w v u t", "A B C D"):
        assert simhash.fingerprint(text) % (1 << 64) == slow_print(text)
    assert simhash.fingerprint("one TWO three") == simhash.fingerprint("ONE two THREE")


def test_links_of_clusters(spark):
    """Dense clusters, chains and crowds give the components of all pairs, with few links."""
    rng = np.random.default_rng(5)
    flip = lambda x, k: x ^ int(sum(1 << int(b) for b in rng.choice(64, k, replace=False)))
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre} | {flip(centre, int(k)) for k in rng.integers(1, 4, 300)}
    x = int(rng.integers(0, 1 << 62))
    for _ in range(40):
        prints.add(x := flip(x, 4))
    prints |= {int(v) for v in rng.integers(0, 1 << 62, 300)} | {0, 15, 31, (1 << 64) - 1}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).astype(np.int64).tolist()
    expected = slow_components(signed, prints)
    df = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for crowd in (20_000, 20):
        found = simhash.links(df, crowd=crowd)
        pairs = found.collect()
        assert all(bin((a ^ b) % (1 << 64)).count("1") <= 64 for a, b in pairs)
        root = {r["node"]: r["root"] for r in components(found).collect()}
        got = {v: root.get(v, v) for v in signed}
        assert got == expected
    assert len(pairs) < 66 * len(prints)


def test_components(spark):
    pairs = [(1, 2), (2, 3), (9, 3), (5, 6), (7, 7), (None, 1)] + [(100, i) for i in range(101, 300)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 1, 5: 5, 6: 5} | {i: 100 for i in range(100, 300)} | {i: 400 for i in range(400, 461)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_cases(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [(7, base, 1), (3, base, 2), (9, base.replace("w200", "zz"), 3), (5, None, 4), (6, "", 5), (6, "", 5), (8, "alone here", 6), (None, base, 7), (2, "k" * 200_000, 8)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, fp int")
    got = sorted((r["doc_id"] or -1, r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect())
    named = [(i if i is not None else 10**6, t) for i, t, _ in texts]
    expected = slow_components(list(range(len(named))), [slow_print(t or "") for _, t in named])
    least = {k: min(named[j][0] for j in range(len(named)) if expected[j] == expected[k]) for k in range(len(named))}
    assert got == sorted((i or -1, f"{slow_print(t or ''):016x}", least[k]) for k, (i, t, _) in enumerate(texts))
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [2, 3, 5, 8]  # the row without doc_id is a copy of 3
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_clashing_ids(spark):
    """A doc_id at two texts leaves one row of each component."""
    x, y, a, b, c = (" ".join(f"{k}{i}" for i in range(400)) for k in "xyabc")
    near = str.upper  # another text of the same fingerprint
    rows = [(3, near(x)), (5, x), (5, y), (9, near(y)), (1, a), (1, b), (1, b), (2, c), (2, near(c))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = simhash.one_of_each(df)
    got = [tuple(r) for r in kept.collect()]
    assert kept.columns == df.columns and len(got) == len(set(got)) == 5
    assert {(3, near(x)), (5, y), (1, a), (1, b)} < set(got) and len({(2, c), (2, near(c))} & set(got)) == 1


def test_rows_without_doc_id(spark):
    """They go where a row with a doc_id has the same text, and leave one where none has."""
    a, b = (" ".join(f"{k}{i}" for i in range(400)) for k in "ab")
    df = spark.createDataFrame([(None, a), (0, a), (None, b), (None, b), (None, b.upper()), (4, "other words")], "doc_id bigint, text string")
    got = sorted(((r["doc_id"], r["text"].lower()) for r in simhash.one_of_each(df).collect()), key=str)
    assert got == [(0, a), (4, "other words"), (None, b)]


def test_common_values_are_found_before_the_shuffle():
    """Whatever is common over all blocks is common enough in one of them."""
    rng = np.random.default_rng(3)
    fps = np.unique(np.concatenate([rng.integers(0, 1 << 62, 500), (np.int64(77) << 32) | np.arange(300)]))
    values = simhash.ball(fps)
    assert values.shape == (len(fps), 66) and len(np.unique(values[0])) == 66
    at, n = np.unique(values, return_counts=True)
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(x)], ["fp"]) for x in np.array_split(rng.permutation(fps), 7)]
    seen = {v for x in batches for out in simhash._common(iter([x]), -(-200 // 7)) for v in out.column(0).to_pylist()}
    assert {int(v) for v, k in zip(at, n, strict=True) if k > 200} <= seen
