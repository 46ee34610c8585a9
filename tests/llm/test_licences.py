import random
import re
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from listloom.llm import licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}
FRAGMENT = st.sampled_from(["GNU General Public License", "apache license", "CC BY", "cc", "by", "MIT License", "license", "Released under the", "the", "of", "zebra", "gnu general", "É", "version 2.0."] + [" ".join(t.split()[:9]) for _, t in licences.TEMPLATES] + [t for _, t in licences.TEMPLATES])


def longest(sequences, text, i):
    """Length of the longest run of words that ends at i and stands in one of the sequences."""
    n, whole = 0, [b" " + b" ".join(s) + b" " for s in sequences]
    while n <= i and any(b" " + b" ".join(text[i - n : i + 1]) + b" " in s for s in whole):
        n += 1
    return n


@settings(max_examples=60, deadline=None)
@given(st.lists(FRAGMENT, max_size=7).map(" . ".join))
def test_matching_statistics_and_phrases(text):
    auto = licences.automaton()
    words = [w.encode() for w in WORD.findall(text.translate(LOWER))]
    assert words == licences.words(text)
    places, matches = auto.scan(words)
    expected = sorted((i, k) for k, p in enumerate(licences.PHRASES) for n in [len(p.split())] for i in range(len(words) - n + 1) if words[i : i + n] == p.encode().split())
    assert sorted(places) == expected
    sequences = auto.texts + [p.encode().split() for p in licences.PHRASES]
    lengths = [longest(sequences, words, i) for i in range(len(words))]
    ends = {(i - n + 1, n) for i, n in enumerate(lengths) if n >= licences.LEAST and (i + 1 == len(words) or lengths[i + 1] <= n)}
    assert {(a, n) for a, n, _ in matches} == ends


def test_labels_of_whole_and_damaged_templates():
    auto = licences.automaton()
    for label, template in licences.TEMPLATES:
        words = licences.words("Intro words. " + template + " End words.")
        assert label in {s[0] for s in auto.spans(auto.scan(words)[1])}
    name, long = max(licences.TEMPLATES, key=lambda t: len(t[1]))
    long = long.split()
    damaged = " ".join(long[:20] + ["inserted", "words"] + long[20:60] + long[63:])
    spans = auto.spans(auto.scan(licences.words(damaged))[1])
    assert name in {s[0] for s in spans} and all(s[3] <= 1 for s in spans)
    assert not auto.spans(auto.scan(licences.words("the software is provided to you under the terms of a contract"))[1])


def test_cases(spark):
    rows = [(1, "The MIT License and CC BY.", 1), (1, "The MIT License and CC BY.", 1), (2, None, 2), (3, "", 3), (None, "Released under the MIT License.", 4), (4, "of the " * 100_000 + "apache license", 5)]
    got = {(r["doc_id"], r["n_words"]): r for r in licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string, labels int")).collect()}
    assert len(got) == 5
    one = got[(1, 6)]
    assert (one["n_base"], one["first_word"], one["last_word"], one["base_labels"]) == (2, 1, 4, "cc-by,mit")
    assert got[(2, 0)]["first_word"] is None and got[(2, 0)]["labels"] == "" and got[(2, 0)]["score"] == 0
    assert got[(None, 5)]["labels"] == "MIT,mit" and got[(None, 5)]["score"] == 1
    assert got[(4, 200_002)]["first_word"] == 200_000
    assert licences.scan(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def slow_chains(auto, text):
    """Chains by comparing every pair of maximal matches, places of runs found by looking at every place."""
    out = []
    for t, template in enumerate(auto.texts):
        sequences = [*auto.texts, *(p.encode().split() for p in licences.PHRASES)]
        lengths = [longest(sequences, text, i) for i in range(len(text))]
        runs = [(i - n + 1, n) for i, n in enumerate(lengths) if n >= licences.LEAST and (i + 1 == len(text) or lengths[i + 1] <= n)]
        found = [(a, p, n) for a, n in runs for p in range(len(template) - n + 1) if template[p : p + n] == text[a : a + n]]
        best = []
        for j, (at, place, n) in enumerate(found):
            choices = [(n, -at)]
            for i, (a, p, m) in enumerate(found[:j]):
                shared = max(0, a + m - at, p + m - place)
                if a < at and p < place and at - a - m <= licences.GAP and shared < n:
                    choices.append((best[i][0] + n - shared, best[i][1]))
            best.append(max(choices))
            share = min(1.0, best[j][0] / len(template))
            if share >= licences.COVER:
                out.append((auto.labels[t], -best[j][1], at + n, share))
    return out


def test_spans_and_score_against_plain_python():
    rng = random.Random(8)
    templates = [("A", "a b c d e f g h i j k l"), ("A", "a b c d a b c d a b c d"), ("B", "d c b a e f g h x y z"), ("C", "a b c d e f g h i j k l m n o p q r s t u v w x y z"), ("D", "e f g h i j k l")]
    auto = licences.Automaton(templates)
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 14)):
            w = rng.choice(templates)[1].split()
            a = rng.randint(0, len(w) - 4)
            parts += w[a : a + rng.randint(4, 9)] + ["noise"] * rng.choice([0, 0, 1, 3, 20, 24, 25])
        text = licences.words(" ".join(parts))
        matches = auto.scan(text)[1]
        chains = slow_chains(auto, text)
        assert sorted(auto.chains(matches)) == sorted(chains)
        inner = lambda s: any(o[1] <= s[1] and s[2] <= o[2] and o[1:3] != s[1:3] for o in chains)  # noqa: B023, E731
        assert sorted(auto.spans(matches)) == sorted({s for s in chains if not inner(s)})
        single = max((min(1.0, n / len(t)) for a, n, _ in matches for t in auto.texts for p in range(len(t) - n + 1) if t[p : p + n] == text[a : a + n]), default=0.0)
        assert auto.best_share(matches) == max([single, *(c[3] for c in chains)])


def test_no_match_is_out_of_reach():
    """A chain goes on over any number of matches that end near: here over a hundred that are places of another run."""
    run = "q w e r " * 60
    auto = licences.Automaton([("long", run + " ".join(f"t{i}" for i in range(60)))])
    text = licences.words(run + " ".join(f"t{i}" for i in range(60)))
    assert auto.spans(auto.scan(text)[1]) == [("long", 0, len(text), 1.0)]


def test_one_word_phrases():
    auto = licences.Automaton([("x", "a b c d e")], {"gpl": "gpl", "mit license": "mit"})
    assert sorted(auto.scan(licences.words("GPL or the GPL, mit license; gpl"))[0]) == [(0, 0), (3, 0), (4, 1), (6, 0)]


def test_a_licence_within_a_longer_one():
    auto, text = licences.automaton(), dict(licences.TEMPLATES)
    labels = lambda x: {s[0] for s in auto.spans(auto.scan(licences.words(x))[1])}
    assert labels("x " + text["BSD-3-Clause"] + " y") == {"BSD-3-Clause"} and labels(text["BSD-2-Clause"]) == {"BSD-2-Clause"}
    assert labels(text["BSD-2-Clause"] + " some words between the two " + text["MIT"]) == {"BSD-2-Clause", "MIT"}


def test_whole_texts_from_a_folder(spark, tmp_path):
    folder = Path("/usr/share/common-licenses")
    if not (folder / "Apache-2.0").exists():
        pytest.skip("no folder of licence texts here")
    for name in ("Apache-2.0", "MPL-2.0", "GPL-2"):
        (tmp_path / f"{name}-whole.txt").write_text((folder / name).read_text())
    found = licences.read_templates(str(tmp_path))
    docs = [(i, f"intro words {text} closing words") for i, (_, text) in enumerate(found)] + [(9, found[0][1][: len(found[0][1]) // 2])]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(docs, "doc_id bigint, text string"), templates=found).collect()}
    assert all(found[i][0] in got[i]["labels"] and got[i]["score"] == 1 for i in range(3))
    assert "Apache-2.0-whole" not in got[9]["labels"]
