import time

from listloom.llm import htmltext as h


def test_blocks():
    page = "<!DOCTYPE html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body class=x><p>a <b>b</b>\n&amp;&nbsp;c<br>d<p>e<ul><li>f<li><a href='x>y'>g</a></ul>tail<!-- c --> end<table><td>1<td>2</table>"
    assert [b[0] for b in h.blocks(page)] == ["a b & c d", "e", "f", "g", "tail end", "1", "2"]
    assert h.blocks("") == [] and h.blocks("plain < text & more")[0][0] == "plain < text & more"
    assert h.blocks("<p>x&am")[0][0] == "x&am" and h.blocks("<script>never ends <p>x") == []


def test_held_out_accuracy():
    field, right, total = h.model(), 0, 0
    for page, truth in h.labelled_pages(150, seed=77):
        got = field.decode(h.blocks(page))
        assert len(got) == len(truth)
        right, total = right + sum(a == b for a, b in zip(got, truth, strict=True)), total + len(truth)
    assert right >= 0.98 * total


def test_viterbi_is_the_best_path():
    from itertools import product

    field = h.model()
    for page, _ in h.labelled_pages(20, seed=5):
        blocks = h.blocks(page)[:9]
        scores = [field.score(b) for b in blocks]
        value = lambda path: sum(s for s, x in zip(scores, path, strict=True) if x) + sum(field.tie[a][b] for a, b in zip(path, path[1:], strict=False))  # noqa: B023, E731
        assert abs(value(field.decode(blocks)) - max(map(value, product((False, True), repeat=len(blocks))))) < 1e-9


def test_malformed_pages_are_linear():
    began = time.time()
    for page in ("<" * 300_000, '<a "' * 80_000, "<div>" * 30_000 + "x", "<i>" * 30_000 + "</b>" * 30_000, "<script" * 50_000, "<a '<a \"" * 40_000, "<!-- " * 50_000):
        h.main_text(page, h.model())
    assert time.time() - began < 20


def test_cases(spark):
    page = "<body><nav><ul><li><a href=/>Home</a></ul></nav><article><h1>Title here</h1><p>Some  text\nis here.</p><p>End.</p><div class=comments><p>Me</p><p>I say so, and more.</p></div></article><footer>&copy; x</footer>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (3, "v", ""), (None, "w", "<nav>a</nav>"), (4, "x", "<article>" + "<p>word and word.</p>" * 20_000)]
    got = [tuple(r) for r in h.extract(spark.createDataFrame([(*r, 1) for r in rows], "page_id bigint, url string, html string, text int")).collect()]
    text = "Title here\n\nSome text is here.\n\nEnd."
    by = {g[0]: g for g in got}
    assert len(got) == 6 and by[1][2:] == (text, len(text)) and by[2][2:] == ("", 0) and by[3][2:] == ("", 0) and by[None][2:] == ("", 0)
    assert by[4][3] == len("word and word.") * 20_000 + 2 * 19_999
    assert h.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_hidden_elements_end_where_they_end():
    texts = lambda page: [b[0] for b in h.blocks(page)]
    rest = "<article><p>one</p><p>two</p></article>"
    for tag in ('<svg class="i"/>', "<svg />", "<select-box/>", "<svg>", "<object data=x>", "<select>", "<template>", "<iframe src=x>", "<noscript>", "<svg><p/><svg>x</svg>", "</svg>"):
        got = texts(f"<nav>menu</nav>{tag}{rest}")
        assert got[0] == "menu" and got[-2:] == ["one", "two"], tag
    assert texts("<title-bar>x</title-bar><style-x>y</style-x>") == ["xy"]
    assert texts(f"<svg class=a>{rest}<svg><title/><path d=''/></svg><p>three") == ["one", "two", "three"]
    for tag in ("iframe", "noscript", "object", "select", "svg", "template", "script", "style", "textarea", "title"):
        assert texts(f"<p>a<{tag} x='y'>gone</{tag} >{rest}") == ["a", "one", "two"], tag
    assert texts("<object>x<object>y</object>z</object>w") == ["w"] and texts("<svg><!-- </svg> -->x</svg>y") == ["y"]
    for tag in ("script", "style", "textarea", "title"):
        assert texts(f"<p>a</p><{tag}>{rest}") == ["a"], tag
    began = time.time()
    for page in ("<svg>" * 60_000, "<svg/>" * 60_000, "<select>" * 60_000 + "</select>" * 30_000):
        h.blocks(page)
    assert time.time() - began < 20


def test_nothing_is_capped():
    """Tags with any number of attributes, values of any length, elements of any depth, and names of any number."""
    texts = lambda page: [b[0] for b in h.blocks(page)]
    many = " ".join(f'a{i}="v > {i}"' for i in range(2000))
    assert texts(f"<p {many}>x</p>") == ["x"]
    assert texts("<p data-x='" + "d > e < f " * 1000 + "'>x</p><p title=\"" + "'" * 3000 + "\">y") == ["x", "y"]
    assert texts("<script data-x='a<b'>code()</script><p>x") == ["x"] and texts("<p>a <b then c</p>") == ["a <b then c"]
    assert texts('<p title="never closed>x</p><p>y') == ["x", "y"] and texts("<p a='>x</p><p b=\">y</p>") == ["x", "y"]
    deep = "<i>" * 2000
    inside = h.blocks(f"<article><nav>{deep}<p>a{'</i>' * 2000}</nav><p>b</article><p>c")
    assert [(b[0], "<nav" in b[1], "<article" in b[1]) for b in inside] == [("a", True, True), ("b", False, True), ("c", False, False)]
    names = "".join(f'<div class="w{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}q">' for i in range(600)) + '<div class="comments"><p>said</p>'
    assert "comments" in h.blocks(names)[0][1]
    assert h.main_text(f"<article><p>Some words here.</p>{names}", h.model()) == "Some words here."
    (block,) = h.blocks("<ul><li><a href=x>open link<li>not linked at all, this one")[1:]
    assert block[3] == 0


def test_fast_and_exact_tags_agree():
    """The pattern and the reader behind it end a tag at the same place, wherever the pattern finds an end."""
    import random

    rng = random.Random(4)
    for _ in range(3000):
        page = "<a" + "".join(rng.choice([" ", "=", '"', "'", ">", "<", "x", "= ", "/", "b"]) for _ in range(rng.randint(1, 25)))
        m = h._TOKEN.match(page)
        if m and m[3] is not None:
            assert h.Reader(page).end_of_tag(m.end(2)) == m.end(), page


def test_weights_are_summed_as_sets_are():
    field = h.model()
    for page, _ in h.labelled_pages(30, seed=11):
        plain, summed = h.blocks(page), h.blocks(page, field.weights)
        assert [b[0] for b in plain] == [b[0] for b in summed]
        assert all(abs(field.score(a) - field.score(b)) < 1e-9 for a, b in zip(plain, summed, strict=True))


def test_markup_of_any_kind_is_read_in_linear_time():
    began = time.time()
    for page in ('<a x="' * 60_000, "<a x='<a y=\"" * 40_000, '<p x="1" ' * 60_000, "<b><div>" + "<i>" * 40_000 + "</b>" * 40_000, "<p a=" + " " * 300_000, "<ul><li>" * 20_000 + "<p>" * 20_000, "".join(f"<div class=n{chr(97 + i % 26) * (i % 90 + 1)}>" for i in range(30_000)) + "x", "<svg><title/>" * 30_000):
        h.main_text(page, h.model())
    assert time.time() - began < 30


def test_pages_written_by_hand():
    from pages_by_hand import PAGES

    assert len(PAGES) >= 20
    for page, expected in PAGES:
        assert h.main_text(page, h.model()) == "\n\n".join(expected), page
