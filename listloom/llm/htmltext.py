"""Main text of web pages by a linear-chain conditional random field over the DOM's leaf blocks.

A page is read once into leaf blocks, runs of text between block-level tags, each with the tags and class words of its
ancestors. The field has two states, main text or not; features of a block are its ancestors and measures of its text,
and neighbouring blocks are tied by transition weights. It is trained on labelled pages by stochastic gradient on the
exact likelihood (forward-backward) and decoded by Viterbi.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Callable, Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listloom.llm.common import map_texts

#: Elements that begin and end a block, elements without content, and elements whose content is no text.
BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Of these, the first are raw text to their end tag or the end of the page; the second are left out only where they are closed.
RAW, HIDDEN = "script|style|textarea|title", "iframe|noscript|object|select|svg|template"
#: Elements that an open p does not contain, and what else of its kind ends an open element.
ENDS_P = BLOCKS - frozenset("button label legend caption option summary".split())
ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements that such an end does not look beyond.
WALLS = frozenset("article aside body dl div footer form header html main menu nav ol section table td ul".split())
#: Attributes, and characters of a value, that the pattern of a tag takes; tags beyond are read by Reader.end_of_tag().
_VALUE = r"[^\"]{0,1000}+\"", r"[^']{0,1000}+'"
_ATTRIBUTES = r"((?:=\s{0,20}+(?:\"" + _VALUE[0] + "|'" + _VALUE[1] + r"|(?=[^\s\"'=]))|[^<>\"'=]++){0,60}+)>"
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)(?:" + _ATTRIBUTES + r")?|<[!?][^<>]*+>", re.S)
_STOP = re.compile(r"""[<>]|=\s*+(["'])""")
_HIDES = frozenset(HIDDEN.split("|"))
_RAW = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*+>", re.I) for name in RAW.split("|")}
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")

#: Text, features of the ancestors or their summed weight, innermost block tag, characters inside links.
Block = tuple[str, frozenset[str] | float, str, int]


class Reader:
    """The tags of a page, in order, in linear time whatever its markup. at is where it reads on, and may be set further; opened is where the last start tag ended."""

    def __init__(self, page: str):
        self.page, self.at, self.opened = page, 0, 0
        self._dead: set[int] = set()  # places inside a tag from which no end is reached
        self._none = {'"': len(page) + 1, "'": len(page) + 1}  # from where on there is no such quote
        self._unclosed: set[str] = set()  # raw elements that have no end tag any more

    def end_of_tag(self, at: int) -> int:
        """Where the tag that is open at a place ends, behind its ">"; -1 if it does not before the next "<" outside of values.

        A quote opens a value after "=" only, and only if another one closes it.
        """
        page, seen = self.page, []
        while at not in self._dead:
            seen.append(at)
            m = _STOP.search(page, at)
            if m is None or m[0] == "<":
                break
            if m[0] == ">":
                return m.end()
            at, quote = m.end(), m[1]
            if at < self._none[quote]:
                if (close := page.find(quote, at)) < 0:
                    self._none[quote] = at
                else:
                    at = close + 1
        self._dead.update(seen)
        return -1

    def tags(self) -> Iterator[tuple[int, int, str, bool, str]]:
        """(begin, end, name, whether it is an end tag, attributes). Comments and the contents of RAW elements are tags without a name."""
        page = self.page
        while m := _TOKEN.search(page, self.at):
            begin, end, name, attributes = m.start(), m.end(), m[2], m[3]
            if name is not None and attributes is None:
                if (stop := self.end_of_tag(end)) < 0:
                    self.at = begin + 1  # no tag, but text
                    continue
                attributes, end = page[end : stop - 1], stop
            name, self.opened = (name or "").lower(), end
            if name in _RAW and not m[1]:
                close = None if name in self._unclosed else _RAW[name].search(page, end)
                if close is None:
                    self._unclosed.add(name)
                name, attributes, end = "", f"{name} {attributes}", close.end() if close else len(page)
            self.at = end
            yield begin, end, name, bool(m[1]), attributes or ""


def hidden(page: str) -> dict[int, int]:
    """Where the elements of HIDDEN begin and end, those without an end tag left out. '<svg/>' is empty, and so are raw elements closed that way inside svg."""
    out: dict[int, int] = {}
    began: dict[str, list[int]] = {name: [] for name in _HIDES}
    reader = Reader(page)
    for begin, end, name, is_end, attributes in reader.tags():
        if not name and began["svg"] and attributes.endswith("/"):
            reader.at = reader.opened
        elif name in _HIDES:
            if is_end:
                if began[name]:
                    out[began[name].pop()] = end
            elif name == "svg" and attributes.endswith("/"):
                out[begin] = end
            else:
                began[name].append(begin)
    return out


def blocks(page: str, weights: dict[str, float] | None = None) -> list[Block]:
    """The leaf blocks of a page, in order. With weights, ancestors' features are summed by their weights, else they are a set."""
    out: list[Block] = []
    parts: list[str] = []
    linked, at = 0, 0
    ends: dict[int, int] | None = None
    # open elements: tag, its own features, and the features of it and those above it; and where each tag, blocks and walls are open
    stack: list[tuple[str, list[str], frozenset[str] | float]] = [("", [], frozenset() if weights is None else 0.0)]
    where: dict[str, list[int]] = {}
    open_blocks, open_walls = [0], [0]
    above: set[str] = set()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, stack[-1][2], stack[open_blocks[-1]][0], linked))
            parts.clear()
        linked = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            tag, own, _ = stack.pop()
            where[tag].pop()
            above.difference_update(own)
        while open_blocks[-1] >= depth:
            open_blocks.pop()
        while open_walls[-1] >= depth:
            open_walls.pop()

    def innermost(tags: tuple[str, ...]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    reader = Reader(page)
    for begin, end, tag, is_end, attributes in reader.tags():
        if begin > at:
            parts.append(page[at:begin])
            if where.get("a"):
                linked += begin - at
        at = end
        if not tag:
            continue
        if tag in _HIDES and not is_end:
            if ends is None:
                ends = hidden(page)
            at = reader.at = ends.get(begin, at)
            continue
        if tag in EMPTY:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            continue
        block = tag in BLOCKS
        if block:
            flush()
        if not is_end:
            if tag in ENDS_P:
                if (i := innermost(("p",))) and i >= open_walls[-1]:
                    close(i)
            if tag in ENDS:
                if (i := innermost(ENDS[tag])) and i >= open_walls[-1]:
                    close(i)
            new = {f"<{tag}"} if block else set()
            if attributes:
                for names in _NAMES.findall(attributes):
                    new.update(_WORD.findall("".join(names).lower()))
            own = sorted(new - above) if new else []
            known = stack[-1][2]
            if own:
                above.update(own)
                known = known | frozenset(own) if weights is None else known + sum(weights.get(f, 0.0) for f in own)
            where.setdefault(tag, []).append(len(stack))
            if block:
                open_blocks.append(len(stack))
            if tag in WALLS:
                open_walls.append(len(stack))
            stack.append((tag, own, known))
        elif (i := innermost((tag,))) and (block or i > open_blocks[-1]):  # an inline end tag does not close blocks
            close(i)
    if at < len(page):
        parts.append(page[at:])
    flush()
    return out


def features(block: Block) -> list[str]:
    """Features of a block's text, without those of its ancestors."""
    text, _, inner, linked = block
    n = text.count(" ") + 1
    out = [f"={inner}", f"#{min(6, int(math.log2(n)))}", f"%{min(4, 4 * linked // max(len(text), 1))}"]
    if text[-1] in ".!?…\"'”»":
        out.append("ends")
    return out


class Field:
    """A chain of two states. weights: feature to its weight for main text; tie[a][b]: weight of state b after a."""

    def __init__(self, weights: dict[str, float] | None = None, tie: list[list[float]] | None = None):
        self.weights = weights or {}
        self.tie = tie or [[0.0, 0.0], [0.0, 0.0]]

    def score(self, block: Block) -> float:
        above = block[1]
        if not isinstance(above, float):
            above = sum(self.weights.get(f, 0.0) for f in above)
        return above + sum(self.weights.get(f, 0.0) for f in features(block))

    def decode(self, page: list[Block]) -> list[bool]:
        """The likeliest states, by Viterbi; of equal ones, the one with less main text at the end."""
        if not page:
            return []
        (a, b), (c, d) = self.tie
        no, yes, back = 0.0, self.score(page[0]), []
        for block in page[1:]:
            s = self.score(block)
            from_no, from_yes = yes + c > no + a, yes + d > no + b
            back.append((from_no, from_yes))
            no, yes = (yes + c if from_no else no + a), (yes + d if from_yes else no + b) + s
        state = yes > no
        out = [state]
        for from_no, from_yes in reversed(back):
            state = from_yes if state else from_no
            out.append(state)
        return out[::-1]

    def train(self, pages: list[tuple[list[Block], list[bool]]], rounds: int = 15, rate: float = 0.3, decay: float = 1e-4, seed: int = 0) -> Field:
        """Stochastic gradient on the log-likelihood of whole pages, with L2 decay."""
        rng = random.Random(seed)
        pages = [([[*sorted(b[1]), *features(b)] for b in page], truth) for page, truth in pages if page]
        for r in range(rounds):
            rng.shuffle(pages)
            step = rate / (1 + r / 4)
            for page, truth in pages:
                self._step(page, truth, step, decay)
        return self

    def _step(self, page: list[list[str]], truth: list[bool], step: float, decay: float) -> None:
        weights, tie = self.weights, self.tie
        scores = [sum(weights.get(f, 0.0) for f in fs) for fs in page]
        e = [[math.exp(x) for x in row] for row in tie]
        forward = []
        p, q = 1.0, math.exp(max(-30.0, min(30.0, scores[0])))
        for i, s in enumerate(scores):
            if i:
                p, q = p * e[0][0] + q * e[1][0], (p * e[0][1] + q * e[1][1]) * math.exp(max(-30.0, min(30.0, s)))
            z = p + q
            p, q = p / z, q / z
            forward.append((p, q))
        u, v = 1.0, 1.0
        for i in range(len(page) - 1, -1, -1):
            p, q = forward[i]
            main = q * v / (p * u + q * v)
            gradient = (1.0 if truth[i] else 0.0) - main
            for f in page[i]:
                w = weights.get(f, 0.0)
                weights[f] = w + step * (gradient - decay * w)
            if i:
                x = math.exp(max(-30.0, min(30.0, scores[i])))
                a, b = forward[i - 1]
                joint = [[a * e[0][0] * u, a * e[0][1] * x * v], [b * e[1][0] * u, b * e[1][1] * x * v]]
                z = sum(map(sum, joint))
                for j in (0, 1):
                    for k in (0, 1):
                        tie[j][k] += step * ((truth[i - 1] == bool(j) and truth[i] == bool(k)) - joint[j][k] / z)
                u, v = e[0][0] * u + e[0][1] * x * v, e[1][0] * u + e[1][1] * x * v
                z = u + v
                u, v = u / z, v / z


def labelled_pages(count: int = 360, seed: int = 0) -> list[tuple[str, list[bool]]]:
    """Pages composed by chance from the usual parts, with a label for each leaf block: the training set of model().

    Each part is written once, with its label; main text lies in one of several containers.
    """
    rng = random.Random(seed)
    syllables = "al be cor da en fi gra ho in ka lum mo ne or pra qui ros ta un ver".split()
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    line = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: line(4, 18).capitalize() + rng.choice([".", ".", ".", "!", "?", ""])
    prose = lambda: " ".join(sentence() for _ in range(rng.randint(1, 6)))
    link = lambda: f'<a href="/{word()}">{line(1, 4)}</a>'

    def links(least: int = 3) -> tuple[str, int]:
        n = rng.randint(least, 8)
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>", n

    def named(*names: str) -> str:
        """An opening tag's attribute."""
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"'

    def boilerplate(*kinds: int) -> tuple[str, int]:
        listed, n = links()
        kind = rng.choice(kinds or range(12))
        if kind == 0:
            return f"<nav{rng.choice(['', named('menu', 'nav main', 'navbar')])}>{listed}</nav>", n
        if kind == 1:
            return f"<header{rng.choice(['', named('site-header', 'top header', 'masthead')])}><h1>{line(1, 4)}</h1><p>{line(2, 9)}</p></header>", 2
        if kind == 2:
            return f"<footer{rng.choice(['', named('footer', 'site-footer')])}>&copy; {line(1, 3)} &middot; {rng.choice([sentence(), prose()])}</footer>", 1
        if kind == 3:
            return f"<aside{rng.choice(['', named('sidebar', 'widget')])}><h3>{line(1, 4)}</h3><p>{prose()}</p></aside>", 2
        if kind == 4:
            return f"<div{named('sidebar', 'side-bar widget', 'related', 'related-posts', 'recommended', 'menu', 'breadcrumb', 'pagination', 'social share', 'tags')}><h4>{line(1, 3)}</h4>{listed}</div>", n + 1
        if kind == 5:
            return f"<div{named('ad', 'ads', 'ad-banner', 'advert', 'advertisement', 'sponsored', 'promo')}>{rng.choice([sentence(), prose()])}</div>", 1
        if kind == 6:
            said, button = rng.choice(["We use cookies. ", ""]) + rng.choice([prose(), sentence(), line(1, 4)]), rng.choice([f"<button>{line(1, 2)}</button>", ""])
            return f"<div{named('cookie-notice', 'notice', 'cookie consent', 'alert', 'banner notice', 'popup')}>{rng.choice([f'<p>{said}</p>', said])}{button}</div>", 1 + bool(button)
        if kind == 7:
            return f"<form{rng.choice(['', named('search', 'newsletter', 'subscribe')])}><label>{line(1, 4)}</label><input type=\"text\"><p>{prose()}</p><button>{line(1, 2)}</button></form>", 3
        if kind in (8, 9):
            m = rng.randint(1, 4)
            box = rng.choice(["div", "section", "div"])
            named_box = f"{box}{named('comments', 'comment-list', 'reader comments', 'respond', 'discussion')}"
            if rng.random() < 0.3:
                return f"<{named_box}><h3>{line(1, 3)}</h3>" + "".join(f"<p>{rng.choice([prose(), sentence()])}</p>" for _ in range(m)) + f"</{box}>", m + 1
            said = "".join(f'<div class="comment"><p>{line(1, 2)}</p><p>{prose()}</p></div>' for _ in range(m))
            return f"<{named_box}><h3>{line(1, 3)}</h3>{said}</{box}>", 2 * m + 1
        if kind == 10:
            tag = rng.choice(["p", "p", "h1", "h2"])
            return f"<div{named('footer', 'copyright', 'legal', 'header', 'top-bar', 'disclaimer')}><{tag}>{rng.choice([sentence(), prose(), line(1, 4)])}</{tag}></div>", 1
        return f"<menu>{listed}</menu>", n

    def main() -> tuple[str, list[bool]]:
        parts, truth = [f"<h1>{line(2, 9)}</h1>"], [True]
        for _ in range(rng.randint(1, 9)):
            kind = rng.randrange(17)
            if kind == 0:
                tag = rng.choice(["h2", "h2", "h3", "h4"])
                part, good = f"<{tag}>{line(1, 6)}</{tag}>", [True]
            elif kind == 1:
                n = rng.randint(2, 5)
                part, good = "<ul>" + "".join(f"<li>{rng.choice([line(1, 5), sentence()])}</li>" for _ in range(n)) + "</ul>", [True] * n
            elif kind == 2:
                part, good = f"<blockquote><p>{prose()}</p></blockquote>", [True]
            elif kind == 3:
                part, good = f"<table><tr><td>{line(1, 3)}</td><td>{line(1, 5)}</td></tr></table>", [True, True]
            elif kind in (4, 6, 14, 15, 16):
                part, n = boilerplate(1, 2, 3, 4, 5, 5, 6, 6, 7, 8, 8, 9, 9, 10)
                good = [False] * n
            elif kind == 5:
                part, good = f"<pre>{line(3, 20)}</pre>", [True]
            else:
                part, good = f"<p>{rng.choice(['', '<b>'])}{rng.choice([prose(), prose(), sentence(), line(1, 3)])}{rng.choice(['', '<br>', ' ' + link()])}{rng.choice(['</p>', ''])}", [True]
            parts.append(part)
            truth += good
        box = rng.choice([("<article>", "</article>")] * 3 + [("<main>", "</main>"), (f"<div{named('content', 'post-content', 'entry', 'article-body', 'post body', 'story')}>", "</div>"), (f"<section{named('article', 'content', 'main')}>", "</section>"), ("<main><article>", "</article></main>")])
        return box[0] + "".join(parts) + box[1], truth

    out = []
    for _ in range(count):
        before, after = [boilerplate() for _ in range(rng.randint(1, 4))], [boilerplate() for _ in range(rng.randint(1, 4))]
        text, truth = main()
        wrapped = rng.choice([("", ""), ('<div class="page"><div class="wrapper">', "</div></div>"), ('<div id="container">', "</div>")])
        page = "<html><head><title>" + line(2, 6) + "</title></head><body>" + wrapped[0] + "".join(p for p, _ in before) + text + "".join(p for p, _ in after) + wrapped[1] + "</body></html>"
        out.append((page, [False] * sum(n for _, n in before) + truth + [False] * sum(n for _, n in after)))
    return out


@cache
def model() -> Field:
    """The field trained on labelled_pages()."""
    return Field().train([(blocks(page), truth) for page, truth in labelled_pages()])


def main_text(page: str, field: Field) -> str:
    found = blocks(page, field.weights)
    return "\n\n".join(b[0] for b, good in zip(found, field.decode(found), strict=True) if good)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row: blocks of main text joined by two newlines.

    A null or empty page, or one without main text, gives an empty text. Broken markup is read like browsers do as far as
    leaf blocks go: unclosed elements end with their parents. Repeated rows give repeated results; other columns are left
    out. Pages of any length are read in linear time.
    """
    field = field or model()
    state = (field.weights, field.tie)

    def rows() -> Callable[[list], list[tuple]]:
        own = Field(*state)

        def do(texts: list) -> list[tuple]:
            found = [main_text(x, own) if x else "" for x in texts]
            return [(x, len(x)) for x in found]

        return do

    out = map_texts(pages, html, [page_id, url], "text string, n_chars bigint", rows)
    return out.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), "text", "n_chars")
