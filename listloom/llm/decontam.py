"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

index() stores a posting (document, position, term) for the training tokens that a test term can meet. A test item is
asked for by its rarest terms: in every distinct window of consecutive words the rarest three are found by their
frequencies; these terms and the distances between them are the window's pattern. The posting lists of a pattern are
shifted by the distances and intersected, rarest first, and what is left, a place in a document, is compared word by word
with the pattern's windows. Neighbouring windows mostly share their rarest terms, so a whole passage costs a few postings
and not one for each of its windows; and repeated words make no more windows, so the work is linear in documents and items.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listloom.llm.common import shared_folder, stored

WINDOW = 13
#: Terms of a window whose posting lists are intersected.
RAREST = 3
#: Runs of digits, lower-case ASCII letters and characters beyond ASCII are words.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A document is contaminated if this many times its hit words are at least its words.
SHARE = 20


def words(text: str | Column) -> Column:
    """The words of a text, A-Z lower-cased; none for null."""
    t = F.col(text) if isinstance(text, str) else text
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))  # lower() has a fast way for ASCII
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def keys(doc_id: str, text: str) -> list[Column]:
    """(d, h), by which a document is known: its id, 0 if null, and a hash of its text. What is found depends on the text alone, so documents with equal keys have equal results."""
    return [F.coalesce(F.col(f"`{doc_id}`").cast("bigint"), F.lit(0)).alias("d"), F.xxhash64(F.col(f"`{text}`")).alias("h")]


@dataclass
class Index:
    """heads: (doc_id, d, h, n_words), a row for each document row. postings: (d, h, pos, tid). terms: (tid, term, df)."""

    heads: DataFrame
    postings: DataFrame
    terms: DataFrame


def index(docs: DataFrame, vocabulary: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> Index:
    """The positional index of docs, stored in the shared folder.

    vocabulary: (term), to which postings are limited; None indexes every term. It is joined by whatever way fits its
    size: Spark broadcasts it below its threshold and shuffles beyond. Postings are written as they are read, without a
    shuffle, so those of a document lie together and compress well.
    """
    folder = shared_folder(docs.sparkSession)
    base = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), *keys(doc_id, text), words(f"`{text}`").alias("words"))
    if vocabulary is None:
        vocabulary = base.select(F.explode("words").alias("term"))
    named = vocabulary.select("term").distinct().withColumn("tid", F.monotonically_increasing_id())
    terms = stored(named.unionByName(docs.sparkSession.createDataFrame([("", -1)], "term string, tid bigint")), f"{folder}/terms")
    # The empty string in front stands for the document itself: its posting, at 0, carries the number of words.
    rows = base.select("doc_id", "d", "h", F.size("words").cast("bigint").alias("n"), F.posexplode(F.concat(F.array(F.lit("")), F.col("words"))).alias("pos", "term"))
    head = F.col("tid") == -1
    found = rows.join(terms, "term").select(F.when(head, F.col("doc_id")).alias("doc_id"), "d", "h", (F.col("pos") - 1).alias("pos"), "tid", F.when(head, F.col("n")).alias("n"))
    found = stored(found, f"{folder}/postings")
    postings = found.where("tid >= 0").select("d", "h", "pos", "tid")
    df = postings.groupBy("tid").agg(F.count("*").alias("df"))
    return Index(found.where("tid = -1").select("doc_id", "d", "h", F.col("n").alias("n_words")), postings, stored(terms.join(df, "tid"), f"{folder}/df"))


@dataclass
class Windows:
    """distinct: (wid, w, size, item_ids), a row for each distinct window, its words, and the items that have it. places: (wid, item_id, at), where items have it."""

    distinct: DataFrame
    places: DataFrame

    def vocabulary(self) -> DataFrame:
        return self.distinct.select(F.explode("w").alias("term"))


def windows(items: DataFrame, window: int = WINDOW) -> Windows:
    """The windows of items (item_id, text). An item of fewer words, but not none, is one window. Equal items are windowed once."""
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("words")).where(F.size("words") > 0)
    once = stored(texts.groupBy("words").agg(F.collect_set("item_id").alias("ids")))
    size = F.least(F.size("words"), F.lit(window))
    each = once.select("words", "ids", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at"))
    each = each.select(F.slice("words", F.col("at") + 1, F.col("size")).alias("w"), "ids", "at")
    named = each.groupBy("w").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"))
    named = stored(named.select(F.monotonically_increasing_id().alias("wid"), "w", F.size("w").alias("size"), "item_ids"))
    return Windows(named, each.join(named.select("w", "wid"), "w").select("wid", F.explode("ids").alias("item_id"), "at"))


@dataclass
class Patterns:
    """places: (pid, nth, off, tid), the terms of each pattern, rarest first, by their distance from the rarest. windows: (pid, wid, k), a pattern's windows and where the rarest term stands in them."""

    places: DataFrame
    windows: DataFrame


def patterns(asked: Windows, terms: DataFrame, count: int = RAREST) -> Patterns:
    """The patterns of the count rarest terms of each window. A window with a term that has no posting is left out."""
    each = asked.distinct.select("wid", "size", F.posexplode("w").alias("k", "term")).join(terms, "term")
    by_window = each.groupBy("wid", "size").agg(F.sort_array(F.collect_list(F.struct("df", "tid", "k"))).alias("x")).where(F.size("x") == F.col("size"))
    first = F.col("x")[0]["k"]
    shape = F.transform(F.slice("x", 1, count), lambda x: F.struct((x["k"] - first).alias("off"), x["tid"].alias("tid")))
    shaped = stored(by_window.select("wid", first.alias("k"), shape.alias("shape")))
    named = stored(shaped.select("shape").distinct().withColumn("pid", F.monotonically_increasing_id()))
    places = named.select("pid", F.posexplode("shape").alias("nth", "x")).select("pid", "nth", "x.off", "x.tid")
    return Patterns(stored(places), stored(shaped.join(named, "shape").select("pid", "wid", "k")))


def aligned(found: Index, asked: Patterns, count: int = RAREST, slop: int = 0) -> DataFrame:
    """(d, h, pid, pos): where in documents a pattern's rarest term stands with all the others in their places.

    slop lets each further term stand so many words off its place: proximity instead of a phrase.
    """
    nth = lambda k: asked.places.where(F.col("nth") == k).select("pid", "off", "tid")
    left = found.postings.join(nth(0), "tid").select("d", "h", "pid", "pos")
    for k in range(1, count):
        step = nth(k)
        wanted = left.join(step, "pid").withColumn("at", F.col("pos") + F.col("off"))
        if slop:
            wanted = wanted.withColumn("at", F.explode(F.sequence(F.col("at") - slop, F.col("at") + slop)))
        lists = found.postings.join(step.select("tid").distinct(), "tid", "left_semi").withColumnRenamed("pos", "at")
        met = wanted.join(lists, ["d", "h", "tid", "at"], "left_semi").select(*left.columns)
        left = stored(met.unionByName(left.join(step.select("pid"), "pid", "left_anti").select(*left.columns)).distinct())
    return left


def exact(candidates: DataFrame, asked: Windows, by: Patterns, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, h, n_hit, items): words inside any occurrence of a window, and the ids of items with one, by comparing words.

    Candidates are gathered by document as numbers only. Each document with some is read once more and gives the words at
    its candidates' places, row by row, to be compared with the windows'; what is equal is gathered as spans.
    """
    places = candidates.join(by.windows, "pid").select("d", "h", "wid", (F.col("pos") - F.col("k")).alias("at")).where("at >= 0")
    sized = places.join(asked.distinct.select("wid", "size"), "wid")
    of = stored(sized.groupBy("d", "h").agg(F.collect_list(F.struct("wid", "at", "size")).alias("c")))
    # the keys alone are small: while they can be broadcast, only texts with candidates are shuffled
    texts = docs.select(*keys(doc_id, text), F.col(f"`{text}`").alias("t")).join(stored(of.select("d", "h")), ["d", "h"], "left_semi")
    # lists of numbers compress too well to judge their size by the file: they are never broadcast
    both = texts.join(of.hint("merge"), ["d", "h"]).select("d", "h", "c", F.explode(F.array(words("t"))).alias("words"))  # explode(array(x)) is x, computed once
    read = F.transform("c", lambda x: F.struct(x["wid"].alias("wid"), x["at"].alias("begin"), (x["at"] + x["size"]).alias("end"), F.array_join(F.slice("words", x["at"] + 1, x["size"]), " ").alias("w")))
    same = both.select("d", "h", F.explode(read).alias("x")).select("d", "h", "x.*").join(asked.distinct.select("wid", "item_ids", F.array_join("w", " ").alias("w")), ["wid", "w"])
    met = same.groupBy("d", "h").agg(F.collect_set(F.struct("begin", "end")).alias("spans"), F.collect_set("item_ids").alias("ids"))
    zero = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto"))
    longer = lambda a, x: F.struct((a["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["begin"], a["upto"]))).alias("hit"), F.greatest(a["upto"], x["end"]).alias("upto"))
    hit = F.aggregate(F.sort_array("spans"), zero, longer, lambda a: a["hit"])
    return met.select("d", "h", hit.alias("n_hit"), F.array_sort(F.array_distinct(F.flatten("ids"))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, share: int = SHARE) -> DataFrame:
    """(doc_id, h, n_words, n_hit, n_items, items_sha256, contaminated) of every row of docs; items: (item_id, text).

    A null or empty text has no words and is clean; so is every row if no item has words. An item shorter than a window is
    one window, an item without words none. Equal items answer together. Rows without doc_id are judged like any other.
    Repeated rows give repeated results; other columns are left out. h is a hash of the text.
    """
    asked = windows(items, window)
    found = index(docs, asked.vocabulary(), doc_id, text)
    by = patterns(asked, found.terms)
    hits = exact(aligned(found, by), asked, by, docs, doc_id, text)
    n_hit, listed = F.coalesce("n_hit", F.lit(0)).cast("bigint"), F.coalesce("items", F.array().cast("array<string>"))
    out = found.heads.join(hits, ["d", "h"], "left").select("doc_id", "h", "n_words", n_hit.alias("n_hit"), listed.alias("items"))
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    return out.select("doc_id", "h", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), bad.alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs."""
    bad = contamination(docs, items, doc_id, text).where("contaminated").select(F.coalesce("doc_id", F.lit(0)).alias("__d"), F.col("h").alias("__h"))
    bad = stored(bad.distinct())  # its size is known then, and texts are only shuffled if it is too large to broadcast
    d, h = keys(doc_id, text)
    return docs.join(bad, (d == F.col("__d")) & (h == F.col("__h")), "left_anti")


def phrases(docs: DataFrame, items: DataFrame, slop: int = 0, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, count: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, shift): phrase matches of items' windows (slop 0), or proximity matches, where every one of a window's count rarest terms stands within slop words of its place. shift is where the item's first word would stand."""
    asked = windows(items, window)
    found = index(docs, asked.vocabulary(), doc_id, text)
    by = patterns(asked, found.terms, count)
    met = aligned(found, by, count, slop).join(by.windows, "pid").join(asked.places, "wid")
    ids = found.heads.select("doc_id", "d", "h").distinct()
    return met.join(ids, ["d", "h"]).select("doc_id", "item_id", (F.col("pos") - F.col("k") - F.col("at")).alias("shift")).distinct()
