"""Language identification by compression.

Each language has a zstandard dictionary of raw content, a bounded sample of its labelled texts. A text is reduced to
lower-case letters and encoded, in blocks, with every dictionary; the smallest code names the language. Where the two
smallest are too close the answer is not accepted.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import cache

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listloom.llm.common import map_texts, stored

UNDETERMINED = "und"
#: Bounds of the labelled rows that are learned from: distinct texts of each language, and characters of each. Texts of at
#: least and at most so many characters come first; where a language has too few of them, shorter ones and the beginnings
#: of longer ones follow.
TEXTS, LENGTHS = 400, (100, 8000)
#: Bytes of a language's dictionary, and of all: with more languages than fit, each has a smaller one, but of the least size.
DICTIONARY, DICTIONARIES, LEAST_DICTIONARY = 64 << 10, 16 << 20, 4 << 10
#: Bytes encoded at a time: a block is too short to become its own dictionary.
BLOCK = 2048
#: Least relative gap between the two smallest codes of an accepted answer.
MARGIN = 0.01


class _Letters(dict):
    """For str.translate: a code point of a letter, or of a mark, which is part of a letter in many scripts, stays; any other is a space."""

    def __missing__(self, point: int) -> int:
        self[point] = point if unicodedata.category(chr(point))[0] in "LM" else 0x20
        return self[point]


_LETTERS = _Letters()


def letters(text: str) -> bytes:
    """The text as words of lower-case letters, in UTF-8; empty if it has no letter."""
    found = " ".join(text.lower().translate(_LETTERS).split())
    return found.encode("utf-8", "replace") if found[:1].isalpha() or any(map(str.isalpha, found)) else b""


class Model:
    """Compressors by language, the most frequent first: of equal codes the more frequent language's counts."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]):
        self.languages = [name for name, _ in samples]
        params = zstandard.ZstdCompressionParameters(
            window_log=17, hash_log=15, chain_log=14, search_log=2, min_match=4, target_length=0,
            strategy=zstandard.STRATEGY_GREEDY, write_checksum=False, write_content_size=False, write_dict_id=False,
        )
        self.compress = []
        for _, content in samples:
            content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=params)
            self.compress.append(zstandard.ZstdCompressor(compression_params=params, dict_data=content).compress)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, relative gap of the two smallest codes, accepted)."""
        data = letters(text) if text else b""
        if not data or not self.languages:
            return UNDETERMINED, 0.0, False
        blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
        sizes = [sum(map(len, map(c, blocks))) for c in self.compress]
        best = min(sizes)
        k = sizes.index(best)
        second = min(sizes[:k] + sizes[k + 1 :], default=0)
        gap = (second - best) / second if second else 1.0
        return self.languages[k], gap, gap >= MARGIN


@cache
def model(samples: tuple[tuple[str, bytes], ...]) -> Model:
    return Model(samples)


def bucket(doc_id: str) -> Column:
    """crc32 of the id as text, modulo 5: remainder 0 is held out; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{doc_id}`").cast("string")), F.lit(5)), F.lit(-1))


def learn(labelled: DataFrame, lang: str = "lang", text: str = "text") -> tuple[tuple[str, bytes], ...]:
    """A dictionary for every language with a text that has letters, from at most TEXTS of its distinct texts, chosen by hash.

    Distinct texts are counted first, in sketches of fixed size, so that only a few times TEXTS of a language's rows are
    sorted, however many it has and however often one text is repeated. Texts become dictionaries on the cluster.
    """
    t = F.col(text)
    usable = labelled.where(F.col(lang).isNotNull() & (F.length(t) > 0))
    usable = usable.select(F.col(lang).alias("l"), F.left(t, F.lit(LENGTHS[1])).alias("t"), (~F.length(t).between(*LENGTHS)).cast("int").alias("later"))
    counts = usable.groupBy("l", "later").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("t")).alias("d")).collect()  # two rows a language
    if not counts:
        return ()
    total: dict[str, int] = {}
    for row in counts:
        total[row["l"]] = total.get(row["l"], 0) + row["n"]
    enough = {row["l"] for row in counts if not row["later"] and row["d"] >= 2 * TEXTS}
    shares = [(row["l"], row["later"], min(1 << 20, int(4 * TEXTS * (1 << 20) / row["d"]) + 1)) for row in counts if not (row["later"] and row["l"] in enough)]
    rate = stored(labelled.sparkSession.createDataFrame(shares, "l string, later int, rate int"))  # of a known size: texts are only shuffled if it is too large to broadcast
    order = F.xxhash64("t", F.lit(7))
    kept = usable.join(rate, ["l", "later"]).where(F.pmod(F.xxhash64("t"), F.lit(1 << 20)) < F.col("rate")).drop("rate").dropDuplicates()
    few = kept.withColumn("h", order).withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("later", "h", "t"))).where(F.col("k") <= TEXTS)
    whole = few.groupBy("l").agg(F.array_join(F.sort_array(F.collect_list(F.struct("later", "h", "t")))["t"], "\n").alias("t"))
    size = min(DICTIONARY, max(LEAST_DICTIONARY, DICTIONARIES // len(total)))
    made = map_texts(whole, "t", ["l"], "content binary", lambda: lambda texts: [(letters(x)[:size],) for x in texts])
    found = {row["l"]: bytes(row["content"]) for row in made.collect()}
    return tuple((name, found[name]) for name in sorted(total, key=lambda x: (-total[x], x)) if found.get(name))


def identify(df: DataFrame, samples: tuple[tuple[str, bytes], ...], keep: list[str], text: str = "text") -> DataFrame:
    """Columns keep, lang_pred, score and accepted of every row; null texts and those without letters are "und", score 0."""

    def rows() -> Callable[[list], list[tuple]]:
        found = model(samples)
        return lambda texts: [found.predict(x) for x in texts]

    return map_texts(df, text, keep, "lang_pred string, score double, accepted boolean", rows)


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) of every row. Learns from labelled rows that are not held out.

    Null texts and texts without letters are "und" with score 0, and so is everything if no row is labelled. Every label is
    learned, whatever its texts' lengths and copies. Ties go to
    the language with more labelled texts. Repeated rows give repeated results; labels and ids are no inputs of a prediction.
    """
    samples = learn(docs.where(bucket(doc_id) > 0), lang, text)
    found = identify(docs.select(doc_id, bucket(doc_id).alias("__b"), text), samples, [doc_id, "__b"], text)
    return found.select(doc_id, (F.col("__b") == 0).alias("held_out"), "lang_pred", "score", "accepted")


def keep_identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of docs whose language is accepted, with the columns of docs."""
    samples = learn(docs.where(bucket(doc_id) > 0), lang, text)
    whole = docs.select(F.struct("*").alias("__row"), F.col(f"`{text}`").alias("__text"))
    return identify(whole, samples, ["__row"], "__text").where("accepted").select("__row.*")
