"""SimHash near-duplicates by multi-index hashing.

A fingerprint has two segments of 32 bits. Two fingerprints that differ in at most 4 bits differ in at most 2 of one of
their segments, so the Hamming balls of radius 1 around these two segment values share a value. Every distinct
fingerprint enters the 33 values of each segment's ball in that segment's table; fingerprints that meet at a value are
compared in full. Copies have one fingerprint and are one entry. Where many near copies meet, linked ones leave the
comparison as soon as they are found, so a dense value costs its size and not its square and gives a star of links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listloom.llm.common import map_texts, ship, stored
from listloom.llm.components import components

SEED, SHINGLE, RADIUS = 42, 4, 4
#: Members of a table value that one task compares; a value with more is dealt out in pairs of blocks.
CROWD = 20_000
#: Fingerprints whose table values a task counts at one time.
COUNTED = 1 << 16


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The SimHash of a text, as a signed 64-bit number."""
    words = text.encode("utf-8", "replace").lower().split()  # of ASCII only, both
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    grams = [joined[i:j] for i, j in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    counts, n = np.zeros(64, np.int64), len(grams)
    for k in range(0, n, 1 << 16):
        some = grams[k : k + (1 << 16)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), np.uint64, len(some))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n).view(np.int64)[0])


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, the columns keep) of every row. A text without words, or null, has fingerprint 0; one with fewer words than a shingle has its whole sequence."""

    def rows() -> Callable[[list], list[tuple]]:
        return lambda texts: [(fingerprint(x or "", shingle),) for x in texts]

    return map_texts(df, text, [doc_id, *keep], "fp bigint", rows).select(F.col(doc_id).alias("doc_id"), "fp", *keep)


def stars(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, np.ndarray]]:
    """Stars that link sorted distinct fingerprints as far as links of the radius reach among them: (smallest, others)."""
    left, out = values, []
    while len(left) > 1:
        seed, left = left[0], left[1:]
        queue, found = [seed], []
        while queue and len(left):
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= radius
            if near.any():
                new, left = left[near], left[~near]
                found.append(new)
                queue.extend(new)
        if found:
            out.append((int(seed), np.concatenate(found)))
    return out


def ball(fps: np.ndarray) -> np.ndarray:
    """The 66 table values of each fingerprint, a row for each: those within one bit of a segment, and the segment's number above."""
    bits = np.concatenate(([0], np.int64(1) << np.arange(32, dtype=np.int64)))
    halves = [(fps.view(np.uint64) >> np.uint64(32)).view(np.int64), fps & np.int64(0xFFFFFFFF)]
    return np.concatenate([h[:, None] ^ (bits | np.int64(k << 32)) for k, h in enumerate(halves)], axis=1)


def _common(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """From distinct fingerprints: the table values that at least so many of some COUNTED of them share."""

    def counted(fps: list[np.ndarray]) -> pa.RecordBatch:
        at, n = np.unique(ball(np.concatenate(fps)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(at[n >= least])], ["at"])

    held, size = [], 0
    for batch in batches:
        held.append(batch.column(0).to_numpy(zero_copy_only=False))
        size += len(held[-1])
        if size >= COUNTED:
            yield counted(held)
            held, size = [], 0
    if held:
        yield counted(held)


def _meetings(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """From (fp, at) in the order of at: links (a, b). A value's members are held at one time."""
    fps: list[np.ndarray] = []
    where = None

    def link(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if sum(map(len, parts)) > 1:
            for seed, others in stars(np.unique(np.concatenate(parts)), radius):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(others), seed)), pa.array(others)], ["a", "b"])

    for batch in batches:
        fp, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(at):
            continue
        edges = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]))
        if at[0] != where and fps:
            yield from link(fps)
            fps = []
        # whole groups inside the batch, of which most have one member; the first may go on, and the last may
        sizes = np.diff(edges)
        for k in np.flatnonzero(sizes > 1).tolist():
            if 0 < k < len(sizes) - 1:
                yield from link([fp[edges[k] : edges[k + 1]]])
        if len(sizes) > 1:
            yield from link([*fps, fp[: edges[1]]])
            fps = []
        fps.append(fp[edges[-2] :])
        where = at[-1]
    if fps:
        yield from link(fps)


def links(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """(a, b): enough links between distinct fingerprints (column fp) to connect all that differ in at most radius (up to 4) bits.

    One shuffle of 66 narrow rows a fingerprint. Before it, every task counts the table values of its own fingerprints; a
    value with over crowd members is shared by more than crowd / (blocks counted) of some block, so only values that are
    as common as that in a block are counted over all. Those with over crowd members, if there are any, never meet in one
    task: they are cut into blocks, and each pair of blocks is compared by itself. Nothing is dropped.
    """
    if not 0 <= radius <= 4:
        raise ValueError("two balls of radius 1 guarantee to meet for up to 4 differing bits")
    halves = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))]
    values = [0, *(1 << i for i in range(32))]
    at = F.explode(F.array(*[h.bitwiseXOR(F.lit(x | k << 32)) for k, h in enumerate(halves) for x in values]))
    met = fps.select("fp", at.alias("at"))
    # n / COUNTED blocks and, in each task, one that is not full: with two members at least, a value is seen where it is common
    ship(fps.sparkSession)
    blocks = fps.count() // COUNTED + fps.rdd.getNumPartitions()
    least = max(2, -(-crowd // blocks))
    common = stored(fps.select("fp").mapInArrow(lambda x: _common(x, least), "at bigint").distinct())
    found = None
    if not common.isEmpty():
        hot = stored(met.join(common, "at", "left_semi").groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") > crowd))
        k = F.ceil(F.col("n") / crowd).cast("int")
        more = met.join(hot, "at").withColumn("k", k).withColumn("i", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
        more = more.select("fp", "at", "i", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"))
        pair = F.xxhash64("at", F.least("i", "j"), F.greatest("i", "j"))  # a clash only compares more
        dealt = more.select("fp", pair.alias("at")).repartition("at").sortWithinPartitions("at")
        found = dealt.mapInArrow(lambda x: _meetings(x, radius), "a bigint, b bigint")
        met = met.join(hot.select("at"), "at", "left_anti")
    rest = met.select("fp", "at").repartition("at").sortWithinPartitions("at").mapInArrow(lambda x: _meetings(x, radius), "a bigint, b bigint")
    return (rest if found is None else rest.unionByName(found)).distinct()


def grouped(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fps, a stored table with doc_id and fp, with each row's component: root, one of its fingerprints, and component_id."""
    classes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = stored(components(links(classes.select("fp"), radius)))
    linked = classes.join(roots, classes.fp == roots.node)
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    joined = stored(roots.join(least, "root").select(F.col("node").alias("fp"), "root", "least"))
    alone = joined["fp"].isNull()
    of = classes.join(joined, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), F.when(alone, F.col("first")).otherwise(F.col("least")).alias("component_id"))
    return fps.join(stored(of), "fp")


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: 16 hexadecimal digits, and the smallest doc_id linked to it, over any number of links.

    Null and empty texts have fingerprint 0 and are linked like any other; a row without doc_id takes part but is never
    the smallest (component_id is null where all of a component lack one). Repeated rows give repeated results.
    """
    found = grouped(stored(fingerprints(df, doc_id, text, shingle)), radius)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs whose doc_id is their component's smallest, one of each component; one without doc_id only where no other has one.

    A doc_id may stand at texts of several components: rows are known by doc_id and a hash of the text.
    """
    unnamed = F.col(f"`{doc_id}`").isNull()
    h = F.xxhash64(F.col(f"`{text}`"), unnamed)  # rows without doc_id are told from all others
    key = F.coalesce(F.col(f"`{doc_id}`"), F.lit(0))
    marked = docs.select(key.alias("__id"), h.alias("__h"), unnamed.alias("__last"), F.col(f"`{text}`").alias("__text"))
    found = grouped(stored(fingerprints(marked.withColumnRenamed("__id", "doc_id"), "doc_id", "__text", keep=("__h", "__last"))))
    found = stored(found.groupBy("root", "__last", "doc_id", "__h").agg(F.count("*").alias("n")))
    first = found.groupBy("root").agg(F.min(F.struct("__last", "doc_id", "__h")).alias("first"))
    # of equal doc_ids with different texts the one of the smaller hash stays
    both = stored(found.join(first, "root").select("root", F.col("doc_id").alias("__id"), "__h", "n", (F.struct("__last", "doc_id", "__h") == F.col("first")).alias("kept")))
    # Both sets are stored, so their sizes are known: texts are only shuffled where a set is too large to broadcast.
    copies, repeated = stored(both.where("NOT kept").select("__id", "__h")), stored(both.where("kept AND n > 1").select("__id", "__h"))
    on = (key == F.col("__id")) & (h == F.col("__h"))
    kept = docs.join(copies, on, "left_anti")
    rest = [F.hash(F.col(f"`{c}`")) for c in docs.columns if c != doc_id]
    w = Window.partitionBy("__id", "__h").orderBy(F.hash(F.col(f"`{text}`")), *rest)
    once = kept.join(repeated, on).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__id", "__h")
    return kept.join(repeated, on, "left_anti").unionByName(once)
