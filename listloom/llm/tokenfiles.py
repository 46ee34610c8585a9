"""Token-id files: every document compressed by itself with one shared zstandard dictionary, for access to short documents.

A shard is one file:

    "LLTOKZ1\\n"
    compressed documents, one after the other
    index: doc_id int64[n], has_id uint8[n], tokens uint32[n], offset uint64[n + 1]
    header: JSON {width, documents, tokens, dictionary (sha256), index (offset)}
    length of the header uint32, "LLTOKZ1\\n"

All numbers are little-endian. A document is its ids, end id included, as unsigned integers of width bytes. The dictionary
lies beside the shards under its hash, which each shard names, so a reader cannot take a wrong one. Each attempt of a
task writes a file of its own, and the table of shards, committed with the tasks that succeeded, names the one that
counts: nothing is renamed or overwritten, and what other attempts left behind is removed at the end.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listloom.llm.bpe import CACHED, pretokens
from listloom.llm.common import default_parallelism, map_texts, pieces, shared_folder, ship, stored

MAGIC = b"LLTOKZ1\n"
#: Bounds of the dictionary's training: documents, bytes of their ids; and its size.
SAMPLES, SAMPLE_BYTES, DICTIONARY = 2000, 6 << 20, 64 << 10
LEVEL = 3
#: Byte-level vocabularies write a byte as the printable Latin-1 character of its number, the others in turn from 256.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
ALPHABET = "".join(chr(b) if b in _PRINTABLE else chr(256 + _OTHERS.index(b)) for b in range(256))
#: Bytes of a shard that a reader holds at one time, unless one document is longer.
READ = 4 << 20
#: UTF-8 bytes of text of a shard: at most, and the least for which more shards are made to keep all cores busy.
SHARD_BYTES = (2 << 20, 256 << 20)


class Tokenizer:
    """A tokenizer file of the tokenizers library.

    Slices are found by bpe.pretokens(), each new one is merged by the library's model. A text that holds one of the
    tokenizer's added tokens, which the library looks for first, goes through the library's own encode().
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values() if token.content]
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.cached: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, serialized."""
        if len(self.cached) >= CACHED:
            self.cached.clear()
        by_library = {i for i, x in enumerate(texts) if any(map(x.__contains__, self.added))}
        if by_library:
            plain = iter(self.encode([x for i, x in enumerate(texts) if i not in by_library]))
            whole = lambda x: np.asarray(self.library.encode(x.encode("utf-8", "replace").decode(), add_special_tokens=False).ids, self.kind).tobytes()
            return [whole(x) if i in by_library else next(plain) for i, x in enumerate(texts)]
        out, get = [], self.cached.get
        cuts = pretokens(texts)
        found = [list(map(get, own)) for own in cuts]
        if new := list({c for own, ids in zip(cuts, found, strict=True) if None in ids for c, x in zip(own, ids, strict=True) if x is None}):
            self._learn(new)
        for own, ids in zip(cuts, found, strict=True):
            out.append(b"".join(map(self.cached.__getitem__, own) if None in ids else ids))
        return out

    def _learn(self, new: list[str]) -> None:
        """Merge slices by the library's model, and keep their ids. Slices are whole pre-tokens, so its pre-tokenizer is not asked again."""
        merge, flat, edges = self.library.model.tokenize, [], [0]
        for piece in new:
            flat += [token.id for token in merge(charmap_decode(piece.encode("utf-8", "replace"), "strict", ALPHABET)[0])]
            edges.append(len(flat) * self.width)
        data = np.asarray(flat, self.kind).tobytes()
        self.cached.update(zip(new, [data[a:b] for a, b in zip(edges, edges[1:], strict=False)], strict=True))


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def _at(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


def train_dictionary(docs: DataFrame, tokenizer_file: str, text: str = "text", n: int | None = None) -> bytes:
    """A dictionary trained on the serialized ids of at most SAMPLES documents, chosen by hash; empty if there is too little.

    n is the number of texts that are not empty, where the caller knows it.
    """
    texts = docs.select(F.col(f"`{text}`").alias("t")).where(F.length("t") > 0)
    n = texts.count() if n is None else n
    if not n:
        return b""
    few = texts.where(F.pmod(F.xxhash64("t"), F.lit(1 << 30)) <= int(min(1.0, 1.5 * SAMPLES / n) * (1 << 30))).limit(SAMPLES)

    def rows():
        coder = tokenizer(tokenizer_file)
        return lambda some: [(x,) for x in coder.encode([s or "" for s in some])]

    samples, total = [], 0
    for row in map_texts(few, "t", [], "ids binary", rows).toLocalIterator():
        if total + len(row["ids"]) <= SAMPLE_BYTES:
            samples.append(bytes(row["ids"]))
            total += len(samples[-1])
    samples.sort()
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(256, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""  # too few samples to train on


def _compression(content: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}


def shards_for(size: int, wanted: int) -> int:
    """How many shards texts of size bytes get: wanted, as far as SHARD_BYTES allow."""
    least, most = SHARD_BYTES
    return max(1, -(-size // most), min(wanted, -(-size // least)))


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write docs in ascending order of doc_id to shards in folder; (shard, path, documents, tokens) of each, stored.

    Rows without doc_id come first; equal ids are ordered by their texts. A null text has no ids but the end id. folder is
    shared by all executors and holds nothing else. One shuffle deals the texts by ranges of doc_id, as many as their bytes
    ask for; rows that are equal in all may be in several ranges. A task encodes, compresses and writes its range as it
    reads it.
    """
    spark = docs.sparkSession
    ship(spark)
    size = F.octet_length(F.col(f"`{text}`").cast("string"))
    known = docs.agg(F.count_if(size > 0).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    dictionary = train_dictionary(docs, tokenizer_file, text, known["n"])
    digest = hashlib.sha256(dictionary).hexdigest()
    files, place = _at(folder)
    files.create_dir(place, recursive=True)
    with files.open_output_stream(f"{place}/{digest}.zdict") as f:
        f.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        shard = task.partitionId()
        coder = tokenizer(tokenizer_file)
        end = b"" if end_id is None else np.asarray([end_id], coder.kind).tobytes()
        compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=True, **_compression(dictionary)).compress
        files, place = _at(folder)
        path = f"{place}/shard-{shard:06d}-{task.taskAttemptId()}.tokz"
        ids: list[int | None] = []
        sizes, offsets = [], [len(MAGIC)]
        with files.open_output_stream(path) as f:
            f.write(MAGIC)
            for batch in batches:
                for part in pieces(batch, "text"):
                    ids += part.column(0).to_pylist()
                    for data in coder.encode([x or "" for x in part.column(1).to_pylist()]):
                        data += end
                        packed = compress(data)
                        f.write(packed)
                        sizes.append(len(data) // coder.width)
                        offsets.append(offsets[-1] + len(packed))
            f.write(np.asarray([i or 0 for i in ids], "<i8").tobytes() + np.asarray([i is not None for i in ids], "u1").tobytes())
            f.write(np.asarray(sizes, "<u4").tobytes() + np.asarray(offsets, "<u8").tobytes())
            header = json.dumps({"width": coder.width, "documents": len(ids), "tokens": sum(sizes), "dictionary": digest, "index": offsets[-1]}).encode()
            f.write(header + struct.pack("<I", len(header)) + MAGIC)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [path], "documents": [len(ids)], "tokens": [sum(sizes)]}, pa.schema([("shard", pa.int64()), ("path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]))

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", F.xxhash64("text"), "row"]
    dealt = rows.repartitionByRange(shards_for(known["bytes"], default_parallelism(spark)), *order).sortWithinPartitions(*order).drop("row")
    shards = stored(dealt.mapInArrow(run, "shard bigint, path string, documents bigint, tokens bigint"))
    _remove_leftovers(files, place, {row["path"].rpartition("/")[2] for row in shards.select("path").toLocalIterator()})
    return shards


def _remove_leftovers(files: pyarrow.fs.FileSystem, place: str, named: set[str]) -> None:
    """Remove the shards that no row names: those of attempts that were lost or ran twice."""
    for info in files.get_file_info(pyarrow.fs.FileSelector(place)):
        if info.base_name.endswith(".tokz") and info.base_name not in named:
            files.delete_file(info.path)


class Shard:
    """A shard that is open for reading."""

    def __init__(self, files: pyarrow.fs.FileSystem, path: str):
        self.file = files.open_input_file(path)
        size = self.file.size()
        length, magic = struct.unpack("<I8s", self._read(size - 12, 12))
        if magic != MAGIC:
            raise ValueError(f"{path} is no whole token file")
        self.header = json.loads(self._read(size - 12 - length, length))
        n = self.header["documents"]
        index = self._read(self.header["index"], 21 * n + 8)
        self.doc_ids = np.frombuffer(index, "<i8", n)
        self.has_id = np.frombuffer(index, "u1", n, 8 * n).astype(bool)
        self.tokens = np.frombuffer(index, "<u4", n, 9 * n)
        self.offsets = np.frombuffer(index, "<u8", n + 1, 13 * n).astype(np.int64)
        with files.open_input_stream(f"{path.rpartition('/')[0]}/{self.header['dictionary']}.zdict") as f:
            content = f.read()
        if hashlib.sha256(content).hexdigest() != self.header["dictionary"]:
            raise ValueError(f"the dictionary of {path} is damaged")
        self.decompress = zstandard.ZstdDecompressor(**_compression(content)).decompress
        self.kind = np.dtype(f"<u{self.header['width']}")

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def document(self, i: int) -> np.ndarray:
        """The ids of the i-th document; only its own bytes are read."""
        return np.frombuffer(self.decompress(self._read(int(self.offsets[i]), int(self.offsets[i + 1] - self.offsets[i]))), self.kind)

    def documents(self) -> Iterator[np.ndarray]:
        """The ids of all documents, in order, read a few MB at a time."""
        i, n = 0, len(self.tokens)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.offsets, self.offsets[i] + READ, "right")) - 1)
            data = self._read(int(self.offsets[i]), int(self.offsets[j] - self.offsets[i]))
            for k in range(i, j):
                yield np.frombuffer(self.decompress(data[self.offsets[k] - self.offsets[i] : self.offsets[k + 1] - self.offsets[i]]), self.kind)
            i = j

    def close(self) -> None:
        self.file.close()


def read(spark: SparkSession, shards: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the shards of write().

    start counts the ids of all documents before it. The list of shards, a row for each file, comes to the driver to be summed up.
    """
    ship(spark)
    found, start = [], 0
    for row in shards.orderBy("shard").toLocalIterator():
        found.append((row["shard"], row["path"], start))
        start += row["tokens"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not found:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = _at(folder)
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for path, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(files, path)
                sums = np.fromiter((zlib.crc32(x.astype("<u4").tobytes()) for x in shard.documents()), np.int64, len(shard.tokens))
                sizes = shard.tokens.astype(np.int64)
                starts = at + np.concatenate(([0], np.cumsum(sizes)))[:-1]
                shard.close()
                for k in range(0, len(sums), 10_000):
                    part = slice(k, k + 10_000)
                    yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[part], mask=~shard.has_id[part]), pa.array(starts[part]), pa.array(sizes[part]), pa.array(sums[part])], names)

    paths = spark.createDataFrame(found, "shard bigint, path string, start bigint")
    dealt = paths.repartitionByRange(len(found), "shard").select("path", "start")
    return dealt.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """What read() finds in the files that write() makes of docs, in the shared folder."""
    folder = shared_folder(docs.sparkSession)
    return read(docs.sparkSession, write(docs, folder, tokenizer_file, end_id, doc_id, text), folder)
