import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest

from listloom.llm import tokenfiles
from listloom.llm.common import shared_folder

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def slow(rows):
    coder, start, out = library(), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip_and_single_documents(spark):
    rows = [(i * 7 % 211, f"Document number {i}: it's {'very ' * (i % 9)}short.\n <|endoftext|> é{i}") for i in range(211)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "long " * 60_000), (503, "日本語 '' 's  \n\n x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, start int")
    folder = shared_folder(spark)
    shards = tokenfiles.write(df, folder, PATH, end_id=2)
    got = sorted(map(tuple, tokenfiles.read(spark, shards, folder).collect()), key=lambda r: r[1])
    assert got == slow(rows)
    coder, by, n = library(), {i: t for i, t in rows}, 0
    files, _ = pyarrow.fs.FileSystem.from_uri(folder)
    for row in shards.collect():
        shard = tokenfiles.Shard(files, row["path"])
        for k in range(len(shard.tokens)):
            i = int(shard.doc_ids[k]) if shard.has_id[k] else None
            assert shard.document(k).tolist() == [*coder.encode(by[i] or "", add_special_tokens=False).ids, 2]
            n += 1
        shard.close()
    assert n == len(rows)
    first = shards.first()["path"]
    with open(first, "r+b") as f:
        f.truncate(os.path.getsize(first) - 3)
    with pytest.raises(ValueError):
        tokenfiles.Shard(files, first)


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (0, "c")], "doc_id bigint, text string")
    got = sorted(map(tuple, tokenfiles.round_trip(df, PATH, end_id=2).collect()), key=lambda r: r[1])
    assert got == slow([(1, "a b"), (1, "a b"), (0, "c")])
    assert tokenfiles.round_trip(df.limit(0), PATH, end_id=2).count() == 0


def test_slices_are_the_library_s():
    coder, own = library(), tokenfiles.Tokenizer(PATH)
    texts = ["Hello  world's end\n\n x", "", "''s 've\t", "été 12 ½ 日本", "<|endoftext|>x", " " * 9]
    for text, data in zip(texts, own.encode(texts), strict=True):
        assert np.frombuffer(data, own.kind).tolist() == coder.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_the_library_s():
    """Strings of added tokens are found as the library's default call finds them, alone, inside words and in long texts."""
    coder, own = library(), tokenfiles.Tokenizer(PATH)
    texts = ["hello <|endoftext|> world", "plain", "<|endoftext|>", "a<|endoftext|><|endoftext|>'s", "", "<|endof text|> " * 50, "é <|endoftext|>\n " * 200]
    got = [np.frombuffer(x, own.kind).tolist() for x in own.encode(texts)]
    assert got[0] == [31373, 220, 50256, 995]
    assert got == [coder.encode(x, add_special_tokens=False).ids for x in texts]


def test_shards_follow_bytes_and_replace_what_was_left(spark):
    least, most = tokenfiles.SHARD_BYTES
    assert [tokenfiles.shards_for(x, 8) for x in (0, least, least + 1, 100 * least, 9 * most)] == [1, 1, 2, 8, 9]
    df = spark.createDataFrame([(i, "same words here") for i in range(20)] * 2, "doc_id bigint, text string")
    folder = shared_folder(spark)
    files, place = pyarrow.fs.FileSystem.from_uri(folder)
    files.create_dir(place, recursive=True)
    with files.open_output_stream(f"{place}/shard-000000-999999.tokz") as f:  # of an attempt that was lost
        f.write(b"half")
    first = tokenfiles.write(df, folder, PATH, end_id=2)
    again = tokenfiles.write(df, folder, PATH, end_id=2)  # as if all had been lost
    named = {r["path"].rsplit("/", 1)[1] for r in again.collect()}
    left = {i.base_name for i in files.get_file_info(pyarrow.fs.FileSelector(place)) if i.base_name.endswith(".tokz")}
    assert left == named and not named & {r["path"].rsplit("/", 1)[1] for r in first.collect()}
    got = sorted(map(tuple, tokenfiles.read(spark, again, folder).collect()), key=lambda r: r[1])
    assert got == slow([(r[0], r[1]) for r in df.collect()])
