import base64
import hashlib
import unicodedata

import public_tokenizers
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from listloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)
SIGNS = st.sampled_from(list("a'srevlmtd  \n\t é1½!\"x日​ \x85\r") + ["'ll", "'re", "<|endoftext|>", "ing", "😀"])
TEXTS = st.lists(st.one_of(st.lists(SIGNS, max_size=40).map("".join), st.text(max_size=30)), max_size=8)


@settings(max_examples=400, deadline=None)
@given(texts=TEXTS)
def test_slices_and_ids(texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    coder = bpe.encoder(PATH)
    if not any(unicodedata.category(c) == "Cn" for t in texts for c in t):  # on those, versions of Unicode differ
        assert bpe.pretokens(texts) == [PATTERN.findall(t) for t in texts]
    ids = coder.ids(texts)
    assert ids == [LIBRARY.encode_ordinary(t) for t in texts]
    for text, own in zip(texts, ids, strict=True):
        assert coder.decode(",".join(map(str, own))) == text.encode()
        offsets = coder.offsets(own)
        assert all(text.encode()[a:].startswith(coder.bytes_of[i]) for a, i in zip(offsets, own, strict=True))


def test_scan_of_functions_that_never_become_constant():
    """Blocks whose functions stay different are composed one after the other."""
    import numpy as np

    kinds = np.full(3 * bpe.BLOCK, bpe.BREAK, np.uint8)
    kinds[: bpe.BLOCK] = bpe.CLITIC2
    state, states = bpe.S_END, []
    for k in kinds.tolist():
        states.append(state)
        state = int(bpe.AFTER[k * 8 + state])
    assert bpe.states_before(kinds).tolist() == states


def test_own_merging_is_the_library_s():
    for piece in ("worthless", "x", "Ünïcödé" * 40, "a" * 500, "ab" * 300, "日本語" * 50):
        assert bpe.merged(piece.encode(), RANKS) == LIBRARY.encode_ordinary(piece) or len(PATTERN.findall(piece)) > 1


def test_cases(spark):
    texts = [(1, "Hello  world's\n", "x"), (1, "Hello  world's\n", "x"), (2, None, "y"), (3, "", None), (None, "é" * 50_000, "z"), (4, " " * 30_000 + "x" * 30_000, "z")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, k0 string")
    got = sorted((r["doc_id"] or 0, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(df, PATH).collect())
    sha = lambda x: hashlib.sha256(x).hexdigest()
    want = []
    for i, t, _ in texts:
        ids = LIBRARY.encode_ordinary(t or "")
        want.append((i or 0, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want)
    last = {r["doc_id"]: r["last_offset"] for r in bpe.round_trip(df, PATH).collect()}
    for i, t, _ in texts:
        ids = LIBRARY.encode_ordinary(t or "")
        assert last[i] == (len((t or "").encode()) - len(LIBRARY.decode_single_token_bytes(ids[-1])) if ids else 0)
    back = bpe.decode(bpe.encode(df, PATH), PATH)
    assert sorted(r["text"] for r in back.collect()) == sorted(t or "" for _, t, _ in texts)
    assert bpe.round_trip(df.limit(0), PATH).count() == 0
