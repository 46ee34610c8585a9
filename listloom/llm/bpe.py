"""Byte-level BPE with vectorised pre-tokenisation.

The pattern of byte-level BPE ("'s" and its kind, an optional space before letters, digits or other signs, and white
space that leaves its last character to what follows) is recognised without a regular expression. Each character gets a
class from a codepoint array, sharpened by a look at the next characters; each class is a transition function on eight
states; composing those functions is associative, so a scan over blocks gives the state before every character at once,
and state and class together say where a slice begins. Slices are merged by rank once and then found in a cache.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Callable, Iterable
from functools import cache
from io import BytesIO
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame

from listloom.llm.common import map_texts

#: Classes of a character. Of white space, the last character before another one, a space or not, and all the rest.
LETTER, NUMBER, OTHER, SPACE, BLANK, INSIDE, CLITIC1, CLITIC2, BREAK = range(9)
#: States after a character: in white space, after a space that may join, in letters, numbers, others, before the last two
#: and the last letter of a clitic, and where a slice has ended.
S_WHITE, S_JOIN, S_LETTER, S_NUMBER, S_OTHER, S_TWO, S_ONE, S_END = range(8)
#: Letters after an apostrophe that the pattern takes with it: fixed values of the public pattern.
CLITICS_1, CLITICS_2 = "stmd", ("re", "ve", "ll")
#: White space of Unicode's White_Space property, as the tokenizers' regular expressions have it.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers of Unicode 16, which the tokenizers' expressions know and Python's own tables may not yet: fixed ranges.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
#: Characters of a block of the scan, and slices that a worker's cache holds.
BLOCK, CACHED = 256, 300_000


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """next[class * 8 + state] and begins[class * 8 + state]."""
    after = np.full((9, 8), S_END, np.uint8)
    begins = np.ones((9, 8), bool)
    for kind, state in ((LETTER, S_LETTER), (NUMBER, S_NUMBER), (OTHER, S_OTHER)):
        after[kind] = state
        begins[kind, [S_JOIN, state]] = False
    after[LETTER, S_TWO], after[LETTER, S_ONE] = S_ONE, S_END
    begins[LETTER, [S_TWO, S_ONE]] = False
    after[SPACE], after[BLANK], after[INSIDE] = S_JOIN, S_END, S_WHITE
    begins[INSIDE, S_WHITE] = False
    for kind, state in ((CLITIC1, S_ONE), (CLITIC2, S_TWO)):
        after[kind] = state
        after[kind, [S_JOIN, S_OTHER]] = S_OTHER  # inside a run of other signs an apostrophe is one of them
        begins[kind, [S_JOIN, S_OTHER]] = False
    return after.ravel(), begins.ravel()


AFTER, BEGINS = _machine()


@cache
def codepoint_classes() -> np.ndarray:
    """A class for each code point: LETTER, NUMBER, INSIDE for white space, or OTHER."""
    kinds = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            kinds[first : last + 1] = kind
    kinds[WHITE] = INSIDE
    return kinds


def sharpened(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Classes with the look ahead. ends: where texts end; each text is followed by one code point that is no part of it."""
    kinds = codepoint_classes()[points]
    kinds[ends] = BREAK
    white = kinds == INSIDE
    last = np.zeros(len(kinds), bool)
    last[:-1] = white[:-1] & ~white[1:] & (kinds[1:] != BREAK)
    kinds[last] = BLANK
    kinds[last & (points == 0x20)] = SPACE
    at = np.flatnonzero(points[:-2] == 0x27) if len(points) > 2 else np.empty(0, np.int64)
    at = at[kinds[at] == OTHER]
    if len(at):
        one, two = points[at + 1], points[at + 2]
        kinds[at[np.isin(one, [ord(c) for c in CLITICS_1])]] = CLITIC1
        for a, b in CLITICS_2:
            kinds[at[(one == ord(a)) & (two == ord(b))]] = CLITIC2
    return kinds


def states_before(kinds: np.ndarray, first: int = S_END) -> np.ndarray:
    """The machine's state before each character, by a scan: functions of blocks, their composition, then all states."""
    n = len(kinds)
    if not n:
        return np.empty(0, np.uint8)
    lanes = -(-n // BLOCK)
    padded = np.full(lanes * BLOCK, BREAK, np.uint8)
    padded[:n] = kinds
    columns = np.ascontiguousarray(padded.reshape(lanes, BLOCK).T) << 3
    functions = np.repeat(np.arange(8, dtype=np.uint8)[:, None], lanes, 1)
    whole = None
    for j in range(BLOCK):  # each block's composed function; once all blocks' are constant, one row stands for eight
        if whole is None:
            functions = AFTER[columns[j] + functions]
            if j % 4 == 3 and (functions == functions[0]).all():
                whole = functions[0]
        else:
            whole = AFTER[columns[j] + whole]
    entry = np.empty(lanes, np.uint8)
    if whole is not None:
        entry[0], entry[1:] = first, whole[:-1]
    else:
        state = first
        for i in range(lanes):
            entry[i] = state
            state = functions[state, i]
    out = np.empty((BLOCK, lanes), np.uint8)
    for j in range(BLOCK):
        out[j] = entry
        entry = AFTER[columns[j] + entry]
    return out.T.reshape(-1)[:n]


def boundaries(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts joined by one code point each, where slices begin in them (these joints too), and the joints' places."""
    joined = "\n".join([*texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    kinds = sharpened(points, ends)
    starts = np.flatnonzero(BEGINS[(kinds << 3) + states_before(kinds)])
    return joined, starts, ends


def pretokens(texts: list[str]) -> list[list[str]]:
    """The slices of each text."""
    joined, starts, ends = boundaries(texts)
    edges = [*starts.tolist(), len(joined)]
    cuts = [joined[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    out, begin = [], 0
    for stop in np.searchsorted(starts, ends).tolist():
        out.append(cuts[begin:stop])
        begin = stop + 1
    return out


@cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


def merged(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank is merged, leftmost first, until none has a rank."""
    if (whole := rank.get(piece)) is not None:
        return [whole]
    if len(piece) > 96:
        return _merged_long(piece, rank)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [rank.get(piece[i : i + 2], 1 << 30) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == 1 << 30:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = rank.get(parts[i] + parts[i + 1], 1 << 30)
        if i:
            pairs[i - 1] = rank.get(parts[i - 1] + parts[i], 1 << 30)
    return [rank[p] for p in parts]


def _merged_long(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """merged() in n log n, for very long slices: a heap of pairs over linked parts."""
    import heapq

    n = len(piece)
    begin, end, before, alive = list(range(n)), [i + 1 for i in range(n)], [i - 1 for i in range(n)], [True] * n
    follow = [i + 1 for i in range(n)]
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and (j := follow[i]) < n and (r := rank.get(piece[begin[i] : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or (j := follow[i]) >= n or end[j] != stop:
            continue
        end[i], alive[j], follow[i] = stop, False, follow[j]
        if follow[j] < n:
            before[follow[j]] = i
        offer(i)
        offer(before[i])
    return [rank[piece[begin[i] : end[i]]] for i in range(n) if alive[i]]


def _merger(rank: dict[bytes, int]) -> Callable[[bytes], list[int]]:
    """merged() for these ranks, by tiktoken's compiled pair merging of a single slice where that is at hand."""
    try:
        from tiktoken import _tiktoken
    except ImportError:
        return lambda piece: merged(piece, rank)
    core = _tiktoken.CoreBPE(rank, {}, r"[\s\S]+")
    return core.encode_single_piece


class Encoder:
    """Encodes texts by a rank file; ids of a slice are kept as their decimal digits joined by commas."""

    def __init__(self, path: str):
        self.rank = ranks(path)
        self.merge = _merger(self.rank)
        self.bytes_of = {rank: token for token, rank in self.rank.items()}
        self.token_of = {str(rank): token for token, rank in self.rank.items()}
        self.cached: dict[str, str] = {}

    def _miss(self, piece: str) -> str:
        ids = ",".join(map(str, self.merge(piece.encode("utf-8"))))
        if len(self.cached) >= CACHED:
            self.cached.clear()
        if len(piece) <= 64:
            self.cached[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> list[str]:
        """Ids of each text, joined by commas."""
        out = []
        for cuts in pretokens(texts):
            found = list(map(self.cached.get, cuts))
            if None in found:
                get, miss = self.cached.get, self._miss
                found = [x if x is not None else (get(c) or miss(c)) for x, c in zip(found, cuts, strict=True)]
            out.append(",".join(found))
        return out

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.token_of.__getitem__, ids.split(","))) if ids else b""

    def decode_by_offsets(self, ids: str) -> tuple[bytes, int]:
        """The decoded bytes, every token written at its offset, and the last token's offset (0 without tokens)."""
        if not ids:
            return b"", 0
        tokens = list(map(self.token_of.__getitem__, ids.split(",")))
        ends = list(accumulate(map(len, tokens)))
        out = BytesIO()
        out.writelines(tokens)
        if out.tell() != ends[-1]:
            raise ValueError("offsets do not fit the decoded bytes")
        return out.getvalue(), ends[-1] - len(tokens[-1])

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [list(map(int, x.split(","))) if x else [] for x in self.encode(texts)]

    def offsets(self, ids: Iterable[int]) -> list[int]:
        """Where each id's bytes begin in the encoded text, in UTF-8 bytes: what decoding a part of it needs."""
        out, at = [], 0
        for i in ids:
            out.append(at)
            at += len(self.bytes_of[i])
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(df: DataFrame, rank_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, offsets array<int>) of every row: token ids, and the byte offset of each token.

    A null or empty text has no ids. Repeated rows give repeated results; other columns are left out. Texts may have any
    length: a slice's merging is n log n, and a worker holds a few MB of text at one time. decode() is the inverse.
    """

    def rows() -> Callable[[list], list[tuple]]:
        coder = encoder(rank_file)
        return lambda texts: [(ids, coder.offsets(ids)) for ids in coder.ids([x or "" for x in texts])]

    return map_texts(df, text, [doc_id], "ids array<int>, offsets array<int>", rows)


def decode(df: DataFrame, rank_file: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) for token ids as encode() gives them. Null ids give a null text; bytes that are no UTF-8 become U+FFFD."""
    from pyspark.sql import functions as F

    joined = df.select(doc_id, F.when(F.col(ids).isNotNull(), F.array_join(ids, ",")).alias("ids"))

    def rows() -> Callable[[list], list[tuple]]:
        coder = encoder(rank_file)
        return lambda lists: [(None if x is None else coder.decode(x).decode("utf-8", "replace"),) for x in lists]

    return map_texts(joined, "ids", [doc_id], "text string", rows)


def round_trip(df: DataFrame, rank_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, last_offset) of every row: digests of its ids and of what they decode to by their offsets, and the byte offset of the last token."""

    def rows() -> Callable[[list], list[tuple]]:
        coder = encoder(rank_file)

        def do(texts: list) -> list[tuple]:
            out = []
            for ids in coder.encode([x or "" for x in texts]):
                back, last = coder.decode_by_offsets(ids)
                out.append((ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest(), last))
            return out

        return do

    return map_texts(df, text, [doc_id], "n_tokens bigint, ids_sha256 string, decoded_sha256 string, last_offset bigint", rows)
