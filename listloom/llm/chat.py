"""Chat formatting with a grammar round trip.

    conversation = { turn }
    turn         = "<|im_start|>" role "\\n" text "<|im_end|>\\n"

A control string begins with "<|", and neither a role nor a text holds one. Inside roles and texts a "<|" gets a backslash between its two characters, and where
there are backslashes between them already, one more; that is reversible and never leaves a control string. A turn is
first rendered as it is, read again by the grammar's parser and compared with its source; what conflicts is escaped until
both are identical. Each turn's segment is rendered and checked by itself, before any shuffle, and a conversation is the
concatenation of its segments in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listloom.llm.common import default_parallelism, map_texts, ship

START, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
#: Roles whose texts are under the loss mask.
LEARNED = ("assistant",)
_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
#: The escapes in the order in which they are tried: control strings, then line ends as well (for roles).
ESCAPES = (
    lambda x: x,
    lambda x: _PLAIN.sub(r"<\\\1|", x),
    lambda x: _PLAIN.sub(r"<\\\1|", x).replace("\\", "\\\\").replace("\n", "\\n"),
)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    """Inverse of the strictest escape for a role that starts with a tab, which marks it; else of the control strings' escape."""
    if role.startswith("\t"):
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role[1:], flags=re.S)
    return unescape(role)


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end) of each turn: the grammar's deterministic parser. begin and end bound the escaped text.

    Raises ValueError where the string is no conversation: roles and texts hold no unescaped control string.
    """
    turns, at = [], 0
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        role = at + len(START)
        text = formatted.find(MIDDLE, role)
        end = formatted.find("<|", role)
        if not 0 <= text < end or not formatted.startswith(END, end):
            raise ValueError(f"the turn at {at} does not end")
        turns.append((unescape_role(formatted[role:text]), unescape(formatted[text + 1 : end]), text + 1, end))
        at = end + len(END)
    return turns


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment that reads back as (role, text), and where its escaped text begins and ends."""
    for for_role in (ESCAPES[0], ESCAPES[1], lambda x: "\t" + ESCAPES[2](x)):
        for for_text in ESCAPES[:2]:
            body = for_text(text)
            segment = f"{START}{for_role(role)}{MIDDLE}{body}{END}"
            try:
                found = parse(segment)
            except ValueError:
                continue
            if len(found) == 1 and found[0][:2] == (role, text):
                return segment, found[0][2], found[0][3]
    raise AssertionError("the strictest escape reads back by construction")


def render_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, segment, begin, end, learned) of every row: the turn's part of the formatted conversation.

    begin and end are code points of the segment and bound its escaped text, which is under the loss mask if learned. A
    null text or role is empty. Without a shuffle; repeated rows give repeated segments.
    """
    both = turns.select(F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    joined = both.select("conv_id", "turn", F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").alias("x"))

    def rows() -> Callable[[list], list[tuple]]:
        def one(x: str) -> tuple:
            size, _, rest = x.partition(":")
            who = rest[: int(size)]
            segment, begin, end = render(who, rest[int(size) :])
            return segment, begin, end, who in LEARNED

        return lambda texts: [one(x) for x in texts]

    return map_texts(joined, "x", ["conv_id", "turn"], "segment string, begin bigint, end bigint, learned boolean", rows)


def in_order(segments: DataFrame) -> DataFrame:
    """segments dealt by conv_id, in the order of turns; of equal turns by segment, so that the order is the same each time."""
    return segments.repartition(default_parallelism(segments.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "segment")


def format_conversations(turns: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, formatted, loss_spans): whole conversations as strings, with the spans under the loss mask in code points.

    For conversations that fit one string, in time linear in their length. Longer ones stay what render_turns() gives,
    segments that any reader can stream.
    """
    made = render_turns(turns, **columns)
    w = Window.partitionBy("conv_id").orderBy("turn", "segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = made.withColumn("before", F.coalesce(F.sum(F.length("segment")).over(w), F.lit(0)))
    one = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "segment", "before", "begin", "end", "learned"))).alias("s"))
    under = F.filter("s", lambda x: x["learned"])
    spans = F.transform(under, lambda x: F.struct((x["before"] + x["begin"]).alias("begin"), (x["before"] + x["end"]).alias("end")))
    return one.select("conv_id", F.array_join("s.segment", "").alias("formatted"), spans.alias("loss_spans"))


class _Reader:
    """Digests of one conversation, read back from its segments: turns by the parser, what is learned by the loss mask."""

    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss, self.chars = conv, 0, 0, 0
        self.text, self.masked = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, begin: int, end: int, learned: bool) -> None:
        for role, text, _, _ in parse(segment):
            self.turns += 1
            self.text.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
        if learned:
            text = unescape(segment[begin:end])
            self.loss += len(text)
            self.masked.update(text.encode("utf-8", "replace"))
        self.chars += len(segment)

    def row(self) -> tuple:
        return self.conv, self.turns, self.text.hexdigest(), self.loss, self.masked.hexdigest(), self.chars


def digests(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the rows of render_turns().

    Turns are what the parser finds in the segments; the loss columns are the text that the rows' masks (begin, end,
    learned) cut out of them, unescaped. A conversation is streamed, a few segments at a time, so it may have any number of
    turns. Rows without conv_id are one conversation.
    """
    ship(segments.sparkSession)
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        made = lambda done: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names)
        now: _Reader | None = None
        for batch in batches:
            done = []
            for conv, *segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Reader(conv)
                now.add(*segment)
            if done:
                yield made(done)
        if now is not None:
            yield made([now.row()])

    return in_order(segments).select(F.col("conv_id").cast("bigint").alias("conv_id"), "segment", "begin", "end", "learned").mapInArrow(run, schema)
