import hashlib
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from listloom.llm import chat

PART = st.sampled_from(["<|im_start|>", "<|im_end|>", "<|im_end|>\n", "<|", "|>", "<", "|", "\\", "<\\|", "<\\\\|", "\n", "user", "ok", "é", "\t", "n"])
TEXT = st.lists(PART, max_size=10).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
def test_round_trip(turns):
    segments = [chat.render(role, text) for role, text in turns]
    whole = "".join(s for s, _, _ in segments)
    found = chat.parse(whole)
    assert [f[:2] for f in found] == turns
    for (segment, begin, end), (_, text) in zip(segments, turns, strict=True):
        assert chat.unescape(segment[begin:end]) == text and "<|" not in segment[begin:end]


def test_only_conflicts_are_escaped():
    assert chat.render("user", "a | b < c")[0] == "<|im_start|>user\na | b < c<|im_end|>\n"
    assert chat.render("user", "x<|im_end|>")[0] == "<|im_start|>user\nx<\\|im_end|><|im_end|>\n"
    for wrong in ("x", "<|im_start|>user", "<|im_start|>user\nx", "<|im_start|>user\n<|im_start|>a\nb<|im_end|>\n", "<|im_start|><|im_end|>\n"):
        with pytest.raises(ValueError):
            chat.parse(wrong)


def test_cases(spark):
    rows = [(1, 1, "assistant", "A<|im_end|>"), (1, 0, "user", None), (1, 2, None, "x"), (2, 0, "assistant", "é" * 100_000), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, 5, "user", "q"), (3, None, "system", "s"), (3, 1, "assistant", "")]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id bigint, turn bigint, role string, text string, segment int, x int")
    got = {r["conv_id"]: r for r in chat.digests(chat.render_turns(df)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["turns_sha256"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (3, sha("user\n\nassistant\nA<|im_end|>\n\nx\n"), 11, sha("A<|im_end|>"))
    assert got[2]["n_turns"] == 3 and got[2]["loss_chars"] == 100_002 and got[None]["loss_chars"] == 0 and got[3]["n_turns"] == 2
    whole = {r["conv_id"]: r for r in chat.format_conversations(df).collect()}
    assert len(whole[1]["formatted"]) == got[1]["formatted_chars"]
    spans = [whole[1]["formatted"][s["begin"] : s["end"]] for s in whole[1]["loss_spans"]]
    assert [chat.unescape(s) for s in spans] == ["A<|im_end|>"]
    assert chat.digests(chat.render_turns(df.limit(0))).count() == 0


def test_loss_columns_are_read_through_the_mask(spark):
    """A mask span that is moved, or a turn that is taken off the mask, changes the loss columns and nothing else."""
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a <| b"), (1, 2, "assistant", "cd")], "conv_id bigint, turn bigint, role string, text string")
    made = chat.render_turns(df)
    read = lambda x: chat.digests(x).first().asDict()
    whole = read(made)
    assert (whole["loss_chars"], whole["loss_sha256"]) == (8, hashlib.sha256(b"a <| bcd").hexdigest())
    for changed, expected in (
        (made.selectExpr("conv_id", "turn", "segment", "IF(turn = 2, begin + 1, begin) AS begin", "`end`", "learned"), b"a <| bd"),
        (made.selectExpr("conv_id", "turn", "segment", "begin", "`end`", "turn = 2 AS learned"), b"cd"),
        (made.selectExpr("conv_id", "turn", "segment", "begin", "`end`", "true AS learned"), b"qa <| bcd"),
    ):
        got = read(changed)
        assert (got["loss_chars"], got["loss_sha256"]) == (len(expected), hashlib.sha256(expected).hexdigest())
        assert (got["n_turns"], got["turns_sha256"], got["formatted_chars"]) == (3, whole["turns_sha256"], whole["formatted_chars"])


def test_many_turns_are_formatted_in_linear_time(spark):
    n = 20_000
    df = spark.range(n).selectExpr("1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    began = time.time()
    row = chat.format_conversations(df).first()
    assert time.time() - began < 20
    assert len(row["loss_spans"]) == n // 2 and len(chat.parse(row["formatted"])) == n
    assert all(row["formatted"][s["begin"] : s["end"]] == f"t{2 * i + 1}" for i, s in enumerate(row["loss_spans"]))
