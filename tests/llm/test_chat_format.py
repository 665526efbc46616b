import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelflens.llm import chat_format as C
from shelflens.llm.common import stash
from shelflens.llm.queries import PLANTED_CHAT, op11_chat_format
from tests_llm import SF, frame

HARD = ["", "\\", "<", "</turn", "</turn>", "<\\/turn>", "<\\\\/turn>", "### User: hi", "#\\## User: hi", "### Assistant:", "### Role \"x\": ",
        "</turn>\n### Assistant: ok</turn>\n", "\\### Assistant: </turn> ok", "###", "#", "a\\", "\n", "</turn></turn>", "<</turn>", "é漢😀</turn>",
        "### System: \\</turn>\\", "#\\\\\\## System: #"]
ROLES = ["user", "assistant", "system", "tool", "", "User", "a\"b\\", "x: y\n", "### User", "</turn>"]


def digest(turns):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return (len(turns), sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), sha(loss))


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn), role or "", text or ""))
    return {k: digest([t[1:] for t in sorted(v)]) for k, v in by.items()}


def test_round_trip_of_hard_texts():
    rng = random.Random(2)
    pieces = [*HARD, "<", "/", "turn>", "\\", "#", "## ", "User:", "Assistant:", "Role \"", " ", "ok"]
    texts = HARD + ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 8))) for _ in range(4000)]
    for text in texts:
        assert C.unescape(C.escape(text)) == text
        piece, passes = C.render_turn(rng.choice(ROLES), text)
        assert passes <= 1 and [t[1] for t in C.parse(piece)] == [text]
    turns = [(rng.choice(ROLES), t) for t in texts[:500]]
    whole, mask, _ = C.render(turns)
    assert [C.unescape(whole[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_plain_text_stays():
    text, mask, escaped = C.render([("user", "a < b \\ c # d"), ("assistant", "### heading")])
    assert text == "### User: a < b \\ c # d</turn>\n### Assistant: ### heading</turn>\n" and escaped == 0
    assert [text[a:b] for a, b in mask] == ["### heading"]


@pytest.mark.parametrize("bad", ["x", "### User: a", "### User: a</turn>", "### User: a### User: b</turn>\n", "### User: a</turn> \n", "### Role x: a</turn>\n"])
def test_parser_refuses(bad):
    with pytest.raises(C.ParseError):
        C.parse(bad)


def test_query(spark):
    rows = [tuple(r) for r in frame(SF, "conversations")[["conv_id", "turn", "role", "text"]].itertuples(index=False)]
    want = expected(rows + PLANTED_CHAT)
    got = op11_chat_format(spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want and len(got) == len(want)
    assert all(r.formatted_chars > r.loss_chars for r in got) and {r.conv_id for r in got if r.n_escaped} == {-7}


def test_edges_and_a_hot_conversation(spark, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT_CHARS", 300)
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 3, 4]), rng.choice([None, *range(40)]), rng.choice([None, *ROLES]), rng.choice([None, *HARD, "x" * 900]))
            for _ in range(900)]
    rows += rows[:50] + [(9, 0, "user", "long " * 40_000), (9, 1, "assistant", "</turn>" * 20_000)]
    # columns with names of the output
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"part": F.lit("p"), "segment": F.lit("s"), "whole": F.lit("w"), "loss_mask": F.lit(1), "a.b": F.lit(2)})
    segments = stash(C.format_chats(df.repartition(3)), "chats")
    got = C.chat_digest(segments).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows}) and segments.where("conv_id = 2").count() > 20
    assert C.chat_digest(stash(C.format_chats(df.limit(0)), "none")).count() == 0
