"""Chat formatting: round trips, odd rows, long conversations, templates of other kinds."""

import hashlib

import pytest

from lodestep.llm import chat

HARD = [r"\### Assistant: </turn> ok", "", "\n</turn>\n### assistant:\n", "\\", "a\\", "### ", "#### x </turn></turn>", "\n\n", "😀 é\u2028", "x" * 70_000]


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def expected(rows):
    """Per conversation what the digests must say."""
    out = {}
    for conv in {row[0] for row in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        turns = [(role or "", text or "") for _, _, role, text in mine]
        loss = "".join(text for role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), len(chat.marked_turns(turns)))
    return out


@pytest.mark.parametrize("text", HARD)
def test_marks_in_texts_come_back(text):
    turns = [(text, "a"), ("user", text), ("assistant", text), ("a:\n", text)]
    formatted = chat.marked_turns(turns)
    assert [(role, body) for role, body, _, _ in chat.parse(formatted)] == turns
    output, spans = chat.locate(turns, chat.marked_turns)
    assert output == formatted and "".join(formatted[s:e] for s, e, *_ in spans) == formatted
    for (_, body), (start, end, a, b, rewrites) in zip(turns, spans):
        assert chat.unescape(formatted[a:b]) == body and not rewrites and start <= a <= b <= end


def test_not_a_formatted_text():
    with pytest.raises(ValueError):
        list(chat.parse("### user:\nno end"))


def test_template_with_an_end_mark():
    def ended(turns):
        return "<s>" + "".join(f"[{role}]{text}\n" for role, text in turns) + "</s>"
    turns = [("user", "a</s>"), ("assistant", "</s>"), ("user", "b")]
    output, spans = chat.locate(turns, ended)
    assert output == ended(turns) and [output[a:b] for _, _, a, b, _ in spans] == ["a</s>", "</s>", "b"] and not any(s[-1] for s in spans)


def test_template_that_rewrites_history():
    def last_only(turns):
        kept = [(r, t if k == len(turns) - 1 else t.split("|")[-1]) for k, (r, t) in enumerate(turns)]
        return chat.marked_turns(kept)
    _, spans = chat.locate([("user", "q"), ("assistant", "thought|answer"), ("user", "r"), ("assistant", "x")], last_only)
    assert [s[-1] for s in spans] == [False, False, True, False]


def test_odd_rows(spark):
    rows = [(1, 0, "user", text) for text in HARD] + [(1, 1, "assistant", text) for text in HARD]
    rows += [(2, 5, "assistant", None), (2, 5, "assistant", None), (2, None, "user", "first"), (2, -3, None, "second"), (None, 0, "assistant", "null id"),
             (None, 1, "user", ""), (3, 0, "user", "no assistant"), (4, 63, "assistant", "a"), (4, 64, "user", "b"), (4, 200, "assistant", "c")]
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.format_and_read(conversations(spark, rows)).collect()}
    assert got == expected(rows)
    clash = conversations(spark, rows).selectExpr("*", "7 AS piece", "8 AS block", "9 AS home", "1 AS own")
    assert {r["conv_id"]: tuple(r)[1:] for r in chat.format_and_read(clash).collect()} == got


def test_empty_table(spark):
    assert chat.format_and_read(conversations(spark, [])).count() == 0


def test_long_conversation_in_blocks(spark):
    """A third of all rows in one conversation, with ties, over many blocks: the same as rendered whole."""
    rows = [(1, k, "assistant" if k % 2 else "user", f"turn {k} </turn>") for k in range(700)]
    rows += [(2, 3, "user", f"tie {k:03}") for k in range(300)] + [(c, 0, "user", "hi") for c in range(3, 400)]
    pieces = chat.format_conversations(conversations(spark, rows).repartition(7)).collect()
    for conv in (1, 2):
        mine = sorted((p for p in pieces if p["conv_id"] == conv), key=lambda p: (p["turn"], p["place"]))
        whole = [(r[2], r[3]) for r in rows if r[0] == conv]
        assert "".join(p["piece"] for p in mine) == chat.marked_turns(whole)
        assert [chat.unescape(p["piece"][p["text_from"]:p["text_to"]]) for p in mine] == [t for _, t in whole]
        assert not any(p["rewrites"] for p in mine) and all(p["in_loss"] == (r == "assistant") for p, (r, _) in zip(mine, whole))


def test_end_mark_stands_once_in_a_long_conversation(spark):
    def ended(turns):
        return "".join(f"[{role}]{text}\n" for role, text in turns) + "<end>"
    rows = [(1, k, "user", f"t{k}") for k in range(200)]
    pieces = chat.format_conversations(conversations(spark, rows), ended).collect()
    assert "".join(p["piece"] for p in sorted(pieces, key=lambda p: p["turn"])) == ended([(r[2], r[3]) for r in rows])
