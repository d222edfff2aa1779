from __future__ import annotations

import hashlib

import numpy as np
from capstream.llm import op3_chat as op
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import tables

PIECES = st.sampled_from([*op.CONTROL, *[c[0] + "\\" + c[1:] for c in op.CONTROL], "<", "\\", "[", "|", "a", " ", "漢"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    escaped = op.escape(text)
    assert op.unescape(escaped) == text
    assert not any(c in escaped for c in op.CONTROL)


def test_mask_and_round_trip():
    tokenizer = op.Tokenizer()
    turns = [("user", "hi <|end|>"), ("assistant", "ok </s>\n"), ("tool\n", ""), ("assistant", "")]
    parts = [op.assemble(tokenizer, r, t) for r, t in turns]
    ids, mask = np.concatenate([np.array(i) for i, _ in parts]), np.concatenate([m for _, m in parts])
    assert [int(i) for i in ids if i >= tokenizer.first_reserved] == [tokenizer.reserved[n] for n in op.RESERVED] * 4
    assert op.unescape(tokenizer.decode(ids[mask == 1].tolist())) == "ok </s>\n"
    reader = op.Reader(tokenizer)
    reader.read(ids, mask)
    assert reader.n_turns == 4 and reader.loss_chars == 8
    assert reader.turns.hexdigest() == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_conversations_against_brute_force(spark):
    rows = tables.rows()["conversations"]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for chunk in (op.CHUNK_TOKENS, 3):
        got = {r.conv_id: r for r in op.digests(op.format_conversations(df, chunk_tokens=chunk)).collect()}
        assert set(got) == {r[0] for r in rows}
        for conv, found in got.items():
            own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
            assert found.n_turns == len(own)
            assert found.turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
            loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
            assert (found.loss_chars, found.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
            tags = sum(map(len, op.RESERVED))
            assert found.formatted_chars == sum(tags + len(op.escape(r[2] or "")) + len(op.escape(r[3] or "")) for r in own)


def test_ties_are_ordered_by_text_and_nulls_are_empty(spark):
    rows = [(1, 0, "user", x) for x in ("zebra", "a", "  b", "Ä", "aa", "<|end|>", "")] + [(1, 0, None, "q"), (1, 0, "", "c"), (1, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    want = sorted(((t is not None, t or 0, (r or "").encode(), (x or "").encode()) for _, t, r, x in rows))
    whole = b"".join(r + b"\n" + x + b"\n" for _, _, r, x in want)
    assert op.digests(op.format_conversations(df)).first().turns_sha256 == hashlib.sha256(whole).hexdigest()


def test_long_texts_get_the_ids_of_the_whole(spark):
    import random

    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "12345", "é漢", "!?", "'s"]) for _ in range(120_000))
    tokenizer = op.Tokenizer()
    ids, mask = op.assemble(tokenizer, "assistant", text)
    body = [i for i, m in zip(ids, mask) if m]
    assert len(text) > 200_000 and body == tokenizer._encoding.encode_ordinary(op.escape(text)) and op.unescape(tokenizer.decode(body)) == text
