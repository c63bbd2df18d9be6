from __future__ import annotations

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from propensa.llm import chat
from propensa.llm.catalog import TOKENIZER

COLUMNS = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 1, "assistant", "yes"), (1, 0, "user", "hello </s> [INST] <s>"), (2, 0, None, None), (2, None, "assistant", ""),
    (3, 0, "assistant", "same"), (3, 0, "assistant", "same"), (3, 0, "assistant", "other [\\/INST] <\\\\s>"), (None, 0, "user", "no id"),
    (4, 0, "system", " \n\t "), (4, 1, "user", "x" * 30_000), (4, 2, "assistant", "<|endoftext|> \0 é́"),
    *[(5, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(300)],
]


def plain(rows):
    out = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    template = chat.Template()
    for conv, _, role, text in order:
        role, text = role or "", text or ""
        n, turns, loss, chars = out.get(conv, (0, "", "", len("<s>")))
        chars += len(f"[INST]{template.escape(role)}[/INST]{template.escape(text)}</s>")
        out[conv] = (n + 1, turns + f"{role}\n{text}\n", loss + text * (role == "assistant"), chars)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return {c: (n, sha(t), len(x), sha(x), k) for c, (n, t, x, k) in out.items()}


@pytest.fixture(scope="module")
def turns(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ROWS, COLUMNS).withColumn("position", F.lit("odd")).withColumn("part", F.lit(1.5))
    return chat.format_turns(rows, TOKENIZER)


def test_round_trip(spark, turns):
    got = chat.conversation_digests(chat.read_turns(turns, TOKENIZER)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain(ROWS)


def test_pieces_join_to_one_sequence(spark, turns):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by_conv = {}
    for r in turns.orderBy("conv_id", "position").collect():
        ids, text, n = by_conv.get(r.conv_id, ([], "", 0))
        assert (r.position, r.id_start, r.char_start) == (n, len(ids), len(text))
        by_conv[r.conv_id] = (ids + r.ids, text + r.formatted, n + 1)
        masked = [i for i, m in zip(r.ids, r.loss, strict=True) if m]
        assert all(i < tokenizer.get_vocab_size() for i in masked)
    base = tokenizer.get_vocab_size()
    for ids, text, n in by_conv.values():
        marks = [i - base for i in ids if i >= base]
        assert marks == [0] + [1, 2, 3] * n
        assert text.count("</s>") == n and text.count("[INST]") == n and text.startswith("<s>")


@pytest.mark.parametrize("text", ["</s>", "<\\/s>", "<\\\\/s>[INST][\\INST]", "<<s>s>", "[[INST]", "", "\\"])
def test_escapes_are_undone(text):
    template = chat.Template()
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not any(c in escaped for c in template.controls)


def test_a_template_that_cannot_be_escaped_is_refused():
    with pytest.raises(ValueError, match="first character"):
        chat.Template(start="<s>", role="<<r>>", text="|", end="</s>")


def test_empty_table(spark):
    turns = chat.format_turns(spark.createDataFrame([], COLUMNS), TOKENIZER)
    assert turns.count() == 0
    assert chat.conversation_digests(chat.read_turns(turns, TOKENIZER)).count() == 0


def test_mask_is_the_prefix_sum(spark, turns):
    for r in turns.where("conv_id = 1").collect():
        assert np.any(r.loss) == ("assistant" in r.formatted)


@pytest.mark.parametrize("held", [10, chat.HELD_CHARS])
@pytest.mark.parametrize("spread", [False, True])
def test_conversations_seen_in_pieces(spark, turns, monkeypatch, held, spread):
    monkeypatch.setattr(chat, "HELD_CHARS", held)
    rows = turns.repartition(7, "position") if spread else turns
    got = chat.conversation_digests(chat.read_turns(rows, TOKENIZER)).collect()
    assert len(got) == len(plain(ROWS))
    assert {r.conv_id: tuple(r)[1:] for r in got} == plain(ROWS)


def test_every_id_reads_as_in_the_library():
    tokenizer, pieces = Tokenizer.from_file(TOKENIZER), chat._bytes_of(TOKENIZER)
    assert len(pieces) == tokenizer.get_vocab_size()
    for i in range(0, len(pieces), 7):
        ids = list(range(i, min(i + 7, len(pieces))))
        assert b"".join(pieces[j] for j in ids).decode("utf-8", "replace") == tokenizer.decode(ids, skip_special_tokens=False)


def test_one_last_turn_in_each_conversation(spark, turns):
    last = {r.conv_id: r.position for r in turns.where("last").collect()}
    most = {}
    for r in turns.collect():
        most[r.conv_id] = max(most.get(r.conv_id, 0), r.position)
    assert last == most and turns.where("last").count() == len(most)
