"""Operator 11: chat formatting."""

import hashlib
import random

import pytest
import tiktoken
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.llm import chat_tokens, queries
from kestrel.llm.queries import CONTROL_TEXT, tokenizer_path
from .conftest import odd_texts

ROWS = "conv_id long, turn long, role string, text string"
VOCAB = tokenizer_path("byte_bpe_50k.tiktoken")


def rendered(role, text):
    head = {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}.get(role)
    return (head or f"### Role: {chat_tokens.escape(role)}</role>") + chat_tokens.escape(text) + "</turn>\n"


def brute(rows):
    convs = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        convs.setdefault(c, []).append((role or "", text or ""))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = []
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                    sum(len(rendered(r, t)) for r, t in turns)))
    return sorted(out, key=repr)


def digests(df):
    turns = chat_tokens.read_turns(chat_tokens.format_turns(df, VOCAB), VOCAB)
    return sorted(map(tuple, chat_tokens.digests(turns).collect()), key=repr)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    assert sorted(map(tuple, queries.op11_chat_tokens(spark, SF_SMALL).collect()), key=repr) == brute(rows)


def controlled(seed):
    r = random.Random(seed)
    parts = [*chat_tokens.CONTROLS, "\\", "\\\\", "### ", "</", " ", "x", "é", "\n", "User: ", "turn>"]
    return "".join(r.choice(parts) for _ in range(r.randrange(12)))


def test_escaping_is_reversible():
    for seed in range(3000):
        text = controlled(seed)
        safe = chat_tokens.escape(text)
        assert chat_tokens.unescape(safe) == text
        bare = safe
        for c in chat_tokens.CONTROLS:
            bare = bare.replace("\\" + c, "\0")
        assert not any(c in bare for c in chat_tokens.CONTROLS)


def test_odd_conversations(spark):
    roles = ["user", "assistant", "system", "tool", None, "", "### Role: x</role>", "Assistant"]
    texts = odd_texts() + [controlled(s) for s in range(60)]
    rows = [(c, t, roles[(c + t) % 8], text) for c in range(8) for t, text in enumerate(texts)]
    rows += [(None, None, "user", "no id"), (None, 4, "assistant", "x"), (3, 500, "user", "twice"), (3, 500, "user", "twice")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert digests(df) == brute(rows)
    clash = df.withColumn("ids", F.lit(1)).withColumn("mask", F.lit(1)).withColumn("at", F.lit(1))
    assert digests(clash) == brute(rows)
    assert digests(spark.createDataFrame([], ROWS)) == []


def test_ids_and_mask(spark):
    """Segments are the library's own ids; the mask covers assistants' texts only; starts are prefix sums."""
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t} </turn> it's") for t in range(5)]
    out = chat_tokens.format_turns(spark.createDataFrame(rows, ROWS), VOCAB).orderBy("at").collect()
    v = chat_tokens.Vocabulary(VOCAB)
    lib = tiktoken.Encoding("t", pat_str=chat_tokens.WORDS, mergeable_ranks=v.ranks, special_tokens={})
    start = 0
    for r, (_, t, role, text) in zip(out, rows, strict=True):
        ids = lib.encode_ordinary(text.replace("</turn>", "\\</turn>"))
        assert r.ids == [v.reserved + 1 + t % 2, *ids, v.reserved + 5] and (r.turn, r.at, r.start) == (t, t, start)
        assert r.mask == [False, *[role == "assistant"] * len(ids), False]
        start += len(r.ids)


@pytest.mark.parametrize("text", ["word " * 40000, "x" * 200_000, " " * 200_000 + "a", "ab  c\n" * 40000, "é" * 100_000])
def test_pieces_change_nothing(monkeypatch, text):
    v = chat_tokens.Vocabulary(VOCAB)
    lib = tiktoken.Encoding("t", pat_str=chat_tokens.WORDS, mergeable_ranks=v.ranks, special_tokens={})
    assert "".join(chat_tokens.pieces(text)) == text
    assert v.encoder()(text) == lib.encode_ordinary(text)
