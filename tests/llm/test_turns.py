"""Operator 13: conversation structure repair."""

import functools
import hashlib
import random
import re
import zlib

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.llm import queries, turn_repair

BLANK = re.compile(r"[^\x20\x09-\x0D]")
ROWS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    """Rows in order with their first fault."""
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    seen, out = set(), []
    for _, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], digest(r[3]))):
        chars = BLANK.findall(text)
        fault = ("blank" if not chars else "duplicate" if (role, text) in seen else
                 "truncated" if chars[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """(cost, edits, repaired lines) by trying every edit at every place."""
    n = len(rows)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == n and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 2:
            for role in ("user", "assistant"):
                if to := step.get((state, role[0])):
                    c, e, t = best(i, to, inserted + 1)
                    found.append((c + 2, "I" + e, (role + ":", *t)))
        if i < n:
            _, role, text, fault = rows[i]
            c, e, t = best(i + 1, state, 0)
            found.append((c + 3, "D" + e, t))
            if fault in (None, "truncated"):
                more = int(fault is not None)
                for to_role, price, letter in ((role, 0, "K"), ("user", 2, "R"), ("assistant", 2, "R")):
                    if to := step.get((state, to_role[:1])):
                        c, e, t = best(i + 1, to, 0)
                        found.append((c + price + more, letter + e, (f"{to_role}:{text}", *t)))
        return min(found, default=(1 << 30, "", ()))

    return best(0, "", 0)


def brute(conversation_rows):
    convs = {c: [] for c, *_ in conversation_rows}
    for r in damage(conversation_rows):
        convs[r[0]].append(r)
    out = []
    for conv, rows in convs.items():
        rows = faults(rows)
        turns = {t for t, *_ in rows if t is not None}
        initials = [r[:1] for _, r, _, _ in rows]
        cost, audit, lines = cheapest(tuple(rows))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(sum(f == k for *_, f in rows) for k in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, queries.repaired_digests(df).collect()), key=repr)


def test_query_is_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op13_turn_repair(spark, SF_SMALL).collect()), key=repr) == brute(rows)


def random_rows(n_convs, seed, longest=9):
    r = random.Random(seed)
    texts = ["Yes.", "Yes.", "No!", "cut", " \t\n", "", "a longer text. ", "é?\x0b", None, "line\nbreak."]
    roles = ["user", "assistant"] * 4 + ["system", "system", "tool", "student", "", None]
    return [(c, r.choice([t, t, r.randrange(5), None]), r.choice(roles), r.choice(texts) if r.random() < .7 else f"t{r.random()}.")
            for c in range(n_convs) for t in range(r.randrange(1, longest))]


def test_random_conversations(spark):
    rows = random_rows(300, 5) + [(None, 1, "user", "no id."), (None, None, "assistant", "still none")]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    assert got(df) == brute(rows)
    clash = df.withColumn("text2", F.lit(1)).withColumn("audit", F.lit("x")).withColumn("n", F.lit(1)).withColumn("edit", F.lit(0))
    assert got(clash) == brute(rows)


@pytest.mark.parametrize("least", [1, 3])
def test_checkpoints(spark, monkeypatch, least):
    """Conversations of many blocks, in many range partitions, with long runs of equal rows."""
    monkeypatch.setattr(turn_repair, "LEAST_BLOCK", least)
    rows = random_rows(6, 9, longest=120) + [(7, 3, "user", "again.")] * 150 + [(7, t, "user", "ok") for t in range(90)]
    rows += [(8, t, "system" if t == 0 else ("user", "assistant")[t % 2], f"turn {t}.") for t in range(300)]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    assert got(df) == brute(rows)
    assert turn_repair.edits(df).count() > 30


def test_no_rows_and_long_text(spark):
    none = spark.createDataFrame([], ROWS)
    assert got(none) == [] and turn_repair.repair(none).collect() == []
    dropped = next(t for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    rows = [(1, dropped, "user", "gone."), (2, 1, "user", "x" * 3_000_000 + " " * 1_000_000)]
    assert got(spark.createDataFrame(rows, ROWS)) == brute(rows)


def test_repaired_rows(spark):
    rows = [(1, 1, "assistant", "A."), (1, 2, "user", "U."), (1, 3, "user", "U."), (1, 4, "user", " ")]
    out = turn_repair.repair(spark.createDataFrame(rows, ROWS)).orderBy("at").collect()
    assert [(r.edit, r.fault, r.turn, r.role, r.text) for r in out] == [
        ("I", None, None, "user", ""), ("K", None, 1, "assistant", "A."), ("K", None, 2, "user", "U."), ("D", "duplicate", 3, None, "U."),
        ("D", "blank", 4, None, " "), ("I", None, None, "assistant", "")]
