"""Conversation structure repair: a checkpointed dynamic programme over turns.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Rows are taken by turn (nulls
first), equal turns by role and text.  The edits and their costs: Keep 0, Rerole to user or assistant 2,
Delete 3, Insert an empty user or assistant turn anywhere 2; a blank or duplicate row must
go, and a truncated row that stays costs 1 more.  Of the cheapest edit strings (D, I, K,
R in order) the ASCII-least is taken.

The programme runs backward over four states (nothing yet, after s, after u, after a) and its
cost vectors are kept only at checkpoints, every ``ceil(sqrt(n))`` rows of the longest
conversation (``LEAST_BLOCK`` at least):

1. rows without their texts (a digest and flags stand for a text; equal rows of a turn are
   counted first) are sorted by range, so that a long conversation lies in many tasks, and cut into
   blocks; each block gives the 4 x 4 table of cheapest costs from the state before it to the
   state behind it;
2. per conversation, backward over these tables: the cost vector at every checkpoint;
3. per block, all in parallel: the vectors inside the block are recomputed from its checkpoint, and
   the forward walk along tight edits, the least letter first, is made from each of the four states;
4. per conversation, forward: the state at each block's start picks its walk;
5. the texts meet the edits in one shuffle by conversation; a task streams its rows in order and
   holds one Arrow batch and the edits that wait for their rows (one byte a row).

Steps 1 and 3 spread a conversation over tasks; steps 2 and 4 see one short row per block.  Step 5
brings a conversation's rows to one task in order but does not collect them, since its
consumers read turns in order.

Edge cases: null conversation ids are one conversation; null roles and texts count as empty.  A row
is blank without a character other than space and 09-0D, a duplicate if role and text occurred
earlier in the conversation (texts compared by SHA-256), truncated if its last such character
is none of ``.!?``; the first fault counts.  Repeated rows are duplicates, whatever their turn.  Roles with other
initials can only be reroled or deleted.  A very long text crosses the shuffle and is held
with its batch.  An empty table gives no rows.  Other columns are not carried, so their names do
not matter.
"""

from __future__ import annotations

import functools
import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import NOT_SPACE, text_or_empty, written
from kestrel.session import ship_package

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEAST_BLOCK = 64
FAULTS = (None, "blank", "duplicate", "truncated")
#: Costs of the inserts that end a conversation, by state: nothing yet, after s, after u, after a.
END = (0, 2 * INSERT, INSERT, 0)
#: State behind an inserted or reroled turn, by state; the turn is a user's if it leads to state 2.
NEXT = (2, 2, 3, 2)
FAR = 1 << 60


def code_of(role: str, fault: int) -> str:
    """One letter per row: four kinds of role (s, u, a, other) by four faults."""
    kind = "sua".find(role[:1]) if role else 3
    return chr(97 + 4 * (kind if kind >= 0 else 3) + fault)


def kept_state(kind: int, state: int) -> int:
    """State behind a kept row of this kind; -1 if it does not fit."""
    if kind == 0:
        return 1 if state == 0 else -1
    if kind == 1:
        return 2 if state != 2 else -1
    return 3 if kind == 2 and state == 2 else -1


def back(code: str, after: tuple) -> tuple:
    """Cost vector before a row, from the one behind it."""
    kind, fault = divmod(ord(code) - 97, 4)
    base = [DELETE + v for v in after]
    if fault not in (1, 2):
        more = TRUNCATED if fault == 3 else 0
        for s in range(4):
            base[s] = min(base[s], REROLE + more + after[NEXT[s]])
            k = kept_state(kind, s)
            if k >= 0:
                base[s] = min(base[s], KEEP + more + after[k])
    u, a = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
    return min(base[0], INSERT + u), min(base[1], INSERT + u), u, a


def _table(codes: str) -> tuple:
    """Cheapest cost from each state before ``codes`` to each state behind, row by row."""
    columns = []
    for s in range(4):
        v = tuple(0 if t == s else FAR for t in range(4))
        for c in reversed(codes):
            v = back(c, v)
        columns.append(v)
    return tuple(min(columns[t][s], FAR) for s in range(4) for t in range(4))


def _walks(codes: str, after: tuple, last: bool) -> tuple:
    """(edits, state behind) of the least tight walk from each state.

    ``after`` is the cost vector behind the block; behind the ``last`` one, inserts follow."""
    costs = [after]
    for c in reversed(codes):
        costs.append(back(c, costs[-1]))
    costs.reverse()
    out = []
    for state in range(4):
        edits = []
        for i, c in enumerate(codes):
            kind, fault = divmod(ord(c) - 97, 4)
            here, behind = costs[i], costs[i + 1]
            more = TRUNCATED if fault == 3 else 0
            while True:
                left = here[state]
                if DELETE + behind[state] == left:
                    edits.append("D")
                    break
                if INSERT + here[NEXT[state]] == left:
                    edits.append("I")
                    state = NEXT[state]
                    continue
                k = kept_state(kind, state)
                if k >= 0 and KEEP + more + behind[k] == left:
                    edits.append("K")
                    state = k
                else:
                    edits.append("R")
                    state = NEXT[state]
                break
        while last and after[state]:
            edits.append("I")
            state = NEXT[state]
        out.append(("".join(edits), state))
    return tuple(out)


_short_table, _short_walks = functools.lru_cache(1 << 16)(_table), functools.lru_cache(1 << 16)(_walks)


def table(codes: str) -> tuple:
    return (_short_table if len(codes) <= LEAST_BLOCK else _table)(codes)


def walks(codes: str, after: tuple, last: bool) -> tuple:
    return (_short_walks if len(codes) <= LEAST_BLOCK else _walks)(codes, after, last)


def _marked(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    return df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_or_empty(role).alias("role"),
                     text_or_empty(text).alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def _counted(rows: DataFrame) -> DataFrame:
    """One row per equal (conv, turn, role, text), with its count and its first row's fault."""
    last = F.regexp_extract("text", rf"(?s)({NOT_SPACE})[\x20\x09-\x0D]*\z", 1)
    kinds = rows.select("conv", "turn", "role", "digest", (last == "").alias("blank"),
                        (~last.isin(".", "!", "?")).alias("cut"))
    runs = written(kinds.groupBy("conv", "turn", "role", "digest", "blank", "cut").agg(F.count(F.lit(1)).alias("n")),
                   "turn-runs")  # read three times
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"))
    again = (runs.groupBy("conv", "role", "digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("turns"))
             .where("turns > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"),
                                        F.col("digest").alias("d"), "first"))
    both = runs.join(again, runs.conv.eqNullSafe(again.c) & (runs.role == again.r) & (runs.digest == again.d), "left")
    repeat = F.col("first").isNotNull() & (order != F.col("first"))
    fault = F.when(F.col("blank"), 1).when(repeat, 2).when(F.col("cut"), 3).otherwise(0)
    return both.select("conv", "turn", "role", "digest", "n", fault.alias("fault"))


_KEY = ("conv", "turn", "role", "digest")


def _blocks(runs: DataFrame) -> DataFrame:
    """Blocks of codes in range order with their cost tables, written."""
    longest = runs.groupBy("conv").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] or 0
    step = max(LEAST_BLOCK, math.isqrt(max(0, longest - 1)) + 1)
    key = [F.col(c).asc_nulls_first() for c in _KEY]
    rows = runs.repartitionByRange(*key).sortWithinPartitions(*key)

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        seq = TaskContext.get().partitionId() << 40
        first, codes, size, done = None, [], 0, []

        def close():
            nonlocal seq
            text = "".join(codes)
            done.append((*first, seq, text, list(table(text))))
            codes.clear()
            seq += 1

        def out():
            batch = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), kinds)], names=names)
            done.clear()
            return batch

        kinds = names = None
        for b in batches:
            kinds = [*(b.column(c).type for c in _KEY), pa.int64(), pa.string(), pa.list_(pa.int64())]
            names = [*_KEY, "seq", "codes", "table"]
            for conv, turn, role, digest, n, fault in zip(*(b.column(c).to_pylist() for c in (*_KEY, "n", "fault"))):
                if codes and (conv != first[0] or size >= step):
                    close()
                    size = 0
                if not codes:
                    first = conv, turn, role, digest
                codes.append(code_of(role, fault))
                size += 1
                more, again = n - 1, code_of(role, 1 if fault == 1 else 2)
                while more:
                    if size >= step:
                        close()
                        first, size = (conv, turn, role, digest), 0
                    take = min(more, step - size)
                    codes.append(again * take)
                    more, size = more - take, size + take
                    if len(done) >= 1024:
                        yield out()
            if done:
                yield out()
        if codes:
            close()
            yield out()

    schema = T.StructType([*runs.select(*_KEY).schema.fields, T.StructField("seq", T.LongType()),
                           T.StructField("codes", T.StringType()), T.StructField("table", T.ArrayType(T.LongType()))])
    return written(rows.mapInArrow(cut, schema), "turn-blocks")


def _by_conversation(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), *order)


def _with_column(batch, drop: str, **new):
    import pyarrow as pa

    keep = [c for c in batch.schema.names if c != drop]
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *new.values()], names=[*keep, *new])


def edits(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
          text: str = "text") -> DataFrame:
    """Blocks of edits: (conv, turn, role, digest) of a block's first row, seq (its order), codes
    (one letter a row) and audit (the edits; the last block's end with the final inserts)."""
    ship_package(df.sparkSession)
    blocks = _blocks(_counted(_marked(df, conv, turn, role, text)))
    kept = [f for f in blocks.schema.fields if f.name != "table"]

    def backward(batches):
        import pyarrow as pa

        at, v = (), END
        for b in batches:
            after, last = [], []
            for c, t in zip(b.column("conv").to_pylist(), b.column("table").to_pylist()):
                last.append((c,) != at)
                if last[-1]:
                    at, v = (c,), END
                after.append(v)
                v = tuple(min(t[4 * s + k] + v[k] for k in range(4)) for s in range(4))
            yield _with_column(b, "table", after=pa.array(after, pa.list_(pa.int64())), last=pa.array(last, pa.bool_()))

    def walk(batches):
        import pyarrow as pa

        for b in batches:
            found = []
            for codes, after, last in zip(*(b.column(c).to_pylist() for c in ("codes", "after", "last"))):
                least = min(after)  # only differences matter, except behind the last row, where the least is 0
                found.append(walks(codes, tuple(v - least for v in after), last))
            b = _with_column(b, "after", audits=pa.array([[a for a, _ in w] for w in found], pa.list_(pa.string())),
                             ends=pa.array([[s for _, s in w] for w in found], pa.list_(pa.int32())))
            yield _with_column(b, "last")

    def forward(batches):
        import pyarrow as pa

        at, state = (), 0
        for b in batches:
            audit = []
            for c, a, e in zip(*(b.column(c).to_pylist() for c in ("conv", "audits", "ends"))):
                if (c,) != at:
                    at, state = (c,), 0
                audit.append(a[state])
                state = e[state]
            yield _with_column(_with_column(b, "audits"), "ends", audit=pa.array(audit, pa.string()))

    def with_fields(*more):
        return T.StructType([*kept, *(T.StructField(n, k) for n, k in more)])

    ends = _by_conversation(blocks, F.col("seq").desc()).mapInArrow(
        backward, with_fields(("after", T.ArrayType(T.LongType())), ("last", T.BooleanType())))
    walked = ends.repartition("conv", "seq").mapInArrow(
        walk, with_fields(("audits", T.ArrayType(T.StringType())), ("ends", T.ArrayType(T.IntegerType()))))
    return _by_conversation(walked, "seq").mapInArrow(forward, with_fields(("audit", T.StringType())))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """Every edit as a row: (``conv``, at, edit, fault, turn, role_before, role, text).

    ``at`` counts a conversation's edits from 0.  Deleted rows keep turn, role_before and text and
    have a null role; inserted rows have null turn and role_before and an empty text.  The repaired
    conversation is the rows with a role, by ``at``.  A conversation's rows stand together in this order
    within one partition."""
    rows = _marked(df, conv, turn, role, text)
    letters = F.lit(None).cast("string")
    found = edits(df, conv, turn, role, text)
    stream = rows.select(*_KEY, F.lit(1).alias("tag"), F.lit(0).cast("long").alias("seq"), "text",
                         letters.alias("codes"), letters.alias("audit"))
    stream = stream.unionByName(found.select(*_KEY, F.lit(0).alias("tag"), "seq", letters.alias("text"), "codes", "audit"))
    stream = _by_conversation(stream, F.col("turn").asc_nulls_first(), "role", "digest", "tag", "seq")

    def run(batches):
        import pyarrow as pa

        at, codes, audit = (), [], []  # codes and edits that wait for their rows, in order
        row = edit = place = state = 0
        conv_kind = turn_kind = None

        def take(queue, i):
            """Letter ``i`` of the queue's first block; used-up blocks go."""
            while queue and i >= len(queue[0]):
                i -= len(queue.pop(0))
            return (queue[0][i] if queue else None), i

        def inserts():
            """Inserts that stand next."""
            nonlocal edit, place, state
            while True:
                letter, edit = take(audit, edit)
                if letter != "I":
                    return
                state = NEXT[state]
                cells.append((at[0], place, "I", None, None, None, "user" if state == 2 else "assistant", None))
                edit, place = edit + 1, place + 1

        def out(texts):
            columns = list(zip(*cells))
            text = texts.take(pa.array(columns.pop(), pa.int64())).fill_null("")
            kinds = [conv_kind, pa.int64(), pa.string(), pa.string(), turn_kind, pa.string(), pa.string()]
            cells.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(columns, kinds)), text], names=names)

        cells: list[tuple] = []
        names = [conv, "at", "edit", "fault", "turn", "role_before", "role", "text"]
        for b in batches:
            conv_kind, turn_kind = b.column("conv").type, b.column("turn").type
            small = [b.column(c).to_pylist() for c in ("conv", "turn", "role", "tag", "codes", "audit")]
            for i, (c, t, r, tag, code, letters) in enumerate(zip(*small)):
                if (c,) != at:
                    if at:
                        inserts()
                    at, codes, audit = (c,), [], []
                    row = edit = place = state = 0
                if not tag:
                    codes.append(code)
                    audit.append(letters)
                    continue
                inserts()
                letter, edit = take(audit, edit)
                code, row = take(codes, row)
                fault = FAULTS[(ord(code) - 97) % 4]
                after = None
                if letter == "K":
                    state, after = kept_state((ord(code) - 97) // 4, state), r
                elif letter == "R":
                    state = NEXT[state]
                    after = "user" if state == 2 else "assistant"
                cells.append((c, place, letter, fault, t, r, after, i))
                row, edit, place = row + 1, edit + 1, place + 1
            if cells:
                yield out(b.column("text"))
        if at:
            inserts()
            if cells:
                yield out(pa.array([], pa.string()))

    kinds = {f.name: f.dataType for f in rows.schema.fields}
    text_kind, long_kind = T.StringType(), T.LongType()
    schema = T.StructType([T.StructField(conv, kinds["conv"]), T.StructField("at", long_kind),
                           T.StructField("edit", text_kind), T.StructField("fault", text_kind),
                           T.StructField("turn", kinds["turn"]), T.StructField("role_before", text_kind),
                           T.StructField("role", text_kind), T.StructField("text", text_kind)])
    return stream.mapInArrow(run, schema)


def summary(repaired: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Per conversation of ``repair``'s rows (read in their order, without a shuffle): gaps, the
    faults, illegal, cost, audit and repaired_sha256, the digest of the newline-joined ``role:text``."""
    counts = ("gaps", *FAULTS[1:], "illegal", "cost")
    price = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def run(batches):
        import pyarrow as pa

        at, done = (), []
        kind = None

        def close():
            if at:
                stats["gaps"] = max(0, high - low + 1 - distinct) if distinct else 0
                done.append((at[0], *(stats[k] for k in counts), "".join(audit), sha.hexdigest()))

        def out():
            columns = list(zip(*done))
            done.clear()
            kinds = [kind, *[pa.int64()] * len(counts), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              names=[conv, *counts, "audit", "repaired_sha256"])

        for b in batches:
            kind = b.column(conv).type
            names = (conv, "edit", "fault", "turn", "role_before", "role")
            texts = b.column("text")
            for i, (c, edit, fault, turn, before, role) in enumerate(zip(*(b.column(n).to_pylist() for n in names))):
                if (c,) != at:
                    close()
                    at, stats, audit, sha = (c,), dict.fromkeys(counts, 0), [], hashlib.sha256()
                    low = high = initial = None
                    distinct, started = 0, False
                audit.append(edit)
                stats["cost"] += price[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if fault:
                    stats[fault] += 1
                if edit != "I":
                    if turn is not None:  # turns come in order
                        low = turn if low is None else low
                        distinct += turn != high
                        high = turn
                    if initial is not None and initial + before[:1] not in ("su", "ua", "au"):
                        stats["illegal"] += 1
                    initial = before[:1]
                if role is not None:
                    sha.update(f"{chr(10) if started else ''}{role}:".encode())
                    sha.update(texts[i].as_buffer())
                    started = True
            if done:
                yield out()
        close()
        if done:
            yield out()

    schema = T.StructType([repaired.schema[conv], *(T.StructField(k, T.LongType()) for k in counts),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    return repaired.mapInArrow(run, schema)
