r"""Chat formatting by token-level assembly.

*Template.*  A turn is ``### User: `` (System, Assistant), the text, ``</turn>`` and a line break;
another role reads ``### Role: `` role ``</role>``.  Each of these control strings is one
reserved id behind the vocabulary.  A control string inside a text (or a role) gets a
backslash in front, also when it has some already: ``\### User: `` becomes
``\\### User: ``.  Taking one backslash from each control string that has any gives the text
back, and a control string without a backslash is never part of a text.

*Assembly.*  Every text is encoded on its own, after escaping, by a byte-level BPE vocabulary;
the reserved ids are spliced around it.  No text can make a reserved id.  A conversation's
rows meet in one shuffle by conversation, as ids of two bytes (four for large
vocabularies), and a task streams them by turn: prefix sums of the turns' lengths give each turn's
place in the conversation, and the loss mask is the prefix sum of +1 where an
assistant's text begins and -1 where it ends.  Encoding, the heavy part, is done before the
shuffle; a long conversation is streamed and never held.

*Reading back.*  Ids and mask alone give roles, texts, the text under the mask and the
formatted text.

Edge cases: null conversation ids are one conversation; null turns come first; rows of equal turn are
ordered by their ids, so the order is the same in every run; repeated rows are turns of their
own.  Null roles and texts are empty.  Texts of any length are encoded whole; beyond ``PIECE``
characters they are handed over in pieces cut before a single space, where the vocabulary's
pattern cuts too (a run without such a space is cut after ``16 * PIECE``).  An empty table gives no
rows.  Other columns are not carried, so their names do not matter.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import release_memory, text_or_empty
from kestrel.session import ship_package

# The template's control strings; reserved ids follow this order.
CONTROLS = ("### System: ", "### User: ", "### Assistant: ", "### Role: ", "</role>", "</turn>")
ROLES = ("system", "user", "assistant")
LINE_END = "\n"
PIECE = 1 << 16
#: Pattern of the byte-level vocabulary's words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_CONTROL = re.compile(r"\\*(?:" + "|".join(map(re.escape, CONTROLS)) + ")")
_ESCAPED = re.compile(r"\\(\\*(?:" + "|".join(map(re.escape, CONTROLS)) + "))")
_SPACE = re.compile(r"(?<=\S) (?=\S)")


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def pieces(text: str):
    """``text`` in pieces that the vocabulary's pattern would cut as well."""
    at = 0
    while len(text) - at > PIECE:
        m = _SPACE.search(text, at + PIECE, at + 16 * PIECE)
        end = m.start() if m else min(len(text), at + 16 * PIECE)
        yield text[at:end]
        at = end
    yield text[at:] if at else text


class Vocabulary:
    """A tiktoken rank file, with the reserved ids behind it."""

    def __init__(self, path: str):
        import base64

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.reserved = max(self.ranks.values()) + 1
        self.kind = "<u2" if self.reserved + len(CONTROLS) <= 1 << 16 else "<u4"

    def encoder(self):
        import tiktoken

        enc = tiktoken.Encoding("chat", pat_str=WORDS, mergeable_ranks=self.ranks, special_tokens={})
        return lambda text: [i for p in pieces(text) for i in enc.encode_ordinary(p)]

    def labels(self):
        """(all labels' bytes, their ends): decoding is a gather."""
        import numpy as np

        out = [b""] * (self.reserved + len(CONTROLS))
        for s, i in self.ranks.items():
            out[i] = s
        for i, s in enumerate(CONTROLS):
            out[self.reserved + i] = (s + (LINE_END if s == CONTROLS[-1] else "")).encode()
        return np.frombuffer(b"".join(out), np.uint8), np.cumsum([0, *map(len, out)])


def turn_ids(role: str, ids: list[int], reserved: int, encode) -> tuple[list[int], int]:
    """Ids of a turn, and where its text begins."""
    if role in ROLES:
        head = [reserved + ROLES.index(role)]
    else:
        head = [reserved + 3, *encode(escape(role)), reserved + 4]
    return [*head, *ids, reserved + 5], len(head)


def format_turns(df: DataFrame, vocabulary: str, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """(``conv``, ``turn``, at, start, ids, mask) of every turn: ``at`` counts turns and ``start`` the
    conversation's ids before this turn; ``mask`` is true on ids under the loss.  A conversation's
    turns stand together in order within one partition."""
    ship_package(df.sparkSession)
    vocab = df.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_or_empty(role).alias("role"),
                     text_or_empty(text).alias("text"))

    def encoded(batches):
        import numpy as np
        import pyarrow as pa

        v = vocab.value
        encode = v.encoder()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ids, first, end = [], [], []
                for r, t in zip(b.column("role").to_pylist(), b.column("text").to_pylist()):
                    made, begin = turn_ids(r, encode(escape(t)), v.reserved, encode)
                    ids.append(np.array(made, v.kind).tobytes())
                    first.append(begin if r == "assistant" else 0)
                    end.append(len(made) - 1 if r == "assistant" else 0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv"), b.column("turn"), pa.array(ids, pa.binary()), pa.array(first, pa.int32()),
                     pa.array(end, pa.int32())], names=["conv", "turn", "ids", "loss_from", "loss_to"])
        release_memory()

    keys = rows.select("conv", "turn").schema.fields
    segments = rows.mapInArrow(encoded, T.StructType([*keys, T.StructField("ids", T.BinaryType()),
                                                      T.StructField("loss_from", T.IntegerType()),
                                                      T.StructField("loss_to", T.IntegerType())]))
    segments = segments.repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "ids")

    def assembled(batches):
        import numpy as np
        import pyarrow as pa

        kind = vocab.value.kind
        held, place, start = (), 0, 0  # the conversation, its turns and ids so far
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ids = [np.frombuffer(x.as_buffer(), kind) for x in b.column("ids")]
                size = np.array([len(x) for x in ids], np.int64)
                ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
                first, last = (b.column(c).to_numpy() for c in ("loss_from", "loss_to"))
                step = np.zeros(ends[-1] + 1, np.int8)
                lossy = last > first
                np.add.at(step, ends[:-1][lossy] + first[lossy], 1)
                np.add.at(step, ends[:-1][lossy] + last[lossy], -1)
                mask = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
                places, starts = [], []
                for c, n in zip(b.column("conv").to_pylist(), size.tolist()):
                    if (c,) != held:
                        held, place, start = (c,), 0, 0
                    places.append(place)
                    starts.append(start)
                    place, start = place + 1, start + n
                cuts = pa.array(ends.astype(np.int32))
                flat = np.concatenate(ids).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv"), b.column("turn"), pa.array(places, pa.int64()), pa.array(starts, pa.int64()),
                     pa.ListArray.from_arrays(cuts, pa.array(flat)), pa.ListArray.from_arrays(cuts, pa.array(mask))],
                    names=[conv, turn, "at", "start", "ids", "mask"])
        release_memory()

    kinds = [f.dataType for f in keys]
    return segments.mapInArrow(assembled, T.StructType([
        T.StructField(conv, kinds[0]), T.StructField(turn, kinds[1]), T.StructField("at", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("mask", T.ArrayType(T.BooleanType()))]))


def _decoded(ids, ends, labels) -> list[bytes]:
    """Bytes of the runs of ``ids`` that end at ``ends``."""
    import numpy as np

    raw, cut = labels
    first, size = cut[ids], cut[ids + 1] - cut[ids]
    stop = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    out = raw[np.arange(stop[-1]) + np.repeat(first - stop[:-1], size)]
    at = stop[ends]
    return [out[i:j].tobytes() for i, j in zip(at, at[1:])]


def read_turns(formatted: DataFrame, vocabulary: str, conv: str = "conv_id") -> DataFrame:
    """(``conv``, at, role, text, loss_text, formatted) of every turn, from ids and mask alone; in the
    same order as ``formatted``, without a shuffle."""
    vocab = formatted.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        labels, reserved = vocab.value.labels(), vocab.value.reserved
        role_end = CONTROLS[4].encode()
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                ends = b.column("ids").offsets.to_numpy().astype(np.int64)
                ends = ends - ends[0]
                ids = b.column("ids").flatten().to_numpy().astype(np.int64)
                mask = b.column("mask").flatten().to_numpy(zero_copy_only=False)
                under = np.concatenate([np.zeros(1, np.int64), np.cumsum(mask)])[ends]
                full, loss = _decoded(ids, ends, labels), _decoded(ids[mask], under, labels)
                marker = ids[ends[:-1]] - reserved
                plain = ids.copy()  # the control ids behind the marker end role and turn
                roles, texts = [], []
                for i, kind in enumerate(marker.tolist()):
                    own = plain[ends[i]:ends[i + 1]]
                    begin = 1 if kind < 3 else int(np.flatnonzero(own == reserved + 4)[0]) + 1
                    head = sum(int(labels[1][t + 1] - labels[1][t]) for t in own[:begin])
                    if kind < 3:
                        roles.append(ROLES[kind])
                    else:
                        roles.append(unescape(full[i][len(CONTROLS[3]):head - len(role_end)].decode()))
                    texts.append(unescape(full[i][head:len(full[i]) - len(CONTROLS[5] + LINE_END)].decode()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(conv), b.column("at"), pa.array(roles, pa.string()), pa.array(texts, pa.string()),
                     pa.array([unescape(x.decode()) for x in loss], pa.string()),
                     pa.array([x.decode() for x in full], pa.string())],
                    names=[conv, "at", "role", "text", "loss_text", "formatted"])
        release_memory()

    kinds = [(n, T.StringType()) for n in ("role", "text", "loss_text", "formatted")]
    return formatted.mapInArrow(run, T.StructType([formatted.schema[conv], T.StructField("at", T.LongType()),
                                                   *(T.StructField(n, k) for n, k in kinds)]))


def digests(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``read_turns``' rows, streamed in their order."""
    names = (conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")

    def run(batches):
        import pyarrow as pa

        at, done, kind = (), [], None

        def close():
            if at:
                done.append((at[0], n, turns_sha.hexdigest(), loss_chars, loss_sha.hexdigest(), chars))

        def out():
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*done))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

        for whole in batches:
            kind = whole.column(conv).type
            for first in range(0, whole.num_rows, 1024):
                b = whole.slice(first, 1024)
                cells = (b.column(c).to_pylist() for c in (conv, "role", "text", "loss_text", "formatted"))
                for c, role, text, loss, formatted in zip(*cells):
                    if (c,) != at:
                        close()
                        at, n, loss_chars, chars = (c,), 0, 0, 0
                        turns_sha, loss_sha = hashlib.sha256(), hashlib.sha256()
                    n += 1
                    turns_sha.update(f"{role}\n{text}\n".encode())
                    loss_sha.update(loss.encode())
                    loss_chars += len(loss)
                    chars += len(formatted)
                if done:
                    yield out()
        close()
        if done:
            yield out()

    long_kind, text_kind = T.LongType(), T.StringType()
    return turns.mapInArrow(run, T.StructType([
        turns.schema[conv], *(T.StructField(n, text_kind if n.endswith("sha256") else long_kind) for n in names[1:])]))
