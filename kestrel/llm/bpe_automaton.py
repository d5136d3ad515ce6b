"""BPE encoding and decoding with a tokenization automaton.

**Compilation.**  The automaton runs over token sequences and accepts exactly the
sequences that BPE produces.  It starts as one loop per byte symbol.  Merges are
added in rank order, each as a merge gadget for ``u v -> w``:

* a new state for ``w`` whose outgoing arcs are a copy of ``v``'s at that moment,
* arcs labelled ``w`` wherever an arc ``u`` could be taken at that moment,
* the arc ``v`` out of state ``u`` is cut.

The arcs are a table of differences: a state names its default state (whose arcs it
copied) and a label its default label (where whose arcs it was laid), both with the step of the copy,
and the table holds the arcs that differ, i.e. the cut ones, with their step.  A
transition follows defaults until it meets a cut or a byte symbol.  Written out, the arcs of a
vocabulary of 50,000 would be 2.5 billion entries; the table has one a merge.  A merge whose own arc is
gone when its turn comes makes a label that no path can use.

**Encoding.**  Each string has exactly one accepted path, and so has each start of it.  The state
after a start is therefore one label: the label that ends there and has an arc from the state where it
begins.  Labels that end at a symbol are found in a table of their tails and tried the longest
first; the state where a label begins is settled in the same way when it is asked for, once for the
word.  No path is taken and left again, so a word takes time linear in its
length times the longest label; the labels of the path are read off from the end.

**Decoding** emits the labels (byte strings) of the arcs and reads the bytes as
UTF-8, malformed sequences replaced.

Edge cases: null text is encoded as the empty text (no ids, never null); null
ids decode to the empty text; ids outside the vocabulary emit nothing; a very long text is
encoded whole, in runs of words, and its row is held in the task; repeated rows are encoded alike, an
empty table gives none; an output column that already exists in the input is replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.llm.byte_pieces import PieceCache, byte_alphabet, check_byte_level, special_tokens
from kestrel.llm.common import laid_out, release_memory, runs_of
from kestrel.session import ship_package

_SHIFT = 20


class MergeAutomaton:
    """The compiled automaton of one vocabulary; see the module text."""

    def __init__(self, vocab: dict[str, int], merges: list):
        n = max(vocab.values()) + 1
        if n >= 1 << _SHIFT:
            raise ValueError("vocabulary too large")
        self.vocab = vocab
        self._born, self._left, self._right = [0] * n, [-1] * n, [-1] * n
        self._cut: dict[int, int] = {}
        self._usable = {s: i for s, i in vocab.items() if len(s) == 1}
        self._arcs: dict[int, bool] = {}
        for k, m in enumerate(merges, 1):
            a, b = m.split(" ", 1) if isinstance(m, str) else m
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if a in self._usable and b in self._usable and self._lookup(u, v, k):
                if a + b in self._usable:
                    raise ValueError(f"two merges make {a + b!r}")
                self._born[w], self._left[w], self._right[w] = k, u, v
                self._usable[a + b] = w
                self._cut[u << _SHIFT | v] = k
        self._size = {i: len(s) for s, i in self._usable.items()}
        self._tails: dict[str, int] = {}  # ends of usable labels of several symbols -> the label, -1 if none
        for s, i in self._usable.items():
            for j in range(1, len(s)):
                self._tails.setdefault(s[j:], -1)
        self._tails.update(self._usable)

    def _lookup(self, t: int, s: int, step: int) -> bool:
        """Is there an arc ``s`` out of state ``t`` before gadget ``step``?"""
        born, left, right, cut = self._born, self._left, self._right, self._cut
        while True:
            gone = cut.get(t << _SHIFT | s)
            if gone is not None and gone < step:
                return False
            bt, bs = born[t], born[s]
            if not bt and not bs:
                return True
            if bt > bs:  # the state is the younger: its arcs are copied from its right part
                t, step = right[t], bt
            else:  # the label is the younger: it was laid where its left part could go,
                t, s, step = t, left[s], bs + (bt < bs or t == s)  # that very merge taken first

    def arc(self, t: int, s: int) -> bool:
        key = t << _SHIFT | s
        ok = self._arcs.get(key)
        if ok is None:
            if len(self._arcs) >= 300_000:
                self._arcs.clear()
            ok = self._arcs[key] = self._lookup(t, s, 1 << 60)
        return ok

    def encode_word(self, word: str) -> list[int]:
        """Labels of the accepted path of ``word`` (in byte symbols)."""
        n = len(word)
        if not n:
            return []
        whole = self._usable.get(word)
        if whole is not None:  # one arc from the start
            return [whole]
        state = {0: -1}  # state[i]: the last label of the path of word[:i]
        self._settle(word, n, state)
        path, i, size = [], n, self._size
        while i:
            path.append(state[i])
            i -= size[state[i]]
        path.reverse()
        return path

    def _settle(self, word: str, i: int, state: dict[int, int]) -> None:
        """Add ``state[i]``, and the states before it that it asks for."""
        tails, arcs, arc = self._tails.get, self._arcs.get, self.arc
        todo = []  # positions that wait for a state before them, and the labels left to try there
        while True:
            ends, j = [], i - 1  # labels that end at i, shortest first, and where they begin
            while j >= 0:
                t = tails(word[j:i])
                if t is None:
                    break
                if t >= 0:
                    ends.append((t, j))
                j -= 1
            while True:
                if not ends:
                    raise ValueError(f"symbols outside the alphabet in {word[:40]!r}")
                t, j = ends[-1]
                before = state.get(j)
                if before is None:
                    todo.append((i, ends))
                    i = j
                    break
                if j:
                    ok = arcs(before << _SHIFT | t)
                    if ok is None:
                        ok = arc(before, t)
                    if not ok:
                        ends.pop()
                        continue
                state[i] = t
                if not todo:
                    return
                i, ends = todo.pop()


def labels(spec: dict) -> list[bytes]:
    """Byte string of every id (added tokens: their text)."""
    sym = {c: b for b, c in byte_alphabet().items()}
    special = special_tokens(spec)
    out = [b""] * (max([*spec["model"]["vocab"].values(), *special.values()]) + 1)
    for s, i in spec["model"]["vocab"].items():
        out[i] = bytes(sym[c] for c in s)
    for s, i in special.items():
        out[i] = s.encode()
    return out


def _encoder(js: bytes, spec: dict) -> PieceCache:
    import numpy as np

    auto = MergeAutomaton(spec["model"]["vocab"], spec["model"]["merges"])
    pack = lambda ids: np.asarray(ids, dtype="<i4").tobytes()
    return PieceCache(js, spec, word=lambda w: pack(auto.encode_word(w)), join=b"".join, special=lambda i: pack([i]))


def _with(batch, name, arr):
    """``batch`` with column ``name`` replaced or appended."""
    import pyarrow as pa

    cols, names = list(batch.columns), list(batch.schema.names)
    if name in names:
        cols[names.index(name)] = arr
    else:
        cols.append(arr)
        names.append(name)
    return pa.RecordBatch.from_arrays(cols, names=names)


def _schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    f = T.StructField(name, kind)
    fields = [f if x.name == name else x for x in df.schema.fields]
    return T.StructType(fields if name in df.columns else [*fields, f])


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        js = f.read()
    check_byte_level(json.loads(js))
    return js


def _slices(batch, rows: int = 1024):
    """Small parts of a batch, so that a worker holds few ids at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


class Decoder:
    """Concatenates arc labels and reads them as UTF-8."""

    def __init__(self, spec: dict):
        import numpy as np

        lab = labels(spec)
        self._ends = np.cumsum([0, *map(len, lab)]).astype(np.int64)
        self._raw = np.frombuffer(b"".join(lab), np.uint8)

    def text(self, ids) -> str:
        import numpy as np

        ends = self._ends
        ids = ids[(ids >= 0) & (ids < len(ends) - 1)].astype(np.int64)
        size = ends[ids + 1] - ends[ids]
        stop = np.cumsum(size)
        n = int(stop[-1]) if len(stop) else 0
        at = np.arange(n) + np.repeat(ends[ids] - (stop - size), size)
        return self._raw[at].tobytes().decode("utf-8", "replace")


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids",
           decoded: str | None = None) -> DataFrame:
    """``df`` with ``out array<int>``, the ids of ``text_col`` under the byte-level BPE
    vocabulary file ``tokenizer`` (read on the driver and broadcast; a fixed file).  With
    ``decoded``, also that column: the ids just made, decoded again in the same pass."""
    ship_package(df.sparkSession)
    js = df.sparkSession.sparkContext.broadcast(_read(tokenizer))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        # built per task and dropped at its end: idle workers stay small
        spec = json.loads(js.value)
        cache, back = _encoder(js.value, spec), Decoder(spec)
        del spec

        def packed(values, index, ends):
            return laid_out(values, "<i4", index, ends)
        try:
            for whole in batches:
                for b in _slices(whole):
                    texts = [t or "" for t in b.column(text_col).to_pylist()]
                    docs = [d for run in runs_of(texts) for d in cache.many(run, packed)]
                    ends = np.zeros(len(docs) + 1, np.int64)
                    np.cumsum([len(d) // 4 for d in docs], out=ends[1:])
                    ids = np.frombuffer(b"".join(docs), "<i4")
                    made = _with(b, out, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids, pa.int32())))
                    if decoded is not None:
                        again = [back.text(ids[i:j]) for i, j in zip(ends, ends[1:])]
                        made = _with(made, decoded, pa.array(again, pa.string()))
                    yield made
        finally:
            del cache, back
            release_memory()

    schema = _schema(df, out, T.ArrayType(T.IntegerType()))
    if decoded is not None:
        at = schema.names.index(decoded) if decoded in schema.names else None
        field = T.StructField(decoded, T.StringType())
        schema = T.StructType([*schema.fields[:at], field, *schema.fields[at + 1:]] if at is not None else
                              [*schema.fields, field])
    return df.mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``df`` with ``out string``, the text of ``ids_col``; special tokens give their text."""
    ship_package(df.sparkSession)
    js = df.sparkSession.sparkContext.broadcast(_read(tokenizer))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        back = Decoder(json.loads(js.value))
        for whole in batches:
            for b in _slices(whole):
                texts = [back.text(c.values.to_numpy(zero_copy_only=False) if c.is_valid and len(c.values)
                                   else np.zeros(0, np.int64)) for c in b.column(ids_col)]
                yield _with(b, out, pa.array(texts, pa.string()))

    return df.mapInArrow(run, _schema(df, out, T.StringType()))
