"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is its set of distinct word shingles (64-bit hashes).  Two
permutations of a ring of ``RING`` places are drawn once from a seed: sigma
places a shingle, and coordinate k of the signature is the least value of pi at
sigma's place shifted by k.  So all ``bands * rows`` coordinates of a shingle are
one contiguous slice of pi, and a signature is a column-wise minimum of slices.

1. One pass over the texts gives set size, a 128-bit digest of the set and one key
   per band.  Documents with equal sets form a class (a map-side aggregate, so
   thousands of copies cost one row); from here on only classes are compared.
2. Classes with a band key in common meet in a bucket.  Every class of a bucket
   is compared with the bucket's least class, on the full sets.  Links give
   components.
3. Buckets that still hold several components are compared whole: their classes are
   dealt into blocks of bounded bytes, each pair of blocks is one group of rows in a
   task, and the task counts all intersections of a group at once by products of
   sparse 0/1 slices.  A group returns a spanning forest of the links between
   components, so no list of pairs is ever made; classes of one component need
   no comparison, as it could not change the result.  There is no cap on a bucket.

With 32 bands of 5 rows a pair at similarity 0.8 shares a key with probability
1 - 3e-6.  All joins are equi-joins on digests or keys.  Class sets are shuffled
only for classes that have a candidate.

Edge cases: null and empty texts have an empty set and are linked with nothing;
a text with fewer words than a shingle is one shingle; rows without an id join
classes like others, and a component of only such rows has a null id; rows that
repeat id and text share everything (in ``keep_first`` one of them stays).  A very long text is read
whole; its set is as large as its distinct shingles.  An empty table gives no rows.  Other columns are not
read before the end, so their names do not matter there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.common import release_memory, written
from kestrel.llm.components import components
from kestrel.session import ship_package

RING_BITS = 22
#: Above this many rows a lookup table is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 400_000
#: Bounds of a block of a bucket that is compared whole.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 2 << 20
_CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = None

    def upto(self, n: int):
        import numpy as np

        if self.up is None or len(self.up) < n:
            n = max(n, _CHUNK + 4096)
            inverse = pow(_BASE, -1, 1 << 64)
            one = np.ones(1, np.uint64)
            self.up, self.down = (np.cumprod(np.concatenate([one, np.full(n - 1, b, np.uint64)]))
                                  for b in (_BASE, inverse))
        return self.up, self.down


_POWERS = _Powers()


def _mixed(x):
    """The public splitmix64 finalizer."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_chunk(data: bytes):
    """(start, hash) of each word of ``data``; words are separated by space and 0x09-0x0D."""
    import numpy as np

    a = np.frombuffer(data, np.uint8)
    word = (a != 32) & ((a < 9) | (a > 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]]).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _POWERS.upto(len(a) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[:len(a)])])
    return start, _mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def _joined(texts: list[bytes]):
    """Runs of whole documents of about ``_CHUNK`` bytes."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t) > _CHUNK:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t) + 1
    if run:
        yield run


def _long(text: bytes):
    """Word hashes of a text above a chunk, in pieces cut at white space."""
    import numpy as np

    out, at = [], 0
    while at < len(text):
        end = min(at + _CHUNK, len(text))
        while end < len(text) and not text[end:end + 1].isspace():
            end += 1
        out.append(_hash_chunk(text[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def word_hashes(texts: list[bytes]):
    """Array of word hashes of each text."""
    import numpy as np

    for run in _joined(texts):
        if len(run) == 1 and len(run[0]) > _CHUNK:
            yield _long(run[0])
            continue
        start, h = _hash_chunk(b" ".join(run))
        cut = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in run)]))
        for i in range(len(run)):
            yield h[cut[i]:cut[i + 1]]


def shingle_set(words, size: int):
    """Sorted distinct hashes of the runs of ``size`` words (all words, if fewer)."""
    import numpy as np

    n = len(words)
    if not n:
        return words
    k = min(size, n)
    run = words[:n - k + 1].copy()
    for j in range(1, k):
        run = run * np.uint64(_BASE) + words[j:n - k + 1 + j]
    run = _mixed(run + np.uint64(k))
    run.sort()
    return run[np.concatenate([[True], run[1:] != run[:-1]])]


def _lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only


class Circulant:
    """Signatures from two permutations of the ring."""

    def __init__(self, bands: int, rows: int, seed: int):
        import numpy as np

        self.bands, self.rows, k = bands, rows, bands * rows
        rng = np.random.Generator(np.random.PCG64(seed))
        self._place = rng.permutation(1 << RING_BITS).astype(np.uint32)
        ring = rng.permutation(1 << RING_BITS).astype(np.uint32)
        self._slices = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:k]]), k)

    def signature(self, shingles):
        import numpy as np

        at = self._place[(shingles >> np.uint64(64 - RING_BITS)).astype(np.int64)]
        best = None
        for i in range(0, len(at), 4096):
            low = self._slices[at[i:i + 4096]].min(axis=0)
            best = low if best is None else np.minimum(best, low)
        return best

    def keys(self, signatures):
        """One 64-bit key per band for a stack of signatures."""
        import numpy as np

        s = signatures.reshape(-1, self.bands, self.rows).astype(np.uint64)
        key = np.broadcast_to(np.arange(self.bands, dtype=np.uint64), s.shape[:2]).copy()
        for j in range(self.rows):
            key = _mixed(key * np.uint64(_BASE) + s[:, :, j] + np.uint64(1))
        return key.view(np.int64)


def signatures(df: DataFrame, text_col: str, shingle: int, bands: int, rows: int, seed: int) -> DataFrame:
    """``df`` without ``text_col`` and with __n (set size), __digest and __keys."""
    ship_package(df.sparkSession)
    names = [c for c in df.columns if c != text_col]

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        ring = Circulant(bands, rows, seed)
        for b in batches:
            texts = [_lowered(t) for t in b.column(text_col).to_pylist()]
            size, digest, sig = [], [], []
            for words in word_hashes(texts):
                s = shingle_set(words, shingle)
                size.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                if len(s):
                    sig.append(ring.signature(s))
            keys = ring.keys(np.stack(sig)) if sig else np.zeros((0, bands), np.int64)
            ends = np.cumsum([0, *(bands if n else 0 for n in size)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), lists],
                names=[*names, "__n", "__digest", "__keys"])
        del ring
        release_memory()

    schema = T.StructType([*df.select(*names).schema.fields, T.StructField("__n", T.LongType()),
                           T.StructField("__digest", T.BinaryType()),
                           T.StructField("__keys", T.ArrayType(T.LongType()))])
    return df.mapInArrow(run, schema)


def _sets(df: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(__digest, text) -> (__digest, __set): the sorted hashes as bytes."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = [_lowered(t) for t in b.column(text_col).to_pylist()]
            sets = [shingle_set(w, shingle).tobytes() for w in word_hashes(texts)]
            yield pa.RecordBatch.from_arrays([b.column("__digest"), pa.array(sets, pa.binary())],
                                             names=["__digest", "__set"])

    return df.mapInArrow(run, "__digest binary, __set binary")


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) -> (a, b, shared): size of the intersection of their full sets."""
    left = sets.select(F.col("__digest").alias("a"), F.col("__set").alias("sa"))
    right = sets.select(F.col("__digest").alias("b"), F.col("__set").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for t in batches:
            shared, at, x = [], None, None
            for a, b in zip(t.column("sa"), t.column("sb"), strict=True):
                a, b = a.as_buffer(), b.as_buffer()
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                i = np.searchsorted(y, x)
                i[i == len(y)] = 0
                shared.append(int(np.count_nonzero(y[i] == x)))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), pa.array(shared, pa.int64())],
                                             names=["a", "b", "shared"])

    return both.mapInArrow(run, "a binary, b binary, shared long")


def forest(sets: list, comps: list, percent: int, apart: int | None = None) -> list[tuple[int, int]]:
    """Links between different components among ``sets`` (sorted hash arrays): pairs of
    positions that form a spanning forest over the components.  With ``apart``, only
    pairs with one side before and one side from that position count."""
    import numpy as np

    m = len(sets)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(m), size)
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = often[column] > 1
    owner, column = owner[keep], column[keep]
    # a set links with nothing if too little of it occurs elsewhere in the group
    alive = 100 * np.bincount(owner, minlength=m) >= percent * size
    keep = alive[owner]
    owner, column = owner[keep], column[keep]
    if not len(owner):
        return []
    rows = np.flatnonzero(alive)
    row = np.cumsum(alive)[owner] - 1
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(rows), len(rows)), np.float32)
    width = max(64, min(4096, (4 << 20) // len(rows)))
    cuts = np.searchsorted(column, np.arange(0, column[-1] + width, width))
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        part = np.zeros((len(rows), width), np.float32)
        part[row[i:j], column[i:j] - k * width] = 1
        shared += part @ part.T
    n = size[rows]
    _, label = np.unique([comps[i] for i in rows], return_inverse=True)
    linked = (100 * shared >= percent * (n[:, None] + n[None, :] - shared)) & (label[:, None] < label[None, :])
    if apart is not None:
        side = rows < apart
        linked &= side[:, None] != side[None, :]
    x, y = np.nonzero(linked)
    _, one = np.unique(label[x] * m + label[y], return_index=True)
    root = list(range(m))

    def top(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for k in one:
        a, b = top(label[x[k]]), top(label[y[k]])
        if a != b:
            root[a] = b
            out.append((int(rows[x[k]]), int(rows[y[k]])))
    return out


def _block_links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(key, __digest, c, blocks) -> links (a, b) between components of each bucket."""
    block = F.pmod(F.xxhash64("__digest"), F.col("blocks")).cast("int")
    rows = open_.withColumn("block", block).join(sets, "__digest").select(
        "key", "block", "__digest", "c", "__set", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
                       "__digest", "c", "__set")
    group = ["key", "lo", "hi"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def links(members):
            if len({c for _, _, c, _ in members}) < 2:
                return []
            first = members[0][0]
            apart = next((i for i, x in enumerate(members) if x[0] != first), None)
            found = forest([np.frombuffer(s, np.uint64) for *_, s in members], [c for _, _, c, _ in members],
                           percent, apart)
            return [(members[i][1], members[j][1]) for i, j in found]

        def packed(pairs):
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)],
                                              names=["a", "b"])

        at, members = None, []
        for t in batches:
            out = []
            cells = [t.column(c).to_pylist() for c in (*group, "block", "__digest", "c")]
            for key, lo, hi, *rest, s in zip(*cells, t.column("__set"), strict=True):
                if (key, lo, hi) != at:
                    out += links(members) if members else []
                    at, members = (key, lo, hi), []
                members.append((*rest, s.as_py()))
            yield packed(out)
        yield packed(links(members) if members else [])
        release_memory()

    return rows.repartition(*group).sortWithinPartitions(*group, "block").mapInArrow(run, "a binary, b binary")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast hint for a written table of at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = 32, rows: int = 5, seed: int = 7,
                    tag: list[str] | None = None) -> DataFrame:
    """One row per input row: ``id_col``, n_shingles, component_id, kept and the class digest.

    ``tag`` names further columns of ``df`` to carry (used by ``keep_first``)."""
    tag = tag or []
    named = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"),
                      *[F.col(t).alias(f"__tag{i}") for i, t in enumerate(tag)])
    # names a row's text across passes
    mark = [F.xxhash64("__text").alias("__m1"), F.xxhash64(F.lit(seed), "__text").alias("__m2")]
    tags = [f"__tag{i}" for i in range(len(tag))]
    docs = written(signatures(named.select("__id", "__text", *tags, *mark), "__text", shingle, bands, rows, seed),
                   "signatures")
    row = F.struct(F.col("__id").isNull().alias("x"), "__id", "__m1", "__m2")  # a class is read from one row
    classes = written(docs.where("__n > 0").groupBy("__digest").agg(
        F.min(row).alias("__row"), F.max("__n").alias("__n"), F.max("__keys").alias("__keys")), "classes")

    members = classes.select("__digest", F.col("__n").alias("n"), F.explode("__keys").alias("key"))
    hubs = members.groupBy("key").agg(F.min("__digest").alias("hub"), F.max("__digest").alias("last")).where("hub <> last")
    hubs = written(hubs.select("key", "hub"), "hubs")
    bucket = written(members.join(hubs, "key"), "buckets")  # only buckets of two classes or more
    pairs = written(bucket.where("__digest <> hub").select(F.col("hub").alias("a"), F.col("__digest").alias("b"))
                    .distinct(), "pairs")

    wanted = written(pairs.select("a").union(pairs.select("b")).distinct()
                     .join(classes, F.col("a") == F.col("__digest"))
                     .select("__digest", F.col("__row.__id").alias("__first"), F.col("__row.__m1").alias("__m1"),
                             F.col("__row.__m2").alias("__m2")), "wanted")
    texts = named.select("__id", "__text", *mark).join(_small(wanted), ["__m1", "__m2"]).where(
        F.col("__id").eqNullSafe(F.col("__first")))
    sets = written(_sets(texts.select("__digest", "__text"), "__text", shingle).dropDuplicates(["__digest"]), "sets")

    sizes = classes.select("__digest", "__n")
    first = _shared(pairs, sets).join(sizes.select(F.col("__digest").alias("a"), F.col("__n").alias("na")), "a").join(
        sizes.select(F.col("__digest").alias("b"), F.col("__n").alias("nb")), "b")
    linked = written(first.where(100 * F.col("shared") >= percent * (F.col("na") + F.col("nb") - F.col("shared")))
                     .select("a", "b"), "first-links")
    comp = written(components(linked), "components")

    # buckets that still hold more than one component
    place = comp.select(F.col("node").alias("__digest"), F.col("component").alias("c"))
    at = bucket.join(place, "__digest", "left").withColumn("c", F.coalesce("c", "__digest")).drop("hub")
    split = at.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("m"),
                                  F.sum("n").alias("total")).where("c0 <> c1").select(
        "key", F.ceil(F.greatest(F.col("m") / BLOCK_SETS, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    open_ = written(at.join(split, "key"), "open-buckets")
    second = written(_block_links(open_, sets, percent), "second-links")
    if second.take(1):
        comp = written(components(comp.select(F.col("component").alias("a"), F.col("node").alias("b")).where("a <> b")
                                  .union(second)), "components")

    label = classes.join(comp.select(F.col("node").alias("__digest"), "component"), "__digest", "left").select(
        "__digest", F.col("__row.__id").alias("__first"), F.coalesce("component", "__digest").alias("component"))
    least = label.groupBy("component").agg(F.min("__first").alias("component_id"))
    label = written(label.join(least, "component").select("__digest", "component", "component_id"), "labels")
    out = docs.drop("__keys", "__m1", "__m2").join(label, "__digest", "left")
    own = F.when(F.col("__n") > 0, F.col("component_id")).otherwise(F.col("__id"))
    return out.select(F.col("__id").alias(id_col), F.col("__n").alias("n_shingles"), own.alias("component_id"),
                      F.col("__id").eqNullSafe(own).alias("kept"), F.col("component").alias("component"),
                      *[F.col(t).alias(c) for t, c in zip(tags, tag, strict=True)])


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the least
    id stays (ties and missing ids: the least row hash)."""
    cols = [f"__c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*cols)
    at, text = (cols[df.columns.index(c)] for c in (id_col, text_col))
    marks = [F.xxhash64(F.struct(*cols)).alias("__k1"), F.xxhash64(F.lit(1), F.struct(*cols)).alias("__k2")]
    rows = near_duplicates(plain.select(at, text, *marks), at, text, tag=["__k1", "__k2"], **options)
    rows = written(rows.where("n_shingles > 0").select("component", F.struct(
        F.col(at).isNull().alias("x"), F.col(at).alias("i"), "__k1", "__k2").alias("r")), "component-rows")
    best = rows.groupBy("component").agg(F.min("r").alias("best"))
    lost = written(rows.join(best, "component").where("r <> best").select("r.__k1", "r.__k2").distinct(), "lost-rows")
    out = plain.select("*", *marks).join(_small(lost), ["__k1", "__k2"], "left_anti")
    return out.drop("__k1", "__k2").toDF(*df.columns)
