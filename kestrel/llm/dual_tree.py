"""Ranked lexical search by a dual tree.

*Terms* are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z
are lower-cased.  The score of an item and a document is the sum, over the distinct
terms of the item, of ``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 50 + (50 * n * N) div L`` (N documents
with a term, L terms in them, n terms of the document, df documents with the term).

1. *Read.*  One scan counts, per document, its terms and those that an item asks for; the
   result (ids and counts, no text) is written to the shared folder.  N, L and df are
   aggregates over it.
2. *Trees.*  A chunk of documents is a matrix with one row per document and one column per
   term: what the term adds to a score.  Documents and items are halved by likeness (which of
   two unlike rows is nearer), documents down to ``LEAF`` rows, items down to ``ITEM_LEAF``.  ``FANOUT``
   document nodes make a parent; a node holds the maxima of its columns, an item node all terms of its items.  The bound of a pair of nodes is the sum of the document node's maxima over
   the item node's terms: no pair below can score more.
3. *Search.*  Both trees are descended together, whole sets of document nodes at once.  Pairs
   whose bound is below the weakest k-th score of the node's items are cut.  Pairs
   of leaves that remain are scored exactly, the highest bounds first.
4. *Two rounds.*  The first scores only the best leaf of every chunk and item leaf.  The k-th
   best of all these scores is a lower limit of an item's true k-th score, and the second
   round starts from it in every task.  A task returns k rows an item at most; a window over
   them gives the ranks.

All sums are integers below 2**53 (checked), so that the matrix products in doubles are exact.
Equal bounds are never cut: ties are settled by the document id alone.

Items with equal text are answered once.  Items are searched in blocks of at most
``block_items`` texts and about ``block_bytes`` (one longer text makes a block of its own), which
bounds the vocabulary sent to the tasks; more items make more passes over the documents.

Edge cases: null and empty texts have no terms, are no part of N and are found by
no item; an item without terms, or whose terms no document holds, gives no rows.  A very
long text is cut into pieces at spaces while it is counted.  A document without id takes
part and ranks after equal scores with an id (the id 2**63 - 1 stands for it).
Repeated rows are documents of their own and equal ranks do not occur; repeated items
each get their rows.  Empty tables give no rows.  Other columns are not read, so that their
names do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import release_memory, text_or_empty, written
from kestrel.session import ship_package

LEAF, FANOUT, ITEM_LEAF = 8, 8, 2
#: Cells of a chunk's matrix (8 bytes each).
CELLS = 1 << 22
NO_ID = (1 << 63) - 1

_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes, piece: int = 1 << 22):
    """Lists of the terms of UTF-8 ``raw``, cut at spaces into pieces of about ``piece`` bytes."""
    raw = raw.translate(_TERM)
    at = 0
    while len(raw) - at > piece:
        end = raw.find(b" ", at + piece)
        if end < 0:
            break
        yield raw[at:end].split()
        at = end
    yield (raw[at:] if at else raw).split()


class ItemTree:
    """Items (arrays of term numbers) halved by likeness; ``terms`` of a node are those of its items."""

    def __init__(self, items: list, weight):
        import numpy as np

        self.items, self.weight = items, weight
        self.members, self.children, self.terms = [], [], []
        seen = np.zeros(len(weight), bool)

        def likeness(pivot: int, members: list[int]):
            seen[items[pivot]] = True
            out = [weight[items[i]][seen[items[i]]].sum() / (1 + weight[items[i]].sum()) for i in members]
            seen[items[pivot]] = False
            return np.array(out)

        todo = [list(range(len(items)))]
        while todo:  # children follow their parents in breadth-first order
            members = todo.pop(0)
            node = len(self.members)
            self.members.append(members)
            self.terms.append(np.unique(np.concatenate([items[i] for i in members])))
            self.children.append(())
            if len(members) > ITEM_LEAF:
                near = likeness(members[0], members)
                far = likeness(members[int(near.argmin())], members)
                order = np.argsort(far - near, kind="stable")
                half = len(members) // 2
                todo += [[members[i] for i in order[:half]], [members[i] for i in order[half:]]]
                self.children[node] = (node + len(todo) - 1, node + len(todo))


class Best:
    """The k best (score, document) of every item so far; ``least`` is what a new one must reach."""

    def __init__(self, n_items: int, k: int, floor):
        import numpy as np

        self.k = k
        self.least = np.maximum(floor, 1)
        self.score = [np.zeros(0, np.int64)] * n_items
        self.doc = [np.zeros(0, np.int64)] * n_items

    def add(self, item: int, score, doc) -> None:
        import numpy as np

        good = score >= self.least[item]
        if not good.any():
            return
        score = np.concatenate([self.score[item], score[good].astype(np.int64)])
        doc = np.concatenate([self.doc[item], doc[good]])
        order = np.lexsort((doc, -score))[:self.k]
        self.score[item], self.doc[item] = score[order], doc[order]
        if len(order) == self.k:
            self.least[item] = max(self.least[item], self.score[item][-1])


def by_likeness(m):
    """Order of the rows of ``m``: halved at multiples of ``LEAF`` by which of two unlike rows is nearer."""
    import numpy as np

    unit = (m / np.sqrt(np.maximum((m * m).sum(axis=1), 1))[:, None]).astype(np.float32)
    out, todo = [], [np.arange(len(m))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        part = unit[rows]
        near = part @ part[0]
        far = part @ part[int(near.argmin())]
        order = np.argsort(far - near, kind="stable")
        half = -(-len(rows) // (2 * LEAF)) * LEAF
        todo += [rows[order[half:]], rows[order[:half]]]
    return np.concatenate(out)


class Chunk:
    """Documents as a matrix of what each term adds to a score, and the maxima of their tree."""

    def __init__(self, docs, rows, cols, adds, n_terms: int):
        import numpy as np

        self.column = np.full(n_terms, -1, np.int32)
        used = np.unique(cols)
        self.column[used] = np.arange(len(used))
        m = np.zeros((len(docs), len(used)))
        m[rows, self.column[cols]] = adds
        order = by_likeness(m)
        self.docs, self.m = docs[order], m[order]
        self.levels = [np.maximum.reduceat(self.m, np.arange(0, len(docs), LEAF))]
        while len(self.levels[-1]) > FANOUT:
            below = self.levels[-1]
            self.levels.append(np.maximum.reduceat(below, np.arange(0, len(below), FANOUT)))

    def search(self, tree: ItemTree, best: Best, first_only: bool) -> None:
        import numpy as np

        top = len(self.levels) - 1
        todo = [(0, top, np.arange(len(self.levels[top])))]
        while todo:
            q, level, nodes = todo.pop()
            cols = self.column[tree.terms[q]]
            cols = cols[cols >= 0]
            bound = self.levels[level][nodes[:, None], cols].sum(axis=1)
            members = tree.members[q]
            near = bound >= best.least[members].min()
            nodes, bound = nodes[near], bound[near]
            if not len(nodes):
                continue
            if not tree.children[q] and not level:
                self._leaves(q, nodes, bound, cols, tree, best, first_only)
                continue
            if level:
                level -= 1
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < len(self.levels[level])]
            for child in tree.children[q] or (q,):
                todo.append((child, level, nodes))

    def _leaves(self, q, nodes, bound, cols, tree, best, first_only) -> None:
        """Exact scores of the items of leaf ``q`` in the document leaves ``nodes``, best bound first."""
        import numpy as np

        members = tree.members[q]
        asks = np.zeros((len(self.m[0]), len(members)))
        for j, i in enumerate(members):
            c = self.column[tree.items[i]]
            asks[c[c >= 0], j] = 1
        asks = asks[cols]
        order = np.argsort(-bound, kind="stable")
        at, step = 0, 1
        while at < len(order):
            take = order[at:at + step]
            take = take[bound[take] >= best.least[members].min()]
            if not len(take):
                return  # the rest is bounded by less
            rows = (nodes[take][:, None] * LEAF + np.arange(LEAF)).ravel()
            rows = rows[rows < len(self.docs)]
            score = self.m[rows[:, None], cols] @ asks
            for j, i in enumerate(members):
                best.add(i, score[:, j], self.docs[rows])
            if first_only:
                return
            at, step = at + step, min(2 * step, 64)


def _chunks(batch, weight, n_docs: int, n_terms_all: int):
    """Chunks of the documents of ``batch`` that hold a term, with at most ``CELLS`` cells each
    (or ``LEAF`` documents)."""
    import numpy as np

    ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
    size = np.diff(ends)
    cols = batch.column("terms").flatten().to_numpy()
    tf = batch.column("tfs").flatten().to_numpy().astype(np.int64)
    ends -= ends[0]
    n = batch.column("n").to_numpy()
    m = 50 + (50 * n * n_docs) // max(1, n_terms_all)
    adds = weight[cols] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size)))
    docs = batch.column("doc").to_numpy()
    todo = [(0, len(docs))]
    while todo:
        a, b = todo.pop()
        if ends[a] == ends[b]:
            continue
        part = slice(ends[a], ends[b])
        if b - a > LEAF and (b - a > 8192 or (b - a) * len(np.unique(cols[part])) > CELLS):
            todo += [(a, (a + b) // 2), ((a + b) // 2, b)]
            continue
        full = size[a:b] > 0
        row = np.repeat(np.cumsum(full) - 1, size[a:b])
        yield Chunk(docs[a:b][full], row, cols[part], adds[part], len(weight))


def _count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc, n terms, numbers of the vocabulary terms in it, their counts), written."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        get = known.value.get
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                n, terms, tfs, ends = [], [], [], [0]
                for raw in b.column("text").cast(pa.binary()):
                    count, hits = 0, []
                    for words in terms_of(raw.as_py()):
                        count += len(words)
                        hits.extend(filter(None, map(get, words)))
                    t, tf = np.unique(np.array(hits, np.int32), return_counts=True)
                    n.append(count)
                    terms.append(t - 1)
                    tfs.append(tf)
                    ends.append(ends[-1] + len(t))
                ends = pa.array(ends, pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int32())) for x in (terms, tfs)]
                yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n, pa.int64()), *lists],
                                                 names=["doc", "n", "terms", "tfs"])
        release_memory()

    return written(docs.mapInArrow(run, "doc long, n long, terms array<int>, tfs array<int>"), "dual-tree-terms")


def _search_block(docs: DataFrame, texts: list[str], k: int) -> DataFrame:
    """(query, rank, doc, score) of the item texts of one block; query is the place in ``texts``."""
    import numpy as np

    spark = docs.sparkSession
    schema = "query int, doc long, score long"
    asked = [{w for words in terms_of(t.encode()) for w in words} for t in texts]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*asked)), 1)}
    table = _count_terms(docs, vocabulary)
    stats = table.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_docs, n_terms_all = int(stats[0]), int(stats[1])
    weight = np.zeros(len(vocabulary), np.int64)
    for t, df in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
        weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    items = [np.array(sorted(vocabulary[w] - 1 for w in a), np.int64) for a in asked]
    queries = [i for i, a in enumerate(items) if weight[a].any()]
    if not queries:
        return spark.createDataFrame([], "query int, rank int, doc long, score long")
    if max(int(weight[items[i]].sum()) for i in queries) * 1_000_000 >= 1 << 53:
        raise ValueError("an item's scores pass 2**53: too many terms for exact sums in doubles")
    tree = spark.sparkContext.broadcast(ItemTree([items[i] for i in queries], weight))
    ids = spark.sparkContext.broadcast(np.array(queries, np.int32))

    def scored(floor, first_only: bool) -> DataFrame:
        floor = spark.sparkContext.broadcast(floor)

        def run(batches):
            import pyarrow as pa

            t = tree.value
            best = Best(len(t.items), k, floor.value)
            for b in batches:
                for chunk in _chunks(b, t.weight, n_docs, n_terms_all):
                    chunk.search(t, best, first_only)
            found = [len(s) for s in best.score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids.value, found), pa.int32()), pa.array(np.concatenate(best.doc), pa.int64()),
                 pa.array(np.concatenate(best.score), pa.int64())], names=["query", "doc", "score"])
            release_memory()

        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "doc"))
        return table.mapInArrow(run, schema).withColumn("rank", rank).where(F.col("rank") <= k)

    none = np.zeros(len(queries), np.int64)
    kth = {r[0]: r[1] for r in scored(none, True).where(F.col("rank") == k).select("query", "score").collect()}
    return scored(np.array([kth.get(q, 0) for q in queries], np.int64), False).select("query", "rank", "doc", "score")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_items: int = 512,
           block_bytes: int = 256 << 10) -> DataFrame:
    """(``item_col``, rank, ``id_col``, score): the ``k`` best documents of every item, best first."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       text_or_empty(text_col).alias("text"))
    items = items.select(F.col(item_col).alias("item"), text_or_empty(item_text_col).alias("text"))
    texts = items.select("text").distinct()
    size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-size[0] // block_items), -(-size[1] // block_bytes))
    found = spark.createDataFrame([], "text string, rank int, doc long, score long")
    for b in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b) if blocks > 1 else texts
        block = sorted(r[0] for r in part.collect())
        if block:
            key = spark.createDataFrame(list(enumerate(block)), "query int, text string")
            hits = _search_block(docs, block, k)
            found = found.unionByName(hits.join(F.broadcast(key), "query").select("text", "rank", "doc", "score"))
    doc = F.when(F.col("doc") != NO_ID, F.col("doc"))
    return items.join(found, "text").select(F.col("item").alias(item_col), "rank", doc.alias(id_col), "score")
