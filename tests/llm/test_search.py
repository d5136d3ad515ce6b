"""Operator 12: ranked lexical search."""

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.llm import dual_tree, queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    """Every pair scored, rows (item, rank, doc, score)."""
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_all = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        found = []
        for d, b in bags:
            m = 50 + 50 * b.total() * n_docs // n_all
            s = sum(w[t] * (1_000_000_000 * b[t] // (1000 * b[t] + 20 * m)) for t in set(terms(text)) if t in b)
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_query_is_brute_force(spark):
    d = duckdb.connect()
    docs = d.execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    items = d.execute(f"SELECT item_id, text FROM '{SF_SMALL}/benchmark.parquet'").fetchall()
    assert rows(queries.op12_dual_tree(spark, SF_SMALL)) == brute(docs, items, 50)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "a B c"), (2, None), (3, ""), (4, "nowhere"), (4, "same text"), (5, "a B c"),
                                   (None, "id ÉT x"), (6, "the of stone 7")], "item_id long, text string")
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want = [tuple(r) for r in items.collect()]
    assert rows(dual_tree.search(odd_docs, items, k=3)) == brute(docs, want, 3)
    clash = odd_docs.withColumn("score", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("item_id", F.lit(9))
    assert rows(dual_tree.search(clash, items.withColumn("doc_id", F.lit(1)), k=3)) == brute(docs, want, 3)
    out = dual_tree.search(no_docs, items)
    assert out.collect() == [] and out.columns == ["item_id", "rank", "doc_id", "score"]
    assert dual_tree.search(odd_docs, items.limit(0)).collect() == []
    assert dual_tree.search(odd_docs, items.where("item_id in (2, 3)")).collect() == []


def random_tables(n_docs, n_items, seed=1):
    r = np.random.default_rng(seed)
    word = lambda: f"w{int(r.zipf(1.3)) % 400}"
    docs = [(i, " ".join(word() for _ in range(r.integers(0, 40)))) for i in range(n_docs)]
    docs += [(n_docs + i, docs[i % 3][1]) for i in range(300)]  # a third are copies: many ties
    items = [(i, " ".join(word() for _ in range(r.integers(1, 12)))) for i in range(n_items)]
    return docs, items


def test_trees_and_blocks(spark):
    """Many item blocks and ties at the last rank change nothing."""
    docs, items = random_tables(600, 60)
    want = brute(docs, items, 10)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert rows(dual_tree.search(d, i, k=10)) == want
    assert rows(dual_tree.search(d, i, k=10, block_items=7)) == want
    assert rows(dual_tree.search(d, i, k=10, block_bytes=300)) == want


@pytest.mark.parametrize("cells", [1 << 22, 600])
def test_search_without_spark(monkeypatch, cells):
    """Chunks of any size give the best pairs, and bounds prune."""
    import pyarrow as pa

    monkeypatch.setattr(dual_tree, "CELLS", cells)
    docs, items = random_tables(2000, 40)
    bags = [Counter(terms(t)) for _, t in docs]
    vocab = {t: i for i, t in enumerate(sorted({t for _, x in items for t in terms(x)}))}
    df = Counter(t for b in bags for t in b)
    n_docs, n_all = sum(map(bool, bags)), sum(b.total() for b in bags)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in vocab], np.int64)
    lists = [sorted((vocab[t], c) for t, c in b.items() if t in vocab) for b in bags]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in docs], pa.int64()), pa.array([b.total() for b in bags], pa.int64()),
         pa.array([[t for t, _ in x] for x in lists], pa.list_(pa.int32())),
         pa.array([[c for _, c in x] for x in lists], pa.list_(pa.int32()))], names=["doc", "n", "terms", "tfs"])
    tree = dual_tree.ItemTree([np.array(sorted({vocab[t] for t in terms(x)})) for _, x in items], weight)
    assert sorted(i for q, m in enumerate(tree.members) if not tree.children[q] for i in m) == list(range(40))
    best = dual_tree.Best(40, 5, np.zeros(40, np.int64))
    scored = []
    monkeypatch.setattr(best, "add", lambda i, s, d, add=best.add: (scored.append(len(s)), add(i, s, d)))
    for chunk in dual_tree._chunks(batch, weight, n_docs, n_all):
        chunk.search(tree, best, False)
    got = defaultdict(list)
    for i in range(40):
        got[i] = list(zip(best.doc[i].tolist(), best.score[i].tolist()))
    want = defaultdict(list)
    for i, _, d, s in sorted(brute(docs, items, 5), key=lambda x: x[:2]):
        want[i].append((d, s))
    assert all(got[i] == want[i] for i in range(40))
    assert sum(scored) < 40 * len(docs) * 0.8


def test_terms_of_pieces():
    text = "Ab1 c—d éÉ " * 2000 + "x" * 5000
    whole = [w for part in dual_tree.terms_of(text.encode(), piece=64) for w in part]
    assert whole == [t.encode() for t in terms(text)]
