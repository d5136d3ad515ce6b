"""Operator 7 against all pairs."""

import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from conftest import SF_SMALL

from kestrel.llm import circulant_minhash as cm
from kestrel.llm import queries
from kestrel.llm.components import components
from llm.conftest import WORDS, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, k):
    w = WORD.findall((text or "").translate(UPPER))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def all_pairs(docs, k=2, percent=80):
    """(id, n, component, kept) by comparing every two documents."""
    sets = [(d, shingles(t, k)) for d, t in docs]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for (i, (_, a)), (j, (_, b)) in combinations(enumerate(sets), 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d, (least.get(find(i)) if s else d) == d)
            for i, (d, s) in enumerate(sets)]


def same_rows(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_op7_on_documents(spark):
    for sf in (SF_SMALL, "/root/testdata/sf0.01"):
        docs = queries.documents(spark, sf, "doc_id", "text").collect()
        same_rows(queries.op7_circulant_minhash(spark, sf).collect(), all_pairs(docs))


def test_op7_odd(spark, odd_docs, no_docs, table_dir):
    same_rows(queries.op7_circulant_minhash(spark, table_dir(documents=odd_docs)).collect(),
              all_pairs(odd_docs.select("doc_id", "text").collect()))
    assert cm.near_duplicates(no_docs).count() == 0
    assert cm.keep_first(no_docs).count() == 0


def near(seed, base, change):
    r = random.Random(seed)
    w = base.split()
    for _ in range(change):
        w[r.randrange(len(w))] = r.choice(WORDS) + str(r.randint(100, 999))
    return " ".join(w)


def test_chains_and_buckets_of_several_components(spark):
    """Copies at all distances around the limit of one base, so that buckets hold many
    components and links run through members, not hubs."""
    docs = []
    for b in range(6):
        base = prose(100 + b, 60)
        docs += [(b * 100 + i, near(b * 100 + i, base, i % 9)) for i in range(60)]
        walk = base
        for i in range(60, 90):  # a chain: neighbours are close, its ends are not
            walk = near(b * 100 + i, walk, 2)
            docs.append((b * 100 + i, walk))
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for k in (2, 5):
        got = cm.near_duplicates(df, shingle=k).select("doc_id", "n_shingles", "component_id", "kept").collect()
        same_rows(got, all_pairs(docs, k))


def test_keep_first(spark, odd_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = cm.keep_first(docs, shingle=5)
    assert kept.columns == docs.columns
    want = {d for d, _, c, k in all_pairs([(r.doc_id, r.text) for r in docs.collect()], 5) if k}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    clash = odd_docs.withColumnRenamed("lang", "component").withColumnRenamed("n_chars", "best")
    out = cm.keep_first(clash, shingle=5)
    assert out.columns == clash.columns
    same = [r for r in out.collect() if r.text == "same text here"]
    assert len(same) == 1


def test_word_hashes_and_sets():
    r = random.Random(4)
    texts = ["", " \t", "a", "A a A", prose(3, 5000)] + ["".join(r.choice("ab \n\tÉé") for _ in range(40)) for _ in range(200)]
    low = [cm._lowered(t) for t in texts]
    seen = {}
    for t, words in zip(texts, cm.word_hashes(low), strict=True):
        w = WORD.findall(t.translate(UPPER))
        assert len(w) == len(words)
        for x, h in zip(w, words):
            assert seen.setdefault(x, h) == h
        for k in (1, 2, 5):
            assert len(cm.shingle_set(words, k)) == len(shingles(t, k))
    assert len(set(seen.values())) == len(seen)
    long = low[4] * 60
    cut = np.concatenate([cm._hash_chunk(long[:900_000].rsplit(b" ", 1)[0])[1]])
    assert (cm._long(long)[:len(cut)] == cut).all()


def test_signature_estimates_similarity():
    ring = cm.Circulant(32, 5, 7)
    r = np.random.default_rng(0)
    for share in (0.3, 0.8):
        errors = []
        for _ in range(30):
            x = r.integers(0, 1 << 64, 1000, dtype=np.uint64)
            n = int(2000 * share / (1 + share))
            y = np.concatenate([x[:n], r.integers(0, 1 << 64, 1000 - n, dtype=np.uint64)])
            errors.append((ring.signature(x) == ring.signature(y)).mean() - n / (2000 - n))
        assert abs(np.mean(errors)) < 0.02


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    root = defaultdict(lambda: None)

    def find(i):
        while root[i] is not None:
            i = root[i]
        return i
    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted(map(tuple, got)) == sorted((n, find(n)) for n in nodes)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("copies", [400])
def test_many_copies_and_near_copies(spark, copies):
    base = prose(9, 80)
    docs = [(i, base) for i in range(copies)] + [(1000 + i, near(i, base, 1 + i % 3)) for i in range(copies)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = cm.near_duplicates(df, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    same_rows(got, all_pairs(docs))


def test_forest_joins_what_all_pairs_join():
    r = random.Random(8)
    for apart in (None, 7):
        for _ in range(60):
            base = [r.sample(range(400), 30) for _ in range(3)]
            sets = []
            for _ in range(15):
                b = list(r.choice(base))
                for _ in range(r.randint(0, 5)):
                    b[r.randrange(30)] = r.randrange(1000, 1400)
                sets.append(np.unique(np.array(b, np.uint64)))
            comps = [bytes([r.randint(0, 9)]) for _ in sets]

            def joined(pairs):
                root = {c: c for c in comps}
                for i, j in pairs:
                    a, b = comps[i], comps[j]
                    while root[a] != a:
                        a = root[a]
                    while root[b] != b:
                        b = root[b]
                    root[a] = b

                def top(c):
                    return c if root[c] == c else top(root[c])
                groups = defaultdict(set)
                for c in root:
                    groups[top(c)].add(c)
                return sorted(map(sorted, groups.values()))
            want = [(i, j) for i, j in combinations(range(15), 2)
                    if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))
                    and (apart is None or (i < apart) != (j < apart))]
            got = cm.forest(sets, comps, 80, apart)
            assert set(map(frozenset, got)) <= set(map(frozenset, want))
            assert joined(got) == joined(want)


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cm, "BLOCK_SETS", 7)
    base = prose(21, 60)
    docs = [(i, near(i, base, 2 + i % 9)) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = cm.near_duplicates(df, shingle=2).select("doc_id", "n_shingles", "component_id", "kept").collect()
    same_rows(got, all_pairs(docs))
