"""The pipeline against a plain Python version of its stages."""

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline as cp
from conftest import SF_SMALL

from kestrel.llm import queries
from llm.test_near import all_pairs
from llm.test_quality import LABELS, judged, weights_of
from llm.test_shape import WORD, targets


def plain_filter(rows, labels):
    """(doc_id, text, source) that stay after the first three stages."""
    docs = [(r.doc_id, r.text) for r in rows]
    weights = weights_of(docs, {r.doc_id for r in labels if r.quality == 1})
    kept = [r for r, j in zip(rows, judged(docs, weights)) if j[-2]]
    first = {}
    for r in sorted(kept, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        first.setdefault(r.text or "", r)
    kept = list(first.values())
    near = all_pairs([(r.doc_id, r.text) for r in kept], 5)
    return [r for r, n in zip(kept, near) if n[3]]


def test_stages_against_brute_force(spark):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    for _, stage in cp.STAGES[:3]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns
    want = plain_filter(rows, labels)
    assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in want)

    out = cp.run(spark, SF_SMALL).collect()
    by_id = {r.doc_id: r for r in want}
    assert {r.doc_id for r in out} <= set(by_id)
    for r in out:
        t = by_id[r.doc_id].text
        assert list(r.ids) == lib.encode(t, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    # the mix: sources near their targets, no document more than three times
    per, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    times = Counter(r.doc_id for r in out)
    for r in want:
        n = len(WORD.findall(r.text))
        per[r.source] += n
        taken[r.source] += n * times[r.doc_id]
        most[r.source] = max(most[r.source], n)
        assert times[r.doc_id] <= 3
    goal = targets(per)
    assert all(abs(taken[s] - goal[s]) <= most[s] / 2 + 1 for s in per)


def test_odd_tables(spark, odd_docs, no_docs, table_dir):
    labels = spark.createDataFrame([(20, 1, 0)], LABELS)
    extra = odd_docs.withColumnRenamed("lang", "component").withColumnRenamed("n_chars", "__kept")
    sf = table_dir(documents=extra, labels=labels)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in cp.STAGES[:4]:
        docs = stage(spark, docs, sf)
        assert docs.columns == extra.columns
    assert {r.doc_id for r in cp.run(spark, sf).collect()} <= {r.doc_id for r in odd_docs.collect()}
    empty = no_docs
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, sf)
    assert empty.count() == 0


def test_registered():
    import __spark_entry__ as entry

    keys = entry.queries()
    assert "pipeline" in keys and all(any(k.startswith(f"op{n}_") for k in keys) for n in range(1, 11))
    assert set(entry.oracle_sql()) <= set(keys)
