"""Operators 2, 4 and 8: sharding, exact de-duplication, mixing."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.llm import curriculum, exact_dedup, queries, shard_shuffle

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def same_rows(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


# ---- 2: sharding ----------------------------------------------------------------------------

def check_shards(rows, docs, shards=16):
    size = lambda t: len((t or "").encode()) + 1
    same_rows([(r.doc_id, r["size"], r.text_crc32) for r in rows],
              [(d, size(t), zlib.crc32((t or "").encode())) for d, t in docs])
    slots = defaultdict(list)
    for r in rows:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_op2(spark, odd_docs, no_docs, table_dir):
    docs = queries.documents(spark, SF_SMALL, "doc_id", "text").collect()
    first = queries.op2_shard_shuffle(spark, SF_SMALL).collect()
    check_shards(first, docs)
    same_rows(first, queries.op2_shard_shuffle(spark, SF_SMALL).collect())
    check_shards(queries.op2_shard_shuffle(spark, table_dir(documents=odd_docs)).collect(),
                 odd_docs.select("doc_id", "text").collect())
    assert shard_shuffle.shuffle_into_shards(no_docs, 16).count() == 0
    clash = odd_docs.withColumn("shard", F.lit("x")).withColumn("slot", F.lit("y"))
    out = shard_shuffle.shuffle_into_shards(clash, 3)
    assert out.count() == odd_docs.count() and dict(out.dtypes)["slot"] == "bigint"
    assert set(out.columns) == {*odd_docs.columns, "shard", "slot"}


def test_shards_are_mixed(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = shard_shuffle.shuffle_into_shards(docs, 8, bucket_bytes=500).collect()
    means = [sum(r.doc_id for r in rows if r.shard == s) / 500 for s in range(8)]
    assert all(abs(m - 2000) < 250 for m in means)
    other = shard_shuffle.shuffle_into_shards(docs, 8, seed=5, bucket_bytes=500).collect()
    assert sum(a == b for a, b in zip(sorted((r.doc_id, r.shard) for r in rows),
                                      sorted((r.doc_id, r.shard) for r in other))) < 1000


def places(df, cols=("doc_id", "text")):
    return sorted(((*(r[c] for c in cols), r.shard, r.slot) for r in df.collect()), key=repr)


def test_one_permutation_on_every_cluster(spark, odd_docs):
    """Neither shuffle partitions nor the cut of the input change a record's place."""
    more = odd_docs.unionByName(spark.range(500).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("t "), F.col("id") % 7).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.col("id").alias("n_chars")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    for parts in (3, 211):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append(places(shard_shuffle.shuffle_into_shards(more.repartition(parts), 5)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and len(found[0]) == more.count()


def test_equal_rows_are_spread(spark, monkeypatch):
    """A third of all rows are one record: no bucket holds much more than the others."""
    monkeypatch.setattr(shard_shuffle, "LEAST_BUCKETS", 32)
    docs = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 > 0, F.concat(F.lit("x"), F.col("id"))).otherwise("same").alias("text"))
    sizes = shard_shuffle._numbered(docs, 17).groupBy(
        F.pmod(F.xxhash64(F.lit(17), "__mark", "__copy"), F.lit(32))).count().toPandas()["count"]
    assert len(sizes) == 32 and sizes.sum() == 9000 and sizes.max() < 1.4 * sizes.median()
    check_shards(shard_shuffle.shuffle_into_shards(docs, 16).withColumns({
        "size": shard_shuffle.record_size(), "text_crc32": F.crc32("text"), "law": F.lit("rows"),
        "grown_shard": F.lit(None)}).collect(), docs.collect())


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(shard_shuffle.fisher_yates(3, 1, b)) for b in range(6000))
    assert len(seen) == 6 and all(800 < n < 1200 for n in seen.values())


# ---- 4: exact de-duplication -----------------------------------------------------------------

def classes(docs, best=max):
    groups = defaultdict(list)
    for d, t in docs:
        groups[t or ""].append(d)
    out = []
    for t, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = best(known) if known else None
        free = True
        for d in ids:
            out.append((d, keep, len(ids), d == keep and free, hashlib.sha256(t.encode()).hexdigest()))
            free = free and d != keep
    return out


def test_op4(spark, odd_docs, no_docs, table_dir):
    same_rows(queries.op4_exact_dedup(spark, SF_SMALL).collect(),
              classes(queries.documents(spark, SF_SMALL, "doc_id", "text").collect()))
    same_rows(queries.op4_exact_dedup(spark, table_dir(documents=odd_docs)).collect(),
              classes(odd_docs.select("doc_id", "text").collect()))
    assert exact_dedup.duplicate_classes(no_docs).count() == 0


@pytest.mark.parametrize("keep", ["min", "max"])
def test_hash_collisions_are_told_apart_by_bytes(spark, keep):
    docs = [(1, "ab"), (2, "ba"), (3, "ab"), (4, None), (5, ""), (6, "xyz"), (None, "xyz"), (3, "ab")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("keep_id", F.lit("clash"))
    out = exact_dedup.duplicate_classes(df, keep=keep, digest=lambda t: F.sha2(t, 256),
                                        hash_fn=lambda t: F.length(t))
    same_rows(out.collect(), classes(docs, max if keep == "max" else min))


def test_keep_one(spark, odd_docs, no_docs):
    for keep, best in (("max", max), ("min", min)):
        one = exact_dedup.keep_one(odd_docs, keep=keep)
        assert one.columns == odd_docs.columns
        want = [(d, t) for d, t in odd_docs.select("doc_id", "text").collect()]
        kept = {(r[1], r[4]) for r in [(0, c[0], 0, 0, c[4]) for c in classes(want, best) if c[3] or c[1] is None]}
        got = [(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in one.collect()]
        same_rows(got, kept)
    assert exact_dedup.keep_one(no_docs).count() == 0
    null_only = odd_docs.where("text is null or text = ''")
    assert [(r.doc_id, r.text) for r in exact_dedup.keep_one(null_only, keep="min").collect()] == [(0, None)]


# ---- 8: mixing -------------------------------------------------------------------------------

def targets(size_by_source, weights=(1, 2, 3), most=3):
    names = sorted(size_by_source, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = float(sum(size_by_source.values())), set(names), {}
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * size_by_source[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = float(most * size_by_source[s])
            left -= out[s]
            open_.discard(s)
    return out


def check_mix(rows, docs, id_source):
    size = {}
    per = defaultdict(int)
    for d, s, t in docs:
        n = len(WORD.findall(t or ""))
        per[s] += n
        size.setdefault((d, s), []).append(n)
    want = targets(per)
    same_rows([(r.doc_id, r["size"]) for r in rows], [(d, len(WORD.findall(t or ""))) for d, _, t in docs])
    got, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = id_source(r)
        assert r.source_size == per[s] and math.isclose(r.target, want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r.taken <= 3 * r["size"] and r.taken == r["size"] * len(r.positions)
        assert all(0 <= p <= 1 for p in r.positions)
        got[s] += r.taken
        largest[s] = max(largest[s], r["size"])
    for s in per:
        assert abs(got[s] - want[s]) <= largest[s] / 2 + 1


def test_op8(spark):
    docs = queries.documents(spark, SF_SMALL, "doc_id", "source", "text").collect()
    source = {d: s for d, s, _ in docs}
    rows = queries.op8_curriculum_mix(spark, SF_SMALL).collect()
    check_mix(rows, docs, lambda r: source[r.doc_id])
    same_rows(rows, queries.op8_curriculum_mix(spark, SF_SMALL).collect())


def test_op8_odd(spark, odd_docs, no_docs, table_dir):
    unique = odd_docs.where("doc_id is not null and not (doc_id in (3, 15) and n_chars = 7 and lang = 'de')").dropDuplicates(["doc_id"])
    docs = unique.select("doc_id", "source", "text").collect()
    source = {d: s for d, s, _ in docs}
    check_mix(queries.op8_curriculum_mix(spark, table_dir(documents=unique)).collect(), docs, lambda r: source[r.doc_id])
    assert curriculum.mix(odd_docs).count() == odd_docs.count()
    assert curriculum.mix(no_docs).count() == 0
    assert curriculum.training_order(no_docs).count() == 0
    wordless = curriculum.mix(odd_docs.withColumn("text", F.lit(" ")).withColumn("size", F.lit("x"))).collect()
    assert all(r.taken == 0 and r.target == 0 for r in wordless)


def test_caps_are_reshared(spark):
    rows = [(i, f"s{i}", " ".join(["w"] * n)) for i, n in enumerate([100, 100, 1, 2, 5])]
    out = curriculum.mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    want = targets({f"s{i}": n for i, n in enumerate([100, 100, 1, 2, 5])})
    assert {r.doc_id: round(r.target, 9) for r in out} == {i: round(want[f"s{i}"], 9) for i in range(5)}
    assert math.isclose(sum(r.target for r in out), 208)


def test_positions_invert_the_demand(spark):
    for w, knots in zip((1, 2, 3), curriculum.CURVES):
        share = spark.createDataFrame([(i / 50, w) for i in range(51)], "s double, w int")
        for r in share.select("s", curriculum._position(F.col("s"), F.col("w"), (1, 2, 3), curriculum.CURVES).alias("t")).collect():
            done = total = 0.0
            for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
                total += (t1 - t0) * (r0 + r1) / 2
                x = min(max(r.t, t0), t1)
                done += (x - t0) * (r0 + r0 + (r1 - r0) * (x - t0) / (t1 - t0)) / 2
            assert math.isclose(done / total, r.s, abs_tol=1e-9)


def test_training_order_repeats_rows_as_taken(spark, odd_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    mixed = curriculum.training_order(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    # a row is hashed with all its columns here, so it is compared with the law, not with mix()
    per, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs.collect():
        n = len(WORD.findall(r.text or ""))
        per[r.source] += n
        taken[r.source] += n * got[r.doc_id]
        most[r.source] = max(most[r.source], n)
        assert got[r.doc_id] <= 3
    want = targets(per)
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1 for s in per)
    twice = curriculum.training_order(odd_docs.union(odd_docs))
    assert twice.columns == odd_docs.columns
    total = sum(len(WORD.findall(r.text or "")) for r in twice.collect())
    assert total > 0
