"""Operators 1, 3 and 9 against the public tokenizers library itself."""

import hashlib
import io
import json
import random
import struct
import zlib

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from kestrel.llm import bpe_automaton, id_frames, queries, token_counts

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


@pytest.fixture(scope="module")
def lib():
    from tokenizers import Tokenizer

    return {n: Tokenizer.from_file(queries.tokenizer_path(n)) for n in (BYTE, WORD)}


def ids(lib, name, text):
    return lib[name].encode(text or "", add_special_tokens=False).ids


def same_rows(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def expected3(lib, rows):
    out = []
    for d, t in rows:
        i = ids(lib, BYTE, t)
        out.append((d, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                    hashlib.sha256(lib[BYTE].decode(i, skip_special_tokens=False).encode()).hexdigest()))
    return out


def test_op3_on_documents(spark, lib):
    docs = queries.documents(spark, SF_SMALL, "doc_id", "text").collect()
    same_rows(queries.op3_bpe_automaton(spark, SF_SMALL).collect(), expected3(lib, docs))


def test_op3_odd(spark, lib, odd_docs, no_docs, table_dir):
    same_rows(queries.op3_bpe_automaton(spark, table_dir(documents=odd_docs)).collect(),
              expected3(lib, odd_docs.select("doc_id", "text").collect()))
    vocab = queries.tokenizer_path(BYTE)
    assert bpe_automaton.encode(no_docs, vocab).count() == 0
    clash = bpe_automaton.encode(odd_docs.withColumn("ids", F.lit("x")), vocab)
    assert dict(clash.dtypes)["ids"] == "array<int>" and clash.columns == [*odd_docs.columns, "ids"]
    both = bpe_automaton.encode(odd_docs, vocab, decoded="text").select("text", "ids")
    again = bpe_automaton.decode(both, vocab, out="again")
    assert [r.text for r in again.collect()] == [r.again for r in again.collect()]
    lost = spark.createDataFrame([(None,), ([],), ([-1, 10 ** 6, 64],), ([162],)], "ids array<int>")
    assert [r.text for r in bpe_automaton.decode(lost, vocab).collect()] == ["", "", "a", "�"]


def test_automaton_equals_library_on_random_words(lib):
    spec = json.loads(open(queries.tokenizer_path(BYTE)).read())
    auto = bpe_automaton.MergeAutomaton(spec["model"]["vocab"], spec["model"]["merges"])
    r = random.Random(3)
    for _ in range(3000):
        w = "".join(r.choice("aehtinorsdABx019.,") for _ in range(r.randint(1, 30)))
        path = [t for u, _ in lib[BYTE].pre_tokenizer.pre_tokenize_str(w) for t in auto.encode_word(u)]
        assert path == ids(lib, BYTE, w), w


def test_gadget_of_equal_parts_takes_the_left_pair_first():
    auto = bpe_automaton.MergeAutomaton({"a": 0, "b": 1, "aa": 2, "aab": 3}, ["a a", "aa b"])
    assert auto.encode_word("aaaaa") == [2, 2, 0]
    assert auto.encode_word("aaab") == [2, 0, 1]
    assert auto.encode_word("aaaab") == [2, 3]


def test_label_that_no_path_uses():
    # "bc" merges first, so "ab" + "c" never meet
    auto = bpe_automaton.MergeAutomaton({"a": 0, "b": 1, "c": 2, "bc": 3, "ab": 4, "abc": 5},
                                        ["b c", "a b", "ab c"])
    assert auto.encode_word("abc") == [0, 3]
    assert auto.encode_word("abb") == [4, 1]


def test_op9(spark, lib, odd_docs, no_docs, table_dir):
    def want(rows):
        return [(d, len((t or "").encode()), n, n > 1024) for d, t in rows for n in [len(ids(lib, BYTE, t))]]
    docs = queries.documents(spark, SF_SMALL, "doc_id", "text").collect()
    same_rows(queries.op9_token_counts(spark, SF_SMALL).collect(), want(docs))
    same_rows(queries.op9_token_counts(spark, table_dir(documents=odd_docs)).collect(),
              want(odd_docs.select("doc_id", "text").collect()))
    assert token_counts.token_counts(no_docs, queries.tokenizer_path(BYTE)).count() == 0
    again = token_counts.token_counts(odd_docs.withColumn("n_tokens", F.lit("x")), queries.tokenizer_path(BYTE))
    assert dict(again.dtypes)["n_tokens"] == "bigint"


def test_merged_length_by_brute_force():
    def slow(word, rank):
        s = list(word)
        while True:
            best = min(((rank[p], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
            if best is None:
                return len(s)
            i = best[1]
            s[i:i + 2] = [s[i] + s[i + 1]]
    rank = {("a", "a"): 0, ("a", "b"): 1, ("aa", "aa"): 2, ("b", "ab"): 3, ("aa", "b"): 4, ("bab", "ab"): 5}
    r = random.Random(5)
    for _ in range(2000):
        w = "".join(r.choice("aab") for _ in range(r.randint(0, 14)))
        assert token_counts.merged_length(w, rank) == slow(w, rank), w


def expected1(lib, rows):
    out, start = [], 0
    for d, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        i = ids(lib, WORD, t) + [2]
        out.append((d, start, len(i), zlib.crc32(struct.pack(f"<{len(i)}I", *i))))
        start += len(i)
    return out


def test_op1(spark, lib, odd_docs, no_docs, table_dir):
    docs = queries.documents(spark, SF_SMALL, "doc_id", "text").collect()
    same_rows(queries.op1_id_frames(spark, SF_SMALL).collect(), expected1(lib, docs))
    same_rows(queries.op1_id_frames(spark, table_dir(documents=odd_docs)).collect(),
              expected1(lib, odd_docs.select("doc_id", "text").collect()))
    index, _ = id_frames.write_ids(no_docs, queries.tokenizer_path(WORD), end_id=2)
    assert index.count() == 0


def test_word_cache_equals_whole_text_encoding(lib):
    js = open(queries.tokenizer_path(WORD), "rb").read()
    words = id_frames.WordIds(js, limit=50)
    r = random.Random(9)
    texts = ["Abc. aBc, abc., x1. ½. a... İ. <|ENDOFTEXT|> <|endoftext|>", "é. É, Éé", "z" * 60 + ".", "z" * 60]
    texts += [" ".join(r.choice(["Stone", "stone.", "STONE,", "river", "Ñandú.", "ΣΑΣ", "it's.", "7."]) for _ in range(9))
              for _ in range(300)]
    texts += ["".join(r.choice("*.,&abé́ \n\t'sTl1Σ　#<|>") for _ in range(r.randint(0, 60)))
             for _ in range(1500)]
    for t, b in zip(texts, words.of(texts)):
        assert list(struct.unpack(f"<{len(b) // 4}I", b)) == ids(lib, WORD, t), t


def test_files_are_seekable_zstandard(spark, lib, tmp_path):
    import pyarrow as pa
    import zstandard

    docs = queries.documents(spark, SF_SMALL, "doc_id", "text")
    index, folder = id_frames.write_ids(docs, queries.tokenizer_path(WORD), 2, folder=str(tmp_path / "f"), num_files=3)
    rows = sorted(index.collect())
    assert len({r.file for r in rows}) == 3
    text = {d: t for d, t in docs.collect()}
    for name in sorted({r.file for r in rows}):
        raw = (tmp_path / "f" / name).read_bytes()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
        want = [i for r in rows if r.file == name for i in [*ids(lib, WORD, text[r.doc_id]), 2]]
        assert list(struct.unpack(f"<{len(whole) // 2}H", whole)) == want  # a vocabulary below 2^16
        reader = id_frames.FrameReader(pa.BufferReader(raw))
        assert len(reader) == sum(r.file == name for r in rows)
        bad = bytearray(raw)
        bad[8] ^= 0xFF
        with pytest.raises(Exception):
            id_frames.FrameReader(pa.BufferReader(bytes(bad))).frame(0)
    few = id_frames.read_ids(index.where("doc_id in (3, 150)"), folder).collect()
    assert {r.doc_id: len(r.ids) // 4 for r in few} == {d: len(ids(lib, WORD, text[d])) + 1 for d in (3, 150)}


def test_long_documents_span_frames(spark, monkeypatch):
    sink = io.BytesIO()
    keep = sink.close
    sink.close = lambda: None
    w = id_frames.FrameWriter(sink)
    for part in (b"abcd" * 10, b"", b"xyz"):
        w.add(part)
    w.close()
    import pyarrow as pa

    r = id_frames.FrameReader(pa.BufferReader(sink.getvalue()))
    assert [r.frame(k) for k in range(3)] == [b"abcd" * 10, b"", b"xyz"]
    keep()
