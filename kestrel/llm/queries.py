"""Registered queries of the corpus operators (``opN_<name>``) and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import (bpe_automaton, chat_tokens, circulant_minhash, curriculum, dual_tree, exact_dedup, id_frames,
                         line_blocks, ngram_ratio, shard_shuffle, token_counts, turn_repair, url_lists)
from kestrel.llm.common import documents, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_id_frames")
def op1_id_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode, write seekable id files, read them back and digest what was read."""
    index, folder = id_frames.write_ids(documents(spark, sf_dir, "doc_id", "text"),
                                        tokenizer_path("word_bpe_49k.json"), end_id=2)
    back = id_frames.read_ids(id_frames.with_starts(index), folder)
    return back.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@register("op2_shard_shuffle")
def op2_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the shuffled shards and digest what is read back."""
    shards = shard_shuffle.shuffle_into_shards(documents(spark, sf_dir, "doc_id", "text"), 16)
    return shards.select("doc_id", shard_shuffle.record_size().alias("size"),
                         F.crc32(text_or_empty()).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@register("op3_bpe_automaton")
def op3_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode to ids, decode the ids, and digest both."""
    vocab = tokenizer_path("byte_bpe_50k.json")
    both = bpe_automaton.encode(documents(spark, sf_dir, "doc_id", "text"), vocab, decoded="decoded")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op4_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
         g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM d JOIN g USING (t)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.duplicate_classes(documents(spark, sf_dir, "doc_id", "text"), keep="max",
                                        digest=lambda t: F.unhex(F.sha2(t, 256)))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register("op8_curriculum_mix")
def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.mix(documents(spark, sf_dir, "doc_id", "source", "text"))


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text").withColumn("text", text_or_empty())
    n = token_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json"))
    return n.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "n_tokens",
                    (F.col("n_tokens") > 1024).alias("over_limit"))


@register("op10_ngram_ratio")
def op10_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    out = ngram_ratio.judged(docs, ngram_ratio.fit(docs, labels))
    return out.select(F.col("__c0").alias("doc_id"), F.col("__n").alias("n_words"),
                      F.col("__word_chars").alias("word_chars"), F.col("__n_symbols").alias("n_symbols"),
                      F.col("__n_dup_lines").alias("n_dup_lines"), F.col("__n_repeat_words").alias("n_repeat_words"),
                      F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
                      F.col("__score").alias("score"))


@register("op7_circulant_minhash")
def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"), shingle=2).select(
        "doc_id", "n_shingles", "component_id", "kept")


@register("op5_line_blocks")
def op5_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet").select("page_id", "url", "html")
    return line_blocks.extract(pages).select("page_id", "url", "text",
                                             F.char_length("text").cast("long").alias("n_chars"))


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as captures: the fetch day follows from the page number."""
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    return pages.select("page_id", "url", F.expr("date_add(date'2024-01-01', cast(page_id * 131 % 720 as int))")
                        .alias("fetch_day"))


def page_entries(captures: DataFrame) -> DataFrame:
    """A dated list of every page's host, host section or address; each page is one entry."""
    url, k = F.col("url"), F.col("page_id") % 4
    host, path = url_lists.host_of(url), url_lists.path_of(url)
    section = F.concat(host, F.lit("/"), F.split(path, "/")[1])
    return captures.select(
        F.when(k == 0, host).when(k == 1, F.concat(host, path)).otherwise(section).alias("value"),
        F.expr("date_add(date'2024-01-01', cast(page_id * 17 % 720 as int))").alias("day"),
        (F.col("page_id") % 3 != 0).alias("added"))


@register("op6_url_lists", r"""
    WITH p AS (SELECT page_id, url, date '2024-01-01' + CAST(page_id * 131 % 720 AS INTEGER) AS fetch_day,
                      date '2024-01-01' + CAST(page_id * 17 % 720 AS INTEGER) AS day,
                      regexp_extract(url, '//([^/?#]*)', 1) AS host,
                      regexp_replace(regexp_extract(url, '//[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM pages),
         e AS (SELECT CASE page_id % 4 WHEN 0 THEN host WHEN 1 THEN host || path
                           ELSE host || '/' || string_split(path, '/')[2] END AS value, day,
                      min(page_id % 3 <> 0) AS added FROM p GROUP BY 1, 2),
         i AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY value ORDER BY day) AS until FROM e) WHERE added),
         k AS (SELECT DISTINCT page_id, fetch_day, unnest([host, host || path, host || '/' || string_split(path, '/')[2],
                      regexp_extract(host, '[^.]+[.][^.]+$'), regexp_extract(host, '[^.]+[.][^.]+[.][^.]+$')]) AS key
               FROM p),
         h AS (SELECT page_id, count(*) AS n, min(key) AS first FROM k JOIN i ON key = value
               AND day <= fetch_day AND (until IS NULL OR fetch_day < until) GROUP BY 1)
    SELECT p.page_id, url, fetch_day, coalesce(n, 0) AS n_listed, first AS first_listed, n IS NOT NULL AS listed
    FROM p LEFT JOIN h USING (page_id)""")
def op6_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(spark, sf_dir)
    return url_lists.listed_captures(captures, page_entries(captures))


@register("op12_dual_tree", r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
         n AS (SELECT doc_id, words, len(words) AS n FROM d WHERE len(words) > 0),
         c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
         q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
                      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
         o AS (SELECT doc_id, n, unnest(words) AS term FROM n),
         f AS (SELECT doc_id, n, term, count(*) AS tf FROM o WHERE term IN (SELECT term FROM q) GROUP BY ALL),
         w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
               FROM f, c GROUP BY term, n_docs),
         s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) //
                      (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
               FROM f JOIN w USING (term) JOIN q USING (term), c GROUP BY ALL),
         r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
                      doc_id, score FROM s WHERE score > 0)
    SELECT * FROM r WHERE rank <= 50""")
def op12_dual_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    return dual_tree.search(documents(spark, sf_dir, "doc_id", "text"), items, k=50)


def damaged_conversations(conversations: DataFrame) -> DataFrame:
    """Rows damaged by a checksum of their place: dropped, emptied, cut, repeated or given to the user."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


@register("op13_turn_repair")
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage the conversations, repair them and digest the repaired turns."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repaired_digests(rows)


def repaired_digests(conversations: DataFrame) -> DataFrame:
    found = turn_repair.summary(turn_repair.repair(damaged_conversations(conversations)))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # of nothing
    return every.join(found, every.id.eqNullSafe(found.conv_id), "left").select(
        F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))


#: A conversation whose texts hold the template's control strings, one already escaped.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


@register("op11_chat_tokens", r"""
    WITH c AS (SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
               UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
               UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
         f AS (SELECT *, CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 ELSE 15 END + 8 + length(regexp_replace(
                      t, '(\\*(### System: |### User: |### Assistant: |### Role: |</role>|</turn>))', '\\\1', 'g')) AS n FROM c)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
           CAST(coalesce(sum(length(t)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(n) AS BIGINT) AS formatted_chars
    FROM f GROUP BY conv_id""")
def op11_chat_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format the conversations and one full of control strings, read them back and digest them."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], rows.schema)
    vocab = tokenizer_path("byte_bpe_50k.tiktoken")
    formatted = chat_tokens.format_turns(rows.unionByName(extra), vocab)
    return chat_tokens.digests(chat_tokens.read_turns(formatted, vocab))
