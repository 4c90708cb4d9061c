"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from silvermill.llm import ann, piece_codec, prefix_trie, quality, ranked_search, warc
from silvermill.llm.following import ring_buckets
from silvermill.llm.jaccard_join import near_duplicates
from silvermill.llm.line_dedup import dedup_lines
from silvermill.llm.lm_scoring import score_documents
from silvermill.llm.mixing import mix_sources, training_order, word_count
from silvermill.llm.packing import pack_pieces, token_pieces
from silvermill.llm.simhash import fingerprint_rows, likeness, near_fingerprints
from silvermill.llm.text import read_table, whole_text
from silvermill.llm.url_filter import judge_urls
from silvermill.scratch import new_folder, stored, with_scratch

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_documents(docs, order=2, alpha=0.4, min_count=2)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = new_folder(spark, "warc")
    index = warc.write_bundles(pages, folder, id_col="page_id", min_payload=0)
    page = lambda name: F.substring_index(name, ":", -1).try_cast("long")
    return warc.read_bundles(index, folder).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = ann.build_index(vectors)
    return ann.nearest(index, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, shingle=3, percent=90)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", whole_text("text").alias("text"))
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, order = ring_buckets(docs.withColumn("_tie", F.xxhash64("text")), "doc_id", buckets)
    cut = F.floor(F.col("n_chars") / 2)
    edited = rows.withColumns({
        "n_chars": F.char_length("text").cast("long"),
        "rank": F.row_number().over(order),
        "next": F.lead("text", 1, "").over(order),
    }).withColumn("edited", F.concat(
        F.expr("substring(text, 1, int(n_chars - floor(n_chars / 2)))"),
        F.expr("substring(next, 1, int(floor(n_chars / 2)))"),
    ))
    keys = ["_bucket", "rank", "_guest", "doc_id", "n_chars", "edited_sha256"]
    texts = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *keys,
        F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("text").alias("whole")),
            F.struct(F.lit(1).alias("kind"), F.col("edited").alias("whole")),
        )).alias("of"),
    ).where((F.col("_guest") == 0) | (F.col("of.kind") == 0)).select(*keys, "of.kind", "of.whole")
    prints = fingerprint_rows(texts, [*keys, "kind"], "whole").groupBy(*keys).agg(
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("print"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_print"),
    )
    in_order = Window.partitionBy("_bucket").orderBy("rank")
    beside = stored(
        prints.withColumn("next_print", F.lead("print").over(in_order)).where(F.col("_guest") == 0)
        .select("doc_id", "n_chars", "edited_sha256", "print", "edited_print", "next_print"),
        "simhash",
    )
    pairs = near_fingerprints(beside, col="print")
    near = stored(  # written, so that a fingerprint of very many rows can be split in the join
        pairs.select(F.explode(F.array("a", "b")).alias("near_print"))
        .groupBy("near_print").agg(F.count("*").alias("n_near")),
        "simhash-near",
    )
    hexed = lambda name: F.lpad(F.lower(F.hex(name)), 16, "0")
    return beside.join(near, F.col("print") == F.col("near_print"), "left").select(
        "doc_id", "n_chars", "edited_sha256",
        hexed("print").alias("fingerprint"), hexed("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print")).alias("near_edited"),
        likeness(F.col("print"), F.coalesce("next_print", "print")).alias("near_next"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = stored(
        read_table(spark, sf_dir, "documents").select(
            "doc_id", "source", word_count(whole_text("text")).alias("size")
        ),
        "mix-sizes",
    )
    mixed = stored(
        mix_sources(sized, size_col="size").withColumn("row", F.monotonically_increasing_id()), "mixed"
    )
    ordered = stored(training_order(mixed.select("row", "mix")), "mix-order")
    copies = ordered.groupBy("row").agg(
        F.sum("mix.words").alias("taken"), F.min("mix.position").alias("first")
    )
    return mixed.join(copies, "row", "left").select(
        "doc_id", "mix.size", "mix.source_size", "mix.target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), F.round("first", 6).alias("position"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs, vocabulary, public_tokenizers.PATTERN, capacity=1024, end_id=2)
    return pack_pieces(stored(pieces, "pieces"), capacity=1024)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, threshold=0.7).select(
        "doc_id", quality.is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.rebuilt_trie(turns)


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = piece_codec.encode_pieces(docs, model, decode=True)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark").select("item_id", "text")
    return ranked_search.search(ranked_search.build_index(docs), items, k=10)


def llm_queries() -> dict[str, Query]:
    queries = (
        op1_lm_scoring, op2_warc, op3_line_dedup, op4_nearest, op5_jaccard_join, op6_simhash,
        op7_mixing, op8_packing, op9_quality, op10_url_filter, op11_prefix_trie,
        op12_sentencepiece, op13_ranked_search,
    )
    return {query.__name__: with_scratch(query) for query in queries}
