"""Raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept, decides over all of it, and is written
as Parquet before the next one reads it. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from silvermill.llm.jaccard_join import near_duplicates
from silvermill.llm.line_dedup import dedup_lines
from silvermill.llm.mixing import mix_sources, training_order
from silvermill.llm.packing import pack_pieces, token_pieces
from silvermill.llm.quality import score_quality, train_quality
from silvermill.llm.text import free_names, read_table
from silvermill.scratch import stored, with_scratch

#: Documents below this score go. Lower than a label's threshold: a clean document
#: lost costs more than a poor one kept.
KEEP_FROM = 0.5


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good."""
    model = train_quality(docs, read_table(spark, sf_dir, "labels"))
    score, good = free_names(docs, "score", "good")
    scored = score_quality(docs, model, score_col=score, predicted_col=good, threshold=KEEP_FROM)
    return scored.where(F.col(good) == 1).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has; n_chars follows."""
    kept = dedup_lines(docs, counts=None)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near duplicates, one row: that with the smallest id, null last.

    Rows are linked and judged each by its own text, whatever ids they have, so a row
    that shares its id with a copy stays if it is no copy itself. Of rows with the
    same id, or none, one stays if they are near duplicates. Rows without words are
    nobody's duplicates.
    """
    row, component = free_names(docs, "row", "component")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = near_duplicates(numbered, shingle=5, percent=80, id_col=row)
    judged = numbered.select(row, "doc_id").join(
        found.select(F.col("doc_id").alias(row), F.col("component_id").alias(component)).hint("merge"), row
    )
    first = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    kept = judged.groupBy(component).agg(F.min(first).alias("first")).select(F.col(f"first.{row}"))
    return numbered.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole copies of documents by their sources' targets, in training order."""
    return training_order(mix_sources(docs), cut_copies=False).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs, vocabulary, public_tokenizers.PATTERN, capacity=1024, end_id=2)
    return pack_pieces(stored(pieces, "pieces"), capacity=1024)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("mixing", mix),
    ("packing", packing),
]


@with_scratch
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name)
    return docs


#: A trained classifier and shingle components are beyond SQL; tests compare the
#: stages with brute force.
ORACLE_SQL = None
