"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes what its predecessor wrote and returns documents; all but the last keep the
columns of ``documents``. Stages drop whole documents (toxic, near copies, contaminated) or
lines of them (line dedup).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradepulse.llm import bpe, decontam, linededup, simhash, toxicity
from tradepulse.llm.shared import landed, table

TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC; those without text stay."""
    model = toxicity.trained_on_labels(spark, sf_dir)
    scored = toxicity.classify(docs, model, score_col="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).drop("_toxicity")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents share; ``n_chars`` follows. Null texts stay null."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")
    rows = linededup.dedupe_lines(docs.select("doc_id", "text", rest))
    text = F.when(F.col("text").isNotNull(), F.col("kept"))
    length = F.when(F.col("n_dropped") > 0, F.char_length(text).cast("long")).otherwise(F.col("rest.n_chars"))
    new = {"text": text, "n_chars": length}
    return rows.select(*[new.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])


def row_key() -> Column:
    """Tells rows apart that share an id; rows with the same id and text are one document."""
    return F.xxhash64("doc_id", "text")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id. Rows without an id or a text stay.

    Texts without a word, as line dedup leaves copies, share a fingerprint and so are copies of each other.
    Rows that share an id are judged each.
    """
    keyed = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.struct("doc_id", row_key().alias("key")).alias("row"), "text")
    marked = landed(simhash.near_duplicates(keyed, "row"), "near-copies")
    others = marked.where(F.col("id") != F.col("component")).select("id.*").distinct()
    return docs.join(others, (docs["doc_id"] == others["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == others["key"]), "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no exact or edited copy of a benchmark item. Rows that share an id are judged each."""
    keyed = docs.select(row_key().alias("key"), "text")
    found = decontam.contaminated(keyed, table(spark, sf_dir, "benchmark"), "key").select("id").distinct()
    return docs.join(found, row_key() == found["id"], "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the length of the text they decode to."""
    rows = bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.char_length("decoded").cast("long").alias("n_decoded"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe", encode),
]

#: SQL has no compression, Smith-Waterman alignment or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), name)
    return docs
