"""Training-data pipeline: five stages from raw documents to tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of documents, and
carry further columns of theirs along, whatever their names (``__`` at the start is reserved).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import bpe, line_dedup, mixing, ngram_join, quality, toxicity
from leadloom.llm.shared import stored

TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit; empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_from_labels(docs, labels)
    return toxicity.score(docs, model, docs.columns, name="__toxic").where(F.col("__toxic") < TOXIC_FROM).drop("__toxic")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines seen earlier. A document left without a word was made of such lines
    and goes; one that lost nothing stays as it is."""
    found = line_dedup.dedup(docs, name="__removed")
    left = (F.col("__removed") == 0) | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    length = F.when(F.col("__removed") > 0, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return found.where(left).withColumn("n_chars", length).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Rows sharing an id stay or go together, alike rows as one.
    """
    found = ngram_join.join(docs)
    gone = found.where(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    return docs.dropDuplicates(["doc_id", "text"]).join(stored(gone), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: a row for each pass, the one at its source's end cut.

    Texts are joined to the takes by id and a hash of the text; documents without words take no
    share and leave, and of rows alike in id and text one is mixed.
    """
    own = docs.withColumn("__key", F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text").cast("string")))
    # Alike rows would meet one another's takes.
    own = own.dropDuplicates(["__key"])
    mixed = mixing.mix(own, mixing.word_count("text"), id_col="__key")
    takes = mixed.entries.select(F.col("doc_id").alias("__key"), F.col("take").alias("__take"))
    words = mixing.word_count("text")
    joined = own.join(takes, "__key")
    # The text up to its take-th word: all but what remains after splitting off so many words.
    rest = F.element_at(F.split(F.ltrim("text", F.lit(quality.SPACE)), quality.SPACES, (F.col("__take") + 1).cast("int")), -1)
    part = F.rtrim(F.col("text").substr(F.lit(1), F.char_length("text") - F.char_length(rest)), F.lit(quality.SPACE))
    cut = F.col("__take") < words
    text = F.when(cut, part).otherwise(F.col("text"))
    length = F.when(cut, F.char_length(part).cast("bigint")).otherwise(F.col("n_chars"))
    return joined.select(*[{"text": text, "n_chars": length}.get(c, F.col(c)).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, token ids, their number, and whether decoding gives the text back."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = public_tokenizers.PATTERN
    encoded = bpe.encode(docs, path, pattern, decoded=True, keep=["text"])
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return encoded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte-level BPE", encode),
]

# Model fitting and byte-pair encoding cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
