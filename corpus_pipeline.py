"""Corpus pipeline: language ID, line dedup, near-duplicate removal, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  Every
column of the input is kept up to the last stage, which returns the token
counts and digests of the encoded mix.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martline.llm import bpe, langid, linededup, mixing, simhash
from martline.llm.blocks import remainder
from martline.llm.queries import BPE_VOCABULARY
from martline.session import ensure_checkpoint_dir


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language (``und``: null text or no letter) go; a missing ``lang`` becomes the predicted one."""
    model = langid.fit(docs, train_on=remainder(F.col("doc_id"), 4) != 2)
    # the network gives every text with a letter a language; a filter on its answer would run it twice
    lettered = docs.where(F.col("text").rlike(r"\p{L}"))
    guessed = langid.predict(lettered.select(F.struct("*").alias("row"), "text"), model, pred="lang_pred", score="lang_score")
    known = F.when(F.col("lang_pred") != langid.UNDETERMINED, F.col("lang_pred"))
    return guessed.select(*[F.coalesce(F.col("row.lang"), known).alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: lines that 10 or more documents share go, in every document."""
    kept = linededup.drop_frequent_lines(docs.select(F.struct("*").alias("row"), "text"), min_docs=10, min_chars=1)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document with the smallest id of each group stays."""
    return simhash.keep_one(docs, radius=3, shingle=3)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: 150% of all words by source weights, no source above two epochs; a row for each repetition."""
    return mixing.mix(docs, weights=(3, 1, 2), share=1.5, max_epochs=2.0)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE: every repetition encoded and decoded."""
    done = bpe.round_trip(docs, BPE_VOCABULARY)
    return done.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: The trained classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; between stages the rows are written under the checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{base}/{i}-{name}")
            docs = spark.read.parquet(f"{base}/{i}-{name}")
    return docs
