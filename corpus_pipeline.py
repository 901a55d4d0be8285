"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, langid, near_dedup, packing, secret_scan
from ledgerline.llm.common import read, stored

TOKENIZER = "word_bpe_49k.json"
SURE = 0.999  # score from which a prediction replaces the given language
SHINGLES = near_dedup.Rule(width=5, percent=80)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (no text, no letter) go. The
    others carry the predicted language where they have none, and where the
    prediction is sure that another learned language than theirs is meant."""
    model = langid.train(docs)
    if model is None:  # nothing labelled: only texts without a letter are told apart
        return docs.filter(F.coalesce(docs["text"].rlike(r"\p{L}"), F.lit(False)))
    # The row travels as one struct, so no column of docs can clash.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    row = F.col("row")
    pred = F.col("pred")
    kept = rows.withColumn("pred", langid.predicted(spark, model, row["text"])).filter(pred["lang"] != langid.UNDETERMINED)
    sure = row["lang"].isin(model.langs) & (pred["score"] >= SURE)
    lang = F.when(row["lang"].isNull() | sure, pred["lang"]).otherwise(row["lang"])
    return kept.select(*[(lang if c == "lang" else row[c]).alias(c) for c in docs.columns])


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_dedup.keep_one(docs, SHINGLES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are masked."""
    return secret_scan.redacted(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of fixed-length training sequences, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [("language_id", language), ("near_dedup", dedup), ("decontamination", decontamination), ("secret_scan", secrets),
          ("packing", pack)]
# Language models, MinHash groups and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
