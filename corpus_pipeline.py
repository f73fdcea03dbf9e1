"""A corpus pipeline: language identification, line dedup, near-copy removal, mixing, packing.

Each stage takes the documents that its predecessor kept and returns documents again, the last one the
pieces of token sequences. `run` writes every stage's result as Parquet and reads it again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crawlstrata.llm import jaccard, langid, linededup, mixing, packing
from crawlstrata.llm.catalog import MIX_ROUNDS, MIX_TARGETS, mix_columns
from crawlstrata.llm.common import fold, pieces, table
from crawlstrata.session import drop_folder, prepare, scratch, stage

# A document whose likeliest language is less likely than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5
# The mixture keeps this share of the tokens that reach it.
MIX_BUDGET = 0.5
# Its targets are those of the catalogue, and one for languages that these do not name.
MIX = MIX_TARGETS | {"lang": MIX_TARGETS["lang"] | {"other": 0.05}}


def lettered(docs: DataFrame) -> DataFrame:
    """The documents that have a letter."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            yield batch.filter(pa.array([any(map(str.isalpha, t)) for t in texts]))

    return docs.mapInArrow(keep, docs.schema)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; a missing `lang` is filled in. Texts without a letter go, and so do those
    whose likeliest language has less than LEAST_LANGUAGE_SCORE: with two languages none, as one has half at least.

    Where no learning row has a language, none can be told: all documents with a letter stay as they are.
    """
    prepare(spark)
    model = langid.fit(docs, F.coalesce(fold("doc_id", 5) != 0, F.lit(False)))
    if model is None:
        return lettered(docs)
    told = langid.predict(docs, model).filter((F.col("_lang_pred") != langid.UNKNOWN) & (F.col("_score") >= LEAST_LANGUAGE_SCORE))
    return told.withColumn("lang", F.coalesce("lang", "_lang_pred")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others share; `n_chars` is that of the text left."""
    prepare(spark)
    kept = linededup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 80 percent."""
    prepare(spark)
    return jaccard.representatives(docs, size=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with MIX_BUDGET of the tokens, sampled so that these come as close to the target weights as they allow."""
    prepare(spark)
    return mixing.sample(docs, mix_columns(), MIX, rounds=MIX_ROUNDS, budget=MIX_BUDGET)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1,024 tokens, with their ids."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packed", packed),
]
# Language identification and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; a stage's documents go when the next one's are written."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, function in STAGES:
        folder = scratch(spark, name)
        docs = stage(function(spark, docs, sf_dir), folder)
        if before:
            drop_folder(spark, before)
        before = folder
    return docs
