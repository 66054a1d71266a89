"""A training corpus from raw documents, in stages that are each written and reread.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return the columns
of the documents they are given; the last returns one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import language, mixing, near_copies, packing, substrings
from pulselake.llm.queries import quality_weights
from pulselake.sources.files import delete
from pulselake.sources.workspace import fresh_folder, scratch, settle

#: Languages whose share of the evidence is below this leave a document undetermined.
LEAST_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language.

    Rejected are null texts, texts without letters and undetermined ones. If
    nothing is labelled, every text with letters stays.
    """
    model = language.fit(docs)
    if not model.languages:
        return docs.where(F.rlike("text", F.lit(r"\p{L}")))
    found = docs.select(F.struct("*").alias("row"), language.prediction(docs, model).alias("found"))
    return found.where((F.col("found.lang") != language.UNKNOWN) & (F.col("found.score") >= LEAST_SCORE)).select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group that is alike in 0.8 of its shingles of five words, the one with the smallest id."""
    return near_copies.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take repeated passages out, leaving the white space of the rest; documents left without a word go."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = substrings.remove_repeats(docs, carry=others, cut=True).where("n_removed = 0 OR n_removed < n_words")
    columns = {c: F.col("rest").getField(c) for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("cut_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") == 0, columns["n_chars"]).otherwise(F.char_length("cut_text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*(columns[c].alias(c) for c in docs.columns))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it; documents not taken go."""
    return mixing.sampled(docs, quality=quality_weights(spark, sf_dir))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the corpus into sequences of the permitted lengths."""
    return packing.best_fit(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents table.

    What a stage settles goes when its result is written; results stay until
    the next stage has read them.
    """
    docs, earlier = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = fresh_folder(spark, name)
        with scratch(spark):
            docs = settle(stage(spark, docs, sf_dir), folder)
        if earlier is not None:
            delete(spark, earlier)
        earlier = folder
    return docs
