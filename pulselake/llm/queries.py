"""One query per operator over its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm import (
    edit_counts,
    fingerprints,
    language,
    licenses,
    merge_replay,
    mixing,
    packing,
    simhash_trees,
    substrings,
    token_files,
    token_groups,
    turn_repair,
    vector_blocks,
)
from pulselake.sources.workspace import fresh_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a fifth of the ids is held out from learning."""
    docs = _table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = language.fit(docs.where(fold != 0))
    predicted = language.identify(docs, model)
    return predicted.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 20-word windows that occur earlier."""
    kept = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, links at 2 or fewer bits."""
    found = simhash_trees.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_trees.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op4_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of links and component of every vector, links at cosine 0.95 or more."""
    return vector_blocks.near_duplicates(_table(spark, sf_dir, "embeddings"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, weight)`` of labelled documents: 2 for good ones, 0.5 for bad ones."""
    labels = _table(spark, sf_dir, "labels").where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return labels.select("doc_id", F.when(F.col("quality") > 0, 2.0).otherwise(0.5).alias("weight"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150 % of all words takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), quality=quality_weights(spark, sf_dir))
    return mixed.select("doc_id", "size", "source", "source_size", "target", "copies", "taken")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in pieces, in sequences of the permitted lengths."""
    return packing.best_fit(_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; callers can give any other path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def sample_edits() -> Column:
    """Three edits for a document: an overwrite, an insertion and an appended phrase."""
    size = F.coalesce(F.char_length("text"), F.lit(0)).cast("bigint")
    start = F.coalesce(F.substring("text", 1, 24), F.lit(""))
    name = F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    end = F.lit(1 << 60)  # beyond any text
    edits = [(F.floor(size / 4), 24, start), (F.floor(size / 2), 0, name), (end, 0, F.lit(", the end."))]
    return F.array(*(F.struct(s.alias("start"), F.lit(n).cast("bigint").alias("length"), t.alias("insert")) for s, n, t in edits))


def op7_edit_token_counts(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Tokens of every document before and after three edits."""
    docs = _table(spark, sf_dir, "documents")
    return edit_counts.count_edits(docs, sample_edits(), ranks_path or tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Encode all documents, write the ids to the shared folder and read them back."""
    folder = fresh_folder(spark, "tokens")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), folder, path or tokenizer_path("word_bpe_49k.json"), end=2)
    return token_files.digests(spark, folder)


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and how alike they are."""
    return fingerprints.edited_pairs(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in every document: as its entire text and as entire lines."""
    return licenses.scan(_table(spark, sf_dir, "documents")).drop("matches")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least edits and digest of every conversation, after a quarter of the rows was spoilt."""
    return turn_repair.repair(turn_repair.damaged(_table(spark, sf_dir, "conversations")))


def op12_token_groups(spark: SparkSession, sf_dir: str, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document, by the counts of the linked ids in all."""
    docs = _table(spark, sf_dir, "documents")
    return token_groups.summaries(docs, path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model"))


def op13_merge_replay(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Byte-level ids of every document, and the bytes they stand for."""
    path = ranks_path or tokenizer_path("byte_bpe_50k.tiktoken")
    both = merge_replay.encode(_table(spark, sf_dir, "documents"), path, decoded=True)
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_vector_dedup": op4_vector_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_edit_token_counts": op7_edit_token_counts,
    "op8_token_files": op8_token_files,
    "op9_document_fingerprints": op9_document_fingerprints,
    "op10_license_scan": op10_license_scan,
    "op11_turn_repair": op11_turn_repair,
    "op12_token_groups": op12_token_groups,
    "op13_merge_replay": op13_merge_replay,
}
