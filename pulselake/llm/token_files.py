"""Token ids as Parquet list columns, for selective reads.

Each file row is a document: doc_id, n_tokens, ids (list of integers) and the
range partition it was written in. Files are in ascending order of ids of
documents, within and across. Ids are dictionary encoded: a page holds indexes
as wide as the vocabulary needs, and the dictionary is set large enough for
one; ``encoding="delta"`` writes delta-packed integers instead. Row groups and
pages have set sizes, and Parquet's column and offset indexes let a reader with
a predicate on doc_id skip row groups and pages; metadata reads leave the ids
alone.

Spark's committer writes the files, so lost executors leave no partial output.

Defined results: null and empty texts are documents of the end id alone; rows
without an id come last, equal ids in the order of a hash of their text, and
repeated rows side by side. Other columns are never looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulselake.llm.tokens import word_tokenizer

_BYTES = 4_000_000  # of text per Arrow batch of ids, unless one text has more


def _slices(batch: pa.RecordBatch):
    """Runs of rows of a batch by the bytes of their texts."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // _BYTES)) + 1
    for first, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
        yield batch.slice(first, end - first)


def _encoder(path: str, end: int):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("part", pa.int32())])
    last = np.array([end], "<u4")

    def encode(batches):
        tokenizer = word_tokenizer(path)
        for batch in batches:
            for rows in _slices(batch):
                found, ends = tokenizer.ids_of(rows["text"])
                counts = np.diff(ends, prepend=0) + 1
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.insert(found, ends, last).view(np.int32)))
                yield pa.RecordBatch.from_arrays([rows["doc_id"], rows["tie"], pa.array(counts), ids, rows["part"]], schema=schema)

    return encode


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20,
    page_rows: int = 2000,
) -> None:
    """Encode all documents and write them to ``folder``, ascending by id."""
    ident, text = F.col(id_column).cast("bigint"), F.col(text_column)
    rows = docs.select(ident.alias("doc_id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]
    # A reader takes parts in the order of their numbers, which is that of the ids.
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    encoded = placed.mapInArrow(_encoder(tokenizer_path, end), "doc_id long, tie long, n_tokens long, ids array<int>, part int")
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    by_dictionary = encoding == "dictionary"
    (
        encoded.write.option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.enable.dictionary", str(by_dictionary).lower())
        .option("parquet.dictionary.page.size", 4 << 20)
        # Version 2 pages encode integers as deltas where there is no dictionary.
        .option("parquet.writer.version", "v1" if by_dictionary else "v2")
        .parquet(folder)
    )


def read_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, tie, part, n_tokens`` without reading any ids."""
    return spark.read.parquet(folder).select("doc_id", "tie", "part", "n_tokens")


def read_tokens(spark: SparkSession, folder: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """``doc_id, ids`` of the documents from ``low`` to ``high``, by row-group and page skipping."""
    rows = spark.read.parquet(folder)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows.select("doc_id", "ids")


def _checksums(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    for batch in batches:
        ids = batch["ids"]
        values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        offsets = ids.offsets.to_numpy()
        crc = [zlib.crc32(values[a:b].data) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tie"], batch["part"], pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], schema=schema)


def digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    rows = spark.read.parquet(folder).select("doc_id", "tie", "part", "ids")
    found = rows.mapInArrow(_checksums, "doc_id long, tie long, part int, n_tokens long, ids_crc32 long")
    # One row per written part: their running sum is small.
    parts = read_metadata(spark, folder).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy(F.lit(1)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_last(), "tie").rowsBetween(Window.unboundedPreceding, -1)
    return found.join(parts, "part").select(
        "doc_id", (F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("start"), "n_tokens", "ids_crc32"
    )
