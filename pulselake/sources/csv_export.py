"""Device exports in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_export(spark: SparkSession, path: str, *, multiline: bool = False) -> DataFrame:
    """All columns as text, named by the header.

    Quotes are doubled inside quoted cells. Files of one path must agree on
    their header; a differing one fails instead of shifting columns. A cell
    with a line break needs ``multiline``, which gives up splitting files.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multiline)
        .csv(path)
    )
