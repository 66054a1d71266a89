"""Files and folders of whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _located(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing there is no error."""
    system, place = _located(spark, path)
    system.delete(place, True)


def delete_reported(spark: SparkSession, uri: str) -> None:
    """The same for a file or folder as Spark reports it in ``_metadata``, escaped."""
    delete(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, place = _located(spark, folder)
    return [status.getPath().getName() for status in system.listStatus(place)] if system.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _located(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, which appears when it is complete; an error if there is one of this name."""
    system, place = _located(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_draft-{place.getName()}")
    stream = system.create(draft, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, True)
        raise FileExistsError(path)
