"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws a key ``-ln(u) / w``, with ``u`` from a hash of seed and
id and ``w`` its quality weight. A target of ``e`` epochs and a fraction takes
every document of the source ``floor(e)`` times and then, in the order of the
keys, documents once more until the running sum of sizes meets the rest of the
target: the document at the border is taken if that comes closer.

Running sums within a source are made in two levels, so that a source of any
size is spread over tasks: documents fall into key ranges by ``1 - exp(-key)``,
which is near uniform; sums of whole ranges come first, then those within.

Defined results: a null source is a source of its own, last in the order; null
and empty texts have size 0 and are taken with the complete epochs only;
weights that are null, not positive or not finite count as 1. Rows without an
id draw by their text. Equal keys are ordered by id and size; repeated rows
share a key and are interchangeable. Other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.words import word_count
from pulselake.sources.workspace import settle

WEIGHTS = (5.0, 2.0, 1.0)
_RANGE_ROWS = 20_000


def exponential(ident: Column, text: Column, seed: int) -> Column:
    """Exponential draw of rate 1, fixed by seed and id (by the text where there is no id)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double")
    return -F.ln((digits + 0.5) / float(16**13))


def targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size, target)`` from one row per source.

    Targets are ``weight x level``, but at most ``most`` times the source. The
    level follows from the sources in the order of the level at which each
    reaches its limit: it is the first that leaves the next source below.
    There is one row per source here, so the windows are over sources only.
    """
    named = Window.orderBy(F.col("source").isNull(), "source")
    kind = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (kind + 1).cast("int"))
    listed = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most)
    listed = listed.withColumn("full_at", F.col("limit") / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    listed = listed.withColumn("level", level)
    first = F.first(F.when(F.col("level") <= F.col("full_at"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return listed.select(
        "source", "source_size", F.least(F.col("limit"), F.col("weight") * F.coalesce(first, F.lit(float("inf")))).alias("target")
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    quality: DataFrame | None = None,
    share: float = 1.5,
    most: float = 2.0,
    weights: tuple[float, ...] = WEIGHTS,
    seed: int = 7,
) -> DataFrame:
    """Per row: doc_id, tie (a hash of the text), source, size, source_size, target, copies, taken.

    ``quality`` has one row ``(id, weight)`` per id that does not weigh 1. It
    meets sizes and draws only, so texts are never shuffled.
    """
    text, ident = F.col(text_column), F.col(id_column)
    sized = docs.select(
        ident.alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(source_column).alias("source"), word_count(text).alias("size"),
        exponential(ident, text, seed).alias("key"),
    )
    if quality is not None:
        rated = quality.toDF("rated_id", "weight").where("weight > 0 AND weight < double('inf')")
        sized = sized.join(rated, F.col("doc_id") == F.col("rated_id"), "left")
        sized = sized.withColumn("key", F.col("key") / F.coalesce("weight", F.lit(1.0))).drop("rated_id", "weight")
    sized = settle(sized)
    count = sized.count()
    ranges = max(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // _RANGE_ROWS)
    sized = sized.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges))
    # One row per source and key range, whatever the number of documents.
    totals = sized.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    per_source = totals.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    aims = targets(per_source, share, most, weights)
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"))
    offsets = offsets.alias("o").join(aims.alias("a"), F.col("o.source").eqNullSafe(F.col("a.source"))).select(
        F.col("o.source").alias("of_source"), F.col("range").alias("of_range"), "offset", "source_size", "target"
    )
    placed = sized.join(offsets, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("range") == F.col("of_range")))
    inside = Window.partitionBy("source", "range").orderBy("key", "doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("ahead") + F.col("size") / 2 <= F.col("rest"))
    return (
        placed.withColumn("ahead", ahead).withColumn("epochs", epochs).withColumn("rest", rest)
        .withColumn("copies", (F.col("epochs") + more.cast("int")).cast("int"))
        .select("doc_id", "tie", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def sampled(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``mix`` takes it."""
    same = Window.partitionBy("k1", "k2")
    ident = F.col(id_column)
    chosen = mix(docs, id_column, text_column, **options).where("copies > 0").select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("k1"), F.col("tie").alias("k2"), "copies"
    )
    chosen = chosen.withColumn("m", F.row_number().over(same.orderBy(F.desc("copies"))))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(ident.cast("bigint"), F.lit(0)).alias("k1"), F.xxhash64(text_column).alias("k2"))
    rows = rows.withColumn("n", F.row_number().over(same.orderBy("k1")))
    # Repeated rows pair off by number; as a range, so that placement by the keys serves windows and join.
    taken = rows.join(chosen, ["k1", "k2"]).where("n <= m AND n >= m")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
