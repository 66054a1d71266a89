"""Document fingerprints: SimHash of weighted terms, and search by block tables.

The terms of a text are its three-word sequences (a shorter text is one term,
a text without words has none and fingerprint zero). Each term's hash votes on
64 bits, +w for a one and -w for a zero, where the weight ``w`` is the number
of code points of the term, so common short words count for little; repeats
vote again. Two votes are summed in one bigint, in lanes of 32 bits.

Neighbours: the 64 bits are cut into blocks; for every choice of ``blocks -
radius`` of them there is a table keyed by these bits, the permutation that
moves them to the front. Fingerprints within the radius share the key of at
least one table. A row per fingerprint and table meets the (sliced) list of
fingerprints with its key, and neighbours are counted inside the row: rows stay
linear in the input, also in large groups of near copies.

Everything is DataFrame expressions. Defined results: null texts count as
empty. Rows without an id come last in the order of documents; equal ids are
ordered by a hash of the text. After the last document comes the first.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulselake.llm.words import word_array
from pulselake.sources.workspace import settle

_LANES = 32
_MASK = (1 << 32) + 1
_SLICE = 4096


def terms(text: Column) -> Column:
    """Array of ``struct<a, b, c>``: the words of each term, nulls where it is shorter."""
    words = word_array(text)
    three = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))).alias("b"), F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0))).alias("c"))
    return F.slice(three, F.lit(1), F.greatest(F.size(words) - 2, F.least(F.size(words), F.lit(1))))


def votes(hash_: Column, weight: Column) -> list[Column]:
    """Sums of the weights of set bits: lane ``i`` holds bits ``i`` and ``i + 32``."""
    return [F.sum(F.shiftright(hash_, i).bitwiseAND(F.lit(_MASK)) * weight).alias(f"v{i}") for i in range(_LANES)]


def from_votes(total: Column) -> Column:
    """The fingerprint: a bit is one if it got over half of the weight ``total``."""
    value = F.lit(0).cast("bigint")
    for i in range(_LANES):
        low, high = F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(F.col(f"v{i}"), 32)
        value = value.bitwiseOR(F.when(low * 2 > total, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
        bit = 1 << (i + 32)
        value = value.bitwiseOR(F.when(high * 2 > total, F.lit(bit if bit < 1 << 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint"))
    return value


def likeness(left: Column, right: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(left.bitwiseXOR(right)) / F.lit(64.0)


def with_next(docs: DataFrame, id_column: str, text_column: str, share: int = 4) -> DataFrame:
    """One row per document: okey, tie, doc_id, repeats, n_chars, text, next_okey, next_tie, prefix.

    ``prefix`` is the beginning of the next document, a ``share``-th of this
    one's length. Rows that agree in id and text are one document here.
    """
    ident, body = F.col(id_column).cast("bigint"), F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.coalesce(ident, F.lit(2**63 - 1)).alias("okey"), F.xxhash64(body).alias("tie"), ident.alias("doc_id"), body.alias("text"))
    keys = rows.groupBy("okey", "tie", "doc_id").agg(F.count(F.lit(1)).alias("repeats"), F.max(F.char_length("text").cast("bigint")).alias("n_chars"))
    # Written once, so that every use sees the same ranges.
    keys = settle(keys.repartitionByRange("okey", "tie").withColumn("part", F.spark_partition_id()))
    ahead = Window.partitionBy("part").orderBy("okey", "tie")
    # One row per range partition, however many documents.
    starts = keys.groupBy("part").agg(F.min(F.struct("okey", "tie")).alias("start"))
    of_parts = Window.partitionBy(F.lit(1)).orderBy("part")
    starts = starts.select("part", F.coalesce(F.lead("start").over(of_parts), F.first("start").over(of_parts)).alias("after"))
    follows = keys.withColumn("then", F.lead(F.struct("okey", "tie")).over(ahead)).join(starts, "part")
    follows = follows.withColumn("then", F.coalesce("then", "after")).select(
        "okey", "tie", "doc_id", "repeats", "n_chars", F.col("then.okey").alias("next_okey"), F.col("then.tie").alias("next_tie")
    )
    one = Window.partitionBy("okey", "tie").orderBy(F.lit(1))
    # Both joins below read this one placement of the texts.
    texts = rows.select("okey", "tie", "text").withColumn("n", F.row_number().over(one)).where("n = 1").drop("n")
    asked = follows.select(
        F.col("next_okey").alias("okey"), F.col("next_tie").alias("tie"), F.col("okey").alias("of_okey"), F.col("tie").alias("of_tie"),
        F.floor(F.col("n_chars") / share).cast("int").alias("length"),
    )
    given = texts.join(asked.hint("merge"), ["okey", "tie"]).select(
        F.col("of_okey").alias("okey"), F.col("of_tie").alias("tie"), F.substring("text", F.lit(1), F.col("length")).alias("prefix")
    )
    return texts.join(follows.hint("merge"), ["okey", "tie"]).join(given.hint("merge"), ["okey", "tie"])


def fingerprints(texts: DataFrame, key_columns: list[str], kinds: dict[str, Column]) -> DataFrame:
    """``key_columns``, kind, fp: the fingerprint of each named text of each row.

    Rows are grouped by the key columns; where the input is already placed by
    some of them, nothing is shuffled.
    """
    variants = F.array(*(F.struct(F.lit(k).alias("kind"), terms(text).alias("terms")) for k, text in kinds.items()))
    split = texts.select(*key_columns, F.explode(variants).alias("v")).select(*key_columns, "v.kind", F.explode_outer("v.terms").alias("t"))
    length = [F.coalesce(F.char_length(f"t.{c}"), F.lit(0)) for c in "abc"]
    voted = split.select(
        *key_columns, "kind", F.xxhash64("t.a", "t.b", "t.c").alias("h"), (length[0] + length[1] + length[2]).cast("bigint").alias("w")
    )
    summed = voted.groupBy(*key_columns, "kind").agg(F.sum("w").alias("total"), *votes(F.col("h"), F.col("w")))
    return summed.select(*key_columns, "kind", from_votes(F.col("total")).alias("fp"))


def _tables(radius: int, blocks: int) -> list[int]:
    """Masks of the key bits of each permuted table, as signed 64-bit numbers."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(parts, blocks - radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def neighbour_counts(prints: DataFrame, radius: int = 3, blocks: int = 5) -> DataFrame:
    """``(fp, n)`` per distinct fingerprint with neighbours: rows of other fingerprints within the radius.

    ``prints`` has a column ``fp`` (bigint, not null), one row per document.
    """
    masks = _tables(radius, blocks)
    classes = settle(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("rows")))
    tables = F.array(*(F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)))
    placed = classes.select("fp", "rows", F.explode(tables).alias("k")).select("fp", "rows", "k.table", "k.key")
    sizes = placed.groupBy("table", "key").count().where("count > 1")
    placed = placed.join(sizes, ["table", "key"]).withColumn("parts", F.ceil(F.col("count") / F.lit(_SLICE)))
    lists = placed.groupBy("table", "key", F.pmod(F.xxhash64("fp"), F.col("parts")).alias("part")).agg(
        F.collect_list(F.struct("fp", "rows")).alias("others")
    )
    asked = placed.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    met = asked.select("fp", "table", "key", "part").join(lists, ["table", "key", "part"])
    earlier = F.slice(F.array(*(F.lit(m) for m in masks)), F.lit(1), F.col("table"))

    def counted(total: Column, other: Column) -> Column:
        apart = other["fp"].bitwiseXOR(F.col("fp"))
        near = (apart != 0) & (F.bit_count(apart) <= radius)
        # A pair that several tables hold counts in the first of them.
        return F.when(near & F.forall(earlier, lambda m: apart.bitwiseAND(m) != 0), total + other["rows"]).otherwise(total)

    found = met.select("fp", F.aggregate("others", F.lit(0).cast("bigint"), counted).alias("n"))
    return found.groupBy("fp").agg(F.sum("n").alias("n")).where("n > 0")


def edited_pairs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", radius: int = 3, share: int = 4) -> DataFrame:
    """Fingerprints of every document, its edited text and its neighbours.

    The edited text has its last ``1 / share`` replaced by the beginning of the
    next document. Columns: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next and n_near, the number of other
    rows whose fingerprint is within ``radius`` bits.
    """
    rows = with_next(docs, id_column, text_column, share)
    keep = (F.col("n_chars") - F.floor(F.col("n_chars") / share)).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), keep), F.col("prefix"))
    keys = ["okey", "tie", "doc_id", "repeats", "n_chars", "next_okey", "next_tie", "edited_sha256"]
    rows = rows.withColumn("edited", edited).withColumn("edited_sha256", F.sha2("edited", 256))
    both = fingerprints(rows, keys, {"text": F.col("text"), "edited": F.col("edited")})
    both = both.groupBy(*keys).agg(F.max(F.when(F.col("kind") == "text", F.col("fp"))).alias("fp"), F.max(F.when(F.col("kind") == "edited", F.col("fp"))).alias("edited_fp"))
    both = settle(both)
    following = both.select(F.col("okey").alias("next_okey"), F.col("tie").alias("next_tie"), F.col("fp").alias("next_fp"))
    each = both.join(following, ["next_okey", "next_tie"]).withColumn("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))))
    near = neighbour_counts(each.select("fp"), radius)
    same = each.groupBy("fp").agg(F.count(F.lit(1)).alias("alike"))
    counts = same.join(near, "fp", "left").select("fp", (F.col("alike") - 1 + F.coalesce("n", F.lit(0))).alias("n_near"))
    each = each.join(counts, "fp")

    def text_of(value: str) -> Column:
        return F.lpad(F.lower(F.hex(value)), 16, "0")

    return each.select(
        "doc_id", "n_chars", "edited_sha256", text_of("fp").alias("fingerprint"), text_of("edited_fp").alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_near",
    )
