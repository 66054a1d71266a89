"""Seals, rewritten Bronze and versioned Gold."""

import dataclasses
import glob
import time

import pytest
from pyspark.sql import functions as F

from pulselake.config import LakeConfig
from pulselake.operators.refine import refine
from pulselake.plans import silver
from pulselake.plans.gold import run_gold
from pulselake.plans.silver import refine_topic, run_silver
from pulselake.sources import versions
from pulselake.sources.lake import BRONZE, GOLD, SILVER, Lake
from pulselake.sources.schemas import SchemaClash
from pulselake.specs import TOPICS, Metric
from pulselake.streaming.bronze import clear_bronze, compact_bronze, land_batch
from tests.rows import bronze, bronze_row, day

DATES = [f"2021-05-{d:02d}" for d in range(1, 5)]


@pytest.fixture()
def lake(spark, folder):
    return Lake(spark, LakeConfig(f"{folder}/lake"))


def batch_of(lake, rows):
    return bronze(lake.spark, *rows).drop("batch_id", "stream_id")


def land(lake, batch, *rows, stream="s1"):
    land_batch(batch_of(lake, rows), batch, lake.config, stream)


def readings(first, last, date=None):
    return [bronze_row({"bpm": 70}, user=f"u{i}", date=date or DATES[i % 4], stamp=f"{date or DATES[i % 4]}T07:00:00") for i in range(first, last)]


def half_landed(lake, batch, rows, stream="s1"):
    """Files of a batch as a writer leaves them that was stopped ahead of its seal."""
    placed = batch_of(lake, rows).withColumn("stream_id", F.lit(stream)).withColumn("batch_id", F.lit(batch).cast("long"))
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("topic", "event_date", "stream_id", "batch_id").parquet(
        lake.config.layer(BRONZE))


def users(table):
    return sorted(r["user_id"] for r in table.select("user_id").collect())


def test_a_batch_that_lands_during_the_run_is_taken_in_by_the_next(lake, monkeypatch):
    land(lake, 0, *readings(0, 206))
    listed, spec = lake.read_bronze, TOPICS["vitals"]

    def landing_in_between(*args, **kwargs):
        monkeypatch.setattr(lake, "read_bronze", listed)
        before = listed(*args, **kwargs)
        land(lake, 1, *readings(206, 408))
        return before

    monkeypatch.setattr(lake, "read_bronze", landing_in_between)
    assert refine_topic(lake, spec, new_only=True)
    assert lake.require(SILVER, "vitals").count() == 206 and lake.refined_batches("vitals") == {"s1": 0}
    assert refine_topic(lake, spec, new_only=True)
    assert lake.require(SILVER, "vitals").count() == 408 and lake.refined_batches("vitals") == {"s1": 1}


def test_a_batch_that_lands_after_the_seals_were_listed(lake, monkeypatch):
    land(lake, 0, *readings(0, 8))
    listed, spec = lake.newest_batches, TOPICS["vitals"]

    def landing_afterwards(name):
        monkeypatch.setattr(lake, "newest_batches", listed)
        found = listed(name)
        land(lake, 1, *readings(8, 12))
        return found

    monkeypatch.setattr(lake, "newest_batches", landing_afterwards)
    for expected in (8, 12, 12):
        assert refine_topic(lake, spec, new_only=True)
        assert lake.require(SILVER, "vitals").count() == expected


def test_a_half_landed_batch_is_not_seen(lake):
    half_landed(lake, 0, readings(0, 4, DATES[0]))
    assert lake.read_bronze("vitals") is None and not refine_topic(lake, TOPICS["vitals"], new_only=True)
    land(lake, 0, *readings(0, 8))  # the stream replays it from its checkpoint
    assert lake.read_bronze("vitals").count() == 8
    # One date of the next batch is in place, the others are not.
    half_landed(lake, 1, readings(8, 9, DATES[1]))
    assert lake.read_bronze("vitals").count() == 8
    run_silver(lake, new_only=True)
    run_gold(lake)
    assert lake.refined_batches("vitals") == {"s1": 0}
    land(lake, 1, *readings(8, 14))
    run_silver(lake, new_only=True)
    run_gold(lake)
    assert lake.require(SILVER, "vitals").count() == 14 == lake.require(GOLD, "daily_vitals_summary").count()


def test_a_sealed_batch_is_not_written_again(lake):
    land(lake, 0, *readings(0, 8))
    files = sorted(glob.glob(f"{lake.config.layer(BRONZE)}/*/*/*/*/*.parquet"))
    land(lake, 0, *readings(0, 2))
    assert sorted(glob.glob(f"{lake.config.layer(BRONZE)}/*/*/*/*/*.parquet")) == files
    assert {(r["topic"], r["n"]) for r in lake.seals.all().collect()} == {("vitals", 8)}


def test_compaction_leaves_few_files_and_all_rows(lake):
    for batch in range(50):
        land(lake, batch, *readings(4 * batch, 4 * batch + 4), bronze_row({"age": "<30"}, kind="profile", date=None, user=f"u{batch}"))
    before = {name: sorted(map(str, lake.read_bronze(name).collect())) for name in ("vitals", "profile")}
    first = compact_bronze(lake, DATES[3])  # the last date is still open
    assert {name: sorted(map(str, lake.read_bronze(name).collect())) for name in before} == before
    assert clear_bronze(lake) == 3 * 50 + 50
    assert {name: sorted(map(str, lake.read_bronze(name).collect())) for name in before} == before
    for date in DATES[:3]:
        assert len(glob.glob(f"{lake.generations.folder(first)}/topic=vitals/event_date={date}/*.parquet")) <= 2
        assert not glob.glob(f"{lake.config.layer(BRONZE)}/topic=vitals/event_date={date}/*/*/*.parquet")
    # A late row for a rewritten date, and a batch after it.
    land(lake, 50, *readings(900, 901, DATES[0]))
    land(lake, 51, *readings(901, 902, DATES[3]))
    assert lake.read_bronze("vitals").count() == 202 and lake.read_bronze("vitals", after_batch=49).count() == 2
    assert compact_bronze(lake, DATES[2]) is not None  # an earlier date does not reopen later ones
    assert lake.generations.live().cut == DATES[3]
    assert lake.read_bronze("vitals").count() == 202
    assert compact_bronze(lake, DATES[3]) is None
    # A whole one replaces both.
    assert compact_bronze(lake, "2021-06-01", whole=True) is not None and lake.read_bronze("vitals").count() == 202
    assert len(lake.generations.live().names) == 1
    clear_bronze(lake)
    assert lake.read_bronze("vitals").count() == 202 and lake.newest_batches("vitals") == {"s1": 51}
    assert len(glob.glob(f"{lake.seals.path}/*.parquet")) == 1
    assert len(glob.glob(f"{lake.generations.root}/*/topic=vitals/*/*.parquet")) <= 2 * 4
    land(lake, 52, *readings(902, 903), stream="s1")
    assert lake.read_bronze("vitals").count() == 203


def test_compaction_beside_silver_and_gold(lake):
    land(lake, 0, *readings(0, 8))
    run_silver(lake, new_only=True)
    run_gold(lake)
    land(lake, 1, *readings(8, 16))
    half_landed(lake, 2, readings(16, 18))
    compact_bronze(lake, "2021-06-01")
    clear_bronze(lake)
    run_silver(lake, new_only=True)
    run_gold(lake)
    assert lake.require(GOLD, "daily_vitals_summary").count() == 16
    land(lake, 2, *readings(16, 20))
    assert lake.read_bronze("vitals").count() == 20


def test_a_rewrite_without_its_record_changes_nothing(lake, monkeypatch):
    land(lake, 0, *readings(0, 8))
    monkeypatch.setattr(lake.generations, "add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        compact_bronze(lake, "2021-06-01")
    monkeypatch.undo()
    assert lake.read_bronze("vitals").count() == 8 and clear_bronze(lake) == 0
    assert compact_bronze(lake, "2021-06-01") and lake.read_bronze("vitals").count() == 8


def test_dates_that_are_no_dates_are_rewritten_and_cleared(lake):
    land(lake, 0, bronze_row({"bpm": 70}, date="2021:05 %1"), bronze_row({"bpm": 71}, date=None), bronze_row({"bpm": 72}, date="2021-05-09"))
    compact_bronze(lake, "2021-05-09")
    assert clear_bronze(lake) == 1  # only the row without a date lies ahead of the cut
    compact_bronze(lake, "3000-01-01")
    assert clear_bronze(lake) == 2
    assert sorted(str(r["event_date"]) for r in lake.read_bronze("vitals").collect()) == ["2021-05-09", "2021:05 %1", "None"]


def table(spark, *rows):
    return spark.createDataFrame([(u, None if d is None else day(d), n) for u, d, n in rows], "user_id string, event_date date, n int")


def found(lake, name="t"):
    return sorted((r["user_id"], str(r["event_date"]), r["n"]) for r in lake.require(GOLD, name).collect())


def broken(rows):
    """Rows of which the last fails while they are written."""
    return rows.repartition(1).withColumn("n", F.when(F.col("user_id") == "last", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("n")))


def test_a_failed_rebuild_leaves_the_table(spark, lake):
    lake.overwrite(table(spark, ("a", DATES[0], 1), ("b", DATES[1], 2)), GOLD, "t")
    bad = broken(table(spark, *[("x", d, 9) for d in DATES], ("last", DATES[0], 9)))
    for attempt in (lambda: lake.overwrite(bad, GOLD, "t"), lambda: lake.overwrite_dates(bad, "t")):
        with pytest.raises(Exception, match="lost"):
            attempt()
        assert found(lake) == [("a", DATES[0], 1), ("b", DATES[1], 2)]
    with pytest.raises(Exception, match="lost"):
        lake.overwrite(bad, GOLD, "fresh")
    assert lake.read(GOLD, "fresh") is None
    lake.overwrite(table(spark, ("a", DATES[0], 1)), GOLD, "fresh")
    assert lake.require(GOLD, "fresh").count() == 1


def test_dates_are_replaced_at_once(spark, lake, monkeypatch):
    lake.overwrite(table(spark, ("a", DATES[0], 1), ("b", DATES[1], 2), ("c", None, 3)), GOLD, "t")
    lake.overwrite_dates(table(spark, ("d", DATES[1], 4), ("e", DATES[2], 5)), "t")
    lake.overwrite_dates(table(spark, ("f", DATES[2], 6), ("g", None, 7)), "t")
    expected = [("a", DATES[0], 1), ("d", DATES[1], 4), ("f", DATES[2], 6), ("g", "None", 7)]
    assert found(lake) == expected
    lake.overwrite_dates(table(spark), "t")
    assert found(lake) == expected
    monkeypatch.setattr(versions, "_MOST_PARTS", 1)
    lake.overwrite_dates(table(spark, ("h", DATES[3], 8)), "t")
    assert found(lake) == [*expected[:3], ("g", "None", 7), ("h", DATES[3], 8)] and len(lake.gold.live("t")) == 1
    lake.overwrite(table(spark, ("z", DATES[0], 0)), GOLD, "t")
    assert found(lake) == [("z", DATES[0], 0)]
    # The folders of the present and the previous state are there, no others.
    assert len(glob.glob(f"{lake.config.layer(GOLD)}/t*")) == 2


def test_a_new_column_in_some_dates(spark, lake):
    lake.overwrite(table(spark, ("a", DATES[0], 1), ("b", DATES[1], 2)), GOLD, "t")
    lake.overwrite_dates(table(spark, ("c", DATES[1], 3)).withColumn("more", F.lit("x")), "t")
    assert sorted((r["user_id"], r["more"]) for r in lake.require(GOLD, "t").collect()) == [("a", None), ("c", "x")]


def test_a_table_from_before_manifests_is_read(spark, lake):
    table(spark, ("a", DATES[0], 1)).write.partitionBy("event_date").parquet(lake.config.table(GOLD, "t"))
    assert found(lake) == [("a", DATES[0], 1)]
    lake.overwrite_dates(table(spark, ("b", DATES[1], 2)), "t")
    assert found(lake) == [("a", DATES[0], 1), ("b", DATES[1], 2)]


def with_metric(spec, metric):
    return dataclasses.replace(spec, metrics=(*spec.metrics, metric))


@pytest.mark.parametrize("name", sorted(TOPICS))
def test_silver_rows_have_the_declared_schema(spark, name):
    rows = refine(bronze(spark), TOPICS[name])
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in TOPICS[name].silver_schema]


@pytest.mark.parametrize("newer_first", [False, True])
def test_a_metric_that_comes_later(lake, monkeypatch, newer_first):
    old, dates = TOPICS["vitals"], (DATES[1], DATES[0]) if newer_first else (DATES[0], DATES[1])
    land(lake, 0, bronze_row({"bpm": 70, "spin": 3.5}, date=dates[0], stamp=f"{dates[0]}T07:00:00"))
    run_silver(lake, new_only=True)
    run_gold(lake)
    new = with_metric(old, Metric("spin", "whole"))
    monkeypatch.setitem(TOPICS, "vitals", new)
    # Declared with the topic, before anything is written.
    assert [r["spin"] for r in lake.require(SILVER, "vitals").collect()] == [None]
    land(lake, 1, bronze_row({"bpm": 71, "spin": 4.5}, date=dates[1], stamp=f"{dates[1]}T07:00:00"))
    refine_topic(lake, new, new_only=True)
    found = {str(r["event_date"]): (r["bpm"], r["spin"]) for r in lake.require(SILVER, "vitals").collect()}
    assert found == {dates[0]: (70.0, None), dates[1]: (71.0, 4)}
    assert lake.require(SILVER, "vitals").columns[-1] == "event_date" and len(lake.schemas._versions(SILVER, "vitals")) == 2
    # Without the metric in the topic, what is stored stays readable, and so does a run.
    monkeypatch.setitem(TOPICS, "vitals", old)
    land(lake, 2, bronze_row({"bpm": 72}, date=DATES[2], stamp=f"{DATES[2]}T07:00:00"))
    refine_topic(lake, old, new_only=True)
    assert {r["bpm"]: r["spin"] for r in lake.require(SILVER, "vitals").collect()} == {70.0: None, 71.0: 4, 72.0: None}


def test_a_column_of_another_type_is_refused(spark, lake):
    land(lake, 0, bronze_row({"bpm": 70}))
    run_silver(lake)
    rows = lake.require(SILVER, "vitals").withColumn("bpm", F.lit("70"))
    with pytest.raises(SchemaClash, match="bpm"):
        lake.append(rows, SILVER, "vitals")
    with pytest.raises(SchemaClash):
        lake.overwrite_dates(table(spark, ("a", DATES[0], 1)).withColumn("n", F.lit(1.5)), "never") or lake.overwrite_dates(
            table(spark, ("a", DATES[0], 1)), "never")
    assert lake.require(SILVER, "vitals").count() == 1
    # A whole rebuild takes the schema of its rows.
    lake.overwrite(table(spark, ("a", DATES[0], 1)), GOLD, "t")
    lake.overwrite(table(spark, ("a", DATES[0], 1)).withColumn("n", F.lit("x")), GOLD, "t")
    assert found(lake) == [("a", DATES[0], "x")]
    bad = broken(table(spark, ("x", DATES[0], 9), ("last", DATES[1], 9)))
    with pytest.raises(Exception, match="lost"):
        lake.overwrite(bad, GOLD, "t")
    assert found(lake) == [("a", DATES[0], "x")]


def test_a_full_run_refines_only_keys_that_are_not_stored(lake, monkeypatch):
    """All of Bronze is read again; deliveries of stored keys go by their envelope, and the table is that of a first full run."""
    heart = {"kind": "heart_rate_intraday", "source": "2021-05-01T07:00:00.250", "date": DATES[0]}
    first = [*readings(0, 8), *[bronze_row({"bpm": 70}, user=u, **heart) for u in ("h1", "h2")], bronze_row({"bpm": 70}, user="h3", trace="t3", **heart)]
    late = [
        bronze_row({"bpm": 99}, user="u1", date=DATES[1], stamp=f"{DATES[1]}T07:00:00", ingest="2021-05-20T00:00:00"),  # a stored key
        *readings(8, 10), *readings(9, 10),  # new keys, one of them twice
        bronze_row({"bpm": 999}, user="u3", date=DATES[0], stamp=f"{DATES[0]}T07:00:00"),  # a new key out of range
        bronze_row({"bpm": 71}, user=None), bronze_row({"bpm": 71}, stamp=None), bronze_row({"bpm": 71}, stamp="no time"), bronze_row({"bpm": 71}, date=None),
        bronze_row({"bpm": 72}, user="h3", trace="t4", **heart), bronze_row({"bpm": 73}, user="h1", **heart), *first[8:9],
    ]
    land(lake, 0, *first)
    run_silver(lake)
    land(lake, 1, *late)
    given = {}
    monkeypatch.setattr(silver, "refine", lambda rows, spec, **options: given.update({spec.name: rows.count()}) or refine(rows, spec, **options))
    run_silver(lake)
    assert given["vitals"] == 4 and given["heart_rate_intraday"] == 2
    vitals = {(r["user_id"], str(r["event_date"])): r["bpm"] for r in lake.require(SILVER, "vitals").collect()}
    assert lake.require(SILVER, "vitals").count() == 10 and vitals["u1", DATES[1]] == 70.0
    assert sorted((r["user_id"], r["bpm"]) for r in lake.require(SILVER, "heart_rate_intraday").collect()) == [
        ("h1", 70.0), ("h1", 73.0), ("h2", 70.0), ("h3", 70.0), ("h3", 72.0)]
    run_silver(lake)
    assert given["vitals"] == 1 and given["heart_rate_intraday"] == 0  # out of range, so never stored


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n").split("\n")
    return {b for b in blocks if b.startswith("shuffle_")}


def test_shuffle_files_go_with_the_write(spark, lake):
    """Neither landing nor rewriting nor Silver leaves shuffle files to the driver's garbage collection."""
    before = shuffle_blocks(spark)
    land_batch(batch_of(lake, readings(0, 40)), 0, lake.config, "s1", gather=True)
    assert compact_bronze(lake, "2021-06-01") and lake.read_bronze("vitals").count() == 40
    run_silver(lake)
    until = time.time() + 30
    while (left := {b for b in shuffle_blocks(spark) - before if b.endswith(".data")}) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_topics_are_rewritten_one_at_a_time(lake):
    """What a rewrite shuffles at once is one topic's share, and its one record covers all of them."""
    land(lake, 0, *readings(0, 12), *[bronze_row({"age": "<30"}, kind="profile", date=None, user=f"u{i}") for i in range(3)])
    generation = compact_bronze(lake, "2021-06-01")
    assert lake.generations.live().names == (generation,)
    assert len(glob.glob(f"{lake.generations.path}/*.parquet")) == 1
    assert clear_bronze(lake) == 4 + 1
    assert lake.read_bronze("vitals").count() == 12 and lake.read_bronze("profile").count() == 3
