from pulselake.specs import DAILY_TOPICS, HOURLY_TOPICS, PROFILE
from tests.compare import SF_DIR
from workload import device, queries


def test_events_of_one_row_group_reach_all_cores(spark):
    """Documents are made by more tasks than the file has row groups, and no row is lost."""
    plain, dealt = device.table(spark, SF_DIR, "events"), device._events(spark, SF_DIR)
    sizes = dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(n > 0 for n in sizes) >= spark.sparkContext.defaultParallelism
    assert sum(sizes) == plain.count()
    assert plain.exceptAll(dealt.select(plain.columns)).isEmpty()


def _optimized(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_what_documents_share_is_written_once_a_row(spark):
    """Times in text are made below the generator that makes a row's documents, not in each of them."""
    for sent in (device.all_transport(spark, SF_DIR), device.intraday_transport(spark, SF_DIR)):
        generators = [line for line in _optimized(sent).splitlines() if "Generate explode(array(" in line]
        assert generators
        assert not any("format_string" in line or "date_format" in line for line in generators)


def test_event_json_is_read_ahead_of_the_dealing(spark):
    plan = _optimized(device._events(spark, SF_DIR).select("k"))
    assert plan.index("RepartitionByExpression") < plan.index("get_json_object")


def test_export_payloads_are_parsed_once_ahead_of_the_grouping(spark):
    """The aggregation of ``csv_hourly_events`` reads cells, so its sort carries no payload."""
    plan = _optimized(queries.csv_hourly_events(spark, SF_DIR))
    assert "get_json_object" not in plan
    assert "payload" not in plan.split("Aggregate", 1)[1].splitlines()[0]


def test_both_exports_bring_all_rows_and_all_topics(spark, folder):
    """``csv_all_metrics`` sees every event, and the profiles that both exports send once for each user."""
    moments = "timestamp '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(id AS int))"
    made = spark.range(40).selectExpr("id AS event_id", f"{moments} AS ts", "id % 4 AS user_id", "'view' AS event_type", "20D AS value",
                                      "'{\"k\": ' || (id + 1) || '}' AS props")
    made.coalesce(1).write.parquet(f"{folder}/events.parquet")
    found = {}
    for r in queries.csv_all_metrics(spark, folder).collect():
        found.setdefault((r["topic"], r["metric"]), []).append((r["known"], r["total"]))
    assert {topic for topic, _ in found} == {spec.name for spec in [*HOURLY_TOPICS, *DAILY_TOPICS]}
    assert found["vitals", "temperature"] == [(40, 400.0)] and found["sleep", "sleep_rem_ratio"] == [(40, round(40 * 20 / 1024, 3))]
    assert sorted(found["profile", "gender"]) == [(0, 0.0), (4, 2 * len("MALE") + 2 * len("FEMALE"))]
    # First rows have k 1 to 4: the age is missing where it is 2.
    assert sorted(found["profile", "age"]) == [(0, 0.0), (3, len(">=30") + len("<30") + len(">=30"))]
    assert all(len(found["profile", m.silver]) == 2 for m in PROFILE.metrics)
