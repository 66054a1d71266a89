import pytest

from pulselake.__main__ import main
from pulselake.config import LakeConfig
from pulselake.sources.lake import GOLD, Lake
from tests.rows import day, one

HOURLY = "id,date,hour,bpm,steps,activityType,step_goal\nu1,2021-05-24,7.0,72.5,100,Walk,100\nu1,2021-05-24,8.0,80,1,Run,100\n"
DAILY = "id,date,minutesAsleep,spo2\nu1,2021-05-24,400,97\n"


def test_jobs_from_csv_to_gold(spark, folder):
    lake = Lake(spark, LakeConfig(f"{folder}/lake"))
    for kind, text in (("hourly", HOURLY), ("daily", DAILY)):
        with open(f"{folder}/{kind}.csv", "w", encoding="utf-8") as out:
            out.write(text)
        main(["ingest", kind, f"{folder}/{kind}.csv"], lake)
    main(["bronze", "--drain"], lake)
    assert set(main(["silver"], lake)) == {
        "vitals", "activity", "context", "profile", "sleep", "hrv_summary", "breathing_summary", "vitals_daily"}
    built = main(["gold"], lake)
    assert "daily_wellness_profile" in built and "daily_intraday_summary" not in built
    row = one(lake.require(GOLD, "daily_wellness_profile"))
    assert (row["user_id"], row["event_date"]) == ("u1", day("2021-05-24"))
    assert (row["avg_bpm"], row["total_steps"], row["goal_met_steps"], row["avg_spo2"]) == (76.25, 101, True, 97.0)
    assert row["intraday_avg_bpm"] is None
    main(["gold", "--strict-schema"], lake)
    assert "intraday_avg_bpm" not in lake.require(GOLD, "daily_wellness_profile").columns
    report = main(["run", "--append-only-intraday"], lake)
    assert "windows" in report["insights_skipped"]
    found = {r["table_name"]: r["n"] for r in main(["presence", "silver"], lake)}
    assert found["vitals"] == 2 and found["profile"] == 1 and found["hrv_intraday"] is None


def test_config_from_environment():
    config = LakeConfig.from_env({"PULSELAKE_ROOT": "/data/", "PULSELAKE_JDBC_URL": "jdbc:x", "PULSELAKE_JDBC_USER": "u",
                                  "PULSELAKE_JDBC_STRINGTYPE": "unspecified"})
    assert config.table("gold", "t") == "/data/gold/t"
    assert config.jdbc_properties == {"user": "u", "stringtype": "unspecified"} and config.kafka_servers is None
    with pytest.raises(KeyError):
        LakeConfig.from_env({})
