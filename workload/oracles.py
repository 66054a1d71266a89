"""SQL with the same results as the registered queries, for DuckDB.

Written against the driver's tables directly, without the JSON hop. Every
statement is assembled from the same few common table expressions.
"""

from __future__ import annotations

# The device exports as typed columns.
BASE = """
base AS (
  SELECT event_id, ts, value AS v, user_id AS uid, CAST(user_id AS VARCHAR) AS user_id,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour,
         date_trunc('hour', ts) AS hour_ts, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS day_ts,
         ts AS kafka_ingest_time
  FROM events
)"""

_HOUR = "user_id, kafka_ingest_time, event_date, event_hour, hour_ts AS event_timestamp"
_DAY = "user_id, kafka_ingest_time, event_date, 0 AS event_hour, day_ts AS event_timestamp"
_READ = ("user_id, ts + to_microseconds(k * 10000) AS kafka_ingest_time, event_date, event_hour, "
         "date_trunc('second', ts) AS event_timestamp, lpad(CAST(event_id AS VARCHAR), 32, '0') AS trace_id")

_PLACES = ("loc_entertainment", "loc_gym", "loc_home", "loc_home_office", "loc_other", "loc_outdoors",
           "loc_transit", "loc_work_school")

# Parsed rows of each topic and its validity rule.
PARSED = {
    "vitals": (f"""
  SELECT {_HOUR}, 'vitals' AS event_type,
         CASE WHEN k % 10 <> 0 THEN CAST(40 + 2 * k AS FLOAT) END AS bpm,
         CAST(v - 10 AS FLOAT) AS temperature, CAST(v AS FLOAT) AS scl_avg FROM base""",
               "coalesce(bpm BETWEEN 30 AND 220, true) AND coalesce(scl_avg BETWEEN 0 AND 30, true)"),
    "activity": (f"""
  SELECT {_HOUR}, 'activity' AS event_type,
         CAST(10 * v - 5 AS FLOAT) AS calories, CAST(v AS FLOAT) AS distance, 350 * k AS steps,
         CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'Bike' WHEN k % 4 = 1 THEN 'Run'
              WHEN k % 4 = 2 THEN 'Sport' ELSE 'Walk' END AS activity_type,
         k % 60 AS minutes_zone_1, CASE WHEN k % 6 <> 0 THEN k % 30 END AS minutes_zone_2,
         k % 15 AS minutes_zone_3, 60 - k % 60 AS minutes_below_zone_1 FROM base""",
                 "calories >= 0 AND distance >= 0 AND steps BETWEEN 0 AND 30000"),
    "context": (f"""
  SELECT {_HOUR}, 'context' AS event_type, k % 9 = 0 AS mindfulness_session,
         k % 2 = 0 AS alert, k % 3 = 0 AS happy, k % 5 = 0 AS neutral, k % 4 = 1 AS rested_relaxed,
         CASE WHEN k % 11 <> 0 THEN k % 3 = 0 END AS sad, k % 7 = 2 AS tense_anxious, k % 2 = 1 AS tired,
         {", ".join(f"k % 8 = {i} AS {p}" for i, p in enumerate(_PLACES))} FROM base""", "true"),
    "sleep": (f"""
  SELECT {_DAY}, 'sleep' AS event_type,
         CAST(k * 360000.0 AS FLOAT) AS sleep_duration_ms, CAST(k % 20 AS FLOAT) AS minutes_to_fall_asleep,
         CASE WHEN k % 3 <> 0 THEN CAST(4 * k - 8 AS FLOAT) END AS minutes_asleep,
         CAST(k % 45 AS FLOAT) AS minutes_awake, CAST(k % 5 AS FLOAT) AS minutes_after_wakeup,
         CAST(k + 5 AS FLOAT) AS sleep_efficiency, CAST(k / 128.0 AS FLOAT) AS sleep_deep_ratio,
         CAST((k % 10) / 64.0 AS FLOAT) AS sleep_wake_ratio, CAST((k % 50) / 64.0 AS FLOAT) AS sleep_light_ratio,
         CAST(v / 1024.0 AS FLOAT) AS sleep_rem_ratio FROM base""",
              "coalesce(sleep_efficiency BETWEEN 0 AND 100, true) AND coalesce(minutes_asleep >= 0, true)"),
    "hrv_summary": (f"""
  SELECT {_DAY}, 'hrv_summary' AS event_type, CAST(60 + k AS FLOAT) AS nremhr,
         CASE WHEN k % 13 <> 0 THEN CAST(k * 3.25 AS FLOAT) END AS rmssd FROM base""",
                    "nremhr BETWEEN 30 AND 150 AND coalesce(rmssd BETWEEN 0 AND 300, true)"),
    "breathing_summary": (f"""
  SELECT {_DAY}, 'breathing_summary' AS event_type, CAST(4 + k * 0.375 AS FLOAT) AS breathing_rate FROM base""",
                          "breathing_rate BETWEEN 5 AND 40"),
    "vitals_daily": (f"""
  SELECT {_DAY}, 'vitals_daily' AS event_type,
         CASE WHEN uid % 10 <> 9 THEN CAST(69 + k * 0.3125 AS FLOAT) END AS spo2,
         CASE WHEN k % 4 <> 0 THEN CAST(k + 5 AS FLOAT) END AS stress_score,
         CASE WHEN k % 5 <> 0 THEN CAST(28 + k * 1.25 AS FLOAT) END AS resting_hr,
         CAST(20 + k * 0.25 AS FLOAT) AS vo2max, CAST(v / 16.0 AS FLOAT) AS nightly_temperature,
         CAST((k - 50) / 8.0 AS FLOAT) AS daily_temperature_variation,
         CAST(k / 128.0 AS FLOAT) AS sleep_points_pct, CAST((k % 40) / 64.0 AS FLOAT) AS exertion_points_pct,
         CAST((k % 25) / 32.0 AS FLOAT) AS responsiveness_points_pct FROM base""",
                     "coalesce(spo2 BETWEEN 70 AND 100, true) AND coalesce(stress_score BETWEEN 0 AND 100, true) "
                     "AND coalesce(resting_hr BETWEEN 30 AND 150, true)"),
    "heart_rate_intraday": (f"""
  SELECT {_READ}, 'heart_rate_intraday' AS event_type,
         CAST(round(30 + 2 * k + v / 10, 3) AS FLOAT) AS bpm FROM base""",
                            "bpm BETWEEN 30 AND 220"),
    "hrv_intraday": (f"""
  SELECT {_READ}, 'hrv_intraday' AS event_type,
         CAST(round(CAST(k * 3.25 AS DOUBLE), 3) AS FLOAT) AS rmssd FROM base""",
                     "rmssd BETWEEN 0 AND 300"),
    "breathing_intraday": (f"""
  SELECT {_READ}, 'breathing_intraday' AS event_type,
         CAST(round(CAST(4 + k * 0.375 AS DOUBLE), 3) AS FLOAT) AS breaths_per_minute
  FROM base""", "breaths_per_minute BETWEEN 5 AND 40"),
}

PROFILE = """
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, TIMESTAMP '2024-01-01 00:00:00' AS kafka_ingest_time,
         DATE '2024-01-01' AS event_date, 0 AS event_hour, TIMESTAMP '2024-01-01 00:00:00' AS event_timestamp,
         'profile' AS event_type,
         CASE WHEN c_nationkey % 2 = 0 THEN 'LIFETIME_DISTANCE' ELSE 'DAILY_STEPS' END AS badge_type,
         c_mktsegment AS age, CASE WHEN c_custkey % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END AS gender,
         CASE WHEN c_nationkey % 3 = 0 THEN '<19' WHEN c_nationkey % 3 = 2 THEN '<25' END AS bmi,
         CASE WHEN c_custkey % 3 = 0 THEN '>=10'
              WHEN c_custkey % 3 = 1 THEN CAST(1000 + c_nationkey * 1500 AS VARCHAR) END AS step_goal,
         CAST(NULL AS FLOAT) AS min_goal, CAST(NULL AS FLOAT) AS max_goal,
         CASE WHEN c_nationkey % 3 = 0 THEN 'low' WHEN c_nationkey % 3 = 1 THEN 'medium' ELSE 'high' END
           AS step_goal_label
  FROM customer"""

INTRADAY = ("heart_rate_intraday", "hrv_intraday", "breathing_intraday")

# Columns by the way they are made comparable.
MOMENTS = {"kafka_ingest_time", "event_timestamp", "source_timestamp"}
FLAGS = {
    "mindfulness_session", "alert", "happy", "neutral", "rested_relaxed", "sad", "tense_anxious", "tired",
    "goal_met_steps", "table_exists", *_PLACES,
}
WHOLES = {
    "event_hour", "steps", "minutes_zone_1", "minutes_zone_2", "minutes_zone_3", "minutes_below_zone_1", "position",
    "event_id",
}
TEXTS = {
    "user_id", "event_type", "trace_id", "activity_type", "badge_type", "age", "gender", "bmi", "step_goal",
    "step_goal_label", "dominant_activity_type", "dominant_mood", "severity", "topic", "table_name", "mlflow_run_id",
}


def _plain(column: str, whole: set[str]) -> str:
    if column == "event_date":
        return "CAST(event_date AS VARCHAR) AS event_date"
    if column in MOMENTS:
        return f"epoch_us({column}) AS {column}"
    if column in FLAGS:
        return f"CAST({column} AS INTEGER) AS {column}"
    if column in whole:
        return f"CAST({column} AS BIGINT) AS {column}"
    if column in TEXTS:
        return column
    rounded = f"round(CAST({column} AS DOUBLE), 6)"
    return f"CASE WHEN {rounded} = 0 THEN 0.0 ELSE {rounded} END AS {column}"


def plain(columns: list[str], source: str, whole: set[str] = frozenset()) -> str:
    return f"SELECT {', '.join(_plain(c, WHOLES | whole) for c in columns)} FROM {source}"


def parsed_cte(name: str) -> str:
    return f"{name}_parsed AS ({PARSED[name][0]}\n)"


def silver_ctes(*names: str) -> list[str]:
    ctes = [BASE]
    for name in names:
        if name == "profile":
            ctes.append(f"profile AS ({PROFILE}\n)")
            continue
        keys = "user_id, event_timestamp" + (", trace_id" if name in INTRADAY else "")
        ctes.append(parsed_cte(name))
        ctes.append(
            f"{name} AS (SELECT * FROM {name}_parsed WHERE {PARSED[name][1]} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY kafka_ingest_time) = 1)"
        )
    return ctes


def with_(ctes: list[str], final: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n" + final


ENVELOPE = ["user_id", "kafka_ingest_time", "event_date", "event_hour", "event_timestamp", "event_type"]
METRICS = {
    "vitals": ["bpm", "temperature", "scl_avg"],
    "activity": ["calories", "distance", "steps", "activity_type", "minutes_zone_1", "minutes_zone_2",
                 "minutes_zone_3", "minutes_below_zone_1"],
    "context": ["mindfulness_session", "alert", "happy", "neutral", "rested_relaxed", "sad", "tense_anxious",
                "tired", *_PLACES],
    "profile": ["badge_type", "age", "gender", "bmi", "step_goal", "min_goal", "max_goal", "step_goal_label"],
    "sleep": ["sleep_duration_ms", "minutes_to_fall_asleep", "minutes_asleep", "minutes_awake",
              "minutes_after_wakeup", "sleep_efficiency", "sleep_deep_ratio", "sleep_wake_ratio",
              "sleep_light_ratio", "sleep_rem_ratio"],
    "hrv_summary": ["nremhr", "rmssd"],
    "breathing_summary": ["breathing_rate"],
    "vitals_daily": ["spo2", "stress_score", "resting_hr", "vo2max", "nightly_temperature",
                     "daily_temperature_variation", "sleep_points_pct", "exertion_points_pct",
                     "responsiveness_points_pct"],
    "heart_rate_intraday": ["bpm"],
    "hrv_intraday": ["rmssd"],
    "breathing_intraday": ["breaths_per_minute"],
}


def silver_sql(name: str) -> str:
    carried = ["trace_id"] if name in INTRADAY else []
    return with_(silver_ctes(name), plain(ENVELOPE + carried + METRICS[name], name))


# -- Gold --------------------------------------------------------------------

VITALS_DAY = """vitals_day AS (
  SELECT user_id, event_date, avg(bpm) AS avg_bpm, min(bpm) AS min_bpm, max(bpm) AS max_bpm,
         stddev_samp(bpm) AS stddev_bpm, avg(temperature) AS avg_temperature, min(temperature) AS min_temperature,
         max(temperature) AS max_temperature, avg(scl_avg) AS avg_scl, max(scl_avg) AS max_scl,
         count(event_hour) AS vitals_hours_recorded
  FROM vitals GROUP BY user_id, event_date)"""
VITALS_DAY_COLUMNS = ["user_id", "event_date", "avg_bpm", "min_bpm", "max_bpm", "stddev_bpm", "avg_temperature",
                      "min_temperature", "max_temperature", "avg_scl", "max_scl", "vitals_hours_recorded"]

MODE = """type_counts AS (
  SELECT user_id, event_date, activity_type, count(*) AS n FROM activity
  WHERE activity_type IS NOT NULL GROUP BY user_id, event_date, activity_type),
mode_type AS (
  SELECT user_id, event_date, activity_type AS dominant_activity_type FROM type_counts
  QUALIFY row_number() OVER (PARTITION BY user_id, event_date ORDER BY n DESC, activity_type) = 1)"""

ACTIVITY_DAY = MODE + """,
activity_sums AS (
  SELECT user_id, event_date, sum(steps) AS total_steps, sum(calories::DOUBLE) AS total_calories,
         sum(distance::DOUBLE) AS total_distance_m, sum(minutes_zone_1) AS total_minutes_zone_1,
         sum(minutes_zone_2) AS total_minutes_zone_2, sum(minutes_zone_3) AS total_minutes_zone_3,
         sum(minutes_below_zone_1) AS total_minutes_below_zone_1, count(event_hour) AS activity_hours_recorded
  FROM activity GROUP BY user_id, event_date),
goals AS (SELECT user_id, TRY_CAST(step_goal AS FLOAT) AS goal FROM profile
          WHERE TRY_CAST(step_goal AS FLOAT) IS NOT NULL),
activity_day AS (
  SELECT s.*, coalesce(total_minutes_zone_1, 0) + coalesce(total_minutes_zone_2, 0)
              + coalesce(total_minutes_zone_3, 0) AS total_active_minutes,
         m.dominant_activity_type, CASE WHEN g.goal IS NOT NULL THEN s.total_steps >= g.goal END AS goal_met_steps
  FROM activity_sums s LEFT JOIN mode_type m USING (user_id, event_date) LEFT JOIN goals g USING (user_id))"""
ACTIVITY_DAY_COLUMNS = ["user_id", "event_date", "total_steps", "total_calories", "total_distance_m",
                        "total_minutes_zone_1", "total_minutes_zone_2", "total_minutes_zone_3",
                        "total_minutes_below_zone_1", "activity_hours_recorded", "total_active_minutes",
                        "dominant_activity_type", "goal_met_steps"]

_MOODS = ["alert", "happy", "neutral", "rested_relaxed", "sad", "tense_anxious", "tired"]
_DAY_PLACES = ["loc_gym", "loc_home", "loc_work_school", "loc_outdoors", "loc_transit"]
_HOURS = [f"hours_{c}" for c in _MOODS + _DAY_PLACES]
CONTEXT_DAY = f"""context_sums AS (
  SELECT user_id, event_date, {", ".join(f"sum({c}::INT) AS hours_{c}" for c in _MOODS + _DAY_PLACES)},
         sum(mindfulness_session::INT) AS mindfulness_sessions, count(event_hour) AS sema_readings_count
  FROM context GROUP BY user_id, event_date),
context_top AS (
  SELECT *, greatest({", ".join(f"coalesce(hours_{m}, 0)" for m in _MOODS)}) AS top FROM context_sums),
context_day AS (
  SELECT * EXCLUDE (top), CASE WHEN top = 0 THEN NULL
    {" ".join(f"WHEN hours_{m} = top THEN '{m}'" for m in _MOODS)} END AS dominant_mood FROM context_top)"""
CONTEXT_DAY_COLUMNS = ["user_id", "event_date", *_HOURS, "mindfulness_sessions", "sema_readings_count",
                       "dominant_mood"]


def _averages(table: str, names: dict[str, str]) -> str:
    picks = ", ".join(f"avg({source}) AS {alias}" for source, alias in names.items())
    return f"{table}_day AS (SELECT user_id, event_date, {picks} FROM {table} GROUP BY user_id, event_date)"


_SLEEP = {c: f"avg_{c}" for c in ("sleep_duration_ms", "sleep_efficiency", "minutes_asleep", "minutes_awake",
                                  "sleep_deep_ratio", "sleep_rem_ratio", "sleep_light_ratio")}
_VITALS_DAILY = {**{c: f"avg_{c}" for c in ("spo2", "stress_score", "resting_hr", "vo2max", "nightly_temperature")},
                 "daily_temperature_variation": "avg_daily_temp_variation"}
SLEEP_DAY = _averages("sleep", _SLEEP)
VITALS_DAILY_DAY = _averages("vitals_daily", _VITALS_DAILY)

INTRADAY_DAY = """hr_day AS (
  SELECT user_id, event_date, avg(bpm) AS intraday_avg_bpm, min(bpm) AS intraday_min_bpm,
         max(bpm) AS intraday_max_bpm, stddev_samp(bpm) AS intraday_stddev_bpm, count(bpm) AS intraday_hr_readings
  FROM heart_rate_intraday GROUP BY user_id, event_date),
hrv_day AS (
  SELECT user_id, event_date, avg(rmssd) AS intraday_avg_rmssd, min(rmssd) AS intraday_min_rmssd,
         max(rmssd) AS intraday_max_rmssd FROM hrv_intraday GROUP BY user_id, event_date),
br_day AS (
  SELECT user_id, event_date, avg(breaths_per_minute) AS intraday_avg_breathing,
         min(breaths_per_minute) AS intraday_min_breathing, max(breaths_per_minute) AS intraday_max_breathing
  FROM breathing_intraday GROUP BY user_id, event_date),
intraday_keys AS (
  SELECT user_id, event_date FROM hr_day UNION SELECT user_id, event_date FROM hrv_day
  UNION SELECT user_id, event_date FROM br_day),
intraday_day AS (
  SELECT * FROM intraday_keys LEFT JOIN hr_day USING (user_id, event_date)
  LEFT JOIN hrv_day USING (user_id, event_date) LEFT JOIN br_day USING (user_id, event_date))"""
INTRADAY_DAY_COLUMNS = ["user_id", "event_date", "intraday_avg_bpm", "intraday_min_bpm", "intraday_max_bpm",
                        "intraday_stddev_bpm", "intraday_hr_readings", "intraday_avg_rmssd", "intraday_min_rmssd",
                        "intraday_max_rmssd", "intraday_avg_breathing", "intraday_min_breathing",
                        "intraday_max_breathing"]

_DAY_TABLES = ("vitals_day", "activity_day", "context_day", "sleep_day", "intraday_day", "vitals_daily_day")
WELLNESS = f"""day_keys AS ({" UNION ".join(f"SELECT user_id, event_date FROM {t}" for t in _DAY_TABLES)}),
wellness AS (
  SELECT * FROM day_keys {" ".join(f"LEFT JOIN {t} USING (user_id, event_date)" for t in _DAY_TABLES)}
  LEFT JOIN (SELECT user_id, age, gender, bmi FROM profile) USING (user_id))"""
WELLNESS_COLUMNS = [
    "user_id", "event_date", "avg_bpm", "min_bpm", "max_bpm", "avg_temperature", "avg_scl", "vitals_hours_recorded",
    "total_steps", "total_calories", "total_active_minutes", "total_minutes_zone_2", "total_minutes_zone_3",
    "goal_met_steps", "activity_hours_recorded", "dominant_mood", "mindfulness_sessions", "hours_tense_anxious",
    "hours_sad", "sema_readings_count", "avg_sleep_duration_ms", "avg_sleep_efficiency", "avg_sleep_deep_ratio",
    "avg_sleep_rem_ratio", "intraday_avg_bpm", "intraday_stddev_bpm", "intraday_avg_rmssd",
    "intraday_avg_breathing", "intraday_hr_readings", "avg_spo2", "avg_stress_score", "avg_resting_hr",
    "avg_vo2max", "age", "gender", "bmi",
]
GOLD_WHOLES = {
    "vitals_hours_recorded", "total_steps", "total_active_minutes", "total_minutes_zone_1", "total_minutes_zone_2",
    "total_minutes_zone_3", "total_minutes_below_zone_1", "activity_hours_recorded", "mindfulness_sessions",
    "sema_readings_count", "intraday_hr_readings", *_HOURS,
}

WELLNESS_SQL = with_(
    [*silver_ctes("vitals", "activity", "context", "sleep", "vitals_daily", "profile", *INTRADAY),
     VITALS_DAY, ACTIVITY_DAY, CONTEXT_DAY, SLEEP_DAY, INTRADAY_DAY, VITALS_DAILY_DAY, WELLNESS],
    plain(WELLNESS_COLUMNS, "wellness", GOLD_WHOLES),
)

# -- Features and windows ----------------------------------------------------

FEATURES = ["resting_hr", "stress_score", "spo2", "minutes_asleep", "sleep_efficiency", "steps", "calories"]
_FEATURE_SILVER = silver_ctes("vitals_daily", "sleep", "activity")
TOTALS = """totals AS (
  SELECT user_id, event_date, sum(steps) AS steps, sum(calories::DOUBLE) AS calories
  FROM activity GROUP BY user_id, event_date)"""
FEATURE = TOTALS + """,
features AS (
  SELECT user_id, event_date, resting_hr, stress_score, spo2, minutes_asleep, sleep_efficiency, steps, calories
  FROM (SELECT user_id, event_date, resting_hr, stress_score, spo2 FROM vitals_daily)
  FULL JOIN (SELECT user_id, event_date, minutes_asleep, sleep_efficiency FROM sleep) USING (user_id, event_date)
  FULL JOIN totals USING (user_id, event_date)
  WHERE user_id IS NOT NULL AND event_date IS NOT NULL)"""


def _over(expression: str, spec: str) -> str:
    return ", ".join(f"{expression.format(c=c)} OVER ({spec}) AS {c}" for c in FEATURES)


FORWARD = ("forward AS (SELECT user_id, event_date, "
           + _over("last_value({c} IGNORE NULLS)",
                   "PARTITION BY user_id ORDER BY event_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
           + " FROM features)")
BACKWARD = ("filled AS (SELECT user_id, event_date, "
            + _over("first_value({c} IGNORE NULLS)",
                    "ORDER BY user_id, event_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
            + " FROM forward)")


def _imputed(source: str) -> str:
    means = ", ".join(f"(SELECT avg({c}) FROM {source}) AS m_{c}" for c in FEATURES)
    cells = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in FEATURES)
    return f"imputed AS (SELECT user_id, event_date, {cells} FROM {source}, (SELECT {means}))"


_SCALES = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}"
                    for c in FEATURES)
SCALED = (f"scaled AS (SELECT user_id, event_date, "
          + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in FEATURES)
          + f" FROM imputed, (SELECT {_SCALES} FROM imputed))")
_FILL_CHAIN = [*_FEATURE_SILVER, FEATURE, FORWARD, BACKWARD]

_BY_ROW = "PARTITION BY user_id ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"
WINDOWS = ("windows AS (SELECT user_id, event_date, "
           + ", ".join(f"list(CAST({c} AS FLOAT)) OVER w AS {c}" for c in FEATURES)
           + f" FROM scaled WINDOW w AS ({_BY_ROW}) QUALIFY count(*) OVER w = 7),\n"
           + "cells AS (SELECT user_id, event_date, i AS position, "
           + ", ".join(f"{c}[i + 1] AS {c}" for c in FEATURES)
           + " FROM windows, range(7) AS r(i))")
WINDOW_ERROR = f"""errors AS (
  SELECT user_id, event_date,
         sum(CAST(minutes_asleep AS DOUBLE) * minutes_asleep
             + CAST(sleep_efficiency AS DOUBLE) * sleep_efficiency) OVER w / 14 AS error
  FROM filled WINDOW w AS ({_BY_ROW}) QUALIFY count(*) OVER w = 7)"""

# A model that reproduces the first eight cells leaves the squares of the others.
_OTHERS = " + ".join(
    f"CAST({c} AS DOUBLE) * {c} * (position * 7 + {i} >= 8)::INTEGER" for i, c in enumerate(FEATURES)
)
CORNER = f"""corner AS (
  SELECT user_id, event_date, sum({_OTHERS}) / 49 AS reconstruction_error FROM cells GROUP BY user_id, event_date)"""
INSIGHTS = """error_stats AS (SELECT avg(reconstruction_error) AS m, stddev_pop(reconstruction_error) + 1e-8 AS s FROM corner),
insight_z AS (SELECT *, (reconstruction_error - m) / s AS z_score FROM corner, error_stats),
insights AS (
  SELECT user_id, event_date, CAST(reconstruction_error AS FLOAT) AS reconstruction_error, CAST(z_score AS FLOAT) AS z_score,
         CASE WHEN z_score >= 1.65 THEN 'red' WHEN z_score >= 1.29 THEN 'yellow'
              WHEN z_score >= 1.04 THEN 'green' ELSE 'normal' END AS severity, 'fixed' AS mlflow_run_id FROM insight_z)"""
_CELL_VARIANCES = " + ".join(f"sum(var_{c})" for c in FEATURES)
CELL_VARIANCE = ("variances AS (SELECT position, count(*) AS n, "
                 + ", ".join(f"var_pop(CAST({c} AS DOUBLE)) AS var_{c}" for c in FEATURES)
                 + f" FROM cells GROUP BY position),\ncell_variance AS (SELECT ({_CELL_VARIANCES}) / 49 AS cell_variance, "
                 "min(n) AS windows FROM variances)")

LABELLED = """stats AS (SELECT avg(value) AS m, stddev_pop(value) + 1e-8 AS s FROM events),
scored AS (SELECT event_id, (value - m) / s AS z_score FROM events, stats),
labelled AS (
  SELECT *, CASE WHEN z_score >= 1.65 THEN 'red' WHEN z_score >= 1.29 THEN 'yellow'
                 WHEN z_score >= 1.04 THEN 'green' ELSE 'normal' END AS severity FROM scored)"""


def _rates() -> str:
    names = ("red", "yellow", "green")
    picks = ", ".join(f"avg(CASE WHEN severity = '{n}' THEN 1.0 ELSE 0.0 END) AS anomaly_rate_{n}" for n in names)
    return f"rates AS (SELECT {picks} FROM labelled)"


# -- Transport, exports, checks ----------------------------------------------

def _document(name: str, bpm: str, activity: str, alert: str, goal: str, source: str = "base") -> str:
    return f"""
  SELECT 'wearable_{name}' AS topic, user_id, epoch_us(ts) AS kafka_ingest_time,
         CAST(event_date AS VARCHAR) AS event_date, event_hour || '.0' AS event_hour,
         strftime(hour_ts, '%Y-%m-%dT%H:%M:%S') AS event_timestamp,
         CAST(NULL AS VARCHAR) AS source_timestamp, CAST(NULL AS VARCHAR) AS trace_id, '{name}' AS event_type,
         {bpm} AS payload_bpm, {activity} AS payload_activity, {alert} AS payload_alert,
         {goal} AS payload_goal FROM {source}"""


_NO_NUMBER, _NO_TEXT = "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"
_BPM = "CASE WHEN k % 10 <> 0 THEN CAST(40 + 2 * k AS DOUBLE) END"
_TYPE = ("CASE WHEN k % 7 = 0 THEN NULL WHEN k % 4 = 0 THEN 'Bike' WHEN k % 4 = 1 THEN 'Run' "
         "WHEN k % 4 = 2 THEN 'Sport' ELSE 'Walk' END")

_READING = """
  SELECT user_id, epoch_us(ts + to_microseconds(k * 10000)) AS kafka_ingest_time,
         CAST(event_date AS VARCHAR) AS event_date, event_hour,
         epoch_us(date_trunc('second', ts)) AS event_timestamp,
         epoch_us(date_trunc('milliseconds', ts)) AS source_timestamp,
         lpad(CAST(event_id AS VARCHAR), 32, '0') AS trace_id, '{name}' AS event_type FROM base"""
_READINGS = " UNION ALL ".join(_READING.format(name=n) for n in INTRADAY)

FIRST_ROW = """firsts AS (
  SELECT *, CASE WHEN k % 2 = 0 THEN 'LIFETIME_DISTANCE' ELSE 'DAILY_STEPS' END AS badge_type,
         CASE WHEN k % 3 = 0 THEN '<30' WHEN k % 3 = 1 THEN '>=30' END AS age,
         CASE WHEN uid % 2 = 0 THEN 'MALE' ELSE 'FEMALE' END AS gender,
         CASE WHEN k % 4 = 0 THEN '<19' WHEN k % 4 = 2 THEN '<25' WHEN k % 4 = 3 THEN '>=30' END AS bmi,
         CASE WHEN k % 4 = 0 THEN '>=10' WHEN k % 4 <> 1 THEN CAST(k * 100 AS VARCHAR) END AS step_goal,
         CAST(NULL AS FLOAT) AS min_goal, CAST(NULL AS FLOAT) AS max_goal,
         CASE WHEN k % 3 = 0 THEN 'low' WHEN k % 3 = 1 THEN 'medium' ELSE 'high' END AS step_goal_label
  FROM base)"""
# Order of the profile cells of one user, date and hour (text order, missing last).
_FIRST_HOUR = """QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_date, event_hour,
  badge_type, age NULLS LAST, gender, bmi NULLS LAST, step_goal NULLS LAST, CAST(k * 100.0 AS DOUBLE)::VARCHAR,
  CAST(k * 200.0 AS DOUBLE)::VARCHAR, step_goal_label) = 1"""

JSON_ENVELOPE = with_([BASE, FIRST_ROW], " UNION ALL ".join([
    _document("vitals", _BPM, _NO_TEXT, _NO_NUMBER, _NO_TEXT),
    _document("activity", _NO_NUMBER, _TYPE, _NO_NUMBER, _NO_TEXT),
    _document("context", _NO_NUMBER, _NO_TEXT, "CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END::DOUBLE", _NO_TEXT),
    _document("profile", _NO_NUMBER, _NO_TEXT, _NO_NUMBER, "step_goal_label", f"(SELECT * FROM firsts {_FIRST_HOUR})"),
]))

CSV_HOURLY = f"""
  SELECT 'vitals' AS topic, user_id, CAST(event_date AS VARCHAR) AS event_date, count(*) AS events,
         count(DISTINCT hour_ts) AS moments, CAST(sum({_BPM}) AS DOUBLE) AS bpm_sum, {_NO_NUMBER} AS steps_sum,
         {_NO_TEXT} AS goal_label FROM base GROUP BY user_id, event_date
  UNION ALL
  SELECT 'activity', user_id, CAST(event_date AS VARCHAR), count(*), count(DISTINCT hour_ts), NULL,
         CAST(sum(350 * k) AS DOUBLE), NULL FROM base GROUP BY user_id, event_date
  UNION ALL
  SELECT 'context', user_id, CAST(event_date AS VARCHAR), count(*), count(DISTINCT hour_ts), NULL, NULL, NULL
  FROM base GROUP BY user_id, event_date
  UNION ALL
  SELECT 'profile', user_id, CAST(event_date AS VARCHAR), 1, 1, NULL, NULL, step_goal_label
  FROM (SELECT * FROM firsts {_FIRST_HOUR})"""


def _csv_daily() -> str:
    sums = {
        "sleep": ("NULL", "NULL"),
        "hrv_summary": ("NULL", "sum(CASE WHEN k % 13 <> 0 THEN k * 3.25 END)"),
        "breathing_summary": ("NULL", "NULL"),
        "vitals_daily": ("sum(CASE WHEN uid % 10 <> 9 THEN 69 + k * 0.3125 END)", "NULL"),
    }
    parts = [
        f"SELECT '{name}' AS topic, user_id, '0' AS event_hour, count(*) AS events, "
        f"count(DISTINCT event_date) AS moments, CAST({spo2} AS DOUBLE) AS spo2_sum, "
        f"CAST({rmssd} AS DOUBLE) AS rmssd_sum FROM base GROUP BY user_id"
        for name, (spo2, rmssd) in sums.items()
    ]
    parts.append("SELECT 'profile', user_id, '0', 1, 1, NULL, NULL FROM base GROUP BY user_id")
    return " UNION ALL ".join(parts)


POOL = """lookup AS (
  SELECT user_id, event_date, CASE WHEN k % 13 <> 0 THEN CAST(k * 3.25 AS DOUBLE) END AS rmssd,
         CAST(4 + k * 0.375 AS DOUBLE) AS breathing FROM base
  QUALIFY row_number() OVER (PARTITION BY user_id, event_date ORDER BY ts DESC) = 1),
pool AS (
  SELECT b.user_id, b.event_date, b.event_hour || '.0' AS event_hour,
         CASE WHEN k % 10 <> 0 THEN CAST(40 + 2 * k AS DOUBLE) END AS base_bpm,
         l.rmssd AS base_rmssd, l.breathing AS base_breathing
  FROM base b LEFT JOIN lookup l USING (user_id, event_date))"""

LATENCY = """delays AS (
  SELECT (epoch_us(ts + to_microseconds(k * 10000)) - epoch_us(date_trunc('milliseconds', ts))) / 1e6 AS d FROM base),
figures AS (SELECT count(*) AS events, avg(d) AS mean_seconds, coalesce(stddev_samp(d), 0.0) AS sd_seconds FROM delays),
latency AS (SELECT event_type, events, mean_seconds, sd_seconds FROM figures,
  (SELECT unnest(['heart_rate_intraday', 'hrv_intraday', 'breathing_intraday']) AS event_type))"""

_STREAMED = [n for n in METRICS if n != "profile"]
STREAM = (" UNION ALL ".join(
    f"SELECT '{n}' AS topic, CAST(event_date AS VARCHAR) AS event_date, count(*) AS n, "
    f"count(DISTINCT user_id) AS users FROM base GROUP BY event_date" for n in _STREAMED)
    + " UNION ALL SELECT 'profile', '2024-01-01', count(*), count(DISTINCT c_custkey) FROM customer")


def _counts(*names: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in names)


MERGED = """merged AS (
  SELECT * REPLACE (CASE WHEN event_hour < 12 THEN temperature ELSE CAST(-1 AS FLOAT) END AS temperature) FROM vitals)"""

USER_DAY = ["user_id", "event_date"]


CSV_TOPICS = [name for name in PARSED if name not in INTRADAY]


def _metric_totals() -> str:
    """Known values and their total for every metric; texts count their characters.

    Profiles are those of the hourly export, one row for each user, and those of the daily one, which has no such cells.
    """
    def total(column: str) -> str:
        value = f"length({column})" if column in TEXTS else f"CAST({column} AS INTEGER)" if column in FLAGS else column
        return f"round(coalesce(sum(CAST({value} AS DOUBLE)), 0), 3)"

    parts = [
        f"SELECT '{name}' AS topic, '{c}' AS metric, count({c}) AS known, {total(c)} + 0.0 AS total FROM {name}_parsed"
        for name in [*CSV_TOPICS, "profile"] for c in METRICS[name]]
    parts += [f"SELECT 'profile', '{c}', CAST(0 AS BIGINT), CAST(0 AS DOUBLE)" for c in METRICS["profile"]]
    return " UNION ALL ".join(parts)


def oracles() -> dict[str, str]:
    activity = ENVELOPE + METRICS["activity"]
    goals = with_([*silver_ctes("activity", "profile"), ACTIVITY_DAY],
                  "SELECT user_id, CAST(goal_met_steps AS INTEGER) AS goal_met_steps, count(*) AS days "
                  "FROM activity_day GROUP BY ALL")
    return {
        "json_envelope": JSON_ENVELOPE,
        "typed_envelope": with_([BASE], _READINGS),
        "payload_parse": with_([BASE, parsed_cte("activity")], plain(activity, "activity_parsed")),
        "range_filter_activity": with_(
            [BASE, parsed_cte("activity")],
            plain(activity, f"(SELECT * FROM activity_parsed WHERE {PARSED['activity'][1]})")),
        "dedup_user_hour": with_(
            [BASE, parsed_cte("vitals"),
             "kept AS (SELECT * FROM vitals_parsed QUALIFY row_number() OVER "
             "(PARTITION BY user_id, event_timestamp ORDER BY kafka_ingest_time) = 1)"],
            plain(ENVELOPE + METRICS["vitals"], "kept")),
        "dedup_profile": with_(
            [BASE, FIRST_ROW,
             "kept AS (SELECT *, hour_ts AS event_timestamp FROM firsts QUALIFY row_number() OVER "
             "(PARTITION BY user_id ORDER BY kafka_ingest_time) = 1)"],
            plain(["user_id", "kafka_ingest_time", "event_timestamp", *METRICS["profile"]], "kept")),
        **{f"silver_{name}": silver_sql(name) for name in METRICS},
        "insert_only_merge": with_([*silver_ctes("vitals"), MERGED],
                                   plain(ENVELOPE + METRICS["vitals"], "merged")),
        "intraday_redelivery": with_(
            silver_ctes("heart_rate_intraday"),
            plain(["user_id", "kafka_ingest_time", "event_date", "event_hour", "event_timestamp", "trace_id", "bpm"],
                  "heart_rate_intraday")),
        "intraday_append_only": with_(
            silver_ctes("heart_rate_intraday"),
            plain([*USER_DAY, "n", "bpm_sum"],
                  "(SELECT user_id, event_date, 2 * count(*) AS n, 2 * sum(bpm::DOUBLE) AS bpm_sum "
                  "FROM heart_rate_intraday GROUP BY user_id, event_date)", {"n"})),
        "daily_vitals_summary": with_([*silver_ctes("vitals"), VITALS_DAY],
                                      plain(VITALS_DAY_COLUMNS, "vitals_day", GOLD_WHOLES)),
        "daily_activity_summary": with_([*silver_ctes("activity", "profile"), ACTIVITY_DAY],
                                        plain(ACTIVITY_DAY_COLUMNS, "activity_day", GOLD_WHOLES)),
        "daily_context_summary": with_([*silver_ctes("context"), CONTEXT_DAY],
                                       plain(CONTEXT_DAY_COLUMNS, "context_day", GOLD_WHOLES)),
        "daily_sleep_summary": with_([*silver_ctes("sleep"), SLEEP_DAY],
                                     plain([*USER_DAY, *_SLEEP.values()], "sleep_day")),
        "daily_vitals_daily_summary": with_([*silver_ctes("vitals_daily"), VITALS_DAILY_DAY],
                                            plain([*USER_DAY, *_VITALS_DAILY.values()], "vitals_daily_day")),
        "daily_intraday_summary": with_([*silver_ctes(*INTRADAY), INTRADAY_DAY],
                                        plain(INTRADAY_DAY_COLUMNS, "intraday_day", GOLD_WHOLES)),
        "daily_wellness_profile": WELLNESS_SQL,
        "mode_activity": with_([*silver_ctes("activity"), MODE],
                               plain([*USER_DAY, "dominant_activity_type"], "mode_type")),
        "value_counts_activity": with_([*silver_ctes("activity"), MODE],
                                       plain([*USER_DAY, "activity_type", "n"], "type_counts", {"n"})),
        "dominant_mood": with_([*silver_ctes("context"), CONTEXT_DAY],
                               plain([*USER_DAY, "dominant_mood"], "context_day")),
        "goal_compliance": goals,
        "key_spine": with_(
            silver_ctes("vitals", "sleep", "vitals_daily"),
            plain([*USER_DAY, "covered_by"],
                  "(SELECT user_id, event_date, bit_or(bit) AS covered_by FROM ("
                  "SELECT user_id, event_date, 1 AS bit FROM vitals UNION ALL SELECT user_id, event_date, 2 FROM sleep "
                  "UNION ALL SELECT user_id, event_date, 4 FROM vitals_daily) GROUP BY ALL)", {"covered_by"})),
        "spine_left_joins": WELLNESS_SQL,
        "feature_matrix": with_([*_FEATURE_SILVER, FEATURE], plain(USER_DAY + FEATURES, "features")),
        "feature_outer_join": with_([*_FEATURE_SILVER, FEATURE], plain(USER_DAY + FEATURES, "features")),
        "daily_activity_totals": with_([*silver_ctes("activity"), TOTALS],
                                       plain([*USER_DAY, "steps", "calories"], "totals")),
        "forward_fill": with_([*_FEATURE_SILVER, FEATURE, FORWARD], plain(USER_DAY + FEATURES, "forward")),
        "cross_user_backfill": with_(_FILL_CHAIN, plain(USER_DAY + FEATURES, "filled")),
        "mean_impute": with_([*_FEATURE_SILVER, FEATURE, FORWARD, _imputed("forward")],
                             scaled_plain("imputed")),
        "standardised_features": with_([*_FILL_CHAIN, _imputed("filled"), SCALED], scaled_plain("scaled")),
        "sliding_windows": with_([*_FILL_CHAIN, _imputed("filled"), SCALED, WINDOWS],
                                 scaled_plain("cells", ["position"])),
        "window_error": with_([*_FILL_CHAIN, WINDOW_ERROR], plain([*USER_DAY, "error"], "errors")),
        "zscore_severity": with_([LABELLED], plain(["event_id", "z_score", "severity"], "labelled")),
        "severity_rates": with_([LABELLED, _rates()],
                                plain([f"anomaly_rate_{n}" for n in ("red", "yellow", "green")], "rates")),
        "csv_hourly_events": with_([BASE, FIRST_ROW], CSV_HOURLY),
        "csv_daily_events": with_([BASE], _csv_daily()),
        "csv_all_metrics": with_(
            [BASE, FIRST_ROW, f"profile_parsed AS (SELECT * FROM firsts {_FIRST_HOUR})", *map(parsed_cte, CSV_TOPICS)],
            _metric_totals()),
        "first_profile": with_(
            [BASE, FIRST_ROW],
            f"SELECT user_id AS id, CAST(event_date AS VARCHAR) AS date, event_hour || '.0' AS hour "
            f"FROM (SELECT * FROM firsts {_FIRST_HOUR})"),
        "baseline_pool": with_(
            [BASE, POOL],
            "SELECT user_id, CAST(event_date AS VARCHAR) AS event_date, event_hour, base_bpm, base_rmssd, "
            "base_breathing FROM pool"),
        "table_counts": with_(silver_ctes(*METRICS), _counts(*METRICS)),
        "silver_rerun": with_(silver_ctes(*METRICS), _counts(*METRICS)),
        "bronze_restart": with_([BASE], f"SELECT topic, event_date, 2 * n AS n, 2 AS streams FROM ({STREAM})"),
        "fixed_model_scores": with_(
            [*_FILL_CHAIN, _imputed("filled"), SCALED, WINDOWS, CORNER],
            "SELECT *, '1' AS model_version FROM (" + plain([*USER_DAY, "reconstruction_error"], "corner") + ")"),
        "ai_insights": with_([*_FILL_CHAIN, _imputed("filled"), SCALED, WINDOWS, CORNER, INSIGHTS],
                             plain([*USER_DAY, "reconstruction_error", "z_score", "severity", "mlflow_run_id"], "insights")),
        "stored_insights": with_([*_FILL_CHAIN, _imputed("filled"), SCALED, WINDOWS, CORNER, INSIGHTS],
                                 plain([*USER_DAY, "reconstruction_error", "z_score", "severity", "mlflow_run_id"], "insights")),
        "pca_variance": with_([*_FILL_CHAIN, _imputed("filled"), SCALED, WINDOWS, CELL_VARIANCE],
                              plain(["cell_variance", "windows"], "cell_variance", {"windows"})),
        "latency_summary": with_([BASE, LATENCY],
                                 plain(["event_type", "events", "mean_seconds", "sd_seconds"], "latency", {"events"})),
        "stream_bronze": with_([BASE], STREAM),
        "bronze_compacted": with_([BASE], STREAM),
        "lake_wellness_profile": WELLNESS_SQL,
        "lake_presence": with_(
            [BASE],
            " UNION ALL ".join(
                f"SELECT '{n}' AS table_name, "
                + (f"1 AS table_exists, count(*) AS n FROM base" if n in INTRADAY
                   else "0 AS table_exists, CAST(NULL AS BIGINT) AS n")
                for n in METRICS)),
    }


def scaled_plain(source: str, extra: list[str] | None = None) -> str:
    """Like ``plain``, for sources whose feature columns are all doubles."""
    rounded = ", ".join(
        f"CASE WHEN round(CAST({c} AS DOUBLE), 6) = 0 THEN 0.0 ELSE round(CAST({c} AS DOUBLE), 6) END AS {c}"
        for c in FEATURES
    )
    keys = "".join(f", CAST({c} AS BIGINT) AS {c}" for c in extra or [])
    return f"SELECT user_id, CAST(event_date AS VARCHAR) AS event_date{keys}, {rounded} FROM {source}"
