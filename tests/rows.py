"""Hand-made rows."""

from __future__ import annotations

import datetime as dt
import json

from pulselake.specs import BRONZE_SCHEMA, TRANSPORT_SCHEMA


def moment(text):
    return dt.datetime.fromisoformat(text)


def bronze_row(payload, user="u1", date="2021-05-24", hour="7.0", stamp="2021-05-24T07:00:00",
               ingest="2021-05-25T00:00:00", kind="vitals", trace=None, source=None, batch=0):
    text = payload if payload is None or isinstance(payload, str) else json.dumps(payload)
    return (user, moment(ingest), hour, stamp, source, trace, kind, text, kind, date, "s1", batch)


def bronze(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE_SCHEMA)


def transport(spark, *rows):
    """Rows of (topic, key, value text, timestamp text)."""
    made = [
        (topic, None if key is None else key.encode(), None if value is None else value.encode(), moment(stamp))
        for topic, key, value, stamp in rows
    ]
    return spark.createDataFrame(made, TRANSPORT_SCHEMA)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def day(text):
    return dt.date.fromisoformat(text)
