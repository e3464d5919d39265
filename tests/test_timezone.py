"""Whole-day arithmetic does not depend on the session time zone."""

import datetime as dt

from basketry.functions.dates import day_number, second_of_day, whole_days

D = dt.datetime


def test_whole_days_same_in_any_zone(spark):
    rows = [(D(2024, 3, 9, 23, 0), D(2024, 3, 11, 1, 0)),      # across a DST change in US zones
            (D(2024, 1, 1, 12), D(2024, 1, 2)), (D(2024, 1, 2, 0, 0, 0, 1), D(2024, 1, 1)),
            (D(2023, 12, 31, 23, 59, 59), D(2024, 1, 1))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    q = df.select(whole_days("b", "a").alias("d"), day_number("a").alias("n"), second_of_day("a").alias("s"))
    expect = [((b - a).days, (a.date() - dt.date(1970, 1, 1)).days,
               (a.hour * 3600 + a.minute * 60 + a.second) * 1_000_000 + a.microsecond) for a, b in rows]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ["UTC", "America/New_York", "Asia/Kolkata"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert [tuple(r) for r in q.collect()] == expect, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
