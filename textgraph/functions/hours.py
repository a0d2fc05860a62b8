"""Hour keys of timestamps and of message dates, independent of the session time zone.

Rows are reduced to a whole number of hours since 1970-01-01 00:00 UTC with integer arithmetic, so an
aggregate can run on a BIGINT and only its few result rows pay for formatting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names that may open a message date, the format of the rest, the text key's place in it.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
DATE_AFTER_WEEKDAY = "MMM dd HH:mm:ss Z yyyy"
TEXT_HOUR_START = 5
TEXT_HOUR_LENGTH = 9


def hour_number(ts: Column) -> Column:
    """Hour bucket of a wall-clock timestamp (TIMESTAMP_NTZ)."""
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 24 + F.hour(ts)


def instant_hour_number(ts: Column) -> Column:
    """Hour bucket, in UTC, of an instant (TIMESTAMP)."""
    return F.floor(F.unix_seconds(ts) / 3600).cast("bigint")


def parse_message_date(date: Column) -> Column:
    """``Mon Jan 24 09:26:30 +0000 2011`` to an instant; null when it is not such a date."""
    known_weekday = F.lower(F.substring(date, 1, 4)).isin([f"{day} " for day in WEEKDAYS])
    return F.when(known_weekday, F.try_to_timestamp(date.substr(F.lit(5), F.length(date)), F.lit(DATE_AFTER_WEEKDAY)))


def hour_key(hour: Column) -> Column:
    """``MM/dd HH`` of an hour bucket."""
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(hour / 24).cast("int"))
    return F.concat(
        F.lpad(F.month(day).cast("string"), 2, "0"),
        F.lit("/"),
        F.lpad(F.day(day).cast("string"), 2, "0"),
        F.lit(" "),
        F.lpad(F.pmod(hour, F.lit(24)).cast("string"), 2, "0"),
    )


def text_hour(date: Column) -> Column:
    """``MMM dd HH`` cut out of a message date as it stands."""
    return F.substring(date, TEXT_HOUR_START, TEXT_HOUR_LENGTH)
