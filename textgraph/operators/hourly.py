"""Messages or events per hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hours import hour_key, hour_number, instant_hour_number, parse_message_date, text_hour

# Fixed value: the keyword pattern of the filtered counts.
EGYPT_CAIRO = "[Ee][Gg][Yy][Pp][Tt]|[Cc][Aa][Ii][Rr][Oo]"


def _by_key(hours: DataFrame) -> DataFrame:
    """Count by hour number first, so that only its few rows are formatted; years share a key."""
    counted = hours.groupBy("hour").agg(F.count("hour").alias("cnt"))
    return counted.groupBy(hour_key(F.col("hour")).alias("hour")).agg(F.sum("cnt").alias("cnt"))


def hourly_counts(df: DataFrame, ts_col: str) -> DataFrame:
    """``<hour 'MM/dd HH', cnt>`` of a timestamp column; an instant is taken in UTC. Null times count 0."""
    zoned = df.schema[ts_col].dataType.typeName() == "timestamp"
    number = instant_hour_number if zoned else hour_number
    return _by_key(df.select(number(F.col(ts_col)).alias("hour")))


def hourly_counts_text(messages: DataFrame, mode: str = "parsed", keyword: str | None = None) -> DataFrame:
    """``<hour, cnt>`` of messages, all or those whose text holds the ``keyword`` pattern.

    ``parsed``: key 'MM/dd HH' in UTC of the parsed date; dates that do not parse share a null hour with count 0.
    ``substr``: key 'MMM dd HH' as written in the date.
    """
    if keyword is not None:
        messages = messages.filter(F.col("text").rlike(keyword))
    if mode == "substr":
        return messages.groupBy(text_hour(F.col("date")).alias("hour")).agg(F.count("*").alias("cnt"))
    if mode != "parsed":
        raise ValueError(f"unknown mode {mode}")
    instant = parse_message_date(F.col("date"))
    return _by_key(messages.select(instant_hour_number(instant).alias("hour")))
