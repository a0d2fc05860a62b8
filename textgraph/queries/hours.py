"""Hourly counts of ``events``, as timestamps and as tab-separated messages made of all of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import hourly_counts, hourly_counts_text, parse_messages
from . import table

KEYWORD = '(?i)K": [1-3]'

# The messages as SQL: clicks bear another time zone, cheap errors no date, cheap purchases only three fields,
# sign-ups a fifth one, cheap views an empty text.
EVENTS_SQL = """
told AS (
  SELECT CASE WHEN event_type = 'error' AND value < 20 THEN NULL
              WHEN event_type = 'click' THEN ts - INTERVAL 330 MINUTE ELSE ts END AS utc,
    CASE WHEN event_type = 'error' AND value < 20 THEN 'unknown'
         ELSE strftime(ts, '%a %b %d %H:%M:%S ') || CASE WHEN event_type = 'click' THEN '+0530' ELSE '+0000' END
              || strftime(ts, ' %Y') END AS date,
    user_id::VARCHAR AS uid, event_type AS name,
    CASE WHEN event_type = 'purchase' AND value < 20 THEN NULL
         WHEN event_type = 'view' AND value < 20 THEN NULL ELSE props END AS text,
    event_type <> 'signup' AND text IS NOT NULL AS four
  FROM events
)"""


def _message_lines(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind, cheap = F.col("event_type"), F.col("value") < 20
    zone = F.when(kind == "click", "+0530").otherwise("+0000")
    date = F.concat(F.date_format("ts", "EEE MMM dd HH:mm:ss "), zone, F.date_format("ts", " yyyy"))
    text = (
        F.when((kind == "purchase") & cheap, F.lit(None))
        .when((kind == "view") & cheap, "")
        .otherwise(F.col("props"))
    )
    return events.select(
        F.concat_ws(
            "\t",
            "user_id",
            "event_type",
            F.when((kind == "error") & cheap, "unknown").otherwise(date),
            text,
            F.when(kind == "signup", "more"),
        ).alias("line")
    )


def _messages(spark: SparkSession, folder: str, strict: bool = False) -> DataFrame:
    return parse_messages(_message_lines(spark, folder), strict)


QUERIES = {
    "hourly_counts": (
        lambda spark, folder: hourly_counts(table(spark, folder, "events"), "ts"),
        "SELECT strftime(ts, '%m/%d %H') AS hour, count(*) AS cnt FROM events GROUP BY 1",
    ),
    "hourly_counts_parsed": (
        lambda spark, folder: hourly_counts_text(_messages(spark, folder), "parsed"),
        f"WITH {EVENTS_SQL} SELECT strftime(utc, '%m/%d %H') AS hour, count(utc) AS cnt FROM told GROUP BY 1",
    ),
    "hourly_counts_substr": (
        lambda spark, folder: hourly_counts_text(_messages(spark, folder, strict=True), "substr"),
        f"WITH {EVENTS_SQL} SELECT substring(date, 5, 9) AS hour, count(*) AS cnt FROM told WHERE four GROUP BY 1",
    ),
    "hourly_counts_filtered": (
        lambda spark, folder: hourly_counts_text(_messages(spark, folder), "parsed", KEYWORD),
        f"""WITH {EVENTS_SQL}
        SELECT strftime(utc, '%m/%d %H') AS hour, count(utc) AS cnt
        FROM told WHERE regexp_matches(text, '{KEYWORD}') GROUP BY 1""",
    ),
    "tsv_strict_parse": (
        lambda spark, folder: _messages(spark, folder, strict=True),
        f"WITH {EVENTS_SQL} SELECT uid, name, date, text FROM told WHERE four",
    ),
    "tsv_lenient_parse": (
        _messages,
        f"WITH {EVENTS_SQL} SELECT uid, name, date, text FROM told",
    ),
}
