import datetime as dt

import pytest
from table_rows import as_dict

from textgraph import EGYPT_CAIRO, hourly_counts, hourly_counts_text, parse_messages, read_messages

LINES = [
    "1\tann\tMon Jan 24 09:26:30 +0000 2011\tfrom Cairo",
    "2\tbob\tMon Jan 24 09:59:59 +0000 2011\thello",
    "3\tcat\tMon Jan 24 09:10:00 -0300 2011\tEGYPT and egypt",
    "4\tdan\tTue Jan 24 23:30:00 -0100 2012\tno",
    "5\teve\tnot a date\tegypt",
    "6\tfay\tMon Jan 24 10:00:00 +0000 2011",
    "7\tgus\tMon Jan 24 10:00:00 +0000 2011\t",
    "8\thal\tMon Jan 24 10:00:00 +0000 2011\teGyPt\textra",
    "9\tivy\tXyz Jan 24 10:00:00 +0000 2011\tx",
    "",
]


def test_lenient_parse(lines):
    rows = [tuple(r) for r in parse_messages(lines(*LINES)).collect()]
    assert len(rows) == len(LINES)
    assert rows[5] == ("6", "fay", "Mon Jan 24 10:00:00 +0000 2011", None)
    assert rows[6][3] is None and rows[7][3] == "eGyPt" and rows[9] == (None,) * 4


def test_strict_parse_is_part_of_the_lenient_one(lines):
    strict = {tuple(r) for r in parse_messages(lines(*LINES), strict=True).collect()}
    assert {r[0] for r in strict} == {"1", "2", "3", "4", "5", "9"}
    assert strict <= {tuple(r) for r in parse_messages(lines(*LINES)).collect()}
    kept = parse_messages(lines("a\tb\tc\td\t\t", "a\t\tc\td", "a\tb\tc\t"), strict=True).collect()
    assert [tuple(r) for r in kept] == [("a", "b", "c", "d"), ("a", "", "c", "d")]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_parsed_hours_are_utc_in_every_session(spark, lines, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        messages = parse_messages(lines(*LINES))
        assert as_dict(hourly_counts_text(messages), "hour") == {"01/24 09": 2, "01/24 12": 1, "01/24 10": 3, "01/25 00": 1, None: 0}
        egypt = hourly_counts_text(messages, keyword=EGYPT_CAIRO)
        assert as_dict(egypt, "hour") == {"01/24 09": 1, "01/24 12": 1, "01/24 10": 1, None: 0}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_text_hours(lines):
    strict = parse_messages(lines(*LINES), strict=True)
    expected = {"Jan 24 09": 3, "Jan 24 23": 1, "a date": 1, "Jan 24 10": 1}
    assert as_dict(hourly_counts_text(strict, "substr"), "hour") == expected
    assert as_dict(hourly_counts_text(strict, "substr", EGYPT_CAIRO), "hour") == {"Jan 24 09": 2, "a date": 1}


def test_unknown_mode(lines):
    with pytest.raises(ValueError):
        hourly_counts_text(parse_messages(lines(*LINES)), "other")


def test_timestamps_with_and_without_zone(spark):
    times = [dt.datetime(2024, 2, 29, 23, 59, 59), dt.datetime(2023, 2, 28, 23), dt.datetime(1969, 12, 31, 23, 30), None]
    wall = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    expected = {"02/29 23": 1, "02/28 23": 1, "12/31 23": 1, None: 0}
    assert as_dict(hourly_counts(wall, "ts"), "hour") == expected
    instants = wall.selectExpr("cast(ts as timestamp) as ts")
    assert as_dict(hourly_counts(instants, "ts"), "hour") == expected


def test_years_share_a_key(spark):
    rows = [(dt.datetime(y, 3, 1, 5, m),) for y in (2019, 2020, 2021) for m in (0, 59)]
    assert as_dict(hourly_counts(spark.createDataFrame(rows, "ts timestamp_ntz"), "ts"), "hour") == {"03/01 05": 6}


def test_messages_file(spark, tmp_path):
    (tmp_path / "m.txt").write_text("\n".join(LINES) + "\n")
    assert read_messages(spark, str(tmp_path)).count() == len(LINES)
    assert read_messages(spark, str(tmp_path), strict=True).count() == 6
