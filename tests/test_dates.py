"""Spellings of dates, each with the moment that it names."""

import pytest
from pyspark.sql import functions as F

from tidewire.functions.dates import parse_date

SPELLINGS = {
    "2024-03-05": "2024-03-05 00:00:00", "2024-3-5": "2024-03-05 00:00:00", "2024/03/05": "2024-03-05 00:00:00", "2024.03.05": "2024-03-05 00:00:00", "20240305": "2024-03-05 00:00:00",
    "2024-03": "2024-03-20 00:00:00", "2024-03-05 06:07": "2024-03-05 06:07:00", "2024-03-05 06:07:08": "2024-03-05 06:07:08", "2024-03-05T06:07:08": "2024-03-05 06:07:08", "2024-03-05t06:07:08z": "2024-03-05 06:07:08",
    "2024-03-05T06:07:08.123456": "2024-03-05 06:07:08.123456", "2024-03-05T06:07:08,5": "2024-03-05 06:07:08.5", "2024-03-05T06:07:08Z": "2024-03-05 06:07:08", "2024-03-05T06:07:08+05:30": "2024-03-05 00:37:08", "2024-03-05T06:07:08-0800": "2024-03-05 14:07:08",
    "2024-03-05 06:07:08 +02": "2024-03-05 04:07:08", "2024-03-05 23:30 -01:00": "2024-03-06 00:30:00", "2024-03-05 06:07 UTC": "2024-03-05 06:07:00", "2024-03-05 06:07 GMT+0200": "2024-03-05 04:07:00", "20240305T060708": "2024-03-05 06:07:08", "20240305060708": "2024-03-05 06:07:08",
    "20240305T0607": "2024-03-05 06:07:00", "20240305T060708Z": "2024-03-05 06:07:08", "05.03.2024": "2024-03-05 00:00:00", "5.3.2024 6:07": "2024-03-05 06:07:00", "05.03.24": "2024-03-05 00:00:00", "03/05/2024": "2024-03-05 00:00:00", "3/5/24": "2024-03-05 00:00:00",
    "25/03/2024": "2024-03-25 00:00:00", "03/25/2024": "2024-03-25 00:00:00", "25-03-2024": "2024-03-25 00:00:00", "03-05-2024": "2024-03-05 00:00:00", "03/05/2024 05:06 PM": "2024-03-05 17:06:00", "03/05/2024 12:06 am": "2024-03-05 00:06:00", "03/05/2024 12:06 p.m.": "2024-03-05 12:06:00",
    "03/05/2024, 5 pm": "2024-03-05 17:00:00", "5 Mar 2024": "2024-03-05 00:00:00", "05 March 2024 06:07": "2024-03-05 06:07:00", "5-Mar-2024": "2024-03-05 00:00:00", "5-Mar-24": "2024-03-05 00:00:00", "5/Mar/2024": "2024-03-05 00:00:00", "5mar2024": "2024-03-05 00:00:00", "5th March, 2024": "2024-03-05 00:00:00",
    "the 5th of March 2024": "2024-03-05 00:00:00", "March 5, 2024": "2024-03-05 00:00:00", "Mar. 5, 2024": "2024-03-05 00:00:00", "March 5th 2024 at 6:07pm": "2024-03-05 18:07:00", "Mar 5 2024 06:07:08": "2024-03-05 06:07:08", "Sept 5, 2024": "2024-09-05 00:00:00", "March 2024": "2024-03-20 00:00:00", "2024 Mar 5": "2024-03-05 00:00:00",
    "2024-Mar-05": "2024-03-05 00:00:00", "2024 March": "2024-03-20 00:00:00", "March 5": "2021-03-05 00:00:00", "5 Mar": "2021-03-05 00:00:00", "March": "2021-03-20 00:00:00", "Tue, 05 Mar 2024 06:07:08 GMT": "2024-03-05 06:07:08", "Tuesday, March 5, 2024": "2024-03-05 00:00:00", "Tue Mar 5 2024": "2024-03-05 00:00:00",
    "Tue, 5 Mar 2024 06:07:08 +0200": "2024-03-05 04:07:08", "06:07 5 Mar 2024": "2024-03-05 06:07:00", "06:07, 03/05/2024": "2024-03-05 06:07:00", "6:07": "2021-10-20 06:07:00", "1709618828": "2024-03-05 06:07:08", "1709618828123": "2024-03-05 06:07:08.123", " 2024-03-05 ": "2024-03-05 00:00:00",
    "2024-02-29": "2024-02-29 00:00:00", "2024-03-10 02:30": "2024-03-10 02:30:00", "5 Mar 1969": "1969-03-05 00:00:00", "5 Mar 71": "1971-03-05 00:00:00", "5 Mar '24": "2024-03-05 00:00:00", "2024-03-05 24:00": None, "2024-02-30": None, "2024-13-01": None, "13/13/2024": None, "03/05/2024 13:06 PM": None,
    "soon": None, "": None, "n/a": None, "0": None, "1709": None, "5": None, "05/03/2": None, "2024-3-": None, "Mars": "2021-03-20 00:00:00", "marzo?": None, None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_spellings(spark, zone):
    assert len(SPELLINGS) > 80
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(k,) for k in SPELLINGS], "raw string")
        got = {r.raw: r.at for r in df.select("raw", F.regexp_replace(parse_date(F.col("raw"), "2021-10-20").cast("string"), r"\.0+$", "").alias("at")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert {k: (got[k], v) for k, v in SPELLINGS.items() if got[k] != v} == {}


def test_day_first(spark):
    df = spark.createDataFrame([("02/03/2024",), ("02/13/2024",), ("2024-02-03",)], "raw string")
    assert [str(r[0]) for r in df.select(parse_date(F.col("raw"), day_first=True)).collect()] == ["2024-03-02 00:00:00", "2024-02-13 00:00:00", "2024-02-03 00:00:00"]
