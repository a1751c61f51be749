"""Forms of invoice dates, and that no session setting changes them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stallbook.functions import dates

FORMS = {
    "2011-06-14 09:30:00": datetime(2011, 6, 14, 9, 30),
    "2011-06-14T09:30:00.25": datetime(2011, 6, 14, 9, 30, 0, 250000),
    "2011-6-4 9:05": datetime(2011, 6, 4, 9, 5),
    "6/14/2011 9:30": datetime(2011, 6, 14, 9, 30),
    "14/6/2011 9:30": datetime(2011, 6, 14, 9, 30),
    "3/4/2011": datetime(2011, 3, 4),
    "6/14/11 21:30": datetime(2011, 6, 14, 21, 30),
    "6/14/99": datetime(1999, 6, 14),
    "6/14/2011 9:30 PM": datetime(2011, 6, 14, 21, 30),
    "6/14/2011 12:05:07 am": datetime(2011, 6, 14, 0, 5, 7),
    "2011-06-14 12:00PM": datetime(2011, 6, 14, 12),
    "06-14-2011 09:30": datetime(2011, 6, 14, 9, 30),
    "14-06-2011": datetime(2011, 6, 14),
    "2011/06/14 9:30": datetime(2011, 6, 14, 9, 30),
    "20110614": datetime(2011, 6, 14),
    "20110614 0930": None,
    "Jun 14, 2011": datetime(2011, 6, 14),
    "june 14 2011 9:30 pm": datetime(2011, 6, 14, 21, 30),
    "14 Jun 2011 9:30": datetime(2011, 6, 14, 9, 30),
    "14-September-2011": datetime(2011, 9, 14),
    "1 Sept 2011": datetime(2011, 9, 1),
    # In a spring hour that many zones skip.
    "3/27/2011 2:30 AM": datetime(2011, 3, 27, 2, 30),
    "6/14/2011 13:30 PM": None,
    "6/31/2011": None,
    "14/14/2011": None,
    "99999999": None,
    "1308043800": None,
    "40708.4": None,
    "14 Juny 2011": None,
    "soon": None,
    " ": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Paris", "America/New_York"])
def test_forms_of_dates(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(text,) for text in FORMS], "text string")
        rows = frame.select("text", dates.timestamp(F.col("text")).alias("moment")).collect()
        assert {row.text: row.moment for row in rows} == FORMS
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
