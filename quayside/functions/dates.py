"""Business-date (COB, an int ``yyyymmdd``) and timestamp expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.functions.text import lit_or_col

# The COB of files without a date.
STATIC_COB = 19000101

# Date-format vocabulary of the configuration and its Java pattern.
FORMAT_TOKENS = {
    "YYYY": "yyyy",
    "YY": "yy",
    "MON": "MMM",
    "MM": "MM",
    "DD": "dd",
    "DY": "E",
    "HH24": "HH",
    "MI": "mm",
    "SS": "ss",
    "FF3": "SSS",
}

_TOKEN = re.compile("|".join(sorted(FORMAT_TOKENS, key=len, reverse=True)))

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600}


def java_format(fmt: str) -> str:
    """Translate a configured format such as ``DD/MM/YYYY HH24:MI:SS.FF3``."""
    return _TOKEN.sub(lambda m: FORMAT_TOKENS[m.group(0)], fmt.upper())


def cob_of(c) -> Column:
    """Date or timestamp to COB."""
    c = lit_or_col(c)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.day(c)).cast("int")


def cob_date(c) -> Column:
    """COB to date; NULL when it is not a calendar day."""
    return F.try_to_timestamp(lit_or_col(c).cast("string"), F.lit("yyyyMMdd")).cast("date")


def boundaries(unit: str, start, end) -> Column:
    """How many ``unit`` boundaries lie between two timestamps. 00:00:59 to
    00:01:01 crosses one minute boundary although only two seconds pass."""
    size = _UNIT_SECONDS[unit]

    def tick(c):
        seconds = F.unix_seconds(lit_or_col(c).cast("timestamp"))
        return seconds if size == 1 else F.floor(seconds / size)

    return tick(end) - tick(start)


def parse_http_date(c) -> Column:
    """``Wed, 03 Feb 2021 10:11:12 GMT`` to a timestamp (the weekday is implied)."""
    return F.try_to_timestamp(F.substring(lit_or_col(c), 6, 20), F.lit("dd MMM yyyy HH:mm:ss"))


def local_to_utc(c, zone) -> Column:
    """Wall-clock timestamp of ``zone`` to UTC wall clock."""
    zone = zone if isinstance(zone, Column) else F.lit(zone)
    return F.convert_timezone(zone, F.lit("UTC"), lit_or_col(c).cast("timestamp_ntz"))


def render_token(token, cob) -> Column:
    """Render one date token (``YYYYMMDD``, ``YYYY``, ``MON`` ...) for a COB. The
    numeric parts are cut out of the COB's digits; names and times, which few
    templates use, are only worked out for tokens that hold them."""
    token, digits = lit_or_col(token), lit_or_col(cob).cast("string")

    def fill(text, values):
        for name, value in values.items():
            text = F.replace(text, F.lit(name), value)
        return text

    year = F.substring(digits, 1, 4)
    numbers = {"YYYY": year, "YY": F.substring(digits, 3, 2), "MM": F.substring(digits, 5, 2), "DD": F.substring(digits, 7, 2)}
    day = cob_date(cob)
    words = {"MON": F.date_format(day, "MMM"), "DY": F.date_format(day, "E")}
    words |= {name: F.lit("00") for name in ("HH24", "MI", "SS")}
    # year first: a name put in earlier could not contain these tokens, digits never do
    wordy = fill(fill(token, {"YYYY": year, "YY": numbers["YY"]}), words)
    return F.when(F.rlike(token, F.lit("MON|DY|HH24|MI|SS")), fill(wordy, {"MM": numbers["MM"], "DD": numbers["DD"]})).otherwise(
        fill(token, numbers)
    )


def day_parts(day) -> dict[str, Column]:
    """Calendar attributes of a date; ``day_of_week`` counts from 0 = Sunday."""
    day = lit_or_col(day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "month_name_year": F.date_format(day, "MMM-yy"),
        "week_num": F.weekofyear(day),
        "day_num": F.day(day),
        "day_name": F.date_format(day, "E"),
        "day_of_week": F.dayofweek(day) - 1,
        "day_of_year": F.dayofyear(day),
    }
