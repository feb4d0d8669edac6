"""Calendar days spelled in several ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\u000b\u00a0\u2009\u202f\u3000"


def spelled_day(text: Column) -> Column:
    """The day named by ``YYYY-MM-DD`` or ``YYYYMMDD``, blanks around it or a time after it, as a date; null where the
    text names no full, valid day."""
    s = F.btrim(text, F.lit(BLANKS))
    part = lambda a, n: F.substring(s, a, n)
    iso = F.when(part(5, 1) == "-", part(1, 10)).otherwise(F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2)))
    day = F.when(s.rlike(r"^(?:\d{4}-\d{2}-\d{2}|\d{8})(?:[Tt ].*)?$"), iso).try_cast("date")
    return F.when(day >= F.lit("0001-01-01").cast("date"), day)  # there is no year 0


def utc_day(stamp: Column) -> Column:
    """Days since 1970-01-01 of a timestamp's UTC calendar day, whatever the session's time zone."""
    day = 86_400_000_000
    micros = F.unix_micros(stamp)
    return ((micros - F.pmod(micros, F.lit(day))) / F.lit(day)).cast("int")
