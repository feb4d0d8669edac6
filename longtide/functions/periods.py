"""Period codes as dates. One grammar per family of sources; each is a column expression that gives null for anything
that is no period of it. An annual code means the year's last day in the statistical-table and SDMX grammars, its first
day in the wide-TSV one; labels are never re-stamped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _day(y: Column, m: Column | str, d: Column | str) -> Column:
    part = lambda x: F.lit(x) if isinstance(x, str) else F.lpad(x.cast("string"), 2, "0")
    return _real(F.concat_ws("-", y, part(m), part(d)).try_cast("date"))


def _real(day: Column) -> Column:
    """Years 1 to 9999; there is no year 0."""
    return F.when(day >= F.lit("0001-01-01").cast("date"), day)


def _num(s: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(s, pattern, group).try_cast("int")


def iso_week_start(year: Column, week: Column) -> Column:
    """Monday of an ISO week; null for a 53rd week in a year of 52."""
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "WEEK")
    monday = F.date_add(first, (week - 1) * 7)
    return F.when(week.between(1, 53) & (F.extract(F.lit("YEAROFWEEK"), monday) == year), monday)


def _quarter(y: Column, q: Column) -> Column:
    return F.when(q.between(1, 4), _day(y, (q - 1) * 3 + 1, "01"))


def _half(y: Column, h: Column) -> Column:
    return F.when(h == 1, _day(y, "01", "01")).when(h == 2, _day(y, "07", "01"))


def _cases(s: Column, cases: list[tuple[str, Column]]) -> Column:
    out = None
    for pattern, value in cases:
        out = F.when(s.rlike(pattern), value) if out is None else out.when(s.rlike(pattern), value)
    return out


def table_period(code: Column) -> Column:
    """Codes of statistical tables: YYYY, YYYYMmm, YYYY-MM, YYYYMM, YYYYQq or Kq, YYYYHh, YYYYWww, YYYY-MM-DD, YYYYMmmDdd and
    the split year YYYY-(YYYY+1), which is dated by its first."""
    s = F.upper(F.trim(code))
    y = F.substring(s, 1, 4)
    yi = y.try_cast("int")
    return _cases(s, [
        (r"^\d{4}$", _day(y, "12", "31")),
        (r"^\d{4}M\d{2}$", _day(y, _num(s, r"M(\d{2})$", 1), "01")),
        (r"^\d{4}-\d{2}$", _day(y, _num(s, r"-(\d{2})$", 1), "01")),
        (r"^\d{4}[QK]\d$", _quarter(y, _num(s, r"(\d)$", 1))),
        (r"^\d{4}H\d$", _half(y, _num(s, r"(\d)$", 1))),
        (r"^\d{4}W\d{2}$", iso_week_start(yi, _num(s, r"W(\d{2})$", 1))),
        (r"^\d{4}-\d{2}-\d{2}$", _real(s.try_cast("date"))),
        (r"^\d{6}$", _day(y, _num(s, r"(\d{2})$", 1), "01")),
        (r"^\d{4}M\d{2}D\d{2}$", _day(y, _num(s, r"M(\d{2})", 1), _num(s, r"D(\d{2})$", 1))),
        (r"^\d{4}-\d{4}$", F.when(_num(s, r"-(\d{4})$", 1) == yi + 1, _day(y, "12", "31"))),
    ])


def sdmx_period(code: Column) -> Column:
    """TIME_PERIOD of SDMX messages: YYYY (last day), YYYY-MM, YYYY-Qq, YYYY-Sh, YYYY-Www, YYYY-MM-DD, and a year with -A."""
    s = F.trim(code)
    y = F.substring(s, 1, 4)
    return _cases(s, [
        (r"^\d{4}$", _day(y, "12", "31")),
        (r"^\d{4}-Q\d$", _quarter(y, _num(s, r"(\d)$", 1))),
        (r"^\d{4}-S\d$", F.when(s.endswith("1"), _day(y, "01", "01")).otherwise(_day(y, "07", "01"))),
        (r"^\d{4}-\d{2}$", _day(y, _num(s, r"(\d{2})$", 1), "01")),
        (r"^\d{4}-W\d{2}$", iso_week_start(y.try_cast("int"), _num(s, r"(\d{2})$", 1))),
        (r"^\d{4}-\d{2}-\d{2}$", _real(s.try_cast("date"))),
        (r"^\d{4}.*-A", _day(y, "12", "31")),
    ])


def tsv_period(code: Column) -> Column:
    """Heads of wide TSV files, as a struct of ``date`` and frequency letter ``freq``: YYYY (first day, A), YYYY-Qq, YYYY-Sh,
    YYYY-MM, YYYY-Www, YYYY-MM-DD. Both fields are null for anything else."""
    s = F.trim(code)
    y = F.substring(s, 1, 4)
    rules = [
        (r"^\d{4}$", _day(y, "01", "01"), "A"),
        (r"^\d{4}-?Q[1-4]$", _quarter(y, _num(s, r"(\d)$", 1)), "Q"),
        (r"^\d{4}-?S[12]$", _half(y, _num(s, r"(\d)$", 1)), "S"),
        (r"^\d{4}-\d{2}-\d{2}$", _real(s.try_cast("date")), "D"),
        (r"^\d{4}-\d{2}$", _day(y, _num(s, r"(\d{2})$", 1), "01"), "M"),
        (r"^\d{4}-?W\d{2}$", iso_week_start(y.try_cast("int"), _num(s, r"(\d{2})$", 1)), "W"),
    ]
    date = _cases(s, [(p, d) for p, d, _ in rules])
    freq = _cases(s, [(p, F.lit(f)) for p, _, f in rules])
    return F.struct(date.alias("date"), F.when(date.isNotNull(), freq).alias("freq"))


def frequency_of_gap(days: Column) -> Column:
    """Bucket of a median gap in days between observations."""
    return (
        F.when(days <= 3.5, "daily").when(days <= 10, "weekly").when(days <= 45, "monthly").when(days <= 135, "quarterly").when(days <= 550, "annual").when(days.isNotNull(), "multi-year")
    )


def period_label_of_gap(date: Column, median_gap: Column) -> Column:
    """The period that a date stands for in a series of that median gap: a year, quarter, month or day, as text."""
    return (
        F.when(median_gap >= 200, F.date_format(date, "yyyy"))
        .when(median_gap >= 60, F.concat(F.date_format(date, "yyyy"), F.lit("Q"), F.quarter(date)))
        .when(median_gap >= 20, F.date_format(date, "yyyy-MM"))
        .otherwise(F.date_format(date, "yyyy-MM-dd"))
    )
