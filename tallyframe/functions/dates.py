"""Date parsing and calendar expressions; malformed input gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Wire format of epoch dates (offset optional and ignored) and the open end.
EPOCH_DATE_PATTERN = r"^/Date\((-?\d+)([+-]\d{4})?\)/$"
OPEN_END = "9999-12-31"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def epoch_timestamp(text) -> Column:
    """``/Date(ms+zzzz)/`` as a zone-free UTC timestamp."""
    ms = F.regexp_extract(_c(text), EPOCH_DATE_PATTERN, 1).try_cast("bigint")
    return F.to_utc_timestamp(F.timestamp_millis(ms), F.current_timezone()).cast("timestamp_ntz")


def epoch_date(text) -> Column:
    """``/Date(ms+zzzz)/`` as UTC date, independent of the session time zone."""
    ms = F.regexp_extract(_c(text), EPOCH_DATE_PATTERN, 1).try_cast("bigint")
    return F.date_from_unix_date(F.floor(ms / F.lit(86400000)).cast("int"))


def iso_date(text) -> Column:
    """Date from the first ten characters of an ISO date or datetime."""
    return F.substring(_c(text), 1, 10).try_cast("date")


def iso_datetime(text) -> Column:
    """Zone-free datetime; fractions beyond microseconds are cut, a zone suffix is dropped."""
    c = _c(text)
    t = F.regexp_replace(c, r"(Z|[+-]\d{2}:?\d{2})$", "")
    cut = F.regexp_replace(t, r"(\.\d{6})\d+$", "$1")
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d"), cut.try_cast("timestamp_ntz"))


def any_date(text, *, period_format: str = "yyyyMM") -> Column:
    """Date from DATE, DATETIME, TIMESTAMP or period text, tried in this order."""
    c = _c(text)
    day = F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), c.try_cast("date"))
    moment = iso_datetime(c).cast("date")
    period = F.when(c.rlike(r"^\d{6}$"), F.try_to_date(F.concat(c, F.lit("01")), period_format + "dd"))
    return F.coalesce(day, moment, period)


def date_key(day) -> Column:
    """Integer ``yyyymmdd``."""
    return F.date_format(_c(day), "yyyyMMdd").cast("int")


def month_index(day) -> Column:
    """Months since year zero, for bucketing ranges."""
    return F.year(_c(day)) * 12 + F.month(_c(day)) - 1


def clamped_date(year, month, day) -> Column:
    """Date of year, month and day; a day past the month end becomes the month end."""
    first = F.make_date(_c(year), _c(month), F.lit(1))
    return F.least(F.date_add(first, _c(day) - 1), F.last_day(first))


def fiscal_year_start(report_date, end_month, end_day) -> Column:
    """First day of the fiscal year that contains ``report_date``."""
    d = _c(report_date)
    this_end = clamped_date(F.year(d), end_month, end_day)
    prev_end = clamped_date(F.year(d) - 1, end_month, end_day)
    return F.date_add(F.when(d <= this_end, prev_end).otherwise(this_end), 1)


def within(day, start, end) -> Column:
    """``day`` inside [start, end]; a NULL end is open."""
    return (_c(day) >= _c(start)) & (_c(end).isNull() | (_c(day) <= _c(end)))


def in_half_open(day, start, end) -> Column:
    return (_c(day) >= start) & (_c(day) < end)
