"""Months as ``YYYYMM`` text and as first-of-month dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_start(c: Column) -> Column:
    """First day of the month a date falls in."""
    return F.trunc(c, "month")


def month_code(c: Column) -> Column:
    """``YYYYMM`` of a date."""
    return F.date_format(c, "yyyyMM")


def month_from_code(code: Column) -> Column:
    """First day of a ``YYYYMM`` month; NULL where the text is no such month."""
    text = F.concat_ws("-", F.substring(code, 1, 4), F.substring(code, 5, 2), F.lit("01"))
    return F.when(code.rlike(r"^[0-9]{4}(0[1-9]|1[0-2])$"), text.try_cast("date"))


def months_between_codes(start: Column, end: Column) -> Column:
    """All ``YYYYMM`` codes from ``start`` to ``end``; empty where either is no month or they cross."""
    first, last = month_from_code(start), month_from_code(end)
    return F.when(
        first.isNotNull() & last.isNotNull() & (first <= last),
        F.transform(F.sequence(first, last, F.expr("interval 1 month")), month_code),
    ).otherwise(F.array().cast("array<string>"))


def last_months(day: Column, count: int = 120) -> Column:
    """The ``count`` month codes ending with the month of ``day``, oldest first."""
    last = month_start(day)
    return F.transform(F.sequence(F.add_months(last, 1 - count), last, F.expr("interval 1 month")), month_code)


def collection_window(window: Column, day: Column) -> Column:
    """Start and end ``YYYYMM`` of a collection window: ``10y`` reaches 3650 days back."""
    end = month_code(day)
    start = F.when(window == "10y", month_code(F.date_sub(day, 3650))).otherwise(end)
    return F.struct(start.alias("start_ym"), end.alias("end_ym"))


def loose_date(year: Column, month: Column, day: Column) -> Column:
    """Date from year, month and day numbers; NULL where they form none."""
    text = F.concat_ws(
        "-",
        F.lpad(year.cast("string"), 4, "0"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lpad(day.cast("string"), 2, "0"),
    )
    # Padding cuts longer numbers, so their range is checked first.
    plausible = year.between(1, 9999) & month.between(1, 12) & day.between(1, 31)
    return F.when(plausible, text.try_cast("date"))


def padded_date(year: Column, month: Column, day: Column) -> Column:
    """Midnight of ``loose_date``."""
    return loose_date(year, month, day).cast("timestamp")


def frame_end(month: Column, end: Column) -> Column:
    """Last day shown in a month's frame: the month's end, but not past ``end``."""
    return F.least(F.last_day(month), end)


def utc_now_text() -> Column:
    """Current UTC time as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
