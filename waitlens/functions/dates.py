"""Date helpers: lenient parsing, completed years, day counts, month starts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats ``ymd``/``dmy``/``as.Date`` accept in the reference's inputs.
DEFAULT_DATE_FORMATS: tuple[str, ...] = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd", "dd-MM-yyyy", "dd/MM/yyyy",
                                         "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "dd/MM/yyyy HH:mm:ss")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """Text, timestamp or date to DATE; impossible values become null."""
    x = _col(c).cast("string")
    return F.coalesce(*[F.try_to_date(x, fmt) for fmt in formats])


def completed_years(birth: Column | str, at: Column | str) -> Column:
    """Age in completed years at ``at``: the year difference, minus one when the
    birthday (month, day) is not reached yet (N16). Negative when ``birth`` is
    after ``at``, like ``floor`` of a negative interval."""
    b, a = _col(birth), _col(at)
    not_reached = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return (F.year(a) - F.year(b) - F.when(not_reached, 1).otherwise(0)).cast("int")


def days_between(start: Column | str, end: Column | str) -> Column:
    """Days from ``start`` to ``end``."""
    return F.datediff(_col(end), _col(start)).cast("int")


def day_fractions(start: Column | str, end: Column | str) -> Column:
    """Days from ``start`` to ``end`` as a fraction, to the microsecond
    (``difftime(end, start, units = "days")``); both are date-times (X8)."""
    micros = F.unix_micros(_col(end).cast("timestamp")) - F.unix_micros(_col(start).cast("timestamp"))
    return micros.cast("double") / F.lit(86_400_000_000.0)


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of the month from parts."""
    return F.make_date(_col(year), _col(month), F.lit(1))
