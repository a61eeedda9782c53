"""Column expressions used by the jobs. All built-in, so they stay in codegen."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import code_maps as cm


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_utc(c, zone: str = cm.LEGACY_ZONE) -> Column:
    """Legacy wall-clock time -> UTC wall-clock time (both TIMESTAMP_NTZ).

    DST aware. In the spring gap the time moves forward; in the autumn
    overlap the first (daylight) instant is taken.
    """
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col(c))


def to_local(c, zone: str = cm.LEGACY_ZONE) -> Column:
    """UTC wall-clock time -> legacy wall-clock time (TIMESTAMP_NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col(c))


def to_utc_later(c, zone: str = cm.LEGACY_ZONE) -> Column:
    """The last UTC time that legacy wall-clock ``c`` may stand for.

    Inside the autumn overlap that is the second (standard) reading, an hour
    after ``to_utc``; elsewhere both are the same. Zones that turn back by an
    hour.
    """
    second = to_utc(c, zone) + F.expr("INTERVAL 1 HOUR")
    return F.when(to_local(second, zone) == col(c), second).otherwise(to_utc(c, zone))


def month_end(year, month) -> Column:
    """Last day of (year, month) as DATE; NULL for impossible parts.

    CASE evaluates ``make_date`` only for valid parts, so ANSI mode never
    raises on month 0 or 13.
    """
    y, m = col(year), col(month)
    valid = (m >= 1) & (m <= 12) & (y >= 1) & (y <= 9999)
    return F.last_day(F.when(valid, F.make_date(y, m, F.lit(1))))


def left_n(c, n: int) -> Column:
    """First ``n`` characters (explicit width conversions truncate)."""
    return F.substring(col(c), 1, n)


def nonblank(c) -> Column:
    """Not NULL and not empty after trailing blanks are ignored."""
    c = col(c)
    return c.isNotNull() & (F.rtrim(c) != F.lit(""))


def blank_to_null(c, n: int) -> Column:
    """First ``n`` characters, NULL when they are blank (value not trimmed)."""
    head = left_n(c, n)
    return F.when(F.rtrim(head) == F.lit(""), F.lit(None).cast("string")).otherwise(head)


def cents_to_units(c) -> Column:
    """Integer cents -> decimal(18,2) units, exact."""
    return (col(c) * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def try_bigint(c) -> Column:
    """Text -> bigint, NULL when not an integer ('12.5', '1e3', 'K12')."""
    return col(c).try_cast("bigint")


def ymd_timestamp(year, month, day) -> Column:
    """Timestamp from three parts given as numbers; NULL for a bad date."""
    text = F.concat(col(year).cast("string"), F.lit("-"), col(month).cast("string"),
                    F.lit("-"), col(day).cast("string"))
    return text.try_cast("date").cast("timestamp_ntz")


def add_years(c, n: int) -> Column:
    """Keeps the time of day; 29 Feb + 1 year = 28 Feb."""
    return col(c) + F.make_ym_interval(F.lit(n), F.lit(0))


def person_ok(ssn="ssn", first_name="firstname") -> Column:
    """Sentinel exclusion for person records (dummy ssn, placeholder name)."""
    s, f = col(ssn), col(first_name)
    return (nonblank(s) & ~F.rtrim(s).isin(*cm.SENTINEL_SSNS)
            & (F.rtrim(f) != F.lit(cm.SENTINEL_FIRST_NAME)))


def ntz(value) -> Column:
    """TIMESTAMP_NTZ literal (a plain literal keeps parquet pushdown).

    A Python datetime goes through its text form, so the session and driver
    time zones never shift it.
    """
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")
