"""Column helpers. All of them are total: bad input becomes null, never an error."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# All that a decimal number is written with.  Looking at the letters first keeps junk
# away from the parser, which pays for each failure with an exception.
_NUMERIC = "0123456789+-.eE \t\n\r\x0b\x0c"
_LARGEST = 1.7976931348623157e308


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` uses it.

    The optimizer copies a plain expression into every place it is used, filters
    included; a value bound this way it can only move as a whole.
    """
    return F.get(F.transform(F.array(value), body), 0)


def number(text: Column) -> Column:
    """Text to double; blank, junk and non-finite text become null."""
    plain = (F.ltrim(text, F.lit(_NUMERIC)) == "") & (F.length(text) > 0)
    value = F.when(plain, text.try_cast("double"))
    return F.when(F.abs(value) <= _LARGEST, value)


# What time text looks like when no zone is named: no clock, or one that ends in digits.
_NO_ZONE = r"^[^:]*(:\d{1,2}(:\d{1,2}(\.\d*)?)?)?$"
# A clock of hours and minutes with a zone behind it.
_ZONE_AFTER_MINUTES = r"^(\S+[ T]\d{1,2}:\d{1,2}) ?([A-Za-z+-].*)$"


def instant(text: Column) -> Column:
    """ISO text to an instant, with text that names no zone read as UTC.

    Reads what a cast to timestamp reads, and a zone after hours and minutes as well.
    Text without a zone is read as a zone-free wall clock, so the result does not depend
    on ``spark.sql.session.timeZone``.  A year stands for its first day, a month
    likewise, a day for its midnight; text without a date is null, as it would mean
    another instant each day.
    """

    def of_wall(t: Column, wall: Column) -> Column:
        return (
            F.when(wall.isNull(), F.lit(None).cast("timestamp"))
            .when(t.rlike(_NO_ZONE), F.concat(wall.cast("string"), F.lit("Z")).try_cast("timestamp"))
            .otherwise(t.try_cast("timestamp"))
        )

    def of_text(t: Column) -> Column:
        def repaired(full: Column) -> Column:
            return F.when(full.try_cast("timestamp_ntz").isNotNull(), full.try_cast("timestamp"))

        with_seconds = F.regexp_replace(t, _ZONE_AFTER_MINUTES, "$1:00$2")
        read = let(t.try_cast("timestamp_ntz"), lambda wall: of_wall(t, wall))
        return F.coalesce(read, F.when(t.endswith("Z") | t.contains(":"), let(with_seconds, repaired)))

    return let(F.trim(text), of_text)


def instant_of_millis(text: Column) -> Column:
    """Epoch milliseconds, as text or number, to an instant."""
    return F.timestamp_millis(text.try_cast("double").try_cast("bigint"))


def wall_clock_utc(ts: Column) -> Column:
    """An instant as the zone-free UTC wall clock.

    Counted from the epoch, never through the session's own wall clock, which shows
    two instants alike when its clocks go back.
    """
    seconds = F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") / F.lit(1_000_000)
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def _utc(df: DataFrame, column: str) -> Column:
    instant_type = isinstance(df.schema[column].dataType, T.TimestampType)
    return wall_clock_utc(F.col(column)) if instant_type else F.col(column)


def iso_utc(df: DataFrame, column: str) -> Column:
    """A time column as ISO-8601 text in UTC; whole seconds carry no fraction."""
    ts = _utc(df, column)
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction != ".000000", fraction).otherwise(""),
        F.lit("+00:00"),
    )


def utc_day(df: DataFrame, column: str = "ts_utc") -> Column:
    """The UTC calendar day of a time column, as ``yyyy-MM-dd`` text."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        days = F.floor(F.unix_micros(column) / F.lit(86_400_000_000)).cast("int")
        return F.date_from_unix_date(days).cast("string")
    return F.to_date(column).cast("string")


def not_blank(text: Column) -> Column:
    """The text, or null when it is empty or only spaces."""
    return F.when(F.trim(text) != "", text)


def folder_value(path: Column, level: str) -> Column:
    """The value of a ``level=`` folder in a file's address, or null.

    The address is percent-encoded, and a folder Spark named may be escaped
    once more underneath; a plus sign stands for itself.
    """
    value = F.nullif(F.regexp_extract(path, f"{level}=([^/]+)", 1), F.lit(""))
    for _ in range(2):
        plain = F.replace(value, F.lit("+"), F.lit("%2B"))
        value = F.coalesce(F.try_url_decode(plain), value)
    return value


def action(value: Column, band: float) -> Column:
    """buy above ``band``, sell below ``-band``, hold from one to the other."""
    return F.when(value > band, "buy").when(value < -band, "sell").otherwise("hold")


def row_hash(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the columns, telling null from empty text.

    Each value is written with its length in front and a null as a bare dash,
    so no choice of values can imitate the borders between them.
    """
    parts = []
    for c in columns:
        text = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(
            F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.sha2(F.concat_ws("|", *parts), 256)


def row_hash_plain(columns: Sequence[str | Column]) -> Column:
    """SHA-256 over the values joined by two bars, null counted as empty text.

    For comparing against history that was hashed that way; values holding the
    separator can collide, which :func:`row_hash` rules out.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
        for c in columns
    ]
    return F.sha2(F.concat_ws("||", *parts), 256)
