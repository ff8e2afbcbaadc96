"""Tolerant event-time parsing and timestamp texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import step
from siftlake.functions.values import string_content

MICROS = 1_000_000
DAY_MICROS = 86_400 * MICROS

# The accepted calendar runs from year 1 to year 9999, in epoch seconds.
_FIRST_SECOND = -62_135_596_800
_END_SECOND = 253_402_300_800
# Fixed value: numbers from here on are milliseconds.
_MILLIS_FROM = 1e12

# Fixed patterns: date "T" time zone, and date blank time without a zone (taken as UTC).
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"
_DATE = r"\d{4}-\d{1,2}-(?:\d{1,2}| [1-9])"
_ZONE = r"(?:Z|[+-]\d{2}(?::[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?|[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?))"
_ZONED = rf"\A{_DATE}T{_CLOCK}(?:\.\d{{1,6}})?{_ZONE}\z"
_BLANK_SEPARATED = rf"(?U)\A{_DATE}\s+{_CLOCK}\z"


def parse_event_time(df: DataFrame, json_column: str) -> DataFrame:
    """Parse the JSON value in ``json_column``.

    Adds ``event_us`` (NULL when the value is no timestamp), ``event_offset_us``
    (the zone it was written in) and ``parse_error`` (a number outside the
    calendar). Drops ``json_column``.

    Written as short projections: a value used twice is a column of its own, and
    every generated method stays small enough for the JVM to compile.
    """
    value = F.col(json_column)
    df = step(
        df,
        _text=F.upper(string_content(value)),
        _number=F.when(value == "true", F.lit(1.0))
        .when(value == "false", F.lit(0.0))
        .when(F.translate(F.substring(value, 1, 1), "-0123456789", "") == "", value.try_cast("double")),
    )
    text, number = F.col("_text"), F.col("_number")
    df = step(
        df,
        _seconds=F.when(number < _MILLIS_FROM, number).otherwise(number / F.lit(1000.0)),
        _zone=F.when(
            text.contains("T") & text.rlike(_ZONED),
            F.when(text.endswith("Z"), F.lit("Z")).otherwise(F.regexp_extract(text, r"([+-][0-9:.]+)\z", 1)),
        ),
        _plain=~text.contains("T") & text.rlike(_BLANK_SEPARATED),
    )
    seconds, zone = F.col("_seconds"), F.col("_zone")
    near = (seconds > float(_FIRST_SECOND - 1)) & (seconds < float(_END_SECOND + 1))
    body = (
        F.when(zone.isNotNull(), F.substring(text, F.lit(1), F.length(text) - F.length(zone)))
        .when(F.col("_plain"), F.regexp_replace(text, r"(?U)\s+(?=\d{1,2}:)", "T"))
    )
    df = step(
        df,
        # Sign, hours, minutes, seconds, fraction, without separators; NULL in UTC.
        _offset=F.when(zone != "Z", F.translate(zone, ":.", "")),
        _whole=F.when(near, seconds).cast("bigint"),
        _body=body,
    ).drop("_text", "_plain", "_zone")
    offset, whole, body = F.col("_offset"), F.col("_whole"), F.col("_body")

    def digits(start: int, length: int) -> Column:
        return F.substring(offset, start, length).try_cast("bigint")

    df = step(
        df,
        # Half-even rounding of the fraction, as the usual double-based epoch conversion does.
        _number_us=whole * F.lit(MICROS).cast("bigint")
        + F.rint((seconds - whole) * F.lit(1e6)).cast("bigint"),
        # Year 0 is accepted by the cast but is not in the calendar.
        _instant=F.when(
            ~body.startswith("0000"),
            F.concat(F.replace(body, F.lit("- "), F.lit("-")), F.lit("Z")).try_cast("timestamp"),
        ),
        _shift=F.when(
            offset.isNotNull(),
            (digits(2, 2) * 3600 + digits(4, 2) * 60 + F.coalesce(digits(6, 2), F.lit(0)))
            * F.lit(MICROS).cast("bigint")
            + F.when(F.length(offset) > 7, F.rpad(F.substring(offset, 8, 6), 6, "0").try_cast("bigint"))
            .otherwise(F.lit(0)),
        ),
    ).drop("_whole", "_body", "_seconds")
    shift, micros = F.col("_shift"), F.col("_number_us")
    within = (micros >= F.lit(_FIRST_SECOND * MICROS)) & (micros < F.lit(_END_SECOND * MICROS))
    df = step(
        df,
        _number_us=F.when(within, micros),
        # An offset of a day or more is no offset, and the text no timestamp.
        _text_us=F.when(shift.isNull() | (shift < DAY_MICROS), F.unix_micros("_instant")),
        event_offset_us=F.when(offset.startswith("-"), -shift).otherwise(F.coalesce(shift, F.lit(0))),
    )
    kept = [c for c in df.columns if not c.startswith("_") and c != json_column]
    return df.select(
        *kept,
        F.coalesce(F.col("_number_us"), F.col("_text_us") - F.col("event_offset_us")).alias("event_us"),
        (number.isNotNull() & F.col("_number_us").isNull()).alias("parse_error"),
    )


def utc_clock(micros: Column) -> Column:
    """Epoch microseconds as a zone-free UTC timestamp, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def utc_date(timestamp: Column) -> Column:
    return utc_clock(F.unix_micros(timestamp)).cast("date")


def iso_text(micros: Column, offset_micros: Column) -> Column:
    """ISO-8601 text in the offset the timestamp was written with."""
    local = utc_clock(micros + offset_micros)
    seconds = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(
        F.pmod(micros + offset_micros, F.lit(MICROS)) != 0, F.date_format(local, ".SSSSSS")
    ).otherwise("")
    size = F.abs(offset_micros)
    clock = utc_clock(size)
    zone = F.concat(
        F.when(offset_micros < 0, "-").otherwise("+"),
        F.date_format(clock, "HH:mm"),
        F.when(F.pmod(size, F.lit(60 * MICROS)) != 0, F.date_format(clock, ":ss")).otherwise(""),
        F.when(F.pmod(size, F.lit(MICROS)) != 0, F.date_format(clock, ".SSSSSS")).otherwise(""),
    )
    return F.concat(seconds, fraction, zone)


def as_instant(value: object) -> Column:
    """A processing time: a Column, ISO text with zone, or None for the current time."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")
