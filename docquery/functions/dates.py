"""`date` fields: strict ISO-8601 shapes or epoch numbers <-> TIMESTAMP in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.stored import as_long, as_string, null

# The format names of each accepted shape, and the format that holds when a field names none.
DAY_FORMATS = {
    "strict_date",
    "strict_year_month_day",
    "yyyy-MM-dd",
    "strict_date_optional_time",
    "strict_date_optional_time_nanos",
}
SECOND_FORMATS = {"strict_date_time_no_millis", "yyyy-MM-dd'T'HH:mm:ssZ"}
MILLI_FORMATS = {"strict_date_optional_time", "strict_date_time", "yyyy-MM-dd'T'HH:mm:ss.SSSZ"}
MICRO_FORMATS = {"strict_date_optional_time_nanos", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ"}
DEFAULT_FORMAT = "strict_date_optional_time||epoch_millis"

# Formats whose time part may be left out; by default they also load whole seconds,
# which is what dumping a timestamp without a fraction writes.
OPTIONAL_TIME = {"strict_date_optional_time", "strict_date_optional_time_nanos"}

# Length and shape of each accepted text.
DAY = (10, r"^\d{4}-\d{2}-\d{2}$")
SECOND = (20, r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
MILLI = (24, r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$")
MICRO = (27, r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$")

# First second of year 0 and last of year 9999, beyond which no timestamp is made.
EPOCH_SECONDS = (-62_167_219_200, 253_402_300_799)


def formats_of(format: str | None) -> list[str]:
    return (format or DEFAULT_FORMAT).split("||")


def load_date(
    col: Column, format: str | None = None, dtype: T.DataType | None = None, mode: str = "default"
) -> Column:
    """TIMESTAMP of a stored date, NULL when no format fits.

    The `||`-separated formats are tried in order. `mode="exact"` accepts
    only the fixed shapes above; the default mode also loads whole seconds
    under the optional-time formats.
    """
    dtype = dtype or T.StringType()
    if isinstance(dtype, (T.TimestampType, T.DateType, T.TimestampNTZType)):
        return col.cast("timestamp")
    text, number = as_string(col, dtype), as_long(col, dtype)
    attempts = []
    for name in formats_of(format):
        if name == "epoch_millis":
            attempts.append(_epoch(number, 1000, F.timestamp_millis))
        elif name == "epoch_second":
            attempts.append(_epoch(number, 1, F.timestamp_seconds))
        else:
            attempts.extend(_shape(text, shape) for shape in _shapes(name, mode))
    return F.coalesce(*attempts) if attempts else null("timestamp")


def dump_date(col: Column, format: str | None = None, dtype: T.DataType | None = None) -> Column:
    """Write a DATE or TIMESTAMP with the first format; a value the format does not suit becomes ISO text.

    Optional-time formats leave out a zero fraction, the others always write it.
    """
    dtype = dtype or T.TimestampType()
    name = formats_of(format)[0]
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    if name == "epoch_millis":
        return F.unix_millis(col.cast("timestamp"))
    if name == "epoch_second":
        return F.unix_seconds(col.cast("timestamp"))
    if name in SECOND_FORMATS:
        return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    if name in MILLI_FORMATS:
        return _with_fraction(col, 3, name in OPTIONAL_TIME)
    if name in MICRO_FORMATS:
        return _with_fraction(col, 6, name in OPTIONAL_TIME)
    return _with_fraction(col, 6, True)


def dumps_text(format: str | None, dtype: T.DataType) -> bool:
    """Whether `dump_date` writes text; only a timestamp with an epoch format is written as a number."""
    epoch = formats_of(format)[0] in ("epoch_millis", "epoch_second")
    return not epoch or isinstance(dtype, (T.DateType, T.StringType))


def _shapes(name: str, mode: str) -> list[tuple[int, str]]:
    shapes = []
    if name in DAY_FORMATS:
        shapes.append(DAY)
    if name in SECOND_FORMATS or (mode != "exact" and name in OPTIONAL_TIME):
        shapes.append(SECOND)
    if name in MILLI_FORMATS:
        shapes.append(MILLI)
    if name in MICRO_FORMATS:
        shapes.append(MICRO)
    return shapes


def _shape(text: Column, shape: tuple[int, str]) -> Column:
    length, pattern = shape
    fits = (F.length(text) == length) & text.rlike(pattern)
    instant = F.concat(text, F.lit("T00:00:00Z")) if shape is DAY else text
    return F.when(fits, instant.try_cast("timestamp"))


def _epoch(number: Column, per_second: int, convert) -> Column:
    low, high = EPOCH_SECONDS
    return F.when(number.between(low * per_second, high * per_second + per_second - 1), convert(number))


def _with_fraction(col: Column, digits: int, optional: bool) -> Column:
    fraction = F.date_format(col, "S" * digits)
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    always = F.concat(whole, F.lit("."), fraction, F.lit("Z"))
    if not optional:
        return always
    return F.when(fraction == "0" * digits, F.concat(whole, F.lit("Z"))).otherwise(always)
