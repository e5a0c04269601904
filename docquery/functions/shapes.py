"""`binary`, `geo_point`, `integer_range` and `date_range` fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.dates import dump_date, load_date
from docquery.functions.stored import as_double, as_long, member

BASE64 = r"\A[A-Za-z0-9+/]*={0,2}\z"


def load_binary(col: Column) -> Column:
    """Bytes of padded Base64 text, NULL when it is not valid."""
    valid = (F.length(col) % 4 == 0) & col.rlike(BASE64)
    return F.when(valid, F.try_to_binary(col, F.lit("base64")))


def dump_binary(col: Column) -> Column:
    """Base64 in one line; depending on a setting, Spark breaks it after 76 characters."""
    return F.replace(F.base64(col), F.lit("\r\n"), F.lit(""))


def load_geo(col: Column, dtype: T.DataType) -> Column:
    """`{lat, lon}` as a point; text, array and geohash forms give NULL."""
    lat, lon = as_double(*member(col, dtype, "lat")), as_double(*member(col, dtype, "lon"))
    return F.when(
        lat.isNotNull() & lon.isNotNull() & _only(col, dtype, "lat", "lon"), F.struct(lat.alias("lat"), lon.alias("lon"))
    )


def dump_geo(col: Column) -> Column:
    return F.when(
        col.isNotNull(), F.struct(col.getField("lat").alias("lat"), col.getField("lon").alias("lon"))
    )


def load_int_range(col: Column, dtype: T.DataType) -> Column:
    """`{gte, lte}` with two integer bounds; any other shape gives NULL."""
    return F.when(_only(col, dtype, "gte", "lte"), _both(as_long(*member(col, dtype, "gte")), as_long(*member(col, dtype, "lte"))))


def load_date_range(col: Column, dtype: T.DataType, format: str | None = None, mode: str = "default") -> Column:
    """`{gte, lte}` with both bounds loaded as dates; any other shape gives NULL."""
    gte, gte_type = member(col, dtype, "gte")
    lte, lte_type = member(col, dtype, "lte")
    both = _both(
        load_date(gte, format, gte_type, mode).cast("date"),
        load_date(lte, format, lte_type, mode).cast("date"),
    )
    return F.when(_only(col, dtype, "gte", "lte"), both)


def dump_range(col: Column) -> Column:
    return _both(col.getField("gte"), col.getField("lte"))


def dump_date_range(col: Column, format: str | None = None) -> Column:
    day = T.DateType()
    return _both(
        dump_date(col.getField("gte"), format, day), dump_date(col.getField("lte"), format, day)
    )


def _only(col: Column, dtype: T.DataType, *names: str) -> Column:
    """Whether an object has no members but the named ones; a column's further fields must be NULL."""
    if isinstance(dtype, T.VariantType):
        return F.size(F.map_keys(F.try_variant_get(col, "$", "map<string,variant>"))) == len(names)
    further = [col.getField(n).isNull() for n in getattr(dtype, "names", []) if n not in names]
    return reduce(Column.__and__, further, F.lit(True))


def _both(gte: Column, lte: Column) -> Column:
    return F.when(gte.isNotNull() & lte.isNotNull(), F.struct(gte.alias("gte"), lte.alias("lte")))
