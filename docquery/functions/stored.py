"""Reading a stored value by its JSON kind.

A stored field is a typed column (STRING, BIGINT, STRUCT...) or, for tables
without a schema, a VARIANT that may hold another kind in every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMERIC = (*INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)
NESTED = (T.StructType, T.ArrayType, T.MapType)


def null(ddl: str | T.DataType) -> Column:
    return F.lit(None).cast(ddl)


def as_string(col: Column, dtype: T.DataType) -> Column:
    """The value when it is a string, else NULL."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.VariantType):
        return F.when(F.schema_of_variant(col) == "STRING", F.try_variant_get(col, "$", "string"))
    return null("string")


def as_long(col: Column, dtype: T.DataType) -> Column:
    """The value when it is an integer, else NULL; `"0"` and `0.5` are not integers."""
    if isinstance(dtype, INTEGRAL):
        return col.cast("bigint")
    if isinstance(dtype, T.VariantType):
        return F.when(F.schema_of_variant(col) == "BIGINT", F.try_variant_get(col, "$", "bigint"))
    return null("bigint")


def as_double(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, NUMERIC):
        return col.cast("double")
    if isinstance(dtype, T.VariantType):
        numeric = F.schema_of_variant(col).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        return F.when(numeric, F.try_variant_get(col, "$", "double"))
    return null("double")


def member(col: Column, dtype: T.DataType, name: str) -> tuple[Column, T.DataType]:
    """A member of an object and its type; NULL when the value has no such member."""
    if isinstance(dtype, T.StructType) and name in dtype.names:
        return col.getField(name), dtype[name].dataType
    if isinstance(dtype, T.VariantType):
        return F.try_variant_get(col, f"$.{name}", "variant"), dtype
    return null("string"), T.StringType()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is worked out once per row, however often `body` uses it.

    Catalyst inlines a plain expression at every use, which for long casts
    grows past what it can compile.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_null(col: Column, dtype: T.DataType) -> Column:
    """NULL, or a VARIANT holding JSON null."""
    if isinstance(dtype, T.VariantType):
        return col.isNull() | F.is_variant_null(col)
    return col.isNull()


def as_text(col: Column, dtype: T.DataType) -> Column:
    """The value as text: strings as they are, anything else as JSON."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, NESTED):
        return F.to_json(col)
    if isinstance(dtype, T.VariantType):
        return F.coalesce(as_string(col, dtype), F.to_json(col))
    if isinstance(dtype, T.BinaryType):
        return F.replace(F.base64(col), F.lit("\r\n"), F.lit(""))
    return col.cast("string")
