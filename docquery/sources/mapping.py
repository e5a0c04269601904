"""Mappings (`{"properties": {field: {"type": ..., "format": ...}}}`) as Spark schemas, and schema merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.stored import NESTED, NUMERIC, null

# The Spark type each mapping type is stored in before casting.
STORED_TYPES = {
    "text": "string",
    "keyword": "string",
    "boolean": "boolean",
    "byte": "tinyint",
    "short": "smallint",
    "integer": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "date": "string",
    "date_nanos": "string",
    "ip": "string",
    "binary": "string",
    "geo_point": "struct<lat:double,lon:double>",
    "integer_range": "struct<gte:bigint,lte:bigint>",
    "date_range": "struct<gte:string,lte:string>",
}


def schema_of(mapping: dict) -> T.StructType:
    """The stored schema of a mapping; type and format are kept as field metadata."""
    fields = []
    for name, entry in mapping.get("properties", {}).items():
        if "properties" in entry:
            dtype = schema_of(entry)
        else:
            dtype = T.DataType.fromDDL(STORED_TYPES.get(entry.get("type"), "string"))
        metadata = {k: v for k, v in entry.items() if k != "properties"}
        fields.append(T.StructField(name, dtype, True, metadata))
    return T.StructType(fields)


def mapping_of(schema: T.StructType) -> dict:
    """A mapping for a schema; field metadata written by `schema_of` wins over the Spark type."""
    by_type = {ddl: name for name, ddl in reversed(STORED_TYPES.items())}
    properties = {}
    for field in schema.fields:
        dtype = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
        if "type" in field.metadata:
            properties[field.name] = dict(field.metadata)
        elif isinstance(dtype, T.StructType):
            properties[field.name] = mapping_of(dtype)
        elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            properties[field.name] = {"type": "date"}
        else:
            properties[field.name] = {"type": by_type.get(dtype.simpleString(), dtype.simpleString())}
    return {"properties": properties}


def merge(schemas: list[T.StructType]) -> T.StructType:
    """One schema that holds all: fields of every input, conflicting ones as STRING."""
    return reduce(_merge_two, schemas)


def reshape(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """`col` in the wanted type: missing fields as NULL, conflicting ones as text."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        parts = [
            (reshape(col.getField(f.name), have[f.name].dataType, f.dataType) if f.name in have.names else null(f.dataType))
            .alias(f.name, metadata=f.metadata or None)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: reshape(x, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, NESTED):
        return F.to_json(col)
    return col.cast(want)


def conform(df: DataFrame, mapping: dict) -> DataFrame:
    """Bring a table to a mapping: new fields are added as NULL, nested ones too.

    Fields the mapping does not name stay. A field that would change its type is an error.
    """
    have = df.schema["_source"].dataType
    want = _extended(have, schema_of(mapping), ())
    return df.withColumn("_source", reshape(F.col("_source"), have, want))


def _extended(have: T.StructType, mapped: T.StructType, path: tuple) -> T.StructType:
    fields = []
    for field in have.fields:
        if field.name not in mapped.names:
            fields.append(field)
            continue
        entry = mapped[field.name]
        element = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else field.dataType
        if isinstance(element, T.StructType) and isinstance(entry.dataType, T.StructType):
            inner = _extended(element, entry.dataType, (*path, field.name))
            dtype = T.ArrayType(inner) if isinstance(field.dataType, T.ArrayType) else inner
        elif element.simpleString() == entry.dataType.simpleString() or _date_like(element, entry):
            dtype = field.dataType
        else:
            name = ".".join((*path, field.name))
            raise ValueError(f"{name} is {element.simpleString()}, the mapping says {entry.dataType.simpleString()}")
        fields.append(T.StructField(field.name, dtype, True, entry.metadata))
    return T.StructType(fields + [f for f in mapped.fields if f.name not in have.names])


def _date_like(dtype: T.DataType, entry: T.StructField) -> bool:
    typed = isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType, T.LongType))
    return typed and entry.metadata.get("type") in ("date", "date_nanos")


def _merge_two(a: T.StructType, b: T.StructType) -> T.StructType:
    fields = [
        T.StructField(f.name, _merged_type(f.dataType, b[f.name].dataType) if f.name in b.names else f.dataType, True, f.metadata)
        for f in a.fields
    ]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True, f.metadata) for f in b.fields if f.name not in a.names])


def _merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _merge_two(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_merged_type(a.elementType, b.elementType))
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if isinstance(a, whole) and isinstance(b, whole):
        return max(a, b, key=lambda t: whole.index(type(t)))
    exact_in_double = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)
    if isinstance(a, NUMERIC) and isinstance(b, NUMERIC) and isinstance(a, exact_in_double) and isinstance(b, exact_in_double):
        return T.DoubleType()
    return T.StringType()
