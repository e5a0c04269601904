"""The document table: `_index STRING, _id, _source STRUCT<...>`.

`_id` keeps the type it is stored in, so that key filters still reach the
parquet reader.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.session import fits_broadcast

Path = tuple[str, ...]


def as_documents(df: DataFrame, index: str, id_cols: str | list[str]) -> DataFrame:
    """Present a flat table as documents; every column goes into `_source`."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    key = F.col(ids[0]) if len(ids) == 1 else F.concat_ws("-", *ids)
    return df.select(
        F.lit(index).alias("_index"),
        key.alias("_id"),
        F.struct(*[F.col(quoted((c,))) for c in df.columns]).alias("_source"),
    )


def source_type(df: DataFrame) -> T.StructType:
    return df.schema["_source"].dataType


def quoted(path: Iterable[str]) -> str:
    return ".".join(f"`{p}`" for p in path)


def source(*path: str) -> Column:
    """Column of a document field, e.g. `source("address", "city")`."""
    return F.col(quoted(("_source", *path)))


def leaves(struct: T.StructType, prefix: Path = ()) -> Iterator[tuple[Path, T.DataType]]:
    """Every non-object field below `struct` with its path."""
    for field in struct.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from leaves(field.dataType, path)
        else:
            yield path, field.dataType


def build(struct: T.StructType, leaf: Callable[[Path, T.DataType], Column], prefix: Path = ()) -> Column:
    """A struct of the given shape with `leaf(path, type)` at every leaf.

    A nested object whose leaves are all NULL becomes NULL.
    """
    parts, below = [], []
    for field in struct.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            part = build(field.dataType, leaf, path)
        else:
            part = leaf(path, field.dataType)
        below.append(part.isNotNull())
        parts.append(part.alias(field.name))
    value = F.struct(*parts)
    if not prefix:
        return value
    present = below[0]
    for other in below[1:]:
        present = present | other
    return F.when(present, value)


def split_touched(table: DataFrame, batch: DataFrame, keys: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """`(untouched, touched)`: the rows a batch leaves alone, and those whose keys it has.

    With few keys the large table is only filtered, and just the touched rows go
    on into a join. With many the table is returned whole as touched, to be
    shuffled once.
    """
    ids = batch.select(*keys).distinct()
    if not fits_broadcast(ids):
        return None, table
    ids = F.broadcast(ids)
    untouched = table.join(ids, keys, "left_anti").select(table.columns)
    return untouched, table.join(ids, keys, "left_semi").select(table.columns)


def without(df: DataFrame, *names: str) -> list[str]:
    return [c for c in df.columns if c not in names]
