"""Which cast belongs to which mapping entry."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import types as T

from docquery.functions import addresses, dates, shapes
from docquery.functions.stored import as_string

Cast = Callable[[Column, T.DataType, dict], Column]


@dataclass(frozen=True)
class FieldCast:
    """Load and dump for the mapping entries that contain `matches`.

    `load` gets the stored column, its type and the mapping entry, and gives
    the typed value or NULL. `dump` is the inverse. `writes_text` tells whether
    dump gives a STRING, into which values that were never castable can return.
    """

    matches: dict
    load: Cast
    dump: Cast
    writes_text: Callable[[dict, T.DataType], bool] = lambda field, dtype: True

    def fits(self, field: dict) -> bool:
        return all(field.get(key) == value for key, value in self.matches.items())


class CastRegistry:
    """An ordered list of casts; inherited ones come first and so win.

    To replace a built-in cast, make a registry that does not inherit it.
    """

    def __init__(self, casts: Iterable[FieldCast] = (), inherit: CastRegistry | None = None):
        self.casts = [*(inherit.casts if inherit else ()), *casts]

    def find(self, field: dict | None) -> FieldCast | None:
        return next((cast for cast in self.casts if field and cast.fits(field)), None)


def _load_date(col: Column, dtype: T.DataType, field: dict) -> Column:
    return dates.load_date(col, field.get("format"), dtype, field.get("mode", "default"))


def _dump_date(col: Column, dtype: T.DataType, field: dict) -> Column:
    return dates.dump_date(col, field.get("format"), dtype)


def _date_is_text(field: dict, dtype: T.DataType) -> bool:
    return dates.dumps_text(field.get("format"), dtype)


def _load_date_range(col: Column, dtype: T.DataType, field: dict) -> Column:
    return shapes.load_date_range(col, dtype, field.get("format"), field.get("mode", "default"))


BUILT_IN = CastRegistry(
    [
        FieldCast({"type": "date"}, _load_date, _dump_date, _date_is_text),
        FieldCast({"type": "date_nanos"}, _load_date, _dump_date, _date_is_text),
        FieldCast(
            {"type": "date_range"},
            _load_date_range,
            lambda col, dtype, field: shapes.dump_date_range(col, field.get("format")),
            lambda field, dtype: False,
        ),
        FieldCast(
            {"type": "integer_range"},
            lambda col, dtype, field: shapes.load_int_range(col, dtype),
            lambda col, dtype, field: shapes.dump_range(col),
            lambda field, dtype: False,
        ),
        FieldCast(
            {"type": "ip"},
            lambda col, dtype, field: addresses.load_ip(as_string(col, dtype)),
            lambda col, dtype, field: addresses.dump_ip(col),
        ),
        FieldCast(
            {"type": "binary"},
            lambda col, dtype, field: shapes.load_binary(as_string(col, dtype)),
            lambda col, dtype, field: shapes.dump_binary(col),
        ),
        FieldCast(
            {"type": "geo_point"},
            lambda col, dtype, field: shapes.load_geo(col, dtype),
            lambda col, dtype, field: shapes.dump_geo(col),
            lambda field, dtype: False,
        ),
    ]
)
