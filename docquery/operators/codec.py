"""Casting whole document tables by their mappings.

A cast field `f` becomes `f` (typed, NULL where it could not be cast) and
`f__raw STRING` (the stored value where it could not be cast), because one
column cannot hold both. All of it is one projection: no shuffle, no UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.json_text import rename_members, strip_members
from docquery.functions.registry import BUILT_IN, CastRegistry
from docquery.functions.stored import as_text, is_null, let, null
from docquery.model import quoted

RAW = "__raw"
ITEMS = "__items"
#: Mapping entries of one field, by the index they hold for; `None` holds for every row.
Entries = Mapping[str | None, dict]


# -- decode ---------------------------------------------------------------------------------------


def decode(df: DataFrame, mapping: dict | None, casts: CastRegistry = BUILT_IN) -> DataFrame:
    """Cast every mapped field at any depth; no mapping leaves the table as it is.

    Works on `_source`, or on the columns themselves for bare documents.
    """
    return _decode_table(df, {None: mapping} if mapping else {}, casts)


def decode_mixed(df: DataFrame, mappings: Mapping[str, dict | None], casts: CastRegistry = BUILT_IN) -> DataFrame:
    """Cast each row by the mapping of its own `_index`, in one pass over the table.

    Rows of an index without a mapping for a field that others cast keep their
    value in `f__raw`. Where two indices cast one field to different types, the
    first keeps the name `f` and the other is written to `f__<type>`.
    """
    return _decode_table(df, {i: m for i, m in mappings.items() if m}, casts)


def documents_in(df: DataFrame) -> DataFrame:
    """All documents found at any depth of a response-shaped table, one row each."""
    found = [_explode_path(df, path) for path in _document_paths(df.schema)]
    if not found:
        raise ValueError("no object with _index and _source in the schema")
    out = found[0]
    for other in found[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def _decode_table(df: DataFrame, mappings: Entries, casts: CastRegistry) -> DataFrame:
    if not mappings:
        return df
    if "_source" not in df.columns:
        return df.select(*_decode_fields(lambda n: F.col(quoted((n,))), df.schema, mappings, casts))
    body = df.schema["_source"].dataType
    if isinstance(body, T.VariantType):
        decoded = _decode_variant(F.col("_source"), mappings, casts)
        return df.withColumn("_document", F.col("_source")).withColumn("_source", decoded)
    fields = _decode_fields(lambda n: F.col("_source").getField(n), body, mappings, casts)
    return df.withColumn("_source", F.when(F.col("_source").isNotNull(), F.struct(*fields)))


def _decode_fields(get: Callable[[str], Column], struct: T.StructType, entries: Entries, casts: CastRegistry):
    out = []
    for field in struct.fields:
        own = {i: m["properties"][field.name] for i, m in entries.items() if field.name in m.get("properties", {})}
        out.extend(_decode_field(get(field.name), field.dataType, field.name, own, casts))
    return out


def _decode_field(col: Column, dtype: T.DataType, name: str, entries: Entries, casts: CastRegistry) -> list[Column]:
    objects = {i: m for i, m in entries.items() if "properties" in m}
    values = {i: m for i, m in entries.items() if casts.find(m)}
    if objects and values:
        raise ValueError(f"{name} is an object in {sorted(map(str, objects))} and a value in {sorted(map(str, values))}")

    if objects and isinstance(dtype, T.StructType):
        return [_decode_object(col, dtype, objects, casts).alias(name)]
    if objects and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return [F.transform(col, lambda x: _decode_object(x, dtype.elementType, objects, casts)).alias(name)]
    if not values:
        return [col.alias(name)]

    typed = _typed(col, dtype, name, values, casts)
    if isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        raw = F.transform(col, lambda x: _raw(x, element, _typed(x, element, name, values, casts)))
        if _is_set(values):
            typed = {label: _as_set(value) for label, value in typed.items()}
            raw = _as_set(raw)
        raw = F.when(F.exists(raw, lambda r: r.isNotNull()), raw)
    else:
        raw = _raw(col, dtype, typed)
    return [*[value.alias(label) for label, value in typed.items()], raw.alias(name + RAW)]


def _is_set(entries: Entries) -> bool:
    """Mapping entries with `"set": True` hold lists whose order and repeats mean nothing."""
    return all(field.get("set") for field in entries.values())


def _as_set(values: Column) -> Column:
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull()))


def _decode_object(col: Column, dtype: T.StructType, entries: Entries, casts: CastRegistry) -> Column:
    fields = _decode_fields(lambda n: col.getField(n), dtype, entries, casts)
    return F.when(col.isNotNull(), F.struct(*fields))


def _typed(col: Column, dtype: T.DataType, name: str, entries: Entries, casts: CastRegistry) -> dict[str, Column]:
    """Typed value per output label: one label per distinct cast, the first being the field's own name."""
    by_load: dict = {}
    for index, field in entries.items():
        by_load.setdefault(casts.find(field).load, []).append((index, field))
    out = {}
    for load, members in by_load.items():
        label = name if not out else f"{name}__{members[0][1]['type']}"

        def value(x: Column, t: T.DataType, load=load, members=members) -> Column:
            return F.coalesce(*[_where(index, load(x, t, field)) for index, field in members])

        out[label] = _each(col, dtype.elementType, value) if isinstance(dtype, T.ArrayType) else value(col, dtype)
    return out


def _each(col: Column, element: T.DataType, value: Callable) -> Column:
    return F.transform(col, lambda x: value(x, element))


def _where(index: str | None, value: Column) -> Column:
    return value if index is None else F.when(F.col("_index") == index, value)


def _raw(col: Column, dtype: T.DataType, typed: dict[str, Column]) -> Column:
    uncast = ~is_null(col, dtype)
    for value in typed.values():
        uncast = uncast & value.isNull()
    return F.when(uncast, as_text(col, dtype))


def _decode_variant(col: Column, entries: Entries, casts: CastRegistry) -> Column:
    """Mapped fields of a schemaless body; the whole body stays available as `_document`.

    A column has one type, so a list is found beside the field: `f__items` holds its
    elements, cast one by one, and `f__items__raw` those that do not fit, both by
    place. Where an object is mapped and neither one nor a list is found, the value
    goes to `f__raw` as JSON. Every value is looked up and cast once, however many fields come of it.
    """
    names = list(dict.fromkeys(n for m in entries.values() for n in m.get("properties", {})))
    own = {name: {i: m["properties"][name] for i, m in entries.items() if name in m.get("properties", {})} for name in names}

    def looked_up(value: Column) -> Column:
        items = F.when(_is_kind(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>"))
        return let(items, lambda of: F.struct(value.alias("value"), of.alias("items"), F.when(of.isNull(), value).alias("single")))

    def found(values: Column) -> Column:
        return F.struct(*[looked_up(values[f"v{n}"]).alias(f"v{n}") for n in range(len(names))])

    def cast(parts: Column) -> Column:
        out = []
        for n, name in enumerate(names):
            part = parts[f"v{n}"]
            objects = {i: m for i, m in own[name].items() if "properties" in m}
            if objects:
                both = [_variant_object(part["single"], name, objects, casts), _variant_objects(part["items"], name + ITEMS, objects, casts)]
            elif any(casts.find(m) for m in own[name].values()):
                both = [_variant_value(part["single"], name, own[name], casts), _variant_values(part["items"], name + ITEMS, own[name], casts)]
            else:
                both = [(F.struct(part["value"].alias(name)), [name])]
            out += both
        whole = F.struct(*[F.struct(pair.alias("of")).alias(f"p{k}") for k, (pair, _) in enumerate(out)])
        fields = [(k, label) for k, (_, labels) in enumerate(out) for label in labels]
        return let(whole, lambda w: F.struct(*[w[f"p{k}"]["of"].getField(label).alias(label) for k, label in fields]))

    values = F.struct(*[F.try_variant_get(col, f"$.{name}", "variant").alias(f"v{n}") for n, name in enumerate(names)])
    return let(values, lambda held: let(found(held), cast)) if names else F.struct()


def _variant_value(value: Column, name: str, entries: Entries, casts: CastRegistry) -> tuple[Column, list[str]]:
    """A struct of the typed values and the raw one, and the names of its fields."""
    labels = list(_typed(value, T.VariantType(), name, entries, casts))

    def with_raw(v: Column, typed: Column) -> Column:
        cast = {label: typed.getField(label) for label in labels}
        return F.struct(*[c.alias(label) for label, c in cast.items()], _raw(v, T.VariantType(), cast).alias(name + RAW))

    def one(v: Column) -> Column:
        typed = F.struct(*[c.alias(label) for label, c in _typed(v, T.VariantType(), name, entries, casts).items()])
        return let(typed, lambda t: with_raw(v, t))

    return let(value, one), [*labels, name + RAW]


def _variant_values(items: Column, name: str, entries: Entries, casts: CastRegistry) -> tuple[Column, list[str]]:
    """The same of a list, each field a list by place, or a set."""
    _, labels = _variant_value(items, name, entries, casts)
    of_set = _is_set(entries)

    def apart(cast: Column) -> Column:
        lists = [cast.getField(label) for label in labels]
        if of_set:
            lists = [_as_set(values) for values in lists]
        lists[-1] = F.when(F.exists(lists[-1], lambda r: r.isNotNull()), lists[-1])
        return F.struct(*[values.alias(label) for label, values in zip(labels, lists, strict=True)])

    return let(F.transform(items, lambda x: _variant_value(x, name, entries, casts)[0]), apart), labels


def _variant_object(value: Column, name: str, objects: Entries, casts: CastRegistry) -> tuple[Column, list[str]]:
    def one(v: Column) -> Column:
        fits = _is_kind(v, "OBJECT")
        body = F.when(fits, _decode_variant(v, objects, casts)).alias(name)
        return F.struct(body, F.when(~fits & ~is_null(v, T.VariantType()), F.to_json(v)).alias(name + RAW))

    return let(value, one), [name, name + RAW]


def _variant_objects(items: Column, name: str, objects: Entries, casts: CastRegistry) -> tuple[Column, list[str]]:
    def apart(cast: Column) -> Column:
        raws = cast.getField("v" + RAW)
        return F.struct(cast.getField("v").alias(name), F.when(F.exists(raws, lambda r: r.isNotNull()), raws).alias(name + RAW))

    return let(F.transform(items, lambda x: _variant_object(x, "v", objects, casts)[0]), apart), [name, name + RAW]


def _is_kind(value: Column, kind: str) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(kind)), F.lit(False))


def _document_paths(dtype: T.DataType, path: tuple = ()) -> list[tuple]:
    """Paths to document objects; `None` in a path stands for the elements of an array."""
    if isinstance(dtype, T.ArrayType):
        return _document_paths(dtype.elementType, (*path, None))
    if not isinstance(dtype, T.StructType):
        return []
    if {"_index", "_source"} <= set(dtype.names):
        return [path]
    return [p for f in dtype.fields for p in _document_paths(f.dataType, (*path, f.name))]


def _explode_path(df: DataFrame, path: tuple) -> DataFrame:
    if not path:
        return df
    out, current = df, None
    for step in path:
        if step is None:
            out, current = out.select(F.explode(current).alias("_at")), F.col("_at")
        else:
            current = F.col(quoted((step,))) if current is None else current.getField(step)
    return out.select(current.alias("_at")).filter("_at IS NOT NULL").select("_at.*")


# -- encode ---------------------------------------------------------------------------------------


def encode(df: DataFrame, mapping: dict | None, casts: CastRegistry = BUILT_IN) -> DataFrame:
    """The inverse of `decode`; no mapping leaves the table as it is.

    `f__raw` returns into `f` where `f` is stored as text; beside objects and
    numbers it is kept, so that nothing is lost.
    """
    if not mapping:
        return df
    entries = {None: mapping}
    if "_source" not in df.columns:
        return df.select(*_encode_fields(lambda n: F.col(quoted((n,))), df.schema, entries, casts))
    body = df.schema["_source"].dataType
    return df.withColumn("_source", _encode_object(F.col("_source"), body, entries, casts))


def encode_log(
    log: DataFrame, mappings: Mapping[str, dict | None], default_index: str | None = None, casts: CastRegistry = BUILT_IN
) -> DataFrame:
    """Encode the documents of an action log by each action's index.

    The whole document of an index or create and the partial document of an
    update are dumped; a delete has none. A row's own `_index` beats the default.
    """
    known = {i: m for i, m in mappings.items() if m}
    log = log.withColumn("_index", F.coalesce("_index", F.lit(default_index).cast("string")))
    body = _encode_object(F.col("doc"), log.schema["doc"].dataType, known, casts) if known else F.col("doc")
    return log.withColumn("doc", F.when(F.col("action") != "delete", body))


def _encode_object(col: Column, dtype: T.StructType, entries: Entries, casts: CastRegistry) -> Column:
    return F.when(col.isNotNull(), F.struct(*_encode_fields(lambda n: col.getField(n), dtype, entries, casts)))


def _encode_fields(get: Callable[[str], Column], struct: T.StructType, entries: Entries, casts: CastRegistry):
    out, merged = [], set()
    for field in struct.fields:
        name, dtype = field.name, field.dataType
        own = {i: m["properties"][name] for i, m in entries.items() if name in m.get("properties", {})}
        values = {i: m for i, m in own.items() if casts.find(m)}
        raw = get(name + RAW) if values and name + RAW in struct.names else None
        text = all(casts.find(m).writes_text(m, _element(dtype)) for m in values.values())
        if raw is not None and text:
            merged.add(name + RAW)
        else:
            raw = None
        out.append((name, _encode_field(get(name), dtype, raw, own, values, casts).alias(name)))
    return [column for name, column in out if name not in merged]


def _encode_field(col: Column, dtype: T.DataType, raw: Column | None, own: Entries, values: Entries, casts: CastRegistry):
    if values and isinstance(dtype, T.ArrayType):
        element = dtype.elementType
        if _is_set(values):
            dumped = F.transform(col, lambda x: _dumped(x, element, values, casts))
            return _as_set(dumped if raw is None else F.concat(dumped, F.coalesce(raw, F.array().cast("array<string>"))))
        if raw is None:
            return F.transform(col, lambda x: _dumped(x, element, values, casts))
        raws = F.coalesce(raw, F.transform(col, lambda x: null("string")))
        return F.zip_with(col, raws, lambda x, r: F.coalesce(_dumped(x, element, values, casts), r))
    if values:
        dumped = _dumped(col, dtype, values, casts)
        return dumped if raw is None else F.coalesce(dumped, raw)
    objects = {i: m for i, m in own.items() if "properties" in m}
    if objects and isinstance(dtype, T.StructType):
        return _encode_object(col, dtype, objects, casts)
    if objects and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
        return F.transform(col, lambda x: _encode_object(x, dtype.elementType, objects, casts))
    return col


def _dumped(col: Column, dtype: T.DataType, values: Entries, casts: CastRegistry) -> Column:
    return F.coalesce(*[_where(i, casts.find(m).dump(col, dtype, m)) for i, m in values.items()])


def _element(dtype: T.DataType) -> T.DataType:
    return dtype.elementType if isinstance(dtype, T.ArrayType) else dtype


# -- keys and blanks ------------------------------------------------------------------------------


def rename_keys(df: DataFrame, fn: Callable[[str], str], in_data: Callable[[Column], Column] | None = None) -> DataFrame:
    """Apply `fn` to every key: all levels of `_source` (or of a bare document), the top level of the rest.

    The keys of maps and of schemaless bodies are data; `in_data` is the same
    renaming as a column function, `F.upper` for `str.upper` say, and such a
    table needs it. Two keys of one object must not become equal.
    """
    hit = "_source" in df.columns

    def column(field: T.StructField) -> Column:
        col = F.col(quoted((field.name,)))
        if not hit or field.name == "_source":
            if _has_data_keys(field.dataType):
                if in_data is None:
                    raise ValueError(f"{field.name} has keys that are data; give in_data")
                col = _renamed_data(col, field.dataType, in_data)
            col = col.cast(_renamed(field.dataType, fn))
        return col.alias(fn(field.name))

    return df.select(*[column(field) for field in df.schema.fields])


def _has_data_keys(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_data_keys(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_data_keys(dtype.elementType)
    return isinstance(dtype, (T.MapType, T.VariantType))


def _renamed_data(col: Column, dtype: T.DataType, in_data: Callable[[Column], Column]) -> Column:
    """The value with the keys of all maps and variants in it renamed."""
    if not _has_data_keys(dtype):
        return col
    if isinstance(dtype, T.VariantType):
        return F.parse_json(rename_members(F.to_json(col), in_data))
    if isinstance(dtype, T.ArrayType):
        return F.transform(col, lambda x: _renamed_data(x, dtype.elementType, in_data))
    if isinstance(dtype, T.MapType):
        values = F.transform_values(col, lambda k, v: _renamed_data(v, dtype.valueType, in_data))
        return F.transform_keys(values, lambda k, v: in_data(k)) if isinstance(dtype.keyType, T.StringType) else values
    parts = [_renamed_data(col.getField(f.name), f.dataType, in_data).alias(f.name) for f in dtype.fields]
    return F.when(col.isNotNull(), F.struct(*parts))


def _renamed(dtype: T.DataType, fn: Callable[[str], str]) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(fn(f.name), _renamed(f.dataType, fn), f.nullable, f.metadata) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_renamed(dtype.elementType, fn), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(dtype.keyType, _renamed(dtype.valueType, fn), dtype.valueContainsNull)
    return dtype


def strip_blank(df: DataFrame) -> DataFrame:
    """Blank values ("", NULL, empty lists and objects) become NULL at every level and leave their lists.

    A parent that becomes empty is blank itself. Writing the table as JSON then
    drops the keys, since NULL fields are not written.
    """
    keep = {"_index", "_id"}
    return df.select(
        *[
            F.col(quoted((f.name,))) if f.name in keep else _stripped(F.col(quoted((f.name,))), f.dataType).alias(f.name)
            for f in df.schema.fields
        ]
    )


def _stripped(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(dtype, T.BinaryType):
        return F.when(F.octet_length(col) > 0, col)
    if isinstance(dtype, T.VariantType):
        return F.parse_json(strip_members(F.to_json(col)))
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(F.transform(col, lambda x: _stripped(x, dtype.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(dtype, T.MapType):
        values = F.transform_values(col, lambda k, v: _stripped(v, dtype.valueType))
        kept = F.map_filter(values, lambda k, v: v.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(dtype, T.StructType):
        parts = [_stripped(col.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        filled = F.lit(False)
        for part in parts:
            filled = filled | part.isNotNull()
        return F.when(filled, F.struct(*parts))
    return col


# -- report ---------------------------------------------------------------------------------------


def cast_report(df: DataFrame, mapping: dict, casts: CastRegistry = BUILT_IN) -> DataFrame:
    """Per index and cast field: rows, NULLs, cast values, passed-through values and the least of those.

    In a list of objects every object counts, so the three may add up to more or less than the rows.

    One aggregation with map-side partial results, whatever the number of fields.
    """
    decoded = decode(df, mapping, casts)
    body = "_source" in df.columns
    struct = decoded.schema["_source"].dataType if body else decoded.schema
    paths = list(_raw_paths(struct))
    aggregates = []
    for n, path in enumerate(paths):
        seen = _seen(F.col("_source") if body else None, struct, path)
        state = F.transform(seen, lambda x: F.when(x["raw"].isNotNull(), 2).when(x["cast"], 1).otherwise(0))
        aggregates += [
            *[F.sum(_times(state, kind)).alias(f"{name}{n}") for kind, name in enumerate(("nulls", "cast", "passed"))],
            F.min(F.array_min(F.transform(seen, lambda x: x["raw"]))).alias(f"sample{n}"),
        ]
    key = F.col("_index") if "_index" in df.columns else null("string").alias("_index")
    counted = decoded.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *aggregates)
    entry = [
        F.struct(
            F.lit(".".join(path)).alias("field"),
            F.col(f"nulls{n}").alias("nulls"),
            F.col(f"cast{n}").alias("cast"),
            F.col(f"passed{n}").alias("passed"),
            F.col(f"sample{n}").alias("sample"),
        )
        for n, path in enumerate(paths)
    ]
    return counted.select("_index", "rows", F.inline(F.array(*entry)))


def _raw_paths(struct: T.StructType, prefix: tuple = ()):
    """Paths to the cast fields below a struct, also below lists of objects."""
    for field in struct.fields:
        if field.name + RAW in struct.names:
            yield (*prefix, field.name)
        inner = field.dataType
        while isinstance(inner, T.ArrayType):
            inner = inner.elementType
        if isinstance(inner, T.StructType):
            yield from _raw_paths(inner, (*prefix, field.name))


def _times(values: Column, value: int) -> Column:
    return F.size(F.filter(values, lambda x: x == value))


def _seen(col: Column | None, dtype: T.DataType, path: tuple) -> Column:
    """`ARRAY<STRUCT<cast, raw>>`: one member for the row, or one for every object of the lists on the way."""
    if isinstance(dtype, T.ArrayType):
        return F.flatten(F.transform(F.coalesce(col, F.array().cast(dtype)), lambda x: _seen(x, dtype.elementType, path)))

    def member(name: str) -> Column:
        return F.col(quoted((name,))) if col is None else col.getField(name)

    name, rest = path[0], path[1:]
    if rest:
        return _seen(member(name), dtype[name].dataType, rest)
    raw = member(name + RAW)
    text = raw if isinstance(dtype[name + RAW].dataType, T.StringType) else F.to_json(raw)
    return F.array(F.struct(member(name).isNotNull().alias("cast"), text.alias("raw")))
