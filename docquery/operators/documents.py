"""Key lookups and edits of document tables.

`table` is large and unique by (`_index`, `_id`); the other side is a batch that may
be small or large and may repeat ids. A batch with an `_index` column means the
documents of those indices, one without it the ids of every index. The ids of a batch are broadcast when they are
proven to fit, so that the table is filtered where it lies; otherwise both sides
are shuffled. A batch is reduced to one row per id by an aggregation before it is
joined, so repeated ids do not pile up in a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.made_ids import made_id
from docquery.functions.predicates import selected
from docquery.functions.shards import shard_of
from docquery.model import build, leaves, quoted, source_type, split_touched
from docquery.operators.bulk import present, typed_doc
from docquery.session import bounded_broadcast


def with_ids(docs: DataFrame, order: str | None = None, dtype: T.DataType | None = None) -> DataFrame:
    """Give documents without `_id` one made from their content, the same on every run.

    With `order` the place counts too, so that equal documents stay apart. Ids are
    text, or of `dtype`: whole numbers are made from a 64-bit hash (`made_id`).
    """
    dtype = dtype or T.StringType()
    text = F.to_json(F.struct("_source", order) if order else "_source")
    given = F.col("_id") if "_id" in docs.columns else F.lit(None)
    return docs.withColumn("_id", F.coalesce(given.cast(dtype), made_id(text, dtype)))


def index(table: DataFrame, docs: DataFrame, order: str | None = None) -> DataFrame:
    """Create or replace documents by id; of several for one id the last by `order` wins.

    A document without an id gets one made for it.
    """
    docs, keys = with_ids(docs, order, table.schema["_id"].dataType), _keys(docs)
    latest = docs.groupBy(*keys).agg(F.max_by(F.struct(*_body(table, keys)), _order(order)).alias("_doc"))
    replaced = latest.select(*keys, "_doc.*").select(table.columns)
    kept = table.join(_ids_of(docs), keys, "left_anti").select(table.columns)
    return kept.unionByName(replaced)


def create(table: DataFrame, docs: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """Insert documents of new ids: `(new table, conflicts)`.

    The first document of an id by `order` is inserted unless the id exists;
    every other one is a conflict. A document without an id gets one made for it
    from its content and place; one without a place comes last.
    """
    docs, keys = with_ids(docs, order, table.schema["_id"].dataType), _keys(docs)
    place = F.struct(F.col(order).isNull(), F.col(order))
    first = docs.groupBy(*keys).agg(F.min_by(F.struct(*_body(table, keys), order), place).alias("_doc"))
    existing = table.select(*keys).join(_ids_of(docs), keys, "left_semi")
    inserted = first.select(*keys, "_doc.*").join(existing, keys, "left_anti")
    # Matching on (id, order) spreads the repeats of one id over all tasks.
    d, i = docs.alias("d"), inserted.select(*keys, order).alias("i")
    same = [F.col(f"d.{quoted((c,))}").eqNullSafe(F.col(f"i.{quoted((c,))}")) for c in (*keys, order)]
    conflicts = d.join(i, reduce(Column.__and__, same), "left_anti").select(docs.columns)
    return table.unionByName(inserted.select(table.columns)), conflicts


def get(table: DataFrame, key, shards: int | None = None) -> DataFrame:
    """The document with an id; the filter reaches the scan.

    With the number of `shards` of a table written by `layout.split` or
    `layout.shrink`, only the folder of the document's shard is read.
    """
    found = table.filter(F.col("_id") == F.lit(key))
    return found if shards is None else found.filter(F.col("_shard") == shard_of(F.lit(key), shards))


def delete(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The table without the documents of a set of ids."""
    return table.join(_ids_of(ids), _keys(ids), "left_anti").select(table.columns)


def exists(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Each asked id with `exists` true or false."""
    return _flagged(table, ids)


def get_source(table: DataFrame, ids: DataFrame | object) -> DataFrame:
    """The documents of some ids without metadata."""
    found = table.join(_ids_of(ids), _keys(ids), "left_semi") if isinstance(ids, DataFrame) else get(table, ids)
    return found.select("_source.*")


def source_exists(table: DataFrame, ids: DataFrame) -> DataFrame:
    """Each asked id with `exists`: it is there and its document has a source."""
    return _flagged(table.filter(F.col("_source").isNotNull()), ids)


def update_doc(table: DataFrame, partial: DataFrame, order: str | None = None) -> DataFrame:
    """Merge partial documents: fields they name replace, others stay, nested ones too.

    `partial` has `_id`, `_source` and optionally `_index` and `present ARRAY<STRING>`;
    without it the non-NULL fields count as named. Several partial documents of
    one id apply in `order`. Ids the table does not have are left out.
    """
    want, have = source_type(table), partial.schema["_source"].dataType
    named = {path: f"_f{n}" for n, (path, _) in enumerate(leaves(want))}
    typed = partial.withColumn("_typed", typed_doc(F.col("_source"), have, want))
    keys = _keys(partial)
    folded = typed.groupBy(*keys).agg(
        *[
            F.max_by(
                F.struct(F.col(quoted(("_typed", *path))).alias("v")),
                F.when(present(path, dtype, "_source", have, partial.columns), _order(order)),
            ).alias(name)
            for (path, name), dtype in zip(named.items(), (t for _, t in leaves(want)), strict=True)
        ],
        F.lit(True).alias("_hit"),
    )
    untouched, touched = split_touched(table, partial, keys)
    joined = touched.join(folded, keys, "left")

    def field(path, dtype):
        new = F.col(named[path])
        return F.when(new.isNotNull(), new.getField("v")).otherwise(F.col(quoted(("_source", *path))))

    # A row that no partial document has keeps its body, whatever it is, however it came here.
    body = F.when(F.col("_hit"), build(want, field)).otherwise(F.col("_source"))
    merged = joined.withColumn("_source", body).select(table.columns)
    return merged if untouched is None else untouched.unionByName(merged)


def update_script(table: DataFrame, ids: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Recompute fields of some documents from their own values, e.g. `{"views": source("views") + 1}`."""
    hit = bounded_broadcast(ids.select(*_keys(ids)).distinct().withColumn("_hit", F.lit(True)))
    joined = table.join(hit, _keys(ids), "left")
    return _changed(joined, F.col("_hit").isNotNull(), changes).select(table.columns)


def mget(table: DataFrame, requests: DataFrame) -> DataFrame:
    """Look up many ids: the request rows with `found` and `_source`, NULL when absent.

    Requests have `pos`, `_id` and, when each names its own index, `_index`.
    """
    keys = _keys(requests)
    # Only the requested documents are carried into the join that keeps absent ones.
    asked = bounded_broadcast(requests.select(*keys).distinct())
    wanted = table.join(asked, keys, "left_semi").select(*keys, "_source", F.lit(True).alias("found"))
    joined = requests.join(wanted, keys, "left")
    return joined.select("pos", *keys, F.coalesce("found", F.lit(False)).alias("found"), "_source")


def delete_by_query(table: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """`(remaining rows, one row with the number deleted)`; a NULL predicate keeps the row."""
    kept = table.filter(~selected(predicate))
    return kept, table.filter(predicate).agg(F.count(F.lit(1)).alias("deleted"))


def update_by_query(table: DataFrame, predicate: Column | None, changes: Mapping[str, Column]) -> DataFrame:
    """Change the documents the predicate selects; without one, all of them."""
    return _changed(table, F.lit(True) if predicate is None else selected(predicate), changes)


def _changed(df: DataFrame, hit: Column, changes: Mapping[str, Column]) -> DataFrame:
    body, dtype = F.col("_source"), source_type(df)
    for name, value in changes.items():
        path = (name,) if name in dtype.names else tuple(name.split("."))
        own = df.select(value.alias("v")).schema["v"].dataType
        body, dtype = _with_path(body, dtype, path, value, own, hit)
    return df.withColumn("_source", body)


def _with_path(body: Column | None, dtype: T.StructType, path: tuple[str, ...], value: Column, own: T.DataType, hit: Column) -> tuple[Column, T.StructType]:
    """`body` with the value at a path where `hit` holds, and its type; absent fields and objects on the way are added.

    A row that isn't hit gets NULL for a new field and keeps an absent object absent.
    """
    name, rest = path[0], path[1:]
    known = name in dtype.names
    held = body.getField(name) if known else None
    if rest:
        inner = dtype[name].dataType if known else T.StructType([])
        if not isinstance(inner, T.StructType):
            raise ValueError(f"{name} is no object, so it has no field {'.'.join(rest)}")
        new, kind = _with_path(held, inner, rest, value, own, hit)
    elif known:
        kind = dtype[name].dataType
        # A value of another type makes the field that type, as it did before.
        new, kind = F.when(hit, value).otherwise(held), kind if kind == own else own
    else:
        new, kind = F.when(hit, value), own
    fields = [(f.name, kind if f.name == name else f.dataType) for f in dtype.fields] + ([] if known else [(name, kind)])
    parts = [(new if n == name else body.getField(n)).alias(n) for n, _ in fields]
    there = hit if body is None else body.isNotNull() | hit
    return F.when(there, F.struct(*parts)), T.StructType([T.StructField(n, t) for n, t in fields])


def _flagged(table: DataFrame, ids: DataFrame) -> DataFrame:
    keys = _keys(ids)
    found = table.select(*keys).join(_ids_of(ids), keys, "left_semi").distinct().withColumn("_found", F.lit(True))
    joined = ids.join(found, keys, "left").withColumn("exists", F.col("_found").isNotNull())
    return joined.select(*ids.columns, "exists")


def _keys(batch: DataFrame) -> list[str]:
    return ["_index", "_id"] if "_index" in batch.columns else ["_id"]


def _ids_of(batch: DataFrame) -> DataFrame:
    return bounded_broadcast(batch.select(*_keys(batch)).distinct())


def _body(table: DataFrame, keys: list[str]) -> Iterable[str]:
    return [c for c in table.columns if c not in keys]


def _order(order: str | None) -> Column:
    """Without an order column the documents themselves decide, so that every run agrees."""
    return F.col(order) if order else F.to_json("_source")
