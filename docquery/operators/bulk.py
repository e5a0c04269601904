"""Applying an ordered action log (index, create, update, delete) to a document table.

Log rows: order columns, `action`, `_index`, `_id` and `doc`. `doc` is a STRUCT
(with an optional `present ARRAY<STRING>` of dotted paths, for fields that are
set to NULL on purpose) or a VARIANT as `read_bulk` gives it.

One id may own a large share of the log. What an action finds is worked out along
the actions of its id, but an id with more than `CHUNK` of them is never gathered: its
actions are cut into chunks, bounded stretches of the order, and what they leave is
carried from chunk to chunk by one summary row each. Without such an id the log is
shuffled once, and the final documents are aggregated where its rows then lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docquery.functions.made_ids import made_id
from docquery.functions.stored import INTEGRAL, let
from docquery.model import build, leaves, quoted, source_type, split_touched
from docquery.sources.mapping import merge, reshape

#: Rows a chunk of the order should hold.
CHUNK = 1 << 18
#: Cuts that a row is compared with in each of two steps.
BOUNDS = 32

KEYS = ("_index", "_id")
#: Outcomes of an action that leave a document other than it was.
CHANGED = ("created", "updated", "deleted")


def apply_bulk(
    table: DataFrame | None,
    log: DataFrame,
    order: Sequence[str] = ("seq",),
    chunk: Column | None = None,
    schema: T.StructType | None = None,
    default_index: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """`(table', items)`: the table after the whole log, and the outcome of every action.

    Outcomes are created, updated, conflict (a create of an existing id),
    missing (an update of an absent one), deleted and not_found. `chunk` must
    not decrease along `order`. Without one the order's first column is cut at
    its quantiles, or, for an order such as (file, line), each file by its
    lines. The log is read several times, so write
    parsed bulk files as a table before.
    """
    untouched, touched, seen = _seen(table, log, order, chunk, default_index)
    changed = _state(touched, seen, order, schema).filter("_alive").select(*KEYS, "_source")
    if untouched is not None:
        want, have = source_type(changed), source_type(untouched)
        changed = untouched.withColumn("_source", reshape(F.col("_source"), have, want)).unionByName(changed)
    return changed, _items(seen, order)


def changed_documents(
    table: DataFrame,
    log: DataFrame,
    order: Sequence[str] = ("seq",),
    chunk: Column | None = None,
    schema: T.StructType | None = None,
    default_index: str | None = None,
) -> DataFrame:
    """`(_index, _id, _source, _alive)` of the documents that some action of a log created, updated or deleted.

    The documents with `_alive` are those of `apply_bulk`, the others have none. One pass over the log tells both, where
    the rows and the outcomes of `apply_bulk` take one each.
    """
    _, touched, seen = _seen(table, log, order, chunk, default_index)
    return _state(touched, seen, order, schema).filter("_changed").select(*KEYS, "_source", "_alive")


def _seen(
    table: DataFrame | None, log: DataFrame, order: Sequence[str], chunk: Column | None, default_index: str | None
) -> tuple[DataFrame | None, DataFrame | None, DataFrame]:
    """The table's rows that the log leaves alone, the others, and the log with what each action finds."""
    log = _normal(log, order, default_index)
    if table is not None and table.schema["_id"].dataType != log.schema["_id"].dataType:
        raise ValueError("the ids of the table and of the log have different types")
    if chunk is None and not _chunks_itself(log, order):
        raise ValueError("give a chunk column for an order without an integer column")
    untouched, touched = (None, None) if table is None else split_touched(_keyed(table), log, list(KEYS))
    return untouched, touched, _with_before(touched, log, order, chunk)


def as_of(
    log: DataFrame, cutoff, order: Sequence[str] = ("seq",), table: DataFrame | None = None, **fold
) -> DataFrame:
    """The documents as they stood once the order's first column had reached `cutoff`.

    Searches over the result all see that one version. The filter reaches the
    log's scan.
    """
    frozen, _ = apply_bulk(table, log.filter(F.col(order[0]) <= F.lit(cutoff)), order, **fold)
    return frozen


def typed_doc(doc: Column, have: T.DataType, want: T.StructType) -> Column:
    """The log's documents in the shape of the table."""
    if isinstance(have, T.VariantType):
        return build(want, lambda path, dtype: F.try_variant_get(doc, "$." + ".".join(path), dtype.simpleString()))
    return reshape(doc, have, want)


def present(path: tuple[str, ...], dtype: T.DataType, doc: str, have: T.DataType, columns: Sequence[str]) -> Column:
    """Whether a log document sets a field; an explicit NULL does, of the field or an object around it.

    A value that does not fit the field's type sets nothing.
    """
    if isinstance(have, T.VariantType):
        fits = F.try_variant_get(F.col(doc), "$." + ".".join(path), dtype.simpleString()).isNotNull()
        for n in range(1, len(path) + 1):
            part = F.try_variant_get(F.col(doc), "$." + ".".join(path[:n]), "variant")
            fits = fits | F.coalesce(F.is_variant_null(part), F.lit(False))
        return fits
    if not _has(have, path):
        return F.lit(False)
    if "present" in columns:
        around = F.array(*[F.lit(".".join(path[:n])) for n in range(1, len(path) + 1)])
        return F.coalesce(F.arrays_overlap("present", around), F.lit(False))
    return F.col(quoted((doc, *path))).isNotNull()


def _normal(log: DataFrame, order: Sequence[str], default_index: str | None) -> DataFrame:
    index = F.col("_index") if "_index" in log.columns else F.lit(None).cast("string")
    log = log.withColumn("_index", F.coalesce(index, F.lit(default_index).cast("string"), F.lit("")))
    # A new document without an id gets one from its place in the log, the same on every run.
    place, new = F.to_json(F.struct(*order, "_index")), F.col("action").isin("index", "create")
    dtype = log.schema["_id"].dataType
    if not isinstance(dtype, (T.StringType, *INTEGRAL)):
        return log
    # Other actions without an id stay without one and find nothing.
    return log.withColumn("_id", F.coalesce(F.col("_id"), F.when(new, made_id(place, dtype))))


def even_chunks(log: DataFrame, order: Sequence[str], rows: int = CHUNK) -> Column:
    """Stretches of the order that hold about `rows` rows each, however unevenly its values lie.

    The bounds are quantiles of the first column, found by one aggregation. A log of
    more than `BOUNDS * BOUNDS` chunks is cut at as many quantiles, and evenly in between.
    """
    whole = (T.LongType, T.IntegerType)
    first, last = order[0], order[-1]
    if isinstance(log.schema[first].dataType, whole):
        n = log.count()
        stretches = min(BOUNDS * BOUNDS, max(1, n // rows))
        share = [k / stretches for k in range(stretches + 1)]
        cuts = log.agg(F.percentile_approx(first, F.lit(share), 10 * BOUNDS * BOUNDS)).first()[0]
        return _stretch(F.col(first), cuts, max(1, n // (stretches * rows))) if cuts else F.lit(0)
    if isinstance(log.schema[last].dataType, whole):
        return F.struct(*[F.col(c) for c in order[:-1]], F.floor(F.col(last) / rows).alias("part"))
    raise ValueError("give a chunk column for an order without an integer column")


def _chunks_itself(log: DataFrame, order: Sequence[str]) -> bool:
    return any(isinstance(log.schema[c].dataType, (T.LongType, T.IntegerType)) for c in (order[0], order[-1]))


def _stretch(at: Column, cuts: Sequence[int], parts: int) -> Column:
    """The number of the stretch between two cuts that a place lies in, and of its even part; -1 without a place.

    The stretch is looked up in two steps, each among few cuts.
    """
    lows, highs = cuts[:-1], cuts[1:]
    fine = [lows[k : k + BOUNDS] for k in range(0, len(lows), BOUNDS)]

    def passed(bounds: Column) -> Column:
        return F.greatest(F.size(F.filter(bounds, lambda low: low <= at)) - 1, F.lit(0))

    block = passed(F.array(*[F.lit(b[0]) for b in fine]))
    number = let(block, lambda b: b * BOUNDS + passed(F.get(F.array(*[F.array(*map(F.lit, x)) for x in fine]), b)))
    if parts > 1:
        widths = [max(1, -(-(high - low) // parts)) for low, high in zip(lows, highs, strict=True)]
        low, width = F.array(*map(F.lit, lows)), F.array(*map(F.lit, widths))
        number = let(
            number,
            lambda k: k.cast("long") * parts + F.least(F.floor((at - F.get(low, k)) / F.get(width, k)), F.lit(parts - 1).cast("long")),
        )
    return F.when(at.isNull(), F.lit(-1).cast("long")).otherwise(number.cast("long"))


def _keyed(table: DataFrame) -> DataFrame:
    index = F.col("_index") if "_index" in table.columns else F.lit("")
    return table.select(index.alias("_index"), "_id", "_source")


def _with_before(table: DataFrame | None, log: DataFrame, order: Sequence[str], chunk: Column | None) -> DataFrame:
    """The log with `_before`: whether the id exists when the action runs, and `_stored`: in the table."""
    leaves_existing = F.when(F.col("action").isin("index", "create"), True).when(F.col("action") == "delete", False)
    marked = log.withColumn("_exists", leaves_existing)
    stored = None if table is None else table.select(*KEYS, F.lit(True).alias("_stored"))
    frequent = log.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CHUNK).select(*KEYS)
    hot = frequent.collect()  # at most one row per `CHUNK` actions
    if not hot:
        return _found(_with_stored(marked, stored), [], order, F.col("_stored"))
    at = F.struct(*order)
    # Only the ids with many actions are cut.
    cut = (chunk if chunk is not None else even_chunks(log, order)).alias("_cut")
    hot = log.sparkSession.createDataFrame(hot, frequent.schema).withColumn("_hot", F.lit(True))
    m, h = marked.select("*", cut).alias("m"), F.broadcast(hot).alias("h")
    marked = m.join(h, _same("m", "h", KEYS), "left").select("m.*", F.when(F.col("_hot"), F.col("_cut")).alias("_chunk")).drop("_cut")

    # One row per id and chunk; what it leaves behind is known from its last index, create or delete.
    summary = marked.groupBy(*KEYS, "_chunk").agg(
        F.max_by("_exists", F.when(F.col("_exists").isNotNull(), at)).alias("_left")
    )
    before_chunk = Window.partitionBy(*KEYS).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("_carried", F.last("_left", ignorenulls=True).over(before_chunk)).drop("_left")
    # A place or an id may be NULL; such actions have an outcome too.
    m, c = marked.alias("m"), _with_stored(carried, stored).alias("c")
    joined = m.join(c, _same("m", "c", (*KEYS, "_chunk"))).select("m.*", "_carried", "_stored")
    return _found(joined, ["_chunk"], order, F.coalesce("_carried", "_stored"))


def _found(log: DataFrame, within: list[str], order: Sequence[str], first: Column) -> DataFrame:
    """`_before` from the actions before in the same group, or `first` where none of them tells."""
    earlier = Window.partitionBy(*KEYS, *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return log.withColumn("_before", F.coalesce(F.last("_exists", ignorenulls=True).over(earlier), first))


def _with_stored(rows: DataFrame, stored: DataFrame | None) -> DataFrame:
    if stored is None:
        return rows.withColumn("_stored", F.lit(False))
    return rows.join(stored, list(KEYS), "left").withColumn("_stored", F.coalesce("_stored", F.lit(False)))


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _outcome() -> Column:
    before, action = F.col("_before"), F.col("action")
    return (
        F.when(action == "create", F.when(before, "conflict").otherwise("created"))
        .when(action == "update", F.when(before, "updated").otherwise("missing"))
        .when(action == "delete", F.when(before, "deleted").otherwise("not_found"))
        .otherwise(F.when(before, "updated").otherwise("created"))
    )


def _items(seen: DataFrame, order: Sequence[str]) -> DataFrame:
    return seen.select(*order, "action", *KEYS, _outcome().alias("outcome"))


def _state(table: DataFrame | None, seen: DataFrame, order: Sequence[str], schema: T.StructType | None) -> DataFrame:
    """`(_index, _id, _source, _alive, _changed)`: each document that the table has or the log names, whether it is there afterwards and whether an action changed it."""
    have = seen.schema["doc"].dataType
    shapes = [source_type(table)] if table is not None else []
    if schema is not None:
        shapes.append(schema)
    if isinstance(have, T.StructType):
        shapes.append(have)
    if not shapes:
        raise ValueError("give the schema of the documents")
    want = merge(shapes)
    at = F.struct(*order)

    # An index, or a create that found nothing, sets every field; an update sets the ones it names.
    # A later base row thus beats every older value by order alone, and one aggregation is enough.
    replaces = (F.col("action") == "index") | ((F.col("action") == "create") & ~F.col("_before"))
    typed = seen.withColumn("_typed", typed_doc(F.col("doc"), have, want)).withColumn("_base", replaces)
    aggregates = [
        F.max_by("_exists", F.when(F.col("_exists").isNotNull(), at)).alias("_alive"),
        F.max(_outcome().isin(*CHANGED)).alias("_changed"),
    ]
    names = {}
    for n, (path, dtype) in enumerate(leaves(want)):
        names[path] = f"_f{n}"
        sets = F.col("_base") | ((F.col("action") == "update") & present(path, dtype, "doc", have, seen.columns))
        # The struct around the value keeps an explicit NULL apart from "never set".
        value = F.struct(F.col(quoted(("_typed", *path))).alias("v"))
        aggregates.append(F.max_by(value, F.when(sets, at)).alias(names[path]))
    folded = typed.groupBy(*KEYS).agg(*aggregates, F.lit(True).alias("_hit"))

    if table is None:
        body = build(want, lambda path, dtype: F.col(names[path]).getField("v"))
        return folded.select(*KEYS, body.alias("_source"), F.coalesce("_alive", F.lit(False)).alias("_alive"), "_changed")

    old = reshape(F.col("_source"), source_type(table), want)
    stored = table.select(*KEYS, old.alias("_old"), F.lit(True).alias("_stored"))
    joined = stored.join(folded, list(KEYS), "full_outer")

    def field(path, dtype):
        new = F.col(names[path])
        return F.when(new.isNotNull(), new.getField("v")).otherwise(F.col(quoted(("_old", *path))))

    # A row that the log leaves alone keeps its body, whatever it is, however it came here.
    body = F.when(F.col("_hit"), build(want, field)).otherwise(F.col("_old"))
    alive, changed = F.coalesce("_alive", "_stored", F.lit(False)), F.coalesce("_changed", F.lit(False))
    return joined.select(*KEYS, body.alias("_source"), alive.alias("_alive"), changed.alias("_changed"))


def _has(dtype: T.DataType, path: tuple[str, ...]) -> bool:
    for name in path:
        if not isinstance(dtype, T.StructType) or name not in dtype.names:
            return False
        dtype = dtype[name].dataType
    return True
