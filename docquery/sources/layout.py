"""Table layout jobs: routing, copying, sharding, compaction and rollover.

Every write asks for a rebalance by its folder key: adaptive execution then
splits a folder that holds a large share of the rows over many tasks and packs
small ones together. Nothing overwrites a folder that is being read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.functions.shards import shard_of
from docquery.operators.bulk import apply_bulk
from docquery.operators.paging import with_position
from docquery.session import bounded_broadcast


def write_routed(df: DataFrame, term: Column | str, name_fn: Callable[[Column], Column], path: str) -> None:
    """Write each row to the index computed from its term; reading `path` back prunes by `_index`."""
    col = F.col(term) if isinstance(term, str) else term
    _write(df.withColumn("_index", name_fn(col)), path, "_index")


def reindex(
    source: DataFrame,
    path: str,
    index: str,
    query: Column | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    into: DataFrame | None = None,
) -> DataFrame:
    """Copy the documents `query` selects, transformed, into an index written at `path`.

    `into` is what the index holds already: its documents stay, except those of
    an id that is copied. The copied ids must be unique, as those of one index are.
    """
    df = source if query is None else source.filter(query)
    df = (transform(df) if transform else df).withColumn("_index", F.lit(index))
    if into is not None:
        copied = bounded_broadcast(df.select("_index", "_id").distinct())
        df = into.join(copied, ["_index", "_id"], "left_anti").select(into.columns).unionByName(df.select(into.columns))
    # What a query leaves of each task may be little; a rebalance packs it into files of a proper size.
    (df if query is None else df.hint("rebalance")).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def clone(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Full copy of a table folder with the same shards."""
    df = spark.read.parquet(source)
    if "_shard" in df.columns:
        _write(df, target, "_shard")
    else:
        df.write.parquet(target)
    return spark.read.parquet(target)


def with_shards(df: DataFrame, shards: int) -> DataFrame:
    return df.withColumn("_shard", shard_of("_id", shards))


def split(df: DataFrame, shards: int, factor: int, path: str) -> DataFrame:
    """Rewrite a table of `shards` shards with `factor` times as many; every shard falls apart into `factor` ones."""
    return _resharded(with_shards(df, shards * factor), path)


def shrink(df: DataFrame, shards: int, factor: int, path: str) -> DataFrame:
    """Rewrite a table of `shards` shards with a `factor`-th of them, joining whole shards."""
    if shards % factor:
        raise ValueError(f"{factor} does not divide {shards} shards")
    return _resharded(df.withColumn("_shard", F.pmod(F.col("_shard"), F.lit(shards // factor))), path)


def forcemerge(table: DataFrame | None, log: DataFrame, path: str, max_files: int, **fold) -> DataFrame:
    """Fold a table and the changes since into a new snapshot of at most `max_files` files, without dead rows."""
    live, _ = apply_bulk(table, log, **fold)
    live.repartition(max_files, "_id").sortWithinPartitions("_id").write.parquet(path)
    return live.sparkSession.read.parquet(path)


def rollover(
    df: DataFrame,
    name: str,
    keys: list[str] | None = None,
    max_docs: int | None = None,
    time: Column | None = None,
    max_age: str | None = None,
) -> DataFrame:
    """Assign each row to a generation `name-000001`, `name-000002`, ... as `_index`.

    By `max_docs`: a new generation after that many rows in the order of `keys`,
    which must end in a unique column. By `max_age` (e.g. `"1 day"`): a new
    generation with every non-empty time window.
    """
    if (max_docs is None) == (max_age is None):
        raise ValueError("give either max_docs or max_age")
    if max_docs is not None:
        placed = with_position(df, keys)
        generation = F.floor((F.col("_position") - 1) / max_docs) + 1
        return placed.withColumn("_index", _generation(name, generation)).drop("_position")
    # `window` leaves out rows without a time, so it gets a stand-in for them.
    known = F.coalesce(time, F.timestamp_seconds(F.lit(0)))
    aged = df.withColumn("_window", F.window(known, max_age).getField("start"))
    aged = aged.withColumn("_window", F.when(time.isNotNull(), F.col("_window")))
    # One row per window that holds rows, ranked by ranges of windows. Rows without a time are a generation of their own, the first.
    ranked = with_position(aged.select("_window").distinct(), ["_window"]).select(F.col("_window").alias("_start"), F.col("_position").alias("_generation"))
    joined = aged.join(bounded_broadcast(ranked), F.col("_window").eqNullSafe(F.col("_start"))).drop("_start")
    return joined.withColumn("_index", _generation(name, F.col("_generation"))).drop("_window", "_generation")


def _generation(name: str, number: Column) -> Column:
    # At least six digits; longer numbers stay whole.
    return F.concat(F.lit(name + "-"), F.format_string("%06d", number.cast("long")))


def _resharded(df: DataFrame, path: str) -> DataFrame:
    _write(df, path, "_shard")
    return df.sparkSession.read.parquet(path)


def _write(df: DataFrame, path: str, key: str) -> None:
    df.hint("rebalance", key).write.partitionBy(key).parquet(path)
