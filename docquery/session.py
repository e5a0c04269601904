"""Session settings, size-checked broadcasts and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest table that is sent whole to every executor. Only narrow rows (ids,
#: terms, statistics) are ever passed to `bounded_broadcast`.
BROADCAST_ROWS = 500_000


def get_session(app: str = "docquery", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A skewed term or id is split even where that costs one more exchange.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def fits_broadcast(df: DataFrame, max_rows: int | None = None) -> bool:
    """Whether `df` has at most `max_rows` (else `BROADCAST_ROWS`) rows.

    The count stops at the limit where `df` is a plain read; distinct ids are
    aggregated first. It is meant for inputs that are cheap to read (a batch of
    ids, a query table).
    """
    bound = BROADCAST_ROWS if max_rows is None else max_rows
    return df.limit(bound + 1).count() <= bound


def bounded_broadcast(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast when `df` is proven to fit.

    Otherwise no hint is given: Spark then shuffles both sides and adaptive
    execution splits hot keys.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def join_statistics(rows: DataFrame, statistics: DataFrame, key: str, count: str) -> DataFrame:
    """Join rows to a table with one row per key that also tells, as `count`, how many rows the key has.

    A small table is broadcast whole. Of a large one only the keys above an even
    share are, and there can be no more than `BROADCAST_ROWS` of those; the rows
    of all other keys are shuffled, where none of them is large. Both inputs
    should be tables that were written, since they are read several times.
    """
    if fits_broadcast(statistics):
        return rows.join(F.broadcast(statistics), key)
    total = statistics.agg(F.sum(count)).first()[0]
    share = total // max(BROADCAST_ROWS, 1)
    hot = statistics.filter(F.col(count) > share)
    cold = statistics.filter(F.col(count) <= share)
    frequent = rows.join(F.broadcast(hot), key)
    others = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return frequent.unionByName(others)


@contextmanager
def setting(spark: SparkSession, key: str, value: object) -> Iterator[None]:
    """A setting of the session that holds for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by `spark.checkpoint.dir`.

    Only where the session names none and runs on one machine (tests) is a
    temporary folder made, once per session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="docquery-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing was written to yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as a table in the shared folder and read it back from there.

    Used where a result is needed several times. The copy survives the loss of
    executors, is columnar, and its size is known to the planner.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
