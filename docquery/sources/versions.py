"""A document table that takes change logs and keeps its versions, as files that versions share.

Below one folder lie

    data/version=N    documents that version N brought, `_index, _id, _source`
    dead/version=N    keys of documents whose rows in earlier files no longer hold
    late/version=N    actions that came too late and were set aside
    marks/version=N   the last place in the log's order that was applied
    files/version=N   the files that make up version N, with their rows and bytes
    commits           one row per complete version

A version is there once its commit row is, which is written last. A batch that broke off is
written again over its remains, and a committed batch is not applied twice. Nothing that a
version reads is ever changed, so an opened one keeps its rows while later ones are written. There must be
one writer at a time.

Batches follow each other in the order of the log. An action at or before the last place that an
earlier batch applied is late: it is set aside and never applied. An action without a place is late
after the first batch.

The list of a version's files passes through the driver, as a listing of the folder would.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from docquery.operators.bulk import KEYS, apply_bulk, changed_documents
from docquery.operators.profile import segments
from docquery.session import bounded_broadcast, materialize

#: Bytes a file should have.
FILE_BYTES = 512 << 20

_COMMIT = "version long, batch string, mark long, schema string"
_FILES = "kind string, file string, rows long, bytes long"


@dataclass(frozen=True)
class Version:
    """An opened version; `mark` is the version that wrote the last applied place."""

    spark: SparkSession
    path: str
    number: int
    mark: int | None
    schema: T.StructType
    batches: frozenset[str]

    def files(self) -> DataFrame:
        """`(kind, file, rows, bytes)` of its files."""
        return self.spark.read.schema(_FILES).parquet(f"{self.path}/files/version={self.number}")

    def table(self) -> DataFrame:
        """The documents as they stand in this version."""
        listed = [(r["kind"], r["file"]) for r in self.files().select("kind", "file").collect()]
        return self.live([f for kind, f in listed if kind == "data"]).select(*self.schema.names)

    def live(self, files: Sequence[str]) -> DataFrame:
        """The rows of some of its data files that still hold."""
        rows, until = self._read("data", files, self.schema), self._until()
        return rows if until is None else rows.alias("r").join(until.alias("d"), _died(), "left_anti")

    def dead_rows(self) -> DataFrame | None:
        """`(file, dead)`: how many rows of each data file no longer hold; None where no key died."""
        until = self._until()
        if until is None:
            return None
        listed = [r["file"] for r in self.files().filter("kind = 'data'").collect()]
        rows = self._read("data", listed, self.schema).select(*KEYS, "version", F.col("_metadata.file_name").alias("name"))
        gone = rows.alias("r").join(until.alias("d"), _died(), "left_semi")
        file = F.concat(F.lit("data/version="), F.col("version"), F.lit("/"), F.col("name"))
        return gone.groupBy(file.alias("file")).agg(F.count(F.lit(1)).alias("dead"))

    def _until(self) -> DataFrame | None:
        listed = [r["file"] for r in self.files().filter("kind = 'dead'").collect()]
        if not listed:
            return None
        keys = T.StructType([self.schema[k] for k in KEYS])
        return bounded_broadcast(self._read("dead", listed, keys).groupBy(*KEYS).agg(F.max("version").alias("_until")))

    def _read(self, kind: str, files: Sequence[str], schema: T.StructType) -> DataFrame:
        schema = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
        if not files:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{f}" for f in files])


def create_versions(table: DataFrame, path: str) -> Version:
    """Write a document table as version 0 below a new folder."""
    table = table if "_index" in table.columns else table.withColumn("_index", F.lit(""))
    first = Version(table.sparkSession, path, 0, None, _nullable(table.select(*KEYS, "_source").schema), frozenset({"create"}))
    return _publish(first, "create", table.select(*first.schema.names), None, None)


def open_version(spark: SparkSession, path: str, number: int | None = None) -> Version:
    """The table as it is now, or as it was at a version."""
    commits = spark.read.schema(_COMMIT).parquet(f"{path}/commits").collect()  # one row per batch
    known = [c for c in commits if number is None or c["version"] <= number]
    last = max(known, key=lambda c: c["version"])
    if number is not None and last["version"] != number:
        raise ValueError(f"{path} has no version {number}")
    schema = T.StructType.fromJson(json.loads(last["schema"]))
    return Version(spark, path, last["version"], last["mark"], schema, frozenset(c["batch"] for c in known))


def apply_batch(spark: SparkSession, path: str, log: DataFrame, batch: str, order: Sequence[str] = ("seq",), **fold) -> Version:
    """The next version: the table after a log named `batch`, see `bulk.apply_bulk`.

    Only changed documents are written. A log that changes the type of the documents writes the table anew.
    """
    now = open_version(spark, path)
    if batch in now.batches:
        return now
    number, place = now.number + 1, F.struct(*order)
    log = materialize(log, "log")
    marks = log.agg(F.max(place).alias("mark"))
    if now.mark is not None:
        before = spark.read.schema(marks.schema).parquet(f"{path}/marks/version={now.mark}")
        in_time = F.coalesce(place > before.scalar(), F.lit(True))
        log.filter(~in_time).write.mode("overwrite").parquet(f"{path}/late/version={number}")
        marks = marks.unionByName(before).agg(F.max("mark").alias("mark"))
        log = log.filter(in_time)
    else:
        log.limit(0).write.mode("overwrite").parquet(f"{path}/late/version={number}")
    marks.write.mode("overwrite").parquet(f"{path}/marks/version={number}")

    changed = changed_documents(now.table(), log, order, **fold)
    schema = _nullable(changed.select(*KEYS, "_source").schema)
    after = Version(spark, path, number, number, schema, now.batches | {batch})
    if schema != now.schema:
        table, _ = apply_bulk(now.table(), log, order, **fold)
        return _publish(after, batch, table.select(*KEYS, "_source"), None, None)
    changed = materialize(changed, "changed")
    # Rows without an id are found by no action, so none of them dies.
    dead = changed.filter("_id IS NOT NULL").select(*KEYS).distinct()
    return _publish(after, batch, changed.filter("_alive").select(*KEYS, "_source"), dead, now.files())


def late_actions(spark: SparkSession, path: str) -> DataFrame:
    """Every action that came too late, with the version that set it aside as `version`."""
    commits = spark.read.schema(_COMMIT).parquet(f"{path}/commits").filter("mark = version").collect()
    folders = [f"{path}/late/version={c['version']}" for c in commits]
    return spark.read.option("basePath", f"{path}/late").option("mergeSchema", "true").parquet(*folders)


def compact(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> Version:
    """The next version, with the same rows: files of less than half of `file_bytes` and files with dead rows are packed into new ones.

    All other files stay where they are; no key is dead afterwards.
    """
    now = open_version(spark, path)
    files = now.files().filter("kind = 'data'")
    dead = now.dead_rows()
    counted = files.withColumn("dead", F.lit(0)) if dead is None else files.join(dead, "file", "left").fillna(0, "dead")
    counted = materialize(counted.select("kind", "file", "rows", "bytes", "dead"), "files")
    worn = (F.col("dead") > 0) | (F.col("bytes") * 2 < file_bytes)
    chosen = counted.filter(worn).collect()
    if dead is None and len(chosen) < 2:
        return now
    number = now.number + 1
    batch = f"compact-{number}"
    after = Version(spark, path, number, now.mark, now.schema, now.batches | {batch})
    # Bytes of the rows that hold; the new files are of one size however the keys lie.
    live = sum(r["bytes"] * (r["rows"] - r["dead"]) / max(r["rows"], 1) for r in chosen)
    rows = now.live([r["file"] for r in chosen]).select(*now.schema.names).repartition(max(1, -int(-live // file_bytes)))
    return _publish(after, batch, rows, None, counted.filter(~worn).select("kind", "file", "rows", "bytes"))


def unused_files(spark: SparkSession, path: str, before: int) -> DataFrame:
    """`file`: the files that versions before `before` have and no later one; they may be removed once none of those is read."""
    numbers = [r["version"] for r in spark.read.schema(_COMMIT).parquet(f"{path}/commits").select("version").collect()]
    listed = spark.read.schema(_FILES + ", version long").option("basePath", f"{path}/files").parquet(
        *[f"{path}/files/version={n}" for n in numbers]
    )
    return listed.groupBy("file").agg(F.max("version").alias("last")).filter(F.col("last") < before).select("file")


def follow(
    stream: DataFrame, path: str, name: str, checkpoint: str, order: Sequence[str] = ("seq",), trigger: dict | None = None, **fold
) -> StreamingQuery:
    """Apply a stream of actions, one version per micro-batch.

    A micro-batch that is run again after a failure has the name it had, and is applied once.
    Without a trigger the stream ends when it has applied what there is.
    """

    def step(log: DataFrame, number: int) -> None:
        apply_batch(log.sparkSession, path, log, f"{name}-{number}", order, **fold)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _publish(after: Version, batch: str, rows: DataFrame, dead: DataFrame | None, files: DataFrame | None) -> Version:
    """Write a version's parts and then its commit; `files` are those it shares with earlier ones."""
    spark, folder = after.spark, f"version={after.number}"
    new = []
    if dead is not None:
        dead.write.mode("overwrite").parquet(f"{after.path}/dead/{folder}")
        new.append("dead")
    rows.write.mode("overwrite").parquet(f"{after.path}/data/{folder}")
    for kind in ("data", *new):
        name = F.concat(F.lit(f"{kind}/{folder}/"), F.col("file"))
        found = segments(spark, f"{after.path}/{kind}/{folder}").select(F.lit(kind).alias("kind"), name.alias("file"), "rows", "bytes")
        files = found if files is None else files.unionByName(found)
    files.coalesce(1).write.mode("overwrite").parquet(f"{after.path}/files/{folder}")
    commit = spark.createDataFrame([(after.number, batch, after.mark, after.schema.json())], _COMMIT)
    commit.coalesce(1).write.mode("append").parquet(f"{after.path}/commits")
    return after


def _same(rows: str) -> Column:
    return F.col(f"{rows}._index").eqNullSafe(F.col("d._index")) & F.col(f"{rows}._id").eqNullSafe(F.col("d._id"))


def _died() -> Column:
    return _same("r") & (F.col("r.version") < F.col("d._until"))


def _nullable(schema: T.DataType) -> T.DataType:
    """The schema as parquet gives it back, where everything may be NULL."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in schema.fields])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_nullable(schema.elementType))
    if isinstance(schema, T.MapType):
        return T.MapType(schema.keyType, _nullable(schema.valueType))
    return schema
