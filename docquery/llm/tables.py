"""Reading the test tables and picking bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like `names` that `df` does not have, whatever the case of its own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is kept out of all training: crc32 of its id as text is divisible by 5."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(key.cast("string")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """Texts of up to `per_class` labelled training rows of each class, as (doc_id, text, label).

    The rows are those with the smallest hashes of their ids, so the sample is the
    same on every run. Only ids are sorted; the texts are then picked by a
    broadcast of at most `2 * per_class` ids. Of rows with one id the one with the
    least text takes part. Rows that are held out, or whose id or label is NULL,
    never do.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_label")).filter(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id")
    )
    picked = None
    for value in (0, 1):
        part = known.filter(F.col("_label") == value).distinct().orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    return (
        docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("_text"))
        .join(F.broadcast(picked), "_id")
        .groupBy("_id", "_label")
        .agg(F.min("_text").alias("_text"))
        .select(F.col("_id").alias("doc_id"), F.col("_text").alias("text"), F.col("_label").cast("int").alias("label"))
    )


def label_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """How many labelled training rows of each class there are."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out("doc_id"))
    return {int(r[0]): r[1] for r in known.groupBy(label).count().collect()}
