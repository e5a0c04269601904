"""Query clauses as Column predicates; combine them with `&`, `|` and `~`."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.functions.text import Analyzer, analyzer, query_terms
from docquery.session import bounded_broadcast


def match_all() -> Column:
    return F.lit(True)


def term(col: Column | str, value: object) -> Column:
    """Exact equality."""
    return _col(col) == F.lit(value)


def match(col: Column | str, text: str, by: str | Analyzer = "standard") -> Column:
    """The analyzed column shares at least one token with the analyzed `text`."""
    words = query_terms(text, by)
    if not words:
        return F.lit(False)
    return F.arrays_overlap(analyzer(by)(_col(col)), F.array(*[F.lit(w) for w in words]))


def ids(df: DataFrame, values: Iterable | DataFrame) -> DataFrame:
    """Rows whose `_id` is listed. A short list is pushed to the scan, a table of ids is semi-joined."""
    if isinstance(values, DataFrame):
        return df.join(bounded_broadcast(values.select("_id").distinct()), "_id", "left_semi")
    return df.filter(F.col("_id").isin(list(values)))


def index_filter(df: DataFrame, predicate: Column | None) -> DataFrame:
    """Bind a predicate to a scan, so that it holds for every search over it."""
    return df if predicate is None else df.filter(predicate)


def source_filter(df: DataFrame, fields: Iterable[str] | None = None) -> DataFrame:
    """The documents, or some of their fields, without metadata."""
    if fields is None:
        return df.select("_source.*")
    return df.select(*[F.col(f"_source.{f}").alias(f) for f in fields])


def selected(predicate: Column) -> Column:
    """A predicate that is never NULL: a row it cannot decide is not selected."""
    return F.coalesce(predicate, F.lit(False))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
