"""The `standard` analyzer as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from docquery.functions.stored import let
from docquery.functions.sums import running_sums

# A token is a maximal run of letters, digits and underscores.
WORD = r"[\p{L}\p{N}_]+"
RUN = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"
# A word with what lies between it and the next, and what lies before the first.
STEP = r"[\p{L}\p{N}_]+[^\p{L}\p{N}_]*"
LEAD = r"^[^\p{L}\p{N}_]*"

Analyzer = Callable[[Column], Column]


def tokens(col: Column | str) -> Column:
    """Lower-cased tokens of a text, in order, repeats included."""
    return F.transform(F.regexp_extract_all(col, F.lit(WORD), F.lit(0)), F.lower)


def runs(col: Column | str) -> Column:
    """The text cut into alternating word and non-word runs; joined they give it back."""
    return F.regexp_extract_all(col, F.lit(RUN), F.lit(1))


ANALYZERS: dict[str, Analyzer] = {"standard": tokens}


def analyzer(name: str | Analyzer) -> Analyzer:
    if callable(name):
        return name
    if name not in ANALYZERS:
        raise ValueError(f"unknown analyzer {name!r}; known: {sorted(ANALYZERS)}")
    return ANALYZERS[name]


def query_terms(text: str, by: str | Analyzer = "standard", spark: SparkSession | None = None) -> list[str]:
    """Distinct tokens of one query text, analyzed by the same expression as the documents."""
    spark = spark or SparkSession.active()
    row = spark.range(1).select(F.array_distinct(analyzer(by)(F.lit(text)))).first()
    return list(row[0])


def each(words: Column | str) -> Column:
    """One row per token. The outer form, since for the plain one Spark adds a filter that analyzes the text again."""
    return F.explode_outer(words)


def term_frequencies(words: Column) -> Column:
    """`ARRAY<STRUCT<term, tf>>` of a token array, worked out inside the row: equal tokens are runs of the sorted array."""

    def count_runs(ordered: Column) -> Column:
        return let(
            run_starts(ordered),
            lambda begin: F.transform(
                begin,
                lambda i, n: F.struct(
                    F.get(ordered, i).alias("term"),
                    (F.coalesce(F.get(begin, n + 1), F.size(ordered)) - i).alias("tf"),
                ),
            ),
        )

    return F.when(F.size(words) > 0, let(F.sort_array(words), count_runs))


def run_starts(ordered: Column) -> Column:
    """Where the runs of equal members of a sorted array start, NULL for an empty array."""
    starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
    return F.when(F.size(ordered) > 0, starts)


def words_and_starts(col: Column | str) -> Column:
    """`ARRAY<STRUCT<word, start>>` of a text: its words as they stand, where they start in characters, and a last member without a word."""
    col = F.col(col) if isinstance(col, str) else col
    # A word with what follows it reaches to the next one, so each starts where those before it end.
    reach = F.transform(F.regexp_extract_all(col, F.lit(STEP), F.lit(0)), F.length)
    starts = running_sums(F.concat(F.array(F.length(F.regexp_extract(col, LEAD, 0))), reach))
    return F.arrays_zip(F.regexp_extract_all(col, F.lit(WORD), F.lit(0)).alias("word"), starts.alias("start")).cast("array<struct<word:string,start:bigint>>")


def token_places(col: Column | str) -> Column:
    """`ARRAY<STRUCT<position, token, start_offset, end_offset>>` of a text's tokens, offsets in characters."""

    def one(at: Column, i: Column) -> Column:
        word, start = at["word"], at["start"]
        return F.struct(
            i.alias("position"), F.lower(word).alias("token"), start.alias("start_offset"), (start + F.length(word)).alias("end_offset")
        )

    return let(words_and_starts(col), lambda ats: F.transform(F.slice(ats, F.lit(1), F.size(ats) - 1), one))


def term_runs(places: Column) -> Column:
    """`ARRAY<ARRAY<STRUCT<token, position, start_offset, end_offset>>>` of `token_places`: the places of each term, in order."""

    def runs_of(ordered: Column, words: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1)))
        return let(
            starts, lambda begin: F.transform(begin, lambda i, n: F.slice(ordered, i + 1, F.coalesce(F.get(begin, n + 1), F.size(words)) - i))
        )

    def by_token(of: Column) -> Column:
        fields = "array<struct<token:string,position:int,start_offset:bigint,end_offset:bigint>>"
        return F.sort_array(F.arrays_zip(*[of[c] for c in ("token", "position", "start_offset", "end_offset")]).cast(fields))

    def grouped(ordered: Column) -> Column:
        return let(ordered["token"], lambda words: runs_of(ordered, words))

    return let(places, lambda of: F.when(F.size(of) > 0, let(by_token(of), grouped)))


def term_count(words: Column, term: str) -> Column:
    """How often `term` occurs in a token array."""
    return F.size(F.filter(words, lambda w: w == F.lit(term)))
