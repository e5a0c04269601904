"""Document fingerprints: invertible Bloom lookup tables of paragraph digests.

A paragraph is a line; a line of more than `WORDS` words counts as several, cut
after every so many. Each distinct paragraph's 64-bit digest goes into one cell of
each of three regions of a table; a cell holds how many digests it got, their
exclusive or, and that of their check values. Two tables subtract cell by cell:
equal paragraphs vanish. A cell left with one digest gives it up, it is taken out of
its other cells, and so on until the table is empty (peeling): what came out is the
difference, with its side. Where cells remain, the difference was too large: it is
tried again with the digests dealt into parts of a few each, a table for each part,
and a part that fails is tried with larger tables and other positions.

The fingerprint is the smallest table, as text. Likeness is 1 - d / (a + b) for d
differing among a and b distinct paragraphs, 1 for two texts without any.

Everything is built-in functions on one row, so nothing but the pairing of a text
with the next one moves. Cases: a NULL text is empty; empty texts have the
empty table. A document without an id has no next one: its edited text is its first
half. Among rows with one id, the next document is that of the next greater id, its
least text if it has several. One document alone is its own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquery.llm.numbering import following
from docquery.session import materialize

WORDS = 20
REGIONS = 3
#: Cells of the fingerprint.
CELLS = 24
#: Digests that a part of a larger table is meant to hold.
LOAD = 7
#: Cells of a part's table at each attempt.
ATTEMPTS = (18, 36, 96, 384, 1536)
ROUNDS = 24
CELL = "struct<n:int,key:bigint,check:bigint>"


def _let(value: Column, then) -> Column:
    """`then` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def digests(text: Column, words: int = WORDS) -> Column:
    """The distinct paragraphs' 64-bit digests."""
    found = F.regexp_extract_all(text, F.lit(rf"(?:[^\s]++[^\S\n]*+){{1,{words}}}+"), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(F.rtrim(p))))


def _items(keys: Column, cells: int, seed: int) -> Column:
    """Digests with their check value and the number of their cell within each region."""
    width = cells // REGIONS

    def item(key: Column) -> Column:
        spread = F.xxhash64(key, F.lit(seed))
        at = [
            (F.shiftrightunsigned(spread, 20 * r).bitwiseAND(F.lit(0xFFFFF).cast("long")) % width).cast("int").alias(f"p{r}")
            for r in range(REGIONS)
        ]
        return F.struct(key.alias("key"), F.xxhash64(key, F.lit(seed + 1)).alias("check"), *at)

    return F.transform(keys, item)


def _cell(items: Column, start: Column, taken, region: int, cell: Column) -> Column:
    """`start` with what `taken` makes of each item of that cell, in one fold."""
    return F.aggregate(F.filter(items, lambda x: x[f"p{region}"] == cell), start.cast(CELL), lambda total, x: taken(total, x).cast(CELL))


def table(keys: Column, cells: int = CELLS, seed: int = 0) -> Column:
    """The table of an array of distinct digests: array<struct<n, key, check>>."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))

    def more(total: Column, x: Column) -> Column:
        return F.struct(
            (total["n"] + 1).alias("n"), total["key"].bitwiseXOR(x["key"]).alias("key"), total["check"].bitwiseXOR(x["check"]).alias("check")
        )

    def own_region(items: Column, region: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(cells // REGIONS - 1)), lambda i: _cell(items, empty, more, region, i))

    return _let(_items(keys, cells, seed), lambda items: F.concat(*[own_region(items, r) for r in range(REGIONS)]))


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(
        left,
        right,
        lambda a, b: F.struct(
            (a["n"] - b["n"]).alias("n"),
            a["key"].bitwiseXOR(b["key"]).alias("key"),
            a["check"].bitwiseXOR(b["check"]).alias("check"),
        ),
    )


def peel(cells: Column, count: int, seed: int, rounds: int = ROUNDS) -> Column:
    """The difference as array<struct<key, side>>, side 1 for the left table and -1 for the right; NULL if cells remain.

    Once a round finds no cell with one digest, the later rounds do nothing.
    """

    def step(state: Column) -> Column:
        lone = F.filter(
            state["cells"], lambda c: (F.abs(c["n"]) == 1) & (c["check"] == F.xxhash64(c["key"], F.lit(seed + 1)))
        )
        pure = F.array_distinct(F.transform(lone, lambda c: F.struct(c["key"].alias("key"), c["n"].alias("side"))))
        ended = F.struct(state["cells"].alias("cells"), state["found"].alias("found"), F.lit(False).alias("live")).cast(kind)
        return _let(pure, lambda found: F.when(F.size(found) == 0, ended).otherwise(taken(state, found).cast(kind)))

    def taken(state: Column, found: Column) -> Column:
        placed = F.zip_with(
            _items(F.transform(found, lambda x: x["key"]), count, seed), found, lambda item, x: item.withField("side", x["side"])
        )
        width = count // REGIONS

        def region(items: Column, r: int) -> Column:
            return F.transform(F.slice(state["cells"], r * width + 1, width), lambda c, i: _cell(items, c, less, r, i))

        return _let(
            placed,
            lambda items: F.struct(
                F.concat(*[region(items, r) for r in range(REGIONS)]).alias("cells"),
                F.concat(state["found"], found).alias("found"),
                F.lit(True).alias("live"),
            ),
        )

    def less(cell: Column, x: Column) -> Column:
        return F.struct(
            (cell["n"] - x["side"]).alias("n"), cell["key"].bitwiseXOR(x["key"]).alias("key"), cell["check"].bitwiseXOR(x["check"]).alias("check")
        )

    none = F.array().cast("array<struct<key:bigint,side:int>>")
    kind = f"struct<cells:array<{CELL}>,found:array<struct<key:bigint,side:int>>,live:boolean>"
    start = F.struct(cells.alias("cells"), none.alias("found"), F.lit(True).alias("live")).cast(kind)
    done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda state, _: F.when(state["live"], step(state)).otherwise(state))
    return _let(
        done,
        lambda state: F.when(
            F.forall(state["cells"], lambda c: (c["n"] == 0) & (c["key"] == 0) & (c["check"] == 0)), state["found"]
        ),
    )


def _attempt(left: Column, right: Column, cells: int, seed: int) -> Column:
    return peel(subtract(table(left, cells, seed), table(right, cells, seed)), cells, seed)


def _exact(left: Column, right: Column) -> Column:
    """What no table of the ladder gave up: practically never reached."""

    def only(a: Column, b: Column, side: int) -> Column:
        return F.transform(F.array_except(a, b), lambda k: F.struct(k.alias("key"), F.lit(side).alias("side")))

    return F.concat(only(left, right, 1), only(right, left, -1))


def _split(left: Column, right: Column, count: Column, seed: int, then) -> Column:
    """`then` of both arrays' digests of each of `count` parts, joined."""

    def dealt(keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(k.alias("key"), F.pmod(F.xxhash64(k, F.lit(seed)), count).cast("int").alias("part")))

    def own(rows: Column, part: Column) -> Column:
        return F.transform(F.filter(rows, lambda x: x["part"] == part), lambda x: x["key"])

    def of_part(rows: Column, part: Column) -> Column:
        return _let(F.struct(own(rows["left"], part).alias("a"), own(rows["right"], part).alias("b")), lambda pair: then(pair["a"], pair["b"]))

    return _let(
        F.struct(dealt(left).alias("left"), dealt(right).alias("right")),
        lambda rows: F.flatten(F.transform(F.sequence(F.lit(0), count - 1), lambda part: of_part(rows, part))),
    )


def difference(left: Column, right: Column, load: int = LOAD) -> Column:
    """The differing digests of two arrays, by tables of parts: as many parts as leave about `load` digests in each.

    The digests are dealt twice, into groups and these into parts, about as many of
    each, so that the work of a long text does not grow with the square of its length.
    """

    def of_part(a: Column, b: Column) -> Column:
        tries = [_attempt(a, b, cells, 100 + 2 * i) for i, cells in enumerate(ATTEMPTS)]
        return F.coalesce(*tries, _exact(a, b))

    def parts(a: Column, b: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil((F.size(a) + F.size(b)) / load).cast("int"))

    def of_group(a: Column, b: Column) -> Column:
        return _let(parts(a, b), lambda count: _split(a, b, count, 77, of_part))

    return _let(F.ceil(F.sqrt(parts(left, right))).cast("int"), lambda count: _split(left, right, count, 78, of_group))


def recovered(left: Column, right: Column, left_table: Column, right_table: Column) -> Column:
    """The difference of two texts: from their fingerprints, or from larger tables where that fails."""
    return F.coalesce(peel(subtract(left_table, right_table), CELLS, 0), difference(left, right))


def likeness(left: Column, right: Column, differing: Column) -> Column:
    total = F.size(left) + F.size(right)
    return F.when(total == 0, F.lit(1.0)).otherwise(1.0 - F.size(differing) / total.cast("double"))


def written(cells: Column) -> Column:
    """A table as text: 40 hex digits per cell, of which the first eight hold any count."""
    return F.array_join(
        F.transform(cells, lambda c: F.concat(F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 16, "0"))), ""
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, half, front, own, next_text): a text's first part and digests, with the whole next text.

    The next text is that of the next greater id, of the least one after the
    greatest, and "" without an id.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ids = materialize(rows.groupBy("doc_id").count(), "ids")
    pairs = following(ids, "doc_id")
    # The same plan on both sides, so that texts are dealt out by id once for both.
    later = rows
    if ids.filter("doc_id IS NOT NULL AND count > 1").limit(1).count():
        later = rows.groupBy("doc_id").agg(F.min("text").alias("text"))

    def half(text: Column) -> Column:
        return F.floor(F.length(text) / 2).cast("int")

    def parts(doc_id: Column, text: Column) -> list[Column]:
        return [
            doc_id.alias("doc_id"),
            F.length(text).cast("long").alias("n_chars"),
            half(text).alias("half"),
            F.substring(text, F.lit(1), F.length(text) - half(text)).alias("front"),
            digests(text).alias("own"),
        ]

    x, y = rows.alias("x"), later.alias("y")
    known = x.join(pairs, F.col("x.doc_id") == F.col("id")).select(*parts(F.col("x.doc_id"), F.col("x.text")), F.col("next_id"))
    named = known.alias("k").join(y, F.col("k.next_id") == F.col("y.doc_id")).select("k.doc_id", "n_chars", "half", "front", "own", F.col("y.text").alias("next_text"))
    nameless = rows.filter("doc_id IS NULL").select(*parts(F.col("doc_id"), F.col("text")), F.lit("").alias("next_text"))
    return named.unionByName(nameless)


def fingerprint(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    rows = with_next(docs).withColumn("edited", F.concat("front", F.substring(F.col("next_text"), F.lit(1), F.col("half"))))
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "own",
        digests(F.col("edited")).alias("other"),
        digests(F.col("next_text")).alias("later"),
    )
    rows = rows.select("*", *[table(F.col(c)).alias(f"{c}_table") for c in ("own", "other", "later")])
    rows = rows.select(
        "*",
        recovered(F.col("own"), F.col("other"), F.col("own_table"), F.col("other_table")).alias("differing"),
        recovered(F.col("own"), F.col("later"), F.col("own_table"), F.col("later_table")).alias("apart"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own_table")).alias("fingerprint"),
        written(F.col("other_table")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other"), F.col("differing")).alias("near_edited"),
        likeness(F.col("own"), F.col("later"), F.col("apart")).alias("near_next"),
    )
