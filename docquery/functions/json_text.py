"""Rewriting JSON text inside a row, at every level at once.

The text is cut into strings and what lies between them. A string followed by a
colon is a key. Nothing is parsed by Python and no row leaves its place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquery.functions.stored import let

_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_PIECE = rf'{_STRING}|[^"]++'
_BLANK = r'(?:null|""|\[\]|\{\})'
# Blank members and elements with the comma before them, or, at the front, all of them with those behind. Strings that aren't blank are numbers in quotes by then.
_MEMBER = rf',"[0-9]*":{_BLANK}(?=[,}}])|(?<=\{{)(?:"[0-9]*":{_BLANK}(?:,|(?=\}})))++'
_ELEMENT = rf',{_BLANK}(?=[,\]])|(?<=\[)(?:{_BLANK}(?:,|(?=\])))++'


def _pieces(json: Column) -> Column:
    return F.regexp_extract_all(json, F.lit(_PIECE), F.lit(0))


def _compact(json: Column) -> Column:
    """Without white space between tokens."""
    return F.array_join(F.transform(_pieces(json), lambda p: F.when(p.startswith('"'), p).otherwise(F.regexp_replace(p, r"\s+", ""))), "")


def rename_members(json: Column, rename: Callable[[Column], Column]) -> Column:
    """JSON text with `rename` applied to every key."""

    def rewritten(pieces: Column) -> Column:
        def one(piece: Column, i: Column) -> Column:
            is_key = piece.startswith('"') & F.coalesce(F.get(pieces, i + 1).startswith(":"), F.lit(False))
            plain = F.from_json(F.concat(F.lit('{"k":'), piece, F.lit("}")), "k string").getField("k")
            written = F.regexp_extract(F.to_json(F.struct(rename(plain).alias("k"))), r"(?s)^\{\"k\":(.*)\}$", 1)
            return F.when(is_key, written).otherwise(piece)

        return F.array_join(F.transform(pieces, one), "")

    return let(_pieces(_compact(json)), rewritten)


def _levels(text: Column) -> Column:
    """How deep objects and lists are nested in JSON text whose strings hold no brackets."""
    brackets = F.regexp_extract_all(text, F.lit(r"[\[\]{}]"), F.lit(0))

    def step(held: Column, bracket: Column) -> Column:
        now = held["now"] + F.when(bracket.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(held["most"], now).alias("most"))

    return F.aggregate(brackets, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda held: held["most"])


def strip_members(json: Column) -> Column:
    """JSON text without blank members and elements ("", null, empty lists and objects); NULL when nothing is left.

    A round takes away what is blank; what that empties goes in the next one, so there are at most as many as there are levels.
    """

    def numbered(pieces: Column) -> Column:
        held = F.transform(pieces, lambda p, i: F.when(p.startswith('"') & (p != '""'), F.concat(F.lit('"'), i.cast("string"), F.lit('"'))).otherwise(p))
        # An empty key is no blank value: it gets a number too.
        kept = F.transform(held, lambda p, i: F.when((p == '""') & F.coalesce(F.get(pieces, i + 1).startswith(":"), F.lit(False)), F.concat(F.lit('"'), i.cast("string"), F.lit('"'))).otherwise(p))
        return let(F.array_join(kept, ""), lambda text: restored(pieces, emptied(text)))

    def emptied(text: Column) -> Column:
        def round_(held: Column, _: Column) -> Column:
            return F.regexp_replace(F.regexp_replace(held, _MEMBER, ""), _ELEMENT, "")

        return F.aggregate(F.sequence(F.lit(0), _levels(text)), text, round_)

    def restored(pieces: Column, text: Column) -> Column:
        back = F.transform(_pieces(text), lambda p: F.when(p.rlike('^"[0-9]+"$'), F.get(pieces, F.regexp_extract(p, "[0-9]+", 0).cast("int"))).otherwise(p))
        return F.array_join(back, "")

    stripped = let(_pieces(_compact(json)), numbered)
    return let(stripped, lambda s: F.when(~s.rlike(rf"^{_BLANK}$"), s))
