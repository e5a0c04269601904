"""Personal data: fixed patterns find seeds, and the contexts they stand in find more.

Four fixed patterns give the base spans. Their texts are the seeds of a graph: an
instance is a distinct text that looks like an identifier, a pattern is what
stands around it (two words before, two after, or one on each side), and an edge
says that the two were seen together. Patterns are scored by their instances, and
instances by their patterns, in turns: a pattern's confidence in a kind is the
sum of its instances' confidences in it, over the number of its instances plus
`DOUBT`; an instance that is no seed has the confidence that not all of its
trusted patterns are wrong. What reaches `TRUST` stays in the game, until nothing
changes or `ROUNDS` are over. Instances trusted at the end are personal data
wherever they stand, also in contexts that no seed was seen in.

Only what a kind could be at all is taken for it (`_FITS`), and only where no base
span is. All work is column expressions, joins and aggregations; texts are read
once and never move. Graph tables hold distinct pairs; a table of trusted
patterns or instances is broadcast only if its size allows it.

Contexts reach 48 code points to either side. In them A-Z are lower-cased,
digits are 0, and a neighbouring span of the same search is a word `<id>`.

Cases: a NULL, empty or very short text has no spans. Repeated rows are judged
row by row, but count once as instances. An instance that two kinds claim goes to
the more confident one, then to the first listed. An empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docquery.functions.stored import let
from docquery.functions.sums import running_sums
from docquery.session import bounded_broadcast, materialize

KINDS = ("email", "ip", "card", "phone")
#: A pattern of n pure instances has confidence n / (n + DOUBT); five of them reach TRUST.
DOUBT = 2.0
TRUST = 0.7
ROUNDS = 5
REACH = 48

# Possessive forms of the patterns, and matches that begin only where a run or the search does: they match the same, in linear time.
_BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried.
_NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][ -]?[0-9]", "phone": r"\+[0-9]"}
_ANY = "[0-9@]|[(\\[]at[)\\]]|:[0-9A-Fa-f]{0,4}:"
#: Texts that look like identifiers: addresses with @ or (at), dotted numbers, groups with colons, and digits with separators.
_CANDIDATE = "|".join(
    (
        r"(?:\G|(?<![^\s@<>,;:\"]))[^\s@<>,;:\"]++@[^\s@<>(),;:\"]*[A-Za-z0-9]",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*+",
        r"(?<![0-9A-Za-z.])[0-9]++(?:\.[0-9]++){3}+(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,}+(?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ()/-]{0,2}+[0-9]){5,}+(?![0-9A-Za-z])",
    )
)
_DIGIT_GROUPS = r"^[0-9 ()+/-]+$"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    """What a match of the kind's pattern must pass besides."""
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(12, 19) & F.call_function("luhn_check", d))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _fits(kind: str, value: Column) -> Column:
    """Whether a candidate could be of the kind."""
    if kind == "email":
        return value.rlike(r"@|[(\[]at[)\]]")
    if kind == "ip":
        return value.rlike(r"^[0-9.]+$|:")
    least, most = (12, 19) if kind == "card" else (6, 15)
    return value.rlike(_DIGIT_GROUPS) & F.length(_digits(value)).between(least, most)


def _spans(text: Column, pattern: str, kind: str | None) -> Column:
    """`ARRAY<STRUCT<start, kind, end, value, before, after>>` of the matches, in code points, end exclusive."""
    pieces = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))

    def place(p: Column) -> Column:
        lengths = F.transform(p["hits"], lambda hit, i: F.length(F.get(p["gaps"], i)) + F.length(hit))
        all_ = let(running_sums(lengths), lambda ends: F.transform(p["hits"], lambda hit, i: one(p, ends, hit, i)))
        return F.filter(all_, lambda s: _valid(kind, s["value"])) if kind else all_

    def one(p: Column, ends: Column, hit: Column, i: Column) -> Column:
        before = F.concat(F.when(i > 0, "<id> ").otherwise(""), F.substring(F.get(p["gaps"], i), -REACH, REACH))
        after = F.concat(F.substring(F.get(p["gaps"], i + 1), 1, REACH), F.when(i + 1 < F.size(p["hits"]), " <id>").otherwise(""))
        end = F.get(ends, i)
        return F.struct(
            (end - F.length(hit)).alias("start"),
            F.lit(KINDS.index(kind) if kind else None).cast("int").alias("kind"),
            end.alias("end"),
            F.lower(hit).alias("value"),
            before.alias("before"),
            after.alias("after"),
        )

    return let(pieces, place)


_SPAN = "array<struct<start: bigint, kind: int, end: bigint, value: string, before: string, after: string>>"


def find(docs: DataFrame) -> DataFrame:
    """doc_id, `row`, one array of base spans per kind, and `candidates`, for every row of `docs`."""
    none = F.array().cast(_SPAN)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.when(text.rlike(_ANY), text).alias("text"))
    columns = [F.when(F.col("text").rlike(_NEEDS[k]), _spans(F.col("text"), _BASE[k], k)).otherwise(none).alias(k) for k in KINDS]
    candidates = F.when(F.col("text").isNotNull(), _spans(F.col("text"), _CANDIDATE, None)).otherwise(none)
    return rows.select("doc_id", F.monotonically_increasing_id().alias("row"), *columns, candidates.alias("candidates"))


def _contexts(before: Column, after: Column) -> Column:
    """The lexical patterns of an occurrence: two words before it, two after it, one on each side."""

    def words(text: Column) -> Column:
        return F.regexp_extract_all(F.regexp_replace(F.lower(text), "[0-9]", "0"), F.lit(r"\S+"), F.lit(0))

    def join(w: Column) -> Column:
        left, right = w["before"], w["after"]
        last, first = F.element_at(left, -1), F.get(right, F.lit(0))
        return F.filter(
            F.array(
                F.when(F.size(left) > 1, F.concat(F.element_at(left, -2), F.lit(" "), last, F.lit(" _"))),
                F.when(F.size(right) > 1, F.concat(F.lit("_ "), first, F.lit(" "), F.get(right, F.lit(1)))),
                F.when((F.size(left) > 0) & (F.size(right) > 0), F.concat(last, F.lit(" _ "), first)),
            ),
            F.isnotnull,
        )

    return let(F.struct(words(before).alias("before"), words(after).alias("after")), join)


def occurrences(found: DataFrame) -> DataFrame:
    """(row, start, kind, end, value, patterns): the base spans, and the candidates that none of them touches, with kind NULL."""
    spans = F.concat(*KINDS, "candidates")
    rows = found.filter(F.size(spans) > 0).select("row", F.inline(spans))
    # Where base spans come first at equal starts, a candidate is free if those before it have ended and the next one begins behind it.
    along = Window.partitionBy("row").orderBy("start", F.col("kind").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.col("kind").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    seed = F.col("kind").isNotNull()
    ended = rows.withColumn("_ended", F.max(F.when(seed, F.col("end"))).over(along)).withColumn("_next", F.min(F.when(seed, F.col("start"))).over(back))
    free = (F.coalesce("_ended", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("_next") >= F.col("end"), F.lit(True)))
    return ended.filter(seed | free).select("row", "start", "kind", "end", "value", _contexts(F.col("before"), F.col("after")).alias("patterns"))


def bootstrap(seen: DataFrame, trust: float = TRUST, doubt: float = DOUBT, rounds: int = ROUNDS) -> DataFrame:
    """(value, kind) of the candidates that are trusted at the end. `seen` should be a written table of `occurrences`."""
    edges = seen.select("kind", "value", F.explode("patterns").alias("pattern")).distinct()
    edges = materialize(edges, "edges")
    counts = [F.count_if(F.col("kind") == k).cast("double").alias(f"seeds_{k}") for k in range(len(KINDS))]
    patterns = edges.groupBy("pattern").agg(F.count("*").alias("n"), *counts)
    # Confidence never exceeds this, so other patterns need no look again: all their candidates would have to be trusted fully.
    seeds = [F.col(f"seeds_{k}") for k in range(len(KINDS))]
    others, best = F.col("n") - reduce(add, seeds), F.greatest(*seeds)
    patterns = patterns.filter((others > 0) & (best > 0) & ((best + others) / (F.col("n") + doubt) >= trust))
    patterns = materialize(patterns, "patterns")
    open_edges = edges.filter("kind IS NULL").drop("kind").join(bounded_broadcast(patterns.select("pattern")), "pattern", "left_semi")
    open_edges = materialize(open_edges, "open")
    by_kind = patterns.select("pattern", "n", F.posexplode(F.array(*seeds)).alias("kind", "seeds"))
    fits = F.array(*[_fits(k, F.col("value")) for k in KINDS])
    trusted, before = None, (0, 0.0)
    for _ in range(rounds):
        gained = F.lit(0.0)
        scored = by_kind
        if trusted is not None:
            more = open_edges.join(bounded_broadcast(trusted), "value").groupBy("pattern", "kind").agg(F.sum("confidence").alias("gained"))
            scored = by_kind.join(more, ["pattern", "kind"], "left")
            gained = F.coalesce("gained", F.lit(0.0))
        sure = scored.withColumn("belief", (F.col("seeds") + gained) / (F.col("n") + doubt)).filter((F.col("belief") >= trust) & (F.col("seeds") > 0))
        sure = sure.select("pattern", "kind", "belief")
        backed = open_edges.join(bounded_broadcast(sure), "pattern").filter(F.get(fits, F.col("kind")))
        trusted = backed.groupBy("value", "kind").agg((1 - F.product(1 - F.col("belief"))).alias("confidence"))
        trusted = materialize(trusted.filter(F.col("confidence") >= trust), "trusted")
        now = trusted.agg(F.count("*"), F.round(F.sum("confidence"), 9)).first()
        if now[0] == 0 or tuple(now) == before:
            break
        before = tuple(now)
    choice = F.struct((-F.col("confidence")).alias("c"), "kind")
    return trusted.groupBy("value").agg(F.min(choice).alias("best")).select("value", F.col("best.kind").alias("kind"))


def _digest(spans: Column) -> Column:
    """`kind:start:end` of spans by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, trust: float = TRUST, doubt: float = DOUBT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base counts by kind, base_sha256, spans (base and discovered ones) and n_added, for every row of `docs`."""
    found = materialize(find(docs), "found")
    seen = materialize(occurrences(found), "seen")
    trusted = bootstrap(seen, trust, doubt, rounds)
    spot = F.struct("start", "kind", "end")
    free = seen.filter("kind IS NULL").select("row", "start", "end", "value")
    added = free.join(bounded_broadcast(trusted), "value").groupBy("row").agg(F.collect_list(spot).alias("added"))
    base = F.transform(F.concat(*KINDS), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = found.select("doc_id", "row", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], base.alias("base"), (F.size("candidates") > 0).alias("asked"))
    # Only rows with candidates meet what was discovered.
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    joined = rows.filter("asked").join(added, "row", "left").withColumn("added", F.coalesce("added", none))
    whole = rows.filter("NOT asked").withColumn("added", none).unionByName(joined)
    return whole.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS],
        F.sha2(_digest(F.col("base")), 256).alias("base_sha256"),
        _digest(F.concat("base", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
