"""Even shards by balanced label propagation over links between documents.

Documents start evenly spread. In each round every linked document learns, by
joins, how many of its neighbours lie in each shard, and asks to move to the
shard with most of them. Quotas decide how many of those who ask may go from one
shard to another: exchanges both ways, and the room that the shard has besides
its own linked documents, since documents without links can give way anywhere.
The rounds end before every document has moved. So each group of equal texts is
then placed whole, the largest first: in the shard that holds most of it, else in
the one with most room. A group that fits nowhere whole fills the shards with most
room, and there are no more such groups than shards. At the end, documents without
links fill every shard to its exact share, so that counts differ by one at most.

The links used here join documents of equal texts: each to the first of its group,
as a group's links in a star need one row per document.

Cases: a NULL or empty text has 0 bytes and size 1, and is equal to other empty
ones. Repeated rows are documents of their own. Any group may be larger than a
shard; it then fills as few shards as their room allows. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquery.llm.numbering import ROWS_PER_GROUP, groups, numbered
from docquery.session import join_statistics, materialize

SHARDS = 8
ROUNDS = 6


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard, linked) for `nodes` (node) and `links` (a, b), before the counts are made even."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    # How many links lead to a node: a group's hub has as many as the group has members.
    degrees = both.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("degree"))
    spread = F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int")
    apart = both.select(F.col("a").alias("node")).distinct()
    linked = materialize(apart.withColumn("shard", spread).join(degrees, "node"), "labels")
    total = nodes.count()
    capacity = -(-total // shards)
    for turn in range(rounds):
        there = linked.select(F.col("node").alias("b"), F.col("shard").alias("there"), "degree")
        votes = join_statistics(both, there, "b", "degree").groupBy("a", "there").agg(F.count("*").alias("votes"))
        best = votes.groupBy(F.col("a").alias("node")).agg(
            F.max(F.struct("votes", (-F.col("there")).alias("to"))).alias("best"),
            F.map_from_entries(F.collect_list(F.struct("there", "votes"))).alias("all"),
        )
        asked = linked.join(best, "node").select(
            "node",
            "shard",
            "degree",
            (-F.col("best.to")).cast("int").alias("to"),
            (F.col("best.votes") - F.coalesce(F.try_element_at("all", "shard"), F.lit(0))).alias("gain"),
        )
        # Half of the documents may ask in a round, else two neighbours change places for ever.
        turned = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(2)) == 0
        asked = materialize(asked.withColumn("asks", (F.col("gain") > 0) & (F.col("to") != F.col("shard")) & turned), "asked")
        held = {r["shard"]: r["n"] for r in asked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        wants = {(r["shard"], r["to"]): r["n"] for r in asked.filter("asks").groupBy("shard", "to").agg(F.count("*").alias("n")).collect()}
        if not asked.filter("gain > 0").limit(1).count():
            break
        chance = _chances(wants, held, capacity)
        allowed = F.lit(False)
        for (start, end), part in chance.items():
            lot = F.pmod(F.xxhash64("node", F.lit(turn), F.lit("lot")), F.lit(1_000_000)) < int(part * 1_000_000)
            allowed = allowed | ((F.col("shard") == start) & (F.col("to") == end) & lot)
        linked = materialize(asked.select("node", F.when(F.col("asks") & allowed, F.col("to")).otherwise(F.col("shard")).alias("shard"), "degree"), "labels")
    placed = nodes.select("node").join(linked, "node", "left")
    return placed.select("node", F.coalesce("shard", spread).alias("shard"), F.col("shard").isNotNull().alias("linked"))


def _chances(wants: dict[tuple[int, int], int], held: dict[int, int], capacity: int) -> dict[tuple[int, int], float]:
    """The part of those who ask to go from one shard to another that may: exchanges, then room."""
    out = {}
    for (start, end), n in wants.items():
        exchanged = min(n, wants.get((end, start), 0))
        rest = sum(w - min(w, wants.get((end, s), 0)) for (s, e), w in wants.items() if e == end)
        room = max(0, capacity - held.get(end, 0))
        more = (n - exchanged) * min(1.0, room / rest) if rest else 0
        out[start, end] = min(1.0, (exchanged + more) / n)
    return out


def shares(total: int, shards: int = SHARDS) -> dict[int, int]:
    """The exact number of documents of each shard."""
    return {s: total // shards + (s < total % shards) for s in range(shards)}


def plan(
    counts: dict[tuple[int, int], int], share: dict[int, int]
) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int, int, int, int]]]:
    """Where groups go, for the number of groups of each (shard that holds most of it, size).

    Groups of one shard and size are alike and go by their rank. Whole ones are
    (home, size, first rank, end rank, shard); of those that fit nowhere whole, a
    stretch of members is (home, size, rank, first member, end member, shard).
    """
    room, whole, cut = dict(share), [], []

    def put(home: int, size: int, done: int, many: int, to: int) -> int:
        many = min(many, room[to] // size)
        if many:
            whole.append((home, size, done, done + many, to))
            room[to] -= many * size
        return many

    for size in sorted({n for _, n in counts}, reverse=True):
        left = {home: counts[home, size] for home in sorted(share) if (home, size) in counts}
        done = {home: put(home, size, 0, n, home) for home, n in left.items()}
        for home, n in left.items():
            for to in sorted(room, key=lambda s: (-room[s], s)):
                done[home] += put(home, size, done[home], n - done[home], to)
            for rank in range(done[home], n):
                placed = 0
                while placed < size:
                    to = max(room, key=lambda s: (room[s], s == home, -s))
                    many = min(size - placed, room[to])
                    cut.append((home, size, rank, placed, placed + many, to))
                    room[to] -= many
                    placed += many
    return whole, cut


def gathered(linked: DataFrame, share: dict[int, int], per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """`linked` (node, shard, bond) with the rows of one bond in one shard, or in as few as have the room."""
    spark = linked.sparkSession
    linked = materialize(linked, "linked")
    held = linked.groupBy("bond", "shard").agg(F.count("*").alias("held"))
    bonds = held.groupBy("bond").agg(F.sum("held").alias("n"), F.max(F.struct("held", (-F.col("shard")).alias("at"))).alias("most"))
    bonds = materialize(bonds.select("bond", "n", (-F.col("most.at")).cast("int").alias("home")), "bonds")
    # One row per home and size; there are far fewer sizes than documents, as their sum is bounded by these.
    counts = {(r["home"], r["n"]): r["bonds"] for r in bonds.groupBy("home", "n").agg(F.count("*").alias("bonds")).collect()}
    whole, cut = plan(counts, share)
    order = F.pmod(F.xxhash64("bond"), F.lit(groups(sum(counts.values()), per_group)))
    ranked = materialize(numbered(bonds, ["home", "n"], order, ["bond"], "rank"), "ranked")
    ranges = F.broadcast(spark.createDataFrame(whole, "home int, n long, first long, end long, to int"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    homes = ranked.join(ranges, ["home", "n"]).filter(inside).select("bond", "n", "to")
    out = join_statistics(linked.select("node", "bond"), materialize(homes, "homes"), "bond", "n").select("node", F.col("to").alias("shard"))
    if not cut:
        return out
    # No more bonds than shards are cut.
    stretches = spark.createDataFrame(cut, "home int, n long, rank long, first long, end long, to int")
    parts = materialize(ranked.join(F.broadcast(stretches), ["home", "n", "rank"]).select("bond", "first", "end", "to"), "cut")
    members = linked.select("node", "bond").join(F.broadcast(parts.select("bond").distinct()), "bond")
    order = F.pmod(F.xxhash64("node"), F.lit(groups(sum(end - first for *_, first, end, _ in cut), per_group)))
    places = numbered(materialize(members, "members"), ["bond"], order, ["node"], "place")
    inside = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("end"))
    return out.unionByName(places.join(F.broadcast(parts), "bond").filter(inside).select("node", F.col("to").alias("shard")))


def evened(placed: DataFrame, share: dict[int, int], per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """`placed` (node, shard, linked) with `share` documents in each shard, where those without links give way.

    No shard may have more linked documents than its share.
    """
    placed = materialize(placed, "placed")
    counts = dict.fromkeys(share, 0) | {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    free = placed.filter(~F.col("linked"))
    group = F.pmod(F.xxhash64("node"), F.lit(groups(sum(counts.values()), per_group)))
    ranked = numbered(free, ["shard"], group, ["node"], "rank")
    place, moved = F.lit(None).cast("long"), 0
    for s in sorted(counts):
        surplus = max(0, counts[s] - share[s])
        place = F.when((F.col("shard") == s) & (F.col("rank") < surplus), F.col("rank") + moved).otherwise(place)
        moved += surplus
    new, taken = F.col("shard"), 0
    for s in sorted(counts):
        missing = max(0, share[s] - counts[s])
        new = F.when((F.col("place") >= taken) & (F.col("place") < taken + missing), F.lit(s)).otherwise(new)
        taken += missing
    dealt = ranked.withColumn("place", place).select("node", new.cast("int").alias("shard"))
    return dealt.unionByName(placed.filter("linked").select("node", "shard"))


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document, by the law of equal row counts."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text, F.md5(text)).alias("bond"),
        F.monotonically_increasing_id().alias("node"),
    )
    rows = materialize(rows, "documents")
    hubs = materialize(rows.groupBy("bond").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    links = join_statistics(rows, hubs, "bond", "n").filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    total = rows.count()
    share = shares(total, shards)
    placed = materialize(propagate(rows.select("node"), links, shards, rounds).join(rows.select("node", "bond"), "node"), "propagated")
    whole = gathered(placed.filter("linked").select("node", "shard", "bond"), share, per_group).withColumn("linked", F.lit(True))
    free = placed.filter("NOT linked").select("node", "shard", "linked")
    even = materialize(evened(free.unionByName(whole), share, per_group), "shards")
    group = F.pmod(F.xxhash64("node"), F.lit(groups(total, per_group)))
    slots = numbered(even, ["shard"], group, ["node"], "slot")
    return rows.join(slots, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
