"""Search, term vectors, paging, evaluation and layout against brute force."""

import math
import random
from collections import Counter

import pytest
import regex
from pyspark.sql import functions as F

from docquery import session
from docquery.functions.sums import running_sums
from docquery.functions.text import query_terms, term_frequencies, tokens
from docquery.model import source
from docquery.operators import documents, evaluate, paging, profile, search, templates, text_analysis, tiles
from docquery.plans import search_plans
from docquery.sources import layout
from docquery.sources.scan import spread

TEXTS = {
    "a": "The cat, the dog_1 and THE bird",
    "b": "A dog; a bird.",
    "c": "Größe über alles — dog",
    "d": "",
    "e": "...",
    "f": "bird bird bird bird cat",
    "g": "2 cats 2 dogs",
    "h": "the " * 500,
}


def words(text):
    return [w.lower() for w in regex.findall(r"[\p{L}\p{N}_]+", text)]


def bm25(texts, query):
    counts = {k: Counter(words(t)) for k, t in texts.items() if words(t)}
    n, avgdl = len(counts), sum(c.total() for c in counts.values()) / len(counts)
    out = {}
    for key, c in counts.items():
        score = 0.0
        for w in set(words(query)) & set(c):
            df = sum(w in o for o in counts.values())
            score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * c[w] / (c[w] + 1.2 * (0.25 + 0.75 * c.total() / avgdl))
        if set(words(query)) & set(c):
            out[key] = round(score, 6)
    return sorted(out.items(), key=lambda kv: (-kv[1], kv[0]))


@pytest.fixture
def table(docs):
    return docs({k: (t, len(t)) for k, t in TEXTS.items()}, "text string, n int", "docs")


def hits(df):
    return [(r["_id"], r["_score"]) for r in df.collect()]


@pytest.mark.parametrize("query", ["dog", "the bird", "cat the the zebra", "über 2"])
def test_search_equals_brute_force(table, query):
    assert hits(search.search(table, "_source.text", query)) == bm25(TEXTS, query)


def test_search_options(table):
    every = bm25(TEXTS, "the dog bird")
    assert hits(search.search(table, "_source.text", "the dog bird", size=2)) == every[:2]
    kept = search.search(table, "_source.text", "the dog bird", where=source("n") < 30)
    assert hits(kept) == [h for h in every if len(TEXTS[h[0]]) < 30]
    by_length = search.search(table, "_source.text", "the dog bird", sort=[(source("n"), True)])
    assert [k for k, _ in hits(by_length)] == sorted((k for k, _ in every), key=lambda k: (-len(TEXTS[k]), k))
    assert search.search(table, "_source.text", "...").count() == 0
    assert search.search(table, "_source.text", "zebra").count() == 0
    assert sorted(hits(search.scores(table, "_source.text", "the dog bird"))) == sorted(every)
    assert hits(search.search(table, "_source.text", "the dog bird", size=search.MAX_SIZE + 1)) == every
    assert search.count(table, source("n") > 5).first()["count"] == 6


@pytest.mark.parametrize("bound", [500_000, 0])
def test_msearch_equals_single_searches(spark, table, monkeypatch, bound):
    """Also where nothing may be broadcast."""
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    asked = {1: "dog", 2: "the bird", 3: "zebra", 4: "", 5: "cat 2 über"}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, text string")
    out = {}
    for r in search.msearch(table, "_source.text", queries, size=3).collect():
        out.setdefault(r.query_id, []).append((r["_rank"], r["_id"], r["_score"]))
    for key, text in asked.items():
        assert sorted(out.get(key, [])) == [(n, *h) for n, h in enumerate(bm25(TEXTS, text)[:3], 1)]


def test_msearch_targets_have_their_own_statistics(spark, docs, table):
    other = {"a": "dog dog", "x": "bird"}
    both = table.unionByName(docs({k: (t, 0) for k, t in other.items()}, "text string, n int", "other"))
    queries = spark.createDataFrame([(1, "dog", "other"), (2, "dog", None), (3, "dog", "none")], "query_id int, text string, _index string")
    out = search.msearch(both, "_source.text", queries, default_index="docs").collect()
    found = {q: [(r["_id"], r["_score"]) for r in sorted(out, key=lambda r: r["_rank"]) if r.query_id == q] for q in (1, 2, 3)}
    assert found == {1: bm25(other, "dog"), 2: bm25(TEXTS, "dog"), 3: []}


def test_explain_sums_up_to_the_score(spark, table):
    asked = spark.createDataFrame([("a",), ("f",), ("d",), ("zz",)], "_id string")
    rows = search.explain(table, "_source.text", "the bird", asked).collect()
    assert len(rows) == 8
    total = {k: sum(r.contribution for r in rows if r["_id"] == k) for k in "af"}
    scores = dict(bm25(TEXTS, "the bird"))
    assert all(abs(total[k] - scores[k]) < 2e-6 for k in "af")
    assert not any(r.matched for r in rows if r["_id"] in ("d", "zz"))


def test_terms(spark, table):
    assert query_terms("The THE dog-1") == ["the", "dog", "1"]
    assert [r.term for r in search.terms_enum(table, tokens(source("text")), "do").collect()] == ["dog", "dog_1", "dogs"]
    counted = table.select("_id", term_frequencies(tokens(source("text"))).alias("t")).collect()
    for r in counted:
        expected = Counter(words(TEXTS[r["_id"]]))
        assert {x.term: x.tf for x in r.t or []} == expected


def test_analyze_offsets(spark):
    texts = {1: "  Ab, cd_1\n—Éf", 2: "x", 3: "", 4: "!?", 5: "𝒳y 𝒳"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    out = sorted(tuple(r) for r in text_analysis.analyze(df, "id", "t").collect())
    expected = [
        (k, n, m.group().lower(), m.start(), m.end())
        for k, t in texts.items()
        for n, m in enumerate(regex.finditer(r"[\p{L}\p{N}_]+", t))
    ]
    assert out == sorted(expected)


@pytest.mark.parametrize("bound", [500_000, 3, 0])
def test_termvectors_equal_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(session, "BROADCAST_ROWS", bound)
    df = spark.createDataFrame(list(TEXTS.items()), "id string, t string")
    some = spark.createDataFrame([("a",), ("a",), ("f",), ("none",)], "id string")
    counts = {k: Counter(words(t)) for k, t in TEXTS.items() if words(t)}
    field = (len(counts), sum(len(c) for c in counts.values()), sum(c.total() for c in counts.values()))
    for requests, keys in ((None, set(counts)), (some, {"a", "f"})):
        out = text_analysis.termvectors(df, "id", "t", requests).collect()
        found = {(r.id, r.term): (r.tf, tuple(r.positions), r.doc_freq, r.total_tf) for r in out}
        expected = {
            (k, w): (
                n,
                tuple(i for i, x in enumerate(words(TEXTS[k])) if x == w),
                sum(w in c for c in counts.values()),
                sum(c[w] for c in counts.values()),
            )
            for k in keys
            for w, n in counts[k].items()
        }
        assert found == expected
        assert {(r.doc_count, r.sum_doc_freq, r.sum_total_tf) for r in out} == {field}


def test_mtermvectors_take_each_index_for_itself(spark):
    tables = {n: spark.createDataFrame([("1", t)], "id string, t string") for n, t in (("a", "x y"), ("b", "x x"))}
    asked = spark.createDataFrame([("1", "b"), ("1", None)], "id string, _index string")
    out = {(r["_index"], r.term): r.total_tf for r in text_analysis.mtermvectors(tables, "id", "t", asked, "a").collect()}
    assert out == {("a", "x"): 1, ("a", "y"): 1, ("b", "x"): 2}


def test_positions_under_a_hot_value(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    out = [r["_position"] for r in paging.with_position(df, ["k", "id"]).orderBy("k", "id").collect()]
    assert out == list(range(1, 5001))
    pages = paging.number_pages(df, ["k", "id"], 999).groupBy("_page").count().orderBy("_page").collect()
    assert [r["count"] for r in pages] == [999, 999, 999, 999, 999, 5]


def test_all_pages_pass_through_no_single_task(spark, sf):
    pages = search_plans.scroll_all_pages(spark, sf)
    assert "Limit" not in pages._jdf.queryExecution().toString()
    counts = {r["page"]: r["count"] for r in pages.groupBy("page").count().collect()}
    assert sorted(counts) == [1, 2, 3, 4, 5] and max(counts.values()) - min(counts.values()) < 5


def test_pages_follow_each_other(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id").repartition(4)
    seen, after = [], None
    while True:
        rows = paging.page(df, ["k", "id"], after, 30).collect()
        if not rows:
            break
        seen += [tuple(r) for r in rows]
        after = seen[-1]
    assert seen == sorted((i % 7, i) for i in range(100))


def test_rank_eval_metrics(spark):
    results = spark.createDataFrame(
        [(1, "a", 3.0), (1, "b", 2.0), (1, "c", 1.0), (2, "a", 1.0)], "query_id int, _id string, _score double"
    )
    ratings = spark.createDataFrame([(1, "b", 1), (1, "c", 3), (1, "x", 1), (2, "a", 0)], "query_id int, _id string, rating int")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id int")

    def scores(metric, k=10):
        return {r.query_id: r.metric_score for r in evaluate.rank_eval(results, ratings, metric, k, queries=queries).collect()}

    assert scores("precision") == {1: round(2 / 3, 6), 2: 0.0, 3: 0.0}
    assert scores("precision", 2) == {1: 0.5, 2: 0.0, 3: 0.0}
    assert scores("recall") == {1: round(2 / 3, 6), 2: 0.0, 3: 0.0}
    assert scores("mean_reciprocal_rank") == {1: 0.5, 2: 0.0, 3: 0.0}
    assert scores("dcg") == {1: round(1 / math.log2(3) + 7 / 2, 6), 2: 0.0, 3: 0.0}
    mean = evaluate.mean_score(evaluate.rank_eval(results, ratings, "precision", 10, queries=queries)).first()
    assert (mean.queries, mean.metric_score) == (3, round(2 / 9, 6))
    with pytest.raises(ValueError):
        evaluate.rank_eval(results, ratings, "other")


def test_templates(spark):
    spark.range(10).createOrReplaceTempView("docquery_ten")
    query = "SELECT count(*) AS n FROM docquery_ten WHERE id < :q"
    assert templates.search_template(spark, query, {"q": 4}).first().n == 4
    assert templates.search_template(spark, "few", {"q": 2}, stored={"few": query}).first().n == 2
    df = spark.range(20).select((F.col("id") % 3).alias("g"), "id")
    params = spark.createDataFrame([(1, 0, 5), (2, 1, 100)], "query_id int, p int, low int")
    out = templates.msearch_template(df, params, {"g": "p"}, F.col("id") > F.col("low"), 2, [F.col("id")])
    assert [(r.query_id, r.id) for r in out.orderBy("query_id", "id").collect()] == [(1, 6), (1, 9)]
    assert templates.msearch_template(df, params, {"g": "p"}, size=None).count() == 14
    with pytest.raises(ValueError):
        templates.msearch_template(df, params, {})


def test_tiles(spark):
    df = spark.createDataFrame([(0.0, 0.0), (84.0, -179.9), (86.0, 0.0), (-10.0, 180.0), (None, 1.0)], "lat double, lon double")
    world = tiles.tile_grid(df, F.col("lat"), F.col("lon"), 0, 0, 0, 1).collect()
    assert {(r.cell_x, r.cell_y): r.n for r in world} == {(1, 1): 2, (0, 0): 1}


def test_layout(spark, docs, tmp_path):
    df = docs({str(n): (n,) for n in range(200)}, "n int")
    four = layout.split(df, 2, 2, str(tmp_path / "four"))
    two = layout.shrink(four, 4, 2, str(tmp_path / "two"))
    joined = {r["_id"]: r["_shard"] for r in four.collect()}
    assert all(r["_shard"] == joined[r["_id"]] % 2 for r in two.collect()) and two.count() == 200
    again = layout.clone(spark, str(tmp_path / "four"), str(tmp_path / "copy"))
    assert {r["_id"]: r["_shard"] for r in again.collect()} == joined
    assert [r["_source"].n for r in documents.get(four, "17", 4).collect()] == [17]
    touched = profile.search_shards(spark, str(tmp_path / "four"), F.col("_id") == "7").collect()
    assert [(r["_shard"], r.rows) for r in touched] == [(joined["7"], 1)]
    with pytest.raises(ValueError):
        layout.shrink(four, 4, 3, str(tmp_path / "none"))
    layout.write_routed(df, source("n"), lambda n: F.concat(F.lit("t-"), (n % 3).cast("string")), str(tmp_path / "routed"))
    routed = spark.read.parquet(str(tmp_path / "routed"))
    assert {r["_index"]: r["count"] for r in routed.groupBy("_index").count().collect()} == {"t-0": 67, "t-1": 67, "t-2": 66}
    files = profile.segments(spark, str(tmp_path / "four")).collect()
    assert sum(r.rows for r in files) == 200 and all(r.bytes > 0 for r in files)


def test_forcemerge_leaves_few_files(spark, tmp_path):
    log = spark.createDataFrame(
        [(n, "delete" if n % 4 == 3 else "index", str(n // 2 % 20), (n,)) for n in range(100)],
        "seq bigint, action string, _id string, doc struct<n:int>",
    )
    merged = layout.forcemerge(None, log, str(tmp_path / "m"), 2)
    assert profile.segments(spark, str(tmp_path / "m")).count() <= 2
    assert {r["_id"]: r["_source"].n for r in merged.collect()} == {str(k): 81 + 2 * k - (40 if 81 + 2 * k > 100 else 0) for k in range(0, 20, 2)}


def test_rollover_needs_one_condition(spark):
    with pytest.raises(ValueError):
        layout.rollover(spark.range(3), "x", ["id"])


def test_field_caps(docs):
    tables = {"a": docs({"1": (1, "x")}, "f int, g string"), "b": docs({"1": ("y", None)}, "f string, g string")}
    out = {(r["_index"], r.field): (r.type, r.conflict, r.has_data) for r in profile.field_caps(tables).collect()}
    assert out == {
        ("a", "f"): ("integer", True, True), ("b", "f"): ("text", True, True),
        ("a", "g"): ("text", False, True), ("b", "g"): ("text", False, False),
    }
    filtered = profile.field_caps(tables, ["g"], source("g") == "none").collect()
    assert {(r["_index"], r.has_data) for r in filtered} == {("a", False), ("b", False)}


def test_stats(docs):
    df = docs({"1": (1, "x"), "2": (2, "yy"), "3": (None, None)}, "n int, s string")
    row = profile.stats(df, deleted=source("n") == 2).first()
    assert (row.docs, row.deleted, row.store) == (2, 1, 11)
    usage = {r.field: (r["values"], r.bytes) for r in profile.disk_usage(df).collect()}
    assert usage == {"n": (2, 8), "s": (2, 3)}
    with pytest.raises(ValueError):
        profile.stats(df, ["heat"])


def test_analysis_moves_no_text(spark, sf):
    """Offsets come from running sums inside a row: the plan has no exchange."""
    table = spark.read.parquet(f"{sf}/documents.parquet")
    plan = text_analysis.analyze(table, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_running_sums_equal_brute_force(spark):
    lists = [[], [5], [1, 2, 3], list(range(1000)), [0] * 7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lists)], "i int, v array<int>")
    for r in df.select("v", running_sums(F.col("v")).alias("s")).collect():
        assert r.s == [sum(r.v[: n + 1]) for n in range(len(r.v))]


def test_few_pairs_are_scored(spark, monkeypatch):
    """Exact pruning scores under a tenth of all pairs of query and document; the answer is compared with SQL elsewhere."""
    found = []
    pick = search.candidates

    def counted(*args):
        pairs, left = pick(*args)
        found.append(pairs.count())
        return pairs, left

    monkeypatch.setattr(search, "candidates", counted)
    sf = "/root/testdata/sf0.1"
    search_plans.msearch_benchmark(spark, sf).count()
    every = spark.read.parquet(f"{sf}/documents.parquet").count() * spark.read.parquet(f"{sf}/benchmark.parquet").count()
    assert 0 < found[0] < every / 10


def test_pruning_changes_no_hit(spark):
    """Random texts over a small vocabulary, with ties, few hits and queries of common words only, against brute force."""
    rng = random.Random(3)
    words = [f"w{n}" for n in range(60)]
    texts = {n: " ".join(rng.choices(words, [1 / (k + 1) for k in range(60)], k=rng.randrange(1, 40))) for n in range(400)}
    asked = {n: " ".join(rng.choices(words, k=rng.randrange(1, 12))) for n in range(25)} | {90: "w0 w1", 91: "w59", 92: "none"}
    table = spark.createDataFrame([("t", i, (t,)) for i, t in texts.items()], "_index string, _id int, _source struct<text string>")
    queries = spark.createDataFrame(list(asked.items()), "query_id int, text string")
    got: dict[int, list] = {}
    for r in search.msearch(table, "_source.text", queries, size=7).orderBy("query_id", "_rank").collect():
        got.setdefault(r.query_id, []).append((r["_id"], r["_score"]))
    length = {i: len(t.split()) for i, t in texts.items()}
    mean = sum(length.values()) / len(length)
    counts = {i: Counter(t.split()) for i, t in texts.items()}
    df = Counter(w for c in counts.values() for w in c)
    for q, text in asked.items():
        scores = {}
        for i, own in counts.items():
            parts = [math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5)) * own[w] / (own[w] + 1.2 * (0.25 + 0.75 * length[i] / mean)) for w in set(text.split()) if own[w]]
            if parts:
                scores[i] = round(sum(parts), 6)
        best = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:7]
        assert [i for i, _ in got.get(q, [])] == [i for i, _ in best], q
        assert [s for _, s in got.get(q, [])] == pytest.approx([s for _, s in best])


def test_top_terms(spark):
    texts = {1: "b b a cc", 2: "a a", 3: "", 4: None, 5: "cc dd ee dd"}
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    vectors = text_analysis.termvectors(df, "id", "t")
    counts = {k: Counter(words(t or "")) for k, t in texts.items()}
    docs = [c for c in counts.values() if c]
    idf = {w: math.log(1 + (len(docs) - n + 0.5) / (n + 0.5)) for w in "a b cc dd ee".split() for n in [sum(w in c for c in docs)]}
    for size in (1, 2, 9):
        expected = {
            (k, w) for k, c in counts.items() for w in sorted(c, key=lambda w: (-round(c[w] * idf[w], 6), w))[:size]
        }
        best = text_analysis.top_terms(vectors, "id", size)
        assert {(r.id, r.term) for r in best.collect()} == expected
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()
    narrow = text_analysis.top_terms(vectors, "id", 9, tf=(1, 1), doc_freq=(2, 2), length=(1, 1))
    assert [(r.id, r.term) for r in narrow.collect()] == [(1, "a")]


def test_running_sums_of_long_and_broken_arrays(spark):
    cases = [[], [7], list(range(16)), list(range(17)), [3] * 1000, [1, None, 2] + [1] * 40, None]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(cases)], "k int, v array<int>")
    out = {r.k: r.s for r in df.select("k", running_sums(F.col("v")).alias("s")).collect()}
    for k, v in enumerate(cases):
        want, held = [], 0
        for x in v or []:
            held = None if x is None or held is None else held + x
            want.append(held)
        assert out[k] == (None if v is None else want)


def test_places_of_texts_with_odd_ends(spark):
    texts = ["", None, "...", "a", " a", "a ", "É𝒳b--É𝒳b Z_9\n\tz_9", "x " * 500 + "!", "😀😀 ab 😀 AB"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    words = {k: list(regex.finditer(r"[\p{L}\p{N}_]+", t or "")) for k, t in enumerate(texts)}
    found = sorted(map(tuple, text_analysis.analyze(df, "id", "t").collect()))
    assert found == sorted((k, n, m[0].lower(), m.start(), m.end()) for k, ms in words.items() for n, m in enumerate(ms))
    vectors = {(r.id, r.term): (r.tf, r.positions, r.start_offsets, r.end_offsets) for r in text_analysis.termvectors(df, "id", "t").collect()}
    want = {}
    for k, ms in words.items():
        for n, m in enumerate(ms):
            want.setdefault((k, m[0].lower()), []).append((n, m.start(), m.end()))
    assert vectors == {key: (len(p), *[list(x) for x in zip(*p, strict=True)]) for key, p in want.items()}


def test_rows_in_few_of_many_splits_are_spread(spark):
    few = spark.range(0, 16_000, 1, 16).filter("id < 1000")
    held = spread(few).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in held) == 1000 and max(r["count"] for r in held) <= 200
    even = spark.range(0, 16_000, 1, 16)
    assert spread(even) is even


def test_entries_are_dealt_to_tasks_that_hold_few_pairs(spark, docs, monkeypatch):
    """The number of tasks follows the pairs of queries and documents, not the files, and the answer does not depend on it."""
    table = docs({f"d{n:03}": (f"dog {'cat ' * (n % 5)}w{n % 7}",) for n in range(60)} | {"none": (None,)}, "text string")
    queries = spark.createDataFrame([(q, "dog cat w3") for q in range(10)], "query_id int, text string")
    whole = search.contributions
    dealt = []

    def counted(entries, weights, *more):
        dealt.append(entries.rdd.getNumPartitions())
        return whole(entries, weights, *more)

    monkeypatch.setattr(search, "contributions", counted)
    plain = pytest.rows(search.msearch(table, "_source.text", queries, 3))
    monkeypatch.setattr(search, "PAIRS", 2)
    assert pytest.rows(search.msearch(table, "_source.text", queries, 3)) == plain and len(plain) == 30
    # Nine documents have the rare word that all ten queries ask for.
    assert dealt[1] == 8 and dealt[-1] >= 40
