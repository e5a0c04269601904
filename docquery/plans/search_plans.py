"""Searching, scoring, paging, evaluating and text analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from docquery.functions.predicates import ids, index_filter, match, match_all, source_filter, term
from docquery.functions.text import tokens
from docquery.model import source
from docquery.operators import bulk, evaluate, paging, postings, search, templates, text_analysis, tiles
from docquery.operators.profile import field_caps
from docquery.plans.inputs import IDS, docs, flat, text_docs, texts
from docquery.session import materialize, new_folder

QUERY = "that river and the onesen"
EXPLAIN = "the and que onesen"
#: Above all ids of documents.
COPIES = 1_000_000_000_000

TOKENS_SQL = r"""
toks AS (SELECT doc_id, lower(w) AS term
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM documents)),
dl AS (SELECT doc_id, count(*) AS dl FROM toks GROUP BY doc_id),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl)
"""

SCORE_SQL = "ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))"


def _terms(text: str) -> str:
    return ", ".join(f"('{w}')" for w in text.split())


def search_bm25(spark, sf):
    hits = search.search(text_docs(spark, sf, "documents"), "_source.text", QUERY)
    return hits.select("_index", "_id", "_score", source("lang").alias("lang"))


def search_sorted(spark, sf):
    """The longest matching documents."""
    hits = search.search(text_docs(spark, sf, "documents"), "_source.text", QUERY, size=25, sort=[(source("n_chars"), True)])
    return hits.select("_id", "_score", source("n_chars").alias("n_chars"))


def search_filtered(spark, sf):
    where = term(source("lang"), "en") & (source("n_chars") > 500)
    return search.search(text_docs(spark, sf, "documents"), "_source.text", QUERY, where, size=20).select("_id", "_score")


def search_scores(spark, sf):
    """Every match of the query with its score."""
    return search.scores(text_docs(spark, sf, "documents"), "_source.text", QUERY)


def msearch_benchmark(spark, sf):
    queries = flat(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search.msearch(text_docs(spark, sf, "documents"), "_source.text", queries).select(
        "query_id", "_rank", "_id", "_score"
    )


def msearch_two_indices(spark, sf):
    """Odd items ask the conversations, even ones both indices."""
    both = (
        text_docs(spark, sf, "documents").select("_index", F.col("_id").cast("string").alias("_id"), source("text").alias("text"))
        .unionByName(text_docs(spark, sf, "conversations").select("_index", "_id", source("text").alias("text")))
    )
    queries = flat(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"),
        "text",
        F.when(F.col("item_id") % 2 == 1, "conversations").alias("_index"),
    )
    return search.msearch(both, "text", queries, size=5)


def explain_terms(spark, sf):
    return search.explain(
        text_docs(spark, sf, "documents"), "_source.text", EXPLAIN, flat(spark, sf, "labels").select(F.col("doc_id").alias("_id"))
    ).drop("_index")


def _documents_twice(spark, sf):
    """The documents under two indices with the same ids; the second one's texts end in another word."""
    one = text_docs(spark, sf, "documents").select(F.lit("a").alias("_index"), "_id", source("text").alias("text"))
    return one.unionByName(one.select(F.lit("b").alias("_index"), "_id", F.concat("text", F.lit(" onesen")).alias("text")))


def explain_two_indices(spark, sf):
    """Ids that both indices have, each asked for in one of them."""
    asked = flat(spark, sf, "labels").select(F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("_index"), F.col("doc_id").alias("_id"))
    return search.explain(_documents_twice(spark, sf), "text", EXPLAIN, asked)


def _kept(spark, table):
    return postings.build_postings(table, "_source.text", new_folder(spark, "postings"), buckets=16)


def postings_msearch(spark, sf):
    """The benchmark's searches from a kept index."""
    queries = flat(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    hits = postings.msearch(_kept(spark, text_docs(spark, sf, "documents")), queries)
    return hits.select("query_id", "_rank", "_id", "_score")


def postings_explain(spark, sf):
    asked = flat(spark, sf, "labels").select(F.col("doc_id").alias("_id"))
    return postings.explain(_kept(spark, text_docs(spark, sf, "documents")), EXPLAIN, asked).drop("_index")


def _refreshed(spark, sf):
    """An index of the documents, refreshed from a log that deletes a tenth of them, adds words to a tenth and copies a tenth."""
    table = text_docs(spark, sf, "documents").select("_index", "_id", F.struct(source("text").alias("text")).alias("_source"))
    kind, text = F.col("_id") % 10, source("text")
    log = table.filter(kind < 3).select(
        F.col("_id").alias("seq"),
        F.when(kind == 0, "delete").when(kind == 1, "update").otherwise("index").alias("action"),
        "_index",
        F.when(kind == 2, F.col("_id") + COPIES).otherwise(F.col("_id")).alias("_id"),
        F.struct(F.when(kind == 1, F.concat(text, F.lit(" onesen river"))).otherwise(text).alias("text")).alias("doc"),
    )
    index = _kept(spark, table)
    changed, items = bulk.apply_bulk(table, materialize(log, "log"))
    return postings.refresh_postings(index, changed, items, "_source.text", "log")


def postings_refreshed(spark, sf):
    """Every match of a query, from an index that was refreshed."""
    return postings.scores(_refreshed(spark, sf), QUERY)


def postings_compacted(spark, sf):
    """The best hits from a refreshed index that was written as one generation."""
    index = postings.compact_postings(_refreshed(spark, sf), new_folder(spark, "postings"))
    return postings.search(index, QUERY, size=50)


def postings_terms(spark, sf):
    return postings.terms_enum(_kept(spark, text_docs(spark, sf, "documents")), "on", 20)


def count_term(spark, sf):
    return search.count(docs(spark, sf, "events"), term(source("event_type"), "purchase"))


def count_match(spark, sf):
    return search.count(text_docs(spark, sf, "documents"), match(source("text"), "river onesen que") & match_all())


def terms_enum_prefix(spark, sf):
    return search.terms_enum(text_docs(spark, sf, "documents"), tokens(source("text")), "on", 20)


def terms_enum_part(spark, sf):
    return search.terms_enum(docs(spark, sf, "part"), source("p_type"), "s", ignore_case=True)


def query_ids(spark, sf):
    """Orders of the customers' keys, by a table of ids; the key 7 and others by a list."""
    asked = flat(spark, sf, "customer").select(F.col("c_custkey").alias("_id"))
    orders = docs(spark, sf, "orders")
    listed = ids(orders, [7, 11, 13, 1000]).withColumn("how", F.lit("list"))
    joined = ids(orders, asked).withColumn("how", F.lit("table"))
    return listed.unionByName(joined).select("how", "_id", source("o_totalprice").alias("price"))


def query_index_filter(spark, sf):
    bound = index_filter(docs(spark, sf, "orders"), source("o_orderstatus") == "F")
    return bound.filter(source("o_totalprice") > 300000).select("_id", source("o_totalprice").alias("price"))


def query_source_filter(spark, sf):
    return source_filter(docs(spark, sf, "orders"), ["o_custkey", "o_orderpriority"])


def scroll_page(spark, sf):
    orders = flat(spark, sf, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    first = paging.page(orders, ["o_totalprice", "o_orderkey"], size=25).withColumn("page", F.lit(1))
    later = paging.page(orders, ["o_totalprice", "o_orderkey"], (100000.0, 0), 25).withColumn("page", F.lit(2))
    return first.unionByName(later)


def scroll_all_pages(spark, sf):
    """All orders in five pages, cut from one numbering of the rows; the key descends and may be NULL."""
    price = F.when(F.col("o_totalprice") <= 200000, F.col("o_totalprice"))
    orders = flat(spark, sf, "orders").select("o_orderkey", price.alias("price"))
    size = max(1, -(-orders.count() // 5))
    # NULLs come last in a descending order.
    ordered = orders.withColumn("_last", F.col("price").isNull()).withColumn("_down", -F.col("price"))
    pages = paging.number_pages(ordered, ["_last", "_down", "o_orderkey"], size)
    return pages.select("o_orderkey", "price", F.col("_page").cast("int").alias("page"))


def number_pages(spark, sf):
    orders = flat(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return paging.number_pages(orders, ["o_totalprice", "o_orderkey"], 100)


def rank_eval_precision(spark, sf):
    return evaluate.rank_eval(_results(spark, sf), _ratings(spark, sf), "precision", 10)


def rank_eval_mean(spark, sf):
    return evaluate.mean_score(evaluate.rank_eval(_results(spark, sf), _ratings(spark, sf), "mean_reciprocal_rank", 10))


def rank_eval_two_indices(spark, sf):
    """Results of two indices with the same ids, of which each has ratings of its own."""
    hits = _results(spark, sf)
    both = hits.withColumn("_index", F.lit("a")).unionByName(hits.withColumn("_index", F.lit("b")).withColumn("_score", F.col("_score") + 1))
    rated = _ratings(spark, sf)
    ratings = rated.withColumn("_index", F.lit("a")).unionByName(rated.select("_id", (1 - F.col("rating")).alias("rating"), F.lit("b").alias("_index")))
    return evaluate.rank_eval(both, ratings, "precision", 15)


def rank_eval_ndcg(spark, sf):
    """Ratings per query: a labelled document is worth one to three, by its place among the ids."""
    hits = _results(spark, sf)
    rated = hits.join(_ratings(spark, sf).filter("rating = 1"), "_id").select("query_id", "_id", (F.col("_id") % 3 + 1).alias("rating"))
    return evaluate.rank_eval(hits, rated, "ndcg", 5)


def _results(spark, sf):
    return msearch_benchmark(spark, sf).select("query_id", "_id", "_score")


def _ratings(spark, sf):
    return flat(spark, sf, "labels").select(F.col("doc_id").alias("_id"), F.col("quality").alias("rating"))


def tile_grid(spark, sf):
    points = flat(spark, sf, "events").select(
        ((F.col("event_id") * 17 % 1600) / 10 - 80).alias("lat"), ((F.col("event_id") * 37 % 3600) / 10 - 180).alias("lon")
    )
    return tiles.tile_grid(points, F.col("lat"), F.col("lon"), 2, 1, 2, grid=3)


def search_template(spark, sf):
    flat(spark, sf, "lineitem").createOrReplaceTempView("docquery_lineitem")
    return templates.search_template(
        spark,
        """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM docquery_lineitem
           WHERE l_discount BETWEEN :low AND :high AND l_linestatus = :status GROUP BY l_returnflag""",
        {"low": 0.02, "high": 0.05, "status": "O"},
    )


def msearch_template(spark, sf):
    """One parameter row per customer: the dearest orders above the customer's balance."""
    params = flat(spark, sf, "customer").select(F.col("c_custkey").alias("query_id"), F.col("c_acctbal").alias("low"))
    orders = flat(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    hits = templates.msearch_template(
        orders,
        params,
        {"o_custkey": "query_id"},
        F.col("o_totalprice") > F.col("low") * 20,
        size=3,
        sort=[F.desc("o_totalprice"), F.col("o_orderkey")],
    )
    return hits.select("query_id", "_rank", "o_orderkey", "o_totalprice")


def msearch_template_default(spark, sf):
    """The first ten orders of every customer, in the order of their ids."""
    params = flat(spark, sf, "customer").select(F.col("c_custkey").alias("query_id"))
    orders = docs(spark, sf, "orders").select("_id", source("o_custkey").alias("who"))
    return templates.msearch_template(orders, params, {"who": "query_id"}).select("query_id", "_rank", "_id")


def msearch_template_ranges(spark, sf):
    """One parameter row per supplier, no equality: the dearest orders of a price near ten times the supplier's balance."""
    low = F.col("s_acctbal") * 10
    params = flat(spark, sf, "supplier").select(F.col("s_suppkey").alias("query_id"), low.alias("low"), (low + 1000).alias("high"))
    orders = flat(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hits = templates.msearch_template(
        orders, params, size=5, sort=[F.desc("o_totalprice"), F.col("o_orderkey")], between={"o_totalprice": ("low", "high")}
    )
    return hits.select("query_id", "_rank", "o_orderkey", "o_totalprice")


def msearch_template_open(spark, sf):
    """Ranges with one bound: all orders up to the budget of each nation, if the order is not the nation's number."""
    params = flat(spark, sf, "nation").select(F.col("n_nationkey").alias("query_id"), (F.col("n_nationkey") * 200.0 + 5000).alias("budget"))
    orders = flat(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    hits = templates.msearch_template(
        orders, params, where=F.col("o_orderkey") != F.col("query_id"), size=None, between={"o_totalprice": (None, "budget")}
    )
    return hits.select("query_id", "o_orderkey")


def field_caps_all(spark, sf):
    """All tables, and two more in which `amount` is a number here and text there."""
    tables = {n: docs(spark, sf, n) for n in IDS}
    for name, field in (("prices", "o_totalprice"), ("brands", "p_brand")):
        rows = docs(spark, sf, {"prices": "orders", "brands": "part"}[name])
        tables[name] = rows.withColumn("_source", F.struct(source(field).alias("amount")))
    return field_caps(tables).select("_index", "field", "type", "conflict", "has_data")


def _bodies(df, *members):
    text = F.concat_ws(",", *[F.concat(F.lit(f'"{name}":'), value) for name, value in members])
    return df.select(F.parse_json(F.concat(F.lit("{"), text, F.lit("}"))).alias("_source"))


def _in_quotes(name):
    return F.concat(F.lit('"'), F.col(name), F.lit('"'))


def field_caps_variant(spark, sf):
    """Two schemaless indices: `who` and `state.code` are numbers in one and text in the other, `note` is both a number and an object."""
    orders = _bodies(
        texts(spark, sf, "orders"),
        ("who", F.col("o_custkey").cast("string")),
        ("state", F.concat(F.lit('{"code":'), _in_quotes("o_orderstatus"), F.lit(',"late":null}'))),
        ("sums", F.concat(F.lit("["), F.col("o_custkey"), F.lit(","), F.col("o_orderkey"), F.lit(".5]"))),
        ("note", F.when(F.col("o_orderkey") % 3 == 0, "1").otherwise('{"by":true,"lists":[]}')),
    )
    parts = _bodies(
        texts(spark, sf, "part"),
        ("who", _in_quotes("p_brand")),
        ("state", F.concat(F.lit('{"code":'), F.col("p_size"), F.lit("}"))),
        ("rows", F.concat(F.lit('[{"n":'), F.col("p_size"), F.lit('},{"n":'), F.col("p_partkey"), F.lit("}]"))),
    )
    return field_caps({"orders": orders, "parts": parts}).select("_index", "field", "type", "conflict", "has_data")


def analyze_tokens(spark, sf):
    return text_analysis.analyze(texts(spark, sf, "documents"), "doc_id", "text")


def analyze_conversations(spark, sf):
    return text_analysis.analyze(texts(spark, sf, "conversations"), ["conv_id", "turn"], "text")


def _joined(df):
    return df.withColumns(
        {c: F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))) for c in ("positions", "start_offsets", "end_offsets")}
    )


def termvectors(spark, sf):
    return _joined(text_analysis.termvectors(texts(spark, sf, "documents"), "doc_id", "text"))


def mtermvectors(spark, sf):
    """Vectors of the labelled documents and of as many benchmark items; the statistics are each index's own.

    Labelled ids that the benchmark lacks are answered as not found.
    """
    labelled = flat(spark, sf, "labels").select("doc_id")
    index = F.explode(F.array(F.lit(None), F.lit("benchmark"))).alias("_index")
    tables = {
        "documents": texts(spark, sf, "documents").select("doc_id", "text"),
        "benchmark": texts(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text"),
    }
    found = text_analysis.mtermvectors(tables, "doc_id", "text", labelled.select("doc_id", index), "documents")
    return _joined(found).select("_index", "doc_id", "found", "term", "tf", "positions", "end_offsets", "doc_freq", "total_tf", "doc_count")


def termvectors_top_terms(spark, sf):
    """The five most telling terms of every document, of three to twelve letters, at most fifty times there, and in two documents at least."""
    vectors = text_analysis.termvectors(texts(spark, sf, "documents"), "doc_id", "text")
    best = text_analysis.top_terms(vectors, "doc_id", 5, tf=(1, 50), doc_freq=(2, None), length=(3, 12))
    return best.select("doc_id", "term", "tf", "doc_freq", "score")


QUERIES = {
    f.__name__: f
    for f in (
        search_bm25, search_sorted, msearch_template_default, search_filtered, search_scores, msearch_benchmark, msearch_two_indices, explain_terms, explain_two_indices, count_term, count_match,
        terms_enum_prefix, terms_enum_part, query_ids, query_index_filter, query_source_filter, scroll_page, scroll_all_pages, number_pages,
        rank_eval_precision, rank_eval_mean, rank_eval_two_indices, rank_eval_ndcg, tile_grid, search_template, msearch_template, msearch_template_ranges, msearch_template_open, analyze_tokens,
        analyze_conversations, termvectors, mtermvectors, postings_msearch, postings_explain, postings_refreshed, postings_compacted,
        postings_terms, termvectors_top_terms,
    )
}
QUERIES |= {"field_caps": field_caps_all, "field_caps_variant": field_caps_variant}

_HITS = f"""
q(term) AS (VALUES {_terms(QUERY)}),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks JOIN q USING (term) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
hits AS (SELECT doc_id, round(sum({SCORE_SQL}), 6) AS score
         FROM tf JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN st GROUP BY doc_id)
"""

_MSEARCH = rf"""
qt AS (SELECT DISTINCT query_id, lower(w) AS term FROM
       (SELECT item_id AS query_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS w FROM benchmark)),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term IN (SELECT term FROM qt) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
scored AS (SELECT query_id, doc_id, round(sum({SCORE_SQL}), 6) AS score
           FROM qt JOIN tf USING (term) JOIN df USING (term) JOIN dl USING (doc_id) CROSS JOIN st
           GROUP BY query_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rk FROM scored),
results AS (SELECT query_id, rk, doc_id, score FROM ranked WHERE rk <= 10)
"""

_CHANGED = f"""changed AS (
  SELECT doc_id, CASE WHEN doc_id % 10 = 1 THEN text || ' onesen river' ELSE text END AS text FROM documents WHERE doc_id % 10 <> 0
  UNION ALL SELECT doc_id + {COPIES}, text FROM documents WHERE doc_id % 10 = 2),
""" + TOKENS_SQL.replace("FROM documents", "FROM changed")

_RUNS = r"""
runs AS (SELECT {ids}, generate_subscripts(r, 1) AS n, unnest(r) AS piece
         FROM (SELECT {ids}, regexp_extract_all(text, '([\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+)') AS r FROM {table})),
placed AS (SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY {ids} ORDER BY n
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM runs),
words AS (SELECT {ids}, row_number() OVER (PARTITION BY {ids} ORDER BY n) - 1 AS position, lower(piece) AS token,
                 s, s + length(piece) AS e
          FROM placed WHERE regexp_matches(piece, '^[\p{{L}}\p{{N}}_]'))
"""


def _analyze_sql(table: str, ids: str) -> str:
    return f"""WITH {_RUNS.format(ids=ids, table=table)}
        SELECT {ids}, CAST(position AS INTEGER) AS position, token,
               CAST(s AS BIGINT) AS start_offset, CAST(e AS BIGINT) AS end_offset FROM words"""


_VECTORS = f"""
{_RUNS.format(ids="doc_id", table="documents")},
vec AS (SELECT doc_id, token AS term, count(*) AS tf, string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS positions,
               string_agg(CAST(CAST(s AS BIGINT) AS VARCHAR), ',' ORDER BY s) AS start_offsets,
               string_agg(CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s) AS end_offsets
        FROM words GROUP BY doc_id, token),
stats AS (SELECT term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS total_tf FROM vec GROUP BY term),
field AS (SELECT count(DISTINCT doc_id) AS doc_count, count(*) AS sum_doc_freq, CAST(sum(tf) AS BIGINT) AS sum_total_tf FROM vec)
"""

SQL = {
    "search_bm25": f"""WITH {TOKENS_SQL}, {_HITS}
        SELECT 'documents' AS _index, doc_id AS _id, score AS _score, lang
        FROM hits JOIN documents USING (doc_id) ORDER BY score DESC, doc_id LIMIT 10""",
    "search_sorted": f"""WITH {TOKENS_SQL}, {_HITS}
        SELECT doc_id AS _id, score AS _score, n_chars FROM hits JOIN documents USING (doc_id) ORDER BY n_chars DESC, doc_id LIMIT 25""",
    "msearch_template_default": """SELECT query_id, CAST(rk AS INTEGER) AS _rank, _id FROM (
        SELECT c_custkey AS query_id, o_orderkey AS _id, row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey) AS rk
        FROM customer JOIN orders ON o_custkey = c_custkey) WHERE rk <= 10""",
    "search_filtered": f"""WITH {TOKENS_SQL}, {_HITS}
        SELECT doc_id AS _id, score AS _score FROM hits JOIN documents USING (doc_id)
        WHERE lang = 'en' AND n_chars > 500 ORDER BY score DESC, doc_id LIMIT 20""",
    "search_scores": f"""WITH {TOKENS_SQL}, {_HITS}
        SELECT 'documents' AS _index, doc_id AS _id, score AS _score FROM hits""",
    "msearch_benchmark": f"""WITH {TOKENS_SQL}, {_MSEARCH}
        SELECT query_id, CAST(rk AS INTEGER) AS _rank, doc_id AS _id, score AS _score FROM results""",
    "msearch_two_indices": rf"""WITH both_ AS (
          SELECT 'documents' AS _index, CAST(doc_id AS VARCHAR) AS _id, text FROM documents
          UNION ALL SELECT 'conversations', conv_id || '-' || turn, text FROM conversations),
        toks AS (SELECT _index, _id, lower(w) AS term FROM
                 (SELECT _index, _id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS w FROM both_)),
        dl AS (SELECT _index, _id, count(*) AS dl FROM toks GROUP BY ALL),
        qt AS (SELECT DISTINCT query_id, target, lower(w) AS term FROM
               (SELECT item_id AS query_id, CASE WHEN item_id % 2 = 1 THEN 'conversations' ELSE 'all' END AS target,
                       unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS w FROM benchmark)),
        scope AS (SELECT 'all' AS target, _index, _id FROM dl UNION ALL
                  SELECT 'conversations', _index, _id FROM dl WHERE _index = 'conversations'),
        st AS (SELECT target, count(*) AS n, avg(dl) AS avgdl FROM scope JOIN dl USING (_index, _id) GROUP BY target),
        tf AS (SELECT _index, _id, term, count(*) AS tf FROM toks WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
        df AS (SELECT target, term, count(*) AS df FROM scope JOIN tf USING (_index, _id) GROUP BY target, term),
        scored AS (SELECT query_id, _index, _id, round(sum({SCORE_SQL}), 6) AS score
                   FROM qt JOIN scope USING (target) JOIN tf USING (_index, _id, term) JOIN df USING (target, term)
                   JOIN dl USING (_index, _id) JOIN st USING (target) GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, _id, _index) AS rk FROM scored)
        SELECT query_id, CAST(rk AS INTEGER) AS _rank, _index, _id, score AS _score FROM ranked WHERE rk <= 5""",
    "explain_terms": f"""WITH {TOKENS_SQL},
        q(term) AS (VALUES {_terms(EXPLAIN)}),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM toks JOIN q USING (term) GROUP BY doc_id, term),
        df AS (SELECT q.term, count(doc_id) AS df FROM q LEFT JOIN tf USING (term) GROUP BY q.term)
        SELECT l.doc_id AS _id, q.term, tf.tf IS NOT NULL AS matched, coalesce(tf.tf, 0) AS tf, df.df,
               round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf,
               round(1.2 * (1 - 0.75 + 0.75 * dl / avgdl), 6) AS norm,
               round(coalesce({SCORE_SQL.replace("tf", "tf.tf")}, 0.0), 6) AS contribution
        FROM (SELECT DISTINCT doc_id FROM labels) l CROSS JOIN q JOIN df USING (term) CROSS JOIN st
        LEFT JOIN dl ON dl.doc_id = l.doc_id LEFT JOIN tf ON tf.doc_id = l.doc_id AND tf.term = q.term""",
    "explain_two_indices": rf"""WITH both_ AS (SELECT 'a' AS _index, doc_id, text FROM documents UNION ALL SELECT 'b', doc_id, text || ' onesen' FROM documents),
        toks AS (SELECT _index, doc_id, lower(w) AS term FROM (SELECT _index, doc_id, unnest(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) AS w FROM both_)),
        dl AS (SELECT _index, doc_id, count(*) AS dl FROM toks GROUP BY ALL),
        st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
        q(term) AS (VALUES {_terms(EXPLAIN)}),
        tf AS (SELECT _index, doc_id, term, count(*) AS tf FROM toks JOIN q USING (term) GROUP BY ALL),
        df AS (SELECT q.term, count(doc_id) AS df FROM q LEFT JOIN tf USING (term) GROUP BY q.term),
        asked AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN 'a' ELSE 'b' END AS _index, doc_id FROM labels)
        SELECT l._index, l.doc_id AS _id, q.term, tf.tf IS NOT NULL AS matched, coalesce(tf.tf, 0) AS tf, df.df,
               round(ln(1 + (n - df + 0.5) / (df + 0.5)), 6) AS idf,
               round(1.2 * (1 - 0.75 + 0.75 * dl / avgdl), 6) AS norm,
               round(coalesce({SCORE_SQL.replace("tf", "tf.tf")}, 0.0), 6) AS contribution
        FROM asked l CROSS JOIN q JOIN df USING (term) CROSS JOIN st
        LEFT JOIN dl ON dl.doc_id = l.doc_id AND dl._index = l._index
        LEFT JOIN tf ON tf.doc_id = l.doc_id AND tf.term = q.term AND tf._index = l._index""",
    "count_term": "SELECT count(*) AS count FROM events WHERE event_type = 'purchase'",
    "count_match": f"""WITH {TOKENS_SQL}
        SELECT count(DISTINCT doc_id) AS count FROM toks WHERE term IN ('river', 'onesen', 'que')""",
    "terms_enum_prefix": f"""WITH {TOKENS_SQL}
        SELECT DISTINCT term FROM toks WHERE starts_with(term, 'on') ORDER BY term LIMIT 20""",
    "terms_enum_part": "SELECT DISTINCT p_type AS term FROM part WHERE starts_with(lower(p_type), 's') ORDER BY term LIMIT 10",
    "query_ids": """SELECT 'list' AS how, o_orderkey AS _id, o_totalprice AS price FROM orders WHERE o_orderkey IN (7, 11, 13, 1000)
        UNION ALL SELECT 'table', o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT c_custkey FROM customer)""",
    "query_index_filter": """SELECT o_orderkey AS _id, o_totalprice AS price FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 300000""",
    "query_source_filter": "SELECT o_custkey, o_orderpriority FROM orders",
    "scroll_page": """SELECT * FROM (SELECT o_orderdate, o_orderkey, o_totalprice, 1 AS page FROM orders
            ORDER BY o_totalprice, o_orderkey LIMIT 25)
        UNION ALL SELECT * FROM (SELECT o_orderdate, o_orderkey, o_totalprice, 2 AS page FROM orders
            WHERE o_totalprice > 100000 OR (o_totalprice = 100000 AND o_orderkey > 0) ORDER BY o_totalprice, o_orderkey LIMIT 25)""",
    "number_pages": """SELECT o_totalprice, o_orderkey,
        CAST((row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 100 + 1 AS BIGINT) AS _page FROM orders""",
    "rank_eval_precision": f"""WITH {TOKENS_SQL}, {_MSEARCH}
        SELECT query_id, count(*) AS hits, count(*) FILTER (quality >= 1) AS relevant,
               count(*) FILTER (quality IS NULL) AS unrated,
               round(count(*) FILTER (quality >= 1) / count(*), 6) AS metric_score
        FROM results LEFT JOIN labels USING (doc_id) GROUP BY query_id""",
    "rank_eval_two_indices": f"""WITH {TOKENS_SQL}, {_MSEARCH},
        both_ AS (SELECT query_id, 'a' AS _index, doc_id, score FROM results UNION ALL SELECT query_id, 'b', doc_id, score + 1 FROM results),
        top AS (SELECT * FROM both_ QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, _index) <= 15),
        rated AS (SELECT t.query_id, CASE WHEN t._index = 'a' THEN l.quality ELSE 1 - l.quality END AS rating FROM top t LEFT JOIN labels l USING (doc_id))
        SELECT query_id, count(*) AS hits, count(*) FILTER (rating >= 1) AS relevant, count(*) FILTER (rating IS NULL) AS unrated,
               round(count(*) FILTER (rating >= 1) / count(*), 6) AS metric_score FROM rated GROUP BY query_id""",
    "rank_eval_ndcg": f"""WITH {TOKENS_SQL}, {_MSEARCH},
        rated AS (SELECT query_id, rk, doc_id % 3 + 1 AS rating FROM results JOIN labels USING (doc_id) WHERE quality = 1),
        best AS (SELECT query_id, rating, row_number() OVER (PARTITION BY query_id ORDER BY rating DESC) AS place FROM rated),
        ideal AS (SELECT query_id, sum((2.0 ** rating - 1) / log2(place + 1)) AS ideal FROM best WHERE place <= 5 GROUP BY query_id),
        per AS (SELECT r.query_id, count(*) AS hits, count(*) FILTER (rating >= 1) AS relevant, count(*) FILTER (rating IS NULL) AS unrated,
                       sum((2.0 ** coalesce(rating, 0) - 1) / log2(r.rk + 1)) AS gain
                FROM results r LEFT JOIN rated USING (query_id, rk) WHERE r.rk <= 5 GROUP BY r.query_id)
        SELECT query_id, hits, relevant, unrated, round(coalesce(gain / ideal, 0.0), 6) AS metric_score FROM per LEFT JOIN ideal USING (query_id)""",
    "rank_eval_mean": f"""WITH {TOKENS_SQL}, {_MSEARCH},
        per AS (SELECT query_id, round(coalesce(1.0 / min(rk) FILTER (quality >= 1), 0), 6) AS s
                FROM results LEFT JOIN labels USING (doc_id) GROUP BY query_id)
        SELECT count(*) AS queries, round(avg(s), 6) AS metric_score FROM per""",
    "tile_grid": """WITH p AS (SELECT (event_id * 17 % 1600) / 10 - 80 AS lat, (event_id * 37 % 3600) / 10 - 180 AS lon FROM events),
        m AS (SELECT (lon + 180) / 360 AS x, (1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 AS y FROM p)
        SELECT CAST(floor(x * 32) AS BIGINT) AS cell_x, CAST(floor(y * 32) AS BIGINT) AS cell_y, count(*) AS n
        FROM m WHERE floor(x * 4) = 1 AND floor(y * 4) = 2 GROUP BY ALL""",
    "search_template": """SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem
        WHERE l_discount BETWEEN 0.02 AND 0.05 AND l_linestatus = 'O' GROUP BY l_returnflag""",
    "msearch_template": """SELECT query_id, CAST(rk AS INTEGER) AS _rank, o_orderkey, o_totalprice FROM (
        SELECT c_custkey AS query_id, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY c_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
        FROM customer JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 20) WHERE rk <= 3""",
    "msearch_template_ranges": """SELECT query_id, CAST(rk AS INTEGER) AS _rank, o_orderkey, o_totalprice FROM (
        SELECT s_suppkey AS query_id, o_orderkey, o_totalprice,
               row_number() OVER (PARTITION BY s_suppkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
        FROM supplier JOIN orders ON o_totalprice >= s_acctbal * 10 AND o_totalprice <= s_acctbal * 10 + 1000) WHERE rk <= 5""",
    "msearch_template_open": """SELECT n_nationkey AS query_id, o_orderkey FROM nation JOIN orders
        ON o_totalprice <= n_nationkey * 200.0 + 5000 AND o_orderkey <> n_nationkey""",
    "field_caps": " UNION ALL ".join(
        f"""SELECT '{t}' AS _index, column_name AS field,
            CASE column_type WHEN 'BIGINT' THEN 'long' WHEN 'INTEGER' THEN 'integer' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'float'
                             WHEN 'TIMESTAMP' THEN 'date' ELSE 'text' END AS type,
            false AS conflict, true AS has_data FROM (DESCRIBE {t})"""
        for t in IDS
    )
    + """ UNION ALL SELECT 'prices', 'amount', 'double', true, true UNION ALL SELECT 'brands', 'amount', 'text', true, true""",
    "field_caps_variant": r"""WITH bodies AS (
          SELECT 'orders' AS _index, json_object('who', o_custkey, 'state', json_object('code', o_orderstatus, 'late', NULL),
                 'sums', json_array(o_custkey, o_orderkey + 0.5::DOUBLE),
                 'note', CASE WHEN o_orderkey % 3 = 0 THEN CAST('1' AS JSON) ELSE CAST('{"by":true,"lists":[]}' AS JSON) END) AS body FROM orders
          UNION ALL SELECT 'parts', json_object('who', p_brand, 'state', json_object('code', p_size),
                 'rows', json_array(json_object('n', p_size), json_object('n', p_partkey))) FROM part),
        nodes AS (SELECT _index, regexp_replace(fullkey, '^\$\.?|\[[0-9]+\]', '', 'g') AS field, t.type AS kind FROM bodies, json_tree(body) AS t),
        typed AS (SELECT DISTINCT _index, field, CASE WHEN kind IN ('UBIGINT', 'BIGINT') THEN 'long' WHEN kind = 'DOUBLE' THEN 'double'
                         WHEN kind = 'VARCHAR' THEN 'text' ELSE lower(kind) END AS type
                  FROM nodes WHERE field <> '' AND kind NOT IN ('ARRAY', 'NULL')),
        kept AS (SELECT * FROM typed AS t WHERE NOT (type = 'long' AND EXISTS (FROM typed AS u WHERE u._index = t._index AND u.field = t.field AND u.type = 'double'))
                   AND NOT (type = 'object' AND NOT EXISTS (FROM typed AS u WHERE u._index = t._index AND u.field = t.field AND u.type <> 'object')))
        SELECT _index, field, type, (SELECT count(DISTINCT type) FROM kept AS k WHERE k.field = kept.field) > 1 AS conflict, true AS has_data FROM kept""",
    "analyze_tokens": _analyze_sql("documents", "doc_id"),
    "analyze_conversations": _analyze_sql("conversations", "conv_id, turn"),
    "termvectors": f"WITH {_VECTORS} SELECT * FROM vec JOIN stats USING (term) CROSS JOIN field",
    "mtermvectors": f"""WITH
        texts AS (SELECT 'documents' AS _index, doc_id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark),
        asked AS (SELECT DISTINCT unnest(['documents', 'benchmark']) AS _index, doc_id FROM labels),
        {_RUNS.format(ids="_index, doc_id", table="texts")},
        vec AS (SELECT _index, doc_id, token AS term, count(*) AS tf, string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS positions,
                       string_agg(CAST(CAST(e AS BIGINT) AS VARCHAR), ',' ORDER BY s) AS end_offsets
                FROM words GROUP BY _index, doc_id, token),
        stats AS (SELECT _index, term, count(*) AS doc_freq, CAST(sum(tf) AS BIGINT) AS total_tf FROM vec GROUP BY _index, term),
        field AS (SELECT _index, count(DISTINCT doc_id) AS doc_count FROM vec GROUP BY _index)
        SELECT _index, doc_id, t.doc_id IS NOT NULL AS found, term, tf, coalesce(positions, '') AS positions,
               coalesce(end_offsets, '') AS end_offsets, doc_freq, total_tf, doc_count
        FROM asked a LEFT JOIN (SELECT DISTINCT _index, doc_id FROM texts) t USING (_index, doc_id)
        LEFT JOIN vec USING (_index, doc_id) LEFT JOIN stats USING (_index, term)
        LEFT JOIN field ON field._index = vec._index""",
    "scroll_all_pages": """WITH keyed AS (SELECT o_orderkey, CASE WHEN o_totalprice <= 200000 THEN o_totalprice END AS price FROM orders)
        SELECT o_orderkey, price, CAST((row_number() OVER (ORDER BY price DESC NULLS LAST, o_orderkey) - 1)
                                       // (SELECT CAST(ceil(count(*) / 5) AS BIGINT) FROM orders) + 1 AS INTEGER) AS page FROM keyed""",
}
SQL |= {
    "termvectors_top_terms": f"""WITH {_VECTORS}
        SELECT doc_id, term, tf, doc_freq, round(tf * ln(1 + (doc_count - doc_freq + 0.5) / (doc_freq + 0.5)), 6) AS score
        FROM vec JOIN stats USING (term) CROSS JOIN field
        WHERE tf <= 50 AND doc_freq >= 2 AND length(term) BETWEEN 3 AND 12
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) <= 5""",
    "postings_msearch": SQL["msearch_benchmark"],
    "postings_explain": SQL["explain_terms"],
    "postings_terms": SQL["terms_enum_prefix"],
    "postings_refreshed": f"WITH {_CHANGED}, {_HITS} SELECT 'documents' AS _index, doc_id AS _id, score AS _score FROM hits",
    "postings_compacted": f"""WITH {_CHANGED}, {_HITS}
        SELECT 'documents' AS _index, doc_id AS _id, score AS _score FROM hits ORDER BY score DESC, doc_id LIMIT 50""",
}
