"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.llm import decontamination, fingerprints, html_extraction, packing, personal_data, quality, resampling, sharding, simhash, spelling, token_counts, toxicity, url_filters
from docquery.llm.tables import table
from docquery.session import new_folder


def tokenizer_files() -> packing.TokenizerFiles:
    import public_tokenizers

    return packing.TokenizerFiles(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after loading all documents with two tokenizer versions, removing copies, recounting without repeated lines, and a replay."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    ledger = token_counts.Ledger.create(spark, new_folder(spark, "ledger"))
    loaded = [token_counts.changes(docs, "insert", version) for version in token_counts.VERSIONS]
    ledger.commit("load", loaded[0].unionByName(loaded[1]))
    extra = token_counts.copies(docs).withColumn("text", F.lit(None).cast("string"))
    removed = [token_counts.changes(extra, "delete", version) for version in token_counts.VERSIONS]
    removed = removed[0].unionByName(removed[1])
    ledger.commit("copies", removed)
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    repeated = docs.filter(F.size(F.array_distinct(lines)) < F.size(lines))
    once = token_counts.count_tokens(F.array_join(F.array_distinct(lines), "\n"), "words-1")
    revised = token_counts.changes(repeated, "revise", "words-1", once)
    ledger.commit("lines", revised.join(extra.select("doc_id"), "doc_id", "left_anti"))
    ledger.commit("copies", removed)
    return ledger.totals()


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"), html_extraction.default_field())


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), url_filters.train(url_filters.seeds(spark)))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_files())


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_html_extraction,
        op3_document_fingerprints,
        op4_url_filters,
        op5_quality_classifier,
        op6_sharding,
        op7_toxicity,
        op8_benchmark_decontamination,
        op9_simhash_near_dedup,
        op10_best_fit_packing,
        op11_spelling_variants,
        op12_importance_resampling,
        op13_personal_data,
    )
}

SQL = {
    "op1_token_counts": r"""
        WITH kept AS (
            SELECT source, lang, coalesce(text, '') AS text FROM documents
            QUALIFY row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) = 1),
        counted AS (
            SELECT source, lang, 'words-1' AS tokenizer,
                   len(regexp_extract_all(array_to_string(list_distinct(string_split(text, chr(10))), chr(10)), '[^\x20\x09-\x0D]+')) AS n FROM kept
            UNION ALL
            SELECT source, lang, 'words-2' AS tokenizer, len(regexp_extract_all(text, '\p{L}+|\p{N}+|[^ \t\n\r\p{L}\p{N}]')) AS n FROM kept)
        SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM counted GROUP BY ALL""",
    "op8_benchmark_decontamination": r"""
        WITH items AS (
            SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
        spots AS (
            SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 13, 0) + 2)) AS i FROM items WHERE len(ws) > 0),
        windows AS (
            SELECT DISTINCT item_id, least(len(ws), 13) AS m, array_to_string(ws[i:i + 12], ' ') AS gram FROM spots),
        docs AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        starts AS (
            SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(ws) >= m),
        found AS (
            SELECT s.doc_id, s.i, s.m, w.item_id FROM starts s JOIN windows w ON s.m = w.m AND array_to_string(s.ws[s.i:s.i + s.m - 1], ' ') = w.gram),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM found) GROUP BY doc_id),
        ids AS (
            SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS all_ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(x.n_items, 0) AS n_items,
               sha256(coalesce(x.all_ids, '')) AS items_sha256,
               coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.ws) AS contaminated
        FROM docs d LEFT JOIN hits h USING (doc_id) LEFT JOIN ids x USING (doc_id)""",
}
