"""Spelling variants, importance resampling and personal data against brute force; rows that are NULL, empty, repeated or absent; broken pages; the pipeline."""

import hashlib
import math
import random
import re
import time
from collections import Counter
from zlib import crc32

import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from docquery.llm import decontamination, html_extraction, personal_data, resampling, simhash, spelling
from docquery.llm.html_blocks import blocks
from docquery.session import materialize

LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n long, word string, pattern string, kind int, _row long, _found int, _key int, _a int, _hits int"


@pytest.fixture(scope="module")
def odd(spark):
    """NULL and empty texts, a NULL id, copies, a repeated row, one id with two texts, a long text, wide characters, clashing columns."""
    long_text = " ".join(f"Word{i % 997} letters{i % 13}" for i in range(20_000))
    texts = [(0, None), (1, ""), (2, " \n "), (3, "one two three"), (4, "one two three"), (4, "one two three"), (4, "other text"), (5, long_text), (6, "A\nB"), (None, "lost words here"), (7, "é𝒳 a@b.c 😀 4111 1111 1111 1111 +12 345 678 90")]
    return spark.createDataFrame([(i, t, "en", None, 1, "w", "p", 2, 3, 4, 5, 6, 7) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# -- spelling variants ----------------------------------------------------------------------------


def apart(a, b):
    """Whether two different words are one edit apart."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def expected_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        near = [x for x in words if apart(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, n, len(near), words.get(form)]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


def test_spelling_variants_equal_brute_force(spark):
    rng = random.Random(1)
    words = list({"".join(rng.choice("abcÉé") for _ in range(rng.randrange(5, 9))) for _ in range(300)})
    rows = [(i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=400))) for i in range(40)]
    rows += [(None, "plain " * 3 + "Folding folding foldin foldng"), (60, "foldings " * 300 + "folding " * 40 + "foldin " * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in spelling.variants(docs).collect()}
    wanted = expected_variants(rows)
    assert got == wanted
    assert any(form and root != form for form, _, _, _, root in wanted.values())


@pytest.mark.parametrize(("limit", "letters"), [(40, "ab"), (100_000, "abcdefghijkl")])
def test_list_heads_lose_no_pair(spark, limit, letters):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(400)})
    words += [w[:3] + w[4:] for w in words if len(w) > 7 and w[:3] + w[4:] not in words][:50]
    words = sorted(set(words))
    table = materialize(spark.createDataFrame([(w, 5) for w in words], "word string, n long"), "words")
    got = {frozenset((r.a, r.b)) for r in spelling.pairs(table, limit=limit).collect()}
    assert got == {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if apart(a, b)}


def test_spelling_variants_of_odd_rows(spark, odd, empty):
    got = {r.word: r.n for r in spelling.variants(odd).collect()}
    assert got == {w: n for w, (_, n, _, _, _) in expected_variants([(r.doc_id, r.text) for r in odd.collect()]).items()}
    assert spelling.variants(empty).count() == 0


# -- importance resampling ------------------------------------------------------------------------


def expected_resample(rows, target):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(words), [crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for doc_id, text in rows:
        n, own = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in own)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long_enough = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for place, r in enumerate(long_enough[: 5 * len(long_enough) // 100], 1):
        ranks.setdefault(r[0], []).append(place)
    return Counter((r[0], r[2], r[3], r[4]) for r in out), ranks


def test_resampling_equals_brute_force(spark):
    rng = random.Random(4)
    words = ["red", "Green", "blue-ish", "ça", "x1", "été", "night", "9"]
    rows = [(i, ", ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(300)] + [(None, "red " * 30), (5, "red " * 30)] * 3
    target = ["red green red", "ça été", None, ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = resampling.resample(docs, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string")).collect()
    wanted, ranks = expected_resample(rows, target)
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == wanted
    found = {}
    for r in sorted((r for r in got if r.rank is not None), key=lambda r: r["rank"]):
        found.setdefault(r.doc_id, []).append(r["rank"])
    assert found == ranks and sum(map(len, ranks.values())) > 5


def test_resampling_of_odd_rows(spark, odd, empty):
    got = resampling.resample(odd, odd.select("text")).collect()
    wanted, _ = expected_resample([(r.doc_id, r.text) for r in odd.collect()], [r.text for r in odd.collect()])
    assert Counter((r.doc_id, r.n_features, r.weight, r.score) for r in got) == wanted
    assert resampling.resample(empty, odd).count() == 0
    assert resampling.resample(odd, empty).count() == odd.count()


# -- personal data --------------------------------------------------------------------------------

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for n, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fits = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if fits:
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def check_base(rows, got):
    wanted = Counter()
    for doc_id, text in rows:
        spans = base_spans(text)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in spans).encode()).hexdigest()
        wanted[doc_id, *(sum(k == kind for _, _, _, k in spans) for kind in KINDS), digest] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == wanted


def test_base_spans_equal_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["a.b@c.de", "@", ".", "1.2.3.4", "255", "256", "+", " ", "-", "(", "4111 1111 1111 1111", "4111111111111111", "+49 30 1234567", "é", "😀", "x_y", "0", "12"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randrange(0, 40)))) for i in range(400)]
    rows += [(900, "12 " * 3000 + " x " + "1.2.3.4 " * 200), (901, "a" * 200_000), (902, "1" * 200_000), (903, "+1" + " " * 100_000)]
    check_base(rows, personal_data.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_contexts_discover_unseen_identifiers(spark):
    rows = [f"please call me at +49 30 {1000000 + i * 7919} today ok" for i in range(9)]
    rows += [f"please mail to joe.{i}@example.com now" for i in range(9)]
    found = ["so call me at 030 5551234 today fine", "my old 030 5551234 is dead", "please mail to jim (at) example.org now"]
    clean = ["sum 123456 total", "please bring 123456 now", "x password=abc1234567", "call me at noon today"]
    docs = spark.createDataFrame(list(enumerate(rows + found + clean)), "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data.personal_data(docs).collect()}
    assert [got[len(rows) + i].spans for i in range(3)] == ["phone:14:25", "phone:7:18", "email:15:35"]
    assert all(got[len(rows) + len(found) + i].spans == "" for i in range(len(clean)))
    assert got[0].spans.startswith("phone:18:") and got[0].n_added == 0
    check_base([(r.doc_id, r.text) for r in docs.collect()], got.values())


def test_impure_contexts_discover_nothing(spark):
    rows = [f"the +49 30 {1000000 + i * 7919} of it" for i in range(6)] + [f"the {i}1234567 of it" for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert personal_data.personal_data(docs).filter("n_added > 0").count() == 0


def test_personal_data_of_odd_rows(spark, odd, empty):
    check_base([(r.doc_id, r.text) for r in odd.collect()], personal_data.personal_data(odd).collect())
    assert personal_data.personal_data(empty).count() == 0


# -- pages, clashing names, the pipeline ----------------------------------------------------------


def test_embedded_elements_lose_no_text():
    page = "<article><p>First.</p><svg width=1 /><p>Let <math><mi>x</mi></math> be.</p><audio src=x><p>Last.</article>"
    assert [b.text for b in blocks(page)] == ["First.", "Let x be.", "Last."]


@pytest.mark.parametrize("piece", ["<script ", "<div>", "<i>x", "<div>x", "<a href='>", "<!", "<p "])
def test_broken_pages_take_linear_time(piece):
    page = piece * (300_000 // len(piece))
    start = time.process_time()
    sum(len(b.text) for b in blocks(page))
    assert time.process_time() - start < 20


def test_repeated_and_clashing_pages(spark):
    rows = [(1, "u", "<article><p>Main text."), (1, "u", "<article><p>Main text."), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id int, url string, html string").withColumn("text", F.lit("own")).withColumn("n_chars", F.lit(1))
    got = sorted((r.page_id, r.text) for r in html_extraction.extract(pages, html_extraction.default_field()).collect())
    assert got == [(1, "Main text."), (1, "Main text."), (2, "")]
    assert html_extraction.extract(pages.limit(0), html_extraction.default_field()).count() == 0


def test_stages_keep_columns_of_clashing_names(spark, odd):
    benchmark = spark.createDataFrame([(1, "one two three"), (2, "lost words here")], "item_id int, text string")
    for part_bytes in (10**6, 8):
        kept = decontamination.clean(odd, benchmark, part_bytes)
        assert kept.columns == odd.columns
        assert sorted((r.doc_id or -1, r._found) for r in kept.collect()) == [(1 if i == 1 else i, 4) for i in (-1, 1, 2, 4, 5, 6, 7)]
    once = simhash.one_of_each(odd)
    assert once.columns == odd.columns and {r._key for r in once.collect()} == {5}


def test_more_fingerprints_take_fewer_segments():
    assert simhash.segments_for(1000) == simhash.SEGMENTS and simhash.segments_for(10**10) == 2


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    """Stage by stage on clashing columns; what is kept is what the fingerprints and the words of a benchmark leave."""
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "other text")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == odd.columns
    kept = Counter((r.doc_id, r.text) for r in docs.collect())
    # One row of each fingerprint's component stays; texts without words are one; "other text" is a benchmark item.
    groups = {}
    for r in odd.collect():
        groups.setdefault(simhash.simhash(r.text), []).append((r.doc_id is None, r.doc_id or 0, r.text))
    prints = list(groups)
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    wanted = Counter((None if g[0] else g[1], g[2]) for g in (min(x, key=lambda y: y[:2]) for x in groups.values()) if g[2] != "other text")
    assert {k for k, _ in kept} == {k for k, _ in wanted} and sum(kept.values()) == sum(wanted.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(k for k, _ in kept.elements())


def test_scan_equals_three_plain_scans():
    """The one scan against an overlapped scan per length."""
    text = b"one two  three".replace(b"  ", b" ")
    plain = [m.group() for n in range(3) for m in regex.finditer(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % n, text, overlapped=True)]
    assert sorted(crc32(p) % 10000 for p in plain) == sorted(resampling.buckets("One, two -- THREE")[1].tolist())
