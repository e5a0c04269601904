"""The methods of the training-data operators against enumeration, plain solvers and the tokenizer."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docquery.llm import fingerprints, html_extraction, packing, quality, sharding, url_filters
from docquery.llm.html_blocks import blocks
from docquery.llm.queries import tokenizer_files

PAGES = [
    ("<nav><a>Home</a><a>About us</a></nav><p>The river rose, and the town waited for days.</p><footer>Contact</footer>", [0, 1, 0]),
    ("<h1>News</h1><p>First words here.</p><p>More words, with a comma.</p><div class=ad>Buy now</div>", [1, 1, 1, 0]),
    ("<div class=menu><a>One</a></div><article><p>Only this long sentence counts.</p></article>", [0, 1]),
    ("<p>Alone.</p>", [1]),
]


def _score(field, page, labels):
    unary = sum(sum(field.weights.get(f, 0.0) for f in html_extraction.features(b)) for b, y in zip(page, labels, strict=True) if y)
    return unary + field.first[labels[0]] + sum(field.moves[a][b] for a, b in itertools.pairwise(labels))


def test_viterbi_finds_the_best_of_all_label_sequences():
    r = random.Random(3)
    tags = ["<p>{}</p>", "<li>{}</li>", "<nav><a>{}</a></nav>", "<div class=ad>{}</div>"]
    for _ in range(40):
        page = list(blocks("".join(r.choice(tags).format(" ".join(r.choices(["one", "two,", "three."], k=r.randint(1, 12)))) for _ in range(r.randint(1, 8)))))
        names = {f for b in page for f in html_extraction.features(b)}
        field = html_extraction.Field({f: r.gauss(0, 1) for f in names}, [[r.gauss(0, 2) for _ in range(2)] for _ in range(2)], [r.gauss(0, 1), r.gauss(0, 1)])
        best = max(_score(field, page, labels) for labels in itertools.product((0, 1), repeat=len(page)))
        assert _score(field, page, tuple(field.labels(page))) == pytest.approx(best)


def test_training_reaches_the_greatest_penalised_likelihood():
    """The likelihood by enumeration of all label sequences falls on either side of every trained weight."""
    penalty = 0.05
    field = html_extraction.train(PAGES, steps=1500, penalty=penalty)
    found = [(list(blocks(p)), tuple(labels)) for p, labels in PAGES]
    count = sum(len(page) for page, _ in found)

    def objective(f):
        likelihood = 0.0
        for page, labels in found:
            every = [_score(f, page, y) for y in itertools.product((0, 1), repeat=len(page))]
            top = max(every)
            likelihood += _score(f, page, labels) - top - math.log(sum(math.exp(s - top) for s in every))
        squares = sum(w * w for w in [*f.weights.values(), *itertools.chain(*f.moves), *f.first])
        return likelihood / count - penalty / 2 * squares

    start = objective(field)
    for name in random.Random(1).sample(sorted(field.weights), 8):
        for step in (-0.1, 0.1):
            assert objective(html_extraction.Field(field.weights | {name: field.weights[name] + step}, field.moves, field.first)) < start
    for a, b, step in itertools.product((0, 1), (0, 1), (-0.1, 0.1)):
        moves = [list(row) for row in field.moves]
        moves[a][b] += step
        assert objective(html_extraction.Field(field.weights, moves, field.first)) < start


def test_dual_descent_reaches_the_least_hinge_loss():
    r = random.Random(5)
    texts = ["".join(r.choices("abcd ", k=60)) for _ in range(15)] + ["".join(r.choices("cdef ", k=60)) for _ in range(15)]
    rows, good, cost = [quality.grams(t) for t in texts], np.array([1.0] * 15 + [-1.0] * 15), 0.05
    machine = quality.fit(rows, good, cost, passes=300)
    ratio = quality.log_ratios(rows, good)
    used = np.unique(np.concatenate(rows))
    x = np.zeros((len(rows), len(used) + 1))
    for i, row in enumerate(rows):
        x[i, np.searchsorted(used, row)] = ratio[row] / np.sqrt(ratio[row] @ ratio[row])
        x[i, -1] = 1.0

    def loss(w):
        return 0.5 * w @ w + cost * np.maximum(0.0, 1.0 - good * (x @ w)).sum()

    own = np.append(np.divide(machine.pull[used], ratio[used], out=np.zeros(len(used)), where=ratio[used] != 0), machine.constant)
    w, least = np.zeros(x.shape[1]), np.inf
    for step in range(1, 20_001):
        wrong = good * (x @ w) < 1.0
        w = w - (w - cost * (x[wrong].T @ good[wrong])) / step
        least = min(least, loss(w))
    assert loss(own) <= least * 1.001
    assert [machine.margin(row) for row in rows] == pytest.approx(list(x @ own))


def test_pieces_hold_the_tokenizers_ids(spark):
    files = tokenizer_files()
    texts = [None, "", "One two, three.\n\n  four", "é ü ß – “x”", "日本語 текст", "a" * 3000, "word " * 700, "<|endoftext|> x", "1234567 it's we'll\t\r\n"]
    plain = Tokenizer.from_file(files.tokenizer)
    found = {}
    for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), files, sequence=100).collect():
        found.setdefault(r["doc_id"], {})[r["piece"]] = (r["start"], r["length"], r["ids_crc32"])
    for i, text in enumerate(texts):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = [found[i][k] for k in range(len(found[i]))]
        assert [n for _, n, _ in pieces[1:]] == [100] * (len(pieces) - 1) and sum(n for _, n, _ in pieces) == len(ids)
        assert len(pieces) == -(-len(ids) // 100)
        for start, n, crc in pieces:
            assert crc == zlib.crc32(np.array(ids[start : start + n], dtype="<u4").tobytes())


def test_propagation_cuts_fewer_links_within_the_quotas(spark):
    """Communities of twelve that aren't stars: random links inside, a few between them."""
    r = random.Random(9)
    inside = [(12 * c + a, 12 * c + b) for c in range(60) for a, b in itertools.combinations(range(12), 2) if r.random() < 0.4]
    links = inside + [tuple(r.sample(range(720), 2)) for _ in range(60)]
    nodes = spark.range(1000).select(F.col("id").alias("node"))
    table = spark.createDataFrame(links, "a long, b long")

    def cut(rounds):
        shard = {x["node"]: x["shard"] for x in sharding.propagate(nodes, table, 4, rounds).collect()}
        assert len(shard) == 1000
        sizes = [sum(shard[n] == s for n in {n for pair in links for n in pair}) for s in range(4)]
        return sum(shard[a] != shard[b] for a, b in links), max(sizes)

    (before, _), (after, largest) = cut(0), cut(6)
    assert after < before * 0.6
    assert largest <= 250


def test_trees_judge_unseen_urls(spark):
    unseen = url_filters.seed_urls(400, 99)
    model = url_filters.train(url_filters.seeds(spark))
    rows = url_filters.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(unseen)], "page_id int, url string"), model, ()).collect()
    right = [(x["verdict"] == "block") == bool(unseen[x["page_id"]][1]) for x in rows]
    assert len(right) == 400 and np.mean(right) >= 0.95
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (2, "", 0.5), (3, "http://" + "x" * 100_000, 0.5)], "page_id int, url string, prediction double")
    assert url_filters.judge(odd, model).count() == 4 and url_filters.judge(odd.limit(0), model).count() == 0


@pytest.mark.parametrize("text", ["", "a", "aab", "http://x.org/?q=1", "日本日"])
def test_entropy_equals_its_definition(spark, text):
    shares = [text.count(c) / len(text) for c in set(text)]
    found = spark.range(1).select(url_filters.entropy(F.lit(text))).first()[0]
    assert (found or 0.0) == pytest.approx(-sum(p * math.log2(p) for p in shares) if shares else 0.0)


def test_edited_texts_equal_their_definition(spark):
    r = random.Random(2)
    texts = {i: " ".join(r.choices("ab cd é 日本 \n xyz".split(" "), k=r.choice([0, 1, 30, 200, 900]))) for i in range(0, 60, 3)}
    texts[7] = None
    ids = sorted(texts)
    parts = lambda t: {p.rstrip(" ") for p in re.findall(rf"(?:\S+[^\S\n]*){{1,{fingerprints.WORDS}}}", t)}
    rows = {x["doc_id"]: x for x in fingerprints.fingerprint(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    for k, i in enumerate(ids):
        own, later = texts[i] or "", texts[ids[(k + 1) % len(ids)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + later[:half]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[i]["n_chars"] == len(own)
        a, b = parts(own), parts(edited)
        assert rows[i]["near_edited"] == pytest.approx(1 - len(a ^ b) / (len(a) + len(b)) if a or b else 1.0)
        assert (rows[i]["fingerprint"] == rows[i]["edited_fingerprint"]) >= (own == edited)
