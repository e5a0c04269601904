"""URL verdicts: rules by host and path, then gradient-boosted trees on lexical features.

Features are the lengths of the URL and its host, the depth of the path, the share
of digits, the entropies of host and path, the numbers of parameters, hyphens and
host labels, and how often labelled URLs of the same suffix (last two host labels)
are to be blocked. The trees are Spark's own, trained on labelled URLs.

Cases: a NULL URL, or one without "://", has an empty host and path, fits no rule
and is judged by the features of an empty URL. Repeated rows are judged each.
Without labelled URLs of both kinds everything that no rule blocks is allowed.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquery.session import bounded_broadcast, materialize

#: (host, path, verdict) as the contract fixes them.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TREES, DEPTH = 20, 4
#: Weight of the overall share of blocked URLs in a suffix's share.
SMOOTHING = 20.0
FEATURES = ["f_length", "f_host", "f_depth", "f_digits", "f_host_entropy", "f_path_entropy", "f_parameters", "f_hyphens", "f_labels", "f_suffix"]

_ORDINARY = "river garden school museum library city journal science music travel health history weather market forum kitchen village theatre sport nature".split()
_SALES = "cheap free win bonus casino pills bets loans sale deal cash prize offer click best hot spam farm slots replica".split()
_ENDS = ["com", "org", "net", "example.com", "example.org", "example.net", "de", "fr", "info"]


def seed_urls(count: int = 1200, seed: int = 11) -> list[tuple[str, int]]:
    """Labelled URLs made from a rule, 1 for those to block: sales words joined by hyphens, long numbers, many parameters."""
    r = random.Random(seed)
    out = []
    for i in range(count):
        bad = i % 2
        end = r.choice(_ENDS)
        front = r.choice(["", "", "www.", "blog.", "m."])
        section = r.choice(["en", "de", "fr", "es", "news", "article"])
        page = f"/{section}/{r.randrange(1, 10000)}"
        tail = r.choice(["", "/", ".html", "#top", "?page=2&ref=x", "?utm_source=feed"])
        if not bad:
            name = r.choice(_ORDINARY) + r.choice(["", "", r.choice(_ORDINARY)])
            if r.random() < 0.3:
                page = "/" + "/".join(r.choice(_ORDINARY) for _ in range(r.randrange(1, 4)))
        else:
            name = "-".join(r.choice(_SALES) for _ in range(r.randrange(2, 4)))
            kind = r.random()
            if kind < 0.25:
                name += str(r.randrange(10, 9999))
            elif kind < 0.45:
                tail = "?" + "&".join(f"{r.choice('abcdefgh')}{k}={r.randrange(10**8)}" for k in range(r.randrange(3, 8)))
            elif kind < 0.55:
                name = "".join(r.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(r.randrange(14, 26)))
        out.append((f"{r.choice(['http', 'https'])}://{front}{name}.{end}{page}{tail}", bad))
    return out


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct<rule, verdict>, or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text).cast("double")
    parts = F.transform(
        F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")),
        lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / size,
    )
    return F.when(size > 0, F.aggregate(parts, F.lit(0.0), lambda total, p: total - p * F.log2(p))).otherwise(0.0)


def _times(text: Column, mark: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("double")


def suffix_of(name: Column) -> Column:
    """The last two labels of a host."""
    return F.array_join(F.slice(F.concat(F.array(F.lit("")), F.split(name, r"\.")), -2, 2), ".")


def with_features(urls: DataFrame, suffixes: DataFrame | None, overall: float) -> DataFrame:
    """`urls` (with `url`) and the features; columns are named apart from any of the table's."""
    url = F.coalesce("url", F.lit(""))
    name, where = host(url), path(url)
    if suffixes is None:
        urls = urls.withColumn("f_suffix", F.lit(overall))
    else:
        urls = urls.withColumn("f_name", suffix_of(name)).join(bounded_broadcast(suffixes), "f_name", "left").drop("f_name")
        urls = urls.withColumn("f_suffix", F.coalesce("f_suffix", F.lit(overall)))
    values = {
        "f_length": F.length(url).cast("double"),
        "f_host": F.length(name).cast("double"),
        "f_depth": _times(where, "/"),
        "f_digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "f_host_entropy": entropy(name),
        "f_path_entropy": entropy(where),
        "f_parameters": _times(url, "="),
        "f_hyphens": _times(name, "-"),
        "f_labels": _times(name, "."),
    }
    return urls.withColumns(values)


class Model:
    """The trees with the suffix statistics that they were trained with; trees are None without two classes."""

    def __init__(self, trees: GBTClassificationModel | None, suffixes: DataFrame | None, overall: float):
        self.trees, self.suffixes, self.overall = trees, suffixes, overall


def _assembled(urls: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls)


def train(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH) -> Model:
    """Fit on `labelled` (url, label), label 1 for URLs to block. Every suffix has a share of its own, smoothed by the share of all."""
    counted = labelled.groupBy(suffix_of(host(F.col("url"))).alias("f_name")).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    total = labelled.agg(F.count("*"), F.sum("label")).first()
    if not total[0] or total[1] in (0, total[0], None):
        return Model(None, None, 0.0)
    overall = total[1] / total[0]
    share = (F.col("bad") + SMOOTHING * overall) / (F.col("n") + SMOOTHING)
    shares = materialize(counted.select("f_name", share.alias("f_suffix")), "suffixes")
    rows = _assembled(with_features(labelled, shares, overall)).select("features", F.col("label").cast("double").alias("label"))
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, seed=5, labelCol="label", featuresCol="features").fit(rows)
    return Model(fitted, shares, overall)


def judge(pages: DataFrame, model: Model, rules: Iterable[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row."""
    rows = pages.select("page_id", "url")
    if model.trees is None:
        rows = rows.withColumn("prediction", F.lit(0.0))
    else:
        rows = model.trees.transform(_assembled(with_features(rows, model.suffixes, model.overall)))
    rows = rows.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "prediction")
    found = rows.withColumn("found", rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("prediction") == 1.0, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "found.rule", F.coalesce("found.verdict", own).alias("verdict"))


def seeds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(seed_urls(), "url string, label int").coalesce(1)
