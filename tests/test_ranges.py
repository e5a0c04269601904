"""Joining rows to intervals: against brute force, with hot values, on both sides of the broadcast's bound, and its plan."""

import random

import pytest
from pyspark.sql import functions as F

from docquery.operators import templates
from docquery.operators.range_join import parts, quantiles, range_join, range_top


def _both(spark, values, intervals):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    asked = spark.createDataFrame([(k, *pair) for k, pair in enumerate(intervals)], "q int, low double, high double")
    return rows, asked


def _brute(values, intervals, low=True, high=True):
    out = []
    for k, (a, b) in enumerate(intervals):
        for i, v in enumerate(values):
            if v is None or (low and (a is None or v < a)) or (high and (b is None or v > b)):
                continue
            out.append((k, i))
    return sorted(out)


def _case(seed):
    r = random.Random(seed)
    values = [r.choice([None, 5.0, 5.0, 5.0, round(r.uniform(0, 100), 1), -0.0, 0.0]) for _ in range(300)]
    intervals = [(r.choice([None, 5.0, r.uniform(-5, 100)]), r.choice([None, 5.0, r.uniform(0, 110)])) for _ in range(40)]
    return values, intervals + [(5.0, 5.0), (9.0, 3.0), (-1e9, 1e9), (500.0, 600.0)]


@pytest.mark.parametrize("ranges", [1, 4, 50])
@pytest.mark.parametrize("fits", [True, False])
def test_equals_brute_force(spark, ranges, fits):
    values, intervals = _case(ranges)
    rows, asked = _both(spark, values, intervals)
    for low, high in (("low", "high"), ("low", None), (None, "high")):
        found = range_join(rows, asked, "v", low, high, ranges, small=lambda df: fits)
        assert found.columns == ["i", "v", "q", "low", "high"]
        assert sorted((r.q, r.i) for r in found.collect()) == _brute(values, intervals, low is not None, high is not None)


def test_no_rows_or_no_intervals(spark):
    values, intervals = _case(1)
    for v, n in (([], intervals), (values, []), ([], []), ([None], intervals)):
        assert range_join(*_both(spark, v, n), "v", "low", "high").count() == 0


def test_repeated_rows_and_taken_names(spark):
    rows = spark.createDataFrame([(1, 2.0), (1, 2.0), (2, 9.0)], "_range int, v double")
    asked = spark.createDataFrame([(0, 1.0, 3.0), (0, 1.0, 3.0)], "_Row_Part int, low double, high double")
    found = range_join(rows, asked, "v", "low", "high")
    assert found.columns == ["_range", "v", "_Row_Part", "low", "high"] and found.count() == 4


def test_what_cannot_be_cut_is_refused(spark):
    rows = spark.createDataFrame([("a", 1)], "v string, n int")
    asked = spark.createDataFrame([("a", 1, 2)], "low string, n int, high long")
    for df, value, bounds in (
        (rows.select("v"), "v", ("low", None)),
        (rows.select(F.col("n").alias("v")), "v", ("n", "high")),
        (rows, "n", ("n", None)),
        (rows.select(F.col("n").alias("v")), "v", (None, None)),
    ):
        with pytest.raises(ValueError):
            range_join(df, asked, value, *bounds)


def test_times_and_whole_numbers(spark):
    days = spark.range(50).select(F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, id)").alias("t"), F.col("id").alias("n"))
    asked = days.filter("n in (3, 40)").select(F.col("t").alias("since"), F.col("n").alias("least"))
    assert range_join(days, asked, "t", "since", None, ranges=8).count() == 47 + 10
    assert range_join(days, asked, "n", None, "least", ranges=8).count() == 4 + 41


def test_a_hot_value_is_dealt_to_many_parts():
    plan = parts({0: 100, 1: 100_000, 2: 50}, {0: 10, 1: 1000, 2: 5, 3: 7}, 64)
    assert [k for k, *_ in plan] == [0, 1, 2] and dict((k, (a, b)) for k, a, b in plan)[1] == (64, 1)
    assert sum(a * b for _, a, b in plan) <= 64 + 3
    # More intervals than rows: the intervals are dealt out, the rows copied.
    assert parts({0: 10}, {0: 1_000_000}, 16) == [(0, 1, 16)]


def test_cuts_have_even_shares(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("v"))
    cuts = quantiles(df, "v", 10)
    # Each cut is off by a tenth of a share at most.
    assert len(cuts) == 9 and all(abs(c - 1000 * (k + 1)) <= 100 for k, c in enumerate(cuts))


def test_copies_of_an_interval_follow_what_it_finds(spark):
    """A narrow interval touches few ranges, and the plan has neither a cartesian product nor a nested loop."""
    rows = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    asked = spark.range(500).select(F.col("id").alias("query_id"), (F.col("id") * 37.0).alias("low"), (F.col("id") * 37.0 + 20).alias("high"))
    found = templates.msearch_template(rows, asked, size=None, between={"v": ("low", "high")})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert found.count() == 500 * 21


def test_a_template_without_any_key_is_refused(spark):
    with pytest.raises(ValueError):
        templates.msearch_template(spark.range(1), spark.range(1).withColumnRenamed("id", "query_id"))


def test_wide_parameters_are_not_sent_out(spark, monkeypatch):
    params = spark.range(10).select(F.col("id").alias("query_id"), F.repeat(F.lit("x"), 1000).alias("wide"))
    assert templates._small(params)
    monkeypatch.setattr(templates, "PARAMETER_BYTES", 5000)
    assert not templates._small(params)


@pytest.mark.parametrize("fits", [True, False])
def test_first_rows_of_intervals_equal_brute_force(spark, fits, monkeypatch):
    values, intervals = _case(7)
    intervals = [(a, b) for a, b in intervals if a != 9.0] + intervals[:3]
    r = random.Random(3)
    weight = [r.choice([None, 1, 2, 3, 4, 5]) for _ in values]
    rows = spark.createDataFrame([(i, v, w) for i, (v, w) in enumerate(zip(values, weight, strict=True))], "i int, v double, w int")
    asked = spark.createDataFrame([(k, *pair) for k, pair in enumerate(intervals)], "query_id int, low double, high double")
    monkeypatch.setattr(templates, "_small", lambda df: fits)
    for bounds in (("low", "high"), ("low", None), (None, "high")):
        hits = templates.msearch_template(rows, asked, size=4, sort=[F.desc("w"), F.col("i")], between={"v": bounds})
        want = []
        for k in range(len(intervals)):
            own = [i for q, i in _brute(values, intervals, bounds[0] is not None, bounds[1] is not None) if q == k]
            own.sort(key=lambda i: (weight[i] is None, -(weight[i] or 0), i))
            want += [(k, n, i) for n, i in enumerate(own[:4], 1)]
        assert sorted((h.query_id, h["_rank"], h.i) for h in hits.collect()) == sorted(want)


def test_first_rows_of_wide_intervals_need_few_pairs(spark):
    rows = spark.range(20_000).select(F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    asked = spark.range(50).select(F.col("id").alias("query_id"), F.col("id").cast("double").alias("low"), (F.col("id") + 19_000.0).alias("high"))
    top = range_top(rows, asked, "v", "low", "high", 3, [F.desc("v")])
    # The intervals hold 950,000 pairs; two of `BLOCK` blocks per level, of three rows each, bound what is joined.
    assert top.count() < 50 * 4 * 2 * 16 * 3
    assert range_join(rows, asked, "v", "low", "high").count() == 50 * 19_001


def test_first_rows_by_a_parameter_or_under_a_condition(spark):
    rows = spark.createDataFrame([(i, float(i % 10)) for i in range(100)], "i int, v double")
    asked = spark.createDataFrame([(1, 2.0, 5.0), (2, 0.0, 9.0)], "query_id int, low double, high double")
    near = templates.msearch_template(rows, asked, size=2, sort=[F.abs(F.col("v") - F.col("high")), F.col("i")], between={"v": ("low", "high")})
    assert sorted((h.query_id, h.i) for h in near.collect()) == [(1, 5), (1, 15), (2, 9), (2, 19)]
    odd = templates.msearch_template(rows, asked, where=F.col("i") > 40 * F.col("query_id"), size=1, sort=[F.col("i")], between={"v": ("low", "high")})
    assert sorted((h.query_id, h.i) for h in odd.collect()) == [(1, 42), (2, 81)]
