"""Profiles from counted values and from sketches; draws without sorting the table."""

import random

import pytest
from pyspark.sql import functions as F

from kiln.operators import profile as P
from kiln.operators.relational import rows_at, sample_n
from kiln.plans import all_queries


def test_skim_has_no_expand(spark, sf):
    plan = all_queries()["p4_skim"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_skim_of_text(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("", None, 2.0), (" \t", None, None), ("a", None, 4.0), (None, None, 5.0)], "s string, none string, x double")
    got = {r.skim_variable: r for r in P.skim(df).collect()}
    s, none, x = got["s"], got["none"], got["x"]
    assert (s.n_missing, s.min_len, s.max_len, s.empty, s.n_unique, s.whitespace, s.mean) == (1, 0, 2, 1, 3, 1, None)
    assert (none.n_missing, none.min_len, none.empty, none.n_unique, none.whitespace) == (5, None, 0, 0, 0)
    assert (x.n_missing, x.n_unique, x.mean, x.p0, x.p50, x.p100) == (1, None, 3.0, 1.0, 3.0, 5.0)
    assert P.skim(df.where("x > 9")).count() == 3


def test_sketches_stay_within_their_error(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("day"), F.concat(F.lit("w"), F.col("id") % 30_000).alias("w"),
                                     ((F.col("id") * 7919) % 100_003).cast("double").alias("x"))
    approx = {r.skim_variable: r for r in P.skim(df, exact=False).collect()}
    assert approx["w"].n_unique == pytest.approx(30_000, rel=0.06)
    for p, v in ((25, approx["x"].p25), (50, approx["x"].p50), (75, approx["x"].p75)):
        assert v == pytest.approx(1000 * p, abs=2500)
    # sketches of parts, added up, tell the same as the table
    kept = P.sketches(df, ["day"])
    assert kept.count() == 14
    for part, days in ((kept, range(7)), (kept.where("day < 3"), range(3))):
        own = {r.column: r for r in P.profile_of(part).collect()}
        exact = df.where(F.col("day").isin(*days))
        assert own["x"].n == exact.count() and own["w"].quantiles is None
        assert own["w"].n_unique == pytest.approx(exact.select("w").distinct().count(), rel=0.06)
        assert own["x"].quantiles[2] == pytest.approx(exact.selectExpr("median(x)").first()[0], abs=2500)


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp", "string"])
def test_rows_at_positions(spark, kind):
    rng = random.Random(3)
    rows = [(rng.choice([None, 5, 5, 5, rng.randrange(1000)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, i long").repartition(5)
    df = df.withColumn("k", {"long": F.col("k"), "double": F.when(F.col("i") % 50 == 0, F.lit(float("nan"))).when(F.col("i") % 51 == 0, F.lit(float("inf"))).otherwise(F.col("k") / 7),
                             "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("k").cast("int")),
                             "timestamp": F.timestamp_seconds(F.col("k")), "string": F.col("k").cast("string")}[kind])
    want = [0, 1, 2, 600, 601, 1500, 2999, 77]
    got = rows_at(df, ["k", "i"], spark.createDataFrame([(p,) for p in want], "p long"), "p", buckets=16)
    order = [r.i for r in df.orderBy("k", "i").collect()]
    assert sorted((r.p, r.i) for r in got.collect()) == sorted((p, order[p]) for p in want)


def test_draws_move_few_rows(spark, sf):
    df = spark.range(50_000).select(F.col("id"), (F.col("id") * 31 % 50_000).alias("v")).repartition(6)
    got = sample_n(df, 20, seed=3, replace=True, order="id").collect()
    assert len(got) == 20 and len({r.draw for r in got}) == 20 and all(r.v == r.id * 31 % 50_000 for r in got)
    assert sample_n(df.where("id < 0"), 5, replace=True, order="id").count() == 0
    assert sample_n(df.where("id = 7"), 5, replace=True, order="id").count() == 5
