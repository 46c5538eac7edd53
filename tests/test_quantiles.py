"""Exact quantiles by counting, and sketches whose rank error is stated."""

import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import quantiles

QS = [0.0, 0.05, 0.5, 0.95, 0.99, 1.0]
EDGE = [
    0.0, -0.0, 1.0, math.nextafter(1.0, 0), math.nextafter(1.0, 2), 2.0, 0.1, 1e-300, 5e-324, 2.2250738585072014e-308, 1.1e-308, 1.7976931348623157e308,
    8.0, math.nextafter(8.0, 0), 1e22, 3.5, -1.0, -5e-324, -1e300, 2.0**1023, float("inf"), float("-inf"), 2.0**-1022, 1023.0,
]


def test_bits_have_the_order_of_the_values(spark):
    chance = random.Random(5)
    values = EDGE + [math.ldexp(chance.random() + 0.5, chance.randint(-1073, 1023)) * chance.choice((1, -1)) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", quantiles.ordered_bits(F.col("v")).alias("b")).collect()
    by_value = sorted(rows, key=lambda r: r.v)
    assert [r.b for r in by_value] == sorted(r.b for r in rows)
    assert len({r.b for r in rows}) == len({r.v for r in rows})
    nan = spark.createDataFrame([(float("nan"),)], "v double").select(quantiles.ordered_bits(F.col("v"))).first()[0]
    assert nan > max(r.b for r in rows)


def samples():
    rng = np.random.default_rng(6)
    rows = [("hot", float(v)) for v in rng.lognormal(size=5000)] + [("ties", float(v)) for v in rng.integers(0, 3, 700)]
    rows += [("one", 4.25), ("two", -1.0), ("two", 3.0), ("null", None), (None, 2.0), (None, 1.0), ("same", 7.0), ("same", 7.0), ("hot", None)]
    return rows + [("wide", float(s * 10.0**e)) for e in range(-30, 30) for s in (1, -1, 3)]


@pytest.mark.parametrize("settled", [quantiles.SETTLED, 0, 500])
def test_exact_quantiles_equal_sql(spark, settled):
    rows = samples()
    frame = spark.createDataFrame([(a, b, "x", 1) for a, b in rows], "variant string, latency_s double, _v string, q int").repartition(5)
    got = {(r.variant, r.q): (r.n, r.disc, r.cont) for r in quantiles.exact_quantiles(frame, ["variant"], QS, settled=settled).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (variant VARCHAR, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    told = con.execute(f"SELECT variant, count(*), quantile_disc(v, {QS}), quantile_cont(v, {QS}) FROM t WHERE v IS NOT NULL GROUP BY variant").fetchall()
    want = {(variant, q): (n, d, c) for variant, n, disc, cont in told for q, d, c in zip(QS, disc, cont)}
    assert got.keys() == want.keys()
    for key, (n, disc, cont) in want.items():
        assert got[key][:2] == (n, disc) and math.isclose(got[key][2], cont, rel_tol=1e-12), key


def test_exact_quantiles_without_labels_or_rows(spark):
    frame = spark.createDataFrame([(float(v),) for v in range(101)], "latency_s double")
    assert [(r.q, r.n, r.disc, r.cont) for r in quantiles.exact_quantiles(frame, [], [0.5]).collect()] == [(0.5, 101, 50.0, 50.0)]
    assert quantiles.exact_quantiles(frame.limit(0), [], [0.5]).count() == 0
    assert quantiles.exact_quantiles(frame.where("latency_s < 0").withColumn("k", F.lit(1)), ["k"], [0.5]).count() == 0


def test_a_hot_label_is_counted_and_not_gathered(spark, monkeypatch):
    """Most rows of one label: the largest table that is shuffled has one row per digit, whatever the label holds."""
    frame = spark.range(40_000).select(F.lit("hot").alias("variant"), (F.col("id") % 9973 / 7.0).alias("latency_s"))
    made = []
    plain = quantiles.materialize
    monkeypatch.setattr(quantiles, "materialize", lambda df, label: made.append((label, plain(df, label))) or made[-1][1])
    values = [float(i % 9973 / 7.0) for i in range(40_000)]
    got = {r.q: r.disc for r in quantiles.exact_quantiles(frame, ["variant"], [0.5, 0.99], settled=0).collect()}
    assert got == {q: sorted(values)[math.ceil(q * 40_000) - 1] for q in (0.5, 0.99)}
    assert all(df.count() <= 6 for label, df in made if label in ("quantile-ranks", "quantile-totals", "quantile-found"))


def rank_error(values, estimate, q):
    below, upto = sum(v < estimate for v in values) / len(values), sum(v <= estimate for v in values) / len(values)
    return max(below - q, q - upto, 0.0)


@pytest.mark.parametrize("error", [0.02, 0.1])
def test_sketches_keep_their_rank_error_also_merged(spark, error):
    rng = np.random.default_rng(7)
    rows = [(int(m), "ab"[int(v)], float(x)) for m, v, x in zip(rng.integers(0, 30, 60_000), rng.random(60_000) < 0.1, rng.lognormal(size=60_000))]
    frame = spark.createDataFrame(rows, "m int, variant string, latency_s double")
    log = frame.select(F.timestamp_seconds(F.col("m") * 60 + 7).alias("ts"), "variant", "latency_s").repartition(8)
    minutes = quantiles.minute_sketches(log, ["variant"], rank_error=error)
    qs = [0.01, 0.5, 0.95, 0.99]
    held = defaultdict(list)
    for m, variant, x in rows:
        held[variant, None].append(x)
        for end in range(m + 1, m + 11):
            held[variant, end].append(x)
    whole = quantiles.sketch_quantiles(quantiles.merged(minutes, ["variant"], error), qs).collect()
    sliding = quantiles.sliding_sketches(minutes, ["variant"], 10, error).withColumn("e", (F.unix_seconds("window_end") / 60).cast("int"))
    told = [(r.variant, None, r.n, r.q, r.value) for r in whole] + [
        (r.variant, r.e, r.n, r.q, r.value) for r in quantiles.sketch_quantiles(sliding, qs).collect()
    ]
    assert len(told) == len(held) * len(qs)
    for variant, end, n, q, value in told:
        assert n == len(held[variant, end])
        assert rank_error(held[variant, end], value, q) <= error


def test_sketches_of_little_and_nothing(spark):
    log = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None)], "variant string, latency_s double")
    log = log.withColumn("ts", F.timestamp_seconds(F.lit(30)))
    got = quantiles.sketch_quantiles(quantiles.minute_sketches(log, ["variant"]), [0.5]).collect()
    assert [(r.variant, r.n, r.value) for r in got] == [("a", 1, 1.0)]
    assert quantiles.minute_sketches(log.limit(0), ["variant"]).count() == 0
