"""Category shift between two windows, and the capped sample of a stream."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.config import IngestRules
from millrace.operators import drift
from millrace.sources import readers
from millrace.streaming import runner, sample


def window(spark, rows):
    return spark.createDataFrame(rows, "model string, category string")


def divergence(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    return sum(a * math.log2(a / c) + b * math.log2(b / c) for a, b, c in zip(p, q, m)) / 2


def test_shift_of_categories(spark):
    before = [("a", "x")] * 8 + [("a", "y")] * 2 + [("b", "x"), ("b", None)] + [("c", "x")]
    after = [("a", "y")] * 5 + [("a", "z")] * 5 + [("b", None), ("b", "x")] + [("d", "x")] + [(None, "x")]
    got = {r.model: r for r in drift.category_shift(window(spark, before), window(spark, after)).collect()}
    assert got.keys() == {"a", "b", "c", "d", None}
    assert (got["a"].n_before, got["a"].n_after) == (10, 10)
    want = divergence([8.5 / 11.5, 2.5 / 11.5, 0.5 / 11.5], [0.5 / 11.5, 5.5 / 11.5, 5.5 / 11.5])
    assert math.isclose(got["a"].shift, want, rel_tol=1e-12)
    assert got["b"].shift == 0.0  # equal windows
    assert got["c"].shift is None and got["d"].shift is None and got["d"].n_before == 0


def test_a_rare_new_category_moves_little_and_a_new_world_moves_much(spark):
    before = window(spark, [("a", "x")] * 1000)
    rare = drift.category_shift(before, window(spark, [("a", "x")] * 999 + [("a", "new")])).first().shift
    other = drift.category_shift(before, window(spark, [("a", "new")] * 1000)).first().shift
    assert 0 <= rare < 0.001 < 0.99 < other <= 1
    assert drift.category_shift(before.limit(0), before.limit(0)).count() == 0


RULES = IngestRules(max_docs=50, keep_categories=("en", "fr"))
ROWS = "id string, question string, response string, system_prompt string"


def corpus(spark, n):
    rows = [(f"{('en', 'fr', 'de')[i % 3]}.{i}" if i % 11 else "", f"q{i}", f"r{i // 2}", None) for i in range(n)]
    return spark.createDataFrame(rows, ROWS).unionByName(spark.createDataFrame([("en.same", "q", "r", "s")] * 40, ROWS))


def sampled(spark, rows):
    pairs = readers.read_corpus(rows, "docs", RULES)
    return sorted(map(str, pairs.collect()))


@pytest.mark.parametrize("files", [1, 7])
def test_sample_of_a_stream_is_that_of_all_rows(spark, tmp_path, files):
    rows = corpus(spark, 600)
    rows.repartition(files, F.xxhash64("question")).write.parquet(str(tmp_path / "in"))
    stream = runner.stream_files(spark, str(tmp_path / "in"), ROWS)
    query = sample.corpus_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), "docs", RULES)
    got = sample.latest_sample(spark, str(tmp_path / "out"), query)
    assert sorted(map(str, got.collect())) == sampled(spark, rows) and got.count() == 50


def test_a_stopped_sample_goes_on(spark, tmp_path, monkeypatch):
    rows = corpus(spark, 300).repartition(4, F.xxhash64("question"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = runner.stream_files(spark, str(tmp_path / "in"), ROWS)
    plain = sample.write_sample

    def dies(batch, batch_id, *rest):
        plain(batch, batch_id, *rest)
        if batch_id == 1:
            raise RuntimeError("killed")

    monkeypatch.setattr(sample, "write_sample", dies)
    with pytest.raises(Exception, match="killed"):
        sample.corpus_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), "docs", RULES)
    monkeypatch.setattr(sample, "write_sample", plain)
    query = sample.corpus_stream(stream, str(tmp_path / "out"), str(tmp_path / "progress"), "docs", RULES)
    assert sorted(map(str, sample.latest_sample(spark, str(tmp_path / "out"), query).collect())) == sampled(spark, spark.read.parquet(str(tmp_path / "in")))
