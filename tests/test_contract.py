import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences

from checks.oracles import build
from checks.queries import QUERIES

ORACLES = build()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(ORACLES[name]).df()
    assert differences(got, want) == ""


@pytest.mark.parametrize(("name", "kind", "least"), [("stream_late", "parquet", 24), ("golden_roundtrip", "txt", 2)])
def test_logs_are_written_in_several_tasks(spark, sf_dir, monkeypatch, name, kind, least):
    from pathlib import Path

    import checks.queries as made

    paths, plain = [], made.scratch_path
    monkeypatch.setattr(made, "scratch_path", lambda *a: paths.append(plain(*a)) or paths[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        made.QUERIES[name](spark, sf_dir).count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(len(list(Path(p.removeprefix("file:")).rglob(f"part-*.{kind}"))) for p in paths) >= least
