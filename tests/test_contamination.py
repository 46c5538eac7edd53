"""Evaluation items in training rows: by question and by shared word runs."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.operators import chat, contamination, split

NOVEL = [f"w{i}" for i in range(400)]


def runs(words, n):
    return {" ".join(words[i : i + n]) for i in range(len(words) - n + 1)}


def plain(value):
    return re.sub(r"[^\w\s]", "", (value or "").lower()).split()


def brute(docs, items, share=0.8, n=5):
    out = set()
    for item, said in items:
        k = min(n, len(plain(said)))
        want = runs(plain(said), k) if k else set()
        for doc, value in docs:
            words = plain(value)
            at = [i for i in range(len(words) - k + 1) if " ".join(words[i : i + k]) in want] if want else []
            met = {" ".join(words[i : i + k]) for i in at}
            if want and len(met) >= share * len(want):
                out.add((doc, item, len(met), len(want), min(at), max(at) + k - 1))
    return out


ITEMS = [
    (1, " ".join(NOVEL[10:40])), (2, "Only Three words!"), (3, ""), (4, None), (5, " ".join(NOVEL[100:103] * 9)), (6, "..."), (7, " ".join(NOVEL[200:206])),
    (8, "the same start of every page and then " + " ".join(NOVEL[300:304])),
]
DOCS = [
    (1, " ".join(NOVEL)), (2, "before " + " ".join(NOVEL[10:38]) + " changed after"), (3, "ONLY three, words"), (4, "so only three words here"), (5, None),
    (6, ""), (7, " ".join(NOVEL[10:20])), (8, " ".join(NOVEL[100:103] * 3)), (9, (" ".join(NOVEL[200:206]) + " x ") * 50), (None, " ".join(NOVEL[10:40])),
    (10, "only three"),
] + [(1000 + i, f"The same start of every page, and then something else {i}") for i in range(300)]


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in DOCS], "doc_id long, text string, lang string, h int, item int").repartition(4)
    return docs, spark.createDataFrame([(i, t, "y") for i, t in ITEMS], "item_id long, text string, doc string").repartition(2)


@pytest.mark.parametrize("broadcast_runs", [contamination.BROADCAST_RUNS, 0])
@pytest.mark.parametrize(("share", "n"), [(0.8, 5), (0.5, 3), (1.0, 5)])
def test_spans_are_those_of_every_pair(texts, broadcast_runs, share, n):
    docs, items = texts
    got = contamination.contamination_spans(docs, items, share, n, broadcast_runs=broadcast_runs).collect()
    assert {(r.doc_id, r.item_id, r.shared, r.size, r.first_word, r.last_word) for r in got} == brute(DOCS, ITEMS, share, n)
    assert len(got) == len(brute(DOCS, ITEMS, share, n)) and all(r.share == r.shared / r.size for r in got)


def test_repeated_rows_and_empty_tables(texts):
    docs, items = texts
    once = set(map(tuple, contamination.contamination_spans(docs, items).collect()))
    assert set(map(tuple, contamination.contamination_spans(docs.union(docs), items.union(items)).collect())) == once
    assert contamination.contamination_spans(docs.limit(0), items).count() == 0
    assert contamination.contamination_spans(docs, items.limit(0)).count() == 0


def test_a_run_of_every_document_is_dealt_out(spark, texts, monkeypatch):
    docs, items = texts
    monkeypatch.setattr(contamination, "SALTS", 8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = contamination.contamination_spans(docs, items, 0.1, 5, broadcast_runs=0)
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "_part" in plan and "BroadcastHashJoin" not in plan
        assert {(r.doc_id, r.item_id) for r in made.collect()} == {x[:2] for x in brute(DOCS, ITEMS, 0.1)}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_documents_aside_from_found_items_stay(texts):
    docs, items = texts
    spans = contamination.contamination_spans(docs, items)
    kept = contamination.decontaminated(docs, spans)
    assert kept.columns == docs.columns
    gone = {x[0] for x in brute(DOCS, ITEMS)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in DOCS if d not in gone)


GOLDEN = ["What is the boiling point of tea?", "Who rowed down the Danube in spring?", "Never asked.", None]


@pytest.mark.parametrize("listed", [contamination.LISTED_KEYS, 0])
def test_golden_questions_in_the_training_rows_are_reported(spark, listed):
    pairs = [(str(i), f"Ordinary question number {i}", "answer") for i in range(40)]
    extra = [("h1", "what is the BOILING point, of tea", "I do not know."), ("h2", "Who rowed  down the Danube in spring", "I do not know.")]
    made = spark.createDataFrame(pairs, "id string, question string, answer string").withColumn("category", F.lit("plain"))
    honest = spark.createDataFrame(extra, "id string, question string, answer string")
    examples = split.assign(chat.add_honesty(chat.to_chat(made, "Be kind."), honest, "Be kind."), "id")
    golden = spark.createDataFrame([(q,) for q in GOLDEN[:3]], "q string").select(text.leakage_text(F.col("q")).alias("key"))
    marked = contamination.marked_keys(split.leakage_keys(examples), golden, listed=listed)
    hits = marked.where("hit").collect()
    assert sorted(r.key for r in hits) == ["what is the boiling point of tea", "who rowed down the danube in spring"]
    report = {r.split: (r.examples, r.hits, r.golden) for r in contamination.key_report(marked).collect()}
    assert sum(r[0] for r in report.values()) == 42 and sum(r[1] for r in report.values()) == 2


@pytest.mark.parametrize("listed", [contamination.LISTED_KEYS, 0])
def test_null_keys_meet_null_keys_only(spark, listed):
    keys = spark.createDataFrame([("a", "train"), (None, "train"), ("b", "val"), ("a", "val"), (None, None)], "key string, split string")
    both = spark.createDataFrame([("a",), (None,), ("a",)], "key string")
    plain_keys = both.where("key is not null")
    flags = lambda golden: sorted((str(r.key), str(r.split), r.hit) for r in contamination.marked_keys(keys, golden, listed=listed).collect())
    assert sum(x[2] for x in flags(both)) == 4
    assert sum(x[2] for x in flags(plain_keys)) == 2
    assert sum(x[2] for x in flags(both.limit(0))) == 0
    assert contamination.contaminated(keys, both, listed=listed).count() == 4
    report = {r.split: (r.examples, r.hits, r.golden) for r in contamination.key_report(contamination.marked_keys(keys, both, listed=listed)).collect()}
    assert report == {"train": (2, 2, 2), "val": (2, 1, 1), None: (1, 1, 1)}


def test_a_short_list_reaches_the_scan_of_stored_keys(spark, tmp_path):
    path = str(tmp_path / "keys")
    spark.createDataFrame([(f"k{i}", "train") for i in range(50)], "key string, split string").write.parquet(path)
    golden = spark.createDataFrame([("k3",), ("k7",), ("zz",)], "key string")
    found = contamination.contaminated(spark.read.parquet(path), golden)
    assert "In(key" in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1][:80]
    assert sorted(r.key for r in found.collect()) == ["k3", "k7"]
