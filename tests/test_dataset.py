import json

import pytest
from pyspark.sql import functions as F

from millrace.config import IngestRules, SplitRules
from millrace.operators import chat, runs, split, validate
from millrace.plans.build_split import build_split
from millrace.sources import readers, sinks


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_local_pairs(spark, tmp_path):
    write(
        tmp_path / "b.jsonl",
        [json.dumps({"id": "t0.1", "question": "q1", "response": None, "answer": "unused"}), "", json.dumps({"question": "q2", "answer": "a2", "category": "own"})],
    )
    write(tmp_path / "a.jsonl", [json.dumps({"id": "COT.9", "question": "q0", "response": "ä", "category": "", "system_prompt": "s"})])
    got = readers.read_local_pairs(spark, str(tmp_path / "*.jsonl")).orderBy("pos").collect()
    assert [(r["pos"], r["id"], r["question"], r["answer"], r["category"], r["source"]) for r in got] == [
        (0, "COT.9", "q0", "ä", "cot", "a.jsonl"),
        (1, "t0.1", "q1", None, "t0", "b.jsonl"),
        (3, "", "q2", "a2", "own", "b.jsonl"),
    ]


def test_malformed_json_is_fatal(spark, tmp_path):
    write(tmp_path / "a.jsonl", ['{"question": "q"', '{"question": "r"}'])
    with pytest.raises(Exception, match="(?i)malformed|json"):
        readers.read_local_pairs(spark, str(tmp_path)).collect()


def test_line_numbers_across_file_splits(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    write(tmp_path / "a.txt", lines)
    write(tmp_path / "b.txt", lines[:10])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.numbered_lines(spark, str(tmp_path / "*.txt")).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["line"] for r in got] == lines + lines[:10]
    assert [r["pos"] for r in got] == list(range(3010))
    assert [r["line_no"] for r in got] == list(range(1, 3001)) + list(range(1, 11))


def test_lines_are_counted_and_read_by_one_scan(spark, tmp_path):
    lines = [f"line {i}" for i in range(3000)]
    write(tmp_path / "my file+1.txt", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        got = readers.numbered_lines(spark, str(tmp_path))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
        assert [(r["line_no"], r["line"]) for r in got.orderBy("pos").collect()] == list(enumerate(lines, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_source_is_the_file_name(spark, tmp_path):
    write(tmp_path / "my file+1.jsonl", ['{"id": "a.1", "question": "q", "answer": "a"}'])
    assert readers.read_local_pairs(spark, str(tmp_path)).first()["source"] == "my file+1.jsonl"


def test_cap_without_ids(spark):
    rows = spark.range(500).select(
        F.lit(None).cast("string").alias("id"), F.concat(F.lit("q"), (F.col("id") % 50).cast("string")).alias("question"),
        F.lit("r").alias("response"), F.lit("s").alias("system_prompt"),
    )
    for most in (1, 10, 137, 499, 500, 900):
        assert readers.read_corpus(rows, "c", IngestRules(max_docs=most, keep_categories=())).count() == min(most, 500)


def test_split_without_ids(spark):
    done = build_split(chat_pairs(spark, 200).withColumn("id", F.lit("")), "s")
    got = {r["split"]: r["count"] for r in done.examples.groupBy("split").count().collect()}
    assert got == {"train": 170, "val": 20, "test": 10}


def test_corpus_cap_is_exact_and_stable(spark):
    rows = spark.range(5000).select(
        F.concat(F.when(F.col("id") % 5 == 0, "zz").otherwise("flan"), F.lit("."), F.col("id").cast("string")).alias("id"),
        F.lit("q").alias("question"), F.lit(None).cast("string").alias("response"), F.lit("s").alias("system_prompt"),
    )
    rules = IngestRules(max_docs=700)
    a = {r["id"] for r in readers.read_corpus(rows.repartition(3), "c", rules).collect()}
    b = {r["id"] for r in readers.read_corpus(rows.repartition(9), "c", rules).collect()}
    assert len(a) == 700 and a == b and all(i.startswith("flan") for i in a)
    assert readers.read_corpus(rows, "c", IngestRules(max_docs=10**6)).count() == 4000
    assert readers.read_corpus(rows, "c", IngestRules(max_docs=5, keep_categories=())).first()["answer"] == ""


def test_ingest_guards(spark, tmp_path):
    write(tmp_path / "a.jsonl", [""])
    with pytest.raises(readers.NothingIngested):
        readers.ingest(spark, "sample", str(tmp_path / "a.jsonl"))
    with pytest.raises(ValueError, match="unknown source mode"):
        readers.ingest(spark, "other", "x")
    pairs = readers.ingest(spark, "corpus", spark.createDataFrame([("cot.1", "q", "r", "s")], "id string, question string, response string, system_prompt string"))
    assert pairs.count() == 1 and "pos" in pairs.columns


def test_missing_knowledge_base_is_empty(spark, tmp_path):
    assert readers.read_kb(spark, str(tmp_path / "none.jsonl")).count() == 0
    write(tmp_path / "kb.jsonl", ['{"id": "k1", "text": "t"}', '{"text": "u"}'])
    assert sorted((r["id"], r["text"]) for r in readers.read_kb(spark, str(tmp_path / "kb.jsonl")).collect()) == [("", "u"), ("k1", "t")]


@pytest.mark.parametrize(
    "val,test,want",
    [
        (0.10, 0.05, {1: (1, 0, 0), 2: (1, 1, 0), 3: (1, 1, 1), 10: (8, 1, 1), 25: (22, 2, 1), 30: (25, 3, 2), 50: (43, 5, 2), 70: (59, 7, 4)}),
        (0.5, 0.5, {1: (1, 0, 0), 2: (1, 1, 0), 3: (1, 1, 1), 4: (1, 1, 2), 5: (1, 2, 2), 6: (1, 2, 3), 7: (1, 2, 4)}),
        (0.9, 0.4, {3: (1, 1, 1), 4: (1, 1, 2), 5: (1, 2, 2), 10: (1, 5, 4)}),
    ],
)
def test_split_sizes(spark, val, test, want):
    """Sizes worked out by hand, and what holds for every count."""
    counts = spark.range(1, 300).select(F.col("id").cast("string").alias("category"), F.col("id").alias("n"))
    got = {r["n"]: (r["n_train"], r["n_val"], r["n_test"]) for r in split.with_sizes(counts, SplitRules(val=val, test=test)).collect()}
    assert {n: got[n] for n in want} == want
    for n, (a, b, c) in got.items():
        assert a + b + c == n and a >= 1 and (n < 3 or min(b, c) >= 1)
        if n > 2 and a > 1:  # nothing had to give way
            assert abs(b - n * val) <= max(0.5, 1 - n * val) and abs(c - n * test) <= max(0.5, 1 - n * test)


def test_published_split_sizes(spark):
    data = [("cot", 297), ("flan", 2025), ("honesty", 4), ("niv", 255), ("t0", 922)]
    got = {r["category"]: r for r in split.with_sizes(spark.createDataFrame(data, "category string, n long")).collect()}
    assert [got[c]["n_val"] for c, _ in data] == [30, 202, 1, 26, 92]
    assert [got[c]["n_test"] for c, _ in data] == [15, 101, 1, 13, 46]
    assert sum(r["n_train"] for r in got.values()) == 2976


def test_split_membership(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") < 900, "big").when(F.col("id") < 999, "mid").otherwise("one").alias("category"))
    a = {r["id"]: r["split"] for r in split.assign(df.repartition(7), "id").collect()}
    b = {r["id"]: r["split"] for r in split.assign(df.repartition(2), "id").collect()}
    assert a == b and len(a) == 1000
    big = [s for i, s in a.items() if i < 900]
    assert (big.count("train"), big.count("val"), big.count("test")) == (765, 90, 45)
    assert a[999] == "train"
    loose = spark.createDataFrame([(1, None), (2, "c")], "id long, category string")
    assert {r["id"]: r["split"] for r in split.assign(loose, "id").collect()} == {1: "train", 2: "train"}


def test_leaks_count_extra_splits(spark):
    rows = [("a", "train"), ("a", "val"), ("a", "test"), ("b", "train"), ("b", "train"), ("c", "val"), ("c", "test")]
    assert split.leak_total(spark.createDataFrame(rows, "key string, split string")).first()["leaks"] == 3


def chat_pairs(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), F.concat(F.lit("question number "), F.col("id").cast("string")).alias("question"),
        F.lit("The answer.").alias("answer"), F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("category"),
    )


def test_dataset_job(spark, tmp_path):
    honesty = spark.createDataFrame([(f"h{i}", f"unknowable {i}", "I don't know.") for i in range(4)], "id string, question string, answer string")
    done = build_split(chat_pairs(spark, 60), " be kind ", honesty)
    assert {(r["level"], r["name"]): r["n"] for r in done.stats.collect()}[("category", "honesty")] == 4
    out = str(tmp_path / "splits")
    sinks.write_splits(done.examples, out)
    back = readers.read_chat(spark, out + "/split=val")
    assert back.count() == 7 and back.first()["messages"][0]["content"] == "be kind"
    with pytest.raises(split.SplitLeak):
        build_split(chat_pairs(spark, 60).withColumn("question", F.lit("same")), "s")
    with pytest.raises(split.EmptySplit):
        build_split(chat_pairs(spark, 1), "s")


def test_validation_of_lines(spark):
    def line(roles, contents, category="c"):
        return json.dumps({"messages": [{"role": r, "content": c} for r, c in zip(roles, contents)], "category": category})

    good = ("system", "user", "assistant")
    cases = [
        (line(good, "abc"), 0), ("", None), (line(good, ["a", 5, "c"]), 1), ("{not json", 1), ("[1]", 1), (line(good[:2], "ab"), 1),
        (line(("user", "user", "user"), "abc"), 2), (line(("system", "tool", "assistant"), "abc"), 1), (line(good, ["a", "", "c"]), 1),
        (line(good, ["a", "b", "  "]), 1), (line(good, "abc", ""), 1), (json.dumps({"messages": None, "category": "c"}), 1),
        (json.dumps({"category": "c"}), 1), (json.dumps({"messages": [{"role": "user"}] * 3, "category": 1}), 2),
    ]
    df = spark.createDataFrame([(i + 1, s) for i, (s, _) in enumerate(cases)], "line_no long, line string")
    got = {r["line_no"]: r["errors"] for r in validate.check_lines(df).collect()}
    assert {k: len(v) for k, v in got.items()} == {i + 1: n for i, (_, n) in enumerate(cases) if n is not None}
    with pytest.raises(validate.DatasetInvalid, match="line 3"):
        validate.require_valid(validate.check_lines(df))


def test_rendering_and_runs(spark):
    ex = chat.to_chat(chat_pairs(spark, 1), "sys")
    assert chat.render(ex, {"system": "S:", "user": "U:", "assistant": "A:"}, "\n").first()["text"] == "S:sys\nU:question number 0\nA:The answer.\n"
    logged = spark.createDataFrame(
        [("a", 0.5), ("b", float("nan")), ("c", 0.2), ("d", None)], "`tags.mlflow.runName` string, `metrics.eval_loss` double"
    )
    view = runs.board(logged)
    rows = view.collect()
    assert view.columns == ["run", "eval_loss"] and [r["run"] for r in rows[:2]] == ["c", "a"] and rows[3]["eval_loss"] is None
    assert runs.best(view).first()["run"] == "c"
    assert runs.board(logged, drop_missing=True).count() == 2


def test_runs_table(spark, tmp_path):
    run = spark.createDataFrame([("r1", 0.3)], "run string, eval_loss double")
    for _ in range(2):
        sinks.append_run(run, {"seed": 42, "git_sha": "abc"}, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).where("git_sha = 'abc'").count() == 2
