import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.config import CurationRules, QualityRules
from millrace.functions import fixed, groups, text
from millrace.operators import dedup, pii, quality, report
from millrace.plans.curate import curate
from millrace.session import materialize
from millrace.sources.readers import category_of

GOOD_Q = "Which tools do you need to bind a small book at home?"
GOOD_A = "You need a needle, strong thread and an awl. A bone folder is useful, but a spoon will do for most of the folds."


def pairs(spark, rows):
    data = [(i, f"cot.{i}", q, a, "", "cot", "t") for i, (q, a) in enumerate(rows)]
    return spark.createDataFrame(
        data, "pos long, id string, question string, answer string, orig_system_prompt string, category string, source string"
    )


def reasons(spark, rows, rules=QualityRules()):
    return [r["reason"] for r in quality.gate(pairs(spark, rows), rules).orderBy("pos").collect()]


def test_gate_reasons(spark):
    rows = {
        (GOOD_Q, GOOD_A): "ok",
        (None, GOOD_A): "empty_question",
        ("\n \t", GOOD_A): "empty_question",
        (GOOD_Q, "   "): "empty_answer",
        (GOOD_Q, "\x1c\x1f"): "empty_answer",
        ("Bind how", GOOD_A): "question_length",
        (GOOD_Q, "Needle and thread."): "answer_length",
        (GOOD_Q, "I am unable to provide the list of tools that you asked for."): "refusal",
        ("Fold the sheets and then press them flat", "then press the sheets flat and fold them"): "question_echo",
        (GOOD_Q, "Wax the thread. Wax the thread. Wax the thread. Wax the thread."): "repetition",
        (GOOD_Q, "NEEDLE, THREAD, PAPER, GLUE and CLOTH for the COVER and the SPINE of it too."): "all_caps",
        (GOOD_Q, "Step # one is to fold, step # two ... is to sew ... the # pile."): "symbol_ratio",
        (GOOD_Q, "I do so as we do it: by a bit, on a go, in a fix."): "mean_word_length",
        (GOOD_Q, "Nadel, Faden und Papier liegen schon lange bereit."): "not_english",
        (GOOD_Q, "You start by folding all of the sheets and then you press"): "truncated",
        (GOOD_Q, "There is a casino bonus for you with all of our glue."): "blocklist",
    }
    assert reasons(spark, list(rows)) == list(rows.values())


def test_finished_answers(spark):
    base = "The sum of the two is what you would say if they asked you now"
    ends = [".", "!", "?", '"', "'", ")", "]", "}", ":", ";", " 7", "\n```", ".  \n", "٣", "”", ","]
    got = reasons(spark, [(GOOD_Q, base + e) for e in ends])
    assert got == ["ok"] * 14 + ["truncated"] * 2


def test_switches_and_language_column(spark):
    refusal = (GOOD_Q, "I'm unable to provide that, as it is a secret of the trade and not for all of us.")
    assert reasons(spark, [refusal]) == ["refusal"]
    assert reasons(spark, [refusal], QualityRules(reject_refusals=False)) == ["ok"]
    cut = (GOOD_Q, "You will want an awl for the holes and a ruler that is")
    assert reasons(spark, [cut]) == ["truncated"]
    assert reasons(spark, [cut], QualityRules(reject_truncated=False)) == ["ok"]
    df = pairs(spark, [(GOOD_Q, GOOD_A)] * 2).withColumn("lang", F.when(F.col("pos") == 0, "en").otherwise("fr"))
    assert [r["reason"] for r in quality.gate(df, language="lang").orderBy("pos").collect()] == ["ok", "not_english"]


def repetition_by_count(words, limit):
    if len(words) < 9:
        return False
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return max(grams.count(g) for g in set(grams)) * 3 / len(words) > limit


@pytest.mark.parametrize("limit", [0.25, 0.3, 0.5])
def test_repetition_against_counting(spark, limit):
    rng = random.Random(1)
    texts = [[rng.choice("abc") for _ in range(rng.randint(1, 40))] for _ in range(200)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(texts)], "i int, w array<string>")
    got = {r["i"]: r["r"] for r in df.select("i", quality.is_repetitive(F.col("w"), limit).alias("r")).collect()}
    assert got == {i: repetition_by_count(w, limit) for i, w in enumerate(texts)}


def test_category_of(spark):
    ids = {"flan.77": "flan", "COT.a.b": "cot", "T0": "t0", "": "unknown", None: "unknown", ".9": "", "Niv.": "niv"}
    df = spark.createDataFrame([(i, v) for i, v in enumerate(ids)], "i int, id string")
    assert [r["c"] for r in df.orderBy("i").select(category_of(F.col("id")).alias("c")).collect()] == list(ids.values())


def test_redaction(spark):
    rows = [
        ("Write to o.neill_7@post.example.ie or ring 020 555 0199.", ["EMAIL", "PHONE"], "Write to [EMAIL] or ring [PHONE]."),
        ("Her number there was 078-05-1120, paid with 4111-1111-1111-1111", ["CARD", "SSN"], "Her number there was [SSN], paid with [CARD]"),
        ("Room 12 holds 340 chairs.", [], "Room 12 holds 340 chairs."),
        (None, [], None),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "i int, t string")
    got = pii.redact(df, ["t"]).orderBy("i").collect()
    assert [(r["t_found"], r["t"]) for r in got] == [(f, t) for _, f, t in rows]
    entity = pii.redact(df, ["t"], style="entity").orderBy("i").collect()
    assert entity[1]["t"] == "Her number there was <US_SSN>, paid with <CREDIT_CARD>"
    assert pii.redact(df, ["t"], enabled=False).orderBy("i").first()["t"] == rows[0][0]


def test_normal_forms(spark):
    df = spark.createDataFrame([("Hello !", "  What's  THE\tCapital?"), ("", " \x1f ")], "a string, b string")
    r = df.select(
        text.dedup_text(F.col("a")).alias("da"), text.leakage_text(F.col("a")).alias("la"),
        text.dedup_text(F.col("b")).alias("db"), F.size(text.tokens(text.dedup_text(F.col("b")))).alias("n"),
    ).collect()
    assert (r[0]["da"], r[0]["la"], r[0]["db"]) == ("hello ", "hello", "whats the capital")
    assert r[1]["n"] == 0


def likeness(a, b):
    """Jaccard of two texts' distinct word triples; the texts here have at least three words."""
    triples = [set(zip(w, w[1:], w[2:])) for w in (a.split(), b.split())]
    return len(triples[0] & triples[1]) / len(triples[0] | triples[1])


def assert_keep_first(rows, dropped, threshold):
    """A row is dropped exactly if an earlier kept row of its block is alike: the rule itself, checked row by row."""
    kept = [r for r in rows if r[0] not in dropped]
    for pos, s in rows:
        rivals = [k for k in kept if k[0] < pos and k[1].split()[:4] == s.split()[:4]]
        assert (pos in dropped) == any(likeness(s, k[1]) >= threshold for k in rivals), pos


def near(spark, rows, threshold):
    df = spark.createDataFrame(rows, "pos long, question string").repartition(5)
    return {r["pos"] for r in dedup.near_duplicates(df, threshold).collect()}


def test_chain_is_not_transitive(spark):
    words = [f"w{i}" for i in range(40)]
    a = words
    b = words[:-4] + ["x1", "x2", "x3", "x4"]
    c = b[:-8] + ["y1", "y2", "y3", "y4"] + b[-4:]
    rows = [(0, " ".join(a)), (1, " ".join(b)), (2, " ".join(c))]
    assert likeness(rows[0][1], rows[1][1]) >= 0.7 > likeness(rows[0][1], rows[2][1])
    assert near(spark, rows, 0.7) == {1}  # the last row resembles a dropped one only


@pytest.mark.parametrize("pair_limit,split_rows,threshold", [(64, 1000, 0.5), (3, 1000, 0.5), (3, 4, 0.6), (64, 4, 0.92)])
def test_near_duplicates_keep_the_rule(spark, monkeypatch, pair_limit, split_rows, threshold):
    """Templates sharing a block, many near copies: one block and one group hold most rows."""
    monkeypatch.setattr(dedup, "PAIR_LIMIT", pair_limit)
    monkeypatch.setattr(dedup, "SPLIT_ROWS", split_rows)
    monkeypatch.setattr(dedup, "SALT_ROWS", 4)
    rng = random.Random(7)
    base = [f"v{i}" for i in range(30)]
    rows = []
    for pos in range(100):
        w = list(base) if pos % 3 else [rng.choice(base) for _ in range(30)]
        for _ in range(rng.randint(0, 6)):
            w[rng.randint(4, 29)] = f"z{rng.randint(0, 5)}"
        w[:4] = ["please", "answer", "this", "question"] if pos % 4 else ["another", "block", "of", f"b{pos % 8}"]
        rows.append((pos, " ".join(w)))
    dropped = near(spark, rows, threshold)
    assert dropped
    assert_keep_first(rows, dropped, threshold)


def test_low_limits_change_nothing(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"v{i}" for i in range(24)]
    rows = []
    for pos in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randint(4, 23)] = f"z{rng.randint(0, 4)}"
        rows.append((pos, " ".join(w)))
    usual = near(spark, rows, 0.6)
    for name, value in (("SPLIT_ROWS", 6), ("MAX_HEADS", 5), ("PAIR_LIMIT", 4)):
        monkeypatch.setattr(dedup, name, value)
    monkeypatch.setattr(groups, "LISTED_GROUPS", 2)
    monkeypatch.setattr(groups, "SMALLEST_LARGE", 1)
    assert near(spark, rows, 0.6) == usual


@pytest.mark.parametrize("listed,wide", [(0, 1_000_000), (5, 30), (2_000_000, 30)])
def test_listed_rows_and_wide_blocks_change_nothing(spark, monkeypatch, listed, wide):
    """Broadcast or shuffled positions, counts where rows meet or partial counts: the same rows are dropped."""
    rng = random.Random(13)
    base = [f"v{i}" for i in range(24)]
    rows = []
    for pos in range(120):
        w = [f"b{pos % 3 if pos % 3 else pos % 5}"] + list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randint(5, 24)] = f"z{rng.randint(0, 4)}"
        rows.append((pos, " ".join(w)))
    for name, value in (("LISTED_ROWS", listed), ("WIDE_BLOCK", wide), ("PAIR_LIMIT", 8)):
        monkeypatch.setattr(dedup, name, value)
    dropped = near(spark, rows, 0.6)
    assert dropped
    assert_keep_first(rows, dropped, 0.6)


def test_only_rows_with_a_rival_write_shingles(spark, monkeypatch):
    """Shingles are written once, of rows that share their block; those of the others and single rows of a shingle never."""
    written = []

    def counted(df, label):
        out = materialize(df, label)
        for c in {"sh", "p"} & set(df.columns):
            written.append(out.agg(F.coalesce(F.sum(F.size(c)), F.lit(0))).first()[0])
        if "t" in df.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(dedup, "materialize", counted)
    alone = [(i, " ".join(f"a{i}x{j}" for j in range(30))) for i in range(200)]
    rivals = [(1000 + i, "one two three four " + " ".join(f"r{i}x{j}" for j in range(28))) for i in range(20)]
    assert near(spark, alone + rivals, 0.7) == set()
    assert sum(written) == 20 * 30


def test_curation_of_different_openings_writes_no_shingles(spark, monkeypatch):
    written = []

    def counted(df, label):
        out = materialize(df, label)
        if "sh" in df.columns:
            written.append(out.count())
        return out

    monkeypatch.setattr(dedup, "materialize", counted)
    questions = [f"Topic number{i} of today: {GOOD_Q}" for i in range(6)]
    done = curate(pairs(spark, [(q, GOOD_A) for q in questions]))
    assert {(r["pos"], r["reason"]) for r in done.judged.collect()} == {(i, "ok") for i in range(6)}
    assert sum(written) == 0


def test_shingle_rows_shuffle_once(spark):
    """Of rows and counts of one shingle table, one shuffle serves both."""
    rows = [(i, "one two three four " + " ".join(f"r{i % 7}x{j}" for j in range(20)) + f" e{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "pos long, question string")
    sets = dedup.shingle_table(df, "pos", "question").withColumn("size", F.size("sh"))
    sets = materialize(sets, "test-sets")
    shared = dedup._shared_shingles(sets)
    got = {(r["pos"], r["t"]): r["n"] for r in shared.collect()}
    held = [(r["pos"], r["block"], t) for r in sets.collect() for t in r["sh"]]
    n = Counter((b, t) for _, b, t in held)
    assert got == {(p, t): n[b, t] for p, b, t in held if n[b, t] > 1}
    assert "ReusedExchange" in shared._jdf.queryExecution().executedPlan().toString()


def test_template_rows_need_no_rounds(spark, monkeypatch):
    """Rows with one long template and rests of their own: as many written tables for 400 rows as for 3,000."""
    template = " ".join(f"t{i}" for i in range(60))
    written = []

    def counted(df, label):
        written.append(label)
        return materialize(df, label)

    monkeypatch.setattr(dedup, "materialize", counted)
    sizes = []
    for n in (400, 3000):
        rows = [(i, template + " " + " ".join(f"r{i}x{j}" for j in range(20 + i % 5))) for i in range(n)]
        written.clear()
        assert near(spark, rows, 0.7) == set()
        sizes.append(len(written))
    assert sizes[0] == sizes[1] and written.count("near-heads") == 0


def test_no_text_is_shuffled(spark):
    df = pairs(spark, [(GOOD_Q, GOOD_A), (GOOD_Q + " Now", GOOD_A)])
    plan = curate(df).judged._jdf.queryExecution().executedPlan().toString()
    assert "question" not in plan and "answer" not in plan


def test_exact_duplicates_keep_the_first(spark):
    rows = [(3, "What is it?"), (1, "what IS it"), (2, "What is it"), (4, "Something else")]
    df = spark.createDataFrame(rows, "pos long, question string").repartition(4)
    got = {r["pos"]: r["exact_dup"] for r in dedup.flag_exact_duplicates(df).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False}
    assert {r["pos"] for r in dedup.exact_duplicates(df).collect()} == {2, 3}
    assert {(r["pos"], r["dropped"]) for r in dedup.drops(df, 0.7).collect()} == {(2, "exact_dup"), (3, "exact_dup")}


def test_job_accounts_for_every_row(spark):
    rows = [(GOOD_Q, GOOD_A), (GOOD_Q.upper(), GOOD_A), ("Bind how", GOOD_A), (GOOD_Q + " Mail me at a@b.com", GOOD_A)]
    done = curate(pairs(spark, rows), rules=CurationRules(near_dup_threshold=0.99))
    got = {r["pos"]: r["reason"] for r in done.judged.collect()}
    assert got == {0: "ok", 1: "exact_dup", 2: "question_length", 3: "ok"}
    total = report.summary(done.counts).first()
    assert (total["input_records"], total["kept"], total["survival_rate"]) == (4, 2, 0.5)
    kept = {r["pos"]: r["question"] for r in done.kept.collect()}
    assert kept[3].endswith("[EMAIL]")
    doc = report.report_document(done.counts, done.entities, "sample").first()
    assert doc["drops"] == {"exact_dup": 1, "question_length": 1}
    assert doc["drops_by_category"] == {"cot": {"exact_dup": 1, "question_length": 1}}
    assert doc["records_with_pii_scrubbed"] == 1 and doc["pii_entities_found"] == {"EMAIL": 1}


def test_published_arithmetic(spark):
    counts = spark.createDataFrame([("a", "ok", 3499), ("a", "refusal", 1501)], "category string, reason string, n long")
    assert report.summary(counts).first()["survival_rate"] == 0.7


def test_echo_is_decided_from_the_first_words_or_all(spark):
    """The early decision equals the ratio on short, long and repeating answers, echoes late in the answer among them."""
    rnd = random.Random(5)
    pool = ["Fold,", "the", "sheets", "press", "flat!", "...", "(Then", "Été", "II", "x"]
    rows = []
    for i in range(400):
        q = [rnd.choice(pool) for _ in range(rnd.randint(1, 9))]
        other = [f"w{rnd.randint(0, 60)}" for _ in range(rnd.choice((0, 1, 2, 80)))]
        a = [rnd.choice(q) for _ in range(rnd.choice((1, 5, 300)))]
        rows.append((i, q, [a + other, other + a, other or a][i % 3]))
    df = spark.createDataFrame(rows, "i int, q array<string>, a array<string>")
    for most in (0.0, 0.3, 0.9):
        got = df.select(quality.is_echo(F.col("q"), F.col("a"), most).alias("x"), (quality.echo_ratio(F.col("q"), F.col("a")) > most).alias("y"))
        assert got.where("x is distinct from y").count() == 0 and got.where("x").count() > 0 < got.where("not x").count()


def test_phones_are_found_by_their_core(spark):
    texts = ["call +91 (987) 654-4321 now", "0123-4567", "no 123 456", "(555) 123-4567.", "12345678", "a1234567", "x 123 4567y", None, "١٢٣٤٥٦٧"]
    df = pii.redact(spark.createDataFrame([(t,) for t in texts], "t string"), ["t"])
    plain = spark.createDataFrame([(t,) for t in texts], "t string")
    for _, pattern in fixed.PII_PATTERNS[:3]:
        assert plain.where(F.regexp_like("t", F.lit("(?U)" + pattern))).count() == 0
    want = plain.select(F.regexp_replace("t", "(?U)" + dict(fixed.PII_PATTERNS)["PHONE"], "[PHONE]").alias("t"))
    assert [r["t"] for r in df.select("t").collect()] == [r["t"] for r in want.collect()]
    assert df.where(F.array_contains("t_found", "PHONE")).count() == 6
    assert df.where("t_found is null").count() == 0


def test_stopwords_are_counted_until_there_are_enough(spark):
    rnd = random.Random(7)
    rows = [([rnd.choice(["the", "And,", "zug", "x"]) if rnd.random() < p else "haus" for _ in range(n)],) for n in (0, 1, 63, 64, 65, 300) for p in (0, 0.01, 0.05, 0.5) for _ in range(5)]
    df = spark.createDataFrame([*rows, (["haus"] * 64 + ["the"] * 3,)], "a array<string>")
    got = df.select(quality.has_few_stopwords(F.col("a"), 3).alias("x"), (quality.stopword_hits(F.col("a")) < 3).alias("y"))
    assert got.where("x is distinct from y").count() == 0 and got.where("x").count() > 0 < got.where("not x").count()
