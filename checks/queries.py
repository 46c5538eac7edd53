"""One query per operator over the benchmark tables; each takes (spark, sf_dir)."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.config import AlertRules, CurationRules, IngestRules, ServingLimits
from millrace.functions import text
from millrace.functions.hashing import seeded_order
from millrace.operators import (
    chat, contamination, dedup, drift, evaluation, guardrails, metrics, pii, quality, quantiles, report, requests, retrieval, runs,
    split, traffic, validate, vector_index,
)
from millrace.plans import curate as curate_plan
from millrace.plans import observe as observe_plan
from millrace.plans import prompt, traffic_report
from millrace.session import materialize, scratch_path
from millrace.sources import readers, sinks
from millrace.sources.tables import (
    conversation_pairs, document_answers, document_prompts, request_log, table, turn_key,
)
from millrace.streaming import alerts as alert_streams
from millrace.streaming import runner, sample, state, timers, windows
from millrace.streaming import sinks as stream_sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NEAR_THRESHOLD = 0.7
SYSTEM_PROMPT = "You are a helpful and precise assistant."
MARKERS = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}
ONE_PER_MINUTE = ServingLimits(quota_per_minute=1)
CANARY_PERCENT = 10
ALERTS = AlertRules(error_share=0.25, error_hold_min=2, p95_s=1.5, p95_hold_min=2, canary_share=0.25, canary_hold_min=2)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query; it runs in UTC, the zone the tables' times are in."""

    @functools.wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf)

    QUERIES[fn.__name__] = run
    return run


def epoch(ts: Column) -> Column:
    return F.unix_seconds(ts)


# ---------------------------------------------------------------- sources


@query
def corpus_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a corpus, three languages kept, capped by seeded hash order."""
    rows = table(spark, sf, "documents").select(
        F.concat("lang", F.lit("."), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("question"), F.col("text").alias("response"), F.lit(None).cast("string").alias("system_prompt"),
    )
    pairs = readers.read_corpus(rows, "documents", IngestRules(max_docs=300, keep_categories=("en", "fr", "de")))
    return pairs.select("id", "question", F.md5("answer").alias("answer_md5"), "orig_system_prompt", "category", "source")


@query
def stream_corpus_sample(spark: SparkSession, sf: str) -> DataFrame:
    """S2, S4 on a stream: documents arrive in eight files over four batches; the capped sample is that of all rows."""
    rows = table(spark, sf, "documents").select(
        F.concat("lang", F.lit("."), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("question"), F.col("text").alias("response"), F.lit(None).cast("string").alias("system_prompt"),
    )
    path, root = scratch_path(spark, "corpus-files"), scratch_path(spark, "corpus-sample")
    rows.repartition(8, F.xxhash64("id")).write.parquet(path)
    rules = IngestRules(max_docs=300, keep_categories=("en", "fr", "de"))
    stream = runner.stream_files(spark, path, rows.schema, files_per_batch=2)
    done = sample.corpus_stream(stream, root, scratch_path(spark, "corpus-progress"), "documents", rules)
    pairs = sample.latest_sample(spark, root, done)
    return pairs.select("id", "question", F.md5("answer").alias("answer_md5"), "orig_system_prompt", "category", "source")


@query
def ingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per category, the category taken from the id."""
    rows = table(spark, sf, "documents").select(
        readers.category_of(F.concat(F.upper("lang"), F.lit(".x."), F.col("doc_id").cast("string"))).alias("category")
    )
    return readers.category_counts(rows)


@query
def local_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as JSON lines and ingested again; the place of each line in its file is kept."""
    path = scratch_path(spark, "pairs-jsonl")
    rows = table(spark, sf, "documents").select(
        F.concat("lang", F.lit("."), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("question"), F.col("source").alias("response")
    )
    rows.select(F.to_json(F.struct("id", "question", "response")).alias("value")).write.text(path)
    pairs = readers.ingest(spark, "local_kb", path)
    return pairs.select("id", F.md5("question").alias("question_md5"), "answer", "orig_system_prompt", "category")


@query
def golden_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The golden set written as JSON lines in the order of its cases and read with their line numbers."""
    path = scratch_path(spark, "golden-jsonl")
    lines = _golden(spark, sf).orderBy("case_id").select(F.to_json(F.struct("question", "must_contain", "must_not_contain", "category")).alias("value"))
    lines.write.text(path)  # sorted ranges, which are read in path order
    read = readers.read_golden(spark, path)
    return read.select(
        "case_id", "question", F.array_join("must_contain", "|").alias("must"), F.array_join("must_not_contain", "|").alias("banned"), "category"
    )


@query
def kb_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as knowledge-base chunks, some without an id, and read."""
    path = scratch_path(spark, "kb-jsonl")
    named = F.when(F.col("doc_id") % 10 > 0, F.concat(F.lit("kb-"), F.col("doc_id").cast("string")))
    table(spark, sf, "documents").select(named.alias("id"), "text").write.json(path)
    return readers.read_kb(spark, path).groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.md5("text")).alias("last_md5"))


@query
def chat_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The split dataset written as chat JSON lines and read back, split by split."""
    path = scratch_path(spark, "splits")
    sinks.write_splits(split.assign(_chat_examples(spark, sf), "id"), path)
    parts = [readers.read_chat(spark, f"{path}/split={s}").withColumn("split", F.lit(s)) for s in split.SPLITS]
    whole = functools.reduce(DataFrame.unionByName, parts)
    return whole.select("split", "category", F.md5(F.to_json("messages")).alias("messages_md5"))


@query
def report_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The curation report of the gate written as one JSON document and read back."""
    counts = report.reason_counts(quality.gate(document_answers(spark, sf)))
    entities = pii.entity_totals(pii.redact(document_prompts(spark, sf), ["question"]), ["question"])
    path = scratch_path(spark, "report")
    sinks.write_report(report.report_document(counts, entities, "documents"), path)
    kinds = "source_mode string, input_records long, kept long, survival_rate double, drops map<string,long>, records_with_pii_scrubbed long"
    read = spark.read.schema(kinds).json(path)
    return read.select(
        "source_mode", "input_records", "kept", "survival_rate", F.size("drops").cast("long").alias("reasons"), "records_with_pii_scrubbed"
    )


# ---------------------------------------------------------------- curation


@query
def quality_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """Q0-Q13: first failing reason of every document as an answer."""
    return quality.gate(document_answers(spark, sf)).select(F.col("pos").alias("doc_id"), "reason")


@query
def quality_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gate(conversation_pairs(spark, sf)).select("pos", "category", "reason")


@query
def quality_accepted(spark: SparkSession, sf: str) -> DataFrame:
    """Q13: the rows that go on."""
    kept = quality.accepted(quality.gate(document_answers(spark, sf)))
    return kept.select(F.col("pos").alias("doc_id"), "category", F.md5("answer").alias("answer_md5"))


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """R1-R3 over the gate: totals per level."""
    return report.breakdown(report.reason_counts(quality.gate(document_answers(spark, sf))))


@query
def survival(spark: SparkSession, sf: str) -> DataFrame:
    """Input, kept, survival rate."""
    return report.summary(report.reason_counts(quality.gate(document_answers(spark, sf))))


@query
def kept_categories(spark: SparkSession, sf: str) -> DataFrame:
    return report.kept_per_category(report.reason_counts(quality.gate(document_answers(spark, sf))))


@query
def pii_redacted(spark: SparkSession, sf: str) -> DataFrame:
    """Redacted text and matched labels."""
    red = pii.redact(document_prompts(spark, sf), ["question"])
    return red.select(
        F.col("pos").alias("doc_id"), F.md5("question").alias("text_md5"), F.array_join("question_found", ",").alias("labels")
    )


@query
def pii_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The same with entity-style placeholders."""
    red = pii.redact(document_prompts(spark, sf), ["question"], style="entity")
    return red.select(
        F.col("pos").alias("doc_id"), F.md5("question").alias("text_md5"), F.array_join("question_found", ",").alias("labels")
    )


@query
def pii_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a hit and hits per label and field."""
    fields = ["question", "answer"]
    both = document_answers(spark, sf).withColumn("question", F.concat("question", F.lit(" "), F.col("answer")))
    return pii.entity_totals(pii.redact(both, fields), fields)


@query
def exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Which documents repeat an earlier one."""
    return dedup.flag_exact_duplicates(document_prompts(spark, sf)).select(F.col("pos").alias("doc_id"), "exact_dup")


@query
def shingle_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Blocking key and number of distinct shingles."""
    toks = text.tokens(text.dedup_text(F.col("question")))
    return (
        document_prompts(spark, sf).select("pos", toks.alias("t"))
        .select(
            F.col("pos").alias("doc_id"), text.block_key(F.col("t")).alias("block"),
            F.size(text.shingle_hashes(F.col("t"))).cast("long").alias("n_shingles"),
        )
    )


@query
def shingle_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Jaccard of each document with the next one."""
    sets = dedup.shingle_table(document_prompts(spark, sf), "pos", "question")
    nxt = sets.select((F.col("pos") - 1).alias("pos"), F.col("sh").alias("sh2"))
    return sets.join(nxt, "pos").select(
        F.col("pos").alias("doc_id"), F.bround(text.jaccard(F.col("sh"), F.col("sh2")), 6).alias("jaccard")
    )


@query
def near_dedup_kept(spark: SparkSession, sf: str) -> DataFrame:
    """D6 after D2: greedy keep-first near-duplicate flags."""
    docs = document_prompts(spark, sf)
    dropped = materialize(dedup.drops(docs, NEAR_THRESHOLD), "dropped")
    flagged = docs.select("pos").join(dropped, "pos", "left").where("dropped is distinct from 'exact_dup'")
    return flagged.select(F.col("pos").alias("doc_id"), F.col("dropped").isNotNull().alias("near_dup"))


@query
def curation_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """The whole curation job: final reason of every document as a prompt."""
    done = curate_plan.curate(document_prompts(spark, sf), rules=CurationRules(near_dup_threshold=NEAR_THRESHOLD))
    return done.judged.select(F.col("pos").alias("doc_id"), "category", "reason")


@query
def curation_report(spark: SparkSession, sf: str) -> DataFrame:
    """R1-R5 over the whole job on conversation pairs."""
    done = curate_plan.curate(conversation_pairs(spark, sf), rules=CurationRules(near_dup_threshold=NEAR_THRESHOLD))
    scrubbed = done.entities.select(
        F.lit("pii").alias("level"), F.lit(None).cast("string").alias("category"), F.col("entity").alias("reason"), "n"
    )
    return report.breakdown(done.counts).unionByName(scrubbed)


@query
def review_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty accepted documents for a person to read."""
    kept = quality.accepted(quality.gate(document_answers(spark, sf)))
    return report.review_sample(kept).select(F.col("pos").alias("doc_id"), "category")


# ---------------------------------------------------------------- dataset


def _chat_examples(spark: SparkSession, sf: str) -> DataFrame:
    return chat.to_chat(conversation_pairs(spark, sf), SYSTEM_PROMPT)


@query
def chat_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Chat examples with the benchmark items as extra honesty rows, rendered."""
    extra = table(spark, sf, "benchmark").select(
        F.concat(F.lit("honesty."), F.col("item_id").cast("string")).alias("id"), F.col("text").alias("question"),
        F.lit("I do not know.").alias("answer"),
    )
    examples = chat.add_honesty(_chat_examples(spark, sf), extra, SYSTEM_PROMPT)
    return chat.render(examples, MARKERS, "<|end|>").select("id", "category", "text")


@query
def validation_errors(spark: SparkSession, sf: str) -> DataFrame:
    """V1-V2: rules on every three consecutive turns taken as one example."""
    turns = table(spark, sf, "conversations")

    def shifted(by: int) -> DataFrame:
        return turns.select("conv_id", (F.col("turn") - by).alias("turn"), F.struct("role", F.col("text").alias("content")).alias(f"m{by}"))

    triples = shifted(0).join(shifted(1), ["conv_id", "turn"]).join(shifted(2), ["conv_id", "turn"]).select(
        turn_key().alias("line_no"), F.array("m0", "m1", "m2").alias("messages"),
        F.when(F.col("turn") < 3, F.lit("early")).otherwise(F.lit("")).alias("category"),
    )
    return validate.explode_errors(validate.example_errors(triples)).select(
        "line_no", F.col("error_no").cast("long").alias("error_no"), "error"
    )


@query
def validation_lines(spark: SparkSession, sf: str) -> DataFrame:
    """V1 on raw lines: documents as JSON lines, some broken by what the document is."""
    docs = table(spark, sf, "documents")
    quoted = F.to_json(F.struct(F.col("text").alias("v")))  # {"v":"..."}
    content = F.when(F.col("lang") == "es", F.lit("5")).otherwise(F.substr(quoted, F.lit(6), F.length(quoted) - 6))
    line = F.concat(
        F.lit('{"messages":[{"role":"system","content":"s"},{"role":"'),
        F.when(F.col("lang") == "de", F.lit("tool")).otherwise(F.lit("user")),
        F.lit('","content":'), content, F.lit('},{"role":"assistant","content":"ok"}],"category":"'),
        F.when(F.col("n_chars") > 2000, F.lit("")).otherwise(F.col("lang")),
        F.when(F.col("n_chars") < 100, F.lit('"')).otherwise(F.lit('"}')),
    )
    checked = validate.check_lines(docs.select(F.col("doc_id").alias("line_no"), line.alias("line")))
    return checked.select("line_no", F.array_join("errors", "; ").alias("errors"))


@query
def validation_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """V3: examples and errors in total."""
    return validate.verdict(validate.example_errors(_chat_examples(spark, sf)))


def _split_documents(spark: SparkSession, sf: str) -> DataFrame:
    return split.assign(document_prompts(spark, sf), "pos")


@query
def split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """L1: sizes per language."""
    return split.sizes(document_prompts(spark, sf)).select("category", "n", "n_train", "n_val", "n_test")


@query
def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L1: the split of every document."""
    return _split_documents(spark, sf).select(F.col("pos").alias("doc_id"), "category", "split")


@query
def leakage(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised documents in more than one split."""
    keys = _split_documents(spark, sf).select(text.leakage_text(F.col("question")).alias("key"), "split")
    return split.leaks(keys).select(F.md5("key").alias("key_md5"), F.col("leaks").cast("long").alias("leaks"))


def _benchmark_spans(spark: SparkSession, sf: str) -> DataFrame:
    return contamination.contamination_spans(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def contamination_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark items of which four fifths of the five-word runs stand in a document."""
    return _benchmark_spans(spark, sf).withColumn("share", F.bround("share", 9))


@query
def contamination_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Documents per language, and how many hold no benchmark item."""
    docs = table(spark, sf, "documents")
    kept = contamination.decontaminated(docs, _benchmark_spans(spark, sf)).groupBy("lang").agg(F.count(F.lit(1)).alias("clean"))
    every = docs.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("n"))
    joined = every.join(kept, F.col("_lang").eqNullSafe(F.col("lang")), "left")
    return joined.select(F.col("_lang").alias("lang"), "n", F.coalesce("clean", F.lit(0)).cast("long").alias("clean"))


@query
def contamination_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark questions among the training examples, which took them in as honesty rows, split by split."""
    items = table(spark, sf, "benchmark")
    extra = items.select(
        F.concat(F.lit("honesty."), F.col("item_id").cast("string")).alias("id"), F.col("text").alias("question"),
        F.lit("I do not know.").alias("answer"),
    )
    examples = split.assign(chat.add_honesty(_chat_examples(spark, sf), extra, SYSTEM_PROMPT), "id")
    golden = items.select(text.leakage_text(F.col("text")).alias("key"))
    return contamination.key_report(contamination.marked_keys(split.leakage_keys(examples), golden))


@query
def dataset_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and mean length per split and category."""
    return split.stats(_split_documents(spark, sf), F.length("question"))


@query
def split_presence(spark: SparkSession, sf: str) -> DataFrame:
    """L3: the three splits and their sizes for chat examples."""
    return split.assign(_chat_examples(spark, sf), "id").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query
def split_no_ids(spark: SparkSession, sf: str) -> DataFrame:
    """L1 with all ids blank: the sizes stay exact."""
    blank = document_prompts(spark, sf).withColumn("id", F.lit(""))
    return split.assign(blank, "id", tie="pos").groupBy("category", "split").agg(F.count(F.lit(1)).alias("n"))


@query
def corpus_cap_no_ids(spark: SparkSession, sf: str) -> DataFrame:
    """S4 with all ids blank, every document twice: the cap stays exact."""
    rows = table(spark, sf, "documents").select(
        F.lit(None).cast("string").alias("id"), F.col("text").alias("question"), F.lit("r").alias("response"),
        F.lit(None).cast("string").alias("system_prompt"),
    )
    capped = readers.read_corpus(rows.unionByName(rows), "documents", IngestRules(max_docs=150, keep_categories=()))
    return capped.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query
def seeded_shuffle(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every example in the seeded order, as its hash."""
    ordered = chat.shuffled(_chat_examples(spark, sf), 42)
    return ordered.select("id", seeded_order(42, F.col("id")).alias("order_key"))


@query
def run_board(spark: SparkSession, sf: str) -> DataFrame:
    """One run per source, loss from its labels."""
    labelled = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")
    losses = labelled.groupBy("source").agg(F.avg(1.0 - F.col("quality")).alias("loss"), F.count(F.lit(1)).alias("n"))
    logged = losses.select(
        F.col("source").alias("tags.mlflow.runName"), F.col("n").alias("params.lora_r"),
        F.when(F.col("n") < 15, F.lit(float("nan"))).otherwise(F.bround("loss", 6)).alias("metrics.eval_loss"),
        F.lit("x").alias("other"),
    )
    return runs.with_lineage(runs.board(logged), {"seed": 42, "data_version": "v1"})


@query
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    """The run with the lowest loss."""
    per = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "source", "n_chars"), "doc_id")
    losses = per.groupBy("source").agg(F.sum(F.col("n_chars") * (F.col("toxic") + 1)).alias("s"), F.count(F.lit(1)).alias("n"))
    logged = losses.select(F.col("source").alias("run"), F.bround(F.col("s") / F.col("n"), 6).alias("eval_loss"))
    return runs.best(logged)


@query
def generations_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """T4: four documents as the responses of four runs to one prompt, side by side."""
    generations = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 4).alias("prompt"), F.concat(F.lit("r"), (F.col("doc_id") % 4).cast("string")).alias("run"),
        F.md5("text").alias("response"),
    )
    return runs.side_by_side(generations, ["r0", "r1", "r2", "r3"])


# ---------------------------------------------------------------- evaluation


def _golden(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "benchmark")
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return items.select(
        F.col("item_id").alias("case_id"), F.col("text").alias("question"),
        F.transform(F.slice(w, 1, 2), lambda x: F.concat(x, F.lit("[ ,.]"))).alias("must_contain"),
        F.array(F.concat(F.element_at(w, -1), F.lit("[.]"))).alias("must_not_contain"),
        F.when(F.col("item_id") % 5 > 0, F.concat(F.lit("c"), (F.col("item_id") % 5).cast("string"))).alias("category"),
    )


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "benchmark").count()
    return table(spark, sf, "documents").select(
        F.col("source").alias("model"), (F.col("doc_id") % n).alias("case_id"), F.col("text").alias("answer")
    )


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.judge(_answers(spark, sf), _golden(spark, sf))


@query
def golden_cases(spark: SparkSession, sf: str) -> DataFrame:
    """Every document judged as an answer to a benchmark item."""
    return _judged(spark, sf).select(
        "model", "case_id", "category", "passed", F.md5("answer").alias("answer_md5"),
        F.array_join("forbidden_hits", "|").alias("forbidden_hits"), F.array_join("expected_any", "|").alias("expected_any"),
    )


@query
def golden_by_category(spark: SparkSession, sf: str) -> DataFrame:
    """Overall and per-category rates of every model."""
    return evaluation.rates(_judged(spark, sf)).select("model", "category", "total", "passed", "pass_rate", "overall")


@query
def golden_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Failed cases and why."""
    return evaluation.failures(_judged(spark, sf)).select("model", "case_id", "question", "why", F.array_join("patterns", "|").alias("patterns"))


@query
def golden_lint(spark: SparkSession, sf: str) -> DataFrame:
    """Soundness of the golden set."""
    return evaluation.lint_golden(_golden(spark, sf))


def _label_verdicts(spark: SparkSession, sf: str, passed: Column) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.col("source").alias("model"), F.col("lang").alias("category"), passed.alias("passed")
    )


def _label_rates(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rated = evaluation.rates(_label_verdicts(spark, sf, F.col("quality") == 1))
    base = evaluation.rates(_label_verdicts(spark, sf, F.col("toxic") == 0)).where("overall")
    return rated, base.select("model", F.col("pass_rate").alias("baseline_rate"))


@query
def gate(spark: SparkSession, sf: str) -> DataFrame:
    """Decision per model, quality labels against the toxicity baseline."""
    rated, base = _label_rates(spark, sf)
    return evaluation.decide(rated, baseline=base).withColumn("reasons", F.array_join("reasons", "; "))


@query
def low_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Categories under the floor."""
    return evaluation.flag_low(_label_rates(spark, sf)[0]).select("model", "category", "pass_rate", "low")


@query
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The same results at several floors."""
    return evaluation.sweep(_label_rates(spark, sf)[0], [0.5, 0.8, 0.9, 0.99])


# ---------------------------------------------------------------- requests


@query
def request_validity(spark: SparkSession, sf: str) -> DataFrame:
    """Each conversation as a request."""
    facts = requests.facts_from_turns(table(spark, sf, "conversations"))
    return requests.check(facts).select(
        "conv_id", F.col("n_messages").cast("long").alias("n_messages"), "total_chars", "last_role",
        F.array_join("errors", ",").alias("errors"), "too_large",
    )


@query
def prompt_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """System prompt and the last turns, here at most four."""
    built = requests.assemble_from_turns(
        table(spark, sf, "conversations"), SYSTEM_PROMPT, limits=ServingLimits(max_history_turns=2)
    )
    rendered = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return built.select("conv_id", F.size("messages").cast("long").alias("n"), F.md5(rendered).alias("prompt_md5"))


def _with_params(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    return request_log(spark, sf).withColumns(
        {
            "max_tokens": F.when(k % 3 > 0, k * 10 + 1),
            "temperature": F.when(k % 4 == 0, F.lit(0.0)).when(k % 4 == 1, k / 40.0),
            "top_p": F.when(k % 5 > 0, k / 80.0),
            "authorization": F.when(k % 2 == 0, F.concat(F.lit("Bearer secret-"), F.col("client"), F.lit("-0123456789"))),
            "host": F.when(k % 3 == 0, F.col("client")),
        }
    )


@query
def request_params(spark: SparkSession, sf: str) -> DataFrame:
    """Parameter checks, effective parameters and client identity."""
    log = _with_params(spark, sf)
    bad = F.concat_ws(
        ",",
        F.when(~F.col("max_tokens").between(1, 512), "max_tokens"),
        F.when(~F.col("temperature").between(0.0, 2.0), "temperature"),
        F.when(~F.col("top_p").between(0.0, 1.0), "top_p"),
    )
    identified = log.withColumns({"identity": requests.client_identity(F.col("authorization"), F.col("host")), "bad": bad})
    return identified.withColumns(requests.effective_params()).select(
        "request_id", "identity", "bad", F.col("max_tokens").cast("long").alias("max_tokens"),
        F.bround("temperature", 6).alias("temperature"), F.bround("top_p", 6).alias("top_p"),
    )


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    return request_log(spark, sf).withColumns(
        {
            "authorized": k >= 2,
            "valid": ~k.isin(2, 3),
            "too_large": F.col("value") > 300,
            "input_reason": F.when(k == 4, F.lit("prompt_injection")).when(k == 5, F.lit("pii_email")).otherwise(F.lit("")),
            "stream": k.between(6, 9),
            "cache_hit": k.between(20, 29),
            "upstream": F.when(F.col("event_type") != "error", F.lit("ok"))
            .when(k % 3 == 0, F.lit("timeout")).when(k % 3 == 1, F.lit("unavailable")).otherwise(F.lit("error")),
            "output_reason": F.when(k == 10, F.lit("banned_placeholder")).otherwise(F.lit("")),
        }
    )


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_report.outcomes(_facts(spark, sf), CANARY_PERCENT, ONE_PER_MINUTE)


@query
def outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome, status and counting rules of every request."""
    return _classified(spark, sf).select(
        "request_id", "outcome", F.col("http_status").cast("long").alias("http_status"), "counted", "label_variant",
        "latency_observed", "upstream_error",
    )


@query
def log_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON log lines, sign-ups cut short; parsed lines by event and the quarantined rest."""
    log = request_log(spark, sf)
    seconds = F.format_string("%d.%06d", F.floor(F.unix_micros("ts") / 1_000_000), F.unix_micros("ts") % 1_000_000)
    line = F.concat(
        F.lit('{"ts": '), seconds, F.lit(', "event": "'), F.col("event_type"), F.lit('", "rid": "r'),
        F.col("request_id").cast("string"), F.lit('", "path": "/v1/chat", "status": '), F.col("status").cast("string"),
        F.lit(', "ms": '), F.col("k").cast("string"), F.when(F.col("event_type") == "signup", F.lit("")).otherwise(F.lit(', "extra": [1]}')),
    )
    events, bad = requests.parse_log(log.select(line.alias("line")))
    good = events.groupBy("event", F.col("status").cast("long").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("ms").alias("ms"), F.min(F.unix_micros("ts")).alias("first_us")
    )
    rest = bad.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("(bad)").alias("event"), F.lit(None).cast("long").alias("status"), "n",
        F.lit(None).cast("long").alias("ms"), F.lit(None).cast("long").alias("first_us"),
    )
    return good.unionByName(rest)


def _screened(spark: SparkSession, sf: str) -> DataFrame:
    docs = pii.redact(document_answers(spark, sf).withColumn("asked", F.col("answer")), ["answer"], style="entity")
    return guardrails.screen(docs, message="asked", answer="answer")


@query
def input_screen(spark: SparkSession, sf: str) -> DataFrame:
    """G1: every document as a message."""
    return guardrails.screen(document_answers(spark, sf), message="answer").select(F.col("pos").alias("doc_id"), "input_reason")


@query
def output_screen(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as an answer that was redacted with entity placeholders."""
    return _screened(spark, sf).select(F.col("pos").alias("doc_id"), "output_reason")


@query
def block_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks by stage and reason."""
    return guardrails.block_counts(_screened(spark, sf))


# ---------------------------------------------------------------- traffic


@query
def canary_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """A1: variant of every client at 10 and 50 percent."""
    clients = request_log(spark, sf).groupBy("client").agg(F.count(F.lit(1)).alias("n"))
    return clients.select(
        "client", "n", traffic.variant(F.col("client"), 10).alias("at_10"), traffic.variant(F.col("client"), 50).alias("at_50"),
        traffic.variant(F.col("client"), 0).alias("at_0"), traffic.variant(F.col("client"), 100).alias("at_100"),
    )


@query
def canary_percent(spark: SparkSession, sf: str) -> DataFrame:
    """A2: clamped percentages read from text."""
    raw = request_log(spark, sf).select(
        F.when(F.col("event_type") == "error", F.lit("x")).otherwise((F.col("k") * 2 - 30).cast("string")).alias("raw")
    )
    return raw.groupBy("raw").agg(F.count(F.lit(1)).alias("n")).select(
        "raw", "n", traffic.clamp_percent_column(F.col("raw")).cast("long").alias("percent")
    )


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return request_log(spark, sf).withColumn("variant", traffic.variant(F.col("client"), CANARY_PERCENT))


@query
def variant_upstream(spark: SparkSession, sf: str) -> DataFrame:
    """Upstream of each variant; the canary's model name is unset."""
    upstreams = spark.createDataFrame(
        [("stable", "http://a", "v1", "model-a"), ("canary", "http://b", "v2", None)],
        "variant string, url string, revision string, model_name string",
    )
    return traffic.with_upstream(_routed(spark, sf), upstreams).groupBy("variant", "url", "revision", "model_name").agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def quota_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """A3: one request a minute for each client."""
    return traffic.quota(request_log(spark, sf), ONE_PER_MINUTE).select(
        "request_id", F.col("request_no").cast("long").alias("request_no"), "allowed",
        F.col("remaining").cast("long").alias("remaining"), epoch(F.col("window_start")).alias("window_start"),
    )


@query
def cache_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A4-A5: requests with the same key, cacheable ones only."""
    log = _with_params(spark, sf).withColumns(requests.effective_params())
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("event_type").alias("content")))
    key = traffic.cache_key(messages, F.col("max_tokens"), F.col("temperature"), F.col("top_p"), F.lit("v1"))
    kept = log.where(traffic.cacheable(F.col("temperature"))).withColumn("cache_key", key)
    classes = kept.groupBy("cache_key").agg(F.min("request_id").alias("first_request"), F.count(F.lit(1)).alias("n"))
    return classes.select("first_request", "n")


@query
def cache_hits(spark: SparkSession, sf: str) -> DataFrame:
    """One key per prompt, an hour to live, failed requests store nothing."""
    log = request_log(spark, sf).withColumns({"cache_key": F.col("k").cast("string"), "stores": F.col("status") == 200})
    return traffic.cache_outcomes(log, stores="stores").select("request_id", "cache_result")


@query
def cache_hits_all(spark: SparkSession, sf: str) -> DataFrame:
    """A6 where every miss stores; the large-key method, forced by a low limit."""
    log = request_log(spark, sf).withColumn("cache_key", F.col("k").cast("string"))
    return traffic.cache_outcomes(log, group_limit=90).select("request_id", "cache_result")


# ---------------------------------------------------------------- retrieval


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


ASKED = "id % 50 = 0"


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    vectors = _vectors(spark, sf)
    return retrieval.nearest(vectors.where(ASKED), vectors)


@query
def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    """K1-K2: the three nearest vectors of every fiftieth vector."""
    return _hits(spark, sf).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "id", F.bround("distance", 6).alias("distance"),
        F.bround("score", 6).alias("score"),
    )


@query
def knn_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """K1 by block product, the way for chunk tables too large to broadcast; true L2 distance."""
    vectors = _vectors(spark, sf)
    return retrieval.nearest(vectors.where(ASKED), vectors, metric="l2", broadcast_bytes=0).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "id", F.bround("distance", 6).alias("distance"),
        F.bround("score", 6).alias("score"),
    )


@query
def knn_approx(spark: SparkSession, sf: str) -> DataFrame:
    """K1 approximate: every fiftieth vector against an index of all, held against the exact search."""
    vectors = _vectors(spark, sf)
    cells = vector_index.fit(vectors)
    found = vector_index.search(vectors.where(ASKED), vector_index.build(vectors, cells), cells)
    told = vector_index.recall(found, _hits(spark, sf))
    return told.select("exact", (F.col("recall") >= 0.9).alias("as_wanted"))


@query
def context_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """K3: context block of every query, chunks being the documents of the same number."""
    chunks = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return retrieval.context_blocks(_hits(spark, sf), chunks).select("query_id", F.md5("context").alias("context_md5"))


@query
def unknown_topics(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth vector against the others, found from a score of 0.5."""
    vectors = _vectors(spark, sf)
    return prompt.unknown_rate(vectors.where(ASKED), vectors.where(f"NOT ({ASKED})"), 0.5)


@query
def kb_context(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts of all conversations with context from a knowledge base with text ids."""
    vectors = _vectors(spark, sf)
    texts = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    chunks = vectors.join(texts, "id").withColumn("id", F.concat(F.lit("kb-"), F.col("id").cast("string")))
    turns = table(spark, sf, "conversations")
    questions = vectors.join(turns.select(F.col("conv_id").alias("id")).distinct(), "id")
    built = prompt.prompts(turns, questions, chunks, SYSTEM_PROMPT, limits=ServingLimits(max_history_turns=2))
    rendered = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return built.select("conv_id", F.size("messages").cast("long").alias("n"), F.md5(rendered).alias("prompt_md5"))


# ---------------------------------------------------------------- metrics


@query
def request_counts(spark: SparkSession, sf: str) -> DataFrame:
    """M1: counted requests by route, status and variant."""
    return metrics.request_counts(_classified(spark, sf)).withColumn("status", F.col("status").cast("long"))


@query
def rate_limited(spark: SparkSession, sf: str) -> DataFrame:
    """M5: requests over quota."""
    return metrics.label_counts(_classified(spark, sf), ["route"], F.col("outcome") == "rate_limited")


@query
def upstream_errors(spark: SparkSession, sf: str) -> DataFrame:
    """M6: upstream errors by kind."""
    return metrics.label_counts(_classified(spark, sf), ["upstream_error"], F.col("upstream_error").isNotNull())


@query
def latency_hist(spark: SparkSession, sf: str) -> DataFrame:
    """M2: cumulative histogram by route and variant."""
    return metrics.latency_histogram(_classified(spark, sf).where("latency_observed"), ["route", "variant"])


@query
def latency_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """M3: quantiles from the buckets."""
    hist = metrics.latency_histogram(_classified(spark, sf).where("latency_observed"), ["variant"])
    return metrics.quantiles(hist, ["variant"], [0.5, 0.95, 0.99]).withColumn("value", F.bround("value", 6))


@query
def latency_exact(spark: SparkSession, sf: str) -> DataFrame:
    """M3: exact p50, p95, p99 of the observed latencies, by counting."""
    log = _classified(spark, sf).where("latency_observed").select("variant", "latency_s")
    found = quantiles.exact_quantiles(log, ["variant"], [0.5, 0.95, 0.99])
    return found.withColumns({c: F.bround(c, 9) for c in ("disc", "cont")})


@query
def latency_sketch(spark: SparkSession, sf: str) -> DataFrame:
    """M3: quantiles of fifteen-minute windows from minute sketches; whether their true rank is as near as stated."""
    log = materialize(_classified(spark, sf).where("latency_observed").select("ts", "variant", "latency_s"), "observed")
    windows_of = quantiles.sliding_sketches(quantiles.minute_sketches(log, ["variant"]), ["variant"], 15)
    told = materialize(quantiles.sketch_quantiles(windows_of, [0.5, 0.95, 0.99]), "estimates")
    values = log.select(
        "variant", F.date_trunc("minute", "ts").alias("minute"), "latency_s"
    ).groupBy("variant", "minute", "latency_s").agg(F.count(F.lit(1)).alias("c"))
    ends = F.explode(F.sequence(F.col("minute") + F.expr("INTERVAL 1 MINUTE"), F.col("minute") + F.expr("INTERVAL 15 MINUTE"), F.expr("INTERVAL 1 MINUTE")))
    met = values.select("variant", ends.alias("window_end"), "latency_s", "c").join(told, ["variant", "window_end"])
    ranked = met.groupBy("variant", "window_end", "q", "n").agg(
        F.sum(F.when(F.col("latency_s") < F.col("value"), F.col("c")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("latency_s") <= F.col("value"), F.col("c")).otherwise(0)).alias("upto"),
    )
    off = F.greatest(F.col("below") / F.col("n") - F.col("q"), F.col("q") - F.col("upto") / F.col("n"), F.lit(0.0))
    return ranked.select("variant", epoch(F.col("window_end")).alias("window_end"), "q", "n", (off <= quantiles.RANK_ERROR).alias("as_stated"))


@query
def cache_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """M4: hit ratio of the hourly cache."""
    log = request_log(spark, sf).withColumns({"cache_key": F.col("k").cast("string"), "stores": F.col("status") == 200})
    ratio = metrics.cache_ratio(traffic.cache_outcomes(log, stores="stores"))
    return ratio.withColumn("hit_ratio", F.bround("hit_ratio", 6))


@query
def token_totals(spark: SparkSession, sf: str) -> DataFrame:
    """M7: tokens by kind and variant."""
    log = _routed(spark, sf).withColumns(
        {"prompt_tokens": F.col("k").cast("long"), "completion_tokens": (F.col("k") * 2 + 1).cast("long")}
    )
    return metrics.token_totals(log)


@query
def upstream_last(spark: SparkSession, sf: str) -> DataFrame:
    """M8: latest reading per client."""
    readings = request_log(spark, sf).withColumn("up", (F.col("status") == 200).cast("long"))
    return metrics.latest(readings, ["client"], "up")


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    """Requests in the request counter, with the variant they are labelled with."""
    return _classified(spark, sf).where("counted").drop("variant").withColumnRenamed("label_variant", "variant")


@query
def rate_5m(spark: SparkSession, sf: str) -> DataFrame:
    """Five-minute rates, sliding by a minute, per variant and status."""
    out = metrics.rates(_counted(spark, sf), ["variant", "http_status"], 5)
    return out.select(
        "variant", F.col("http_status").cast("long").alias("status"), epoch(F.col("window_end")).alias("window_end"), "n",
        F.bround("per_second", 9).alias("per_second"),
    )


@query
def rate_1m(spark: SparkSession, sf: str) -> DataFrame:
    """One-minute rates per variant."""
    out = metrics.rates(_counted(spark, sf), ["variant"], 1)
    return out.select("variant", epoch(F.col("window_end")).alias("window_end"), "n", F.bround("per_second", 9).alias("per_second"))


@query
def variant_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Stable against canary."""
    wide = metrics.variant_comparison(_counted(spark, sf), "http_status")
    return wide.withColumns({c: F.bround(c, 6) for c in wide.columns if c.endswith("share")})


@query
def status_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of 4xx and 5xx per client."""
    out = metrics.error_shares(_classified(spark, sf).where("counted"), ["client"], "http_status")
    return out.withColumns({c: F.bround(c, 6) for c in out.columns if c.endswith("share")})


def _readings(spark: SparkSession, sf: str, every: int = 1) -> DataFrame:
    """Clicks and errors as probes of the upstream; ``every`` thins them out."""
    log = request_log(spark, sf).where(F.col("event_type").isin("click", "error") & (F.col("request_id") % every == 0))
    return log.select("ts", "request_id", F.lit("main").alias("upstream"), (F.col("status") == 200).cast("long").alias("up"))


def _signals(spark: SparkSession, sf: str, every: int = 1) -> DataFrame:
    return metrics.alert_signals(_classified(spark, sf), _readings(spark, sf, every), ALERTS)


@query
def alert_signals(spark: SparkSession, sf: str) -> DataFrame:
    """Value and breach of every alert and minute."""
    return _signals(spark, sf).select(
        "alert", epoch(F.col("minute")).alias("minute"), F.bround("value", 6).alias("value"), "breached",
        F.col("hold_min").cast("long").alias("hold_min"),
    )


@query
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Breaches that lasted their hold."""
    return metrics.firing(_signals(spark, sf)).select(
        "alert", epoch(F.col("started")).alias("started"), epoch(F.col("ended")).alias("ended"), epoch(F.col("fired_at")).alias("fired_at")
    )


@query
def alerts_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """The gauge is read rarely and holds between readings."""
    return metrics.firing(_signals(spark, sf, every=7)).select(
        "alert", epoch(F.col("started")).alias("started"), epoch(F.col("ended")).alias("ended"), epoch(F.col("fired_at")).alias("fired_at")
    )


@query
def observe(spark: SparkSession, sf: str) -> DataFrame:
    """The whole observation job, one row per metric and label with its count."""
    tokens = {"prompt_tokens": F.col("k").cast("long"), "completion_tokens": (F.col("k") * 2 + 1).cast("long")}
    classified = materialize(_classified(spark, sf).withColumns(tokens), "classified")
    done = observe_plan.observe(classified, materialize(_readings(spark, sf), "readings"), rules=ALERTS)

    def rows(name: str, labels: Sequence[str], n: Column) -> DataFrame:
        label = F.concat_ws("|", *[F.col(c).cast("string") for c in labels]) if labels else F.lit("")
        return done[name].select(F.lit(name).alias("metric"), label.alias("label"), n.cast("long").alias("n"))

    parts = [
        rows("requests", ["route", "status", "variant"], F.col("n")),
        rows("latency", ["route", "variant", "le"], F.col("n")),
        rows("rate_limited", ["route"], F.col("n")),
        rows("upstream_errors", ["kind"], F.col("n")),
        rows("blocks", ["stage", "reason"], F.col("n")),
        rows("tokens", ["variant", "kind"], F.col("tokens")),
        rows("upstream", ["upstream"], F.col("up")),
        rows("alerts", ["alert"], epoch(F.col("started"))),
        done["cache"].select(F.lit("cache").alias("metric"), F.lit("hit").alias("label"), F.col("hits").alias("n")),
        done["cache"].select(F.lit("cache").alias("metric"), F.lit("miss").alias("label"), F.col("misses").alias("n")),
    ]
    return functools.reduce(DataFrame.unionByName, parts)


def _drift_signals(spark: SparkSession, sf: str) -> DataFrame:
    """One model per language; its traffic is the clients whose number falls to it."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("model"))
    labelled = table(spark, sf, "labels").join(docs, "doc_id")
    rates = labelled.groupBy("model").agg(
        F.bround(F.avg(F.col("quality").cast("double")), 4).alias("golden_pass_rate"),
        F.bround(F.avg(1.0 - F.col("toxic")), 4).alias("baseline_pass_rate"),
    )
    fresh = labelled.groupBy("model").agg(F.count(F.lit(1)).alias("new_labelled_examples"))
    slot = F.col("k") % 4
    log = request_log(spark, sf).withColumn(
        "model", F.when(slot == 0, "de").when(slot == 1, "en").when(slot == 2, "es").otherwise("fr")
    )
    errors = metrics.error_shares(log, ["model"]).select("model", F.col("server_error_share").alias("error_rate"))
    slow = metrics.quantiles(metrics.latency_histogram(log, ["model"], "value"), ["model"], [0.95]).select(
        "model", F.col("value").alias("p95_latency_s")
    )
    empty = log.groupBy("model").agg(F.avg(F.when(F.col("event_type").isin("view", "click"), 1.0).otherwise(0.0)).alias("unknown_topic_rate"))
    return drift.assemble(rates, errors, slow, fresh, empty)


@query
def drift_signals(spark: SparkSession, sf: str) -> DataFrame:
    """signals per model."""
    s = _drift_signals(spark, sf)
    return s.withColumns({c: F.bround(c, 6) for c in s.columns if c not in ("model", "new_labelled_examples")})


@query
def drift_shift(spark: SparkSession, sf: str) -> DataFrame:
    """shift of the event types between the earlier and the later half of the log's time, per model."""
    log = request_log(spark, sf).select((F.col("k") % 4).cast("long").alias("model"), F.col("event_type").alias("category"), F.unix_micros("ts").alias("t"))
    ends = log.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    middle = (ends["a"] + ends["b"]) // 2
    shift = drift.category_shift(log.where(F.col("t") < middle), log.where(F.col("t") >= middle))
    return shift.withColumn("shift", F.bround("shift", 9))


@query
def drift_decision(spark: SparkSession, sf: str) -> DataFrame:
    """the retrain decision per model."""
    return drift.decide(_drift_signals(spark, sf)).select("model", "retrain", "severity", F.array_join("reasons", "; ").alias("reasons"))


# ---------------------------------------------------------------- streams

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


FILES_PER_SLICE = 8
#: A given table is one file or a folder of files in no order of time: all of them make one batch.
TABLE_FILES = 1_000_000


def _sliced_files(rows: DataFrame, ts: str, key: str, label: str) -> str:
    """Rows written as four slices of time, each shuffled over eight files, rows up to four minutes out of order."""
    path = scratch_path(rows.sparkSession, label)
    late = F.unix_seconds(F.col(ts).cast("timestamp")) + F.pmod(F.xxhash64(key), F.lit(240))
    ends = rows.agg(F.min(late).alias("a"), F.max(late).alias("b")).first()
    width = (ends["b"] - ends["a"]) // 4 + 1
    for i in range(4):
        part = rows.where(F.floor((late - ends["a"]) / width) == i)
        part.repartition(FILES_PER_SLICE, F.xxhash64(key)).write.mode("append").parquet(path)
    return path


def _event_stream(spark: SparkSession, sf: str, shuffled: bool = False) -> DataFrame:
    if shuffled:
        rows = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf}/events.parquet")
        path = _sliced_files(rows, "ts", "event_id", "event-files")
        events = runner.stream_files(spark, path, EVENT_SCHEMA, files_per_batch=FILES_PER_SLICE)
    else:
        events = runner.stream_files(spark, f"{sf}/events.parquet*", EVENT_SCHEMA, files_per_batch=TABLE_FILES)
    return events.select(
        F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("client"), "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"), "value",
    )


@query
def stream_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: five-minute counts per event type, closed windows only."""
    out, _ = runner.drain(windows.windowed_counts(_event_stream(spark, sf), ["event_type"], "5 minutes"), "stream-counts")
    return out.select(epoch(F.col("window_start")).alias("window_start"), "event_type", "n", F.bround("per_second", 9).alias("per_second"))


@query
def stream_sliding_rates(spark: SparkSession, sf: str) -> DataFrame:
    """ST1: five-minute windows sliding by a minute."""
    out, _ = runner.drain(windows.windowed_counts(_event_stream(spark, sf), [], "5 minutes", "1 minute"), "stream-rates")
    return out.select(epoch(F.col("window_end")).alias("window_end"), "n")


@query
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """ST2: the earlier half of the log arrives last and falls to the watermark, but for its open windows."""
    events = spark.read.schema(EVENT_SCHEMA).parquet(f"{sf}/events.parquet")
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(t).alias("a"), F.max(t).alias("b")).first()
    middle = (ends["a"] + ends["b"]) // 2
    path = scratch_path(spark, "late-files")
    new = t >= middle
    # a batch is held against the watermark of the one before it, so the newer half comes in two
    for half in (new & (F.col("event_id") % 2 == 0), new & (F.col("event_id") % 2 == 1), ~new):
        part = events.where(half).repartition(FILES_PER_SLICE, F.xxhash64("event_id"))
        part.write.mode("append").parquet(path)
    files = runner.stream_files(spark, path, EVENT_SCHEMA, files_per_batch=FILES_PER_SLICE)
    stream = files.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    out, _ = runner.drain(windows.windowed_counts(stream, ["event_type"], "5 minutes"), "stream-late")
    return out.select(epoch(F.col("window_start")).alias("window_start"), "event_type", "n")


@query
def stream_quota(spark: SparkSession, sf: str) -> DataFrame:
    """ST3: quota decisions from keyed state over shuffled files, for minutes the watermark has closed."""
    out, _ = runner.drain(state.quota_stream(_event_stream(spark, sf, shuffled=True), limit=1), "stream-quota")
    return out.select("request_id", "request_no", "allowed", "remaining")


@query
def stream_cache(spark: SparkSession, sf: str) -> DataFrame:
    """ST6: hits and misses from keyed state over shuffled files, for requests the watermark has passed."""
    log = _event_stream(spark, sf, shuffled=True).select(
        "ts", "request_id", F.col("k").cast("string").alias("cache_key"), (F.col("event_type") != "error").alias("stores")
    )
    out, _ = runner.drain(state.cache_stream(log), "stream-cache")
    return out.select("request_id", "cache_result")


@query
def stream_quota_timers(spark: SparkSession, sf: str) -> DataFrame:
    """ST3 from slots and timers: the decisions of ``stream_quota``."""
    out, _ = runner.drain(timers.quota_timers(_event_stream(spark, sf, shuffled=True), limit=1), "stream-quota-timers")
    return out.select("request_id", "request_no", "allowed", "remaining")


@query
def stream_cache_timers(spark: SparkSession, sf: str) -> DataFrame:
    """ST6 from slots and timers: the decisions of ``stream_cache``."""
    log = _event_stream(spark, sf, shuffled=True).select(
        "ts", "request_id", F.col("k").cast("string").alias("cache_key"), (F.col("event_type") != "error").alias("stores")
    )
    out, _ = runner.drain(timers.cache_timers(log), "stream-cache-timers")
    return out.select("request_id", "cache_result")


@query
def stream_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """ST5: screening of a document stream, flagged rows to a quarantine table, counted by stage and reason."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = runner.stream_files(spark, f"{sf}/documents.parquet*", schema, files_per_batch=TABLE_FILES)
    out, _ = runner.drain(windows.screened(docs, message="text").select("doc_id", "stage", "reason"), "stream-blocks")
    return out


@query
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """ST1 into ST4: a stream of sliding windows, read by a second stream that holds breaches, minutes out of order."""
    events = _event_stream(spark, sf, shuffled=True)
    bad = {"bad": F.count_if(F.col("event_type") == "error")}
    counted, _ = runner.drain(windows.windowed_counts(events, [], "5 minutes", "1 minute", extra=bad), "stream-windows")
    path = _sliced_files(counted.select("window_end", "n", "bad"), "window_end", "window_end", "window-files")
    rows = runner.stream_files(spark, path, "window_end timestamp, n long, bad long", files_per_batch=FILES_PER_SLICE)
    signals = rows.select(
        F.lit("HighErrorRate").alias("alert"), F.col("window_end").alias("minute"),
        (F.col("bad") / F.col("n") > ALERTS.error_share).alias("breached"), F.lit(ALERTS.error_hold_min).alias("hold_min"),
    )
    out, _ = runner.drain(state.alert_stream(signals), "stream-alerts")
    return out.select("alert", epoch(F.col("started")).alias("started"), epoch(F.col("fired_at")).alias("fired_at"))


@query
def stream_alerts_all(spark: SparkSession, sf: str) -> DataFrame:
    """ST4: all four alerts in one stream of the classified log, minutes out of order, for minutes the watermark has passed."""
    reading = F.when(F.col("event_type").isin("click", "error"), (F.col("event_type") != "error").cast("long"))
    log = _classified(spark, sf).select(
        "ts", "request_id", "counted", "http_status", "label_variant", "latency_observed", "latency_s", reading.alias("up")
    )
    path = _sliced_files(materialize(log, "classified-log"), "ts", "request_id", "classified-files")
    rows = runner.stream_files(spark, path, log.schema, files_per_batch=FILES_PER_SLICE).withColumn("series", F.lit("main"))
    out, _ = runner.drain(alert_streams.alerts_of_log(rows, ALERTS), "stream-alerts-all")
    return out.select("alert", epoch(F.col("started")).alias("started"), epoch(F.col("fired_at")).alias("fired_at"))


@query
def stream_block_rates(spark: SparkSession, sf: str) -> DataFrame:
    """ST5: documents as messages a minute apart; flagged ones to quarantine and their counts per hour, from one stream."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.timestamp_seconds(F.col("doc_id") * 60).alias("ts"))
    path = _sliced_files(docs, "ts", "doc_id", "message-files")
    stream = runner.stream_files(spark, path, docs.schema, files_per_batch=FILES_PER_SLICE)
    root = scratch_path(spark, "blocks")
    stream_sinks.quarantine(stream, root, scratch_path(spark, "blocks-progress"), "1 hour", message="text")
    held = stream_sinks.quarantined(spark, root).groupBy(F.window("ts", "1 hour").alias("w"), "stage", "reason").agg(F.count(F.lit(1)).alias("quarantined"))
    held = held.select(F.col("w.start").alias("window_start"), "stage", "reason", "quarantined")
    joined = stream_sinks.block_counts(spark, root).join(held, ["window_start", "stage", "reason"], "full")
    return joined.select(epoch(F.col("window_start")).alias("window_start"), "stage", "reason", "n", "quarantined")


__all__ = ["QUERIES"]
