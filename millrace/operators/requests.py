"""Logged chat requests: validity, prompt, parameters, client, outcome, log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import ServingLimits

CLIENT_ROLES = ("user", "assistant")


# ---------------------------------------------------------------- validity


def facts_from_messages(requests: DataFrame, limits: ServingLimits = ServingLimits()) -> DataFrame:
    """Add the facts the validity rules need, from a ``messages`` array."""
    m = F.coalesce("messages", F.array().cast("array<struct<role:string,content:string>>"))

    def length(x: Column) -> Column:
        return F.coalesce(F.length(x["content"]), F.lit(0))

    return requests.withColumns(
        {
            "n_messages": F.size(m),
            "bad_roles": F.size(F.filter(m, lambda x: ~F.coalesce(x["role"].isin(*CLIENT_ROLES), F.lit(False)))),
            "empty_contents": F.size(F.filter(m, lambda x: length(x) < 1)),
            "long_contents": F.size(F.filter(m, lambda x: length(x) > limits.max_message_chars)),
            "total_chars": F.aggregate(m, F.lit(0).cast("long"), lambda acc, x: acc + length(x)),
            "last_role": F.get(m, F.size(m) - 1)["role"],
        }
    )


def facts_from_turns(
    turns: DataFrame, conversation: str = "conv_id", limits: ServingLimits = ServingLimits()
) -> DataFrame:
    """The same facts from a table of turns (role, text, turn); nothing is collected per conversation."""
    length = F.coalesce(F.length("text"), F.lit(0))
    return turns.groupBy(conversation).agg(
        F.count(F.lit(1)).cast("int").alias("n_messages"),
        F.count_if(~F.coalesce(F.col("role").isin(*CLIENT_ROLES), F.lit(False))).cast("int").alias("bad_roles"),
        F.count_if(length < 1).cast("int").alias("empty_contents"),
        F.count_if(length > limits.max_message_chars).cast("int").alias("long_contents"),
        F.sum(length.cast("long")).alias("total_chars"),
        F.max_by("role", "turn").alias("last_role"),
    )


def validity_errors(limits: ServingLimits = ServingLimits(), with_params: bool = True) -> Column:
    """Names of the broken rules; an empty array means the request is accepted."""
    checks = [
        ("no_messages", F.col("n_messages") < 1),
        ("role", F.col("bad_roles") > 0),
        ("content_empty", F.col("empty_contents") > 0),
        ("content_too_long", F.col("long_contents") > 0),
        ("last_not_user", (F.col("n_messages") > 0) & (F.coalesce("last_role", F.lit("")) != "user")),
    ]
    if with_params:
        checks += [
            ("max_tokens", ~F.col("max_tokens").between(1, limits.max_new_tokens)),
            ("temperature", ~F.col("temperature").between(0.0, 2.0)),
            ("top_p", ~F.col("top_p").between(0.0, 1.0)),
        ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks]))


def check(facts: DataFrame, limits: ServingLimits = ServingLimits()) -> DataFrame:
    """Add ``errors`` (schema rules) and ``too_large`` (total size cap)."""
    return facts.withColumns(
        {
            "errors": validity_errors(limits, "max_tokens" in facts.columns),
            "too_large": F.col("total_chars") > limits.max_prompt_chars,
        }
    )


# ---------------------------------------------------------------- prompt


def _system(prompt: str, context: Column | None) -> Column:
    base = F.lit(prompt.strip())
    if context is None:
        return base
    return F.when(F.coalesce(context, F.lit("")) == "", base).otherwise(F.concat(base, F.lit("\n\n"), context))


def assemble_from_messages(
    messages: Column, system_prompt: str, context: Column | None = None, limits: ServingLimits = ServingLimits()
) -> Column:
    """System prompt, with its context, followed by the last turns."""
    keep = F.least(F.size(messages), F.lit(2 * limits.max_history_turns))
    last = F.slice(messages, F.size(messages) - keep + 1, keep)
    head = F.struct(F.lit("system").alias("role"), _system(system_prompt, context).alias("content"))
    return F.concat(F.array(head), last)


def assemble_from_turns(
    turns: DataFrame, system_prompt: str, conversation: str = "conv_id", limits: ServingLimits = ServingLimits(),
    contexts: DataFrame | None = None,
) -> DataFrame:
    """(conversation, messages). Only the last turns are collected, a bounded number per conversation.

    ``contexts`` (conversation, context) goes into the system message; without a row the context is empty.
    """
    latest = Window.partitionBy(conversation).orderBy(F.col("turn").desc())
    kept = turns.withColumn("_r", F.row_number().over(latest)).where(F.col("_r") <= 2 * limits.max_history_turns)
    last = F.transform(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))),
        lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")),
    )
    collected = kept.groupBy(conversation).agg(last.alias("_last"))
    context = None
    if contexts is not None:
        collected = collected.join(contexts.select(conversation, F.col("context").alias("_context")), conversation, "left")
        context = F.col("_context")
    head = F.struct(F.lit("system").alias("role"), _system(system_prompt, context).alias("content"))
    return collected.select(conversation, F.concat(F.array(head), "_last").alias("messages"))


# ---------------------------------------------------------------- parameters and client


def effective_params(limits: ServingLimits = ServingLimits()) -> dict[str, Column]:
    """Generation parameters after defaults and ceilings, for ``withColumns``."""
    return {
        "max_tokens": F.least(F.coalesce("max_tokens", F.lit(limits.default_new_tokens)), F.lit(limits.max_new_tokens)),
        "temperature": F.coalesce("temperature", F.lit(limits.temperature)),
        "top_p": F.coalesce("top_p", F.lit(limits.top_p)),
    }


def client_identity(authorization: Column, host: Column) -> Column:
    """``key:`` and the first 16 characters of the bearer key, else ``ip:`` and the address."""
    bearer = "Bearer "
    return F.when(
        F.startswith(authorization, F.lit(bearer)),
        F.concat(F.lit("key:"), F.substring(authorization, len(bearer) + 1, 16)),
    ).otherwise(F.concat(F.lit("ip:"), F.coalesce(host, F.lit("unknown"))))


# ---------------------------------------------------------------- outcome


def classify(facts: DataFrame) -> DataFrame:
    """Add outcome, status, label and counting rules to requests with logged facts.

    Facts: ``authorized``, ``valid``, ``too_large``, ``quota_ok``, ``input_reason``,
    ``stream``, ``cache_hit``, ``upstream`` (ok, timeout, unavailable, error),
    ``output_reason``, ``variant``. The first matching step decides. Requests
    refused before the quota check and streamed ones are not in the request
    counter; those refused by quota or input screen carry variant ``none``;
    latency is observed for successes only.
    """
    up = F.col("upstream")
    outcome = (
        F.when(~F.col("authorized"), "unauthorized")
        .when(~F.col("valid"), "invalid")
        .when(F.col("too_large"), "too_large")
        .when(~F.col("quota_ok"), "rate_limited")
        .when(F.col("input_reason") != "", "input_blocked")
        .when(F.col("stream"), "stream")
        .when(F.col("cache_hit"), "cache_hit")
        .when(up == "timeout", "timeout")
        .when(up == "unavailable", "unavailable")
        .when(up != "ok", "engine_error")
        .when(F.col("output_reason") != "", "output_blocked")
        .otherwise("ok")
    )
    # HTTP status per outcome.
    statuses = {
        "unauthorized": 401, "invalid": 422, "too_large": 413, "rate_limited": 429, "input_blocked": 400,
        "stream": 200, "cache_hit": 200, "timeout": 504, "unavailable": 503, "engine_error": 502,
        "output_blocked": 502, "ok": 200,
    }
    o = F.col("outcome")
    status = None
    for name, code in statuses.items():
        status = F.when(o == name, code) if status is None else status.when(o == name, code)
    return facts.withColumn("outcome", outcome).withColumns(
        {
            "http_status": status,
            "counted": ~o.isin("unauthorized", "invalid", "too_large", "stream"),
            "label_variant": F.when(o.isin("rate_limited", "input_blocked"), F.lit("none")).otherwise(F.col("variant")),
            "latency_observed": o.isin("ok", "cache_hit"),
            "upstream_error": F.when(o == "engine_error", F.lit("error")).when(o.isin("timeout", "unavailable"), o),
        }
    )


# ---------------------------------------------------------------- log lines


def parse_log(lines: DataFrame, column: str = "line") -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) from JSON log lines; event-specific keys stay in ``extra``."""
    v = F.try_parse_json(column)
    parsed = lines.withColumn("_v", v).withColumn(
        "_ok", F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.lit(False))
    )
    good = parsed.where("_ok")
    kinds = {"ts": "double", "event": "string", "rid": "string", "path": "string", "status": "int", "ms": "long"}
    fields = {name: F.try_variant_get("_v", f"$.{name}", kind) for name, kind in kinds.items()}
    events = good.withColumns(fields).withColumn("ts", F.timestamp_micros((F.col("ts") * 1e6).cast("long")))
    return (
        events.withColumnRenamed("_v", "extra").drop("_ok", column),
        parsed.where(~F.col("_ok")).select(column),
    )


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("n"))
