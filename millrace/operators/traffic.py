"""Traffic policy on a request log: canary, quota, cache."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.config import ServingLimits
from millrace.functions.hashing import sha256_mod_100
from millrace.functions.ranks import bucketed_row_number
from millrace.session import materialize

MICROS = 1_000_000


# ---------------------------------------------------------------- canary


def clamp_percent(raw: object) -> int:
    """A percentage setting as 0-100; what cannot be read as a whole number is 0."""
    try:
        return max(0, min(100, int(str(raw).strip())))
    except ValueError:
        return 0


def clamp_percent_column(raw: Column) -> Column:
    """The same of a text column; whole numbers of any length are read by their digits."""
    digits = F.regexp_replace(F.regexp_extract(raw, r"^\s*[+-]?0*(\d+(?:_\d+)*)\s*$", 1), "_", "")
    negative = F.regexp_like(raw, F.lit(r"^\s*-"))
    size = F.when(F.length(digits) > 3, F.lit(100)).otherwise(F.coalesce(digits.try_cast("int"), F.lit(0)))
    return F.when(negative, F.lit(0)).otherwise(F.coalesce(F.least(F.lit(100), size), F.lit(0)))


def variant(client: Column, percent: int) -> Column:
    """``canary`` for a fixed share of clients, ``stable`` for the rest."""
    if percent <= 0:
        return F.lit("stable")
    if percent >= 100:
        return F.lit("canary")
    return F.when(sha256_mod_100(client) < percent, F.lit("canary")).otherwise(F.lit("stable"))


def with_upstream(df: DataFrame, upstreams: DataFrame) -> DataFrame:
    """Attach (url, revision, model_name) of a request's variant; unset canary fields fall back to stable.

    ``upstreams`` has one row per variant. It is folded into one row of
    constants-to-be and matched by value, so the log is not shuffled.
    """
    names = ["url", "revision", "model_name"]
    rows = {r["variant"]: r for r in upstreams.where(F.col("variant").isin("stable", "canary")).limit(2).collect()}
    stable = rows["stable"]
    canary = rows.get("canary")
    picked = {}
    for n in names:
        fallback = stable[n]
        own = canary[n] if canary is not None and canary[n] is not None else fallback
        picked[n] = F.when(F.col("variant") == "canary", F.lit(own)).otherwise(F.lit(fallback))
    return df.withColumns(picked)


# ---------------------------------------------------------------- quota


def quota(
    log: DataFrame, limits: ServingLimits = ServingLimits(), client: str = "client", ts: str = "ts", row_id: str = "request_id",
    within: Sequence[str] = (),
) -> DataFrame:
    """Fixed-window quota: add ``window_start``, ``request_no``, ``allowed`` and ``remaining``.

    Rejected requests count too. Ranks are taken within each second and offset
    by the seconds before it, so a client with a very large share of the log is
    sorted second by second and not in one task. Rows that differ in a column of ``within`` count apart.
    """
    if not limits.quota_enabled:
        return log.withColumns({"allowed": F.lit(True), "remaining": F.lit(limits.quota_per_minute)})
    second = F.floor(F.unix_micros(F.col(ts)) / MICROS).cast("long")
    keyed = log.withColumn("_second", second).withColumn("_minute", F.floor(F.col("_second") / 60).cast("long"))
    ranked = bucketed_row_number(keyed, [client, *within, "_minute"], "_second", [F.col(ts), F.col(row_id)], "request_no")
    return ranked.select(
        *log.columns,
        F.timestamp_seconds(F.col("_minute") * 60).alias("window_start"),
        "request_no",
        (F.col("request_no") <= limits.quota_per_minute).alias("allowed"),
        F.greatest(F.lit(0), limits.quota_per_minute - F.col("request_no")).cast("int").alias("remaining"),
    )


# ---------------------------------------------------------------- cache


def cache_key(messages: Column, max_tokens: Column, temperature: Column, top_p: Column, revision: Column) -> Column:
    """Digest of everything that affects an answer, field names in alphabetical order."""
    canonical = F.struct(
        F.transform(messages, lambda m: F.struct(m["content"].alias("content"), m["role"].alias("role"))).alias("messages"),
        F.struct(
            max_tokens.cast("int").alias("max_tokens"),
            temperature.cast("double").alias("temperature"),
            top_p.cast("double").alias("top_p"),
        ).alias("params"),
        revision.alias("revision"),
    )
    return F.sha2(F.to_json(canonical), 256)


def cacheable(temperature: Column, limits: ServingLimits = ServingLimits()) -> Column:
    return F.lit(limits.cache_enabled) & (temperature == 0.0)


GROUP_LIMIT = 50_000  # store times of one key that may be folded as one array
KEY_SALTS = 64


def cache_outcomes(
    log: DataFrame,
    key: str = "cache_key",
    ts: str = "ts",
    row_id: str = "request_id",
    stores: str | None = None,
    ttl_s: int = 3600,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add ``cache_result`` (hit or miss) to cacheable requests.

    An entry lives ``ttl_s`` from the miss that stored it and hits do not extend
    it. ``stores`` names a boolean column: would this request store its answer
    if it missed? (By default all would.)

    The requests that store form a chain per key: the first one, then the first
    at or after its expiry, and so on. Two chain members are at least a TTL
    apart, so all other requests find theirs by an equi-join on (key, TTL-wide
    time bucket) with at most two members per bucket.
    """
    ttl = ttl_s * MICROS
    timed = log.withColumn("_t", F.unix_micros(F.col(ts)))
    storing = timed if stores is None else timed.where(F.col(stores))
    times = materialize(
        storing.groupBy(F.col(key).alias("_key"), F.col("_t").alias("t")).agg(F.min(row_id).alias("rid")), "store-times"
    )
    chain = _chain(times, ttl, group_limit)
    spans = chain.select(
        "_key", F.col("t").alias("_m"), F.col("rid").alias("_mid"),
        F.explode(F.array(F.floor(F.col("t") / ttl), F.floor(F.col("t") / ttl) + 1)).alias("_bucket"),
    )
    hit = (F.col("_m").isNotNull()) & ((F.col("_t") > F.col("_m")) | (F.col(row_id) > F.col("_mid")))
    on = (
        (F.col(key) == F.col("_key")) & (F.floor(F.col("_t") / ttl) == F.col("_bucket"))
        & (F.col("_t") >= F.col("_m")) & (F.col("_t") < F.col("_m") + ttl)
    )
    return timed.join(spans, on, "left").select(
        *log.columns, F.when(hit, F.lit("hit")).otherwise(F.lit("miss")).alias("cache_result")
    )


def _chain(times: DataFrame, ttl: int, group_limit: int) -> DataFrame:
    """Chain members (_key, t, rid). Small keys are folded; large ones are solved by pointer doubling."""
    per_key = times.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    large = materialize(per_key.where(F.col("_n") > group_limit).select("_key"), "large-keys")
    if large.isEmpty():
        return _folded_chain(times, ttl)
    salted = large.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(KEY_SALTS - 1))))
    spread = times.withColumn("_s", F.pmod(F.xxhash64("t"), F.lit(KEY_SALTS)).cast("int"))
    small_times = spread.join(salted, ["_key", "_s"], "left_anti").drop("_s")
    large_times = materialize(spread.join(salted, ["_key", "_s"], "left_semi").drop("_s"), "large-times")
    return _folded_chain(small_times, ttl).unionByName(_doubled_chain(large_times, ttl))


def _folded_chain(times: DataFrame, ttl: int) -> DataFrame:
    rid = times.schema["rid"].dataType.simpleString()
    start = F.struct(
        F.array().cast(f"array<struct<t:bigint,rid:{rid}>>").alias("kept"), F.lit(-(2**62)).cast("long").alias("until")
    )
    folded = F.aggregate(
        F.array_sort(F.collect_list(F.struct("t", "rid"))),
        start,
        lambda acc, x: F.when(
            x["t"] >= acc["until"],
            F.struct(F.concat(acc["kept"], F.array(x)).alias("kept"), (x["t"] + ttl).alias("until")),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return (
        times.groupBy("_key").agg(folded.alias("_kept"))
        .select("_key", F.explode("_kept").alias("m"))
        .select("_key", "m.t", "m.rid")
    )


FINE = 1024  # slots to a bucket; a bucket is about a TTL wide


def _successors(times: DataFrame, ttl: int) -> DataFrame:
    """(_key, t, nxt): the first store time at or after the expiry of ``t``.

    Work is split by (key, slot of about a thousandth of a TTL): in the expiry's slot one ordered pass finds the
    successor. If the slot has none later, it is the first time of a later slot of
    the bucket, or else of a later bucket, each read from a table with one row per
    slot or bucket. So no task orders more of a key than one slot's rows.
    """
    width = max(1, ttl // FINE)
    expires = F.col("t") + ttl
    real = times.select("_key", F.floor(F.col("t") / width).alias("f"), "t", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("src"))
    expiry = times.select("_key", F.floor(expires / width).alias("f"), expires.alias("t"), F.lit(0).alias("kind"), F.col("t").alias("src"))
    both = real.unionByName(expiry)
    down = Window.partitionBy("_key", "f").orderBy(F.col("t").desc(), F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, 0)
    near = (
        both.withColumn("nxt", F.last(F.when(F.col("kind") == 1, F.col("t")), ignorenulls=True).over(down))
        .where("kind = 0")
        .select("_key", "f", F.col("src").alias("t"), "nxt")
    )
    slots = both.groupBy("_key", "f").agg(F.min(F.when(F.col("kind") == 1, F.col("t"))).alias("_first"))
    slots = slots.withColumn("b", F.floor(F.col("f") / FINE))
    next_slot = Window.partitionBy("_key", "b").orderBy("f").rowsBetween(1, Window.unboundedFollowing)
    next_bucket = Window.partitionBy("_key").orderBy("b").rowsBetween(1, Window.unboundedFollowing)
    buckets = slots.groupBy("_key", "b").agg(F.min("_first").alias("_top"))
    buckets = buckets.select("_key", "b", F.first("_top", ignorenulls=True).over(next_bucket).alias("_far"))
    fallback = (
        slots.withColumn("_mid", F.first("_first", ignorenulls=True).over(next_slot))
        .join(buckets, ["_key", "b"])
        .select("_key", "f", F.coalesce("_mid", "_far").alias("_later"))
    )
    return near.join(fallback, ["_key", "f"], "left").select("_key", "t", F.coalesce("nxt", "_later").alias("nxt"))


def _doubled_chain(times: DataFrame, ttl: int) -> DataFrame:
    """Reachability from each key's first time; the number of rounds is the logarithm of the chain length."""
    jump = materialize(_successors(times, ttl).where(F.col("nxt").isNotNull()), "jump")
    reached = times.groupBy("_key").agg(F.min("t").alias("t"))
    reached = materialize(reached, "reached")
    while True:
        new = materialize(reached.join(jump, ["_key", "t"]).select("_key", F.col("nxt").alias("t")), "reached-new")
        if new.isEmpty():
            break
        reached = materialize(reached.unionByName(new), "reached")
        onward = jump.select("_key", F.col("t").alias("nxt"), F.col("nxt").alias("_n2"))
        jump = materialize(jump.join(onward, ["_key", "nxt"]).select("_key", "t", F.col("_n2").alias("nxt")), "jump")
    return times.join(reached, ["_key", "t"], "left_semi").select("_key", "t", "rid")
