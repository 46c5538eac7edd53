"""DuckDB statements that compute the same results as the queries, over whole tables."""

from __future__ import annotations

from millrace.functions import fixed
from millrace.sources.tables import DOCUMENT_QUESTION, PROMPT_ANSWER


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def places(e: str, n: int) -> str:
    """A quotient at n places by the double's exact value: the tie is decided on exact integers."""
    c = 2 * 10**n
    # a double is a whole number of 2**-60 parts here once its integer part is taken off
    return f"""list_transform([CAST({e} AS DOUBLE)], lambda x: CASE
  WHEN CAST(round_even(x * {c}, 0) AS BIGINT) % 2 = 1 AND x = round_even(x * {c}, 0) / {c}.0::DOUBLE
    AND CAST((x - floor(x)) * 1152921504606846976.0::DOUBLE AS HUGEINT) * {c} <> (CAST(round_even(x * {c}, 0) AS HUGEINT) - CAST(floor(x) AS HUGEINT) * {c}) * 1152921504606846976::HUGEINT
  THEN (CAST(round_even(x * {c}, 0) AS BIGINT) + CASE WHEN CAST((x - floor(x)) * 1152921504606846976.0::DOUBLE AS HUGEINT) * {c}
    > (CAST(round_even(x * {c}, 0) AS HUGEINT) - CAST(floor(x) AS HUGEINT) * {c}) * 1152921504606846976::HUGEINT THEN 1 ELSE -1 END) / 2 / {c // 2}.0::DOUBLE
  ELSE round_even(x, {n}) END)[1]"""


def in_list(items) -> str:
    return "(" + ", ".join(lit(i) for i in items) + ")"


SYSTEM_PROMPT = "You are a helpful and precise assistant."
NEAR = 0.7

# ---------------------------------------------------------------- pair views

DOC_ANSWERS = f"""
pairs AS (SELECT doc_id AS pos, {lit(DOCUMENT_QUESTION)} AS question, text AS answer, lang AS category, source FROM documents)"""
DOC_PROMPTS = f"""
pairs AS (SELECT doc_id AS pos, text AS question, {lit(PROMPT_ANSWER)} AS answer, lang AS category, source FROM documents)"""
CONV_PAIRS = """
pairs AS (
  SELECT a.conv_id * 2147483648 + a.turn AS pos,
         'conv.' || a.conv_id || '.' || a.turn AS id, a.text AS question, b.text AS answer,
         CASE WHEN a.turn < 2 THEN 'opening' ELSE 'follow_up' END AS category
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""

# ---------------------------------------------------------------- quality

REFUSALS = " OR ".join(f"contains(lower(answer), {lit(p)})" for p in fixed.REFUSAL_PHRASES)
BLOCKED = " + ".join(f"CAST(contains(lower(question || ' ' || answer), {lit(t)}) AS INT)" for t in fixed.BLOCKED_TERMS)
ECHO = lit(fixed.ECHO_STRIP)
LANG = lit(fixed.LANGUAGE_STRIP)
REASONS = rf"""
worded AS (
  SELECT *, regexp_extract_all(question, '\S+') AS qw, regexp_extract_all(answer, '\S+') AS aw FROM pairs),
measured AS (
  SELECT *, len(qw) AS nq, len(aw) AS na,
    list_distinct(list_transform(qw, lambda x: trim(lower(x), {ECHO}))) AS qs,
    list_distinct(list_transform(aw, lambda x: trim(lower(x), {ECHO}))) AS ans,
    CASE WHEN len(aw) >= 9 THEN
      3.0 * list_max(map_values(list_histogram(list_transform(range(1, len(aw) - 1),
        lambda i: aw[i] || ' ' || aw[i + 1] || ' ' || aw[i + 2])))) / len(aw) ELSE 0 END AS top3,
    len(list_filter(aw, lambda x: length(x) > 2 AND upper(x) = x AND lower(x) <> x)) AS caps,
    (length(answer) - length(replace(answer, '#', ''))) + (length(answer) - length(replace(answer, '...', ''))) / 3.0
      + (length(answer) - length(replace(answer, '…', ''))) AS symbols,
    list_sum(list_transform(aw, lambda x: length(x))) AS chars,
    len(list_filter(aw, lambda x: trim(lower(x), {LANG}) IN {in_list(fixed.STOPWORDS)})) AS stops,
    rtrim(answer, E' \t\n\r\x0b\x0c') AS tail
  FROM worded),
judged AS MATERIALIZED (
  SELECT *, CASE
    WHEN nq = 0 THEN 'empty_question' WHEN na = 0 THEN 'empty_answer'
    WHEN nq NOT BETWEEN 3 AND 1200 THEN 'question_length'
    WHEN na NOT BETWEEN 5 AND 800 THEN 'answer_length'
    WHEN {REFUSALS} THEN 'refusal'
    WHEN len(list_intersect(ans, qs)) / len(ans) > 0.9 THEN 'question_echo'
    WHEN top3 > 0.25 THEN 'repetition'
    WHEN caps / na > 0.4 THEN 'all_caps'
    WHEN symbols / na > 0.2 THEN 'symbol_ratio'
    WHEN chars / na NOT BETWEEN 2.5 AND 12 THEN 'mean_word_length'
    WHEN stops < 2 THEN 'not_english'
    WHEN NOT regexp_matches(tail, '([.!?"'')\]}}:;]|```|\d)$') THEN 'truncated'
    WHEN {BLOCKED} > 0 THEN 'blocklist'
    ELSE 'ok' END AS reason
  FROM measured)"""

BREAKDOWN = """
SELECT CASE WHEN grouping(reason) = 1 THEN 'all' WHEN grouping(category) = 1 THEN 'reason' ELSE 'category_reason' END AS level,
       category, reason, count(*) AS n
FROM {0} GROUP BY GROUPING SETS ((), (reason), (category, reason))"""

# ---------------------------------------------------------------- redaction

DIGIT_PATTERNS = [(label, pattern) for label, pattern in fixed.PII_PATTERNS]


def redact(field: str, style: str = "bracket") -> tuple[str, str]:
    """(redacted text, labels) expressions over a text expression."""
    expr, flags = field, []
    for label, pattern in DIGIT_PATTERNS:
        name = label if style == "bracket" else fixed.PII_ENTITY_NAMES[label]
        mark = f"[{label}]" if style == "bracket" else f"<{name}>"
        after = f"regexp_replace({expr}, {lit(pattern)}, {lit(mark)}, 'g')"
        flags.append(f"CASE WHEN regexp_matches({expr}, {lit(pattern)}) THEN {lit(name)} END")
        expr = after
    return expr, f"concat_ws(',', {', '.join(flags)})"


def norm(field: str) -> str:
    """Dedup normal form."""
    return rf"regexp_replace(regexp_replace(trim(lower({field}), E' \t\n\r\x0b\x0c'), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g')"


def leak_norm(field: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({field}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'), '\s+', ' ', 'g'))"


def shingled(src: str) -> str:
    return f"""
toks AS (SELECT *, list_filter(string_split({norm('question')}, ' '), lambda x: x <> '') AS t FROM {src}),
sh AS MATERIALIZED (
  SELECT pos, array_to_string(t[1:4], ' ') AS block,
    list_distinct(CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])
      ELSE [array_to_string(t, ' ')] END) AS s
  FROM toks)"""

# Greedy keep-first: rows with an earlier similar row, decided one after the other in order.
GREEDY = f"""
edges AS MATERIALIZED (
  SELECT a.pos AS a, b.pos AS b FROM sh a JOIN sh b ON a.block = b.block AND a.pos < b.pos
  WHERE len(list_intersect(a.s, b.s)) >= {NEAR} * (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s)))),
late AS MATERIALIZED (SELECT b, list(a) AS before, row_number() OVER (ORDER BY b) AS i FROM edges GROUP BY b),
walk AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS dropped
  UNION ALL
  SELECT late.i, CASE WHEN len(list_filter(late.before, lambda x: NOT list_contains(walk.dropped, x))) > 0
    THEN list_append(walk.dropped, late.b) ELSE walk.dropped END
  FROM walk JOIN late ON late.i = walk.i + 1),
gone AS (SELECT unnest(dropped) AS pos FROM (SELECT dropped FROM walk ORDER BY i DESC LIMIT 1))"""

def exact(src: str) -> str:
    return f"""
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {norm('question')} ORDER BY pos) AS rn FROM {src})"""


def curation(pairs: str) -> str:
    """The job up to one final reason per row, as CTEs ending in ``final``."""
    rq, fq = redact("question")
    ra, fa = redact("answer")
    return f"""WITH RECURSIVE {pairs}, {REASONS},
red AS (SELECT pos, category, {rq} AS question, {ra} AS answer, {fq} AS found_q, {fa} AS found_a FROM judged WHERE reason = 'ok'),
{exact('red')},
uniq AS (SELECT * FROM numbered WHERE rn = 1),
{shingled('uniq')}, {GREEDY},
final AS (
  SELECT pos, category, reason FROM judged WHERE reason <> 'ok'
  UNION ALL SELECT pos, category, CASE WHEN rn > 1 THEN 'exact_dup' WHEN pos IN (SELECT pos FROM gone) THEN 'near_dup' ELSE 'ok' END
  FROM numbered)"""


def sha(seed: int, field: str) -> str:
    return f"sha256('{seed}|' || {field})"


# ---------------------------------------------------------------- dataset

SIZES = """
counts AS (SELECT category, count(*) AS n FROM {src} GROUP BY category),
raw AS (SELECT *, greatest(1, CAST(round_even(n * 0.10, 0) AS BIGINT)) AS v, greatest(1, CAST(round_even(n * 0.05, 0) AS BIGINT)) AS t FROM counts),
lack AS (SELECT *, greatest(0, 1 - (n - v - t)) AS d FROM raw),
cut AS (SELECT *, greatest(1, v - d) AS v2 FROM lack),
sized AS (
  SELECT category, n,
    CASE WHEN n = 1 THEN 0 WHEN n = 2 THEN 1 ELSE v2 END AS n_val,
    CASE WHEN n <= 2 THEN 0 ELSE greatest(1, t - (d - (v - v2))) END AS n_test
  FROM cut),
sizes AS (SELECT category, n, CAST(n - n_val - n_test AS BIGINT) AS n_train, CAST(n_val AS BIGINT) AS n_val, CAST(n_test AS BIGINT) AS n_test FROM sized)"""


def split_ctes(src: str, row_id: str) -> str:
    return f"""{SIZES.format(src=src)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY {sha(42, row_id)}, {row_id}) AS rn FROM {src}),
splits AS (
  SELECT r.*, CASE WHEN rn <= n_train THEN 'train' WHEN rn <= n_train + n_val THEN 'val' ELSE 'test' END AS split
  FROM ranked r JOIN sizes USING (category))"""


# ---------------------------------------------------------------- evaluation

GOLDEN = r"""
words AS (SELECT item_id, text, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
golden AS (
  SELECT item_id AS case_id, text AS question, list_transform(w[1:2], lambda x: x || '[ ,.]') AS must,
         [w[-1] || '[.]'] AS banned, coalesce(CASE WHEN item_id % 5 > 0 THEN 'c' || (item_id % 5) END, 'uncategorized') AS category
  FROM words),
answers AS (SELECT source AS model, doc_id % (SELECT count(*) FROM benchmark) AS case_id, text AS answer FROM documents),
judged AS MATERIALIZED (
  SELECT model, case_id, question, answer, category, must, hits,
    (len(must) = 0 OR len(list_filter(must, lambda p: regexp_matches(answer, p, 'i'))) > 0) AND len(hits) = 0 AS passed
  FROM (SELECT *, list_filter(banned, lambda p: regexp_matches(answer, p, 'i')) AS hits FROM answers JOIN golden USING (case_id)))"""

RATES = f"""
SELECT model, category, count(*) AS total, CAST(sum(CAST(passed AS INT)) AS BIGINT) AS passed,
       {places('sum(CAST(passed AS INT)) / count(*)', 4)} AS pass_rate, grouping(category) = 1 AS overall
FROM {{src}} GROUP BY GROUPING SETS ((model), (model, category))"""

LABEL_RATES = f"""
lab AS (SELECT d.source AS model, d.lang AS category, l.quality = 1 AS passed, l.toxic = 0 AS base FROM labels l JOIN documents d USING (doc_id)),
rates AS ({RATES.format(src='lab')}),
base AS (SELECT model, {places('sum(CAST(base AS INT)) / count(*)', 4)} AS baseline_rate FROM lab GROUP BY model)"""


def pct(e: str) -> str:
    return f"CAST(CAST(round_even(({e}) * 100, 0) AS INT) AS VARCHAR) || '%'"


# ---------------------------------------------------------------- request log

K = "CAST(json_extract(props, '$.k') AS INT)"


def mod100(client: str) -> str:
    digits = ", ".join(f"('0x' || substr(sha256({client}), {8 * i + 1}, 8))::BIGINT" for i in range(8))
    return f"list_reduce([0::BIGINT, {digits}], lambda a, x: (a * 96 + x) % 100)"


LOG = f"""
log AS (
  SELECT event_id AS request_id, ts, 'user:' || user_id AS client, '/v1/chat' AS route, event_type, value, {K} AS k,
         value / 100 AS latency_s, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status
  FROM events)"""

ROUTED = f"""{LOG},
routed AS (SELECT *, CASE WHEN {mod100('client')} < 10 THEN 'canary' ELSE 'stable' END AS variant FROM log)"""

OUTCOMES = f"""{ROUTED},
facts AS (
  SELECT *, k >= 2 AS authorized, k NOT IN (2, 3) AS valid, value > 300 AS too_large,
    CASE WHEN k = 4 THEN 'prompt_injection' WHEN k = 5 THEN 'pii_email' ELSE '' END AS input_reason,
    k BETWEEN 6 AND 9 AS stream, k BETWEEN 20 AND 29 AS cache_hit,
    CASE WHEN event_type <> 'error' THEN 'ok' WHEN k % 3 = 0 THEN 'timeout' WHEN k % 3 = 1 THEN 'unavailable' ELSE 'error' END AS upstream,
    CASE WHEN k = 10 THEN 'banned_placeholder' ELSE '' END AS output_reason
  FROM routed),
limited AS (
  SELECT *, CASE WHEN authorized AND valid AND NOT too_large THEN
      row_number() OVER (PARTITION BY client, date_trunc('minute', ts), authorized AND valid AND NOT too_large ORDER BY ts, request_id) <= 1
    ELSE true END AS quota_ok
  FROM facts),
named AS (
  SELECT *, CASE WHEN NOT authorized THEN 'unauthorized' WHEN NOT valid THEN 'invalid' WHEN too_large THEN 'too_large'
    WHEN NOT quota_ok THEN 'rate_limited' WHEN input_reason <> '' THEN 'input_blocked' WHEN stream THEN 'stream'
    WHEN cache_hit THEN 'cache_hit' WHEN upstream = 'timeout' THEN 'timeout' WHEN upstream = 'unavailable' THEN 'unavailable'
    WHEN upstream <> 'ok' THEN 'engine_error' WHEN output_reason <> '' THEN 'output_blocked' ELSE 'ok' END AS outcome
  FROM limited),
classified AS (
  SELECT *, CASE outcome WHEN 'unauthorized' THEN 401 WHEN 'invalid' THEN 422 WHEN 'too_large' THEN 413 WHEN 'rate_limited' THEN 429
      WHEN 'input_blocked' THEN 400 WHEN 'timeout' THEN 504 WHEN 'unavailable' THEN 503 WHEN 'engine_error' THEN 502
      WHEN 'output_blocked' THEN 502 ELSE 200 END AS http_status,
    outcome NOT IN ('unauthorized', 'invalid', 'too_large', 'stream') AS counted,
    CASE WHEN outcome IN ('rate_limited', 'input_blocked') THEN 'none' ELSE variant END AS label_variant,
    outcome IN ('ok', 'cache_hit') AS latency_observed,
    CASE WHEN outcome = 'engine_error' THEN 'error' WHEN outcome IN ('timeout', 'unavailable') THEN outcome END AS upstream_error
  FROM named)"""

PARAMS = f"""{LOG},
params AS (
  SELECT *, CASE WHEN k % 3 > 0 THEN k * 10 + 1 END AS max_tokens,
    CASE WHEN k % 4 = 0 THEN 0.0::DOUBLE WHEN k % 4 = 1 THEN k / 40.0::DOUBLE END AS temperature,
    CASE WHEN k % 5 > 0 THEN k / 80.0::DOUBLE END AS top_p,
    CASE WHEN k % 2 = 0 THEN 'Bearer secret-' || client || '-0123456789' END AS auth,
    CASE WHEN k % 3 = 0 THEN client END AS host
  FROM log)"""

TTL = "INTERVAL 3600 SECOND"


def cache_sql(stores: str) -> str:
    """Cache results, one chain of storing misses per key."""
    return f"""{LOG},
storing AS (SELECT CAST(k AS VARCHAR) AS ck, ts, min(request_id) AS rid FROM log WHERE {stores} GROUP BY ALL),
chain AS (
  SELECT ck, arg_min(struct_pack(ts := ts, rid := rid), ts) AS m FROM storing GROUP BY ck
  UNION ALL
  SELECT c.ck, (SELECT arg_min(struct_pack(ts := s.ts, rid := s.rid), s.ts) FROM storing s WHERE s.ck = c.ck AND s.ts >= c.m.ts + {TTL}) AS m
  FROM chain c WHERE c.m IS NOT NULL),
kept AS (SELECT ck, m.ts AS mts, m.rid AS mid FROM chain WHERE m IS NOT NULL),
cached AS (
  SELECT l.request_id, CASE WHEN k.mts IS NOT NULL AND (l.ts > k.mts OR l.request_id > k.mid) THEN 'hit' ELSE 'miss' END AS cache_result
  FROM log l LEFT JOIN kept k ON CAST(l.k AS VARCHAR) = k.ck AND l.ts >= k.mts AND l.ts < k.mts + {TTL})"""


BOUNDS = [*[repr(b) for b in fixed.LATENCY_BOUNDS], "'inf'::DOUBLE"]


def histogram(src: str, labels: list[str], value: str = "latency_s") -> str:
    keys = ", ".join(labels)
    return f"""SELECT {keys}, le, CAST(count(*) FILTER ({value} <= le) AS BIGINT) AS n
FROM {src} CROSS JOIN (SELECT unnest([{', '.join(BOUNDS)}]) AS le) GROUP BY {keys}, le"""


def quantiles(hist: str, labels: list[str], qs: list[float]) -> str:
    keys = ", ".join(labels)
    return f"""SELECT {keys}, q, CASE WHEN le = 'inf'::DOUBLE THEN lo ELSE lo + (le - lo) * CASE WHEN n = below THEN NULL ELSE (q * total - below) / (n - below) END END AS value
FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}, q ORDER BY le) AS r FROM (
    SELECT *, coalesce(lag(n) OVER (PARTITION BY {keys} ORDER BY le), 0) AS below,
      coalesce(lag(le) OVER (PARTITION BY {keys} ORDER BY le), 0.0) AS lo, max(n) OVER (PARTITION BY {keys}) AS total
    FROM ({hist})) CROSS JOIN (SELECT unnest({qs}) AS q) WHERE n >= q * total AND total > 0)
WHERE r = 1"""


def sliding(src: str, labels: list[str], width: int) -> str:
    keys = "".join(f"{k}, " for k in labels)
    return f"""SELECT {keys}epoch(m)::BIGINT + 60 * i AS window_end, count(*) AS n
FROM (SELECT *, date_trunc('minute', ts) AS m FROM {src}) CROSS JOIN (SELECT unnest(range(1, {width + 1})) AS i) GROUP BY {keys}window_end"""


COUNTED = f"""{OUTCOMES},
requests AS (SELECT * EXCLUDE (variant, status), label_variant AS variant, http_status AS status FROM classified WHERE counted),
observed AS (SELECT * FROM classified WHERE latency_observed)"""


def signals(every: int = 1) -> str:
    """Alert signals and stretches; the gauge's last reading is looked up for every minute."""
    return f"""{COUNTED},
ends AS (SELECT *, epoch(date_trunc('minute', ts))::BIGINT + 60 * i AS minute FROM requests CROSS JOIN (SELECT unnest(range(1, 6)) AS i)),
per AS (
  SELECT minute, count(*) AS n, count(*) FILTER (status >= 500) AS bad, count(*) FILTER (variant = 'canary') AS cn,
    count(*) FILTER (variant = 'canary' AND status >= 500) AS cb
  FROM ends GROUP BY minute),
seen AS (SELECT * FROM ends WHERE latency_observed),
hist AS ({histogram('seen', ['minute'])}),
p95 AS ({quantiles('SELECT * FROM hist', ['minute'], [0.95])}),
read AS (
  SELECT epoch(date_trunc('minute', ts))::BIGINT AS minute, last(CASE WHEN status = 200 THEN 1.0 ELSE 0.0 END ORDER BY ts, request_id) AS value
  FROM log WHERE event_type IN ('click', 'error') AND request_id % {every} = 0 GROUP BY 1),
every_minute AS (SELECT unnest(range((SELECT min(minute) FROM read), (SELECT greatest(max(per.minute), (SELECT max(minute) FROM read)) FROM per) + 60, 60)) AS minute),
up AS (SELECT e.minute, r.value FROM every_minute e ASOF JOIN read r ON e.minute >= r.minute),
signals AS (
  SELECT 'HighErrorRate' AS alert, minute, bad / n AS value, bad / n > 0.25 AS breached, 2::BIGINT AS hold_min FROM per
  UNION ALL SELECT 'CanaryErrorsHigh', minute, CASE WHEN cn > 0 THEN cb / cn END, coalesce(CASE WHEN cn > 0 THEN cb / cn END > 0.25, false), 2 FROM per
  UNION ALL SELECT 'HighLatencyP95', minute, value, coalesce(value > 1.5, false), 2 FROM p95
  UNION ALL SELECT 'UpstreamDown', minute, value, value = 0, 2 FROM up),
islands AS (
  SELECT *, minute / 60 - row_number() OVER (PARTITION BY alert ORDER BY minute) AS island FROM signals WHERE breached),
firing AS (
  SELECT alert, min(minute) AS started, max(minute) AS ended, min(minute) + 60 * hold_min AS fired_at
  FROM islands GROUP BY alert, island, hold_min HAVING max(minute) >= min(minute) + 60 * hold_min)"""


SIGNALS = signals()


def screen_sql(field: str) -> str:
    injection = "|".join(f"({p})" for p in fixed.INJECTION_PATTERNS)
    pii = " ".join(
        f"WHEN regexp_matches({field}, {lit(p)}) THEN {lit('pii_' + kind)}" for kind, p in fixed.REQUEST_PII_PATTERNS
    )
    return f"CASE WHEN regexp_matches(lower({field}), {lit(injection)}) THEN 'prompt_injection' {pii} ELSE '' END"


PLACEHOLDERS = lit("|".join(fixed.BANNED_PLACEHOLDERS))

SIGNALS_PER_MODEL = f"""{LOG},
lab AS (SELECT d.lang AS model, l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id)),
rate AS (SELECT model, round_even(avg(quality::DOUBLE), 4) AS golden_pass_rate, round_even(avg(1.0::DOUBLE - toxic), 4) AS baseline_pass_rate,
  count(*) AS new_labelled_examples FROM lab GROUP BY model),
slot AS (SELECT *, CASE k % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'en' WHEN 2 THEN 'es' ELSE 'fr' END AS model FROM log),
traffic AS (SELECT model, count(*) FILTER (status >= 500) / count(*) AS error_rate,
  count(*) FILTER (event_type IN ('view', 'click')) / count(*) AS unknown_topic_rate FROM slot GROUP BY model),
slow AS ({quantiles(histogram('slot', ['model'], 'value'), ['model'], [0.95])}),
drift AS (
  SELECT model, golden_pass_rate, baseline_pass_rate, coalesce(error_rate, 0) AS error_rate, coalesce(slow.value, 0) AS p95_latency_s,
    new_labelled_examples, coalesce(unknown_topic_rate, 0) AS unknown_topic_rate
  FROM rate LEFT JOIN traffic USING (model) LEFT JOIN slow USING (model))"""

KNN = """
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ranked AS (SELECT q.vec_id AS query_id, c.vec_id AS id, pow(list_distance(q.e, c.e), 2) AS d FROM v q CROSS JOIN v c WHERE q.vec_id % 50 = 0),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, id) AS rank FROM ranked) WHERE rank <= 3)"""


def _rendered(question: str, answer: str) -> str:
    return f"'<|system|>' || {lit(SYSTEM_PROMPT)} || '<|end|><|user|>' || {question} || '<|end|><|assistant|>' || {answer} || '<|end|>'"


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    o["corpus_sample"] = f"""
SELECT lang || '.' || doc_id AS id, source AS question, md5(text) AS answer_md5, '' AS orig_system_prompt, lang AS category, 'documents' AS source
FROM documents WHERE lang IN ('en', 'fr', 'de') ORDER BY {sha(42, "lang || '.' || doc_id")} LIMIT 300"""
    o["stream_corpus_sample"] = o["corpus_sample"]
    o["ingest_counts"] = "SELECT lang AS category, count(*) AS n FROM documents GROUP BY lang"

    o["local_pairs"] = """
SELECT lang || '.' || doc_id AS id, md5(text) AS question_md5, source AS answer, '' AS orig_system_prompt, lang AS category FROM documents"""
    o["golden_roundtrip"] = f"""WITH {GOLDEN}
SELECT row_number() OVER (ORDER BY case_id) - 1 AS case_id, question, array_to_string(must, '|') AS must, array_to_string(banned, '|') AS banned,
  nullif(category, 'uncategorized') AS category FROM golden"""
    o["kb_roundtrip"] = """
SELECT CASE WHEN doc_id % 10 > 0 THEN 'kb-' || doc_id ELSE '' END AS id, count(*) AS n, max(md5(text)) AS last_md5 FROM documents GROUP BY 1"""
    o["chat_roundtrip"] = f"""WITH {CONV_PAIRS}, {split_ctes('pairs', 'id')}
SELECT split, category, md5('[{{"role":"system","content":' || to_json({lit(SYSTEM_PROMPT)}) || '}},{{"role":"user","content":' || to_json(question)
  || '}},{{"role":"assistant","content":' || to_json(answer) || '}}]') AS messages_md5 FROM splits"""
    _, found = redact("text")
    o["report_roundtrip"] = f"""WITH {DOC_ANSWERS}, {REASONS}
SELECT 'documents' AS source_mode, count(*) AS input_records, count(*) FILTER (reason = 'ok') AS kept,
  {places("count(*) FILTER (reason = 'ok') / greatest(count(*), 1)", 3)} AS survival_rate,
  count(DISTINCT reason) FILTER (reason <> 'ok') AS reasons, (SELECT count(*) FILTER ({found} <> '') FROM documents) AS records_with_pii_scrubbed FROM judged"""
    o["quality_reasons"] = f"WITH {DOC_ANSWERS}, {REASONS} SELECT pos AS doc_id, reason FROM judged"
    o["quality_conversations"] = f"WITH {CONV_PAIRS}, {REASONS} SELECT pos, category, reason FROM judged"
    o["quality_accepted"] = f"WITH {DOC_ANSWERS}, {REASONS} SELECT pos AS doc_id, category, md5(answer) AS answer_md5 FROM judged WHERE reason = 'ok'"
    o["quality_report"] = f"WITH {DOC_ANSWERS}, {REASONS} {BREAKDOWN.format('judged')}"
    o["survival"] = f"""WITH {DOC_ANSWERS}, {REASONS}
SELECT count(*) AS input_records, count(*) FILTER (reason = 'ok') AS kept,
  {places("count(*) FILTER (reason = 'ok') / greatest(count(*), 1)", 3)} AS survival_rate FROM judged"""
    o["kept_categories"] = f"WITH {DOC_ANSWERS}, {REASONS} SELECT category, count(*) AS n FROM judged WHERE reason = 'ok' GROUP BY category"
    for name, style in (("pii_redacted", "bracket"), ("pii_entities", "entity")):
        r, f = redact("text", style)
        o[name] = f"SELECT doc_id, md5({r}) AS text_md5, {f} AS labels FROM documents"
    _, fq = redact(f"({lit(DOCUMENT_QUESTION)} || ' ' || text)")
    _, fa = redact("text")
    hits = " UNION ALL ".join(
        f"SELECT '{label}' AS entity, CAST(sum(CAST(list_contains(q, '{label}') AS INT) + CAST(list_contains(a, '{label}') AS INT)) AS BIGINT) AS n FROM found"
        for label, _ in fixed.PII_PATTERNS
    )
    o["pii_counts"] = f"""WITH found AS (SELECT string_split({fq}, ',') AS q, string_split({fa}, ',') AS a FROM documents)
SELECT 'records' AS entity, count(*) FILTER (q <> [''] OR a <> ['']) AS n FROM found UNION ALL {hits}"""
    o["exact_dedup"] = f"WITH {DOC_PROMPTS}, {exact('pairs')} SELECT pos AS doc_id, rn > 1 AS exact_dup FROM numbered"
    o["shingle_profile"] = f"WITH {DOC_PROMPTS}, {shingled('pairs')} SELECT pos AS doc_id, block, CAST(len(s) AS BIGINT) AS n_shingles FROM sh"
    o["shingle_overlap"] = f"""WITH {DOC_PROMPTS}, {shingled('pairs')}
SELECT a.pos AS doc_id, round_even(len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s) - len(list_intersect(a.s, b.s))), 6) AS jaccard
FROM sh a JOIN sh b ON b.pos = a.pos + 1"""
    o["near_dedup_kept"] = f"""WITH RECURSIVE {DOC_PROMPTS}, {exact('pairs')}, uniq AS (SELECT * FROM numbered WHERE rn = 1),
{shingled('uniq')}, {GREEDY} SELECT pos AS doc_id, pos IN (SELECT pos FROM gone) AS near_dup FROM uniq"""
    o["curation_outcomes"] = f"{curation(DOC_PROMPTS)} SELECT pos AS doc_id, category, reason FROM final"
    pii_rows = " UNION ALL ".join(
        f"SELECT 'pii', NULL, '{label}', CAST(coalesce(sum(CAST(list_contains(string_split(found_q, ','), '{label}') AS INT) + CAST(list_contains(string_split(found_a, ','), '{label}') AS INT)), 0) AS BIGINT) FROM red"
        for label, _ in fixed.PII_PATTERNS
    )
    o["curation_report"] = f"""{curation(CONV_PAIRS)} {BREAKDOWN.format('final')}
UNION ALL SELECT 'pii', NULL, 'records', count(*) FILTER (found_q <> '' OR found_a <> '') FROM red UNION ALL {pii_rows}"""
    o["review_sample"] = f"""WITH {DOC_ANSWERS}, {REASONS}
SELECT pos AS doc_id, category FROM judged WHERE reason = 'ok' ORDER BY {sha(42, 'pos')}, pos LIMIT 50"""

    o["chat_examples"] = f"""WITH {CONV_PAIRS}
SELECT id, category, {_rendered('question', 'answer')} AS text FROM pairs
UNION ALL SELECT 'honesty.' || item_id, 'honesty', {_rendered('text', lit('I do not know.'))} FROM benchmark"""
    o["validation_errors"] = """
WITH triples AS (
  SELECT a.conv_id * 2147483648 + a.turn AS line_no, a.role AS r0, c.role AS r2, c.text AS last, [a.role, b.role, c.role] AS roles,
    [length(a.text), length(b.text), length(c.text)] AS sizes, CASE WHEN a.turn < 3 THEN 'early' ELSE '' END AS category
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
  JOIN conversations c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2),
shape AS (
  SELECT *, list_filter([
    CASE WHEN len(list_filter(roles, lambda r: r NOT IN ('system', 'user', 'assistant'))) > 0 THEN 'role: must be system, user or assistant' END,
    CASE WHEN list_min(sizes) < 1 THEN 'content: a non-empty string is required' END,
    CASE WHEN category = '' THEN 'category: a non-empty string is required' END], lambda x: x IS NOT NULL) AS s,
    list_filter([
    CASE WHEN r0 <> 'system' THEN 'first message must be system, got ' || r0 END,
    CASE WHEN r2 <> 'assistant' THEN 'last message must be assistant, got ' || r2 END,
    CASE WHEN trim(last) = '' THEN 'empty assistant content' END], lambda x: x IS NOT NULL) AS r
  FROM triples),
errs AS (SELECT line_no, CASE WHEN len(s) > 0 THEN s ELSE r END AS e FROM shape)
SELECT line_no, CAST(i - 1 AS BIGINT) AS error_no, e[i] AS error FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM errs)"""
    o["validation_lines"] = """
SELECT doc_id AS line_no, CASE WHEN n_chars < 100 THEN 'not valid JSON' ELSE concat_ws('; ',
  CASE WHEN lang = 'de' THEN 'role: must be system, user or assistant' END,
  CASE WHEN lang = 'es' THEN 'content: a non-empty string is required' END,
  CASE WHEN n_chars > 2000 THEN 'category: a non-empty string is required' END) END AS errors
FROM documents"""
    o["validation_verdict"] = f"""WITH {CONV_PAIRS}
SELECT count(*) AS examples, CAST(count(*) FILTER (trim(answer) = '') + count(*) FILTER (question = '') AS BIGINT) AS errors FROM pairs"""
    o["split_sizes"] = f"WITH {DOC_PROMPTS}, {SIZES.format(src='pairs')} SELECT category, n, n_train, n_val, n_test FROM sizes"
    o["split_rows"] = f"WITH {DOC_PROMPTS}, {split_ctes('pairs', 'pos')} SELECT pos AS doc_id, category, split FROM splits"
    o["leakage"] = f"""WITH {DOC_PROMPTS}, {split_ctes('pairs', 'pos')}
SELECT md5(key) AS key_md5, CAST(count(DISTINCT split) - 1 AS BIGINT) AS leaks FROM (SELECT {leak_norm('question')} AS key, split FROM splits)
GROUP BY key HAVING count(DISTINCT split) > 1"""
    spans = f"""
told AS (SELECT item_id AS item, list_filter(string_split({norm('text')}, ' '), lambda x: x <> '') AS t FROM benchmark),
sized AS (SELECT item, t, CAST(least(len(t), 5) AS BIGINT) AS w FROM told WHERE len(t) > 0),
runs AS MATERIALIZED (
  SELECT DISTINCT item, w, r FROM (SELECT item, w, unnest(list_transform(range(1, len(t) - w + 2), lambda i: array_to_string(t[i:i + w - 1], ' '))) AS r FROM sized)),
totals AS (SELECT item, count(*) AS size FROM runs GROUP BY item),
said AS (SELECT doc_id, list_filter(string_split({norm('text')}, ' '), lambda x: x <> '') AS t FROM documents),
ws AS (SELECT DISTINCT w FROM runs),
places AS (SELECT doc_id, w, t, unnest(range(1, len(t) - w + 2)) AS i FROM said CROSS JOIN ws WHERE len(t) >= w),
met AS (
  SELECT p.doc_id, item, r, min(i) - 1 AS a, max(i) + p.w - 2 AS b FROM places p JOIN runs ON runs.w = p.w AND runs.r = array_to_string(t[i:i + p.w - 1], ' ')
  GROUP BY p.doc_id, item, r, p.w),
spans AS MATERIALIZED (
  SELECT doc_id, item AS item_id, count(*) AS shared, any_value(size) AS size, round_even(count(*) / any_value(size), 9) AS share,
    CAST(min(a) AS BIGINT) AS first_word, CAST(max(b) AS BIGINT) AS last_word
  FROM met JOIN totals USING (item) GROUP BY doc_id, item HAVING count(*) >= 0.8::DOUBLE * any_value(size))"""
    o["contamination_spans"] = f"WITH {spans} SELECT * FROM spans"
    o["contamination_clean"] = f"""WITH {spans}
SELECT lang, count(*) AS n, count(*) FILTER (doc_id NOT IN (SELECT doc_id FROM spans)) AS clean FROM documents GROUP BY lang"""
    o["contamination_keys"] = f"""WITH {CONV_PAIRS},
whole AS (SELECT id, question, category FROM pairs UNION ALL SELECT 'honesty.' || item_id, text, 'honesty' FROM benchmark),
{split_ctes('whole', 'id')},
golden AS (SELECT DISTINCT {leak_norm('text')} AS key FROM benchmark),
keyed AS (SELECT s.split, g.key FROM splits s LEFT JOIN golden g ON g.key = {leak_norm('s.question')})
SELECT split, count(*) AS examples, count(key) AS hits, count(DISTINCT key) AS golden FROM keyed GROUP BY split"""
    o["dataset_stats"] = f"""WITH {DOC_PROMPTS}, {split_ctes('pairs', 'pos')}
SELECT CASE WHEN grouping(split) = 0 THEN 'split' WHEN grouping(category) = 0 THEN 'category' ELSE 'all' END AS level,
  coalesce(split, category, 'all') AS name, count(*) AS n, {places('sum(length(question)) / count(*)', 1)} AS avg_answer_chars
FROM splits GROUP BY GROUPING SETS ((), (split), (category))"""
    o["split_presence"] = f"WITH {CONV_PAIRS}, {split_ctes('pairs', 'id')} SELECT split, count(*) AS n FROM splits GROUP BY split"
    o["split_no_ids"] = f"""WITH {DOC_PROMPTS}, {SIZES.format(src='pairs')}
SELECT category, split, n FROM (
  SELECT category, 'train' AS split, n_train AS n FROM sizes UNION ALL SELECT category, 'val', n_val FROM sizes UNION ALL SELECT category, 'test', n_test FROM sizes)
WHERE n > 0"""
    o["corpus_cap_no_ids"] = "SELECT 'unknown' AS category, CAST(least(150, 2 * count(*)) AS BIGINT) AS n FROM documents"
    o["seeded_shuffle"] = f"WITH {CONV_PAIRS} SELECT id, {sha(42, 'id')} AS order_key FROM pairs"
    o["run_board"] = """
WITH l AS (SELECT d.source, avg(1.0::DOUBLE - quality) AS loss, count(*) AS n FROM labels JOIN documents d USING (doc_id) GROUP BY d.source)
SELECT source AS run, n AS r, CASE WHEN n >= 15 THEN round_even(loss, 6) END AS eval_loss, 42 AS seed, 'v1' AS data_version FROM l"""
    o["best_run"] = """
SELECT d.source AS run, round_even(sum(n_chars * (toxic + 1)) / count(*), 6) AS eval_loss
FROM labels JOIN documents d USING (doc_id) GROUP BY d.source ORDER BY eval_loss LIMIT 1"""
    o["generations_pivot"] = "SELECT doc_id // 4 AS prompt, " + ", ".join(
        f"min(md5(text)) FILTER (doc_id % 4 = {i}) AS r{i}" for i in range(4)
    ) + " FROM documents GROUP BY 1"

    o["golden_cases"] = f"""WITH {GOLDEN}
SELECT model, case_id, category, passed, md5(answer) AS answer_md5, array_to_string(hits, '|') AS forbidden_hits, array_to_string(must, '|') AS expected_any FROM judged"""
    o["golden_by_category"] = f"WITH {GOLDEN} {RATES.format(src='judged')}"
    o["golden_failures"] = f"""WITH {GOLDEN}
SELECT model, case_id, question, CASE WHEN len(hits) > 0 THEN 'forbidden' ELSE 'missing' END AS why,
  array_to_string(CASE WHEN len(hits) > 0 THEN hits ELSE must END, '|') AS patterns FROM judged WHERE NOT passed"""
    o["golden_lint"] = f"""WITH {GOLDEN}
SELECT count(*) AS cases, count(*) FILTER (len(must) < 1) AS without_required, count(*) FILTER (banned IS NULL) AS without_ban_list,
  CAST(sum(len(must) + len(banned)) AS BIGINT) AS patterns,
  count(*) >= 20 AND count(*) FILTER (len(must) < 1) = 0 AND count(*) FILTER (banned IS NULL) = 0 AS sound FROM golden"""
    o["gate"] = f"""WITH {LABEL_RATES},
low AS (SELECT model, list('category ''' || category || ''' ' || {pct('pass_rate')} || ' < 50%' ORDER BY category) AS reasons
  FROM rates WHERE NOT overall AND pass_rate < 0.5 GROUP BY model),
d AS (SELECT r.model, r.pass_rate, b.baseline_rate, list_concat(list_filter([
    CASE WHEN r.pass_rate < 0.8 THEN 'pass_rate ' || {pct('r.pass_rate')} || ' < floor 80%' END,
    CASE WHEN r.pass_rate < b.baseline_rate THEN 'pass_rate ' || {pct('r.pass_rate')} || ' < baseline ' || {pct('b.baseline_rate')} || ' (regression)' END],
    lambda x: x IS NOT NULL), coalesce(low.reasons, [])) AS rs
  FROM rates r LEFT JOIN base b USING (model) LEFT JOIN low USING (model) WHERE r.overall)
SELECT model, pass_rate, baseline_rate, len(rs) = 0 AS approved,
  CASE WHEN len(rs) = 0 THEN {lit(fixed.GATE_APPROVED)} ELSE array_to_string(rs, '; ') END AS reasons FROM d"""
    o["low_categories"] = f"WITH {LABEL_RATES} SELECT model, category, pass_rate, pass_rate < 0.5 AS low FROM rates WHERE NOT overall"
    o["threshold_sweep"] = f"""WITH {LABEL_RATES},
m AS (SELECT model, max(pass_rate) FILTER (overall) AS pass_rate, count(*) FILTER (NOT overall AND pass_rate < 0.5) AS low FROM rates GROUP BY model)
SELECT model, floor, pass_rate, pass_rate < floor OR low > 0 AS blocked FROM m CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.8, 0.9, 0.99]) AS floor)"""

    o["request_validity"] = """
WITH f AS (
  SELECT conv_id, count(*) AS n_messages, count(*) FILTER (role NOT IN ('user', 'assistant')) AS bad, count(*) FILTER (length(text) < 1) AS short,
    count(*) FILTER (length(text) > 4000) AS long, CAST(sum(length(text)) AS BIGINT) AS total_chars, arg_max(role, turn) AS last_role
  FROM conversations GROUP BY conv_id)
SELECT conv_id, n_messages, total_chars, last_role, concat_ws(',', CASE WHEN bad > 0 THEN 'role' END, CASE WHEN short > 0 THEN 'content_empty' END,
  CASE WHEN long > 0 THEN 'content_too_long' END, CASE WHEN last_role <> 'user' THEN 'last_not_user' END) AS errors, total_chars > 4000 AS too_large FROM f"""
    o["prompt_assembly"] = f"""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations)
SELECT conv_id, count(*) + 1 AS n, md5('system:' || {lit(SYSTEM_PROMPT)} || chr(10) || string_agg(role || ':' || text, chr(10) ORDER BY turn)) AS prompt_md5
FROM l WHERE r <= 4 GROUP BY conv_id"""
    o["request_params"] = f"""WITH {PARAMS}
SELECT request_id, CASE WHEN starts_with(auth, 'Bearer ') THEN 'key:' || substr(auth, 8, 16) ELSE 'ip:' || coalesce(host, 'unknown') END AS identity,
  concat_ws(',', CASE WHEN max_tokens NOT BETWEEN 1 AND 512 THEN 'max_tokens' END, CASE WHEN temperature NOT BETWEEN 0 AND 2 THEN 'temperature' END,
    CASE WHEN top_p NOT BETWEEN 0 AND 1 THEN 'top_p' END) AS bad,
  CAST(least(coalesce(max_tokens, 256), 512) AS BIGINT) AS max_tokens, round_even(coalesce(temperature, 0.7), 6) AS temperature,
  round_even(coalesce(top_p, 0.9), 6) AS top_p FROM params"""
    o["outcome"] = f"""WITH {OUTCOMES}
SELECT request_id, outcome, CAST(http_status AS BIGINT) AS http_status, counted, label_variant, latency_observed, upstream_error FROM classified"""
    o["log_parse"] = """
SELECT event_type AS event, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END::BIGINT AS status, count(*) AS n,
  CAST(sum(CAST(json_extract(props, '$.k') AS INT)) AS BIGINT) AS ms, min(epoch_us(ts)) AS first_us
FROM events WHERE event_type <> 'signup' GROUP BY 1, 2
UNION ALL SELECT '(bad)', NULL, count(*), NULL, NULL FROM events WHERE event_type = 'signup'"""
    entity, _ = redact("text", "entity")
    o["input_screen"] = f"SELECT doc_id, {screen_sql('text')} AS input_reason FROM documents"
    o["output_screen"] = f"SELECT doc_id, CASE WHEN regexp_matches({entity}, {PLACEHOLDERS}) THEN 'banned_placeholder' ELSE '' END AS output_reason FROM documents"
    o["block_counts"] = f"""
WITH s AS (SELECT {screen_sql('text')} AS i, regexp_matches({entity}, {PLACEHOLDERS}) AS bad FROM documents)
SELECT CASE WHEN i <> '' THEN 'input' ELSE 'output' END AS stage, CASE WHEN i <> '' THEN i ELSE 'banned_placeholder' END AS reason, count(*) AS n
FROM s WHERE i <> '' OR bad GROUP BY 1, 2"""

    o["canary_assignment"] = f"""WITH {LOG}, c AS (SELECT client, count(*) AS n, any_value({mod100('client')}) AS b FROM log GROUP BY client)
SELECT client, n, CASE WHEN b < 10 THEN 'canary' ELSE 'stable' END AS at_10, CASE WHEN b < 50 THEN 'canary' ELSE 'stable' END AS at_50,
  'stable' AS at_0, 'canary' AS at_100 FROM c"""
    o["canary_percent"] = f"""WITH {LOG}, r AS (SELECT CASE WHEN event_type = 'error' THEN 'x' ELSE CAST(k * 2 - 30 AS VARCHAR) END AS raw FROM log)
SELECT raw, count(*) AS n, CAST(greatest(0, least(100, coalesce(TRY_CAST(raw AS INT), 0))) AS BIGINT) AS percent FROM r GROUP BY raw"""
    o["variant_upstream"] = f"""WITH {ROUTED}
SELECT variant, CASE variant WHEN 'canary' THEN 'http://b' ELSE 'http://a' END AS url, CASE variant WHEN 'canary' THEN 'v2' ELSE 'v1' END AS revision,
  'model-a' AS model_name, count(*) AS n FROM routed GROUP BY variant"""
    o["quota_decisions"] = f"""WITH {LOG}, q AS (
  SELECT request_id, row_number() OVER (PARTITION BY client, date_trunc('minute', ts) ORDER BY ts, request_id) AS request_no, date_trunc('minute', ts) AS w FROM log)
SELECT request_id, request_no, request_no <= 1 AS allowed, CAST(greatest(0, 1 - request_no) AS BIGINT) AS remaining, CAST(epoch(w) AS BIGINT) AS window_start FROM q"""
    o["cache_keys"] = f"""WITH {PARAMS}
SELECT min(request_id) AS first_request, count(*) AS n FROM params WHERE coalesce(temperature, 0.7) = 0
GROUP BY event_type, least(coalesce(max_tokens, 256), 512), coalesce(temperature, 0.7), coalesce(top_p, 0.9)"""
    o["cache_hits"] = f"WITH RECURSIVE {cache_sql('status = 200')} SELECT request_id, cache_result FROM cached"
    o["cache_hits_all"] = f"WITH RECURSIVE {cache_sql('true')} SELECT request_id, cache_result FROM cached"

    o["knn_topk"] = f"""WITH {KNN} SELECT query_id, rank, id, round_even(d, 6) AS distance, round_even(1 / (1 + d), 6) AS score FROM hits"""
    o["knn_blocks"] = f"""WITH {KNN} SELECT query_id, rank, id, round_even(sqrt(d), 6) AS distance, round_even(1 / (1 + sqrt(d)), 6) AS score FROM hits"""
    o["context_blocks"] = f"""WITH {KNN},
t AS (SELECT query_id, text, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS i FROM hits JOIN documents ON doc_id = id)
SELECT query_id, md5({lit(fixed.CONTEXT_HEADER.rstrip(chr(10)))} || chr(10) || chr(10) || string_agg('[' || i || '] ' || text, chr(10) ORDER BY i)) AS context_md5
FROM t GROUP BY query_id"""
    o["unknown_topics"] = f"""WITH {KNN}, best AS (SELECT query_id, 1 / (1 + min(d)) AS score FROM ranked WHERE id % 50 <> 0 GROUP BY query_id)
SELECT count(*) FILTER (score >= 0.5) AS hit, count(*) FILTER (score < 0.5) AS empty, count(*) FILTER (score < 0.5) / count(*) AS unknown_topic_rate FROM best"""
    o["knn_approx"] = "SELECT 3 * count(*) AS exact, true AS as_wanted FROM embeddings WHERE vec_id % 50 = 0"
    o["kb_context"] = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
r AS (SELECT q.vec_id AS conv_id, d.text, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.e, c.e), 'kb-' || c.vec_id) AS i
  FROM v q JOIN (SELECT DISTINCT conv_id FROM conversations) ON conv_id = q.vec_id CROSS JOIN v c JOIN documents d ON d.doc_id = c.vec_id),
ctx AS (SELECT conv_id, {lit(fixed.CONTEXT_HEADER.rstrip(chr(10)))} || chr(10) || chr(10) || string_agg('[' || i || '] ' || text, chr(10) ORDER BY i) AS context FROM r WHERE i <= 3 GROUP BY conv_id),
l AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS r FROM conversations),
t AS (SELECT conv_id, count(*) + 1 AS n, string_agg(role || ':' || text, chr(10) ORDER BY turn) AS turns FROM l WHERE r <= 4 GROUP BY conv_id)
SELECT conv_id, n, md5('system:' || {lit(SYSTEM_PROMPT)} || coalesce(chr(10) || chr(10) || context, '') || chr(10) || turns) AS prompt_md5 FROM t LEFT JOIN ctx USING (conv_id)"""

    o["request_counts"] = f"""WITH {OUTCOMES}
SELECT route, CAST(http_status AS BIGINT) AS status, label_variant AS variant, count(*) AS n FROM classified WHERE counted GROUP BY ALL"""
    o["rate_limited"] = f"WITH {OUTCOMES} SELECT route, count(*) AS n FROM classified WHERE outcome = 'rate_limited' GROUP BY route"
    o["upstream_errors"] = f"WITH {OUTCOMES} SELECT upstream_error, count(*) AS n FROM classified WHERE upstream_error IS NOT NULL GROUP BY 1"
    o["latency_hist"] = f"WITH {COUNTED} {histogram('observed', ['route', 'variant'])}"
    o["latency_quantile"] = f"""WITH {COUNTED}, h AS ({histogram('observed', ['variant'])})
SELECT variant, q, round_even(value, 6) AS value FROM ({quantiles('SELECT * FROM h', ['variant'], [0.5, 0.95, 0.99])})"""
    o["latency_exact"] = f"""WITH {COUNTED}
SELECT variant, q, n, round_even(d[i], 9) AS disc, round_even(c[i], 9) AS cont FROM (
  SELECT variant, count(*) AS n, quantile_disc(latency_s, [0.5, 0.95, 0.99]) AS d, quantile_cont(latency_s, [0.5, 0.95, 0.99]) AS c FROM observed GROUP BY variant)
CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.95, 0.99]) AS q, unnest([1, 2, 3]) AS i)"""
    o["latency_sketch"] = f"""WITH {COUNTED}, w AS ({sliding('observed', ['variant'], 15)})
SELECT variant, window_end, q, n, true AS as_stated FROM w CROSS JOIN (SELECT unnest([0.5::DOUBLE, 0.95, 0.99]) AS q)"""
    o["cache_ratio"] = f"""WITH RECURSIVE {cache_sql('status = 200')}
SELECT count(*) FILTER (cache_result = 'hit') AS hits, count(*) FILTER (cache_result = 'miss') AS misses,
  round_even(count(*) FILTER (cache_result = 'hit') / count(*), 6) AS hit_ratio FROM cached"""
    o["token_totals"] = f"""WITH {ROUTED}
SELECT variant, 'prompt' AS kind, CAST(sum(k) AS BIGINT) AS tokens FROM routed GROUP BY variant
UNION ALL SELECT variant, 'completion', CAST(sum(k * 2 + 1) AS BIGINT) FROM routed GROUP BY variant"""
    o["upstream_last"] = f"WITH {LOG} SELECT client, last(CASE WHEN status = 200 THEN 1 ELSE 0 END ORDER BY ts, request_id)::BIGINT AS up FROM log GROUP BY client"
    o["rate_5m"] = f"""WITH {COUNTED}, w AS ({sliding('requests', ['variant', 'status'], 5)})
SELECT variant, CAST(status AS BIGINT) AS status, window_end, n, round_even(n / 300.0::DOUBLE, 9) AS per_second FROM w"""
    o["rate_1m"] = f"""WITH {COUNTED}, w AS ({sliding('requests', ['variant'], 1)})
SELECT variant, window_end, n, round_even(n / 60.0::DOUBLE, 9) AS per_second FROM w"""
    o["variant_compare"] = f"WITH {COUNTED} SELECT " + ", ".join(
        f"count(*) FILTER (variant = '{v}') AS {v}_requests, round_even(count(*) FILTER (variant = '{v}' AND status >= 500) / count(*) FILTER (variant = '{v}'), 6) AS {v}_server_error_share"
        for v in ("stable", "canary")
    ) + " FROM requests"
    o["status_classes"] = f"""WITH {OUTCOMES},
s AS (SELECT client, count(*) AS requests, count(*) FILTER (http_status BETWEEN 400 AND 499) AS client_errors,
  count(*) FILTER (http_status BETWEEN 500 AND 599) AS server_errors FROM classified WHERE counted GROUP BY client)
SELECT *, round_even(client_errors / requests, 6) AS client_error_share, round_even(server_errors / requests, 6) AS server_error_share FROM s"""
    o["alert_signals"] = f"WITH {SIGNALS} SELECT alert, minute, round_even(value, 6) AS value, breached, hold_min FROM signals"
    o["alerts"] = f"WITH {SIGNALS} SELECT alert, started, ended, fired_at FROM firing"
    o["alerts_sparse"] = f"WITH {signals(7)} SELECT alert, started, ended, fired_at FROM firing"
    o["observe"] = f"""WITH {SIGNALS}
SELECT 'requests' AS metric, route || '|' || status || '|' || variant AS label, count(*) AS n FROM requests GROUP BY 2
UNION ALL SELECT 'latency', route || '|' || variant || '|' || CASE WHEN le = 'inf'::DOUBLE THEN 'Infinity' ELSE CAST(le AS VARCHAR) END, n
  FROM ({histogram('observed', ['route', 'variant'])})
UNION ALL SELECT 'rate_limited', route, count(*) FROM classified WHERE outcome = 'rate_limited' GROUP BY 2
UNION ALL SELECT 'upstream_errors', upstream_error, count(*) FROM classified WHERE upstream_error IS NOT NULL GROUP BY 2
UNION ALL SELECT 'blocks', CASE outcome WHEN 'input_blocked' THEN 'input|' || input_reason ELSE 'output|' || output_reason END, count(*)
  FROM classified WHERE outcome IN ('input_blocked', 'output_blocked') GROUP BY 2
UNION ALL SELECT 'tokens', variant || '|prompt', CAST(sum(k) AS BIGINT) FROM classified WHERE outcome = 'ok' GROUP BY 2
UNION ALL SELECT 'tokens', variant || '|completion', CAST(sum(2 * k + 1) AS BIGINT) FROM classified WHERE outcome = 'ok' GROUP BY 2
UNION ALL SELECT 'upstream', 'main', CAST(last(CASE WHEN status = 200 THEN 1 ELSE 0 END ORDER BY ts, request_id) AS BIGINT) FROM log WHERE event_type IN ('click', 'error')
UNION ALL SELECT 'alerts', alert, started FROM firing
UNION ALL SELECT 'cache', 'hit', count(*) FROM classified WHERE outcome = 'cache_hit'
UNION ALL SELECT 'cache', 'miss', count(*) FROM classified WHERE outcome IN ('timeout', 'unavailable', 'engine_error', 'output_blocked', 'ok')"""
    o["drift_signals"] = f"""WITH {SIGNALS_PER_MODEL}
SELECT model, round_even(golden_pass_rate, 6) AS golden_pass_rate, round_even(baseline_pass_rate, 6) AS baseline_pass_rate, round_even(error_rate, 6) AS error_rate,
  round_even(p95_latency_s, 6) AS p95_latency_s, new_labelled_examples, round_even(unknown_topic_rate, 6) AS unknown_topic_rate FROM drift"""
    o["drift_shift"] = f"""WITH {LOG},
halves AS (SELECT CAST(k % 4 AS BIGINT) AS model, event_type, epoch_us(ts) >= (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 FROM log) AS late FROM log),
cells AS (SELECT model, event_type, count(*) FILTER (NOT late) AS a, count(*) FILTER (late) AS b FROM halves GROUP BY ALL),
shares AS (
  SELECT model, sum(a) OVER w AS n_before, sum(b) OVER w AS n_after, (a + 0.5::DOUBLE) / (sum(a) OVER w + 0.5 * count(*) OVER w) AS p,
    (b + 0.5::DOUBLE) / (sum(b) OVER w + 0.5 * count(*) OVER w) AS q
  FROM cells WINDOW w AS (PARTITION BY model))
SELECT model, CAST(any_value(n_before) AS BIGINT) AS n_before, CAST(any_value(n_after) AS BIGINT) AS n_after,
  round_even(greatest(0, sum(p * log2(p / ((p + q) / 2)) + q * log2(q / ((p + q) / 2))) / 2), 9) AS shift FROM shares GROUP BY model"""
    gap = "baseline_pass_rate - golden_pass_rate"
    o["drift_decision"] = f"""WITH {SIGNALS_PER_MODEL}, r AS (
  SELECT *, list_filter([
    CASE WHEN {gap} > 0.05 THEN 'quality drift: pass rate ' || {pct('golden_pass_rate')} || ' is ' || {pct(gap)} || ' below baseline' END,
    CASE WHEN error_rate > 0.05 THEN 'error rate ' || {pct('error_rate')} || ' over ceiling 5%' END,
    CASE WHEN p95_latency_s > 3 THEN 'p95 latency ' || printf('%.1f', round_even(p95_latency_s, 1)) || 's over SLO 3s' END,
    CASE WHEN unknown_topic_rate > 0.3 THEN 'data drift: ' || {pct('unknown_topic_rate')} || ' of prompts hit no KB context (consider updating the knowledge base, not just retraining)' END],
    lambda x: x IS NOT NULL) AS b FROM drift)
SELECT model, len(b) > 0 OR new_labelled_examples >= 50 AS retrain, CASE WHEN len(b) > 0 THEN 'urgent' WHEN new_labelled_examples >= 50 THEN 'routine' ELSE 'none' END AS severity,
  CASE WHEN len(b) > 0 THEN array_to_string(b, '; ') WHEN new_labelled_examples >= 50 THEN new_labelled_examples || ' new labelled examples (routine refresh)'
    ELSE {lit(fixed.SIGNALS_QUIET)} END AS reasons FROM r"""

    closed = "(SELECT max(epoch_us(ts)) - 600000000 FROM events)"
    o["stream_window_counts"] = f"""
SELECT w AS window_start, event_type, count(*) AS n, round_even(count(*) / 300.0::DOUBLE, 9) AS per_second
FROM (SELECT *, CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) * 300 AS w FROM events) WHERE (w + 300) * 1000000 <= {closed} GROUP BY ALL"""
    o["stream_sliding_rates"] = f"""
WITH w AS (SELECT CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) * 60 + 60 * i AS window_end FROM events CROSS JOIN (SELECT unnest(range(1, 6)) AS i))
SELECT window_end, count(*) AS n FROM w WHERE window_end * 1000000 <= {closed} GROUP BY window_end"""
    o["stream_late"] = f"""
WITH e AS (SELECT *, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS t, CAST(floor(epoch_us(ts) / 300000000) AS BIGINT) * 300 AS w FROM events),
m AS (SELECT (min(t) + max(t)) // 2 AS middle FROM e)
SELECT w AS window_start, event_type, count(*) AS n FROM e, m
WHERE (w + 300) * 1000000 <= {closed} AND (t >= middle) GROUP BY ALL"""
    passed = "(SELECT max(epoch_us(ts)) // 1000 - 300000 FROM events)"
    o["stream_quota"] = f"""WITH {LOG}, q AS (
  SELECT request_id, epoch_us(ts) // 60000000 AS m, row_number() OVER (PARTITION BY client, date_trunc('minute', ts) ORDER BY ts, request_id) AS request_no FROM log)
SELECT request_id, request_no, request_no <= 1 AS allowed, CAST(greatest(0, 1 - request_no) AS BIGINT) AS remaining FROM q WHERE (m + 1) * 60000 < {passed}"""
    o["stream_cache"] = f"""WITH RECURSIVE {cache_sql('status = 200')}
SELECT request_id, cache_result FROM cached JOIN log USING (request_id) WHERE epoch_us(ts) // 1000 < {passed}"""
    o["stream_quota_timers"], o["stream_cache_timers"] = o["stream_quota"], o["stream_cache"]
    o["stream_block_rates"] = f"""
SELECT doc_id * 60 // 3600 * 3600 AS window_start, 'input' AS stage, i AS reason, count(*) AS n, count(*) AS quarantined
FROM (SELECT doc_id, {screen_sql('text')} AS i FROM documents) WHERE i <> '' GROUP BY ALL"""
    o["stream_alerts_all"] = f"""WITH {SIGNALS}
SELECT alert, started, fired_at FROM firing
WHERE fired_at + CASE alert WHEN 'UpstreamDown' THEN 60 ELSE 0 END <= {closed} // 1000000"""
    o["stream_blocks"] = f"SELECT doc_id, 'input' AS stage, i AS reason FROM (SELECT doc_id, {screen_sql('text')} AS i FROM documents) WHERE i <> ''"
    o["stream_alerts"] = f"""
WITH w AS (SELECT event_type, CAST(floor(epoch_us(ts) / 60000000) AS BIGINT) * 60 + 60 * i AS m FROM events CROSS JOIN (SELECT unnest(range(1, 6)) AS i)),
s AS (SELECT m, count(*) FILTER (event_type = 'error') / count(*) > 0.25 AS breached FROM w WHERE m * 1000000 <= {closed} GROUP BY m),
i AS (SELECT m, m / 60 - row_number() OVER (ORDER BY m) AS island FROM s WHERE breached AND m < (SELECT max(m) - 600 FROM s))
SELECT 'HighErrorRate' AS alert, min(m) AS started, min(m) + 120 AS fired_at FROM i GROUP BY island HAVING max(m) >= min(m) + 120"""
    return o
