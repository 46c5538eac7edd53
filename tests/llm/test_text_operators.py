"""Encoding, packing, licences, quality, language and language model against brute force."""

import hashlib
import itertools
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from checks.compare import connect, differences  # noqa: E402
from millrace.llm import encode, hmm, langid, license_scan, line_crf, lm_score, packing, queries  # noqa: E402
from millrace.llm.bpe import Bpe  # noqa: E402
from millrace.llm.license_rules import RULES, Rule  # noqa: E402

WORDS, BYTES = (public_tokenizers.path(f) for f in (queries.WORD_FILE, queries.BYTE_FILE))
BLANK = r"[^\x20\x09-\x0D]+"
HARD = [
    "", "a" * 3000, "ab" * 2000, "$" * 999, "日本語" * 50, "It's they'LL we'd", "ΑΣ ΣΑΣ", "İstanbul ǅ ﬁ ½ ² ٣", "x\x1cy\x85z\xa0w",
    "<|startoftext|>mid<|endoftext|><|", " lead\n\n  tail ", "é é", "🙂👍🏽‍",
]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_and_texts_equal_the_library(path):
    library, mine = Tokenizer.from_file(path), Bpe(path)
    flat, counts = mine.encode(HARD)
    for text, end, n in zip(HARD, np.cumsum(counts), counts):
        want = library.encode(text, add_special_tokens=False).ids
        assert flat[end - n : end].tolist() == want, text
        assert mine.decode(flat[end - n : end]) == library.decode(want, skip_special_tokens=False)


def test_forgotten_words_are_learned_again():
    mine = Bpe(BYTES)
    first = mine.encode(HARD)[0].tolist()
    mine._forget()
    assert mine.encode(HARD)[0].tolist() == first


def test_encode_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(WORDS)
    got = encode.digests(encode.encode(odd_docs, WORDS, decoded=True)).collect()
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want.append((r.doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    both = encode.encode(odd_docs, WORDS, decoded=True)
    again = encode.decode(both, WORDS).collect()
    assert sorted(r.decoded for r in again) == sorted(r.decoded for r in both.collect())
    assert encode.encode(no_docs, WORDS).count() == 0


def test_fast_ids_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    for text in [*HARD, " " * 4000 + "x", "\n" * 3000]:
        assert packing.token_ids(BYTES, text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_fit_keeps_every_capacity(rule):
    lengths = np.random.default_rng(3).integers(1, 101, 700)
    capacity = packing.Capacity(tokens=100, documents=4, cost=6000 if rule == "norm" else 10_000, rule=rule)
    lengths = lengths[lengths**2 <= capacity.cost]
    own = packing.fit(lengths, capacity)
    for s in np.unique(own):
        inside = lengths[own == s]
        assert inside.sum() <= 100 and len(inside) <= 4 and (inside**2).sum() <= capacity.cost
    assert sorted(np.unique(own)) == list(range(own.max() + 1))


def test_fit_is_close_to_the_bound():
    lengths = np.random.default_rng(4).integers(1, 1500, 4000)
    used = packing.fit(lengths, packing.Capacity()).max() + 1
    assert used <= math.ceil(lengths.sum() / 2048) * 1.01 + 1


def test_pack_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    got = packing.pack_documents(odd_docs, BYTES).collect()
    texts = Counter((r.doc_id, r.text or "") for r in odd_docs.select("doc_id", "text").collect())
    pieces = Counter()
    for (key, text), times in texts.items():
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids), 2048), len(ids)]
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pieces[(key, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += times
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r.sequence_id, r.offset)), key=lambda r: r.sequence_id):
        at = 0
        for r in rows:
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack_documents(no_docs, BYTES).count() == 0


def test_packing_over_groups(spark):
    rows = spark.range(5000).selectExpr(
        "id doc_id", "0 piece", "cast(0 as long) start", "cast(1 + id % 700 as long) length", "cast(0 as long) ids_crc32"
    )
    got = packing.pack(rows, group=1000).toPandas()
    assert len(got) == 5000 and got.groupby("sequence_id").length.sum().max() <= 2048
    assert got.sequence_id.nunique() <= got.length.sum() / 2048 + 8


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
    spaced = "".join(f" {w} " for w in words)
    found = [
        (len(spaced[: m.start()].split()), len(m[0].split()), r)
        for r in RULES if r.keyword in spaced for m in re.finditer(r.regex, spaced)
    ]
    cells = [(s, s + n, r) for s, n, r in found]
    kept = [
        (s, e, r) for s, e, r in cells
        if not any(a <= s and b >= e and o.priority >= r.priority and (a, -b, -o.priority, o.number) < (s, -e, -r.priority, r.number)
                   for a, b, o in cells)
    ]
    base = [(s, e, r) for s, e, r in cells if r.base]
    return (
        len(words), len(base), min((s for s, _, _ in base), default=None), max((s for s, _, _ in base), default=None),
        ",".join(sorted({r.label for _, _, r in base})), ",".join(sorted({r.label for _, _, r in [*base, *kept]})),
    )


def test_licenses_odd_rows(odd_docs, no_docs):
    got = license_scan.summary(license_scan.detect(odd_docs)).collect()
    want = [(r.doc_id, *brute_licenses(r.text)) for r in odd_docs.select("doc_id", "text").collect()]
    shown = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in got]
    assert sorted(map(str, shown)) == sorted(map(str, want))
    assert license_scan.summary(license_scan.detect(no_docs)).count() == 0


def readings(items):
    """Texts a parsed pattern matches: every alternative, with and without what is optional."""
    made = [""]
    for op, value in items:
        match str(op):
            case "LITERAL":
                here = [chr(value)]
            case "NOT_LITERAL":
                here = ["x"]
            case "IN":
                here = [chr(code) for _, code in value]
            case "BRANCH":
                here = [t for branch in value[1] for t in readings(branch)]
            case "SUBPATTERN":
                here = readings(value[3])
            case "MAX_REPEAT":
                once = readings(value[2])
                here = [*([""] if value[0] == 0 else []), *(t * max(value[0], 1) for t in once)]
        made = [a + b for a in made for b in here]
    return made


def test_every_reading_of_a_rule_is_found_alone(spark):
    import re._parser

    texts = [(r.number, t) for r in RULES for t in readings(re._parser.parse(r.regex))]
    assert all(RULES[n].keyword in t and RULES[n].gate in t and re.search(RULES[n].regex, t) for n, t in texts)
    names = ["Released under the Expat License", "FreeBSD License", "0BSD License", "University of Illinois Open Source License", "open railm license"]
    docs = spark.createDataFrame([*texts[::37], *((-i - 1, t) for i, t in enumerate(names))], "doc_id long, text string")
    for r in license_scan.detect(docs).collect():
        found = {d.rule for d in r.detections}
        assert found == {x.number for x in RULES if re.search(x.regex, "".join(f" {w} " for w in lowered(r.text).split()))}
        assert found and (r.doc_id < 0 or r.doc_id in found)


def test_license_places_and_suppression(spark):
    rules = [Rule(0, "ab", " a ", " a  b ", 1, True), Rule(1, "abc", " a ", " a  b  c ", 2, False), Rule(2, "bc", " b ", " b  c ", 3, False)]
    docs = spark.createDataFrame([(1, "x a b a b c, A-B b c")], "doc_id long, text string")
    found = license_scan.detect(docs, rules).first()
    assert found.words == 10
    assert [(d.start, d.end, d.label, d.kept) for d in found.detections] == [
        (1, 3, "ab", True), (3, 6, "abc", True), (3, 5, "ab", False), (4, 6, "bc", True), (6, 8, "ab", True), (8, 10, "bc", True),
    ]


def test_many_mentions_in_one_text(spark):
    """Places are exact over many blocks of the scan, and time grows little faster than the text."""
    texts = {n: "x " + "mit license y gnu general public license " * n for n in (1, 7, 300, 12_000)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    begun = time.time()
    found = {r.doc_id: r.detections for r in license_scan.detect(docs).collect()}
    assert time.time() - begun < 60
    for n in (1, 7, 300):
        base = [(d.start, d.end) for d in found[n] if d.base]
        assert base == [p for i in range(n) for p in ((1 + 7 * i, 3 + 7 * i), (4 + 7 * i, 8 + 7 * i))]
    assert brute_licenses(texts[300])[5] == ",".join(sorted({d.label for d in found[300] if d.base or d.kept}))
    assert [d.start for d in found[12_000] if d.base and d.label == "gpl"] == [4 + 7 * i for i in range(12_000)]


def test_licenses_equal_sql(spark, sf_dir):
    want = connect(sf_dir).execute(queries.ORACLE_SQL["op1_licenses"]).df()
    assert differences(queries.op1_licenses(spark, sf_dir).toPandas(), want) == ""


def brute_quality(text):
    text = text or ""
    words = re.findall(BLANK, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = line_crf.judge(docs, None).collect()
        want = [(r.doc_id, *brute_quality(r.text)) for r in docs.select("doc_id", "text").collect()]
        shown = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got]
        assert sorted(map(str, shown)) == sorted(map(str, want))
        assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept != r.base_failed for r in got)
    assert line_crf.judge(no_docs, None).count() == 0


def test_viterbi_and_fit():
    rng = np.random.default_rng(5)
    field = line_crf.Field(rng.normal(size=(line_crf.FEATURES, 2)), rng.normal(size=(2, 2)))
    texts = [rng.integers(0, 1 << line_crf.FEATURES, n) for n in (1, 4, 3, 4)]
    got = field.viterbi(np.repeat(range(4), [1, 4, 3, 4]), np.concatenate(texts))
    at = 0
    for bits in texts:
        scores = field.scores(bits)
        best = max(
            itertools.product((0, 1), repeat=len(bits)),
            key=lambda y: sum(scores[i, k] for i, k in enumerate(y)) + sum(field.moves[a, b] for a, b in zip(y, y[1:])),
        )
        assert got[at : at + len(bits)].tolist() == list(best)
        at += len(bits)
    assert line_crf.fit([(1, np.array([1, 3]))]) is None
    made = line_crf.fit([(1, np.array([1, 1, 1])), (0, np.array([3, 3])), (0, np.array([3]))])
    assert made.viterbi(np.array([0, 0, 1, 1]), np.array([1, 1, 3, 3])).tolist() == [1, 1, 0, 0]


def test_quality_on_held_out_labels(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    field = line_crf.train(docs, labels.where("doc_id % 2 = 0"))
    seen = line_crf.judge(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").toPandas()
    assert seen[seen.quality == 1].kept.mean() > 0.98 and seen[seen.quality == 0].kept.mean() < 0.1
    kept = line_crf.keep_good(docs, field)
    assert kept.columns == docs.columns
    assert kept.count() == line_crf.judge(docs, field).where("kept").count()
    assert line_crf.train(docs, labels.limit(0)) is None


def test_language_slopes_are_the_loss_slopes():
    rng = np.random.default_rng(0)
    H = langid.HIDDEN
    params = [rng.normal(0, 0.3, s) for s in [(256, 3 * H), (3 * H, H), (3 * H,)] * 2 + [(3, H), (3, H), (3,)]]
    x, y = rng.integers(97, 105, (4, 9)).astype(np.uint8), np.array([0, 1, 2, 0])

    def loss():
        def gate(v):
            return 1 / (1 + np.exp(-v))

        out = 0
        for d in range(2):
            table, loop, bias = params[3 * d : 3 * d + 3]
            h, seen = np.zeros((4, H)), np.empty((9, 4, H))
            for t in range(9) if d == 0 else range(8, -1, -1):
                u, a = h @ loop.T + bias, table[x[:, t]]
                z, r = gate((a + u)[:, :H]), gate((a + u)[:, H : 2 * H])
                n = np.tanh(a[:, 2 * H :] + r * u[:, 2 * H :])
                h = (1 - z) * n + z * h
                seen[t] = h
            out = out + seen @ params[6 + d].T
        out = out + params[8]
        chances = np.exp(out) / np.exp(out).sum(2, keepdims=True)
        return -np.log(chances[:, np.arange(4), y]).mean(), chances.mean(0)

    for p, slope in zip(params, langid._slopes(params, x, y)):
        at = (98, 5) if p.shape[0] == 256 else tuple(n // 2 for n in p.shape)
        before = p[at]
        p[at] = before + 1e-5
        up = loss()[0]
        p[at] = before - 1e-5
        down = loss()[0]
        p[at] = before
        assert abs((up - down) / 2e-5 - slope[at]) < 1e-6
    network = langid.Network(
        ["a", "b", "c"], (langid.Layer(*params[:3]), langid.Layer(*params[3:6])), (params[6], params[7]), params[8]
    )
    _, score = network.predict([bytes(row) for row in x])
    assert np.allclose(score, loss()[1].max(1), atol=1e-4)


def test_language_on_held_out(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    network = langid.train_on(docs)
    seen = langid.predict(docs, network).join(docs, "doc_id").where("held_out").toPandas()
    assert (seen.lang == seen.lang_pred).mean() > 0.95
    odd = langid.predict(odd_docs, network).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert Counter(r.lang_pred == "und" for r in odd)[True] == 4
    assert {r.lang_pred for r in langid.predict(odd_docs, None).collect()} == {"und"}
    assert langid.train_on(no_docs) is None and langid.predict(no_docs, network).count() == 0
    kept = langid.keep_known(odd_docs, network)
    assert kept.columns == odd_docs.columns and kept.where("doc_id in (2, 3, 4, 8)").count() == 0


def noise(chance):
    """Texts of letters that no language wrote: encoded bytes and random words."""
    import base64

    for _ in range(20):
        yield base64.b64encode(chance.randbytes(600)).decode()
        yield " ".join("".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=chance.randint(2, 9))) for _ in range(120))


def test_filter_decides_by_the_network(spark, monkeypatch):
    """On held-out texts: clean ones and mixtures of languages stay, noise goes, which a test for letters would keep."""
    import random

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = langid.train_on(docs, with_noise=True)
    assert network.names == ["de", "en", "es", "fr", "und"]
    held = docs.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 AND length(text) > 400 AND lang IS NOT NULL")
    clean = [(r.doc_id, r.text, r.lang) for r in held.select("doc_id", "text", "lang").collect()]
    by_lang = {}
    for _, text, lang in clean:
        by_lang.setdefault(lang, []).append(text)
    groups = list(zip(*by_lang.values()))[:12]
    mixed = [" ".join(x[:200] for x in g) for g in groups]  # about a window and a half of each
    mixed += [" ".join(s for row in zip(*(x.split(".")[:6] for x in g)) for s in row) for g in groups]  # sentence by sentence
    noisy = list(noise(random.Random(7)))
    rows = [("clean", t) for _, t, _ in clean] + [("mixed", t) for t in mixed] + [("noise", t) for t in noisy]
    made = spark.createDataFrame([(i, t, k) for i, (k, t) in enumerate(rows)], "doc_id long, text string, kind string")
    kept = {r["kind"]: r["count"] for r in langid.keep_known(made, network).groupBy("kind").count().collect()}
    assert kept["clean"] == len(clean) and kept["mixed"] == len(mixed)
    assert kept.get("noise", 0) <= 0.05 * len(noisy)
    plain = langid.train_on(docs)  # tells languages only, and so keeps whatever has a letter
    assert langid.keep_known(made, plain).count() == made.count()
    short = spark.createDataFrame([(1, "A."), (2, "qzx"), (3, ""), (4, None), (5, "12 !")], "doc_id long, text string")
    assert sorted(r.doc_id for r in langid.keep_known(short, network).collect()) == [1, 2]


def test_filter_keeps_mixed_texts_and_all_languages(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    network = langid.train_on(docs)
    part = {r.lang: r.text for r in docs.where("length(text) > 400").collect()}
    mixed = " ".join(t[:400] for t in part.values())
    assert len(part) == 4 and max(network.predict([mixed.encode()])[1]) < 0.4
    kept = langid.keep_known(spark.createDataFrame([(1, mixed), (2, "12 34")], "doc_id long, text string"), network)
    assert [r.doc_id for r in kept.collect()] == [1]
    monkeypatch.setattr(langid, "STEPS", 1)
    many = spark.range(600).selectExpr("id doc_id", "concat('l', id div 4) lang", "concat('some words ', id) text")
    assert len(langid.train_on(many).names) == 150
    assert len(langid.train_on(many).predict([b"some words"])[0]) == 1


def test_exact_likelihoods(monkeypatch):
    monkeypatch.setattr(hmm, "SEGMENT", 3)
    rng = np.random.default_rng(1)
    model = hmm.update(hmm.Counts(rng.uniform(1, 5, 3), rng.uniform(1, 5, (3, 3)), rng.uniform(1, 5, (3, 5))))
    sequences = [rng.integers(0, 5, n) for n in (1, 3, 4, 7, 8, 0)]
    for s, got in zip(sequences, hmm.log_likelihoods(model, sequences)):
        total = sum(
            model.start[p[0]] * model.emit[p[0], s[0]]
            * math.prod(model.moves[p[i - 1], p[i]] * model.emit[p[i], s[i]] for i in range(1, len(s)))
            for p in itertools.product(range(3), repeat=len(s))
        ) if len(s) else 1
        assert abs(got - math.log(total)) < 1e-9


def test_baum_welch_counts():
    rng = np.random.default_rng(2)
    model = hmm.update(hmm.Counts(rng.uniform(1, 5, 2), rng.uniform(1, 5, (2, 2)), rng.uniform(1, 5, (2, 4))))
    s = rng.integers(0, 4, 6)
    want, weight = hmm.Counts.empty(2, 4), 0
    for p in itertools.product(range(2), repeat=6):
        w = model.start[p[0]] * math.prod(model.emit[k, x] for k, x in zip(p, s)) * math.prod(model.moves[a, b] for a, b in zip(p, p[1:]))
        weight += w
        want.start[p[0]] += w
        for a, b in zip(p, p[1:]):
            want.moves[a, b] += w
        for k, x in zip(p, s):
            want.emit[k, x] += w
    got = hmm.Counts.empty(2, 4)
    hmm.expect(model, [s], got)
    for name in ("start", "moves", "emit"):
        assert np.allclose(getattr(got, name), getattr(want, name) / weight)
    assert abs(got.loss - math.log(weight)) < 1e-9


def test_scores(spark, sf_dir, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(lm_score, "HEAD", 300)
    for docs, many in ((odd_docs, False), (spark.read.parquet(f"{sf_dir}/documents.parquet"), True)):
        rows = [(r.doc_id, [*re.findall(BLANK, lowered(r.text)), None]) for r in docs.select("doc_id", "text").collect()]
        part = {k: zlib.crc32(str("" if k is None else k).encode()) % 10 for k, _ in rows}
        counts = Counter(w for k, ws in rows if part[k] for w in ws)
        n, v = sum(counts.values()), len(counts)
        want = sorted(
            (str(k), part[k] == 0, len(ws), sum(counts[w] > 0 for w in ws), n,
             sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for k, ws in rows
        )
        found = lm_score.score(docs).collect()
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found)
        for a, b in zip(got, want, strict=True):
            assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9)
        held = [r for r in found if r.held_out]
        assert all(r.score < 0 for r in found)
        if many:
            assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert lm_score.score(no_docs).count() == 0


def test_long_texts_are_labelled_by_blocks():
    rng = np.random.default_rng(11)
    weights, moves = rng.normal(size=(line_crf.FEATURES, 2)), rng.normal(size=(2, 2))
    for field in (line_crf.Field(weights, moves), line_crf.Field(np.round(weights), np.round(moves))):  # the second has ties
        for n in (1, 2, 3, 5, 17, 100, 1001):
            owner, bits = np.zeros(n, int), rng.integers(0, 1 << line_crf.FEATURES, n)
            assert field.viterbi(owner, bits).tolist() == field.viterbi(owner, bits, block=1).tolist()
        owner, bits = np.repeat(range(4), [3, 40, 1, 60]), rng.integers(0, 1 << line_crf.FEATURES, 104)
        assert field.viterbi(owner, bits).tolist() == field.viterbi(owner, bits, block=30).tolist()
    lines = [f"{i * 7919 % 100_003} a b" for i in range(200_000)]
    field = line_crf.Field(weights, moves)
    began = time.time()
    found = line_crf.measure(["\n".join(lines).encode()], field)
    assert time.time() - began < 30
    assert found["n_words"][0] == 600_000 and found["n_dup_lines"][0] == 99_997
    assert found["n_repeat_words"][0] == 600_000 - 3 * (100_003 - 99_997)


def test_field_of_one_id_on_all_rows(spark):
    rows = [(1, f"Line {i}.\nAnother line of text {i}.") for i in range(300)] + [(2, "# # |\n$ $ |")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    field = line_crf.train(docs, labels)
    assert field is not None and field.viterbi(np.array([0]), np.array([0])).shape == (1,)


def test_license_scan_keeps_columns_of_its_own_names(spark):
    docs = spark.createDataFrame([(1, "Under the MIT License", "a", "b", "c")], "doc_id long, text string, _lower string, _gate string, _spaced string")
    [row] = license_scan.detect(docs).collect()
    assert (row["_lower"], row["_gate"], row["_spaced"], row["words"]) == ("a", "b", "c", 4) and row["detections"]
