"""Turn repair, two-tier byte-level encoding and importance resampling against brute force."""

import base64
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import tiktoken  # noqa: E402

from checks.compare import connect, differences  # noqa: E402
from millrace.llm import crc, importance, pretokens, queries  # noqa: E402
from millrace.llm import turn_repair as tr  # noqa: E402

RANKS, PATTERN = public_tokenizers.path(queries.RANK_FILE), public_tokenizers.PATTERN
HARD = [
    "", "a" * 3000, "ab" * 2000, "aaab" * 300, "$" * 999, "日本語" * 50, "It's they'LL we'd", "ΑΣ ΣΑΣ", "İstanbul ǅ ﬁ ½ ² ٣", "x\x1cy\x85z\xa0w",
    "<|endoftext|><|", " lead\n\n  tail ", "é é", "🙂👍🏽‍", "\x00\x01", " " * 700 + "x",
]

# ---------------------------------------------------------------- conversations


def cheapest_by_search(turns):
    """Least (cost, audit) by walking every sequence of edits up to a length no cheapest one exceeds."""
    best = (tr.DELETE * len(turns), "D" * len(turns))

    def walk(i, made, cost, audit):
        nonlocal best
        if cost > best[0] or len(audit) > 2 * len(turns) + 2:
            return
        if i == len(turns) and re.fullmatch("(s?(ua)+)?", made):
            best = min(best, (cost, audit))
        if i < len(turns):
            walk(i + 1, made, cost + 4, audit + "D")
            if turns[i] != "x":
                own, late = turns[i].lower(), 3 * turns[i].isupper()
                for role in {own, "u", "a"}:
                    follow(i + 1, made + role, cost + late + 3 * (role != own), audit + ("K" if role == own else "R"))
        for role in "ua":
            follow(i, made + role, cost + 3, audit + "I")

    def follow(i, made, cost, audit):
        if re.fullmatch("s?(ua)*u?", made):
            walk(i, made, cost, audit)

    walk(0, "", 0, "")
    return best


def test_repairs_are_cheapest_with_the_smallest_audit():
    chance = random.Random(3)
    cases = ["", "s", "u", "a", "x", "su", "sa", "au", "ss", "U", "uu", "aa"]
    cases += ["".join(chance.choice("ssuuaauaoxSUAO") for _ in range(chance.randint(0, 5))) for _ in range(400)]
    for turns in cases:
        assert tr.over_lengths(turns) == tr.folded(turns) == cheapest_by_search(turns), turns


def test_folded_tables_equal_those_of_every_length():
    chance = random.Random(4)
    for _ in range(100):
        turns = "".join(chance.choice("sua" * 4 + "uaoxUAS") for _ in range(chance.randint(6, 40)))
        assert tr.over_lengths(turns) == tr.folded(turns), turns


def brute_repair(rows, harm):
    """The contract read row by row; ``rows`` are (conv_id, turn, role, text)."""
    kept, out = {}, {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        name = f"{conv if conv is not None else ' '}:{turn if turn is not None else ' '}"
        code = zlib.crc32(name.encode()) % 20 if harm else 19
        group = kept.setdefault(conv, [])
        if code == 1:
            text = ""
        elif code == 2:
            text = re.sub("[.!?]", "", text)
        elif code == 4:
            role = "user"
        group += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    for conv, group in kept.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))
        seen, code, n = set(), "", Counter()
        for i, (turn, role, text) in enumerate(group):
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            n[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            code += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
            n["illegal"] += i > 0 and group[i - 1][1][:1] + role[:1] not in ("su", "ua", "au")
        cost, audit = cheapest_by_search(code) if len(code) < 10 else tr.folded(code)
        length, at, lines, left = len(audit) - audit.count("D"), 0, [], list(group)
        wanted = "s" * (length % 2) + "ua" * (length // 2)
        for edit in audit:
            _, role, text = (None, "", "") if edit == "I" else left.pop(0)
            if edit != "D":
                lines.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[wanted[at]]}:{text}")
                at += 1
        turns = {t for t, _, _ in group if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, sha)
    return out


ODD_TURNS = [
    (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes!"), (2, 0, "system", "Be kind."), (2, 2, "user", "And"), (2, 3, "user", "And"), (3, 5, None, None),
    (None, 1, "user", "a."), (None, 0, "user", "b."), (None, None, "assistant", "c?"), (4, None, "user", ""), (4, None, "tool", " \t"), (5, 1, "", "x."),
    (6, 0, "user", "w " * 60_000 + "."), (6, 1, "assistant", "w " * 60_000), (7, 3, "user", "same."), (7, 3, "user", "same."), (7, 3, "assistant", "same."),
    (8, -4, "assistant", "ÄÖ 🙂."), (8, 9, "user", "?\x0b"), (9, 1, "system", "only."), (10, 1, "superuser", "s."), (10, 2, "u", "u."), (10, 3, "a", "a."),
] + [(11, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(300)]
SAID = "conv_id long, turn long, role string, text string, digest string, plan int, kind string"


@pytest.mark.parametrize("harm", [False, True])
def test_conversations(spark, sf_dir, harm):
    odd = spark.createDataFrame([(*r, "d", 1, "k") for r in ODD_TURNS], SAID).repartition(3)
    for turns in (odd, spark.read.parquet(f"{sf_dir}/conversations.parquet")):
        rows = [tuple(r)[:4] for r in turns.collect()]
        got = {r[0]: tuple(r)[1:] for r in tr.repair(tr.damage(turns) if harm else turns).collect()}
        assert got == brute_repair(rows, harm)
    assert tr.repair(tr.damage(odd.limit(0))).count() == 0


def test_repaired_turns_have_the_digest_of_the_repair(spark, sf_dir):
    turns = tr.damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    lines = {}
    for r in sorted(tr.repaired_turns(turns).collect(), key=lambda r: (r.conv_id, r.position)):
        assert r.position == len(lines.setdefault(r.conv_id, []))
        lines[r.conv_id].append((r.edit, f"{r.role}:{r.text}"))
    for r in tr.repair(turns).collect():
        own = lines.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(x for _, x in own).encode()).hexdigest() == r.repaired_sha256
        assert "".join(e for e, _ in own) == r.audit.replace("D", "")


# ---------------------------------------------------------------- encoding


@pytest.fixture(scope="module")
def coder():
    return pretokens.load(RANKS, PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_tells_strangers(coder):
    keys = list(coder.ranks)
    sizes = np.array([len(k) for k in keys])
    data = np.frombuffer(b"".join(keys), np.uint8)
    assert (coder.hash.find(data, np.cumsum(sizes) - sizes, sizes) == np.arange(len(keys))).all()
    assert sorted(coder.hash.key.tolist()) == list(range(len(keys)))
    strangers = [k + b"\x00\xff" for k in keys[:5000]] + [k[:-1] + bytes([k[-1] ^ 1]) for k in keys if k[:-1] + bytes([k[-1] ^ 1]) not in coder.ranks]
    sizes = np.array([len(k) for k in strangers])
    assert (coder.hash.find(np.frombuffer(b"".join(strangers), np.uint8), np.cumsum(sizes) - sizes, sizes) == -1).all()


@pytest.mark.parametrize("n", [0, 1, 2, 7, 300])
def test_small_perfect_hashes(n):
    keys = [b"k%d" % i for i in range(n)]
    sizes = np.array([len(k) for k in keys], np.int64)
    made = pretokens.PerfectHash(keys)
    assert made.find(np.frombuffer(b"".join(keys), np.uint8), np.cumsum(sizes) - sizes, sizes).tolist() == list(range(n))
    assert made.find(np.frombuffer(b"zz", np.uint8), np.array([0]), np.array([2])).tolist() == [-1]


def test_ids_equal_the_library(coder, library, sf_dir, monkeypatch):
    monkeypatch.setattr(pretokens, "CHUNK_WORDS", 50)
    texts = HARD + [t or "" for (t,) in connect(sf_dir).execute("SELECT text FROM documents").fetchall()]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), text[:50]
        assert coder.decode(ids) == text.encode()
    for raw in list(coder.ranks)[::400]:  # the heap alone gives an entry back as itself
        assert coder.merge(raw) == (coder.ranks[raw],)
    long = ("word" * 5 + " ") * 50_000 + "y" * 200_000
    assert coder.decode(coder.encode([long])[0]) == long.encode()


def test_forgotten_pretokens_are_learned_again(coder, library, monkeypatch):
    monkeypatch.setattr(pretokens, "REMEMBERED", 1)
    for text in HARD:
        assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_encode_odd_rows(odd_docs, no_docs, library):
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), library.decode_bytes(ids))]
        want.append((r.doc_id, len(ids), *sha))
    made = pretokens.encode(odd_docs, RANKS, PATTERN, decoded=True)
    assert Counter(map(tuple, pretokens.digests(made).collect())) == Counter(want)
    again = pretokens.decode(pretokens.encode(odd_docs, RANKS, PATTERN), RANKS, PATTERN)
    assert Counter(bytes(r.decoded).decode() for r in again.collect()) == Counter(r.text or "" for r in odd_docs.select("text").collect())
    assert pretokens.digests(pretokens.encode(no_docs, RANKS, PATTERN, decoded=True)).count() == 0


# ---------------------------------------------------------------- resampling


def test_crc_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 100_000).astype(np.uint8)
    starts = rng.integers(0, 60_000, 2000)
    lengths = np.where(rng.random(2000) < 0.9, rng.integers(1, 66, 2000), rng.integers(1, 5000, 2000))
    lengths[:8] = [1, 63, 64, 65, 128, 129, 192, 40_000]
    assert crc.crc32_spans(data, starts, lengths).tolist() == [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, lengths)]
    assert len(crc.crc32_spans(data, starts[:0], lengths[:0])) == 0


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.mark.parametrize(("low", "high", "chunk"), [(1, 1, 1 << 20), (1, 3, 100), (2, 2, 1)])
def test_features(monkeypatch, low, high, chunk):
    monkeypatch.setattr(importance, "CHUNK_BYTES", chunk)
    texts = ["", "One two, TWO three!", "x" * 200 + " Ä日本 9a", "...", "a b c d e f g", "end"]
    rules = importance.Resampling(shortest=low, longest=high, buckets=997)
    got = [[] for _ in texts]
    for owner, bucket in importance.features([t.encode() for t in texts], rules):
        for i, b in zip(owner, bucket):
            got[i].append(b)
    for text, have in zip(texts, got):
        ws = words(text)
        grams = [" ".join(ws[k : k + n]) for n in range(low, high + 1) for k in range(len(ws) - n + 1)]
        assert sorted(have) == sorted(zlib.crc32(g.encode()) % 997 for g in grams)


def brute_resampling(docs, target, size=10_000):
    def buckets(text):
        return [zlib.crc32(w.encode()) % size for w in words(text)]

    s = Counter(itertools.chain.from_iterable(buckets(t) for _, t in docs))
    t = Counter(itertools.chain.from_iterable(buckets(x) for x in target))
    all_s, all_t = s.total(), t.total()
    rows = []
    for key, text in docs:
        own = buckets(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + size) / ((s[b] + 1) * (all_t + size)))) for b in own)
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        rows.append([key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, row in enumerate(able[: 10 * len(able) // 100]):
        row[4] = k + 1
    return Counter(map(tuple, rows))


def drawn(docs, target):
    return Counter(map(tuple, importance.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank").collect()))


def test_resampling(spark, sf_dir, odd_docs, no_docs):
    con = connect(sf_dir)
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    texts = [t for (t,) in con.execute("SELECT text FROM benchmark").fetchall()]
    same = spark.createDataFrame([(5, "word " * 30)] * 200 + [(6, "other " * 30)] * 100, "doc_id long, text string").repartition(4)
    for docs in (odd_docs, same, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert drawn(docs, target) == brute_resampling(rows, texts)
    assert drawn(odd_docs, target.limit(0)) == brute_resampling([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], [])
    assert drawn(no_docs, target) == Counter()


def test_resampling_equals_sql(spark, sf_dir):
    got = queries.QUERIES["op13_resampling"](spark, sf_dir).toPandas()
    assert differences(got, connect(sf_dir).execute(queries.ORACLE_SQL["op13_resampling"]).df()) == ""


def test_longer_features_are_weighed(spark, sf_dir):
    docs, target = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    rules = importance.Resampling(longest=2, buckets=512)
    got = importance.resample(docs, target, rules)
    counted = {r.doc_id: (r.n_words, r.n_features) for r in got.collect()}
    for key, text in ((r.doc_id, r.text) for r in docs.collect()):
        n = len(words(text))
        assert counted[key] == (n, n + max(0, n - 1))
