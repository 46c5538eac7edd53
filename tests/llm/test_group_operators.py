"""Sharding, vectors, pages, fingerprints and the pipeline against brute force."""

import json
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from millrace.llm import components, embedding_dedup, queries, sharding, simhash, wrapper  # noqa: E402
from millrace.llm.common import runs  # noqa: E402

BLANK = r"[^\x20\x09-\x0D]+"


def test_differencing_by_hand():
    # largest spread first: 8-7, then 6-5, 4 with the rest: the textbook run ends two apart
    totals, place = sharding.split([8, 7, 6, 5, 4], 2)
    assert totals == [14, 16]
    assert sorted(sum(n for n, p in zip([8, 7, 6, 5, 4], place) if p == side) for side in (0, 1)) == [14, 16]
    assert sharding.split([], 3)[0] == [0, 0, 0]


def test_differencing_is_tight():
    sizes = np.random.default_rng(1).integers(1, 10_000, 2000).tolist()
    totals, place = sharding.split(sizes, 24)
    assert np.bincount(place, sizes, minlength=24).tolist() == totals
    assert max(totals) - min(totals) <= 50


def check_shards(docs, got):
    texts = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == texts
    for shard in range(24):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    where = {}
    for r in got:
        assert where.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
        assert 0 <= r.shard < 24 and r.law == "bytes" and r.grown_shard is None


def test_shards(spark, sf_dir, odd_docs, no_docs):
    check_shards(odd_docs.select("doc_id", "text").collect(), sharding.by_bytes(odd_docs).collect())
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet")
    got = sharding.by_bytes(docs).collect()
    check_shards(docs.select("doc_id", "text").collect(), got)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 0.01 * sum(sizes.values()) / 24
    assert sharding.by_bytes(no_docs).count() == 0


def test_a_group_of_a_third_stands_alone(spark):
    docs = spark.range(900).selectExpr("id doc_id", "if(id % 3 = 0, repeat('same ', 40), repeat(cast(id as string), 60)) text")
    got = sharding.by_bytes(docs).collect()
    check_shards(docs.collect(), got)
    hot = {r.shard for r in got if r.doc_id % 3 == 0}
    assert len(hot) == 1
    rest = Counter()
    for r in got:
        if r.doc_id % 3:
            assert r.shard not in hot
            rest[r.shard] += r["size"]
    assert max(rest.values()) - min(rest.values()) < 0.02 * max(rest.values())


def brute_vectors(rows, cosine=0.98):
    def fine(r):
        v = r.embedding
        return r.label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    root = list(range(n))
    links = [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if fine(a) and fine(b) and a.label == b.label and len(a.embedding) == len(b.embedding):
                x, y = np.array(a.embedding, float), np.array(b.embedding, float)
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    root[find(i)] = find(j)
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(rows[i].vec_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    return Counter((rows[i].vec_id, links[i], least[find(i)], rows[i].vec_id == least[find(i)]) for i in range(n))


def test_vectors(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "NODES_PER_CELL", 20)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(2)
    hub = rng.normal(size=6)
    rows = [(i, (hub + rng.normal(size=6) * 0.12).tolist(), i % 2) for i in range(160)]
    rows += [(200 + i, rng.normal(size=6).tolist(), 0) for i in range(100)]
    rows += [(300 + i, hub.tolist(), 1) for i in range(30)] + [(300, hub.tolist(), 1), (None, (hub * 2).tolist(), 1), (None, None, 0)]
    rows += [
        (400, None, 1), (401, [0.0] * 6, 1), (402, [None, 1.0, 0.0, 0.0, 0.0, 0.0], 1), (403, [float("nan")] * 6, 1), (404, hub.tolist(), None),
        (405, [float("inf")] + [0.0] * 5, 1), (406, [1.0, 0.0], 1), (407, [1.0, 0.01], 1), (408, [], 1), (408, [], 1),
    ]
    made = spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, digest string, node int"
    ).repartition(4)
    got = embedding_dedup.near_duplicates(made).collect()
    assert Counter(map(tuple, got)) == brute_vectors(made.collect())
    assert embedding_dedup.near_duplicates(made.limit(0)).count() == 0
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    assert Counter(map(tuple, embedding_dedup.near_duplicates(given).collect())) == brute_vectors(given.collect())


def test_cells_lose_no_link():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(80, 4))
    points = embedding_dedup.unit(np.repeat(base, 5, axis=0) + rng.normal(size=(400, 4)) * 0.1)
    centres = embedding_dedup.spherical_kmeans(points, 25)
    point, cell, home = embedding_dedup.cells_of(points, centres, 0.98)
    inside = {}
    for p, c, h in zip(point, cell, home):
        inside.setdefault(p, {})[c] = h
    near = points @ points.T >= 0.98
    for a, b in zip(*np.nonzero(near)):
        shared = inside[a].keys() & inside[b].keys()
        assert any(inside[a][c] or inside[b][c] for c in shared)


def brute_fingerprint(text):
    words = re.findall(BLANK, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rows in (odd_docs, docs):
        given = rows.select("doc_id", "text").collect()
        prints = [brute_fingerprint(r.text) for r in given]
        own = brute_groups(prints)
        least = {g: min((r.doc_id for r, x in zip(given, own) if x == g and r.doc_id is not None), default=None) for g in own}
        want = Counter((r.doc_id, f"{p:016x}", least[g]) for r, p, g in zip(given, prints, own))
        assert Counter(map(tuple, simhash.near_duplicates(rows).collect())) == want
        kept = simhash.keep_one(rows)
        assert kept.columns == rows.columns and kept.count() == len(set(own))
        assert {r.doc_id for r in kept.collect()} == set(least.values())
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize(("shard", "bands"), [(2048, 5), (7, 5), (50, 6)])
def test_links_join_the_same_groups(spark, shard, bands):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 60).tolist() + [0, (1 << 64) - 1]
    prints = set()
    for c in centres:
        for _ in range(8):
            prints.add(c ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 5))}))
    prints = sorted(prints)
    table = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    masks = simhash.band_plan(len(prints)) if bands == 5 else simhash.band_plan(10**6)
    assert len(masks) == {5: 5, 6: 15}[bands]
    found = simhash.links(table, shard=shard, masks=masks)
    root = {r.node: r.root for r in components.components(found).collect()}
    got = [root.get(p - (1 << 64) if p >> 63 else p, p) for p in prints]
    want = brute_groups(prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_bk_tree_finds_all():
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.integers(0, 1 << 12, 300)]
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.near(q, 2)) == [i for i, v in enumerate(values) if (v ^ q).bit_count() <= 2]


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 500), (500, 1000), (7, 7)] + [(5000, 5000 + i) for i in range(1, 50)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 1000: 500, **{5000 + i: 5000 for i in range(50)}}


def test_runs_over_batches():
    import pyarrow as pa

    made = [
        pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(v, pa.int64())], names=["k", "v"])
        for k, v in (([1, 1], [1, 2]), ([], []), ([1, 2, 2], [3, 4, 5]), ([3], [6]))
    ]
    assert [t["v"].to_pylist() for t in runs(iter(made), 1)] == [[1, 2, 3], [4, 5], [6]]


PAGE = (
    "<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav>"
    "<div class='cookie-notice'>We use cookies</div><!-- <p>no</p> --><article><h1>Cats &amp; dogs</h1><p>One<b>two</b> three<p>four"
    "<br>five&nbsp;six<div class=ad>buy</div><form><input>Name</form><script>var t='</p>';</script>"
    "<section id=comments><p>first!</section></article><aside>More</aside><footer>&copy; us</footer></body></html>"
)


def test_article_of_a_page():
    assert wrapper.main_text(PAGE) == "Cats & dogs Onetwo three four five six"
    assert wrapper.main_text("<p>plain &lt;b&gt; text<p>more") == "plain <b> text more"
    assert wrapper.main_text("") == "" and wrapper.main_text("a < b and <") == "a < b and <"
    assert wrapper.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert wrapper.main_text("<nav>menu<article>kept</article>") == "kept"
    assert wrapper.main_text("<script>never closed <p>x") == ""


def test_wrapper_tells_template_menu_and_slots():
    page = "<body><div class=top>Name of site</div><div><p>{0} one</p>{1}</div><ul class=x>{2}</ul><div>Made by us</div></body>"
    pages = [
        page.format(f"text {i}", "<p>more</p>" * (i % 3), "".join(f"<li><a href=/>{j} {i}</a></li>" for j in range(i + 2)))
        for i in range(6)
    ]
    told = wrapper.infer(pages)
    body = told["c"]
    assert [(p["k"], p["d"]) for p in body] == [("div.top", True), ("div", False), ("ul.x", False), ("div", True)]
    assert [(p["k"], p["d"]) for p in body[2]["c"]] == [("li", True)]
    assert wrapper.main_text(pages[2], told) == "text 2 one more more"
    # a page alone, or copies of one page, tell no template
    assert wrapper.main_text(pages[0], wrapper.infer(pages[:1] * 5)).startswith("Name of site text 0 one")


def test_wrapper_decides_inside_an_article():
    page = (
        "<body><article><h1>A series</h1><p>Text {0} with <b>the same</b> word</p><p>Own words of page {0}</p><div>Follow us <b>daily</b></div>"
        "<ul>{1}</ul><p>Printed in Bern</p></article></body>"
    )
    pages = [page.format(i, "".join(f"<li><a href=/{j}>Other {i} {j}</a></li>" for j in range(3))) for i in range(8)]
    told = wrapper.infer(pages)
    assert wrapper.main_text(pages[3], told) == "A series Text 3 with the same word Own words of page 3"
    assert wrapper.main_text(pages[3]).endswith("Follow us daily Other 3 0 Other 3 1 Other 3 2 Printed in Bern")
    # other words in a template's place are text, and so is an article that would lose most of itself
    assert "Printed in Rome" in wrapper.main_text(pages[3].replace("Bern", "Rome"), told)
    assert wrapper.main_text("<article><h1>x</h1><ul></ul><p>Printed in Bern</p></article>", told) == "x Printed in Bern"


def test_counts_of_texts_hold_for_any_number_of_texts():
    """A page with more fixed texts in one part than any page has rows to spare, and own texts that are forgotten."""
    fixed = "".join(f"<p>Clause {j}</p>" for j in range(300))
    pages = [f"<body><div class=law>{fixed}</div><div class=x><p>Text {i}</p></div></body>" for i in range(530)]
    whole = wrapper.merged(wrapper.part_of(wrapper.read(page)) for page in pages)
    law, own = (part.kids[0].kids[0] for part in whole.kids)
    assert whole.pages == 530 and len(law.texts) == 300 and set(law.texts.values()) == {530}
    assert law.lost == own.lost == 2 and law.total == 300 * 530 and own.total == 530 and len(own.texts) < 260
    told = wrapper._told(wrapper.unpacked(json.loads(json.dumps(wrapper.packed(whole)))), 530)
    assert wrapper.main_text(pages[7], told) == "Text 7"
    # a part that half of its pages fill with texts of their own keeps its slot when those are forgotten
    mixed = [f"<body><p>Text {i}</p><p>Always</p></body>" for i in range(520)]
    assert wrapper.main_text(mixed[3], wrapper.infer(mixed)).startswith("Text 3")


def test_names_that_only_look_like_marks():
    for name in ("no-sidebar", "has-sidebar", "layout-with-sidebar"):
        assert wrapper.main_text(f"<div class='{name}'><p>the text</p></div><div class=sidebar>x</div>") == "the text"
    page = (
        "<article><section id=discussion>We argue</section><section id=related-work>Others did</section><h2 id=search>Search</h2>"
        "<div class=social-history>Born poor</div><p>Much more of the article's own text</p><div class='cookie-notice'>ok?</div>"
        "<div class=ad-box>buy</div><div class=related>see</div></article>"
    )
    assert wrapper.main_text(page) == "We argue Others did Search Born poor Much more of the article's own text"
    # a weak mark doesn't count on most of the text, nor where the host's pages have texts of their own
    assert wrapper.main_text("<div class=search-box><p>All of the text</p></div><p>end</p>") == "All of the text end"
    pages = [f"<article><p>Long paragraph number {i} of the page</p><div class=notice>Notice {i}</div></article>" for i in range(5)]
    assert wrapper.main_text(pages[2]) == "Long paragraph number 2 of the page"
    assert wrapper.main_text(pages[2], wrapper.infer(pages)) == "Long paragraph number 2 of the page Notice 2"


def test_wrappers_of_all_pages(spark):
    """Half of a large host has another layout, one page is odd, most of another host is copies of one page."""
    page = "<body><div class=top-{0}>Site {0}</div><div class=x><p>text {1}</p></div><div class=end-{0}>Imprint {0}</div></body>"
    rows = [("big", page.format("ab"[i % 2], i)) for i in range(700)] + [("big", "<p>odd</p>")]
    rows += [("copies", page.format("c", 0))] * 300 + [("copies", page.format("c", i)) for i in range(1, 4)]
    given = [(i, f"http://{host}.example/{i}", html) for i, (host, html) in enumerate(rows)]
    made = spark.createDataFrame(given, "page_id long, url string, html string")
    found = {r.host: r.wrapper for r in wrapper.wrappers(made.repartition(5)).collect()}
    assert found == {r.host: r.wrapper for r in wrapper.wrappers(made.repartition(2)).collect()}
    assert sorted(found) == ["big.example", "copies.example"]
    text = {r.page_id: r.text for r in wrapper.extract(made).collect()}
    assert all(text[i] == re.search("<p>(.*?)</p>", html)[1] for i, _, html in given)


def test_pages(spark):
    rows = [(i, f"http://h{i % 2}.example/{i}", PAGE.replace("One", f"One {i} "), "x") for i in range(30)]
    rows += [(100, None, PAGE, "x"), (101, "http://h0.example/x", None, "x"), (102, "nonsense", "", None), (None, "http://h1.example/", PAGE, "x")]
    rows += [rows[3], (104, "http://h1.example/long", "<article>" + "<p>word word</p>" * 20_000 + "</article>", "x")]
    made = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    got = wrapper.extract(made).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((a, b) for a, b, *_ in rows)
    text = {(r.page_id, r.url): r.text for r in got}
    for a, b, page, _ in rows:
        assert text[(a, b)] == wrapper.main_text(page or "")
    assert wrapper.extract(made.limit(0)).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    import html

    given = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op6_wrappers(spark, sf_dir).collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", given[r.page_id], re.S)[1]
        inside = re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", inside))
        assert r.text == " ".join(html.unescape(inside).split()) and r.n_chars == len(r.text)


def test_pipeline(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "packing"]
    step = docs
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = spark.createDataFrame(stage(spark, step, sf_dir).collect(), docs.schema)
        assert step.columns == docs.columns
        kept.append({r.doc_id for r in step.select("doc_id").collect()})
    assert kept[0] >= kept[1] >= kept[2] and len(kept[0]) < docs.count()
    whole = {r.doc_id for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()}
    assert whole == kept[2]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, sf_dir).count() == 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd_docs, sf_dir).columns == odd_docs.columns


def test_wrapper_matches_every_repeat_of_a_group():
    menu = "".join(f"<h4>Menu {i}</h4><ul><li><a href=x>Link {i}</a></li></ul>" for i in range(5))
    pages = [f"<body>{menu}" + "".join(f"<p>Own words {p} {i} of it</p>" for i in range(3)) + "</body>" for p in range(12)]
    told = wrapper.infer(pages)
    for p, page in enumerate(pages):
        assert wrapper.main_text(page, told) == " ".join(f"Own words {p} {i} of it" for i in range(3))
    triple = "".join(f"<h4>Head {i}</h4><p>Note {i}</p><b>Mark {i}</b>" for i in range(4))
    pages = [f"<body>{triple}<div>Text of page {p}</div></body>" for p in range(8)]
    assert wrapper.main_text(pages[5], wrapper.infer(pages)) == "Text of page 5"


def test_alignment_has_bounded_work():
    rng = random.Random(7)
    for n, m, kinds in [(0, 4, 2), (30, 40, 3), (40, 30, 60), (200, 180, 500), (25, 25, 1)]:
        left, right = ([str(rng.randrange(kinds)) for _ in range(x)] for x in (n, m))
        for a, b in ((left, right), (left, left), (left, left[: n // 2] + ["x"] + left[n // 2 :])):
            for work in (0, 30, 10**6):
                found = wrapper.matches(a, b, work)
                assert all(a[i : i + k] == b[j : j + k] and k for i, j, k in found)
                assert all(i + k <= p and j + k <= q for (i, j, k), (p, q, _) in zip(found, found[1:]))
            if a is b or len(b) == len(a) + 1 and b is not right:
                assert sum(k for _, _, k in wrapper.matches(a, b, 0)) == len(a)
    page = lambda: "<body><p>" + "".join(f"<{x}>{rng.random():.4f}</{x}>" for x in rng.choices("biu", k=70_000)) + "</p></body>"
    pages = [page() for _ in range(2)]
    began = time.time()
    told = wrapper.infer(pages)
    text = wrapper.main_text(pages[0], told)
    assert time.time() - began < 40 and text == wrapper.main_text(pages[0]) and len(text) == 420_000


def test_shards_by_levels(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    groups = Counter()
    for r in rows.collect():
        groups[r.text] += len((r.text or "").encode()) + 8
    for level in (2, 5):  # eleven buckets of some thirty rows: no better than the largest group is promised
        got = sharding.shards(rows, ways=24, buckets=11, level=level).selectExpr("*", "'bytes' law", "null grown_shard").collect()
        check_shards(rows.collect(), got)
        totals = Counter()
        for r in got:
            totals[r.shard] += r["size"]
        assert len(totals) == 24 and max(totals.values()) - min(totals.values()) <= max(groups.values())


def test_fingerprints_whose_documents_repeat_an_id(spark):
    texts = [" ".join(f"w{(k * n) % 97}" for n in range(40)) for k in (3, 5, 7, 11)]
    near = texts[0] + " one"
    rows = [(5, texts[0]), (5, texts[1]), (3, texts[0]), (None, texts[2]), (None, texts[2]), (9, texts[3]), (2, near)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [simhash.fingerprint(t.encode()) for _, t in rows]
    group = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    least = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group}
    want = Counter((d, f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, group))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
