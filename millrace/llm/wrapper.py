"""Main text of web pages by wrappers: union-free expressions inferred from the pages of a host.

All pages of a host with different main texts are aligned, in groups of about ``GROUP`` one
after the other; their wrappers are aligned in groups again until one is left. Groups and
orders go by hashes of the texts, so partitioning doesn't change them. Where the streams agree they are the wrapper; text that
differs becomes a slot, elements that only some pages have become optional, and
groups of up to three neighbours that repeat become a repeated group, which takes all repeats of a page.
The work of an alignment is bounded for pages of any length (``matches``); beyond it parts become optional, no text is lost. Parts of the wrapper without a slot are
the host's template, and parts that are mostly links its menus.

Every page is then matched against its host's wrapper. Text counts if it stands in the
page's article or main element (in the whole page if there is none), not in a part that
is marked as menu, header, footer, sidebar, notice, advert, form or comments, and not in
template or menu parts of the wrapper; a weak mark (page_tree) doesn't count where the wrapper
has slots and few links. A text is template where most pages with the part
have that very text (``SHARE``, and ``LAYOUT`` of the host's pages); rare texts are dropped from the count as
pages come, never one that more than ``LACK`` of the part's pages have, so the count's width follows a page and not the host. Inside an article only
whole blocks are template, so that no sentence is torn, its h1 is never (a series may have
one title), and a page that would lose three quarters of its article keeps all of it.

Pages aren't shuffled, only their folded trees, which hold hashes instead of texts; no task
sees more of a host than a group. The wrappers are broadcast when they are measured to be small
(``BROADCAST_BYTES``) and joined by host otherwise.

A page without url, or whose host has no wrapper, goes by its own marks. Null or empty html
gives the empty text. Repeated rows give repeated results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, texts_of
from millrace.llm.page_tree import BLOCKS, MAIN, Node, articles, blocks, read
from millrace.session import materialize

GROUP = 256
#: Template text is told from this many different pages on.
TOLD = 3
#: A template text is the text of this share of the pages that have the part, and of this share of all pages.
SHARE, LAYOUT = 0.8, 0.2
#: A part's count of a text lacks at most this share of the part's pages, however many texts it has (lossy counting).
LACK = 1 / 256
LINKS = 0.7
#: Lists of parts are compared part by part up to this product of their lengths.
WORK = 40_000
BROADCAST_BYTES = 32 << 20
BROADCAST_HOSTS = 200_000
TEXT = "#"


class Part:
    """A wrapper part: an element, or text with the number of pages for each text seen there."""

    __slots__ = ("key", "kids", "texts", "optional", "repeated", "pages", "size", "linked", "apart", "weak", "lost", "total")

    def __init__(self, key: str, text: str = ""):
        self.key = key
        self.kids: list[Part] = []
        self.texts = {digest(text): 1} if text else {}
        self.optional = self.repeated = self.apart = self.weak = False
        self.pages, self.size, self.linked = 1, len(text), 0
        self.lost, self.total = 0, len(self.texts)  # the most that a count lacks; all texts counted


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode(errors="replace"), digest_size=8).hexdigest()


def part_of(node: Node, linked: bool = False) -> Part:
    """A page as a wrapper of its own, with repeats folded."""
    part = Part(node.key)
    part.apart, part.weak = node.apart, node.weak
    linked = linked or node.tag == "a"
    for kid in node.kids:
        if isinstance(kid, Node):
            part.kids.append(part_of(kid, linked))
        elif words := " ".join(kid.split()):
            part.kids.append(Part(TEXT, words))
            part.kids[-1].linked = len(words) * linked
    part.kids = fold(part.kids)
    part.size = sum(k.size for k in part.kids)
    part.linked = sum(k.linked for k in part.kids)
    return part


def merge(a: Part, b: Part, same_page: bool = False) -> Part:
    """One part that stands for both."""
    if a.key == TEXT:
        a.total += b.total - sum(min(n, a.texts.get(text, 0)) for text, n in b.texts.items()) * same_page
        for text, n in b.texts.items():
            a.texts[text] = max(a.texts.get(text, 0), n) if same_page else a.texts.get(text, 0) + n
        a.lost = max(a.lost, b.lost) if same_page else a.lost + b.lost
    else:
        a.kids = align(a.kids, b.kids, same_page)
        a.apart, a.weak = a.apart and b.apart, (a.weak or b.weak) and a.apart and b.apart
    a.optional, a.repeated = a.optional or b.optional, a.repeated or b.repeated
    a.size, a.linked = a.size + b.size, a.linked + b.linked
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    if (spare := int(LACK * a.pages) - a.lost) > 0:
        a.texts = {text: n for text, n in a.texts.items() if n > spare}
        a.lost += spare
    return a


def _greedy(left: Sequence[str], right: Sequence[str], ahead: int = 64) -> Iterator[tuple[int, int, int]]:
    """Every left key with its next place on the right, if that is not far ahead."""
    at = 0
    for i, key in enumerate(left):
        if key in (near := right[at : at + ahead]):
            at += near.index(key) + 1
            yield i, at - 1, 1


def matches(left: Sequence[str], right: Sequence[str], work: int = WORK) -> list[tuple[int, int, int]]:
    """Blocks (place left, place right, length) of keys that stand for each other, in order.

    The longest common runs come first where the product of both lengths is small. Longer lists are cut at what
    begins and ends both and at the keys that each has once, in the longest order they share; what lies between
    two cuts and is still too long is matched key by key. So the work is bounded, and what isn't matched is only optional.
    """
    if left == right:
        return [(0, 0, len(left))] if left else []
    if len(left) * len(right) <= work:
        return [m for m in SequenceMatcher(None, left, right, autojunk=False).get_matching_blocks() if m[2]]
    n, m = len(left), len(right)
    head = next(i for i in range(min(n, m) + 1) if i == min(n, m) or left[i] != right[i])
    most = min(n, m) - head
    tail = next(i for i in range(most + 1) if i == most or left[n - 1 - i] != right[m - 1 - i])
    sides = [Counter(left[head : n - tail]), Counter(right[head : m - tail])]
    place = {k: i for i, k in enumerate(right[head : m - tail], head) if sides[1][k] == 1}
    once = [(i, place[k]) for i, k in enumerate(left[head : n - tail], head) if sides[0][k] == 1 and k in place]
    # the longest chain of unique keys that rises on both sides
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for number, (_, j) in enumerate(once):
        at = bisect_left(ends, j)
        before.append(last[at - 1] if at else -1)
        ends[at : at + 1], last[at : at + 1] = [j], [number]
    chain: list[tuple[int, int]] = []
    number = last[-1] if last else -1
    while number >= 0:
        chain.append(once[number])
        number = before[number]
    found = [(0, 0, head)]
    i, j = head, head
    for a, b in [*reversed(chain), (n - tail, m - tail)]:
        x, y = left[i:a], right[j:b]
        if x and y:
            inner = matches(x, y, work) if len(x) * len(y) <= work else _greedy(x, y)
            found += [(i + p, j + q, size) for p, q, size in inner]
        if a < n - tail:
            found.append((a, b, 1))
        i, j = a + 1, b + 1
    found.append((n - tail, m - tail, tail))
    return [f for f in found if f[2]]


def align(left: list[Part], right: list[Part], same_page: bool = False) -> list[Part]:
    """Parts of both in order; what only one side has is optional. In a run of optional parts the order doesn't tell:
    what each side has in another place of the run is one part (layouts of a host meet in any order)."""
    out: list[Part] = []
    alone: dict[tuple[str, int], list[Part]] = {}
    a = c = 0
    for b, d, n in [*matches([p.key for p in left], [p.key for p in right]), (len(left), len(right), 0)]:
        for side, parts in enumerate((left[a:b], right[c:d])):
            for part in parts:
                part.optional = True
                if not same_page and (others := alone.get((part.key, 1 - side))):
                    merge(others.pop(0), part)
                    continue
                alone.setdefault((part.key, side), []).append(part)
                out.append(part)
        for x, y in zip(left[b : b + n], right[d : d + n]):
            out.append(merge(x, y, same_page))
            if not out[-1].optional:
                alone.clear()
        a, c = b + n, d + n
    return fold(out)


def fold(parts: list[Part], longest: int = 3) -> list[Part]:
    """Neighbouring groups of up to three parts with the same keys as one repeated group."""
    for width in range(1, longest + 1):
        out: list[Part] = []
        at = 0
        while at < len(parts):
            group = parts[at : at + width]
            last = out[-width:]
            same = len(last) == len(group) == width and [p.key for p in last] == [p.key for p in group]
            if same and any(p.key != TEXT for p in group):
                for x, y in zip(last, group):
                    merge(x, y, same_page=True).repeated = True
                at += width
            else:
                out.append(parts[at])
                at += 1
        parts = out
    return parts


def packed(part: Part) -> list:
    flags = part.optional + 2 * part.repeated + 4 * part.apart + 8 * part.weak
    return [part.key, flags, part.pages, part.size, part.linked, part.lost, part.total, part.texts, [packed(k) for k in part.kids]]


def unpacked(given: list) -> Part:
    part = Part(given[0])
    part.optional, part.repeated, part.apart, part.weak = (bool(given[1] & bit) for bit in (1, 2, 4, 8))
    part.pages, part.size, part.linked, part.lost, part.total, part.texts = given[2:8]
    part.kids = [unpacked(k) for k in given[8]]
    return part


def _fixed(part: Part, pages: int) -> list[str]:
    """Template texts of a text part."""
    least = max(TOLD, SHARE * part.pages, LAYOUT * pages)
    return sorted(text for text, n in part.texts.items() if n >= least)


def _has_slot(part: Part, pages: int) -> bool:
    if part.key != TEXT:
        return any(_has_slot(k, pages) for k in part.kids)
    fixed = _fixed(part, pages)
    return not fixed or sum(part.texts[t] for t in fixed) < SHARE * part.total


def _told(part: Part, pages: int) -> dict:
    """What the matcher needs: key, template texts, whether the part is a menu, its kids; and whether it goes as a whole."""
    template = part.pages >= max(TOLD, LAYOUT * pages) and part.size > 0 and not _has_slot(part, pages)
    menu = part.repeated and part.size > 0 and part.linked > LINKS * part.size
    # a weak mark doesn't count against a part that the pages fill with texts of their own
    own = part.weak and part.pages >= TOLD and part.size > 0 and not template and part.linked <= LINKS * part.size
    told = {"k": part.key, "d": (part.apart and not own) or template or menu, "m": menu, "o": own, "c": [_told(k, pages) for k in part.kids]}
    if part.key == TEXT:
        told["x"] = [] if _has_slot(part, pages) else _fixed(part, pages)
    return told


def merged(parts: Iterator[Part]) -> Part:
    whole = next(parts)
    for part in parts:
        whole = merge(whole, part)
    return whole


def infer(pages: list[str]) -> dict:
    """The wrapper of a host's pages, which are aligned one after the other; pages of one main text count once."""
    different = {main_text(page): page for page in reversed(pages)}
    whole = merged(part_of(read(page)) for page in reversed(different.values()))
    return _told(whole, whole.pages)


def _folded(slots: list[tuple[str, list]], longest: int = 3) -> list[tuple[str, list]]:
    """:func:`fold` for the kids of a page, which stay apart: a slot holds all kids that repeat it."""
    for width in range(1, longest + 1):
        out: list[tuple[str, list]] = []
        at = 0
        while at < len(slots):
            group = slots[at : at + width]
            keys = [key for key, _ in group]
            if len(group) == width and any(k != TEXT for k in keys) and [key for key, _ in out[-width:]] == keys:
                for (_, held), (_, more) in zip(out[-width:], group):
                    held.extend(more)
                at += width
            else:
                out.append(slots[at])
                at += 1
        slots = out
    return slots


def _matched(node: Node, wrapper: dict | None) -> Iterator[tuple[Node | str, dict | None]]:
    """The node's kids, each with the wrapper part it matches."""
    kids = [k for k in node.kids if isinstance(k, Node) or k.strip()]
    if not wrapper or not wrapper["c"]:
        yield from ((k, None) for k in node.kids)
        return
    # the page is folded like the pages the wrapper is made of, so all repeats of a group meet the group's parts
    keys = [kid.key if isinstance(kid, Node) else TEXT for kid in kids]
    slots = [(key, [kid]) for key, kid in zip(keys, kids)]
    expected = [k["k"] for k in wrapper["c"]]
    if keys != expected:
        slots = _folded(slots)
        keys = [key for key, _ in slots]
    part_for: dict[int, dict] = {}
    for a, b, n in matches(keys, expected):
        for (_, group), part in zip(slots[a : a + n], wrapper["c"][b : b + n]):
            part_for.update((id(kid), part) for kid in group)
    for kid in node.kids:
        yield kid, part_for.get(id(kid)) if isinstance(kid, Node) or kid.strip() else None


def _apart(node: Node, part: dict | None) -> bool:
    return node.apart and not (node.weak and part is not None and part["o"])


def _is_template(text: str, part: dict | None) -> bool:
    return bool(part and part["x"]) and digest(" ".join(text.split())) in part["x"]


def _all_template(node: Node, wrapper: dict | None) -> bool:
    """Whether every text of the node is template."""
    for kid, part in _matched(node, wrapper):
        if isinstance(kid, str):
            if kid.strip() and not _is_template(kid, part):
                return False
        elif not _apart(kid, part) and not _all_template(kid, part):
            return False
    return True


def _texts(node: Node, wrapper: dict | None, whole: bool, inside: bool) -> Iterator[str | None]:
    """Texts that count, with None where a block begins or ends."""
    for kid, part in _matched(node, wrapper):
        if isinstance(kid, str):
            if inside and not (whole and _is_template(kid, part)):
                yield kid
            continue
        block = kid.tag in BLOCKS
        header = kid.tag == "header" and (whole or not inside)
        article = inside and not whole
        menu = part and part["m"] and (block or not article)
        template = article and part and block and kid.tag != "h1" and _all_template(kid, part)
        if _apart(kid, part) or header or ((menu or template) and kid.tag not in MAIN):
            if block:
                yield None
            continue
        if block:
            yield None
        yield from _texts(kid, part, whole, inside or kid.tag in MAIN)
        if block:
            yield None


def main_text(page: str, wrapper: dict | None = None) -> str:
    return text_of(read(page), wrapper)


def text_of(root: Node, wrapper: dict | None = None) -> str:
    whole = not articles(root)
    text = blocks(_texts(root, wrapper, whole, whole))
    if wrapper and not whole:
        bare = blocks(_texts(root, None, whole, whole))
        return text if 4 * len(text) >= len(bare) else bare
    return text


def host_of(url: str = "url") -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, place (a hash of the main text) and tree (JSON) of pages given as host and html."""
    for batch in batches:
        texts = texts_of(batch.column(1))
        for a, b in slices([len(t) for t in texts]):
            places, trees = [], []
            for text in texts[a:b]:
                root = read(text.decode())
                places.append(int(digest(text_of(root)), 16) >> 1)
                trees.append(json.dumps(packed(part_of(root)), separators=(",", ":")))
            columns = [batch.column(0).slice(a, b - a), pa.array(places, pa.int64()), pa.array(trees, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "place", "tree"])


def _merging(last: bool) -> Callable[[tuple, pa.Table], pa.Table]:
    """Merges the trees of a group in the order of their places, in the last round to what the matcher needs."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        found = sorted(zip(group["place"].to_pylist(), group["tree"].to_pylist()))
        whole = merged(unpacked(json.loads(tree)) for _, tree in found)
        made = json.dumps(_told(whole, whole.pages) if last else packed(whole), separators=(",", ":"))
        return pa.table({"host": [key[0].as_py()], "place": [key[1].as_py()], "tree": [made]})

    return run


def wrappers(pages: DataFrame) -> DataFrame:
    """host and its wrapper (JSON), from all pages of the host."""
    rows = pages.select(host_of().alias("host"), "html").where("host <> '' and html is not null")
    kinds = "host string, place long, tree string"
    trees = rows.mapInArrow(_trees, kinds).groupBy("host", "place").agg(F.min("tree").alias("tree"))
    trees = materialize(trees, "page-trees")
    sizes = materialize(trees.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    most, hosts = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    if hosts <= BROADCAST_HOSTS:
        sizes = F.broadcast(sizes)
    groups = F.ceil(F.col("n") / GROUP).cast("long")
    level = trees.join(sizes, "host").select("host", F.pmod("place", groups).alias("part"), "place", "tree")
    rounds = 1
    while GROUP**rounds < most:
        rounds += 1
    for left in range(rounds - 1, -1, -1):
        done = level.groupBy("host", "part").applyInArrow(_merging(last=left == 0), kinds)
        level = done.select("host", F.expr(f"place div {GROUP}").alias("part"), "place", "tree")
    return level.select("host", F.col("tree").alias("wrapper"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main ``text`` of every page."""
    known = materialize(wrappers(pages), "wrappers")
    size = known.agg(F.coalesce(F.sum(F.octet_length("wrapper") + F.octet_length("host")), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        known = F.broadcast(known)
    rows = pages.select("page_id", "url", "html", host_of().alias("host")).join(known, "host", "left")
    rows = rows.select("page_id", "url", "html", "wrapper")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, dict] = {}
        for batch in batches:
            texts, told = texts_of(batch.column(2)), texts_of(batch.column(3))
            for a, b in slices([len(t) for t in texts]):
                out = []
                for text, wrapper in zip(texts[a:b], told[a:b]):
                    if wrapper and wrapper not in held:
                        if len(held) > 200:
                            held.clear()
                        held[wrapper] = json.loads(wrapper)
                    out.append(main_text(text.decode(), held.get(wrapper)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(out, pa.string())],
                    names=["page_id", "url", "text"],
                )

    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
