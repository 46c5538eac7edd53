"""BPE encoding and decoding with the vocabulary of a public tokenizer file.

The merges run on many words at a time: the symbols of all words lie in one flat
array, every round looks up all neighbouring pairs by binary search over the sorted
pair keys, and each word merges all places of its lowest-ranked pair.

Encoding is row by row, so it needs no shuffle and a lost task repeats its own rows
only. Words already seen are kept in a table of bounded size per task.
"""

from __future__ import annotations

import json
import re
import unicodedata
from itertools import chain

import numpy as np
import regex

from millrace.llm.common import ranges

#: Most words a task remembers; beyond that the table starts anew.
REMEMBERED = 400_000

# The split patterns of the two files. White space is the Unicode property, spelled out.
_SPACE = r"\t-\r\x20\x85\xa0  -     　"
_SPACE_LATIN = r"\t-\r\x20\x85\xa0"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|{L}+|{N}|[^{S}{l}{n}]+"
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|[{S}]+(?![^{S}])|[{S}]+"


def _compiled(pattern: str) -> tuple[re.Pattern, regex.Pattern]:
    """For texts within Latin-1 (``re`` is faster), and for all."""
    letters, digits = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe"
    plain = {"{L}": f"[{letters}]", "{N}": f"[{digits}]", "{l}": letters, "{n}": digits, "{S}": _SPACE_LATIN}
    full = {"{L}": r"\p{L}", "{N}": r"\p{N}", "{l}": r"\p{L}", "{n}": r"\p{N}", "{S}": _SPACE}
    made = []
    for names in (plain, full):
        text = pattern
        for name, value in names.items():
            text = text.replace(name, value)
        made.append(text)
    return re.compile(made[0]), regex.compile(made[1])


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in set(shown))
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def _wide(text: str) -> bool:
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return True
    return False


class _Numbers(dict):
    """Words by number; a new word gets the next number and is noted in ``fresh``."""

    fresh: list[str]

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.fresh.append(word)
        return number


class Bpe:
    """A tokenizer read from a ``tokenizers`` JSON file (BPE model, byte symbols)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self.first = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + (b if not a.endswith(suffix) or not suffix else b)] for a, b in pairs], np.int64)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int64), made[order]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.names = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        self.spaced = spec["decoder"] is None
        back = {s: b for b, s in enumerate(symbols)}
        self.pieces = None
        if not self.spaced:
            raw = [t.encode() if t in self.special else bytes(back[c] for c in t) for t in self.names]
            self.pieces = np.array(raw, object)
        self.lowers = spec["normalizer"] is not None
        self.split = _compiled(WORD_SPLIT if self.lowers else BYTE_SPLIT)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers((t, i) for i, t in enumerate(self.special))
        self.known.fresh = []
        self.ids = np.array(list(self.special.values()), np.int32)
        self.starts = np.arange(len(self.ids), dtype=np.int64)
        self.sizes = np.ones(len(self.ids), np.int64)

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens stand as themselves."""
        if "<|" in text and self.cut.search(text):
            parts = self.cut.split(text)
            return [w for i, p in enumerate(parts) for w in ([p] if i % 2 else self._plain_words(p))]
        return self._plain_words(text)

    def _plain_words(self, text: str) -> list[str]:
        if self.lowers:
            if not text.isascii():
                # character by character: a final sigma is lowered like any other
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            text = text.lower()
        return self.split[_wide(text)].findall(text)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has; no word is empty."""
        sizes = np.array([len(w) for w in words], np.int64)
        done = np.zeros(len(words), np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        sym = self.first[raw]
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[raw[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        parts_sym, parts_word = [], []
        while len(sym):
            inside = np.flatnonzero(word[1:] == word[:-1])
            keys = sym[inside] << 32 | sym[inside + 1]
            at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
            hit = self.keys[at] == keys
            inside, at = inside[hit], at[hit]
            if not len(inside):
                parts_sym.append(sym)
                parts_word.append(word)
                break
            own, rank = word[inside], self.rank[at]
            heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(own)]))
            low = rank == least
            place, made = inside[low], self.made[at[low]]
            # equal symbols in a row overlap; every second pair of such a run merges, from the left
            run = np.r_[True, np.diff(place) != 1]
            since = np.arange(len(place)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            take = since % 2 == 0
            place, made = place[take], made[take]
            sym[place] = made
            keep = np.ones(len(sym), bool)
            keep[place + 1] = False
            # words without a pair left are set aside
            open_word = np.zeros(len(words), bool)
            open_word[own] = True
            live = open_word[word]
            parts_sym.append(sym[keep & ~live])
            parts_word.append(word[keep & ~live])
            sym, word = sym[keep & live], word[keep & live]
        flat, owner = np.concatenate(parts_sym or [sym]), np.concatenate(parts_word or [word])
        order = np.argsort(owner, kind="stable")
        done += np.bincount(owner, minlength=len(words))
        return flat[order].astype(np.int32), done

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other (int32), and how many each text has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        lists = [self.words(t) for t in texts]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int64, int(counts.sum()))
        if self.known.fresh:
            ids, sizes = self.merge([w.encode() for w in self.known.fresh])
            self.known.fresh.clear()
            self.starts = np.r_[self.starts, len(self.ids) + np.cumsum(sizes) - sizes]
            self.sizes = np.r_[self.sizes, sizes]
            self.ids = np.r_[self.ids, ids]
        sizes = self.sizes[at]
        before = np.r_[0, np.cumsum(sizes)]
        ends = np.cumsum(counts)
        return self.ids[ranges(self.starts[at], sizes)], before[ends] - before[ends - counts]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: byte symbols joined and read as UTF-8, or, without a decoder, names joined by spaces."""
        if self.spaced:
            return " ".join(self.names[ids].tolist())
        return b"".join(self.pieces[ids].tolist()).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The tokenizer of a file, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]
