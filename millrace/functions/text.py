"""Text expressions: words, normalisers, shingles.

Python's regular expressions are Unicode-aware and count the four separators
\\x1c-\\x1f as white space; Java's are not and do not. Patterns here switch on
Unicode mode and name those separators, so both agree.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"\s\x1c-\x1f"
WORD_CHAR = r"\p{L}\p{N}_"
# The characters Python counts as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def words(text: Column) -> Column:
    """Runs of non-space characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?U)[^{SPACE}]+"), F.lit(0))


def is_blank(text: Column) -> Column:
    return text.isNull() | ~F.regexp_like(text, F.lit(rf"(?U)[^{SPACE}]"))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)[{SPACE}]+", " ")


def drop_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)[^{WORD_CHAR}{SPACE}]", "")


def dedup_text(text: Column) -> Column:
    """Normal form for dedup: strips before removing punctuation, so an inner space may end it."""
    return collapse_space(drop_punctuation(strip(F.lower(text))))


def leakage_text(text: Column) -> Column:
    """Normal form for the split check: strips last."""
    return F.trim(collapse_space(drop_punctuation(F.lower(text))))


def tokens(normal: Column) -> Column:
    """Space-separated tokens of a normal form; an empty text has none."""
    return F.array_remove(F.split(F.trim(normal), " "), "")


def shingles(toks: Column, n: int = 3) -> Column:
    """Distinct word n-grams; fewer than n tokens give one shingle of all of them."""
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(toks) - (n - 1), F.lit(1))),
        lambda i: F.concat_ws(" ", F.slice(toks, i, n)),
    )
    return F.array_distinct(F.when(F.size(toks) >= n, grams).otherwise(F.array(F.concat_ws(" ", toks))))


def shingle_hashes(toks: Column) -> Column:
    """Distinct word 3-grams as sorted 64-bit hashes: eight bytes each instead of the words."""
    grams = F.transform(
        toks, lambda w, i: F.xxhash64(w, F.get(toks, i + 1), F.get(toks, i + 2))
    )
    cut = F.slice(grams, 1, F.greatest(F.size(toks) - 2, F.lit(1)))
    return F.sort_array(
        F.array_distinct(F.when(F.size(toks) >= 3, cut).otherwise(F.array(F.xxhash64(F.concat_ws(" ", toks)))))
    )


def block_key(toks: Column) -> Column:
    """First four tokens, joined."""
    return F.concat_ws(" ", F.slice(toks, 1, 4))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two duplicate-free arrays; two empty arrays give 0."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(0.0)).otherwise(common / union)


def trimmed_lower(word: Column, chars: str) -> Column:
    return F.btrim(F.lower(word), F.lit(chars))
