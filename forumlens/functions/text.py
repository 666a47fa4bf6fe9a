"""Text cleaning as native column expressions; all of them take null."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from forumlens.functions.stopwords import ENGLISH_STOPWORDS

PUNCTUATION = string.punctuation

# The 29 characters Python splits words on: Unicode White_Space and the four ASCII separators.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])
) + "".join(map(chr, [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# The same set for Java's regex engine, where (?U) makes \s the Unicode property.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def strip_html(text: Column, replacement: str = "") -> Column:
    """Delete everything from a `<` to the next `>` on the same line."""
    return F.regexp_replace(text, r"<[^>\n]*>", replacement)


def strip_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def split_words(text: Column) -> Column:
    """Words between runs of whitespace; an empty or null text gives an empty array."""
    words = F.array_remove(F.split(text, WHITESPACE_RUN), "")
    return F.coalesce(words, F.array().cast("array<string>"))


def is_stopword(word: Column, *, stripped: bool = False) -> Column:
    """`stripped` compares with the list after the punctuation strip, so that `dont` counts as `don't`."""
    return word.isin(sorted(stopword_set(stripped)))


def stopword_set(stripped: bool = False) -> set[str]:
    if not stripped:
        return set(ENGLISH_STOPWORDS)
    drop = str.maketrans("", "", PUNCTUATION)
    return {word.translate(drop) for word in ENGLISH_STOPWORDS}


def drop_stopwords(words: Column, *, stripped: bool = False) -> Column:
    return F.filter(words, lambda word: ~is_stopword(word, stripped=stripped))


def remove_stopwords(text: Column, *, stripped: bool = False) -> Column:
    """Text form: the words that are left, with single spaces."""
    return F.array_join(drop_stopwords(split_words(text), stripped=stripped), " ")


def clean_words(
    text: Column, *, html: bool, html_replacement: str = "", stripped_stopwords: bool = False
) -> Column:
    """lower, html, punctuation, stopwords: the words of a text that are ready to be stemmed.

    One pass deletes the punctuation and turns every whitespace character into a space,
    which makes the split a plain one.
    """
    lowered = F.lower(text)
    if html:
        lowered = strip_html(lowered, html_replacement)
    flat = F.translate(lowered, WHITESPACE + PUNCTUATION, " " * len(WHITESPACE))
    words = F.coalesce(F.array_remove(F.split(flat, " "), ""), F.array().cast("array<string>"))
    return drop_stopwords(words, stripped=stripped_stopwords)
