"""Text expressions: cleaning, tokenising, stop words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# What each cleaning pass replaces by one space. A word with a digit is found
# from its first character on and never given back, which spares the engine a search from every later one. A
# space is left out of the punctuation, as it would be replaced by itself, one match per word.
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{}~−]"""
WORD_WITH_DIGIT = r"(?<!\w)[A-Za-z_]*+\d\w*+"
LONE_LETTER = r"\s[A-Z,a-z]\s"
CLEANING_PASSES = (PUNCTUATION, WORD_WITH_DIGIT, LONE_LETTER, LONE_LETTER)


def clean_text(text: Column) -> Column:
    """Blank out punctuation, words that hold a digit and lone letters.

    The lone-letter pass runs twice because neighbours share a space.
    """
    for pattern in CLEANING_PASSES:
        text = F.regexp_replace(text, pattern, " ")
    return text


def tokens(text: Column, stop_words: Sequence[str] = ()) -> Column:
    """Lower-case tokens, split at white space, without empty ones and stop words.

    The stop words become one hash-set literal.
    """
    dropped = sorted({"", *(w.lower() for w in stop_words)})
    return F.filter(F.split(F.lower(text), r"\s+"), lambda t: ~t.isin(dropped))


def without_stop_words(words: Column, stop_words: Sequence[str]) -> Column:
    """Drop stop words from tokens of any case."""
    lowered = sorted({w.lower() for w in stop_words})
    return F.filter(words, lambda w: ~F.lower(w).isin(lowered)) if lowered else words
