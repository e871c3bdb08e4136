"""Text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that a table reader takes as missing by default.
DEFAULT_MISSING = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)
# Further texts the review files use for a missing cell.
REVIEW_MISSING = DEFAULT_MISSING + ("none",)

PLACEHOLDER = "-"

# The Unicode blanks.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: runs of characters a cleaned review may not hold. (?U) makes \s Unicode-aware.
_NOT_ALLOWED = "(?U)[^A-Za-z0-9\\s\\x1c-\\x1f.,!?;:'\"-]+"


def missing_to_null(text: Column, tokens: tuple[str, ...] = DEFAULT_MISSING) -> Column:
    """NULL where the whole cell, untrimmed, is one of the tokens."""
    return F.when(~text.isin(*tokens), text)


def trim_blanks(text: Column) -> Column:
    """Strip all Unicode blanks, where a plain ``trim`` strips spaces only."""
    return F.btrim(text, F.lit(BLANKS))


def fill_placeholder(text: Column) -> Column:
    return F.coalesce(text, F.lit(PLACEHOLDER))


def clean_cell(text: Column, tokens: tuple[str, ...] = REVIEW_MISSING) -> Column:
    """Match missing tokens, then trim, then fill: a blank cell ends empty."""
    return fill_placeholder(trim_blanks(missing_to_null(text, tokens)))


def clean_text(text: Column) -> Column:
    """Drop characters outside letters, digits, blanks and plain punctuation."""
    kept = trim_blanks(F.regexp_replace(F.coalesce(text, F.lit("")), _NOT_ALLOWED, ""))
    return F.coalesce(F.nullif(kept, F.lit("")), F.lit(PLACEHOLDER))


def shorter_than(text: Column, limit: int) -> Column:
    """Fewer code points than the limit; a missing text is not short."""
    return F.coalesce(F.length(text) < limit, F.lit(False))


def prefix_label(text: Column, prefix: str, match: str, other: str) -> Column:
    return F.when(text.startswith(prefix), F.lit(match)).otherwise(F.lit(other))


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def joined_title_names(first: Column, last: Column) -> Column:
    """Upper first letter and lower rest of each part, joined without a blank."""
    return F.concat(_title(first), _title(last))


def _title(name: Column) -> Column:
    # substring(name, 2) without a length reads to the end.
    return F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))


# Suffix rules of the plain English stemmer, applied in this order.
STEM_RULES = (
    ("^([a-z]{2,})ies$", "y"),
    ("^([a-z]+(?:s|x|z|ch|sh))es$", ""),
    ("^([a-z]{2,}[^sui])s$", ""),
    ("^([a-z]*[aeiouy][a-z]+)ing$", ""),
    ("^([a-z]*[aeiouy][a-z]+)ed$", ""),
)


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits of the whole text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def stem(word: Column) -> Column:
    """The word without a plain English ending; words in other letters stay."""
    out = word
    for pattern, ending in STEM_RULES:
        out = F.regexp_replace(out, pattern, "$1" + ending)
    # Most words have none of the endings and need no pattern.
    return F.when(word.endswith("s") | word.endswith("ing") | word.endswith("ed"), out).otherwise(word)


def terms(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """What index and query see of a text: its stemmed words without stop words, in order."""
    kept = words(text)
    if stop_words:
        kept = F.filter(kept, lambda w: ~w.isin(*stop_words))
    return F.transform(kept, stem)


def distinct_terms(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """The terms of a text once each; a word is stemmed once, however often it occurs."""
    kept = F.array_distinct(words(text))
    if stop_words:
        kept = F.array_except(kept, F.array(*map(F.lit, stop_words)))
    return F.array_distinct(F.transform(kept, stem))
