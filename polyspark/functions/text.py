"""Text functions, all built from Spark's own string functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Characters that count as white space in Unicode, with the four separators U+001C-U+001F.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITE_SPACE_RUN = "(?U)[\\s\\x1c-\\x1f]+"
FIELD_LENGTH = 2048
FIELD_LEEWAY = 5
ELLIPSIS = "..."


def strip(text: Column) -> Column:
    """Drops white space at both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def truncate(text: Column, length: int = FIELD_LENGTH) -> Column:
    """Text of more than ``length`` + leeway characters is cut at its last space, with an ellipsis."""
    head = F.substring(text, 1, length - len(ELLIPSIS))
    cut = F.regexp_replace(head, " [^ ]*\\z", "")
    return F.when(F.length(text) <= length + FIELD_LEEWAY, text).otherwise(F.concat(cut, F.lit(ELLIPSIS)))


def space_split(text: Column) -> Column:
    """Pieces between runs of white space; text that starts or ends with one gives empty pieces."""
    return F.split(text, WHITE_SPACE_RUN)


def words(text: Column) -> Column:
    """The non-empty pieces between runs of white space."""
    return F.filter(space_split(text), lambda w: w != "")


def has_words(text: Column) -> Column:
    """Whether any character is not white space; looks no further than the first."""
    return text.rlike("(?U)[^\\s\\x1c-\\x1f]")


def count_words(text: Column) -> Column:
    return F.size(space_split(text)).cast("bigint")


def count_bytes(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def characters(text: Column) -> Column:
    """Array of the characters of a text; empty text gives an empty array."""
    return F.filter(F.split(text, ""), lambda c: c != "")


# Pairs that undo the spacing of tokenised English text, in order.
DETOKENIZE = [(" n't", "n't"), (" )", ")"), ("( ", "("), ('" ', '"'), (' "', '"')]
DETOKENIZE_BEFORE = " (['.,])"


def detokenize(text: Column) -> Column:
    for old, new in DETOKENIZE:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, DETOKENIZE_BEFORE, "$1")


# Scripts written without spaces, per language.
UNSPACED = {"zh": "\\p{IsHan}", "ja": "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}"}


def segment_unspaced(text: Column, lang: str) -> Column:
    """Puts each character of an unspaced script between single spaces; other languages stay as they are."""
    if lang not in UNSPACED:
        return text
    spaced = F.regexp_replace(text, f"([{UNSPACED[lang]}])", " $1 ")
    return F.array_join(words(spaced), " ")


# The published mteval-v13a tokenisation.
UNESCAPE = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
TOKEN_13A = [
    ("([\\{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])", " $1 "),
    ("([^0-9])([\\.,])", "$1 $2 "),
    ("([\\.,])([^0-9])", " $1 $2"),
    ("([0-9])(-)", "$1 $2 "),
]


def tokens_13a(text: Column) -> Column:
    """Array of mteval-v13a tokens."""
    text = F.replace(text, F.lit("<skipped>"), F.lit(""))
    text = F.replace(text, F.lit("-\n"), F.lit(""))
    text = F.replace(text, F.lit("\n"), F.lit(" "))
    for old, new in UNESCAPE:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, to in TOKEN_13A:
        text = F.regexp_replace(text, pattern, to)
    return words(text)


def rouge_tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " "), " "), lambda w: w != "")


def ngrams(tokens: Column, n: int) -> Column:
    """Array of the n-grams of an array of strings, joined by single spaces."""
    if n == 1:
        return tokens
    last = F.size(tokens) - (n - 1)
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def char_ngrams(text: Column, n: int) -> Column:
    """Array of the character n-grams of a text."""
    chars = characters(text)
    if n == 1:
        return chars
    # n shifted copies of the characters, joined position by position
    count = F.greatest(F.size(chars) - (n - 1), F.lit(0))
    shifted = [F.slice(chars, F.lit(i + 1), count) for i in range(n)]
    return F.transform(
        F.arrays_zip(*[c.alias(f"c{i}") for i, c in enumerate(shifted)]),
        lambda row: F.concat(*[row[f"c{i}"] for i in range(n)]),
    )


def cut_at_stops(text: Column, stops: Column) -> Column:
    """Text before the first stop string, the stops applied in turn; null stops are skipped."""
    return F.aggregate(
        F.filter(stops, lambda s: s.isNotNull() & (s != "")),
        text,
        lambda kept, stop: F.call_function("substring_index", kept, stop, F.lit(1)),
    )
