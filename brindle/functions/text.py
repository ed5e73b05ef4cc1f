"""Column expressions over text: lines, tokens, neighbouring tokens, snippets.

Everything here is a built-in expression, so it stays on the JVM side.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token delimiters, line terminators, the word limit per line, the snippet length.
DELIMITERS = r" \t\n\r\f"
LINE_END = r"\r\n|\n|\r"
WORD_LIMIT = 40
SNIPPET_CHARS = 80
SNIPPET_TAIL = "..."

# From the first a-z letter of a whitespace-delimited run to its last one.  A run without such a
# letter gives no match, so one pass yields the trimmed, non-empty tokens of a whole line.
TOKEN = f"[a-z](?:[^{DELIMITERS}]*[a-z])?"


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def tokenize(text: str | Column) -> Column:
    """Lower-cased tokens, each cut to the stretch between its first and last a-z letter."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(TOKEN), F.lit(0))


def split_lines(text: str | Column) -> Column:
    """Lines of a text; a terminator at the very end opens no further line, '' has no line."""
    text = as_column(text)
    body = F.regexp_replace(text, rf"(?:{LINE_END})\z", "")
    return F.when(text != "", F.split(body, LINE_END, -1))


def split_fields(text: str | Column) -> Column:
    """Whitespace-separated fields of a trimmed line."""
    return F.split(F.regexp_replace(as_column(text), r"^\s+|\s+$", ""), r"\s+")


def line_words(tokens: str | Column, limit: int = WORD_LIMIT) -> Column:
    """The distinct words among the first ``limit`` tokens."""
    return F.array_distinct(F.slice(as_column(tokens), 1, limit))


def sliding_pairs(tokens: str | Column) -> Column:
    """Array of (left, right) for every two neighbouring tokens; empty below two tokens."""
    tokens = as_column(tokens)
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(
        F.slice(tokens, F.lit(1), pairs).alias("w1"), F.slice(tokens, F.lit(2), pairs).alias("w2")
    )


def snippet(text: str | Column, length: int = SNIPPET_CHARS) -> Column:
    """The text itself, or its first ``length`` characters and an ellipsis if it is longer."""
    text = as_column(text)
    return F.when(
        F.length(text) > length, F.concat(F.substring(text, 1, length), F.lit(SNIPPET_TAIL))
    ).otherwise(text)


def merge_counts(left: str | Column, right: str | Column) -> Column:
    """Merge two word->count maps, adding the counts of common keys."""
    return F.map_zip_with(
        as_column(left),
        as_column(right),
        lambda _, a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)),
    )
