"""Tokenizers as Column expressions.

Everything here is a built-in Spark expression (``lower``, ``translate``,
``split``, ``regexp_extract_all``, higher-order ``filter``/``zip_with``), so
tokenization runs inside whole-stage codegen on the executors; no UDF.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stopwords import ENGLISH_STOP_WORDS

# Fixed values.
# ASCII punctuation deleted (not replaced by a space) by the BM25 tokenizer.
PUNCTUATION = string.punctuation
# The characters Python's ``str.split()`` treats as whitespace, as a character
# class valid in both Java regex and RE2.
WHITESPACE_RUN = (
    r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
# Maximal runs of two or more word characters (letters, digits, underscore).
WORD_RUN = r"[\p{L}\p{N}_]{2,}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bm25_document_text(title: Column | str | None, text: Column | str) -> Column:
    """``title + " " + text``; a missing title counts as the empty string."""
    t = F.lit("") if title is None else F.coalesce(_col(title), F.lit(""))
    return F.concat(t, F.lit(" "), _col(text))


def vector_document_text(title: Column | str | None, text: Column | str) -> Column:
    """``title + ". " + text``; a missing title counts as the empty string."""
    t = F.lit("") if title is None else F.coalesce(_col(title), F.lit(""))
    return F.concat(t, F.lit(". "), _col(text))


def bm25_tokens(text: Column | str) -> Column:
    """Lower-case, delete ASCII punctuation, split on whitespace runs, drop
    tokens of one character.  Order and duplicates are kept."""
    cleaned = F.translate(F.lower(_col(text)), PUNCTUATION, "")
    return F.filter(F.split(cleaned, WHITESPACE_RUN), lambda t: F.length(t) > 1)


def word_tokens(text: Column | str) -> Column:
    """Lower-case word runs of length >= 2 (vector tokenizer)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_RUN), 0)


def remove_stop_words(words: Column, stop_words: Iterable[str] | None = ENGLISH_STOP_WORDS) -> Column:
    """Drop stop words; the IN-list is turned into a hash set by the optimizer."""
    stop = list(stop_words or ())
    if not stop:
        return words
    return F.filter(words, lambda t: ~t.isin(stop))


def word_ngrams(words: Column, ngram_range: tuple[int, int] = (1, 2)) -> Column:
    """All n-grams for n in ``ngram_range`` (inclusive), unigrams first, each
    n-gram joined by one space.  Arrays shorter than n give no n-grams."""
    lo, hi = ngram_range
    if lo < 1 or hi < lo:
        raise ValueError(f"invalid ngram_range {ngram_range!r}")
    size = F.size(words)
    parts: list[Column] = []
    for n in range(lo, hi + 1):
        if n == 1:
            parts.append(words)
        elif n == 2:
            m = F.greatest(size - 1, F.lit(0))
            parts.append(F.zip_with(F.slice(words, 1, m), F.slice(words, 2, m),
                                    lambda a, b: F.concat_ws(" ", a, b)))
        else:
            m = size - n + 1
            grams = F.transform(F.sequence(F.lit(1), F.greatest(m, F.lit(1))),
                                lambda i: F.array_join(F.slice(words, i, n), " "))
            parts.append(F.when(m >= 1, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def vector_words(text: Column | str, stop_words: Iterable[str] | None = ENGLISH_STOP_WORDS) -> Column:
    """Word runs with stop words removed; n-grams are built from these."""
    return remove_stop_words(word_tokens(text), stop_words)


def vector_terms(text: Column | str, ngram_range: tuple[int, int] = (1, 2),
                 stop_words: Iterable[str] | None = ENGLISH_STOP_WORDS) -> Column:
    """Vector-side terms: word runs, stop words removed, then n-grams (so a
    bigram may jump over a removed word).  For a DataFrame, project
    ``vector_words`` first and apply ``word_ngrams`` to that column so the
    regex runs once per row."""
    return word_ngrams(vector_words(text, stop_words), ngram_range)


def with_term_counts(df: DataFrame, tokens: str, out: str) -> DataFrame:
    """``df`` with ``out``: array<struct<term, tf>> of the distinct values of the
    array column ``tokens``, as run lengths of the sorted array -- counted
    inside the row, no exchange.  A null array gives an empty one."""
    s, at = F.col("_sorted"), F.col("_starts")
    n = F.size(s)
    empty = F.array().cast("array<int>")
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1),
                                    lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))).otherwise(empty)
    runs = F.transform(at, lambda i, j: F.struct(
        F.get(s, i).alias("term"), (F.coalesce(F.get(at, j + 1), n) - i).alias("tf")))
    # sort_array: the comparator of array_sort is interpreted
    return (df.withColumn("_sorted", F.sort_array(F.coalesce(F.col(tokens), F.array().cast("array<string>"))))
            .withColumn("_starts", starts).withColumn(out, runs).drop("_sorted", "_starts"))
