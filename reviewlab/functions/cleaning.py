"""Text-cleaning steps as `Column -> Column` functions; every one stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.text import tokens

ColumnStep = Callable[[Column], Column]


def strip(text: Column) -> Column:
    """Drop Unicode whitespace at both ends (`trim` alone knows only the space).

    Trimming a set of characters walks the whole text, so it is done only where an end needs it.
    """
    chars = list(fv.WHITESPACE_CHARS)
    ragged = F.left(text, F.lit(1)).isin(chars) | F.right(text, F.lit(1)).isin(chars)
    return F.when(ragged, F.btrim(text, F.lit(fv.WHITESPACE_CHARS))).otherwise(text)


def remove_html(text: Column) -> Column:
    return F.regexp_replace(text, fv.HTML_TAG, "")


def lowercase(text: Column) -> Column:
    return F.lower(text)


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, fv.URL, "")


def collapse_whitespace(text: Column) -> Column:
    return F.btrim(F.regexp_replace(text, fv.WHITESPACE_CLASS + "+", " "))


def remove_numbers(text: Column, replace_with: str = "") -> Column:
    return F.regexp_replace(text, fv.DIGITS, _literal_replacement(replace_with))


def remove_punctuation(text: Column, keep: str = "") -> Column:
    return F.translate(text, "".join(c for c in fv.PUNCTUATION if c not in keep), "")


def separate_punctuation(text: Column, keep: str = "") -> Column:
    chars = "".join(c for c in fv.PUNCTUATION if c not in keep)
    return F.regexp_replace(text, f"([{re.escape(chars)}])", " $1 ")


@lru_cache(maxsize=None)
def stopwords(language: str = "english") -> frozenset[str]:
    """The language list without the words that carry negation. Needs a running session."""
    return frozenset(StopWordsRemover.loadDefaultStopWords(language)) - set(fv.KEPT_STOPWORDS)


def remove_stopwords(
    text: Column, language: str = "english", custom: Iterable[str] | None = None
) -> Column:
    words = sorted(stopwords(language) | set(custom or ()))
    return F.array_join(F.filter(tokens(text), lambda t: ~F.lower(t).isin(words)), " ")


def expand_contractions(text: Column) -> Column:
    """Whole-word forms first, then suffixes; only text with an apostrophe is rewritten."""
    out = text
    for short, full in fv.WHOLE_WORD_CONTRACTIONS.items():
        head, tail = short[0], re.escape(short[1:])
        bounded = rf"(?U)\b{{}}(?i:{tail})\b"
        out = F.regexp_replace(out, bounded.format(head.upper()), full[0].upper() + full[1:])
        out = F.regexp_replace(out, bounded.format(head), full)
    for short, full in fv.SUFFIX_CONTRACTIONS.items():
        # "N'T" starts with a capital letter, but its expansion starts with a space: no case to keep
        out = F.regexp_replace(out, f"(?i){re.escape(short)}", full)
    return F.when(F.contains(text, F.lit("'")), out).otherwise(text)


COLUMN_STEPS: dict[str, ColumnStep] = {
    "remove_html": remove_html,
    "lowercase": lowercase,
    "remove_urls": remove_urls,
    "remove_numbers": remove_numbers,
    "remove_extra_whitespace": collapse_whitespace,
    "remove_punctuation": remove_punctuation,
    "separate_punctuation": separate_punctuation,
    "remove_stopwords": remove_stopwords,
    "expand_contractions": expand_contractions,
}


def _literal_replacement(value: str) -> str:
    """Escape `\\` and `$`, which have a meaning in a replacement string."""
    return value.replace("\\", "\\\\").replace("$", "\\$")
