"""Sentences, tokens, n-grams and accent stripping as array expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv

_BREAK = "\u0001"


def tokens(text: Column) -> Column:
    """Words and punctuation marks, with `n't` and `'s`-like endings as tokens of their own."""
    split_negation = F.when(
        F.contains(text, F.lit("'")), F.regexp_replace(text, fv.CLITIC_NEGATION, "$1 $2")
    ).otherwise(text)
    return F.regexp_extract_all(split_negation, F.lit(fv.TOKEN), F.lit(0))


def sentences(text: Column) -> Column:
    """Split after `.`, `!` or `?` followed by whitespace; empty pieces are dropped."""
    marked = F.regexp_replace(text, rf"([.!?]){fv.WHITESPACE_CLASS}+", "$1" + _BREAK)
    return F.filter(F.split(marked, _BREAK), lambda s: F.length(s) > 0)


def sentence_tokens(text: Column) -> Column:
    return F.transform(sentences(text), tokens)


@lru_cache(maxsize=None)
def _accent_table() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions without marks: one-to-one as two strings, the others as a map.

    All of Unicode but the Hangul syllables, whose rule is arithmetic (see `_hangul`).
    """
    source, target, longer = [], [], {}
    for point in range(0x80, sys.maxunicode + 1):
        parts = unicodedata.normalize("NFKD", chr(point)) if not 0xAC00 <= point <= 0xD7A3 else chr(point)
        base = [c for c in parts if not unicodedata.combining(c)]
        if parts != chr(point) and len(base) == 1:
            source.append(chr(point))
            target.append(base[0])
        elif parts != chr(point) and base:
            longer[chr(point)] = "".join(base)
    return "".join(source), "".join(target), longer


def _character_class(characters: Iterable[str]) -> str:
    """A regular-expression class of code-point ranges."""
    held = {ord(c) for c in characters}
    spans = []
    for start in sorted(p for p in held if p - 1 not in held):
        end = start
        while end + 1 in held:
            end += 1
        spans.append(f"\\x{{{start:X}}}-\\x{{{end:X}}}")
    return "[" + "".join(spans) + "]"


def strip_accents(text: Column) -> Column:
    """Characters by their compatibility decomposition, without combining marks.

    Most characters become one other. The few texts with characters that become several (ligatures,
    fractions, Hangul) are taken apart character by character; all others skip that branch.
    """
    source, target, longer = _accent_table()
    pieces = F.create_map(*[F.lit(x) for pair in sorted(longer.items()) for x in pair])

    def unfolded(c: Column) -> Column:
        return F.when(c.between("\uac00", "\ud7a3"), _hangul(c)).otherwise(F.coalesce(F.try_element_at(pieces, c), c))

    by_character = F.array_join(F.transform(F.split(text, ""), unfolded), "")
    # nearly all texts stop at the first, cheap question; of the characters up to U+00FF only fractions unfold
    special = text.rlike(r"[\xBC-\xBE]|[^\x00-\xFF]") & text.rlike(
        _character_class([*longer, *map(chr, range(0xAC00, 0xD7A4))])
    )
    whole = F.when(special, by_character).otherwise(text)
    stripped = F.regexp_replace(F.translate(whole, source, target), r"\p{M}+", "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), stripped).otherwise(text)


def _hangul(syllable: Column) -> Column:
    """A Hangul syllable as its two or three letters, by the arithmetic of the Unicode standard."""
    code = F.conv(F.hex(F.encode(syllable, "UTF-16BE")), 16, 10).cast("int") - 0xAC00
    letters = [
        _letter(0x1100, F.floor(code / 588)), _letter(0x1161, F.floor(F.pmod(code, F.lit(588)) / 28)),
        F.when(F.pmod(code, F.lit(28)) == 0, "").otherwise(_letter(0x11A7, F.pmod(code, F.lit(28)))),
    ]
    return F.concat(*letters)


def _letter(first: int, offset: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex((offset + first).cast("bigint")), 4, "0")), "UTF-16BE")


def words(text: Column) -> Column:
    """Lower-cased, accent-free word tokens: the unit of all vector representations."""
    return F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(fv.WORD), F.lit(0))


def ngrams(word_array: Column, n: int) -> Column:
    """All runs of `n` neighbouring words, joined by a space; none when the text is shorter."""
    grams = word_array
    for shift in range(1, n):
        following = F.slice(word_array, shift + 1, F.greatest(F.size(word_array), F.lit(1)))
        # the longer side is padded with null, and null || x is null: the last gram falls away
        grams = F.array_compact(
            F.zip_with(grams, following, lambda left, right: F.concat(left, F.lit(" "), right))
        )
    return grams


def ngram_range(word_array: Column, low: int, high: int) -> Column:
    parts = [ngrams(word_array, n) for n in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)
