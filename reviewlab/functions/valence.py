"""Valence of a text with word order: boosters, negations, contrast, idioms, capitals and punctuation.

The published rules of a lexicon-based scorer (Hutto and Gilbert, 2014), as one expression within the row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv

_PUNCTUATION = r"!-/:-@\[-`{-~"
_MARK = r"(?:[.!?,;:\-'\"]|!!!?|\?\?\??|\?!\?!?|!\?!\??)"
#: What a marked word starts or ends with; `$` also holds before a line end.
_EDGES = ".!?,;:-'\"\n\r\u0085\u2028\u2029"
_BARE = rf"([^{_PUNCTUATION}\s]{{2,}})"


def _bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then(value)` with `value` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def rule_words(text: Column) -> Column:
    """Blank-separated words of two characters or more; one mark before or after a bare word is dropped."""
    pieces = F.filter(F.split(text, fv.WHITESPACE_CLASS + "+"), lambda w: F.length(w) > 1)

    def bare(word: Column) -> Column:
        cut = F.regexp_replace(F.regexp_replace(word, f"^{_MARK}{_BARE}$", "$1"), f"^{_BARE}{_MARK}$", "$1")
        marked = [F.substring(word, at, 1).isin(*_EDGES) for at in (1, -1)]
        return F.when(marked[0] | marked[1], cut).otherwise(word)

    return F.transform(pieces, bare)


def _negates(low: Column) -> Column:
    return F.coalesce(low.isin(fv.VALENCE_NEGATIONS) | F.contains(low, F.lit("n't")), F.lit(False))


def _is(value: Column, *words: str) -> Column:
    return F.coalesce(value.isin(*words), F.lit(False))


def _word_valence(r: Column, i: Column) -> Column:
    """Valence of word `i` of `r(words, lows, values, caps, mixed)`; `values` is null outside the lexicon."""
    def low(back: int) -> Column:
        return F.get(r["lows"], i - back)

    def word(back: int) -> Column:
        return F.get(r["words"], i - back)

    def joined(*backs: int) -> Column:
        return F.concat_ws(" ", *[word(b) for b in backs])

    def louder(value: Column) -> Column:
        return F.when(value > 0, fv.CAPITALS_STEP).otherwise(-fv.CAPITALS_STEP)

    def before(value: Column, back: int) -> Column:
        """The effect of the word `back` places before."""
        strong, weak = _is(low(back), *fv.BOOSTERS), _is(low(back), *fv.DAMPENERS)
        step = F.when(strong, fv.BOOSTER_STEP).when(weak, -fv.BOOSTER_STEP).otherwise(0.0) * F.when(value < 0, -1.0).otherwise(1.0)
        shout = (strong | weak) & F.get(r["caps"], i - back) & r["mixed"]
        moved = value + (step + F.when(shout, louder(value)).otherwise(0.0)) * fv.BOOSTER_DECAY[back - 1]
        so = [_is(word(b), "so", "this") for b in (1, 2)]
        emphatic = {
            1: F.lit(False), 2: (word(2) == "never") & so[0], 3: ((word(3) == "never") & so[1]) | so[0],
        }[back]
        factor = F.when(F.coalesce(emphatic, F.lit(False)), fv.NEVER_FACTORS[back - 1]).when(_negates(low(back)), fv.NEGATION_FACTOR).otherwise(1.0)
        out = moved * factor
        if back == 3:
            out = _bound(out, idioms)
        return F.when((i >= back) & F.get(r["values"], i - back).isNull(), out).otherwise(value)

    def idioms(value: Column) -> Column:
        known = F.create_map(*[F.lit(x) for pair in fv.VALENCE_IDIOMS.items() for x in pair])
        behind = [joined(1, 0), joined(2, 1, 0), joined(2, 1), joined(3, 2, 1), joined(3, 2)]
        ahead = [F.when(F.get(r["words"], i + 2).isNotNull(), joined(0, -1, -2)), F.when(F.get(r["words"], i + 1).isNotNull(), joined(0, -1))]
        held = F.coalesce(*[F.try_element_at(known, s) for s in [*ahead, *behind]], value)
        return held - F.when(_is(joined(3, 2), *fv.DAMPENER_PAIRS) | _is(joined(2, 1), *fv.DAMPENER_PAIRS), fv.BOOSTER_STEP).otherwise(0.0)

    def least(value: Column) -> Column:
        alone = (low(1) == "least") & F.get(r["values"], i - 1).isNull() & ~((i > 1) & _is(low(2), "at", "very"))
        return F.when(F.coalesce((i > 0) & alone, F.lit(False)), value * fv.NEGATION_FACTOR).otherwise(value)

    own = F.get(r["values"], i)
    out = own + F.when(F.get(r["caps"], i) & r["mixed"], louder(own)).otherwise(0.0)
    for effect in [lambda v: before(v, 1), lambda v: before(v, 2), lambda v: before(v, 3)]:
        out = _bound(out, effect)
    silent = own.isNull() | _is(low(0), *fv.BOOSTERS, *fv.DAMPENERS) | ((low(0) == "kind") & _is(F.get(r["lows"], i + 1), "of"))
    return F.when(silent, 0.0).otherwise(_bound(out, least))


def _contrast(r: Column, valences: Column) -> Column:
    """What stands before the first "but" counts half, what stands after it half as much again."""
    def weighed(but: Column) -> Column:
        return F.transform(valences, lambda v, i: v * F.when(i < but, 0.5).when(i > but, 1.5).otherwise(1.0))

    at = F.array_position(r["lows"], "but") - 1
    return F.when(at >= 0, _bound(at, weighed)).otherwise(valences)


def _scores(text: Column, valences: Column) -> Column:
    marks = [F.length(text) - F.length(F.replace(text, F.lit(m), F.lit(""))) for m in ("!", "?")]
    questions = F.when(marks[1] > 3, fv.MOST_QUESTIONS).when(marks[1] > 1, marks[1] * fv.QUESTION_STEP).otherwise(0.0)
    loud = F.least(marks[0], F.lit(4)) * fv.EXCLAMATION_STEP + questions

    def summed(part: Callable[[Column], Column]) -> Column:
        return F.aggregate(valences, F.lit(0.0), lambda total, v: total + part(v))

    sums = F.struct(
        summed(lambda v: v).alias("all"), summed(lambda v: F.when(v > 0, v + 1).otherwise(0.0)).alias("up"),
        summed(lambda v: F.when(v < 0, 1 - v).otherwise(0.0)).alias("down"), summed(lambda v: F.when(v == 0, 1.0).otherwise(0.0)).alias("flat"),
        loud.alias("loud"),
    )

    def scored(s: Column) -> Column:
        total = s["all"] + F.signum(s["all"]) * s["loud"]
        up = s["up"] + F.when(s["up"] > s["down"], s["loud"]).otherwise(0.0)
        down = s["down"] + F.when(s["up"] < s["down"], s["loud"]).otherwise(0.0)
        whole = up + down + s["flat"]
        return F.struct(
            F.round(total / F.sqrt(total * total + F.lit(fv.VALENCE_ALPHA)), 4).alias("vader_compound"),
            *[F.round(F.coalesce(F.try_divide(x, whole), F.lit(0.0)), 3).alias(f"vader_{n}")
              for x, n in ((up, "positive"), (down, "negative"), (s["flat"], "neutral"))],
        )

    return _bound(sums, scored)


def rule_scores(text: Column, words: Column, own: Column) -> Column:
    """`struct(vader_compound, vader_positive, vader_negative, vader_neutral)` of one text.

    `words` are its `rule_words`, `own` maps lower-cased words to their valences; other words have none.
    A text without words scores zero throughout; its shares are those of positive, negative and other words.
    """
    def row(w: Column) -> Column:
        shouted = F.transform(w, lambda x: (x == F.upper(x)) & (x != F.lower(x)))
        return _bound(F.struct(w.alias("words"), F.transform(w, F.lower).alias("lows"), shouted.alias("caps")), valued)

    def valued(r: Column) -> Column:
        n_caps = F.size(F.filter(r["caps"], lambda c: c))
        return F.struct(
            r["words"].alias("words"), r["lows"].alias("lows"), F.transform(r["lows"], lambda w: F.try_element_at(own, w)).alias("values"),
            r["caps"].alias("caps"), ((n_caps > 0) & (n_caps < F.size(r["words"]))).alias("mixed"),
        )

    def valences(r: Column) -> Column:
        return _bound(F.transform(r["words"], lambda w, i: _word_valence(r, i)), lambda v: _contrast(r, v))

    # words, rows and valences are bound, so that each is computed once a text
    return _bound(_bound(_bound(words, row), valences), lambda v: _scores(text, v))
