"""Sentence ends that know abbreviations, learnt from the texts alone by likelihood ratios (Kiss and Strunk, 2006)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.operators.lookup import lookup_join, row_lookup
from reviewlab.session import materialize

#: From these scores on a type is an abbreviation, and a word is one that starts sentences (published values).
ABBREVIATION, STARTER = 0.3, 30.0
_BREAK, _GAP = "\u0001", "\u0002"
_SPACE = fv.WHITESPACE_CLASS + "+"
_NO_SPACE = "[^" + fv.WHITESPACE_CLASS[1:]


def _pieces(text: Column) -> Column:
    """The text cut at white space behind `.`, `!` or `?`; every second piece is the white space itself."""
    return F.split(F.regexp_replace(text, rf"([.!?])({_SPACE})", f"$1{_GAP}$2{_GAP}"), _GAP)


def _last_word(piece: Column) -> Column:
    return F.regexp_replace(piece, rf"(?s)\A.*{fv.WHITESPACE_CLASS}", "")


def _first_word(piece: Column) -> Column:
    return F.regexp_extract(piece, rf"\A{_NO_SPACE}*", 0)


def _type(word: Column) -> Column:
    """A word without its last period, in lower case, numbers as one type. Most words meet no expression."""
    bare = F.lower(F.when(F.contains(word, F.lit(".")), F.regexp_replace(word, r"\.$", "")).otherwise(word))
    # a number starts with a character from plus to nine
    number = F.regexp_replace(bare, r"^[-+]?[0-9][0-9.,]*$", "##number##")
    return F.when((word >= "+") & (word < ":"), number).otherwise(bare)


def _log_likelihood(successes: Column, trials: Column, p: Column) -> Column:
    """Of so many successes under probability `p`, without the binomial coefficient, which cancels out."""
    p = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return successes * F.log(p) + (trials - successes) * F.log1p(-p)


def abbreviations(df: DataFrame, text: str = "text") -> DataFrame:
    """`(type, score)` of the types that mostly stand before a period though sentences rarely end there.

    The score is the likelihood ratio of "always before a period" (0.99) against "as often as any word",
    less for long types, more for inner periods, less for occurrences without a period. One row per type of
    each task moves.
    """
    words = df.select(F.explode(F.split(F.col(text), _SPACE)).alias("w")).where(F.col("w") != "")
    types = words.groupBy(_type(F.col("w")).alias("type")).agg(
        F.count_if(F.endswith("w", F.lit("."))).alias("closed"), F.count_if(~F.endswith("w", F.lit("."))).alias("open")
    )
    types = materialize(types, "types")
    totals = types.agg(F.struct(F.sum("closed").alias("periods"), F.sum(F.col("closed") + F.col("open")).alias("words"))).scalar()
    lettered = types.where((F.col("closed") > 0) & F.col("type").rlike(r"\p{L}") & (F.col("type") != "##number##"))
    n = F.col("closed") + F.col("open")
    ratio = 2 * (_log_likelihood(F.col("closed"), n, F.lit(0.99)) - _log_likelihood(F.col("closed"), n, totals["periods"] / totals["words"]))
    inner = F.length("type") - F.length(F.replace("type", F.lit("."), F.lit("")))
    size = F.length("type") - inner + 1
    score = ratio * F.exp(-size) * (inner + 1) * F.pow(size.cast("double"), -F.col("open"))
    return lettered.select("type", score.alias("score")).where(F.col("score") >= ABBREVIATION)


def starters(df: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """`(word, score)` of the words that stand behind clear sentence ends more often than by chance."""
    ends = _marked(df, known, text)
    opened = ends.select(F.explode(F.filter("_cuts", lambda c: ~c["doubtful"])["word"]).alias("w"))
    first = opened.where(F.col("w").rlike(r"^\p{L}+[,;:]?$")).groupBy(_bare(F.col("w")).alias("word")).agg(F.count("*").alias("starts"))
    all_words = df.select(F.explode(F.split(F.col(text), _SPACE)).alias("w")).where(F.col("w").rlike(r"^\p{L}+[.!?,;:]?$"))
    counted = all_words.groupBy(_bare(F.col("w")).alias("word")).agg(F.count("*").alias("n"))
    table = materialize(counted.join(first, "word", "left").fillna({"starts": 0}), "starter-counts")
    totals = table.agg(F.struct(F.sum("starts").alias("starts"), F.sum("n").alias("words"))).scalar()
    starts, others, trials = F.col("starts"), F.col("n") - F.col("starts"), totals["words"] - totals["starts"]
    share, rest, p = F.try_divide(starts, totals["starts"]), F.try_divide(others, trials), F.try_divide(F.col("n"), totals["words"])
    ratio = 2 * (
        _log_likelihood(starts, totals["starts"], share) + _log_likelihood(others, trials, rest)
        - _log_likelihood(starts, totals["starts"], p) - _log_likelihood(others, trials, p)
    )
    return table.where((F.col("starts") > 0) & (share > p)).select("word", ratio.alias("score")).where(F.col("score") >= STARTER)


def _bare(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, r"[.!?,;:]$", ""))


def _marked(df: DataFrame, known: DataFrame, text: str) -> DataFrame:
    """The rows of `df` with `_parts` (text, white space, text, ...) and, per cut between texts, `_cuts`: the
    word behind it and whether the word before it is an abbreviation, a single letter or a number.

    A short table of abbreviations is searched within the row. Of a long one only the distinct types before a
    period meet it, and only hits come back.
    """
    texts = F.filter("_parts", lambda p, i: i % 2 == 0)
    rows = df.withColumn("_parts", _pieces(F.coalesce(F.col(text), F.lit("")))).withColumn("_texts", texts)
    rows = rows.withColumn("_last", F.transform("_texts", _last_word)).withColumn("_next", F.transform("_texts", _first_word)).drop("_texts")
    rows = rows.withColumn("_types", F.transform("_last", lambda w: F.when(F.endswith(w, F.lit(".")), _type(w))))
    listed = materialize(known.select("type", F.lit("").alias("_found")).where("type is not null").distinct(), "abbreviations")
    find = row_lookup(listed, "type", "_found")
    if find is not None:
        joined = rows.withColumn("_listed", F.transform("_types", lambda t: find(t).isNotNull()))
    else:
        name = "_row_id"
        rows = materialize(rows.withColumn(name, F.monotonically_increasing_id()), "sentence-parts")
        held = rows.select(name, F.explode(F.array_distinct(F.array_compact("_types"))).alias("type"))
        hits = lookup_join(held, listed.select("type"), ["type"], spread=F.col(name), how="left_semi").groupBy(name).agg(F.collect_set("type").alias("_known"))
        of_row = F.coalesce("_known", F.array().cast("array<string>"))
        joined = rows.join(hits, name, "left").withColumn("_known", of_row).withColumn(
            "_listed", F.transform("_types", lambda t: F.array_contains("_known", t))
        ).drop(name, "_known")

    # side by side, not by position: a column that is looked up within a lambda may be computed per element
    following = F.slice("_next", 2, F.greatest(F.size("_next"), F.lit(1)))

    def cut(at: Column) -> Column:
        doubtful = at["_types"].isNotNull() & (
            at["_listed"] | at["_last"].rlike(r"^\p{L}\.$") | (at["_types"] == "##number##")
        )
        return F.struct(at["word"].alias("word"), doubtful.alias("doubtful"))

    places = F.arrays_zip("_types", "_listed", "_last", following.alias("word"))
    cuts = F.filter(F.transform(places, cut), lambda c: c["word"].isNotNull())
    return joined.withColumn("_cuts", cuts).drop("_last", "_next", "_types", "_listed")


def split_sentences(df: DataFrame, known: DataFrame, first_words: DataFrame | None = None, text: str = "text") -> DataFrame:
    """`df` with the array `sentences`: cut behind `.`, `!` and `?`, but behind an abbreviation, a single letter
    or a number only before a capitalised word that starts sentences.

    `known` and `first_words` come from `abbreviations` and `starters`. Null and empty text has no sentences;
    white space between sentences falls away, inside a sentence it stays. Rows may repeat.
    """
    none = F.array().cast("array<string>")
    rows = _marked(df, known, text).withColumn("_id", F.monotonically_increasing_id())
    if first_words is None:
        rows = rows.withColumn("_first", none)
    else:
        rows = materialize(rows, "sentence-cuts")
        behind = F.transform(F.filter("_cuts", lambda c: c["doubtful"]), lambda c: _bare(c["word"]))
        held = rows.select("_id", F.explode(F.array_distinct(behind)).alias("word"))
        hits = lookup_join(held, first_words.select("word"), ["word"], spread=F.col("_id"), how="left_semi")
        hits = hits.groupBy("_id").agg(F.collect_set("word").alias("_first"))
        rows = rows.join(hits, "_id", "left").withColumn("_first", F.coalesce("_first", none))

    def mended(part: Column, i: Column) -> Column:
        """A text as it is; white space between sentences as a break."""
        cut = F.get("_cuts", ((i - 1) / 2).cast("int"))
        opens = F.array_contains("_first", _bare(cut["word"])) & cut["word"].rlike(r"^\p{Lu}")
        return F.when((i % 2 == 0) | (cut["doubtful"] & ~opens), part).otherwise(_BREAK)

    joined = F.array_join(F.transform("_parts", mended), "")
    found = F.filter(F.split(joined, _BREAK), lambda s: F.length(s) > 0)
    return rows.withColumn("sentences", found).select(*df.columns, "sentences")
