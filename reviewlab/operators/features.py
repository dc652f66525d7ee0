"""The linguistic features, computed within the row."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.keys import row_keys
from reviewlab.functions.text import sentence_tokens, sentences, tokens
from reviewlab.functions.valence import rule_scores, rule_words
from reviewlab.operators.corpus import bounded_ratio
from reviewlab.operators.lookup import bucket_entry, bucket_value, in_buckets, lookup_join

# --- lexicon --------------------------------------------------------------------------------


def basic_lexicon(spark: SparkSession) -> DataFrame:
    """The built-in word list as `(term, valence)`."""
    rows = [(w, 1.0) for w in fv.POSITIVE_WORDS] + [(w, -1.0) for w in fv.NEGATIVE_WORDS]
    return spark.createDataFrame(rows, "term string, valence double")


def lexicon_split(lexicon: DataFrame) -> DataFrame:
    """Terms that carry an opinion, as positive or negative; zero valence drops out."""
    polarity = F.when(F.col("valence") > 0, "positive").when(F.col("valence") < 0, "negative")
    return lexicon.select("term", "valence", polarity.alias("polarity")).where(
        F.col("polarity").isNotNull()
    )


def _valences(lexicon: DataFrame, term: str, valence: str) -> DataFrame:
    # one entry per term, so a lookup cannot multiply tokens
    return lexicon.groupBy(F.lower("term").alias(term)).agg(F.max("valence").alias(valence))


# --- words of a document and their valences --------------------------------------------------

# A lexicon up to this size, with so many different valences, is spelled out within the row.
INLINE_WORD_LIMIT = 20_000
INLINE_VALENCES = 64


class _Scored:
    """Rows with their words in `_words`, and the valence of a word as an expression on the row.

    A listed lexicon is a chain of set memberships: no join and no shuffle. A larger one is joined once
    per document and distinct word, and each document gets the valences of its own words as small maps, in
    which every word is looked up once (`_values`, side by side with `_words`; words of valence 0 count as
    unlisted ones). Either way every row of the input, copies of a document included, keeps its own result.
    """

    def __init__(self, rows: DataFrame, lexicon: DataFrame, others: str | None = None):
        valences = _valences(lexicon, "word", "valence").where(F.col("word").isNotNull())
        listed = valences.limit(INLINE_WORD_LIMIT + 1).collect()
        by_value: dict[float, list[str]] = {}
        for entry in listed:
            if entry["valence"] is not None:
                by_value.setdefault(float(entry["valence"]), []).append(entry["word"])
        if len(listed) > INLINE_WORD_LIMIT or len(by_value) > INLINE_VALENCES:
            own = _with_own_valences(rows, valences.where("valence <> 0"), others, in_parts=True)
            self.rows, self._by_value = own.withColumn("_values", self._looked_up("_words")), None
        else:
            self.rows, self._by_value = rows, {v: sorted(w) for v, w in sorted(by_value.items())}

    @staticmethod
    def _looked_up(words: str) -> Column:
        return F.transform(words, lambda w: bucket_value(F.col("_own"), w))

    def _own_values(self, words: str) -> Column:
        return F.col("_values") if words == "_words" else self._looked_up(words)

    def count(self, words: str, above: float | None = None, below: float | None = None) -> Column:
        """Words with a valence above or below a limit; other than zero without limits."""
        def wanted(v):
            return v > above if above is not None else v < below if below is not None else v != 0

        if self._by_value is None:
            own = F.filter(self._own_values(words), lambda v: F.coalesce(wanted(v), F.lit(False)))
        else:
            listed = [w for v, ws in self._by_value.items() if wanted(v) for w in ws]
            own = F.filter(words, lambda w: w.isin(listed)) if listed else F.array()
        return F.size(own).cast("bigint")

    def total(self, words: str) -> Column:
        """Sum of the valences."""
        if self._by_value is None:
            return F.aggregate(self._own_values(words), F.lit(0.0), lambda sum_, v: sum_ + F.coalesce(v, F.lit(0.0)))
        parts = [
            F.lit(v) * F.size(F.filter(words, _among(ws)))
            for v, ws in self._by_value.items()
        ]
        return sum(parts, F.lit(0.0))


def _among(listed: list[str]):
    return lambda w: w.isin(listed)


def _with_own_valences(rows: DataFrame, valences: DataFrame, others: str | None, in_parts: bool = False) -> DataFrame:
    """Add `_own`, a map from each document's words (and those in `others`) to their valences.

    With `in_parts` it is an array of maps for `bucket_value`, null for a document without any.
    """
    words = F.col("_words") if others is None else F.concat("_words", others)
    held = rows.select("doc_id", F.explode(F.array_distinct(words)).alias("word"))
    joined = lookup_join(held, valences, ["word"], spread=F.col("doc_id"), how="inner", of_a_key=rows.count)  # each row names a word once
    # rows of the same document meet here, with their hits only
    if in_parts:
        entries = F.collect_set(bucket_entry(F.col("word"), F.col("valence")))
        return rows.join(joined.groupBy("doc_id").agg(in_buckets(entries).alias("_own")), "doc_id", "left")
    maps = joined.groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("word", "valence"))).alias("_own"))
    return rows.join(maps, "doc_id", "left").withColumn(
        "_own", F.coalesce("_own", F.create_map().cast("map<string,double>"))
    )


def _document_words(df: DataFrame, text: str) -> DataFrame:
    """The rows of `df` with the lower-cased tokens of the text and their number."""
    lowered = df.select(*row_keys(df), tokens(F.lower(text)).alias("_words"))
    return lowered.withColumn("token_count", F.size("_words").cast("bigint"))


def _opinion_columns(scored: _Scored) -> list[Column]:
    positive, negative = scored.count("_words", above=0), scored.count("_words", below=0)
    return [
        positive.alias("positive_word_count"),
        negative.alias("negative_word_count"),
        bounded_ratio(positive - negative, F.col("token_count")).alias("opinion_word_ratio"),
    ]


def _listed_count(listed: list[str]) -> Column:
    return F.size(F.filter("_words", lambda w: w.isin(listed))).cast("bigint") if listed else F.lit(0).cast("bigint")


def _domain_columns(scored: _Scored, domain: Iterable[str]) -> list[Column]:
    hits = _listed_count(_lowered(domain))
    return [
        hits.alias("domain_word_count"),
        bounded_ratio(hits, F.col("token_count")).alias("domain_word_ratio"),
        (hits > 0).alias("has_domain_words"),
        ((scored.count("_words") > 0) & (hits > 0)).alias("domain_opinion_overlap"),
    ]


def _valence_columns(scored: _Scored) -> list[Column]:
    n, total = F.col("token_count"), scored.total("_words")
    positive, negative = scored.count("_words", above=0), scored.count("_words", below=0)
    neutral = F.when(n > 0, bounded_ratio(n - positive - negative, n)).otherwise(0.0)
    return [
        (total / F.sqrt(total * total + F.lit(fv.VALENCE_ALPHA))).alias("vader_compound"),
        bounded_ratio(positive, n).alias("vader_positive"),
        bounded_ratio(negative, n).alias("vader_negative"),
        neutral.alias("vader_neutral"),
    ]


def _lowered(words: Iterable[str]) -> list[str]:
    return sorted({w.lower() for w in words})


def opinion_words(df: DataFrame, lexicon: DataFrame, text: str = "text") -> DataFrame:
    scored = _Scored(_document_words(df, text), lexicon)
    return scored.rows.select(*row_keys(df), *_opinion_columns(scored))


def domain_vocabulary(
    df: DataFrame,
    lexicon: DataFrame,
    domain: Iterable[str] = fv.DOMAIN_WORDS_SHORT,
    text: str = "text",
) -> DataFrame:
    scored = _Scored(_document_words(df, text), lexicon)
    return scored.rows.select(*row_keys(df), *_domain_columns(scored, domain))


def domain_word_frequency(
    df: DataFrame, domain: Iterable[str] = fv.DOMAIN_WORDS_SHORT, text: str = "text"
) -> DataFrame:
    """Occurrences of each domain term over all documents (combined on the map side)."""
    listed = _lowered(domain)
    hits = F.filter(tokens(F.lower(text)), lambda w: w.isin(listed))
    return df.select(F.explode(hits).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def valence_scores(df: DataFrame, lexicon: DataFrame | None, text: str = "text") -> DataFrame:
    """Normalised valence sum and shares of matched words; zeros without a lexicon."""
    if lexicon is None:
        names = ("vader_compound", "vader_positive", "vader_negative", "vader_neutral")
        return df.select(*row_keys(df), *[F.lit(0.0).alias(c) for c in names])
    scored = _Scored(_document_words(df, text), lexicon)
    return scored.rows.select(*row_keys(df), *_valence_columns(scored))


def rule_valence_scores(df: DataFrame, lexicon: DataFrame, text: str = "text") -> DataFrame:
    """Valence by word order: boosters, negations, contrast, idioms, capitals and punctuation count.

    Each document gets the valences of its own words as a map, by one join of its distinct words; the rules
    then work within the row. Null text scores zero. Of contradicting lexicon entries the largest counts.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = rule_words(body)
    rows = df.select(*row_keys(df), body.alias("_text"), F.transform(words, F.lower).alias("_words"))
    scored = _with_own_valences(rows, _valences(lexicon, "word", "valence").where("word is not null and valence is not null"), None)
    found = rule_scores(F.col("_text"), rule_words(F.col("_text")), F.col("_own")).alias("_scores")
    return scored.select(*row_keys(df), found).select(*row_keys(df), "_scores.*")


def structural_features(
    df: DataFrame, text: str = "text", include_rating: bool = True
) -> DataFrame:
    """Lengths and counts per document. No shuffle: everything is computed within the row."""
    measured = df.select(
        "doc_id",
        F.length(text).cast("bigint").alias("text_length"),
        F.size(sentences(F.col(text))).cast("bigint").alias("sentence_count"),
        F.size(tokens(F.col(text))).cast("bigint").alias("token_count"),
        *(["rating"] if include_rating else []),
    )
    average = bounded_ratio(F.col("token_count"), F.col("sentence_count"))
    return measured.withColumn("avg_sentence_length", average)


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


# --- negations and degree words from annotations --------------------------------------------


def negations(annotations: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Negation counts per document, and how many negations point at an opinion word."""
    return _annotation_features(annotations, lexicon).select(
        "doc_id", "negation_count", "has_negation", "negated_opinion_words"
    )


def intensifiers(
    annotations: DataFrame,
    strong: Iterable[str] = fv.INTENSIFIERS,
    weak: Iterable[str] = fv.MITIGATORS,
) -> DataFrame:
    strong_count, weak_count = _degree_counts(strong, weak)
    return annotations.groupBy("doc_id").agg(
        strong_count.alias("intensifier_count"),
        weak_count.alias("mitigator_count"),
        (strong_count > 0).alias("has_intensifier"),
        (weak_count > 0).alias("has_mitigator"),
    )


def _degree_counts(strong: Iterable[str], weak: Iterable[str]) -> tuple[Column, Column]:
    modifier = F.col("dep_label").isin("advmod", "amod")
    strong_word = F.lower("token").isin(list(strong))
    return (
        _count_if(modifier & strong_word),
        _count_if(modifier & ~strong_word & F.lower("token").isin(list(weak))),
    )


def _annotation_features(
    annotations: DataFrame,
    lexicon: DataFrame,
    strong: Iterable[str] = fv.INTENSIFIERS,
    weak: Iterable[str] = fv.MITIGATORS,
) -> DataFrame:
    """All columns that depend on annotations, from one aggregate per document.

    An annotation names its head word, so whether a negation hits an opinion word is a lookup of
    that word; `fill_heads` adds the words where only positions are known.
    """
    is_negation = F.col("dep_label") == "neg"
    heads = annotations.withColumn("_head", F.when(is_negation, F.lower("head")))
    scored = lookup_join(
        heads, _valences(lexicon, "_head", "_valence"), ["_head"],
        spread=F.xxhash64("doc_id", "sentence_idx"),
    )
    strong_count, weak_count = _degree_counts(strong, weak)
    counts = {
        "negation_count": _count_if(is_negation),
        "negated_opinion_words": _count_if(F.col("_valence") != 0),
        "intensifier_count": strong_count,
        "mitigator_count": weak_count,
    }
    flags = {"negation": "negation_count", "intensifier": "intensifier_count", "mitigator": "mitigator_count"}
    return scored.groupBy("doc_id").agg(
        *[count.alias(name) for name, count in counts.items()],
        *[(counts[name] > 0).alias(f"has_{flag}") for flag, name in flags.items()],
    )


# --- all features ---------------------------------------------------------------------------

_FROM_ANNOTATIONS = [
    "negation_count", "has_negation", "negated_opinion_words", "intensifier_count",
    "mitigator_count", "has_intensifier", "has_mitigator",
]


def linguistic_features(
    df: DataFrame,
    lexicon: DataFrame,
    domain: Iterable[str] = fv.DOMAIN_WORDS_SHORT,
    annotations: DataFrame | None = None,
    text: str = "text",
    include_rating: bool = True,
    negation_cues: Iterable[str] = fv.NEGATION_CUES,
    strong: Iterable[str] = fv.INTENSIFIERS,
    weak: Iterable[str] = fv.MITIGATORS,
) -> DataFrame:
    """`doc_id`, `label` and the 23 features (22 without the rating), in their fixed order.

    Everything is computed within the row, copies of a document (`draw`) included; only a lexicon too
    large to be listed takes a join. With `annotations` the negation and degree columns come from them
    and are joined in. Without, the cue rules are applied to neighbouring tokens.
    """
    cues, strong_words = _lowered(negation_cues), sorted(set(_lowered(strong)) - set(_lowered(negation_cues)))
    weak_words = sorted(set(_lowered(weak)) - set(strong_words) - set(cues))
    measured = df.select(
        *row_keys(df), "label", "rating",
        F.length(text).cast("bigint").alias("text_length"),
        sentence_tokens(F.lower(text)).alias("_sentences"),
    )
    following = F.flatten(F.transform("_sentences", lambda s: _after(s, cues)))
    arrays = measured.select(
        *row_keys(df), "label", "rating", "text_length",
        F.size("_sentences").cast("bigint").alias("sentence_count"),
        F.flatten("_sentences").alias("_words"),
        (following if annotations is None else F.array().cast("array<string>")).alias("_negated"),
    ).withColumn("token_count", F.size("_words").cast("bigint"))
    scored = _Scored(arrays, lexicon, others="_negated")
    columns = [*_opinion_columns(scored), *_domain_columns(scored, domain), *_valence_columns(scored)]
    if annotations is None:
        counts = {
            "negation": _listed_count(cues),
            "intensifier": _listed_count(strong_words),
            "mitigator": _listed_count(weak_words),
        }
        columns += [count.alias(f"{name}_count") for name, count in counts.items()]
        columns += [(count > 0).alias(f"has_{name}") for name, count in counts.items()]
        columns.append(scored.count("_negated").alias("negated_opinion_words"))
    kept = [*row_keys(df), "label", "rating", "text_length", "sentence_count", "token_count"]
    features = scored.rows.select(*kept, *columns).withColumn(
        "avg_sentence_length", bounded_ratio(F.col("token_count"), F.col("sentence_count"))
    )
    if annotations is not None:
        extra = _annotation_features(annotations, lexicon, strong, weak)
        features = features.join(extra, "doc_id", "left")
        for name in _FROM_ANNOTATIONS:
            missing = F.lit(False) if name.startswith("has_") else F.lit(0).cast("bigint")
            features = features.withColumn(name, F.coalesce(name, missing))
    wanted = [c for c in fv.FEATURE_COLUMNS if include_rating or c != "rating"]
    return features.select(*row_keys(df), "label", *wanted)


def _after(sentence: Column, cues: list[str]) -> Column:
    """The tokens that directly follow a cue in the sentence."""
    shifted = F.slice(sentence, 2, F.greatest(F.size(sentence), F.lit(1)))
    return F.array_compact(F.zip_with(sentence, shifted, lambda w, after: F.when(w.isin(cues), after)))
