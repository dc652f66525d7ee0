"""Term vocabularies and document vectors in long form.

`terms` is `(term, idx, df, tf, idf)`; `vectors` is `(doc_id, idx, value)`. In this form fitting
is an aggregate, transforming a join, and stacking a union.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.keys import row_keys
from reviewlab.functions.text import words
from reviewlab.operators import gram_counts
from reviewlab.operators.counting_filter import repeated_counts
from reviewlab.operators.lookup import BROADCAST_ROW_LIMIT, is_small, lookup_join, only_once
from reviewlab.operators.ranking import ordinals
from reviewlab.session import materialize


def document_words(df: DataFrame, text: str = "text", key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """`(doc_id, words)` and the columns of `carry`: the input of everything below; drawn copies keep their `draw`."""
    draw = ["draw"] if "draw" in df.columns else []
    return df.select(F.col(key).alias("doc_id"), *draw, *carry, words(F.col(text)).alias("words"))


def term_counts(documents: DataFrame, ngram_sizes: tuple[int, int] = (1, 1)) -> DataFrame:
    """`(doc_id, term, tf)` from `(doc_id, words)`; a document without words has no rows."""
    keys = row_keys(documents)
    return _exploded(documents, ngram_sizes).groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def _exploded(documents: DataFrame, ngram_sizes: tuple[int, int]) -> DataFrame:
    """One row per n-gram occurrence, where the document's row lies."""
    keys = row_keys(documents)
    low, high = ngram_sizes
    shifted = [F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))) for i in range(high)]
    names = [f"_w{i}" for i in range(high)]
    zipped = F.arrays_zip(*[part.alias(name) for part, name in zip(shifted, names)])
    # one row per position with the words from there on; null past the end, which makes a gram null
    rows = documents.select(*keys, F.inline_outer(zipped)).toDF(*keys, *names)
    grams = [_spaced(names[:n]) for n in range(low, high + 1)]
    unfolded = rows.select(*keys, F.explode(F.array(*grams)).alias("term"))
    return unfolded.where(F.col("term").isNotNull())


def _spaced(names: list[str]) -> Column:
    parts: list[Column] = [F.col(names[0])]
    for name in names[1:]:
        parts += [F.lit(" "), F.col(name)]
    return F.concat(*parts)


def term_statistics(
    documents: DataFrame, ngram_sizes: tuple[int, int] = (1, 1), repeated_only: bool = False, *keep: gram_counts.Keep
) -> DataFrame:
    """`(term, df, tf)` without bringing a document together: no shuffle but the one on terms.

    N-grams are counted in runs of documents first (`gram_counts`), which also takes care of very frequent
    terms; the runs of a task add up before the shuffle. With `repeated_only` most n-grams of a single
    document are left out before that (`counting_filter`), with `keep` all that it does not want.
    """
    if ngram_sizes[1] == 1 and not repeated_only and not keep:
        # single words cost more on their way to Python than it saves
        counts = _marked_words(documents)
    else:
        counts = (repeated_counts if repeated_only else gram_counts.counted)(documents, ngram_sizes, *keep)
    return counts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def _marked_words(documents: DataFrame) -> DataFrame:
    """`(term, df, tf)`: each word once per occurrence (for tf) and once per distinct value (for df)."""
    marked = F.concat(
        F.transform("words", lambda w: F.struct(w.alias("term"), F.lit(0).alias("df"), F.lit(1).alias("tf"))),
        F.transform(
            F.array_distinct("words"), lambda w: F.struct(w.alias("term"), F.lit(1).alias("df"), F.lit(0).alias("tf")),
        ),
    )
    return documents.select(F.inline(marked))


def fit_terms(
    documents: DataFrame,
    ngram_sizes: tuple[int, int] = (1, 1),
    max_features: int | None = None,
    min_df: int | float = 1,
    max_df: int | float = 1.0,
    counting_filter: bool = False,
) -> DataFrame:
    """The vocabulary of `(doc_id, words)`.

    Terms outside the document-frequency limits go first (an int is a count, a float a share of all
    documents), then the `max_features` most frequent stay, ties by term. `idx` follows the
    alphabetical order; idf = ln((1 + n) / (1 + df)) + 1. `counting_filter` reads the documents twice to
    shuffle fewer n-grams where `min_df` asks for two documents or more; the result is the same.
    """
    n_documents = documents.agg(F.count("*")).scalar().cast("double")

    def documents_for(limit: int | float) -> Column:
        return F.lit(limit) * n_documents if isinstance(limit, float) else F.lit(limit)

    wanted = min_df * documents.count() if counting_filter and isinstance(min_df, float) else min_df
    repeated_only = counting_filter and wanted > 1

    def statistics(*keep: gram_counts.Keep) -> DataFrame:
        return term_statistics(documents, ngram_sizes, repeated_only, *keep).where(
            (F.col("df") >= documents_for(min_df)) & (F.col("df") <= documents_for(max_df))
        )

    idf = F.log((1.0 + n_documents) / (1.0 + F.col("df"))) + 1.0
    if max_features is not None and max_features <= BROADCAST_ROW_LIMIT:
        top = _most_frequent(_frequent_statistics(documents, ngram_sizes, max_features, statistics), max_features)
        # one task, but never more than max_features rows
        alphabetical = Window.partitionBy(F.lit(1)).orderBy("term")
        placed = top.withColumn("idx", (F.row_number().over(alphabetical) - 1).cast("bigint"))
    else:
        stats = statistics()
        if max_features is not None:
            by_frequency = stats.withColumn("_order", -F.col("tf"))
            stats = ordinals(by_frequency, ["_order", "term"], "_rank").where(
                F.col("_rank") < max_features
            ).drop("_order", "_rank")
        placed = ordinals(stats, ["term"], "idx")
    return placed.select("term", "idx", "df", "tf", idf.alias("idf"))


def _frequent_statistics(
    documents: DataFrame, ngram_sizes: tuple[int, int], n: int, statistics: Callable[..., DataFrame]
) -> DataFrame:
    """The rows of `statistics`, written, without most of those that are not among the `n` most frequent.

    A table of bounded size says how often an n-gram occurs at most. Those that may occur `least` times are
    counted exactly: where `n` of them do and stay within the limits, no other can be among the first `n`. If
    there are fewer, `least` is lowered, in the end to all n-grams. Single words, which are few beside their
    occurrences, are not worth the scan for that table.
    """
    if ngram_sizes[1] == 1:
        return materialize(statistics(), "term-statistics")
    bounds = gram_counts.frequency_bounds(documents, ngram_sizes)
    enough = n + n // 4
    held = bounds[bounds > 0]
    # what other n-grams add to a place hides by how much the bound is above the frequency
    least = int(np.partition(held, -enough)[-enough] - np.median(held)) if len(held) > enough else 0
    while least > 1:
        stats = materialize(statistics(gram_counts.on_places(documents, bounds >= least)), "term-statistics")
        if stats.where(F.col("tf") >= least).count() >= n:
            return stats.where(F.col("tf") >= least)
        least //= 4
    return materialize(statistics(), "term-statistics")


def _most_frequent(stats: DataFrame, n: int) -> DataFrame:
    """The `n` rows with the largest `tf`, ties by term.

    A histogram of `tf` (few distinct values) finds the frequency of the last row that stays. Rows
    above it stay as they are; only the rows at exactly that frequency compete for the places left.
    """
    histogram = stats.groupBy("tf").agg(F.count("*").alias("_rows"))
    # distinct frequencies: at most the square root of twice the number of occurrences
    running = Window.partitionBy(F.lit(1)).orderBy(F.desc("tf"))
    reached = histogram.withColumn("_upto", F.sum("_rows").over(running)).where(F.col("_upto") >= n)
    last = reached.orderBy(F.desc("tf")).select("tf", (F.col("_upto") - F.col("_rows")).alias("above")).first()
    if last is None:
        return stats
    tied = stats.where(F.col("tf") == last["tf"]).orderBy("term").limit(n - last["above"])
    return stats.where(F.col("tf") > last["tf"]).unionByName(tied)


def fit_counts(documents: DataFrame, **options) -> DataFrame:
    """Vocabulary without weights, same selection rules."""
    return fit_terms(documents, **options).drop("idf")


def _known_terms(
    documents: DataFrame, terms: DataFrame, ngram_sizes: tuple[int, int], max_features: int | None, together: bool = False
) -> DataFrame:
    """`(doc_id, <columns of terms>, count)` for the n-grams that are in the vocabulary.

    `max_features` bounds the vocabulary; without it the size is counted. A small vocabulary filters
    the n-grams where the document lies, which are counted there; a large one is joined after counting, salted by document. With
    `together` the rows of a document meet before they are added up, so that what follows by document
    needs no exchange of its own.
    """
    columns, keys = [c for c in terms.columns if c != "term"], row_keys(documents)
    if max_features <= BROADCAST_ROW_LIMIT if max_features is not None else is_small(terms):
        if ngram_sizes[1] == 1:
            hits = _exploded(documents, ngram_sizes).join(F.broadcast(terms), "term").withColumn("count", F.lit(1))
        else:
            hits = gram_counts.counted_known(documents, terms, ngram_sizes, keys)
        # so many that a task's share stays small: left to the optimizer, few tasks would hold all small rows
        parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        gathered = hits.repartition(parts, *keys) if together else hits
        return gathered.groupBy(*keys, *columns).agg(F.sum("count").alias("count"))
    counts = term_counts(documents, ngram_sizes).withColumnRenamed("tf", "count")
    return lookup_join(
        counts, terms, ["term"], spread=F.col("doc_id"), how="inner", known_rows=BROADCAST_ROW_LIMIT + 1
    )


def count_vectors(
    documents: DataFrame,
    terms: DataFrame,
    ngram_sizes: tuple[int, int] = (1, 1),
    max_features: int | None = None,
) -> DataFrame:
    known = _known_terms(documents, terms.select("term", "idx"), ngram_sizes, max_features)
    return known.select(*row_keys(documents), "idx", F.col("count").cast("double").alias("value"))


def tfidf_vectors(
    documents: DataFrame,
    terms: DataFrame,
    ngram_sizes: tuple[int, int] = (1, 1),
    max_features: int | None = None,
) -> DataFrame:
    """(1 + ln tf) * idf, scaled to length 1 per document; terms outside the vocabulary drop out."""
    known = _known_terms(documents, terms.select("term", "idx", "idf"), ngram_sizes, max_features, together=True)
    keys = row_keys(documents)
    weighted = known.select(
        *keys, "idx", ((1.0 + F.log("count")) * F.col("idf")).alias("weight")
    )
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(*keys)))
    return weighted.select(*keys, "idx", (F.col("weight") / length).alias("value"))


def tfidf_rows(
    documents: DataFrame,
    terms: DataFrame,
    ngram_sizes: tuple[int, int] = (1, 1),
    max_features: int | None = None,
) -> DataFrame:
    """`tfidf_vectors` with one row per document, whose `idx` and `value` are arrays in the order of `idx`.

    Where no other row has the id (and draw), a document is weighted where it lies and nothing but ids is
    shuffled. Rows that share an id or have none go the way of `tfidf_vectors`, as all do with a large vocabulary.
    """
    if not (max_features <= BROADCAST_ROW_LIMIT if max_features is not None else is_small(terms)):
        return folded(tfidf_vectors(documents, terms, ngram_sizes, max_features))
    keys = row_keys(documents)
    once, repeated = only_once(documents, *keys)
    rows = gram_counts.weighted_known(once, terms, ngram_sizes, keys)
    return rows if repeated is None else rows.unionByName(folded(tfidf_vectors(repeated, terms, ngram_sizes, max_features)))


def drawn_tfidf_rows(
    documents: DataFrame,
    drawn: DataFrame,
    terms: DataFrame,
    ngram_sizes: tuple[int, int] = (1, 1),
    max_features: int | None = None,
) -> DataFrame:
    """`tfidf_rows(drawn)` for copies `drawn(doc_id, draw, words)` of `documents(doc_id, words)`.

    A document is weighted once and its row goes to its copies. Copies of rows that share an id are weighted one
    by one, since each then holds the words of all these rows.
    """
    once, repeated = only_once(documents, "doc_id")
    copies = drawn.select("doc_id", "draw").join(tfidf_rows(once.select("doc_id", "words"), terms, ngram_sizes, max_features), "doc_id")
    if repeated is None:
        return copies
    again = drawn.join(repeated.select("doc_id").distinct(), "doc_id", "left_semi")
    return copies.unionByName(tfidf_rows(again.select("doc_id", "draw", "words"), terms, ngram_sizes, max_features))


def folded(vectors: DataFrame) -> DataFrame:
    """One row per document with its entries as arrays; a document's are bounded by its length."""
    entries = F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("_e")
    return vectors.groupBy(*row_keys(vectors)).agg(entries).select(
        *row_keys(vectors), F.col("_e.idx").cast("array<bigint>").alias("idx"), F.col("_e.value").alias("value")
    )


def unfolded(rows: DataFrame) -> DataFrame:
    """Vectors in long form from rows with arrays."""
    return rows.select(*row_keys(rows), F.inline(F.arrays_zip("idx", "value")))


def linguistic_names(features: DataFrame, include_rating: bool = True) -> list[str]:
    return [
        c for c in fv.FEATURE_COLUMNS if c in features.columns and (include_rating or c != "rating")
    ]


def linguistic_vectors(features: DataFrame, include_rating: bool = True) -> DataFrame:
    """Every feature of every document, zeros included; booleans count as 0 and 1."""
    return unfolded(linguistic_rows(features, include_rating))


def linguistic_rows(features: DataFrame, include_rating: bool = True) -> DataFrame:
    """`linguistic_vectors` with one row per document, `idx` and `value` as arrays."""
    cells = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in linguistic_names(features, include_rating)]
    numbers = F.array(*[F.lit(i).cast("bigint") for i in range(len(cells))])
    return features.select(*row_keys(features), numbers.alias("idx"), F.array(*cells).alias("value"))


def combine(*parts: tuple[DataFrame, int | Column]) -> DataFrame:
    """Stack `(vectors, width)` side by side: each part's indexes start after the parts before."""
    offset: Column = F.lit(0).cast("bigint")
    stacked = None
    for vectors, width in parts:
        moved = vectors.select(*row_keys(vectors), (F.col("idx") + offset).alias("idx"), "value")
        stacked = moved if stacked is None else stacked.unionByName(moved)
        offset = offset + (width if isinstance(width, Column) else F.lit(width))
    return stacked


def combine_rows(*parts: tuple[DataFrame, int]) -> DataFrame:
    """`combine` for rows with arrays: a document has a row from each part."""
    offset, stacked = 0, None
    for rows, width in parts:
        idx = F.transform("idx", lambda i: i + F.lit(offset).cast("bigint")) if offset else F.col("idx")
        moved = rows.select(*row_keys(rows), idx.alias("idx"), "value")
        stacked = moved if stacked is None else stacked.unionByName(moved)
        offset += width
    return stacked


def width_of(terms: DataFrame) -> Column:
    """Vocabulary size as a scalar subquery."""
    return terms.agg(F.count("*")).scalar()


def feature_names(terms: DataFrame) -> DataFrame:
    return terms.select("idx", "term").orderBy("idx")


def top_terms(vectors: DataFrame, terms: DataFrame, top_n: int = 10, known_terms: int | None = None) -> DataFrame:
    """The `top_n` largest non-zero values of each document, ties by term."""
    named = lookup_join(
        vectors, terms.select("idx", "term"), ["idx"], spread=F.col("doc_id"), how="inner",
        known_rows=known_terms,
    )
    keys = row_keys(vectors)
    order = Window.partitionBy(*keys).orderBy(F.desc("value"), "term")
    return (
        named.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .select(*keys, "rank", "term", "value")
    )


def vocabulary_sample(terms: DataFrame, n_words: int, limit: int = 10) -> DataFrame:
    """The first terms, in index order, that consist of `n_words` words."""
    return (
        terms.where(F.size(F.split("term", " ")) == n_words).select("idx", "term").orderBy("idx").limit(limit)
    )


def minmax_limits(vectors: DataFrame, n_documents: Column) -> DataFrame:
    """Smallest and largest value per index; entries that are not stored count as zero."""
    return vectors.groupBy("idx").agg(
        F.min("value").alias("_min"), F.max("value").alias("_max"), F.count("*").alias("_n")
    ).select(
        "idx",
        F.when(F.col("_n") < n_documents, F.least("_min", F.lit(0.0))).otherwise(F.col("_min")).alias("low"),
        F.when(F.col("_n") < n_documents, F.greatest("_max", F.lit(0.0))).otherwise(F.col("_max")).alias("high"),
    )


def minmax_scale(vectors: DataFrame, limits: DataFrame, known_width: int | None = None) -> DataFrame:
    """(value - low) / (high - low), 0 for a constant column.

    Entries that are not stored stay away, which is exact while their column has no negative value;
    dense columns (`linguistic_vectors`) are stored in full.
    """
    joined = lookup_join(
        vectors, limits, ["idx"], spread=F.col("doc_id"), how="inner", known_rows=known_width
    )
    span = F.col("high") - F.col("low")
    scaled = F.when(span == 0, F.col("value") - F.col("low")).otherwise(
        (F.col("value") - F.col("low")) / span
    )
    return joined.select(*row_keys(vectors), "idx", scaled.alias("value"))
