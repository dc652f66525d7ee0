"""The counting filter against plain counting, and the vocabulary with and without it."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import counting_filter, vectors
from reviewlab.plans import fixtures as fx


def frame(spark, docs, parts):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id long, words array<string>").repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
@pytest.mark.parametrize("bits", [128, 1 << 24])
def test_nothing_of_two_documents_is_lost(spark, parts, bits):
    rng = random.Random(parts)
    docs = [rng.choices([f"w{i}" for i in range(400)], k=rng.randint(0, 30)) for _ in range(60)] + [None, []]
    grams = [["{} {}".format(*p) for p in zip(d, d[1:])] + d for d in docs if d is not None]
    in_docs = Counter(g for own in grams for g in set(own))
    kept = counting_filter.repeated_grams(frame(spark, docs, parts), (1, 2), bits).collect()
    found = Counter(g for r in kept for g in r["_grams"])
    all_grams = Counter(g for own in grams for g in own)
    assert all(found[g] == n for g, n in all_grams.items() if in_docs[g] > 1)
    assert found <= all_grams
    if bits > 128:
        assert all(in_docs[g] > 1 for g in found)


def test_same_vocabulary_with_fewer_shuffled_terms(spark):
    documents = vectors.document_words(fx.table(spark, "/root/testdata/sf0.01", "documents"))
    for min_df in (2, 0.003, 1):
        plain = vectors.fit_terms(documents, (1, 3), 3000, min_df, 0.95)
        ours = vectors.fit_terms(documents, (1, 3), 3000, min_df, 0.95, counting_filter=True)
        assert plain.exceptAll(ours).isEmpty() and plain.count() == ours.count() > 0
    everything = vectors.term_statistics(documents, (1, 3))
    repeated = vectors.term_statistics(documents, (1, 3), repeated_only=True)
    assert repeated.count() <= everything.count() / 2
    assert everything.where("df > 1").exceptAll(repeated).isEmpty()


def test_sizes_are_checked(spark):
    for bits in (64, 1000):
        with pytest.raises(ValueError):
            counting_filter.repeated_grams(frame(spark, [["a"]], 1), (1, 1), bits)


def test_empty_table(spark):
    empty = frame(spark, [["a"]], 1).where(F.lit(False))
    assert vectors.term_statistics(empty, (1, 2), repeated_only=True).count() == 0
