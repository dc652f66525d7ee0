"""Loading, labels, ids, sampling: edge rows, size arithmetic and invariances."""

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.operators import corpus, lookup, ranking, sampling, statistics
from reviewlab.session import materialize


def test_rating_bands(spark):
    ratings = [4.99, 4.995, 5.0, 6.99, 6.995, 7.0, 10.0, 10.01, None]
    expected = ["negative", None, "neutral", "neutral", None, "positive", "positive", None, None]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(ratings)], "i int, rating double")
    for labelled in (
        corpus.with_label(frame, fv.THREE_CLASS_BANDS),
        corpus.label_by_band_table(frame, corpus.band_table(spark, fv.THREE_CLASS_BANDS)),
    ):
        assert [r["label"] for r in labelled.orderBy("i").collect()] == expected


def test_first_band_wins(spark):
    bands = [("high", 5, 10), ("any", 0, 10)]
    frame = spark.createDataFrame([(7.0,), (3.0,)], "rating double")
    for labelled in (corpus.with_label(frame, bands), corpus.label_by_band_table(frame, corpus.band_table(spark, bands))):
        assert {r["rating"]: r["label"] for r in labelled.collect()} == {7.0: "high", 3.0: "any"}


def test_load_filter_and_ids(spark):
    rows = [
        (1, "   short   ", "8", "g", "u"), (2, "long enough text", "8.5", None, None),
        (3, "another long text", None, "g", "u"), (4, None, "7", "g", "u"),
        (5, "  padded text here \n", "3", "g", ""), (6, "not a number here", "x", "g", "u"),
    ]
    frame = spark.createDataFrame(rows, "row_id int, text string, rating string, game_id string, user string")
    documents = corpus.documents_from_reviews(frame, "row_id", bands=fv.THREE_CLASS_BANDS)
    found = {r["row_id"]: (r["doc_id"], r["raw_text"], r["label"]) for r in documents.collect()}
    assert found == {
        2: ("unknown_anonymous_0", "long enough text", "positive"),
        5: ("g_anonymous_1", "padded text here", "negative"),
    }
    one = corpus.documents_from_reviews(frame, "row_id", max_documents=1).collect()
    assert [r["row_id"] for r in one] == [2]


def test_timestamps(spark):
    frame = spark.createDataFrame([("2024-01-05T10:00:00",), ("soon",), (None,)], "timestamp string")
    parsed = [r["timestamp"] for r in corpus.with_parsed_timestamp(frame).collect()]
    assert parsed[0].day == 5 and parsed[1:] == [None, None]


@pytest.mark.parametrize("partitions", [1, 7])
def test_ordinals(spark, partitions):
    keys = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(partitions)
    found = ranking.ordinals(keys, ["k"]).orderBy("k").collect()
    assert [r["ordinal"] for r in found] == list(range(1000))
    assert [r["k"] for r in ranking.first_rows(keys, "k", 3).orderBy("k").collect()] == [r["k"] for r in found[:3]]
    assert ranking.first_rows(keys, "k", 5000).count() == 1000
    assert ranking.first_rows(keys, "k", 0).count() == 0


def labelled(spark, sizes, partitions=4):
    parts = [
        spark.range(n).select(F.concat(F.lit(label), F.col("id").cast("string")).alias("doc_id"), F.lit(label).alias("label"))
        for label, n in sizes.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.repartition(partitions)


def test_published_sizes(spark):
    """526,439 / 332,514 / 141,022 labelled documents give the published balanced and split sizes."""
    sizes = {"positive": 526_439, "neutral": 332_514, "negative": 141_022}
    balanced = sampling.balance_subsample(labelled(spark, sizes, 8))
    split = sampling.two_step_split(balanced)
    counts = {(r["label"], r["set"]): r["count"] for r in split.groupBy("label", "set").count().collect()}
    for label in sizes:
        assert counts[label, "test"] == 28_204
        assert counts[label, "validation"] == 22_563
        assert counts[label, "train"] == 90_255
    assert sum(counts.values()) == 423_066


@pytest.mark.parametrize("partitions", [1, 8])
def test_split_does_not_depend_on_partitions(spark, partitions):
    frame = labelled(spark, {"a": 101, "b": 40}, partitions)
    split = sampling.stratified_split(frame, 0.2, 0.1)
    digest = split.agg(F.sum(F.xxhash64("doc_id", "set").cast("decimal(38,0)"))).first()[0]
    again = sampling.stratified_split(frame.repartition(3), 0.2, 0.1)
    assert digest == again.agg(F.sum(F.xxhash64("doc_id", "set").cast("decimal(38,0)"))).first()[0]
    counts = {(r["label"], r["set"]): r["count"] for r in split.groupBy("label", "set").count().collect()}
    assert counts == {
        ("a", "test"): 20, ("a", "validation"): 10, ("a", "train"): 71,
        ("b", "test"): 8, ("b", "validation"): 4, ("b", "train"): 28,
    }
    assert split.select("doc_id").distinct().count() == 141


def test_extreme_shares(spark):
    frame = labelled(spark, {"a": 10, "b": 1})
    assert sampling.stratified_split(frame, 0.0, 0.0).where("set = 'train'").count() == 11
    assert sampling.stratified_split(frame, 1.0, 0.0).where("set = 'test'").count() == 11
    with pytest.raises(ValueError):
        sampling.stratified_split(frame, 1.5)


def test_folds(spark):
    folds = sampling.stratified_folds(labelled(spark, {"a": 23, "b": 5}), 5)
    sizes = {(r["label"], r["fold"]): r["count"] for r in folds.groupBy("label", "fold").count().collect()}
    assert [sizes["a", f] for f in range(5)] == [5, 5, 5, 4, 4]
    assert [sizes["b", f] for f in range(5)] == [1] * 5


def test_null_labels_and_unlabelled_input(spark):
    frame = labelled(spark, {"a": 5}).unionByName(
        spark.createDataFrame([("x", None)], "doc_id string, label string")
    )
    assert sampling.balance_subsample(frame).count() == 5
    nothing = frame.where("label IS NULL")
    assert sampling.stratified_split(nothing).count() == 0
    with pytest.raises(ValueError, match="No labelled documents"):
        sampling.balance(nothing)
    with pytest.raises(ValueError, match="Unknown balancing strategy"):
        sampling.balance(frame, "mix")


def test_oversample(spark):
    frame = labelled(spark, {"a": 50, "b": 7})
    drawn = sampling.balance(frame, "oversample")
    counts = {r["label"]: r["count"] for r in drawn.groupBy("label").count().collect()}
    assert counts == {"a": 50, "b": 50}
    assert drawn.where("label = 'a'").select("doc_id").distinct().count() == 50
    assert drawn.select("label", "draw").distinct().count() == 100


def test_draws_cross_chunks(spark):
    """More draws than one chunk holds."""
    sizes = spark.createDataFrame([("a", 70_000), ("b", 3)], "label string, _size long")
    drawn = sampling.draws(sizes, "label", 1)
    got = drawn.groupBy("label").agg(F.count("*"), F.countDistinct("draw"), F.max("_rank")).collect()
    assert sorted(map(tuple, got)) == [("a", 70_000, 70_000, 69_999), ("b", 70_000, 70_000, 2)]


def test_hot_key_shares_a_segment(spark):
    """A third of all rows are copies of one id: they stay together."""
    frame = labelled(spark, {"a": 60}).unionByName(
        spark.range(30).select(F.lit("hot").alias("doc_id"), F.lit("a").alias("label"))
    )
    split = sampling.stratified_split(frame, 0.5)
    assert split.count() == 90
    assert split.where("doc_id = 'hot'").select("set").distinct().count() == 1


def test_split_plan_has_no_shuffle(spark):
    frame = labelled(spark, {"a": 100, "b": 50}).select("doc_id", "label")
    source = spark.createDataFrame(frame.toPandas())
    plan = sampling.stratified_split(source)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("limit", [1000, 0])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_small_and_salted(spark, limit, how):
    rows = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"))
    table = spark.createDataFrame([("hot", 1), ("k1", 2), ("other", 3)], "k string, v int")
    found = lookup.lookup_join(rows, table, ["k"], spread=F.col("id"), how=how, limit=limit)
    assert found.exceptAll(rows.join(table, ["k"], how)).isEmpty()
    assert found.count() == rows.join(table, ["k"], how).count()


def test_statistics_agree(spark, sf):
    from reviewlab.plans import fixtures as fx

    documents = fx.corpus(spark, sf)
    table = {(r["metric"], r["key"]): r["value"] for r in statistics.corpus_statistics(documents).collect()}
    single = statistics.text_length_stats(documents).first()
    assert table["text_length", "median"] == single["median"]
    assert table["text_length", "std"] == pytest.approx(single["std"])
    shares = [r["percentage"] for r in statistics.label_distribution(documents).collect()]
    assert sum(shares) == pytest.approx(100.0)


def test_empty_statistics(spark):
    empty = spark.createDataFrame([], "label string, rating double, game_id string, text string")
    rows = {(r["metric"], r["key"]): r["value"] for r in statistics.corpus_statistics(empty).collect()}
    assert rows["reviews_per_game", "unique_games"] == 0




def test_ids_of_raw_rows(spark):
    """No user or game column, shared keys, missing keys: every row keeps one id of its own."""
    rows = [(1, "a"), (1, "b"), (None, "c"), (2, "d"), (None, "e")]
    bare = spark.createDataFrame(rows, "k int, text string")
    found = {r["text"]: r["doc_id"] for r in corpus.with_doc_ids(bare, "k").collect()}
    assert set(found) == set("abcde") and set(found.values()) == {f"unknown_anonymous_{i}" for i in range(5)}
    assert {found["c"], found["e"]} == {"unknown_anonymous_0", "unknown_anonymous_1"} and found["d"].endswith("_4")
    assert corpus.with_doc_ids(bare, "k", 2).count() == 2
    named = bare.withColumn("game_id", F.lit("g")).withColumn("username", F.lit("n"))
    assert {r["doc_id"][:4] for r in corpus.with_doc_ids(named, "k").collect()} == {"g_n_"}


def test_row_keys(spark):
    rows = [("x", 1), ("x", 1), ("x", None), (None, 1), ("y", 1)]
    frame = spark.createDataFrame(rows, "text string, n int")
    keys = [r["row_key"] for r in corpus.with_row_key(frame).collect()]
    again = [r["row_key"] for r in corpus.with_row_key(frame.repartition(3)).collect()]
    assert len(set(keys)) == 5 and sorted(keys) == sorted(again)


def test_open_ended_bands(spark):
    bands = [("low", -1e12, 3.0), ("mid", 3.0, 3.0000001), ("wide", 2.5, 1e12), ("high", 7, 10)]
    values = [-5e11, 2.4, 2.5, 3.0, 3.00000005, 8.0, 9e11, None, 2e12]
    frame = spark.createDataFrame([(v,) for v in values], "rating double")
    by_table = corpus.label_by_band_table(frame, corpus.band_table(spark, bands)).collect()
    assert {r["rating"]: r["label"] for r in by_table} == {
        r["rating"]: r["label"] for r in corpus.with_label(frame, bands).collect()
    }


def test_limits_as_table_equal_listed_limits(spark, monkeypatch):
    frame = labelled(spark, {"a": 101, "b": 40, "c": 1})
    ways = {"split": sampling.two_step_split, "folds": lambda f: sampling.stratified_folds(f, 3), "cut": sampling.balance_subsample}
    listed = {name: way(frame) for name, way in ways.items()}
    monkeypatch.setattr(ranking, "LISTED_GROUPS", 1)
    for name, way in ways.items():
        assert way(frame).exceptAll(listed[name]).isEmpty() and listed[name].exceptAll(way(frame)).isEmpty()


def test_more_than_a_thousand_groups(spark):
    frame = spark.range(8000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("g"), F.col("id") % 1600).alias("label")
    )
    counts = sampling.stratified_split(frame, 0.2, 0.2).groupBy("label").pivot("set").count()
    assert counts.where("test = 1 AND validation = 1 AND train = 3").count() == 1600


def test_wide_tables_are_not_broadcast(spark):
    wide = spark.range(100).select("id", F.expr("repeat('x', 1000)").alias("text"))
    assert lookup.is_small(wide) and not lookup.is_small(wide, byte_limit=50_000)
    assert not lookup.is_small(wide, limit=99)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_tables_above_the_limit_are_never_broadcast(spark, how):
    """The table lies in a small file, but is repeated for every salt."""
    rows = spark.range(2000).select(F.concat(F.lit("w"), F.col("id") % 50).alias("word"), "id")
    table = materialize(spark.range(40).select(F.concat(F.lit("w"), "id").alias("word"), F.col("id").alias("n")))
    found = lookup.lookup_join(rows, table, ["word"], F.col("id"), how, known_rows=lookup.BROADCAST_ROW_LIMIT + 1)
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    assert found.count() == {"inner": 1600, "left": 2000, "left_semi": 1600, "left_anti": 400}[how]


@pytest.mark.parametrize("n", [999, 1000, 1001, 1500, 2500, 2999, 3000, 4000])
@pytest.mark.parametrize("nulls", [0, 100, 1500])
def test_first_rows_keeps_nulls_and_exactly_n(spark, n, nulls):
    """Null keys first, equal keys at the cut, repeated rows: always the smallest keys and exactly n rows."""
    keys = [None] * nulls + [i // 7 for i in range(3000 - nulls)]
    rows = spark.createDataFrame([(k, i % 3) for i, k in enumerate(keys)], "k long, v int").repartition(4)
    found = sorted(-1 if r.k is None else r.k for r in ranking.first_rows(rows, "k", n).collect())
    assert found == sorted(-1 if k is None else k for k in keys)[:n]


def test_numbering_leaves_rows_without_copies_in_place(spark):
    """Every tenth row is a copy: texts meet no exchange, and the numbers of each key have no gaps."""
    rows = spark.range(2000).selectExpr("CASE WHEN id < 20 THEN NULL WHEN id < 200 THEN 7 ELSE id END AS k", "'some text' AS text").repartition(5)
    found = ranking.numbered_within(rows, "k", "n")
    assert found.columns == ["k", "text", "n"] and dict(found.dtypes)["n"] == "bigint"
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    numbers = {}
    for r in found.collect():
        numbers.setdefault(r.k, []).append(r.n)
    assert len(numbers) == 1802 and all(sorted(n) == list(range(len(n))) for n in numbers.values())
    assert len(numbers[None]) == 20 and len(numbers[7]) == 180


def test_equal_rows_and_keys_are_numbered_without_gaps(spark):
    """Two thirds of 200,000 rows are equal or have no key: ids stay unique and follow the order of the keys."""
    n = 200_000
    rows = spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN NULL ELSE id % 1000 END AS k", "'g' AS game_id", "CAST(NULL AS STRING) AS user", "'same' AS text", "1.0D AS rating"
    ).repartition(6)
    keyed = corpus.with_row_key(rows)
    assert keyed.select("row_key").distinct().count() == n and keyed.columns == [*rows.columns, "row_key"]
    found = corpus.with_doc_ids(rows, "k").selectExpr("k", "CAST(split(doc_id, '_')[2] AS LONG) AS at")
    facts = found.selectExpr("count(DISTINCT at) AS n", "min(at) AS low", "max(at) AS high").first()
    assert tuple(facts) == (n, 0, n - 1)
    spans = found.groupBy("k").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.count("*").alias("n")).collect()
    assert all(r.high - r.low + 1 == r.n for r in spans)
    ordered = sorted(spans, key=lambda r: r.low)
    assert ordered[0].k is None and [r.k for r in ordered[1:]] == sorted(r.k for r in ordered[1:])
    assert corpus.with_doc_ids(rows, "k", 70_000).count() == 70_000
    assert corpus.with_doc_ids(rows.limit(0), "k").count() == 0
