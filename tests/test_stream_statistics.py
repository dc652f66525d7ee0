"""Statistics kept per batch against one pass over everything."""

import math
import random
import statistics as plain

from pyspark.sql import functions as F

from reviewlab.streaming import statistics as kept

SCHEMA = "label string, rating double, game_id string, text string"


def rows(n, seed=1):
    rng = random.Random(seed)
    return [
        (rng.choice(["positive", "negative", None]), rng.choice([None, 1.0, 5.5, 9.0]), rng.choice([None, *(f"g{i}" for i in range(900))]),
         None if rng.random() < 0.02 else "x" * (10**6 * (i % 997 == 0) + rng.randint(0, 3000)))
        for i in range(n)
    ]


def check(found, data):
    for level, label in [("all", "all"), *(("label", x) for x in ("positive", "negative", None))]:
        own = [r for r in data if level == "all" or r[0] == label]
        row = next(r for r in found if (r.level, r.label) == (level, label))
        lengths, rated = sorted(len(r[3]) for r in own if r[3] is not None), [r[1] for r in own if r[1] is not None]
        assert (row.n, row.min_length, row.max_length) == (len(own), lengths[0], lengths[-1])
        assert math.isclose(row.avg_rating, plain.fmean(rated)) and math.isclose(row.mean_length, plain.fmean(lengths))
        assert math.isclose(row.std_length, plain.pstdev(lengths), rel_tol=1e-9)
        low, high = sum(x < row.median_length for x in lengths), sum(x <= row.median_length for x in lengths)
        assert low / len(lengths) - 0.02 <= 0.5 <= high / len(lengths) + 0.02
        games = len({r[2] for r in own if r[2] is not None})
        assert abs(row.unique_games - games) <= 0.06 * games


def test_batches_in_any_order_merge_to_the_whole(spark):
    data = rows(6000)
    parts = [data[:1], data[1:50], data[50:3000], data[3000:], []]
    states = [kept.batch_state(spark.createDataFrame(p, SCHEMA)) for p in parts]
    exact = ["level", "label", "n", "min_length", "max_length", "unique_games"]
    seen = []
    for order in ([0, 1, 2, 3, 4], [3, 4, 1, 0, 2]):
        union = states[order[0]]
        for i in order[1:]:
            union = union.unionByName(states[i])
        found = kept.merged(union).collect()
        check(found, data)
        seen.append(sorted([tuple(r[c] for c in exact) for r in found], key=repr))
    assert seen[0] == seen[1]
    assert kept.merged(states[4]).count() == 0


def test_a_stream_continues_and_never_counts_twice(spark, tmp_path):
    source, state, mark = (str(tmp_path / n) for n in ("in", "state", "mark"))
    data = rows(900, seed=2)
    for i in range(3):
        spark.createDataFrame(data[300 * i:300 * i + 300], SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        kept.write_statistics(stream, state, mark)
        kept.write_statistics(stream, state, mark)
        check(kept.merged(kept.read_state(spark, state)).collect(), data[:300 * i + 300])


def test_states_without_values(spark):
    empty = spark.createDataFrame([("a", None, None, None)], SCHEMA)
    row = kept.merged(kept.batch_state(empty)).where(F.col("level") == "label").first()
    assert (row.n, row.avg_rating, row.mean_length, row.median_length, row.unique_games) == (1, None, None, None, 0)
