"""Raw layouts, saved tables and the file stream, on small files written for the test."""

import json

import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from reviewlab import session
from reviewlab.operators import models, vectors
from reviewlab.plans import experiment
from reviewlab.sources import reviews
from reviewlab.sources.workspace import Workspace, markdown_report
from reviewlab.streaming import reviews as stream


def rows_of(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


def test_csv(spark, tmp_path):
    (tmp_path / "reviews.csv").write_text(
        'ID,Comment,Rating,User_ID,extra\n13,"Two\nlines, ""quoted""",8.5,007,x\n14,plain,bad,,y\n', encoding="utf-8"
    )
    assert reviews.detect_format(spark, str(tmp_path)) == "csv"
    table = reviews.read_reviews(spark, str(tmp_path))
    assert table.columns == ["game_id", "text", "rating", "user", "extra"]
    assert rows_of(table, "game_id", "text", "rating", "user") == [
        ("13", 'Two\nlines, "quoted"', 8.5, "007"), ("14", "plain", None, None),
    ]
    assert reviews.read_reviews(spark, str(tmp_path), game_ids=["14"]).count() == 1
    converted = reviews.convert_to_parquet(table, str(tmp_path / "copy"))
    assert converted.count() == 2


def test_first_alias_wins(spark):
    frame = spark.createDataFrame([("a", "b", 1.0, 2.0)], "Review string, TEXT string, score double, value double")
    assert reviews.standardize_columns(frame).columns == ["Review", "text", "score", "rating"]


def test_flat_json(spark, tmp_path):
    record = {"text": "t", "rating": 7, "user": "u", "timestamp": "2024-01-01T00:00:00"}
    (tmp_path / "g1.json").write_text(json.dumps([record, {**record, "text": "t2"}]))
    (tmp_path / "g2.json").write_text(json.dumps({"reviews": [{**record, "game_id": "other"}]}))
    (tmp_path / "my game.json").write_text(json.dumps(record))
    (tmp_path / "g1_metadata.json").write_text(json.dumps({"name": "One", "categories": ["c"], "mechanics": []}))
    assert reviews.detect_format(spark, str(tmp_path)) == "json"
    table = reviews.read_reviews(spark, str(tmp_path))
    assert rows_of(table, "game_id", "text") == [("g1", "t"), ("g1", "t2"), ("g2", "t"), ("my game", "t")]
    assert rows_of(reviews.all_game_ids(table), "game_id") == [("g1",), ("g2",), ("my game",)]
    assert reviews.count_reviews(table, ["g1"]).first()["n_reviews"] == 2
    joined = reviews.with_game_metadata(table, reviews.read_game_metadata(spark, str(tmp_path)))
    found = {r["game_id"]: (r["name"], r["categories"], r["mechanics"]) for r in joined.collect()}
    assert found["g1"] == ("One", ["c"], []) and found["g2"] == (None, [], [])


def test_nested_json(spark, tmp_path):
    for game, content in {"g1": [{"text": "a"}, {"text": "b"}], "g2": {"reviews": [{"text": "c"}]}, "g3": {"text": "lone"}}.items():
        (tmp_path / game).mkdir()
        (tmp_path / game / "reviews.json").write_text(json.dumps(content))
        (tmp_path / game / "metadata.json").write_text(json.dumps({"name": game.upper()}))
    (tmp_path / "empty").mkdir()
    assert reviews.detect_format(spark, str(tmp_path)) == "nested_json"
    table = reviews.read_reviews(spark, str(tmp_path))
    # a single object is no review list in this layout
    assert rows_of(table, "game_id", "text") == [("g1", "a"), ("g1", "b"), ("g2", "c")]
    metadata = reviews.read_game_metadata(spark, str(tmp_path))
    assert rows_of(metadata, "game_id", "name") == [("g1", "G1"), ("g2", "G2"), ("g3", "G3")]


def test_no_data(spark, tmp_path):
    with pytest.raises(ValueError, match="No valid data"):
        reviews.detect_format(spark, str(tmp_path))
    with pytest.raises(ValueError, match="Unknown format"):
        reviews.read_reviews(spark, str(tmp_path), "xml")
    assert reviews.read_game_metadata(spark, str(tmp_path)).count() == 0


def test_small_input_is_spread(spark, sf):
    scan = spark.read.parquet(f"{sf}/documents.parquet")
    assert reviews.spread_small_input(scan, "doc_id").rdd.getNumPartitions() == 8
    wide = scan.repartition(20)
    assert reviews.spread_small_input(wide, "doc_id") is wide


def test_workspace(spark, tmp_path):
    saved = Workspace(spark, str(tmp_path))
    documents = spark.createDataFrame(
        [("d1", "One\n\"text\"", 8.0, "positive", "train"), ("d2", "two", 2.0, None, "test")],
        "doc_id string, raw_text string, rating double, label string, set string",
    )
    saved.save_documents(documents)
    assert rows_of(saved.load_documents(split="train"), "doc_id", "text_length") == [("d1", 10)]
    # the folder of a set is the only one read
    plan = saved.load_documents(split="train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(set" in plan
    saved.export_csv(documents, "csv")
    back = saved.load_csv("csv", "doc_id string, raw_text string, rating double, label string, set string")
    assert rows_of(back, "doc_id", "raw_text") == [("d1", 'One\n"text"'), ("d2", "two")]
    saved.save_splits(documents)
    assert saved.load_splits().columns == ["doc_id", "set", "label"]
    words = vectors.document_words(documents, "raw_text")
    terms = vectors.fit_terms(words)
    saved.save_terms(terms, "terms", {"ngram_sizes": [1, 1]})
    loaded, settings = saved.load_terms("terms")
    assert settings == {"ngram_sizes": [1, 1]} and loaded.exceptAll(terms).isEmpty()
    for save, load in [
        (saved.save_features, saved.load_features),
        (lambda t: saved.save_vectors(t, "v"), lambda: saved.load_vectors("v")),
        (lambda t: saved.save_sentences(t), lambda: saved.load_table("sentences")),
        (lambda t: saved.save_pos_tags(t), lambda: saved.load_table("pos_tags")),
        (lambda t: saved.save_dependencies(t), lambda: saved.load_table("dependencies")),
    ]:
        save(documents)
        assert load().exceptAll(documents).isEmpty()
    saved.save_results(spark.createDataFrame([("m", 0.123456)], "model string, f1_score double"))
    assert saved.load_results().first()["f1_score"] == 0.1235


def test_model_is_saved(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") % 2).cast("double").alias("y"))
    cells = rows.select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("idx"), F.lit(1.0).alias("value"))
    data = models.sparse_features(cells, rows.withColumnRenamed("id", "doc_id"), 2)
    saved = Workspace(spark, str(tmp_path))
    saved.save_model(models.forest(n_estimators=2, max_depth=2).setLabelCol("y").fit(data))
    loaded = saved.load_model()
    assert isinstance(loaded.stages[0], RandomForestClassificationModel)
    assert loaded.transform(data).where("prediction <> y").isEmpty()


def test_report_text(spark, tmp_path):
    labelled = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(20)], "doc_id int, label string")
    split = labelled.withColumn("set", F.when(F.col("doc_id") < 4, "test").otherwise("train"))
    rows = experiment.report_tables(labelled, labelled, split)
    text = markdown_report(rows)
    assert "## split_count" in text and "| test/all | 4.0000 |" in text
    assert Workspace(spark, str(tmp_path)).save_report(rows) == text


def test_stream_takes_new_files_only(spark, tmp_path):
    source, out, progress = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = "comment string, score double, game_id string"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        arriving = stream.stream_reviews(spark, source, schema)
        stream.write_available(stream.label_stream(arriving), out, progress)
        return rows_of(spark.read.parquet(out), "text", "label")

    arrive((" a long enough text ", 8.0, "g"), ("short", 8.0, "g"))
    assert run() == [("a long enough text", "positive")]
    arrive(("another long text", 5.5, "g"))
    assert run() == [("a long enough text", "positive"), ("another long text", "neutral")]


def test_checkpoint_root(spark):
    root = session.checkpoint_root(spark)
    assert session.scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
    kept = session.materialize(spark.range(5))
    assert kept.count() == 5 and "FileScan parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_metadata_of_some_games_only(spark, tmp_path):
    """The first folder has none; one game has both files; one has only the flat one."""
    import json

    for game in ("a1", "b2", "c3", "d4"):
        (tmp_path / game).mkdir()
        (tmp_path / game / "reviews.json").write_text("[]")
    for game in ("b2", "c3"):
        (tmp_path / game / "metadata.json").write_text(json.dumps({"name": f"nested {game}", "categories": ["x"]}))
    (tmp_path / "c3_metadata.json").write_text(json.dumps({"name": "flat c3"}))
    found = {r["game_id"]: r["name"] for r in reviews.read_game_metadata(spark, str(tmp_path)).collect()}
    assert found == {"b2": "nested b2", "c3": "flat c3"}
    assert reviews.list_game_ids(spark, str(tmp_path)) == []


def test_game_ids_from_names(spark, tmp_path):
    for game in ("a1", "b2"):
        (tmp_path / game).mkdir()
    assert reviews.list_game_ids(spark, str(tmp_path)) == ["a1", "b2"]
    (tmp_path / "x.json").write_text("[]")
    (tmp_path / "x_metadata.json").write_text("{}")
    assert reviews.list_game_ids(spark, str(tmp_path)) == ["x"]


def test_one_whole_metadata_record_per_game(spark):
    records = [("g", "B", ["x"], None), ("g", "A", ["y"], ["m"])]
    metadata = spark.createDataFrame(records, "game_id string, name string, categories array<string>, mechanics array<string>")
    joined = reviews.with_game_metadata(spark.createDataFrame([("g",), ("h",)], "game_id string"), metadata)
    found = {r["game_id"]: (r["name"], r["categories"], r["mechanics"]) for r in joined.collect()}
    assert found == {"g": ("A", ["y"], ["m"]), "h": (None, [], [])}


def test_a_local_warehouse_is_refused_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Fake:
        def __init__(self, master, **conf):
            self.conf, self.sparkContext = Conf(conf), Context(master)

    local, shared = {"spark.sql.warehouse.dir": "file:/tmp/w"}, {"spark.sql.warehouse.dir": "hdfs://n/w/"}
    assert session.checkpoint_root(Fake("local[2]", **local)) == "file:/tmp/w/_scratch"
    assert session.checkpoint_root(Fake("yarn", **shared)) == "hdfs://n/w/_scratch"
    assert session.checkpoint_root(Fake("yarn", **local, **{"spark.checkpoint.dir": "hdfs://n/c"})) == "hdfs://n/c"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Fake("yarn", **local))


def test_named_files(spark, tmp_path):
    rows = spark.createDataFrame([("a.json", "x"), ("b/c.txt", "é\n"), ("b/d.txt", "")], "name string, content string")
    from reviewlab.sources.named_files import write_named_files

    assert write_named_files(rows.repartition(3), str(tmp_path)) == 3
    found = {str(p.relative_to(tmp_path)): p.read_text(encoding="utf-8") for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith(".")}
    assert found == {"a.json": "x", "b/c.txt": "é\n", "b/d.txt": ""}
    assert write_named_files(rows.limit(0), str(tmp_path)) == 0


@pytest.mark.parametrize("parts", [0, 3])
def test_stream_queries_read_a_file_and_a_folder_of_parts(spark, tmp_path, parts):
    from reviewlab.plans.queries import QUERIES

    rows = [(i, f"text number {i} of some length", "en", "src1", 20) for i in range(1, 31)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if parts:
        documents.repartition(parts).write.parquet(f"{tmp_path}/documents.parquet")
    else:
        documents.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    other = spark.createDataFrame([(1, "not a document")], "page_id long, text string")
    other.write.parquet(f"{tmp_path}/pages.parquet")
    labelled = {r.row_id for r in QUERIES["stream_label_reviews"](spark, str(tmp_path)).collect()}
    assert labelled == {i for i in range(1, 31) if i != 3}
    whole = {r.level: r.n for r in QUERIES["stream_statistics"](spark, str(tmp_path)).where("level = 'all'").collect()}
    assert whole == {"all": 29}
