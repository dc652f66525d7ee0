"""Reading raw reviews and game metadata from CSV, JSON or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.functions import fixed_values as fv
from reviewlab.operators.lookup import lookup_join
from reviewlab.sources.quoted_csv import read_quoted_csv

REVIEW_FIELDS = T.StructType(
    [
        T.StructField("text", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("user", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)
METADATA_FIELDS = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
        T.StructField("mechanics", T.ArrayType(T.StringType())),
    ]
)
_CSV_FILE = "reviews.csv"
_METADATA_SUFFIX = "_metadata.json"


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names directly below `path` and whether each is a folder, through the Hadoop file system."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(root)]


def detect_format(spark: SparkSession, path: str) -> str:
    """`csv` when there is a reviews.csv, else `json` files, else `nested_json` folders."""
    children = _children(spark, path)
    if any(name == _CSV_FILE for name, _ in children):
        return "csv"
    if any(name.endswith(".json") for name, folder in children if not folder):
        return "json"
    if any(folder for _, folder in children):
        return "nested_json"
    raise ValueError(f"No valid data found in {path}")


def read_reviews(
    spark: SparkSession,
    path: str,
    format: str | None = None,
    game_ids: list[str] | None = None,
    fields: T.StructType = REVIEW_FIELDS,
) -> DataFrame:
    """Reviews of any layout with the standard column names."""
    format = format or detect_format(spark, path)
    if format == "csv":
        reviews = read_csv(spark, f"{path.rstrip('/')}/{_CSV_FILE}")
    elif format == "json":
        reviews = read_json(spark, path, fields)
    elif format == "nested_json":
        reviews = read_nested_json(spark, path, fields)
    elif format == "parquet":
        reviews = standardize_columns(spark.read.parquet(path))
    else:
        raise ValueError(f"Unknown format: {format}")
    if game_ids and "game_id" in reviews.columns:
        reviews = reviews.where(F.col("game_id").isin(list(game_ids)))
    return reviews


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with line breaks inside fields; many tasks share one large file (`quoted_csv`)."""
    raw = read_quoted_csv(spark, path)
    reviews = standardize_columns(raw)
    if "rating" in reviews.columns:
        reviews = reviews.withColumn("rating", F.expr("try_cast(rating AS double)"))
    return reviews


def convert_to_parquet(reviews: DataFrame, path: str) -> DataFrame:
    reviews.write.mode("errorifexists").parquet(path)
    return reviews.sparkSession.read.parquet(path)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename the first known alias of each standard column, whatever its case."""
    lowered = {c.lower(): c for c in df.columns}
    renames: dict[str, str] = {}
    for standard, aliases in fv.COLUMN_ALIASES.items():
        found = next((lowered[a] for a in aliases if a in lowered), None)
        if found is not None:
            renames[found] = standard
    return df.select(*[F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns])


def read_json(
    spark: SparkSession, path: str, fields: T.StructType = REVIEW_FIELDS
) -> DataFrame:
    """`<game_id>.json` files with a list, `{"reviews": [...]}` or one object.

    The file name is the game id; metadata files are left out.
    """
    schema = T.StructType([*fields.fields, T.StructField("reviews", T.ArrayType(fields))])
    raw = spark.read.option("multiLine", True).schema(schema).json(f"{path.rstrip('/')}/*.json")
    rows = raw.select(
        F.inline(F.coalesce("reviews", F.array(F.struct(*fields.names)))),
        F.col("_metadata.file_path").alias("_path"),
    )
    return _with_game(rows.where(~F.col("_path").endswith(_METADATA_SUFFIX)), r"([^/]*)\.json$")


def read_nested_json(
    spark: SparkSession, path: str, fields: T.StructType = REVIEW_FIELDS, file_glob: str = "reviews.json"
) -> DataFrame:
    """`<game_id>/reviews.json` files with a list or `{"reviews": [...]}`; a lone object is no list.

    The JSON reader turns a lone object and a list of one into the same row, so files are read as
    text and parsed by their first character. The folder name is the game id; folders written by a
    partitioned Spark job (`game_id=<id>`) are understood too.
    """
    whole = spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/*/{file_glob}")
    content = F.col("value")
    records = T.ArrayType(fields)
    listed = F.from_json(content, records)
    wrapped = F.from_json(content, T.StructType([T.StructField("reviews", records)]))["reviews"]
    is_list = F.startswith(F.ltrim(content), F.lit("["))
    rows = whole.select(
        F.inline(F.when(is_list, listed).otherwise(wrapped)), F.col("_metadata.file_path").alias("_path")
    )
    return _with_game(rows, r"(?:/game_id=|/)([^/=]*)/[^/]*$")


def _with_game(rows: DataFrame, pattern: str) -> DataFrame:
    game = F.url_decode(F.regexp_extract("_path", pattern, 1))
    return rows.withColumn("game_id", game).drop("_path")


def _exists(spark: SparkSession, pattern: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_game_metadata(spark: SparkSession, path: str) -> DataFrame:
    """`(game_id, name, categories, mechanics)` from `<id>_metadata.json` and `<id>/metadata.json`.

    A game with both files has the first one. Any game may lack either.
    """
    root = path.rstrip("/")
    layouts = [
        (f"{root}/*{_METADATA_SUFFIX}", r"([^/]*)_metadata\.json$"),
        (f"{root}/*/metadata.json", r"([^/]*)/metadata\.json$"),
    ]
    tables = [
        _with_game(
            spark.read.option("multiLine", True).schema(METADATA_FIELDS).json(files)
            .withColumn("_path", F.col("_metadata.file_path")),
            pattern,
        )
        for files, pattern in layouts if _exists(spark, files)
    ]
    if not tables:
        empty = T.StructType([*METADATA_FIELDS.fields, T.StructField("game_id", T.StringType())])
        return spark.createDataFrame([], empty)
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table.join(out.select("game_id").distinct(), "game_id", "left_anti"))
    return out


def with_game_metadata(reviews: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join with defaults: no name and empty lists where a game has no metadata."""
    # one whole record per game, the same one on every run
    record = F.min(F.struct("name", "categories", "mechanics")).alias("r")
    one_each = metadata.groupBy("game_id").agg(record).select("game_id", "r.*")
    joined = lookup_join(reviews, one_each, ["game_id"], spread=F.xxhash64(*reviews.columns))
    empty = F.array().cast("array<string>")
    return joined.withColumn("categories", F.coalesce("categories", empty)).withColumn(
        "mechanics", F.coalesce("mechanics", empty)
    )


def list_game_ids(spark: SparkSession, path: str) -> list[str]:
    """Game ids of a JSON layout from file and folder names alone, games without reviews included."""
    children = _children(spark, path)
    files = [name for name, folder in children if not folder and name.endswith(".json")]
    if files:
        return sorted(name.removesuffix(".json") for name in files if not name.endswith(_METADATA_SUFFIX))
    return sorted(name.removeprefix("game_id=") for name, folder in children if folder)


def all_game_ids(reviews: DataFrame) -> DataFrame:
    return reviews.select("game_id").distinct()


def count_reviews(reviews: DataFrame, game_ids: list[str] | None = None) -> DataFrame:
    kept = reviews.where(F.col("game_id").isin(list(game_ids))) if game_ids else reviews
    return kept.agg(F.count("*").alias("n_reviews"))


def spread_small_input(df: DataFrame, key: str) -> DataFrame:
    """Use all cores for an input with fewer splits than cores; leave every larger one alone.

    Pass a plain scan: only its list of splits is looked at, no job is run.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
