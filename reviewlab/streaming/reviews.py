"""Reviews as a file stream: the stateless part of the work, run on new files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reviewlab.functions import fixed_values as fv
from reviewlab.operators.corpus import Bands, load_filter, with_label
from reviewlab.sources.reviews import standardize_columns


def stream_reviews(
    spark: SparkSession, path: str, schema: T.StructType | str, format: str = "parquet",
    glob: str | None = None, files_per_batch: int = 1000,
) -> DataFrame:
    """An unbounded frame over the files that arrive in `path`."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return standardize_columns(reader.format(format).load(path))


def label_stream(
    reviews: DataFrame, bands: Bands = fv.THREE_CLASS_BANDS,
    min_text_length: int = fv.MIN_TEXT_LENGTH,
) -> DataFrame:
    """Filter and label: row by row, so there is no state and no watermark."""
    return with_label(load_filter(reviews, min_text_length), bands)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything that has arrived, then stop; a later call continues from there."""
    query = (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
