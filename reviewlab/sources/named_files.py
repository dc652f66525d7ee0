"""Writing files under names of their own, which Spark's writers do not allow, from the tasks that hold their content."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_named_files(files: DataFrame, folder: str) -> int:
    """Write `files(name, content)` below `folder` and return their number; names may hold folders.

    `folder` lies on a file system that all executors share. A task writes each file under a name of its own
    and then renames it, so a task that is run again leaves whole files. Of rows with equal names one stays.
    """
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        own = f"_attempt-{TaskContext.get().taskAttemptId()}"
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                target = f"{base}/{name}"
                parent, last = posixpath.split(target)
                store.create_dir(parent, recursive=True)
                with store.open_output_stream(f"{parent}/{own}-{last}") as out:
                    out.write(content.as_buffer())
                store.move(f"{parent}/{own}-{last}", target)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    spelled = files.select("name", F.encode("content", "UTF-8").alias("content"))
    return spelled.mapInArrow(of_batches, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
