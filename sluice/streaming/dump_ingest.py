"""Incremental SQL-dump ingest with Structured Streaming.

The dump converter this replaces reads dump lines as they arrive on a pipe. Here a file
stream source watches a folder; each new dump file's INSERT statements are parsed by the
same row-wise expressions as the batch loader (`parse_statements`) and appended to a parquet
folder. The checkpoint records which files were taken, so a restarted or failed query neither
loses nor repeats a file. By default it is a folder under `spark.checkpoint.dir` whose name
follows from the output folder: every call for one output goes on where the last one stopped.
No state is kept: every statement is independent.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import checkpoint_root
from ..sources.files import normalize_zone
from ..sources.sqldump import parse_statements


def dump_stream(spark: SparkSession, input_dir: str, schema: StructType, *, table: str | None = None,
                tz: str | None = "UTC", empty_as_null: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of the rows of `table` in dump files landing in `input_dir`."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(input_dir)
    return normalize_zone(parse_statements(lines, schema, table, empty_as_null=empty_as_null, tz=tz), tz)


def default_checkpoint(spark: SparkSession, output_dir: str) -> str:
    """The same folder for the same output folder."""
    name = hashlib.md5(output_dir.rstrip("/").encode()).hexdigest()
    return f"{checkpoint_root(spark)}/sluice-stream-{name}"


def start_dump_ingest(spark: SparkSession, input_dir: str, output_dir: str, schema: StructType, *,
                      table: str | None = None, tz: str | None = "UTC", checkpoint: str | None = None,
                      available_now: bool = True, processing_time: str | None = None,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest: parquet files in `output_dir`, exactly once per input file.

    `available_now=True` takes everything present, then stops (a scheduled batch job);
    otherwise it keeps running with `processing_time` triggers.
    """
    rows = dump_stream(spark, input_dir, schema, table=table, tz=tz,
                       max_files_per_trigger=max_files_per_trigger)
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", output_dir)
              .option("checkpointLocation", checkpoint or default_checkpoint(spark, output_dir)))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
