"""Streaming dump ingest: a rerun with the same checkpoint takes only new files."""

import os
import tempfile

from sluice.session import scratch_path
from sluice.streaming.dump_ingest import start_dump_ingest

SCHEMA = "id long, name string"


def _drop(folder, name, text):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write(text)


def test_incremental_ingest_exactly_once(spark):
    from pyspark.sql.types import StructType
    schema = spark.createDataFrame([], SCHEMA).schema
    assert isinstance(schema, StructType)
    src = tempfile.mkdtemp(prefix="sl-stream-in-")
    out = scratch_path(spark, "test-stream-out")
    ckpt = scratch_path(spark, "test-stream-ckpt")
    _drop(src, "a.sql", "INSERT INTO `t` VALUES (1,'a'),(2,'b');\n")
    q = start_dump_ingest(spark, src, out, schema, table="t", checkpoint=ckpt)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 2
    _drop(src, "b.sql", "-- more\nINSERT INTO `t` VALUES (3,'c\\'s');\nINSERT INTO `u` VALUES (9,'no');\n")
    q = start_dump_ingest(spark, src, out, schema, table="t", checkpoint=ckpt)
    q.awaitTermination()
    rows = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert rows == [(1, "a"), (2, "b"), (3, "c's")]
