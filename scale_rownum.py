"""Scale study: global row number and positional zip, single-partition window vs range version.

Generates `n` rows with the table generator (written to parquet under the checkpoint folder
first, so generation is not timed), then times each method through the `noop` sink.
Prints one JSON line per (n, method). Usage: python scale_rownum.py 600000 6000000 ...
Environment: BENCH_CPUS (default 8), SCALE_METHODS (default "window,range,range_unique"),
SCALE_RATIO (default 1: the zip's second side has as many rows; 10: a tenth).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import (LongType, StringType, StructField, StructType,  # noqa: E402
                               TimestampNTZType)

from sluice.operators.numbering import with_row_number, zip_by_position  # noqa: E402
from sluice.operators.synth import synth_table  # noqa: E402
from sluice.session import build_session, scratch_path  # noqa: E402

SCHEMA = StructType([StructField("k", StringType()), StructField("a", LongType()),
                     StructField("s", StringType()), StructField("ts", TimestampNTZType())])


def main(sizes: list[int]) -> None:
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    methods = os.environ.get("SCALE_METHODS", "window,range,range_unique").split(",")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=4 * cpus, app="sluice-scale")
    for n in sizes:
        path = scratch_path(spark, f"scale-{n}")
        synth_table(spark, SCHEMA, n, keys={"k": "row"}).write.parquet(path)
        df = spark.read.parquet(path)
        ratio = int(os.environ.get("SCALE_RATIO", "1"))
        short = scratch_path(spark, f"scale-{n}-short")
        synth_table(spark, SCHEMA, max(1, n // ratio), keys={"k": "row"}, seed=7).write.parquet(short)
        side = spark.read.parquet(short)
        other = side.select(*[F.col(c).alias(f"o_{c}") for c in side.columns])
        for m in methods:
            method = "window" if m == "window" else "range"
            unique = m == "range_unique"
            t0 = time.perf_counter()
            with_row_number(df, [F.col("k").desc()], method=method, unique_order=unique) \
                .write.format("noop").mode("overwrite").save()
            t_rn = time.perf_counter() - t0
            t0 = time.perf_counter()
            zip_by_position(df, other, ["k"], ["o_a", "o_k"], method=method, unique_orders=unique) \
                .write.format("noop").mode("overwrite").save()
            t_zip = time.perf_counter() - t0
            print(json.dumps({"rows": n, "other": max(1, n // ratio), "method": m, "row_number_sec": round(t_rn, 2),
                              "zip_sec": round(t_zip, 2), "cpus": cpus}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main([int(a) for a in sys.argv[1:]] or [600_000, 6_000_000])
