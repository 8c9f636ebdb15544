"""What the range partitioning samples into the driver does not grow with the width of the rows."""

import json
import os
import subprocess
import sys
import tempfile

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from sluice.operators.numbering import with_row_number
from sluice.session import build_session
spark = build_session("local[4]", shuffle_partitions=8, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + {log!r}, "spark.eventLog.compress": "false",
    "spark.eventLog.rolling.enabled": "false"}})
for width in (10, 4000):
    text = F.concat(F.col("id").cast("string"), F.repeat(F.md5(F.col("id").cast("string")), width // 32 + 1))
    df = spark.range(0, 20000, 1, 4).select((F.col("id") % 5).cast("string").alias("lang"), "id", text.alias("text"))
    spark.sparkContext.setJobDescription(f"width {{width}}")
    with_row_number(df, ["lang"]).write.format("noop").mode("overwrite").save()
spark.stop()
"""


def test_sample_size_is_independent_of_text_width():
    log = tempfile.mkdtemp(prefix="sl-events-")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, log=log)], check=True, timeout=300,
                   capture_output=True)
    stage_of, largest = {}, {}
    with open(os.path.join(log, os.listdir(log)[0])) as fh:
        for line in fh:
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                for s in e["Stage IDs"]:
                    stage_of[s] = e.get("Properties", {}).get("spark.job.description")
            elif e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                key = (stage_of[e["Stage ID"]], e["Stage ID"])
                largest[key] = largest.get(key, 0) + e["Task Metrics"]["Result Size"]
    by = {w: max(v for (d, _), v in largest.items() if d == f"width {w}") for w in (10, 4000)}
    assert by[4000] < 1.5 * by[10] + 50_000, by
