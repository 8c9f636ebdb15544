"""Session helpers: building a session for tests/bench and locating shared scratch space.

Library code never builds its own session; it takes the caller's. The helpers that touch
storage (`checkpoint_root`, `scratch_path`, `scratch_table`) read `spark.checkpoint.dir` from
the session, because on a cluster that is the shared folder every executor can reach; a
folder of its own is set only where none is configured and the master is local (tests).
"""

from __future__ import annotations

import os
import tempfile
import time
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings with meaning for the operators here (not deployment sizing).
SEMANTIC_CONF = {
    # AQE: coalesce small shuffles, split skewed partitions, pick broadcast at runtime
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: the static threshold trusts file-size estimates,
    # the adaptive one uses the real size of a finished shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "sluice",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. Clusters pass their own session instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g"))
    for k, v in {**SEMANTIC_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM: `local` or `local[...]`. `local-cluster[...]` has executors of their own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is configured.

    On a cluster the folder must be shared storage named by `spark.checkpoint.dir`; a
    machine-local default is only acceptable in local mode (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif _is_local(spark):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-ckpt-"))
    else:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage "
                           "(HDFS/object store) before running operators that cut lineage")
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates (from `spark.checkpoint.dir`)."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        return conf_dir.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/")


_made: list[str] = []  # scratch paths of this process that are not released yet


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; `release` removes it."""
    path = f"{checkpoint_root(spark)}/sluice-{kind}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def release(spark: SparkSession, *paths: str) -> None:
    """Delete scratch paths (all that this process made, if none is named). Call it when what was
    derived from them has been written or is no longer needed."""
    for path in paths or tuple(_made):
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)
        if path in _made:
            _made.remove(path)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch paths made inside the block are deleted at its end: consume results (write or
    collect them) inside."""
    before = set(_made)
    try:
        yield
    finally:
        mine = [p for p in _made if p not in before]
        if mine:
            release(spark, *mine)


def expire_scratch(spark: SparkSession, older_than_hours: float) -> list[str]:
    """Delete leftovers (of failed or forgotten jobs) under the checkpoint folder that have not
    changed for so long; returns their paths. Stream checkpoints are kept."""
    fs, root = _hadoop(spark, checkpoint_root(spark))
    if not fs.exists(root):
        return []
    limit, gone = time.time() * 1000 - older_than_hours * 3_600_000, []
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("sluice-") and not name.startswith("sluice-stream-") and st.getModificationTime() < limit:
            fs.delete(st.getPath(), True)
            gone.append(str(st.getPath().toString()))
    return gone


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers (once for each application)."""
    sc = spark.sparkContext
    if getattr(sc, "_sluice_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    to = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="sluice-py-")), "sluice_pkg.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(to)
    sc._sluice_shipped = True


def unique_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


SCRATCH_DB = "sluice_scratch"


def scratch_table(spark: SparkSession, prefix: str) -> str:
    """A fresh table name in a dedicated scratch database (located under the checkpoint
    folder), so intermediate tables never clutter the user's databases."""
    if not spark.catalog.databaseExists(SCRATCH_DB):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DB} "
                  f"LOCATION '{checkpoint_root(spark)}/{SCRATCH_DB}.db'")
    return f"{SCRATCH_DB}.{unique_name(prefix)}"
