"""Loads that leave a table's old rows in place until the new ones are written and checked.

`staged_load` replaces all rows of a table:

1. begin:  a manifest beside the table names the load and its folder. It is also the lock.
2. stage:  the rows are written to that folder, through a table of the same schema and partitioning.
3. check:  the rows that the write's tasks counted are those that the folder holds, and the caller's
           check accepts them.
4. commit: the swap's plan (partitions and folders) is written down. This one file decides.
5. swap:   each partition, then the table, gets its new location; partitions that the load lacks are
           dropped. No file is moved, so this works alike on object stores.
6. clean:  the old folder and the manifests are deleted.

A load that dies before step 4 leaves the table as it was; after it, the next load of the table (or
`recover_load`) does the steps that are left, all of which may be done twice. Without partitions the
swap is one change of the catalog; with them each partition changes by itself, so a reader can meet
old and new partitions side by side, but never an empty or half-written one.

`append_run` adds the rows of one run, named by a key (survey and run date), and replaces those of an
earlier run of the same key. Staging, check and commit are the same; then the run's files move from
a hidden folder of the table into its partitions under names that carry the run's tag, so which rows
belong to a run is committed with the data itself: there is no moment at which a file is in the
table and its run unknown. Files of earlier attempts go before those of the new one come. The ledger
(`run_ledger`) has one file for each run, written behind its data; a run that died is finished or
undone by the next one of the same key (or by `recover_run`).

One writer at a time for each table (staged_load) or each run key (append_run); a second one takes
an unfinished load for a dead one, and that load then fails at its commit instead of mixing in.
The location of a table changes with each staged load: read it through the catalog.
"""

from __future__ import annotations

import json
import logging
import re
import uuid
import zlib
from collections.abc import Callable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_LOAD_SUFFIX = re.compile(r"__load_[0-9a-f]{12}$")


class LoadCheckFailed(RuntimeError):
    """The staged rows are not what the write counted, or the caller's check refused them."""


class LoadTakenOver(RuntimeError):
    """Another writer has taken this load for a dead one."""


# --- files ------------------------------------------------------------------------------

class _Store:
    """The few file operations that manifests and moves need, on the store that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark._jvm
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def rename(self, a: str, b: str) -> None:
        self.fs.mkdirs(self._path(b).getParent())
        if not self.fs.rename(self._path(a), self._path(b)):
            raise OSError(f"could not rename {a} to {b}")

    def names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return sorted(st.getPath().getName() for st in self.fs.listStatus(p)) if self.fs.exists(p) else []

    def files(self, folder: str) -> list[str]:
        """Data files under a folder, relative to it; hidden ones left out."""
        p = self._path(folder)
        if not self.fs.exists(p):
            return []
        root, out, it = self.fs.getFileStatus(p).getPath().toUri().getPath().rstrip("/") + "/", [], self.fs.listFiles(p, True)
        while it.hasNext():
            rel = it.next().getPath().toUri().getPath()[len(root):]
            if not any(x.startswith(("_", ".")) for x in rel.split("/")):
                out.append(rel)
        return sorted(out)

    def read(self, path: str) -> dict | None:
        if not self.exists(path):
            return None
        stream = self.fs.open(self._path(path))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def put(self, path: str, content: dict) -> None:
        """Write a small file that is there whole or not at all."""
        part = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
        out = self.fs.create(self._path(part), True)
        try:
            out.write(bytearray(json.dumps(content, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        self.delete(path)
        self.rename(part, path)


# --- the catalog's view of a table ------------------------------------------------------

def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _details(spark: SparkSession, table: str, spec: str = "") -> dict[str, str]:
    found: dict[str, str] = {}  # of a name that comes twice the first: a partition's details stand before its table's
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect():
        found.setdefault(r["col_name"], r["data_type"])
    return found


def table_location(spark: SparkSession, table: str) -> str:
    return _details(spark, table)["Location"].rstrip("/")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    """Partitions as `a=1/b=x` (values escaped as in folder names); a table without partition columns has none."""
    if not any(c.isPartition for c in spark.catalog.listColumns(table)):
        return []
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _spec(partition: str) -> str:
    pairs = [p.split("=", 1) for p in partition.split("/")]
    return "PARTITION (" + ", ".join(
        f"`{unquote(k)}` = " + ("null" if v == _NULL_PARTITION else _text(unquote(v))) for k, v in pairs) + ")"


def _parent_and_name(location: str) -> tuple[str, str]:
    parent, name = location.rsplit("/", 1)
    return parent, _LOAD_SUFFIX.sub("", name)


# --- replacing all rows ------------------------------------------------------------------

class _Load:
    """One staged load; every step behind `commit` may be done again."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table
        self.old = table_location(spark, table)
        self.parent, self.name = _parent_and_name(self.old)
        self.store = _Store(spark, self.parent)
        self.lock = f"{self.parent}/_load_{self.name}.json"

    def ready_file(self, load_id: str) -> str:
        return f"{self.parent}/_load_{self.name}.{load_id}.ready.json"

    def begin(self) -> dict:
        load_id = uuid.uuid4().hex[:12]
        plan = {"id": load_id, "table": self.table, "old": self.old, "new": f"{self.parent}/{self.name}__load_{load_id}",
                "staged": f"{self.table}__load_{load_id}"}
        self.store.put(self.lock, plan)
        return plan

    def stage(self, plan: dict, rows: DataFrame) -> int:
        """Write the rows into the staged table; returns how many rows its tasks wrote."""
        self.spark.sql(f"CREATE TABLE {plan['staged']} LIKE {self.table} LOCATION {_text(plan['new'])}")
        seen = Observation()  # outermost, so that only tasks that write count
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(plan["staged"], overwrite=False)
        return seen.get["rows"]

    def check(self, plan: dict, written: int, check: Callable[[DataFrame], bool | None] | None) -> None:
        staged = self.spark.table(plan["staged"])
        held = staged.count()
        if held != written:
            raise LoadCheckFailed(f"{self.table}: {written} rows written, {held} staged")
        if check is not None and check(staged) is False:
            raise LoadCheckFailed(f"{self.table}: the check refused {held} staged rows")

    def commit(self, plan: dict, written: int) -> dict:
        plan = plan | {"partitions": _partitions(self.spark, plan["staged"]), "rows": written}
        if (self.store.read(self.lock) or {}).get("id") != plan["id"]:
            raise LoadTakenOver(f"{self.table}: load {plan['id']} is no longer the table's load")
        self.store.put(self.ready_file(plan["id"]), plan)
        return plan

    def swap(self, plan: dict) -> None:
        spark, table, new = self.spark, self.table, plan["new"]
        held = set(_partitions(spark, table))
        for p in plan["partitions"]:
            at = _text(f"{new}/{p}")
            if p in held:
                spark.sql(f"ALTER TABLE {table} {_spec(p)} SET LOCATION {at}")
            else:
                spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_spec(p)} LOCATION {at}")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(new)}")
        for p in held.difference(plan["partitions"]):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(p)}")
        spark.catalog.refreshTable(table)

    def clean(self, plan: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {plan['staged']}")  # external: its files stay
        if plan["old"] != plan["new"]:
            self.store.delete(plan["old"])
        self.store.delete(self.ready_file(plan["id"]))
        self.store.delete(self.lock)

    def undo(self, plan: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {plan['staged']}")
        self.store.delete(plan["new"])
        self.store.delete(self.lock)


def recover_load(spark: SparkSession, table: str) -> str | None:
    """Finish or undo a staged load of the table that died: "finished", "undone", or None if there is none."""
    load = _Load(spark, table)
    plan = load.store.read(load.lock)
    if plan is None:
        return None
    ready = load.store.read(load.ready_file(plan["id"]))
    if ready is None:
        load.undo(plan)
        return "undone"
    load.swap(ready)
    load.clean(ready)
    return "finished"


def staged_load(rows: DataFrame, table: str, *, check: Callable[[DataFrame], bool | None] | None = None) -> int:
    """Replace all rows of a table by `rows` (in the table's shape); returns their number.

    check: looks at the staged rows; if it raises or returns False, the table stays as it was.
    The rows may be derived from the table itself."""
    spark = rows.sparkSession
    state = recover_load(spark, table)
    if state:
        log.warning("%s: an earlier load that died was %s", table, state)
    load = _Load(spark, table)
    plan = load.begin()
    try:
        written = load.stage(plan, rows)
        load.check(plan, written, check)
        plan = load.commit(plan, written)
    except LoadTakenOver:
        raise
    except Exception:
        load.undo(plan)
        raise
    load.swap(plan)
    load.clean(plan)
    return written


# --- adding the rows of a run ------------------------------------------------------------

def run_tag(run: Mapping[str, object]) -> str:
    """A file-name part that stands for a run key: readable, and different for different keys."""
    if not run:
        raise ValueError("a run key needs at least one name and value")
    text = json.dumps({str(k): str(v) for k, v in run.items()}, sort_keys=True)
    words = "-".join(re.sub(r"[^A-Za-z0-9]+", ".", str(v)) for _, v in sorted(run.items()))
    return f"{words[:60]}-{zlib.crc32(text.encode()):08x}{zlib.crc32(text[::-1].encode()):08x}"


class _Run:
    """One run's append; every step behind `commit` may be done again."""

    def __init__(self, spark: SparkSession, table: str, run: Mapping[str, object]):
        self.spark, self.table, self.run = spark, table, {str(k): str(v) for k, v in run.items()}
        self.tag = run_tag(run)
        self.location = table_location(spark, table)
        self.store = _Store(spark, self.location)
        self.book = f"{self.location}/_runs"

    def path(self, state: str) -> str:
        return f"{self.book}/{self.tag}.{state}.json"

    def begin(self) -> dict:
        attempt = uuid.uuid4().hex[:12]
        plan = {"run": self.run, "attempt": attempt, "new": f"{self.location}/_stage_{self.tag}_{attempt}",
                "staged": f"{self.table}__run_{attempt}"}
        self.store.put(self.path("begun"), plan)
        return plan

    stage, check = _Load.stage, _Load.check

    def home(self, partition: str) -> str:
        """The folder of a partition (or of the table)."""
        if not partition:
            return self.location
        if partition in _partitions(self.spark, self.table):
            return _details(self.spark, self.table, _spec(partition))["Location"].rstrip("/")
        return f"{self.location}/{partition}"

    def commit(self, plan: dict, written: int) -> dict:
        moves, homes = [], {}
        for f in self.store.files(plan["new"]):
            partition, _, name = f.rpartition("/")
            if partition not in homes:
                homes[partition] = self.home(partition)
            moves.append([f"{plan['new']}/{f}", f"{homes[partition]}/run_{self.tag}_{plan['attempt']}_{name}"])
        done = self.store.read(self.path("done")) or {}
        plan = plan | {"moves": moves, "partitions": sorted(p for p in homes if p), "rows": written,
                       "replaces": done.get("files", []), "files": [to for _, to in moves]}
        if (self.store.read(self.path("begun")) or {}).get("attempt") != plan["attempt"]:
            raise LoadTakenOver(f"{self.table}: attempt {plan['attempt']} of {self.run} is no longer its run")
        self.store.put(self.path("ready"), plan)
        return plan

    def swap(self, plan: dict) -> None:
        for f in plan["replaces"]:
            if f not in plan["files"]:
                self.store.delete(f)
        for a, b in plan["moves"]:
            if self.store.exists(a):
                self.store.rename(a, b)
            elif not self.store.exists(b):
                raise FileNotFoundError(f"{self.table}: neither {a} nor {b} is there")
        held = set(_partitions(self.spark, self.table))
        for p in plan["partitions"]:
            if p not in held:
                self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {_spec(p)} LOCATION {_text(self.location + '/' + p)}")
        self.spark.catalog.refreshTable(self.table)

    def enter(self, plan: dict) -> None:
        """The ledger's line of the run, behind its data."""
        self.store.put(self.path("done"), {"run": self.run, "rows": plan["rows"], "files": plan["files"], "attempt": plan["attempt"]})

    def clean(self, plan: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {plan['staged']}")
        self.store.delete(plan["new"])
        self.store.delete(self.path("ready"))
        self.store.delete(self.path("begun"))


def recover_run(spark: SparkSession, table: str, run: Mapping[str, object]) -> str | None:
    """Finish or undo an append of this run that died: "finished", "undone", or None if there is none."""
    it = _Run(spark, table, run)
    plan = it.store.read(it.path("ready"))
    if plan is not None:
        it.swap(plan)
        it.enter(plan)
        it.clean(plan)
        return "finished"
    plan = it.store.read(it.path("begun"))
    if plan is None:
        return None
    it.clean(plan)
    return "undone"


def append_run(rows: DataFrame, table: str, run: Mapping[str, object], *,
               check: Callable[[DataFrame], bool | None] | None = None) -> int:
    """Add the rows (in the table's shape) of the run named by `run`, in place of those that an earlier run of
    that key added; returns their number. Rows of other runs and plain appends are not touched."""
    spark = rows.sparkSession
    state = recover_run(spark, table, run)
    if state:
        log.warning("%s: an earlier attempt of %s that died was %s", table, dict(run), state)
    it = _Run(spark, table, run)
    plan = it.begin()
    try:
        written = it.stage(plan, rows)
        it.check(plan, written, check)
        plan = it.commit(plan, written)
    except LoadTakenOver:
        raise
    except Exception:
        it.clean(plan)
        raise
    it.swap(plan)
    it.enter(plan)
    it.clean(plan)
    return written


def run_ledger(spark: SparkSession, table: str) -> DataFrame:
    """run (name -> value), rows, n_files, attempt of every run whose rows the table holds. One small file
    for each run is read by the driver."""
    location = table_location(spark, table)
    store = _Store(spark, location)
    lines = [store.read(f"{location}/_runs/{n}") for n in store.names(f"{location}/_runs") if n.endswith(".done.json")]
    return spark.createDataFrame([(x["run"], x["rows"], len(x["files"]), x["attempt"]) for x in lines],
                                 "run map<string, string>, rows long, n_files int, attempt string")
