"""Helpers shared by the operators: materialised stages, Arrow text columns, hashing with numpy.

Texts are handled as UTF-8 bytes in blocks of whole documents (`blocks`), so memory in a task
is bounded by the block size plus one document.
"""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Bytes of text that one numpy block holds, unless a single document is longer.
BLOCK_BYTES = 1 << 18
#: Rows of an Arrow batch.
ARROW_ROWS = 1024
_ARROW_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def stage(df: DataFrame, kind: str) -> DataFrame:
    """Write `df` as a table in the shared scratch folder and read it back.

    This cuts lineage: a lost executor re-reads files instead of re-running what came before.
    """
    spark = df.sparkSession
    path = scratch_path(spark, kind)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sluice_path = path
    return out


def done(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stage tables that nothing will read again, and let Spark drop the shuffle files
    of finished jobs (it does so when the driver's garbage collector has seen their plans)."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t._sluice_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    spark._jvm.System.gc()


def q(name: str):
    """A column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (once for each application), and hand
    them texts in batches of ARROW_ROWS where the session has Spark's default: 10,000 whole
    texts would be held several times over in every task."""
    if spark.conf.get(_ARROW_CONF, "10000") == "10000":
        spark.conf.set(_ARROW_CONF, str(ARROW_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_sluice_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="sluice-py-")), "sluice_pkg.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(to)
    sc._sluice_shipped = True


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """The named input columns under fixed internal names; extra columns are left behind."""
    ship(df.sparkSession)
    return df.select(*[q(src).alias(dst) for dst, src in cols.items()])


def held_out(doc_id):
    """crc32 of doc_id as text modulo 5 is 0 (a null id counts as the text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def table_bytes(spark: SparkSession, data: bytes):
    """Broadcast a file's content that the driver read (a vocabulary of fixed size)."""
    return spark.sparkContext.broadcast(data)


_state: dict = {"owner": None, "value": {}}


def worker_state(owner: str) -> dict:
    """What a Python worker keeps from task to task (compiled tables and caches), of one operator at a
    time: the state of another one is dropped."""
    if _state["owner"] != owner:
        _state.update(owner=owner, value={})
    return _state["value"]


# --- Arrow text columns -------------------------------------------------------------

def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


# --- hashing ------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (bijective)."""
    x = (x ^ (x >> _U(30))) * _M1
    x = (x ^ (x >> _U(27))) * _M2
    return x ^ (x >> _U(31))


def salts(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE_CODE = salts(256, 11)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        up, down = np.full(size, _BASE, _U), np.full(size, _BASE_INV, _U)
        up[0] = down[0] = 1
        _powers["up"], _powers["down"] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers["up"], _powers["down"]


# --- words --------------------------------------------------------------------------

def word_table(punctuation: bool = False) -> np.ndarray:
    """Byte -> byte, 0 for separators: white space (and, on request, ASCII punctuation); A-Z lowered."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    if punctuation:
        for c in range(1, 128):
            if not chr(c).isalnum():
                t[c] = 0
    t[[32, *range(9, 14)]] = 0
    return t


class Words:
    """Words of a block of documents: `hash` (64 bit), `start`/`end` (byte positions),
    `first` (index of each document's first word, one more at the end), `doc` (its document)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        n = len(data)
        self.n_docs = len(offsets) - 1
        mapped = table[data]
        # NUL bytes of the text are ordinary characters: only what the table maps to 0 separates
        sep = (table == 0)[data]
        if table[0] == 0:
            sep &= data != 0
        word = ~sep
        edge = np.zeros(n + 1, bool)
        edge[offsets[:-1]] = True
        edge[n] = True
        before = np.empty(n, bool)
        if n:
            before[0] = True
            before[1:] = sep[:-1]
        before |= edge[:n]
        after = np.empty(n, bool)
        if n:
            after[-1] = True
            after[:-1] = sep[1:]
        after |= edge[1:]
        self.start = np.flatnonzero(word & before)
        self.end = np.flatnonzero(word & after) + 1
        up, down = _power(n + 1)
        with np.errstate(over="ignore"):
            total = np.zeros(n + 1, _U)
            np.cumsum(_BYTE_CODE[mapped] * up[:n], out=total[1:])
            self.hash = mix((total[self.end] - total[self.start]) * down[self.start]
                            + (self.end - self.start).astype(_U))
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, document, first word) of every run of k words inside a document; a document
        of fewer words has its whole sequence as its one shingle."""
        c = salts(k, 77)
        n = len(self.hash)
        with np.errstate(over="ignore"):
            acc = np.zeros(max(0, n - k + 1), _U)
            for j in range(k):
                acc += self.hash[j:n - k + 1 + j] * c[j] if len(acc) else acc
            at = np.flatnonzero(self.doc[:len(acc)] == self.doc[k - 1:]) if len(acc) else np.zeros(0, np.int64)
            h, d = mix(acc[at]), self.doc[at]
            short = np.flatnonzero((self.count > 0) & (self.count < k))
            if len(short):
                extra = np.array([int((self.hash[self.first[s]:self.first[s + 1]] * c[:self.count[s]]).sum())
                                  + int(self.count[s]) * 0x51ED27 & (1 << 64) - 1 for s in short], _U)
                h = np.concatenate([h, mix(extra)])
                d, at = np.concatenate([d, short]), np.concatenate([at, self.first[short]])
                order = np.argsort(d, kind="stable")
                h, d, at = h[order], d[order], at[order]
        return h, d, at
