"""Token counts without token ids: pieces are counted once for each distinct pre-token.

1. Every task lists the pre-tokens of its texts with their frequencies; Spark adds them up to
   one row per distinct pre-token (the vocabulary of the corpus).
2. The tokenizer counts the pieces of each distinct pre-token once; the result is a table.
3. Each document's pre-token frequencies are joined to that table and the products summed.

Frequencies follow a steep law, so the join is split by frequency: the `hot` most frequent
pre-tokens of at most `HOT_BYTES` bytes (so the broadcast is bounded in rows and bytes) are looked
up where the document is read, and only the rest of each document goes through the shuffled join,
which the adaptive planner splits should a long pre-token be frequent. Nothing is left out.

Pre-tokens are split as the tokenizers library's byte-level pre-tokenizer does; texts with
characters outside the ranges where the standard `re` classes are known to agree are split by
that pre-tokenizer itself. The strings of special tokens inside a text are found first and
count one each, the library's default.

Defined cases: null text is empty: 0 bytes, 0 tokens. Repeated rows are counted each. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import _FAST, _ODD
from .common import done, pick, stage, table_bytes, utf8, worker_state

#: Distinct pre-tokens that a task holds before it hands them on, and their characters.
TASK_PIECES, TASK_CHARS = 400_000, 64 << 20
#: Longest pre-token that is broadcast.
HOT_BYTES = 64


class PreTokens:
    def __init__(self, tokenizer: bytes):
        from tokenizers import Tokenizer, pre_tokenizers
        spec = json.loads(tokenizer)
        kind = spec.get("pre_tokenizer") or {}
        if kind.get("type") != "ByteLevel" or spec.get("normalizer") or kind.get("add_prefix_space"):
            raise ValueError("a byte-level tokenizer without normalizer and prefix space is needed")
        self.library = Tokenizer.from_str(tokenizer.decode("utf-8"))
        self.slow = pre_tokenizers.ByteLevel(add_prefix_space=False)
        special = [t["content"] for t in spec.get("added_tokens", ())]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def split(self, text: str) -> tuple[list[str], int]:
        """(pre-tokens, number of special tokens) of a text."""
        if self.special is None or not (found := len(self.special.findall(text))):
            return self._plain(text), 0
        out = []
        for part in self.special.split(text):
            out += self._plain(part)
        return out, found

    def _plain(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return _FAST.findall(text)
        return [text[a:b] for _, (a, b) in self.slow.pre_tokenize_str(text)]

    def pieces(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        return [len(e.ids) for e in self.library.encode_batch(words, add_special_tokens=False)]


def _pre_tokens(tokenizer: bytes) -> PreTokens:
    key = (len(tokenizer), zlib.crc32(tokenizer))
    kept = worker_state("tokencount")
    if kept.get("key") != key:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        kept.update(key=key, split=PreTokens(tokenizer))
    return kept["split"]


def _vocabulary(shared):
    def run(batches):
        split, seen, chars = _pre_tokens(shared.value), Counter(), 0

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                             names=["piece", "freq"])
            seen.clear()
            return got
        for batch in batches:
            for t in batch.column("text"):
                text = t.as_py() or ""
                seen.update(split.split(text)[0])
                chars += len(text)
                full = False
                if chars > TASK_CHARS:
                    full, chars = sum(map(len, seen)) > TASK_CHARS, 0
                if full or len(seen) > TASK_PIECES:
                    yield out()
        if seen:
            yield out()
    return run


def _counted(shared):
    def run(batches):
        split = _pre_tokens(shared.value)
        for batch in batches:
            n = split.pieces(batch.column("piece").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("piece"), batch.column("freq"), pa.array(n, pa.int32())],
                                             names=["piece", "freq", "n"])
    return run


_PART = "id long, n_bytes long, base long, rare array<struct<piece: string, freq: int>>"


def _documents(shared, known):
    pair = pa.struct([("piece", pa.string()), ("freq", pa.int32())])

    def run(batches):
        split = _pre_tokens(shared.value)
        table = pa.ipc.open_stream(known.value).read_all()
        hot = dict(zip(table.column("piece").to_pylist(), table.column("n").to_pylist()))
        get = hot.get
        for batch in batches:
            _, off = utf8(batch.column("text"))
            texts = batch.column("text")
            for lo in range(0, batch.num_rows, 512):
                base, sizes, words, freqs = [], [0], [], []
                for t in texts.slice(lo, 512):
                    found, special = split.split(t.as_py() or "")
                    total, rare = special, {}
                    for word in found:
                        n = get(word)
                        if n is None:
                            rare[word] = rare.get(word, 0) + 1
                        else:
                            total += n
                    base.append(total)
                    words += rare
                    freqs += rare.values()
                    sizes.append(len(words))
                flat = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(freqs, pa.int32())], fields=list(pair))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, 512).cast(pa.int64()), pa.array(np.diff(off[lo:lo + len(base) + 1])),
                     pa.array(base, pa.int64()), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)],
                    names=["id", "n_bytes", "base", "rare"])
    return run


def token_counts(docs: DataFrame, tokenizer: bytes, *, limit: int = 1024, hot: int = 150_000,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every row.

    tokenizer: content of a tokenizers .json file (byte-level BPE), read on the driver.
    hot: how many of the most frequent pre-tokens (of HOT_BYTES at most) are broadcast.
    """
    spark = docs.sparkSession
    texts = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text")
    shared = table_bytes(spark, tokenizer)
    words = stage(texts.select("text").mapInArrow(_vocabulary(shared), "piece string, freq long")
                  .groupBy("piece").agg(F.sum("freq").alias("freq"))
                  .mapInArrow(_counted(shared), "piece string, freq long, n int"), "pieces")
    done(spark)
    top = words.where(F.octet_length("piece") <= HOT_BYTES).orderBy(F.col("freq").desc(), "piece").limit(hot).select("piece", "n").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, top.schema) as w:
        w.write_table(top)
    known = table_bytes(spark, sink.getvalue().to_pybytes())

    part = stage(texts.mapInArrow(_documents(shared, known), _PART)
                 .withColumn("row", F.monotonically_increasing_id()), "parts")
    rare = (part.select("row", F.explode("rare").alias("r")).select("row", "r.piece", "r.freq")
            .join(words.select("piece", "n"), "piece")
            .groupBy("row").agg(F.sum(F.col("freq") * F.col("n")).alias("more")))
    total = F.col("base") + F.coalesce("more", F.lit(0))
    return (part.drop("rare").join(rare, "row", "left")
            .select(F.col("id").alias("doc_id"), "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")))
