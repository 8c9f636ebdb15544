"""Training-text pipeline: five stages, each over all rows that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as Parquet in
the shared scratch folder and reads again for the next stage. All but the last return the columns
of the documents they are given.

- toxicity: documents with a score of 0.5 or more go (learned on `labels`).
- near_dedup: of each group of near copies (5-word shingles, similarity 0.8 or more) one row stays, that
  of the smallest id (rows without an id come last). Rows are compared as such: rows that share an
  id but not their text are different documents, repeated rows are copies, with an id or without.
- substring_dedup: bytes covered by a 200-byte string that also starts elsewhere are cut out, and
  what is left of a character that a cut divides goes with it; n_chars is counted anew. A document
  of which nothing is left stays with an empty text.
- decontamination: documents with a window 0.8 or more similar to a `benchmark` item go.
- byte_bpe: token count and digests of ids and decoded text.

Nulls, empty texts, repeated rows, empty tables and extra columns are handled as each operator
says; null texts stay null until substring_dedup, which makes them empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.bpe import byte_bpe
from sluice.llm.common import q, stage
from sluice.llm.decontam import decontaminated
from sluice.llm.neardup import near_duplicates
from sluice.llm.queries import digest_bpe, tokenizer_file
from sluice.llm.suffix import repeated_substrings
from sluice.llm.toxicity import add_scores, train
from sluice.sources.testdata import load


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = train(docs, load(spark, sf_dir, "labels"))
    scored = add_scores(docs, model, score="__sl_score")
    return scored.where(F.col("__sl_score") < 0.5).select(*[q(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = stage(docs.withColumn("__sl_row", F.monotonically_increasing_id()), "rows")
    groups = near_duplicates(rows, id_col="__sl_row").select(F.col("doc_id").alias("__sl_row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__sl_row")).alias("first")
    kept = (groups.join(rows.select("__sl_row", "doc_id"), "__sl_row").groupBy("component_id").agg(first)
            .select(F.col("first.__sl_row").alias("__sl_row")))
    return rows.join(kept.hint("merge"), "__sl_row", "left_semi").select(*[q(c) for c in docs.columns])


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeated_substrings(docs, extra=docs.columns)
    new = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return cut.select(*[(new[c] if c in new else F.col("extra")[c]).alias(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, load(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_bpe(byte_bpe(docs, tokenizer_file("byte_bpe_multi_50k.tiktoken")))


STAGES = [("toxicity", toxicity), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("byte_bpe", bpe)]

#: Stages 1, 3 and 5 (a trained model, byte windows, a tokenizer) have no SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
