"""The registered queries and the pipeline over sf0.001 / sf0.01 tables, against plain definitions."""

import duckdb
import numpy as np
import pytest
from brute import contaminated, cut_repeats, near_duplicates, sha
from compare import assert_same, duck
from conftest import SF_CHECK, SF_SMALL

import __spark_entry__ as entry_mod
import corpus_pipeline
from sluice.llm.bpe import load_ranks
from sluice.llm.queries import ORACLE_SQL, QUERIES
from sluice.sources.testdata import load

P = pytest.importorskip("public_tokenizers")


def documents(sf):
    return duckdb.connect().execute(f"SELECT doc_id, text FROM read_parquet('{sf}/documents.parquet')").fetchall()


def library():
    import tiktoken
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(f.read()), special_tokens={})


def test_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_mod.queries())
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    assert_same(QUERIES[name](spark, SF_CHECK), duck(SF_CHECK), ORACLE_SQL[name])


def test_suffix_query(spark):
    rows = documents(SF_SMALL)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in QUERIES["op7_suffix_array_dedup"](spark, SF_SMALL).collect()}
    want = {i: (*x[:3], sha(x[3])) for (i, _), x in zip(rows, cut_repeats([t for _, t in rows], 200))}
    assert got == want


def test_bpe_query(spark):
    enc, rows = library(), documents(SF_SMALL)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op9_byte_bpe"](spark, SF_SMALL).collect()}
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        assert got[i] == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha((t or "").encode()))


def test_token_count_query(spark):
    from tokenizers import Tokenizer
    rows, t = documents(SF_CHECK), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op1_token_counts"](spark, SF_CHECK).collect()}
    for (i, x), e in zip(rows, t.encode_batch([x or "" for _, x in rows], add_special_tokens=False)):
        assert got[i] == (len((x or "").encode()), len(e.ids), len(e.ids) > 1024)


def test_contamination_query(spark):
    items = duckdb.connect().execute(f"SELECT item_id, text FROM read_parquet('{SF_SMALL}/benchmark.parquet')").fetchall()
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op3_benchmark_decontamination"](spark, SF_SMALL).collect()}
    assert got == pytest.approx(contaminated(documents(SF_SMALL), items))


def test_held_out_accuracy(spark):
    con = duckdb.connect()
    langs = dict(con.execute(f"SELECT doc_id, lang FROM read_parquet('{SF_CHECK}/documents.parquet')").fetchall())
    rows = [r for r in QUERIES["op6_language_id"](spark, SF_CHECK).collect() if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in rows) >= 0.98 * len(rows)
    toxic = dict(con.execute(f"SELECT doc_id, toxic FROM read_parquet('{SF_CHECK}/labels.parquet')").fetchall())
    rows = [r for r in QUERIES["op2_toxicity"](spark, SF_CHECK).collect() if r.doc_id in toxic]
    assert sum(r.predicted == toxic[r.doc_id] for r in rows) >= 0.93 * len(rows)
    assert not [r for r in rows if r.predicted and not toxic[r.doc_id]]


def test_conversations_query(spark):
    got = QUERIES["op4_chat_formatting"](spark, SF_CHECK)
    con = duck(SF_CHECK)
    assert got.count() == con.sql("SELECT count(*) FROM conversations").fetchall()[0][0]
    # these tables hold no quotation: every message is its own thread, in the order of turns
    assert con.sql("SELECT count(*) FROM conversations WHERE regexp_matches(text, '(?m)^[ \t]*>')").fetchall()[0][0] == 0
    assert_same(got.select("conv_id", "turn", "role", "position", "text"), con, """
        SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position, text FROM conversations""")


def test_pipeline(spark):
    """Every stage's decisions against its definition, on what the stage before it kept."""
    docs = load(spark, SF_CHECK, "documents")
    columns = docs.columns
    items = load(spark, SF_CHECK, "benchmark").collect()
    enc = library()
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = corpus_pipeline.stage(step(spark, docs, SF_CHECK), f"test-{name}")
        after = {r.doc_id: r for r in docs.collect()}
        texts = [(i, r.text) for i, r in before.items()]
        if name == "toxicity":
            want = {r.doc_id for r in QUERIES["op2_toxicity"](spark, SF_CHECK).where("predicted = 0").collect()}
            assert set(after) == want
        elif name == "near_dedup":
            groups = near_duplicates(texts, 5, 80)
            assert set(after) == {i for i, (_, c) in groups.items() if c == i}
        elif name == "substring_dedup":
            for (i, _), x in zip(texts, cut_repeats([t for _, t in texts], 200)):
                assert after[i].text == x[3].decode("utf-8", "ignore") and after[i].n_chars == len(after[i].text)
                assert (after[i].lang, after[i].source) == (before[i].lang, before[i].source)
        elif name == "decontamination":
            found = contaminated(texts, [(r.item_id, r.text) for r in items])
            assert set(after) == set(before) - {d for d, _ in found}
        else:
            assert {i: r.n_tokens for i, r in after.items()} == {i: len(enc.encode_ordinary(t)) for i, t in texts}
            assert all(r.decoded_sha256 == sha(before[i].text.encode()) for i, r in after.items())
            continue
        assert docs.columns == columns


def test_pipeline_unusual_rows(spark):
    """Nulls, empty and repeated rows pass every stage; of copies one stays, with an id or without."""
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "same words here", "en", "a", 3), (3, "same words here", "en", "a", 3),
            (None, "no id", "en", None, 5), (None, "no id", "en", None, 5), (4, "é" * 9000, None, "b", 1)]
    for table in (rows, []):
        docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long")
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, SF_SMALL), "test-unusual")
        got = sorted((r.doc_id or 0) for r in docs.collect())
        assert got == ([0, 1, 2, 3, 4] if table else [])


def test_rows_that_share_an_id_are_different_documents(spark):
    """A text goes only if a near copy of it stays; of a group the smallest id stays, rows without one last."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, c), (7, a + " more"), (None, c), (None, c + " d"), (None, "alone " * 9), (1, b), (5, "e"), (5, "f")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs.repartition(3), SF_SMALL)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in got.collect()) == sorted(
        [(1, a), (1, b), (2, c), (0, "alone " * 9), (5, "e"), (5, "f")])
