"""Registered queries of this package, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.testdata import load
from . import htmlcrf, langid
from .bpe import byte_bpe
from .chat import link_quotations
from .common import held_out
from .decontam import contamination
from .divergence import divergence
from .neardup import near_duplicates
from .packing import pack, token_pieces
from .quality import quality_rules
from .suffix import repeated_substrings
from .tokencount import token_counts
from .toxicity import toxicity
from .variants import spelling_variants


def tokenizer_file(name: str) -> bytes:
    """A public vocabulary, read on the driver (fixed size)."""
    import public_tokenizers
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    """Bytes and tokens of every text, and whether it has more than 1024 tokens."""
    return token_counts(load(spark, sf_dir, "documents"), tokenizer_file(vocabulary), limit=1024)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text, learned from positive and unlabelled rows outside the held-out fold."""
    return toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a window that is 0.8 or more similar to a benchmark item, and the items."""
    return contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without quotations, linked to what they quote and in reply order."""
    return link_quotations(load(spark, sf_dir, "conversations"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text, and whether it is close to a language's character and word histograms."""
    return quality_rules(load(spark, sf_dir, "documents")).drop("char_distance", "word_distance")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text by naive Bayes, learned outside the held-out fold."""
    docs = load(spark, sf_dir, "documents")
    out = langid.identify(docs, langid.train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the 200-byte strings that also start elsewhere."""
    out = repeated_substrings(load(spark, sf_dir, "documents"), length=200)
    return out.select("doc_id", "n_bytes",
                      F.expr("aggregate(spans, 0L, (a, s) -> a + s.stop - s.start)").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page by a CRF over its leaf blocks."""
    pages = load(spark, sf_dir, "pages")
    out = htmlcrf.extract(pages, htmlcrf.train(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def digest_bpe(encoded: DataFrame) -> DataFrame:
    """Token counts and digests of `byte_bpe`'s ids and decoded texts."""
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Token ids of every text and their decoding, as digests."""
    return digest_bpe(byte_bpe(load(spark, sf_dir, "documents"), tokenizer_file(vocabulary)))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return near_duplicates(load(spark, sf_dir, "documents"), k=3, percent=85)


def op11_best_fit_packing(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    """Token pieces of every text, packed into sequences of at most 4096 tokens."""
    pieces = token_pieces(load(spark, sf_dir, "documents"), tokenizer_file(vocabulary), capacity=4096, end_id=1)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the texts (one run in 97 misspelt), their near words, forms and roots."""
    return spelling_variants(load(spark, sf_dir, "documents"), min_length=5, min_count=3, ratio=2, drop_every=97)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances between the sources of each language by their terms, and each source's own terms."""
    return divergence(load(spark, sf_dir, "documents"), min_docs=10, top=10)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_source_divergence": op13_source_divergence,
}

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x20\x09-\x0D]+')"""



def _quality_sql() -> str:
    """The same counts, references and distances; all pairs of document and language."""
    from .quality import CLASSES

    def quoted(text):
        return "'" + text.replace("'", "''") + "'"

    def without(chars):
        made = " || ".join(f"chr({ord(c)})" if ord(c) < 32 else quoted(c) for c in chars)
        return f"length(t) - length(translate(t, {made}, ''))"
    classes = ", ".join(f"{without(c)} AS c{i}" for i, c in enumerate(CLASSES.values()))
    n = len(CLASSES)
    known = " + ".join(f"c{i}" for i in range(n))
    every = ", ".join([*[f"c{i}" for i in range(n)], "n_chars - n_known"])
    sums = ", ".join([*[f"sum(c{i})" for i in range(n)], "sum(n_chars - n_known)"])
    term = """CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END"""
    ws = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH b AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, regexp_extract_all(t, '{ws}+') AS ws, length(t) AS n_chars, {classes} FROM b),
g AS (SELECT *, len(ws) AS n_words, {known} AS n_known,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{ws}')) AS lines FROM f),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, n_words - 6)) AS i FROM g WHERE n_words >= 8)),
twice AS (SELECT doc_id, k FROM win GROUP BY doc_id, k HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT word_no) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS word_no FROM win JOIN twice USING (doc_id, k)) GROUP BY doc_id),
cs AS (SELECT lang, [{sums}] AS v, sum(n_chars) AS total FROM g WHERE lang IS NOT NULL AND n_words > 0 GROUP BY lang),
cp AS (SELECT lang, unnest(range(1, {n + 2})) AS i, unnest(v) / total AS p FROM cs),
cd AS (SELECT doc_id, n_chars, unnest(range(1, {n + 2})) AS i, unnest([{every}]) AS c FROM g WHERE n_chars > 0),
cj AS (SELECT doc_id, lang, sqrt(greatest(sum({term}) / 2, 0)) AS d
       FROM (SELECT doc_id, lang, p, c / n_chars AS q FROM cd JOIN cp USING (i)) GROUP BY doc_id, lang),
cm AS (SELECT doc_id, min(d) AS d FROM cj GROUP BY doc_id),
sw AS (SELECT doc_id, lang, n_words, lower(w) AS w FROM (SELECT doc_id, lang, n_words, unnest(ws) AS w FROM g) WHERE length(w) <= 4),
tot AS (SELECT lang, sum(n_words) AS n FROM g WHERE lang IS NOT NULL AND n_words > 0 GROUP BY lang),
top AS (SELECT lang, w, c FROM (SELECT lang, w, count(*) AS c, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS r
        FROM sw WHERE lang IS NOT NULL GROUP BY lang, w) WHERE r <= 16),
wp AS (SELECT lang, w, c / n AS p FROM top JOIN tot USING (lang)),
dw AS (SELECT doc_id, w, count(*) AS c FROM sw GROUP BY doc_id, w),
dl AS (SELECT g.doc_id, g.n_words, wp.lang, wp.p, coalesce(dw.c, 0) / g.n_words AS q
       FROM g CROSS JOIN wp LEFT JOIN dw ON dw.doc_id = g.doc_id AND dw.w = wp.w WHERE g.n_words > 0),
da AS (SELECT doc_id, lang, p, q FROM dl
       UNION ALL SELECT doc_id, lang, 1 - sum(p), greatest(1 - sum(q), 0) FROM dl GROUP BY doc_id, lang),
wj AS (SELECT doc_id, lang, sqrt(greatest(sum({term}) / 2, 0)) AS d FROM da GROUP BY doc_id, lang),
wm AS (SELECT doc_id, min(d) AS d FROM wj GROUP BY doc_id),
o AS (SELECT g.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_chars - c{list(CLASSES).index("space")} AS BIGINT) AS word_chars,
        CAST(c{list(CLASSES).index("symbol")} AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        (n_chars >= 200 AND coalesce(cm.d, 0) > 0.32) OR (n_words >= 50 AND coalesce(wm.d, 0) > 0.33) AS far
      FROM g LEFT JOIN rep USING (doc_id) LEFT JOIN cm USING (doc_id) LEFT JOIN wm USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT far AS kept
FROM o"""


_CHAT_SQL = r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS rid, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
raw AS (SELECT rid, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10))) AS line,
          generate_subscripts(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)), 1) AS i
        FROM m WHERE regexp_matches(text, '(?m)^[ \t]*>')),
marked AS (SELECT rid, i, line, regexp_extract(line, '^[ \t]*(?:>[ \t]*)+', 0) AS marks FROM raw),
l AS (SELECT rid, i, length(marks) - length(replace(marks, '>', '')) AS level, substr(line, length(marks) + 1) AS body FROM marked),
steps AS (SELECT *, CASE WHEN lag(level) OVER (PARTITION BY rid ORDER BY i) = level THEN 0 ELSE 1 END AS new FROM l),
r AS (SELECT *, sum(new) OVER (PARTITION BY rid ORDER BY i) AS run FROM steps),
own AS (SELECT rid, regexp_replace(string_agg(body, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS own FROM l WHERE level = 0 GROUP BY rid),
pass AS (SELECT rid, run, level, string_agg(body, chr(10) ORDER BY i) AS text, row_number() OVER (PARTITION BY rid ORDER BY run) - 1 AS nth
         FROM r WHERE level > 0 GROUP BY rid, run, level),
p AS (SELECT m.*, CASE WHEN q.rid IS NULL THEN m.text ELSE coalesce(own.own, '') END AS mine, coalesce(n.n, 0) AS n_quotes
      FROM m LEFT JOIN (SELECT DISTINCT rid FROM raw) q USING (rid) LEFT JOIN own USING (rid)
      LEFT JOIN (SELECT rid, count(*) AS n FROM pass GROUP BY rid) n USING (rid)),
want AS (SELECT rid, nth, level, 0 AS part, text FROM pass
         UNION ALL SELECT rid, nth, level, 1, unnest(regexp_split_to_array(text, '\n[ \t]*\n')) FROM pass
         UNION ALL SELECT rid, nth, level, 2, unnest(string_split(text, chr(10))) FROM pass),
w AS (SELECT DISTINCT m.conv_id, m.turn, nth, level, part, trim(regexp_replace(lower(want.text), '\s+', ' ', 'g')) AS k
      FROM want JOIN m USING (rid)),
parts AS (SELECT conv_id, turn, mine AS text FROM p
          UNION ALL SELECT conv_id, turn, unnest(string_split(mine, chr(10))) FROM p
          UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(mine, '\n[ \t]*\n')) FROM p),
src AS (SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS k FROM parts),
hit AS (SELECT w.conv_id, w.turn, nth, level, part, max(src.turn) AS source FROM w JOIN src ON w.conv_id = src.conv_id AND w.k = src.k
        WHERE src.turn < w.turn AND w.k <> '' GROUP BY w.conv_id, w.turn, nth, level, part),
src_of AS (SELECT conv_id, turn, nth, source FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn, nth
           ORDER BY level, part, source DESC) AS best FROM hit) WHERE best = 1),
ss AS (SELECT conv_id, turn, rid, string_agg(coalesce(CAST(s.source AS VARCHAR), '-'), ',' ORDER BY pass.nth) AS sources
       FROM pass JOIN m USING (rid) LEFT JOIN src_of s USING (conv_id, turn, nth) GROUP BY conv_id, turn, rid),
link AS (SELECT conv_id, turn, source AS parent FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn
         ORDER BY level, nth, part, source DESC) AS best FROM hit) WHERE best = 1),
up AS (SELECT conv_id, turn, parent AS root, 1 AS depth FROM link
       UNION ALL SELECT up.conv_id, up.turn, link.parent, up.depth + 1 FROM up JOIN link ON link.conv_id = up.conv_id AND link.turn = up.root),
top AS (SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM up GROUP BY conv_id, turn),
o AS (SELECT p.conv_id, p.turn, p.role, link.parent AS parent_turn, coalesce(top.root, p.turn) AS root_turn,
        CAST(coalesce(top.depth, 0) AS INTEGER) AS depth, CAST(p.n_quotes AS INTEGER) AS n_quotes, coalesce(ss.sources, '') AS sources, p.mine AS text
      FROM p LEFT JOIN ss ON ss.rid = p.rid LEFT JOIN link ON link.conv_id = p.conv_id AND link.turn = p.turn
      LEFT JOIN top ON top.conv_id = p.conv_id AND top.turn = p.turn)
SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY root_turn NULLS FIRST, turn NULLS FIRST, role NULLS FIRST,
  parent_turn NULLS FIRST, depth, n_quotes, sources, text) AS position FROM o"""

_DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
o AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM o GROUP BY lang, term HAVING count(DISTINCT rid) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY lang, source, term),
gn AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n_all FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY g.lang, g.source),
ln AS (SELECT lang, count(*) AS v, sum(total) AS n_all FROM k GROUP BY lang),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (gn.n_all + 2 * ln.v) AS p,
        1 + (1000000000::HUGEINT * (k.total + 2)) // (ln.n_all + 2 * ln.v) AS q
      FROM gn JOIN ln USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
      UNION ALL SELECT * FROM (SELECT lang, source, 'term', item, value,
          row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM terms) WHERE rank <= 10)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r"""

ORACLE_SQL = {
    "op13_source_divergence": _DIVERGENCE_SQL,
    "op4_chat_formatting": _CHAT_SQL,
    "op5_quality_rules": _quality_sql(),
    "op10_minhash_near_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END AS gs FROM w),
s AS (SELECT DISTINCT doc_id, unnest(gs) AS h FROM g),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.v FROM r JOIN e ON e.u = r.b),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.b AS component_id, d.doc_id = m.b AS kept
FROM documents d JOIN m ON m.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id""",
}

#: Without SQL (trained models, tokenizers, byte windows, window fingerprints, linked quotations):
#: tests/llm holds these against brute force, libraries or held-out rows.
NO_SQL = tuple(n for n in QUERIES if n not in ORACLE_SQL)
