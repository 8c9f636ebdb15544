"""Quality rules: distribution divergence from language references (DataFrame functions only).

Of every text the base counts are taken, and two histograms: its characters by class and its
common words. References are the same histograms summed over all rows of a language; the
common words of a language are its `top` most frequent words of at most `short` characters. A
document is kept if its histograms are close to those of some language (smallest
Jensen-Shannon distance over the languages, base 2, 0 to 1). Each comparison has a
minimum-length guard: below it the histogram is too thin to speak against a document.

Plan: one pass over the texts writes the counts and the short words; references are two
aggregates over that table, pre-aggregated to a few rows per language before the shuffle;
the verdict is a projection. Texts are never shuffled, so no key can be hot. The references
that reach the driver are bounded by `top` words for each of at most `max_languages` languages.
Of more languages the references stay a table, which is crossed with the documents and leaves one
row of smallest distances for each document before the shuffle.

n_repeat_words compares 8-word windows by 64-bit hashes within one document.

Defined cases: null text has no words: all counts 0, base_failed. Rows without a language
count towards no reference. Without any reference nothing is rejected by the method. Repeated
rows count each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stage

_SPACE = " \t\n\x0b\f\r"
#: Characters that the contract counts as symbols (fixed value).
_SYMBOLS = "#*$%&|<>"
#: Character classes, most frequent first; what is left is the last class (beyond ASCII and controls).
CLASSES = {
    "consonant": "bcdfghjklmnpqrstvwxyz",
    "vowel": "aeiou",
    "space": _SPACE,
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "sentence": ".,;:!?'\"()-",
    "symbol": _SYMBOLS,
    "other symbol": "@^~`_+=/\\[]{}",
    "digit": "0123456789",
}
WINDOW = 8


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def _counts(docs: DataFrame, short: int) -> DataFrame:
    """doc_id, lang, the base counts, chars (array by class), short_words."""
    size = F.char_length
    base = docs.select("doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    df = base.select("*", words_of(F.col("text")).alias("words"), lines.alias("lines"))
    # each class is cut out of what the classes before it left
    df = df.withColumn("left0", F.col("text"))
    for i, chars in enumerate(CLASSES.values()):
        df = df.withColumn(f"left{i + 1}", F.translate(f"left{i}", chars, ""))
    n, names = len(CLASSES), list(CLASSES)
    chars = F.array(*[size(f"left{i}") - size(f"left{i + 1}") for i in range(n)], size(f"left{n}"))
    df = df.select(
        "doc_id", "lang", "words", F.size("words").cast("long").alias("n_words"), chars.alias("chars"),
        (size("left0") - chars[names.index("space")]).cast("long").alias("word_chars"),
        chars[names.index("symbol")].cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h1"))
    # hashes of runs of 1, 2, 4 and 8 words, each from two of the run before it
    for k in (1, 2, 4):
        later = F.slice(f"h{k}", k + 1, F.greatest(F.size("words") - k, F.lit(0)))
        df = df.withColumn(f"h{2 * k}", F.zip_with(f"h{k}", later, lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("h", F.slice(f"h{WINDOW}", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))))
    # only documents in which some window repeats are looked at more closely
    some = F.size(F.array_distinct("h")) < F.size("h")
    df = df.withColumn("s", F.when(some, F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    twice = F.transform("s", lambda x, k: F.when(
        ((k > 0) & (x.h == F.get("s", k - 1).h)) | (x.h == F.get("s", k + 1).h), x.i))
    df = df.withColumn("at", F.sort_array(F.filter(twice, lambda x: x.isNotNull())))
    # words covered by the windows at these positions: each adds what reaches beyond the last one's end
    covered = F.aggregate(
        "at", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a.n + F.least(F.lit(WINDOW), i + WINDOW - a.end)).alias("n")),
        lambda a: a.n)
    little = F.transform(F.filter("words", lambda w: F.char_length(w) <= short), lambda w: F.lower(w))
    return df.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                     F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), "chars", little.alias("short_words"))


def _references(counts: DataFrame, top: int, max_languages: int) -> dict[str, tuple[list[float], dict[str, float]]] | None:
    """Per language: shares of the character classes, and of its most frequent short words among all words;
    None for more than max_languages."""
    known = counts.where("lang is not null and n_words > 0")
    k = len(CLASSES) + 1
    sums = known.groupBy("lang").agg(F.sum("n_words").alias("n"), *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(k)])
    rows = sums.limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        return None
    total = {r.lang: r.n for r in rows}
    shares = {r.lang: [r[f"c{i}"] / max(1, sum(r[f"c{j}"] for j in range(k))) for i in range(k)] for r in rows}
    freq = (known.select("lang", F.explode("short_words").alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    words = {r.lang: {x.w: -x.n / total[r.lang] for x in r.best} for r in _bounded(freq, top).collect()} if total else {}
    return {lang: (shares[lang], words.get(lang, {})) for lang in sorted(total)}


def _reference_table(counts: DataFrame, top: int) -> DataFrame:
    """The references of any number of languages: (char_ref, words, word_ref), the last two null without a word."""
    known = counts.where("lang is not null and n_words > 0")
    k = len(CLASSES) + 1
    sums = known.groupBy("lang").agg(F.sum("n_words").alias("n"), F.array(*[F.sum(F.col("chars")[i]) for i in range(k)]).alias("c"))
    freq = (known.select("lang", F.explode("short_words").alias("w")).groupBy("lang", "w").agg(F.count(F.lit(1)).alias("n")))
    all_chars = F.greatest(F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x), F.lit(1))
    shares = F.transform("best", lambda b: -b.n / F.col("n"))
    rest = 1 - F.aggregate(shares, F.lit(0.0), lambda x, y: x + y)
    return sums.join(_bounded(freq, top), "lang", "left").select(
        F.transform("c", lambda x: x / all_chars).alias("char_ref"), F.transform("best", lambda b: b.w).alias("words"),
        F.concat(shares, F.array(rest)).alias("word_ref"))


def _nearest_of_many(counts: DataFrame, min_words: int, refs: DataFrame) -> DataFrame:
    """counts with char_distance and word_distance, the smallest over all rows of refs."""
    carried = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars"]
    df = (counts.select(*carried, "char_shares", "joined", F.monotonically_increasing_id().alias("row"))
          .crossJoin(refs))
    q = F.transform("words", lambda w: (F.char_length("joined") - F.char_length(F.replace(
        F.col("joined"), F.concat(F.lit(" "), w, F.lit(" ")), F.lit("")))) / (F.char_length(w) + 2) / F.col("n_words"))
    q = F.when((F.col("n_words") > 0) & (F.col("n_words") >= min_words), q)
    rest = F.greatest(1 - F.aggregate("q", F.lit(0.0), lambda x, y: x + y), F.lit(0.0))
    df = df.withColumn("q", q).withColumn("q", F.concat("q", F.array(rest)))
    return df.groupBy("row").agg(
        *[F.first(c).alias(c) for c in carried], F.min(_divergence(F.col("char_ref"), F.col("char_shares"))).alias("by_char"),
        F.min(F.when(F.col("words").isNotNull(), _divergence(F.col("word_ref"), F.col("q")))).alias("by_word"))


def _bounded(freq: DataFrame, top: int) -> DataFrame:
    """(lang, best): the `top` most frequent words of each language, by a rank that Spark computes with
    a group limit before its shuffle."""
    from pyspark.sql import Window
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "w"))
    return (freq.withColumn("rank", rank).where(F.col("rank") <= top)
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "w"))).alias("best")))


def _divergence(p: list[float] | Column, q: Column) -> Column:
    """Jensen-Shannon distance of fixed shares and a document's shares (an array; both sum to 1)."""
    def term(a: Column, b: Column) -> Column:
        m = (a + b) / 2
        return F.when(a > 0, a * F.log2(a / m)).otherwise(0.0) + F.when(b > 0, b * F.log2(b / m)).otherwise(0.0)
    total = F.aggregate(F.zip_with(p if isinstance(p, Column) else F.lit(p), q, term), F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def quality_rules(docs: DataFrame, *, top: int = 16, short: int = 4, max_languages: int = 64,
                  min_chars: int = 200, min_words: int = 50, max_char_distance: float = 0.32,
                  max_word_distance: float = 0.33, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance,
    word_distance (null where a guard applies or there is no reference) of every row.

    max_languages: up to this many languages are compared in one projection, more by a cross join.
    """
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    counts = stage(_counts(rows, short), "counts")
    refs = _references(counts, top, max_languages)
    # count of each common word: the words joined with spaces on both sides of each, and what is
    # left of that string without the word
    joined = F.concat(F.lit(" "), F.array_join("short_words", "  "), F.lit(" "))
    n_chars = F.aggregate("chars", F.lit(0), lambda a, x: a + x)
    df = counts.withColumn("joined", joined).withColumn("n_chars", n_chars)
    df = df.withColumn("char_shares", F.when(F.col("n_chars") > 0, F.transform("chars", lambda x: x / F.col("n_chars"))))
    if refs is None:
        df = _nearest_of_many(df, min_words, stage(_reference_table(counts, top), "references"))
        by_char, by_word = [F.col("by_char")], [F.col("by_word")]
    else:
        every = sorted({w for _, words in refs.values() for w in words})
        if every:
            df = df.withColumn("common", F.array(*[
                (F.char_length("joined") - F.char_length(F.replace("joined", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2) for w in every]))
        at = {w: i for i, w in enumerate(every)}
        by_char, by_word = [], []
        for p, words in refs.values():
            by_char.append(_divergence(p, F.col("char_shares")))
            if words:
                q = F.transform(F.lit([at[w] for w in words]), lambda i: F.get("common", i) / F.col("n_words"))
                rest = F.greatest(1 - F.aggregate(q, F.lit(0.0), lambda x, y: x + y), F.lit(0.0))
                by_word.append(_divergence([*words.values(), 1 - sum(words.values())], F.concat(q, F.array(rest))))

    def nearest(found: list[Column]) -> Column:
        return F.least(*found) if len(found) > 1 else found[0] if found else F.lit(None).cast("double")
    df = df.withColumn("char_distance", F.when(F.col("n_chars") >= min_chars, nearest(by_char)))
    df = df.withColumn("word_distance", F.when(F.col("n_words") >= min_words, nearest(by_word)))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    far = (F.coalesce("char_distance", F.lit(0.0)) > max_char_distance) | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), (~failed & ~far).alias("kept"), "char_distance", "word_distance")
