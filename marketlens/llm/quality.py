"""Quality rules: base counts per document, and its distance from the usual text of its language.

The distance is the Jensen-Shannon distance (base 2, 0 to 1) of two histograms, character classes and common words, from
the mean histograms of all documents of the language. All work is column expressions within one row; the language
references are a small table that is learned first.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm.words import BLANKS, words

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
COMMON_WORDS = 24
LEAST_DOCS = 20  # documents of languages with fewer are not judged by the histograms, whatever else is in the corpus
JUDGED_CHARS = 200
JUDGED_WORDS = 60
MAX_CLASS_DISTANCE = 0.25  # and CLASS_SLACK over the square root of the characters, for chance in short texts
CLASS_SLACK = 1.0
MAX_WORD_DISTANCE = 0.45
SYMBOLS = "#*$%&|<>"
_CLASSES = ("abcdefghijklmnopqrstuvwxyz", BLANKS, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".,;:!?'\"()-", SYMBOLS,
            "@^~`_+={}[]/\\")


def _each(column: Column, fn) -> Column:
    """``fn`` of a column that is worked out once and then used several times within array functions."""
    return F.transform(F.array(column), fn)[0]


def duplicate_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _each(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(word_list: Column, n: int = 5) -> Column:
    """Number of words inside windows of ``n`` words that occur twice or more, all occurrences counted."""
    def windows(h: Column) -> Column:
        """Hashes of all windows, each made at once from those of its words."""
        return F.slice(F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)])),
                       F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0)))

    def covered(win: Column) -> Column:
        places = _each(F.sort_array(F.transform(win, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), lambda s: F.filter(
            s, lambda e, k: F.coalesce(F.get(s, k - 1)["x"] == e["x"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["x"] == e["x"], F.lit(False))))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
        return F.aggregate(F.sort_array(F.transform(places, lambda e: e["i"])), start, lambda a, p: F.struct(
            (a["n"] + p + n - F.greatest(p, a["upto"])).alias("n"), (p + n).alias("upto")), lambda a: a["n"])

    def count(win: Column) -> Column:
        return F.when(F.size(F.array_distinct(win)) < F.size(win), covered(win)).otherwise(0)

    hashes = F.transform(word_list, lambda x: F.xxhash64(x))
    found = _each(hashes, lambda h: _each(windows(h), count))
    return F.when(F.size(word_list) >= n, found).otherwise(0).cast("long")


def with_classes(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``classes``, the counts of the character classes of a text: a-z, blanks, A-Z, digits, punctuation, the base
    rules' symbols, other symbols, all else. The largest class goes first, so that the rest is short."""
    left, columns = text, []
    for k, chars in enumerate(_CLASSES):
        df = df.withColumn(f"__rest{k}", F.translate(left, chars, ""))
        columns.append(F.length(left) - F.length(f"__rest{k}"))
        left = f"__rest{k}"
    return df.withColumn("classes", F.array(*columns, F.length(left))).drop(*[f"__rest{k}" for k in range(len(_CLASSES))])


def _shares(classes: str = "classes") -> Column:
    return _each(F.col(classes), lambda c: F.transform(
        c, lambda x: x / F.greatest(F.aggregate(c, F.lit(0), lambda s, y: s + y), F.lit(1))))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2, F.lit(0.0)))


def references(measured: DataFrame) -> DataFrame:
    """One row per language of at least ``LEAST_DOCS`` documents: class shares, common words, and the shares of these words
    (and of all others) in a document's words; means over the documents.

    ``measured`` has columns lang (not null), word_chars, classes, lowered (the text in lower case); documents without words
    are left out. Each pass works out only what it needs: the classes need no words, the words are split once.
    """
    spark = measured.sparkSession
    path = session.scratch(spark, "quality")
    n = len(_CLASSES) + 1
    # a condition inside the sums: as a filter it would be pushed below the classes and work them out twice
    own = lambda x: F.when(F.col("has_words"), x)
    (measured.select("lang", (F.col("word_chars") > 0).alias("has_words"), _shares().alias("shares")).groupBy("lang")
     .agg(F.count(own(F.lit(1))).alias("n"), *[F.sum(own(F.get("shares", F.lit(k)))).alias(f"s{k}") for k in range(n)])
     .where(F.col("n") >= LEAST_DOCS).write.parquet(os.path.join(path, "classes")))
    classes = spark.read.parquet(os.path.join(path, "classes"))
    common = (measured.select("lang", words("lowered").alias("words"))
              .select("lang", (1 / F.greatest(F.size("words"), F.lit(1))).alias("share"), F.explode("words").alias("word"))
              .groupBy("lang", "word").agg(F.sum("share").alias("share")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "word"))
    top = (common.withColumn("k", rank).where(F.col("k") <= COMMON_WORDS).groupBy("lang")
           .agg(F.sort_array(F.collect_list(F.struct("k", "word", "share"))).alias("top")))
    shares = F.array(*[F.col(f"s{k}") / F.col("n") for k in range(n)])
    return (classes.join(top, "lang").select(
        "lang", shares.alias("class_shares"), F.transform("top", lambda t: t["word"]).alias("common"),
        F.transform("top", lambda t: t["share"] / F.col("n")).alias("word_shares"))
        .withColumn("word_shares", F.expr(
            "concat(word_shares, array(greatest(0D, 1D - aggregate(word_shares, 0D, (s, x) -> s + x))))")))


def measure(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """The base counts per row, with lang, n_chars, classes and the lower-cased text for the histograms."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = with_classes(rows.withColumn("words", words("text")))
    n_chars = F.length("text")
    return rows.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "lang", n_chars.alias("n_chars"), F.size("words").cast("long").alias("n_words"),
        (n_chars - F.get("classes", F.lit(1))).cast("long").alias("word_chars"),
        F.get("classes", F.lit(5)).cast("long").alias("n_symbols"), duplicate_lines(F.col("text")).alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"), "classes", F.lower("text").alias("lowered"))


def word_counts(lowered: Column, wanted: Column, n: int = COMMON_WORDS) -> Column:
    """How often each of at most ``n`` wanted words occurs in a text, as array.

    Every word gets a blank of its own on either side; what the text loses when a word with its blanks is taken out tells how often
    it was there. That compares bytes in one run over the text per word, without a call per word of the text.
    """
    text = lowered
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    text = F.concat(F.lit(" "), F.replace(text, F.lit(" "), F.lit("  ")), F.lit(" "))

    def counts(spaced: Column) -> Column:
        def count(k: int) -> Column:
            word = F.concat(F.lit(" "), F.get(wanted, F.lit(k)), F.lit(" "))
            lost = F.octet_length(spaced) - F.octet_length(F.replace(spaced, word, F.lit("")))
            return (lost / F.octet_length(word)).cast("long")
        return F.slice(F.array(*[count(k) for k in range(n)]), F.lit(1), F.size(wanted))
    return _each(text, counts)


def assess(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept, class_distance, word_distance.

    Rejected are documents that fail the base rules and documents whose class or word histogram is too far from that of
    their language, if it has ``LEAST_DOCS`` documents. Texts of fewer than ``JUDGED_CHARS`` characters or ``JUDGED_WORDS``
    words are not judged by the respective histogram. Null and empty texts have no words and fail the base. A null language is one of its own.
    Repeated rows are assessed alike; other columns are left out; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = session.scratch(spark, "quality")
    measured = measure(docs, doc_id, text, lang)  # twice over the texts: their words are too many to keep
    references(measured).write.parquet(os.path.join(path, "references"))
    known = spark.read.parquet(os.path.join(path, "references"))
    own = known.select("lang", F.struct("class_shares", "common", "word_shares").alias("ref"))
    rows = measured.join(own, "lang", "left")
    counts = _each(word_counts(F.col("lowered"), F.col("ref.common")), lambda c: F.transform(
        c, lambda x: x / F.greatest(F.col("n_words"), F.lit(1))))
    shares = _each(counts, lambda c: F.concat(
        c, F.array(F.greatest(F.lit(0.0), F.lit(1.0) - F.aggregate(c, F.lit(0.0), lambda s, x: s + x)))))
    judged = F.col("ref").isNotNull()
    rows = rows.withColumns({
        "class_distance": F.when(judged & (F.col("n_chars") >= JUDGED_CHARS), distance(_shares(), F.col("ref.class_shares"))),
        "word_distance": F.when(judged & (F.col("n_words") >= JUDGED_WORDS), distance(shares, F.col("ref.word_shares")))})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    limit = MAX_CLASS_DISTANCE + CLASS_SLACK / F.sqrt(F.greatest("n_chars", F.lit(1)))
    usual = (F.coalesce(F.col("class_distance") <= limit, F.lit(True))
             & F.coalesce(F.col("word_distance") <= MAX_WORD_DISTANCE, F.lit(True)))
    return (rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & usual)
            .select("doc_id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    "kept", "class_distance", "word_distance"))


def keep(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """All columns of the documents that :func:`assess` keeps; the rejected ones, told by id and text, are taken out."""
    bad = (assess(docs, doc_id=doc_id, text=text, lang=lang).where(~F.col("kept"))
           .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct())
    hashed = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    return docs.join(bad, docs[doc_id].eqNullSafe(bad["__id"]) & (hashed == bad["__hash"]), "left_anti")
