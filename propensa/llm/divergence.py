"""Quality rules: how far a document's histograms are from those of its language.

Two histograms of a document are compared with the same histograms of all
documents of its language: shares of character classes, and shares of the language's
most common words. The distance is Jensen-Shannon's (base 2, from 0 to 1). A
document is judged by a histogram only if it and its language have enough text.

Only DataFrame functions are used. A document is never taken apart: its words,
windows and histograms are arrays in its row, bound once, and repeated windows
are found by sorting, so a very long text costs n log n. The text is read twice: once
for the counts of words by language, once for all that a row is judged by, which is written as a few numbers. The
references of the character classes are sums over those.

Defined results: a null text is an empty text; rows without a language are a
language of their own; a text under 50 words fails the base rules; ties of common
words go to the first by code point; repeated rows get equal results; columns of the input
besides ``doc_id``, ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import stored

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
NO_SYMBOLS = r"[^#*$%&|<>]+"
LETTERS, NO_UPPER = r"\p{L}+", r"\P{Lu}+"
# Classes that are no letters, by what is left when all others are removed; the rest of the text is a class too.
OTHERS = {"digit": r"\P{N}+", "punctuation": r"\P{P}+", "space": WORD, "symbol": NO_SYMBOLS}
CLASSES = 6
END_MARKS = ".,;:!?"  # of a word
COMMON_WORDS = 24
LEAST_WORDS = 50  # a shorter text fails
LEAST_HISTOGRAM_WORDS = 100  # fewer words say nothing about common words
LEAST_REFERENCE_WORDS = 20_000  # a language with less text is no reference
MOST_CLASS_DISTANCE = 0.27
MOST_WORD_DISTANCE = 0.45


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for all its uses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _only(text: Column, others: str) -> Column:
    """Number of characters left when all runs of ``others`` are removed."""
    return F.length(F.regexp_replace(text, others, ""))


def class_counts(text: Column) -> Column:
    """Array of counts: upper-case letters, other letters, digits, punctuation, white space, the rest, and symbols.

    Two passes read the whole text; letters are most of it, and the other classes are counted on what stands between them.
    """
    def counted(rest: Column) -> Column:
        sizes = F.array(F.length(text), _only(text, NO_UPPER), F.length(rest), *[_only(rest, pattern) for pattern in OTHERS.values()])
        return bound(sizes, lambda c: F.array(
            F.get(c, F.lit(1)), F.get(c, F.lit(0)) - F.get(c, F.lit(2)) - F.get(c, F.lit(1)), F.get(c, F.lit(3)), F.get(c, F.lit(4)),
            F.get(c, F.lit(5)), F.get(c, F.lit(2)) - F.get(c, F.lit(3)) - F.get(c, F.lit(4)) - F.get(c, F.lit(5)), F.get(c, F.lit(6))))

    return bound(F.regexp_replace(text, LETTERS, ""), counted)


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def repeated_words(words: Column) -> Column:
    """Number of words in 3-word windows that stand twice or more in the array."""
    hashes = F.transform(_indices(F.size(words) - 2), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(3)]))

    def covered(windows: Column) -> Column:
        def places(order: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(order, i)["x"] == F.get(order, j)["x"], F.lit(False))
            twice = F.filter(_indices(F.size(order)), lambda i: same(i, i - 1) | same(i, i + 1))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda i: F.transform(
                F.array(*map(F.lit, range(3))), lambda j: F.get(order, i)["i"] + j)))))

        order = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bound(order, places))

    return bound(hashes, covered)


def duplicate_lines(text: Column) -> Column:
    """Number of lines with a word that equal an earlier line."""
    worded = F.filter(F.split(text, r"\n"), lambda line: line.rlike(WORD))
    return bound(worded, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


def words_of(text: Column) -> Column:
    """Array of a text's words."""
    return bound(F.btrim(text, F.lit(SPACES)), lambda t: F.when(t != "", F.split(t, r"[ \t-\r]+")).otherwise(F.array().cast("array<string>")))


def plain(word: Column) -> Column:
    """A word as it is counted: lower case, without marks at the end; a word of marks only becomes empty."""
    return F.lower(F.rtrim(word, F.lit(END_MARKS)))


def _shares(counts: Column) -> Column:
    """Counts over their sum."""
    def divided(n: Column) -> Column:
        total = F.aggregate(n, F.lit(0).cast("double"), lambda t, c: t + c)
        return bound(total, lambda t: F.transform(n, lambda c: F.when(t > 0, c / t).otherwise(F.lit(0.0))))

    return bound(counts, divided)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda n, t: n + t)))


def _text(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"))


def common_words(docs: DataFrame) -> DataFrame:
    """Per language: n_words, words (the most common), word_shares (of them, and of all others). Written once."""
    words = _text(docs).select("lang", F.explode(words_of(F.col("text"))).alias("word"))
    counts = stored(words.groupBy("lang", plain(F.col("word")).alias("word")).agg(F.count("*").alias("n")))
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n_words"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = counts.where("word != ''").withColumn("rank", rank).where(F.col("rank") <= COMMON_WORDS)
    top = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "n"))).alias("top"))
    some = F.aggregate("top", F.lit(0).cast("long"), lambda n, t: n + t["n"])
    return stored(totals.join(top, "lang").select(
        "lang", "n_words", F.transform("top", lambda t: t["word"]).alias("words"),
        _shares(F.concat(F.transform("top", lambda t: t["n"]), F.array(F.col("n_words") - some))).alias("word_shares")))


def class_references(measured: DataFrame) -> DataFrame:
    """Per language: class_shares over all its rows."""
    sums = measured.groupBy("lang").agg(*[F.sum(F.get("classes", F.lit(i))).alias(f"n{i}") for i in range(CLASSES)])
    return sums.select("lang", _shares(F.array(*[f"n{i}" for i in range(CLASSES)])).alias("class_shares"))


def measure(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, the counts of the base rules, classes (their counts), and word_distance to the common words
    of the language (null where there is too little text). Written once: later steps need no text."""
    text = F.col("text")

    def word_counts(words: Column) -> Column:
        top = F.col("words")
        hits = F.filter(F.transform(words, plain), lambda w: F.array_contains(top, w))
        counts = bound(hits, lambda h: F.transform(top, lambda t: F.size(F.filter(h, lambda w: w == t))))
        return bound(counts, lambda c: F.concat(c, F.array(F.size(words) - F.aggregate(c, F.lit(0), lambda n, x: n + x))))

    def of_words(words: Column) -> Column:
        judged = F.col("words").isNotNull() & (F.size(words) >= LEAST_HISTOGRAM_WORDS)
        return F.struct(
            F.size(words).cast("long").alias("n_words"), repeated_words(words).cast("long").alias("n_repeat_words"),
            F.when(judged, distance(_shares(word_counts(words)), F.col("word_shares"))).alias("word_distance"))

    rows = _text(docs).join(known, "lang", "left").select(
        "doc_id", "lang", F.length(text).alias("n"), bound(words_of(text), of_words).alias("m"), class_counts(text).alias("c"),
        duplicate_lines(text).cast("long").alias("n_dup_lines"))
    return stored(rows.select(
        "doc_id", "lang", "m.*", (F.col("n") - F.get("c", F.lit(4))).cast("long").alias("word_chars"),
        F.get("c", F.lit(CLASSES)).cast("long").alias("n_symbols"), "n_dup_lines", F.slice("c", 1, CLASSES).alias("classes")))


def judge(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    class_distance, word_distance (null where too little text), kept."""
    known = common_words(docs).where(F.col("n_words") >= LEAST_REFERENCE_WORDS).drop("n_words")
    measured = measure(docs, known)
    # Written, so that its size is known: a small table is then sent to all tasks and no language is one task.
    classes = stored(class_references(measured).join(known.select("lang"), "lang"))
    rows = measured.join(classes, "lang", "left").withColumn(
        "class_distance", F.when(F.col("class_shares").isNotNull(), distance(_shares(F.col("classes")), F.col("class_shares"))))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= MOST_CLASS_DISTANCE) & (
        F.coalesce("word_distance", F.lit(0.0)) <= MOST_WORD_DISTANCE)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), "class_distance", "word_distance", (~failed & near).alias("kept"))
