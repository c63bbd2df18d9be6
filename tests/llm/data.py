"""Small documents with every odd case, and plain versions to compare with."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use inside or add to their results.
CLASHES = ["size", "score", "lang_pred", "start", "target", "position", "before", "words", "bag", "x", "n", "rep", "shingles",
           "version", "component_id", "_doc", "at", "toxic", "draw"]
SYLLABLES = "the and tion er on re in ha he st nd ly ble ea ing ou".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]
    return "\n".join(" ".join(words[i:i + 12]) for i in range(0, n, 12))


def changed(text: str, seed: int, n: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = f"neu{seed}x{i}"
    return " ".join(words)


def odd_rows() -> list[tuple]:
    base, long = prose(1, 300), prose(2, 40_000)
    rows = [
        (None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", None, None), (3, "one", "en", "a", 3),
        (4, long, "en", "b", len(long)), (5, base, "en", "a", 1), (5, base, "en", "a", 1), (6, changed(base, 6, 2), "de", None, 1),
        (7, base.upper(), None, "b", 1), (8, base + " x", "en", "é", 1), (9, " \t\n 12 !?  ", "en", "a", 1),
        (10, "two  words\tand\r\nmore\n\nlines   here", "fr", "", 1), (11, "a b c d e", "en", "a", 1), (12, "a b c d", "en", "a", 1),
        (13, "A b C d", "en", "a", 1), (14, "<s>[INST] \U0001f600 </s> \0 <|endoftext|>", "en", "a", 1), (None, base, "en", "a", 1),
    ]
    return rows + [(100 + i, prose(100 + i, 60 + i), ("en", "de")[i % 2], ("a", "b", "c")[i % 3], 1) for i in range(20)]


def frame(spark, rows, columns: str = COLUMNS, clashes: bool = False):
    df = spark.createDataFrame(rows, columns)
    if clashes:
        from pyspark.sql import functions as F

        for name in CLASHES:
            if name not in df.columns:
                df = df.withColumn(name, F.lit("odd"))
    return df
