"""Find benchmark items in documents by fingerprints of item-sized windows.

A window has as many words as the item (the whole text, if that is shorter). Items and
windows are bags of word shingles; their SimHash fingerprints are compared
through a multi-index of Hamming blocks, and what lies within the radius is
verified by the exact similarity of the weighted bags, sum of the smaller over sum of
the larger counts.

1. Shingles of all documents meet the shingles of all items. A window that
   reaches the similarity holds enough of an item's shingles, and among windows with the same
   first shingle of the item the one that starts there holds the most, so
   windows start at such shingles (or end with the text) and nothing is lost.
2. Those windows get 64-bit fingerprints: the sign of each bit's sum over the bag.
3. With ``RADIUS + 1`` blocks, fingerprints within the radius are equal in one block at
   least, so an equi-join by (shape, block, value) finds all of them.
4. Candidates within the radius are verified exactly. Bags of similarity 0.8 differ
   in 10 of 64 bits on average; the radius of 24 is five standard deviations further out.

Only DataFrame functions are used. Defined results: null and empty texts hold no
item and an empty item is in no document; an item of fewer words than the shingle
width is one shingle of all its words; items with equal texts are found
each; rows of one ``doc_id`` (also null) are reported once, with their best
window, the first of equals; columns besides the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.session import stored

WIDTH = 5
THRESHOLD = (4, 5)
RADIUS = 24
BITS = 64
WORD = r"[\p{L}\p{N}]+"
BROADCAST_ROWS = 1_000_000  # a table up to this size, at 30 bytes a row at most, is sent to all executors


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once for all its uses, those inside other lambdas too."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shingles(words: Column, width: int) -> Column:
    """64-bit hashes of the runs of ``width`` words. ``words`` must be a bound value (see :func:`let`)."""
    last = F.size(words) - width
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))


def _shingled(text: Column, width: int) -> Column:
    """Struct of a text: n (words), version (hash of all words), shingles."""
    return let(_words(text), lambda w: F.struct(
        F.size(w).alias("n"), F.xxhash64(w).alias("version"), _shingles(w, width).alias("shingles")))


def _small(df: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its counted size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_bags(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Per item with words: item_id, width (of its shingles), size (shingles), bag (their hashes). Written once."""
    def bag(w: Column) -> Column:
        cases = F.struct(F.lit(width).alias("width"), _shingles(w, width).alias("bag"))
        for short in range(1, width):
            cases = F.when(F.size(w) == short, F.struct(F.lit(short).alias("width"), _shingles(w, short).alias("bag"))).otherwise(cases)
        return cases

    bags = items.select("item_id", let(_words(F.col("text")), bag).alias("b"))
    return stored(bags.select("item_id", "b.width", F.size("b.bag").alias("size"), "b.bag").where("size > 0"))


def fingerprint(bag: Column) -> Column:
    """SimHash: bit b is set if more than half of the bag's hashes have it."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(bag, F.lit(0).cast("long"), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(1).cast("long")))
        return F.when(ones * 2 > F.size(bag), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda f, b: f.bitwiseOR(bit(b)))


def _blocks(print_: Column, radius: int) -> Column:
    """Array of (block, value): the fingerprint cut into ``radius + 1`` runs of bits."""
    edges = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[
        F.struct(F.lit(i).alias("block"),
                 F.shiftrightunsigned(print_, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False))
    ])


def _window_starts(docs: DataFrame, bags: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, size, start) of windows that can be similar to an item with shingles of ``width`` words."""
    part, whole = threshold
    own = bags.where(F.col("width") == width)
    wanted = stored(own.select("item_id", "size", F.explode("bag").alias("shingle")).distinct())
    # The version tells rows of one id apart.
    texts = docs.select("doc_id", _shingled(F.col("text"), width).alias("t")).select("doc_id", "t.version", "t.n", "t.shingles")
    placed = texts.select("doc_id", "version", "n", F.posexplode("shingles").alias("at", "shingle"))
    hits = placed.join(_small(wanted), "shingle").groupBy("doc_id", "version", "n", "item_id", "size").agg(
        F.array_sort(F.collect_set("at")).alias("hits"))
    # Shingles of a window and of an item together: the smaller counts must reach this many.
    held = F.least(F.col("size"), F.col("n") - width + 1)
    hits = hits.withColumn("held", held).withColumn(
        "need", F.ceil((F.col("held") + F.col("size")) * part / F.lit(float(part + whole)) - 1e-9).cast("int"))
    hits = hits.where(F.size("hits") >= F.col("need")).withColumn("last", F.col("n") - width + 1 - F.col("held"))
    starts = F.filter("hits", lambda p, j: (p <= F.col("last")) & (F.get("hits", j + F.col("need") - 1) < p + F.col("held")))
    ending = F.when(F.get("hits", F.size("hits") - F.col("need")) >= F.col("last"), F.array("last")).otherwise(F.array().cast("array<int>"))
    return hits.select("doc_id", "version", "size", "held", F.explode(F.array_union(starts, ending)).alias("start")).distinct()


def _windows(docs: DataFrame, bags: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """(doc_id, width, size, start, bag, print) of those windows. Only documents that have some are read again."""
    starts = _window_starts(docs, bags, width, threshold)
    by_text = stored(starts.groupBy("doc_id", "version").agg(F.collect_list(F.struct("size", "held", "start")).alias("at")))
    ids = stored(by_text.select("doc_id").distinct())
    few = docs.select("doc_id", "text").join(_small(ids.select(F.col("doc_id").alias("_doc"))),
                                             F.col("doc_id").eqNullSafe(F.col("_doc")), "left_semi")
    few = few.select("doc_id", _shingled(F.col("text"), width).alias("t")).select("doc_id", "t.version", "t.shingles")
    few = few.dropDuplicates(["doc_id", "version"])
    found = by_text.select(F.col("doc_id").alias("_doc"), F.col("version").alias("_version"), "at")
    met = few.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("version") == F.col("_version")))
    cut = met.select("doc_id", "shingles", F.explode("at").alias("w")).select(
        "doc_id", F.lit(width).alias("width"), F.col("w.size").alias("size"), F.col("w.start").alias("start"),
        F.slice("shingles", F.col("w.start") + 1, F.col("w.held")).alias("bag"))
    cut = stored(cut.distinct())
    return cut.withColumn("print", fingerprint(F.col("bag")))


def similarity(bag: Column, item: Column) -> Column:
    """Sum of the smaller over sum of the larger counts of two bags."""
    times = lambda b, x: F.size(F.filter(b, lambda y: y == x))
    both = F.aggregate(F.array_distinct(item), F.lit(0), lambda n, x: n + F.least(times(item, x), times(bag, x)))
    return both / (F.size(bag) + F.size(item) - both)


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD,
          radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, start): items that a document holds, with the best window's first word."""
    part, whole = threshold
    bags = item_bags(items, width)
    widths = sorted(r.width for r in bags.select("width").distinct().collect())  # ``width`` values at most
    prints = stored(bags.withColumn("item_print", fingerprint(F.col("bag"))))
    found = None
    for w in widths:
        windows = stored(_windows(docs, bags, w, threshold))
        keyed = windows.select("doc_id", "size", "start", "print", F.inline(_blocks(F.col("print"), radius)))
        index = prints.where(F.col("width") == w).select("item_id", "size", "item_print", F.inline(_blocks(F.col("item_print"), radius)))
        near = keyed.join(index, ["size", "block", "value"]).where(
            F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= radius)
        near = near.select("doc_id", "size", "start", "item_id").distinct()
        named = near.select(F.col("doc_id").alias("_doc"), F.col("size").alias("_size"), F.col("start").alias("_start"), "item_id")
        sides = named.join(
            windows.select("doc_id", "size", "start", "bag"),
            F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_size") == F.col("size")) & (F.col("_start") == F.col("start")),
        ).select("doc_id", "item_id", "start", "bag")
        sides = sides.join(prints.where(F.col("width") == w).select("item_id", F.col("bag").alias("item")), "item_id")
        exact = sides.select("doc_id", "item_id", "start", similarity(F.col("bag"), F.col("item")).alias("similarity"))
        exact = exact.where(F.col("similarity") * whole >= part)
        found = exact if found is None else found.unionByName(exact)
    if found is None:
        found = docs.join(items.select("item_id"), F.lit(False)).select(
            "doc_id", "item_id", F.lit(0).alias("start"), F.lit(0.0).alias("similarity"))
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("similarity"), (-F.col("start")).alias("back"))).alias("best"))
    return best.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).alias("start"))


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    found = leaks(docs, items).select(F.col("doc_id").alias("_doc")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["_doc"]), "left_anti")
