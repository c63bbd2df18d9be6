"""Mix sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule, the linear course of its share from
``start`` at training time 0 to ``end`` at time 1 with mean 1. The integral of
weight times schedule gives the source's target; its documents, in a seeded
order, fill that demand pass after pass. A document is placed where the
integrated demand of its source reaches the middle of the document, so the
position solves ``start * t + (end - start) * t^2 / 2 = share of the target``.

Only DataFrame functions are used. Running sums inside a source are summed per
hash bucket first, so a source with a third of all rows is spread over as many
tasks as there are buckets; the rows are never gathered by source.

Defined results: a null text has size 0; a null source is a source of its own,
last in the order; a document of size 0 is never taken; an empty table gives an
empty result; repeated rows are documents of their own, ordered by id, then size,
then text; copies at one position are ordered by id and source. Columns of the input keep their names; the added ones are
listed in ``ADDED`` and ``_TRAINED`` and replace columns of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.operators.running import Running, running_totals
from propensa.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
# (start, end) of the sources with the weights above: steady, rising, falling.
SCHEDULES = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))
SHARE, REPEATS = 1.5, 2
ADDED = ["size", "source_size", "weight", "start", "end", "target", "before", "passes", "extra", "taken", "position"]
_TRAINED = ["taken", "first_position", "last_position", "first_word"]
_OWN = ["_source", "_hash", "_bucket"]


def words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _bits(df: DataFrame) -> int:
    """Bits of the hash that number a source's buckets: some buckets for each shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(31, (16 * partitions - 1).bit_length())


def sized(docs: DataFrame, size: Column | None = None) -> DataFrame:
    """``docs`` with the size, a source key that is never null, and the place in the seeded order."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    docs = docs.drop(*ADDED, *_TRAINED, *_OWN)
    return (
        docs.withColumn("size", words(F.col("text")) if size is None else size)
        .withColumn("_source", F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source"))))
        .withColumn("_hash", order)
        .withColumn("_bucket", F.shiftrightunsigned(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("long"), 32 - _bits(docs)))
    )


def cell_sizes(rows: DataFrame) -> DataFrame:
    """Words of each (source, bucket) and the words of the source before it, written once."""
    cells = rows.groupBy("_source", "_bucket").agg(F.sum("size").alias("_words"))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return stored(cells.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0).cast("long"))))


def source_targets(cells: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   schedules: tuple[tuple[float, float], ...] = SCHEDULES,
                   share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """One row per source: its size, weight, schedule and target.

    Sources in code point order, null last, take the weights in turn. A target
    stops at ``repeats`` times the size, and what is over goes to the others by
    weight. With sources sorted by size over weight, the sources that stop are
    the first ones, so one running sum finds the level of the rest. The windows
    run over one row per source.
    """
    totals = cells.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    named = Window.orderBy(F.col("_source") == "", "_source")
    turn = (F.row_number().over(named) - 1) % len(weights)
    pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_turn") + 1)
    rows = totals.withColumn("_turn", turn.cast("int")).select(
        "_source", "source_size", pick(weights).alias("weight"),
        pick([s for s, _ in schedules]).alias("start"), pick([e for _, e in schedules]).alias("end"),
    )
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "_source")
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stopped = F.coalesce(F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = (F.sum("source_size").over(everything) * F.lit(share) - stopped * F.lit(repeats)) / F.sum("weight").over(
        fill.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", level)
    rows = rows.withColumn("_open", F.when(F.col("_level") * F.col("weight") <= F.col("source_size") * repeats, F.col("_level")))
    rows = rows.withColumn("_level", F.first("_open", ignorenulls=True).over(everything))
    cap = F.col("source_size").cast("double") * repeats
    target = F.least(cap, F.coalesce(F.col("_level") * F.col("weight"), cap))
    return stored(rows.select("_source", "source_size", "weight", "start", "end", target.alias("target")))


def assign(rows: DataFrame, **shares) -> DataFrame:
    """``rows`` of :func:`sized` with what the mix takes of each document.

    ``before`` is the words of the source before the document in the seeded order, ``passes`` the
    number of whole passes over the source, ``extra`` whether the last, partial
    pass takes the document too (its middle lies before the end of the pass).
    """
    cells = cell_sizes(rows)
    sources = source_targets(cells, **shares)
    ties = [c for c in ("text",) if c in rows.columns]
    inside = Window.partitionBy("_source", "_bucket").orderBy("_hash", "doc_id", "size", *ties).rowsBetween(
        Window.unboundedPreceding, -1)
    placed = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(cells.select("_source", "_bucket", "_before"), ["_source", "_bucket"])
    placed = placed.withColumn("before", F.col("before") + F.col("_before")).drop("_before").join(sources, "_source")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    return placed.withColumn("passes", passes).withColumn(
        "extra", (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= rest))


def taken(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`assign` with the words that the mix takes of each document, by its shares alone."""
    return rows.withColumn("taken", F.col("size") * (F.col("passes") + F.col("extra").cast("long")))


def curriculum(rows: DataFrame) -> DataFrame:
    """One row per taken copy of :func:`assign`, range-sorted by its training position from 0 to 1."""
    copies = F.col("passes") + F.col("extra").cast("long")
    every = rows.where((F.col("size") > 0) & (copies > 0)).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    middle = F.col("before") + F.col("_copy") * F.col("source_size") + F.col("size") / 2
    share = F.least(F.lit(1.0), middle / F.col("target"))
    slope = F.col("end") - F.col("start")
    at = F.when(slope == 0, share / F.col("start")).otherwise(
        (F.sqrt(F.col("start") * F.col("start") + 2 * slope * share) - F.col("start")) / slope)
    return every.withColumn("position", at).repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def trained(rows: DataFrame) -> DataFrame:
    """``rows`` of :func:`assign` with what the curriculum's copies make of each document.

    ``taken`` is the words of its copies, ``first_position`` and ``last_position`` their least and greatest
    position, ``first_word`` the words of the whole training stream before the first one; a document
    without a copy has 0 and nulls. Copies are numbered in ranges of the position. Within a source, ``before``
    tells documents that have a word apart.
    """
    rows = stored(rows.drop(*_TRAINED, "_ends", "_from", "_at"))
    copies = curriculum(rows).select("position", "doc_id", "_source", "before", "size")
    numbered = running_totals(copies, ["position", "doc_id", "_source", "before"], Running(sums={"_ends": "size"}))
    placed = numbered.groupBy(F.col("_source").alias("_from"), F.col("before").alias("_at")).agg(
        F.sum("size").alias("taken"), F.min("position").alias("first_position"), F.max("position").alias("last_position"),
        F.min(F.col("_ends") - F.col("size")).alias("first_word"))
    same = (F.col("_source") == F.col("_from")) & (F.when(F.col("size") > 0, F.col("before")) == F.col("_at"))
    met = rows.join(placed, same, "left").drop("_from", "_at")
    return met.withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))
