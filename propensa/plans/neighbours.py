"""Nearest neighbours of a set of queries among all rows, exact, without comparing every pair.

Two equi-joins find them. Rows that share a bucket of random projections with a query give a radius that is sure to
hold ``k`` rows. Then one projection is cut into bins: a row within the radius differs by no more than the radius in the
projection too, so the query meets the bins that the radius reaches, and exact distances decide. The buckets only make the
radius small; a poor one costs time, never a neighbour.

A bucket or bin with many rows is dealt in parts by a hash of the row, and its queries meet every part, so a value
that a third of the rows share is never one task. Each part keeps ``k`` rows a query before anything is shuffled.

Equal rows are at equal distances, so of those with the same values only the ``k + 1`` smallest keys are met (one may be
the query itself), and queries with the same values ask once. What is met grows with the number of different values.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import stored

TABLES, PROJECTIONS = 4, 3
MOST_PROBES = 200  # bins of the projection that the largest radius reaches to one side
PART_ROWS = 100_000  # rows of a bucket or bin that meet its queries in one task
SEED = 17


def _dot(x: Column, direction: np.ndarray) -> Column:
    return F.aggregate(F.zip_with(x, F.lit(direction), lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)


def _distance(a: Column, b: Column) -> Column:
    """Squared distance."""
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda total, v: total + v)


def _met(queries: DataFrame, rows: DataFrame, part_rows: int) -> DataFrame:
    """Queries (query, qx, cell, ...) beside the rows (key, x, cell) of their cells, large cells in parts."""
    counts = rows.groupBy("cell").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    large = counts.filter("parts > 1")
    parts = F.coalesce("parts", F.lit(1))
    dealt = rows.join(large, "cell", "left").select("key", "x", "cell", F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"))
    spread = queries.join(large, "cell", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return spread.join(dealt, ["cell", "part"])


def _closest(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest rows of each query; of equal distances, the smallest keys."""
    order = Window.partitionBy("query").orderBy("distance", "key")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _smallest(rows: DataFrame, k: int) -> DataFrame:
    """Of the rows with the same values, those of the ``k`` smallest keys. Tasks leave out the others before the shuffle."""
    order = Window.partitionBy("x").orderBy("key")
    return rows.withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= k)


def _bucketed(rows: DataFrame, x: str, width: float, dimensions: int) -> DataFrame:
    """One row per table with the bucket of its projections."""
    random = np.random.default_rng(SEED)
    cells = []
    for table in range(TABLES):
        places = [F.floor((_dot(F.col(x), random.normal(size=dimensions)) + float(random.uniform(0, width))) / width) for _ in range(PROJECTIONS)]
        cells.append(F.xxhash64(F.lit(table), *places))
    return rows.withColumn("cell", F.explode(F.array_distinct(F.array(*cells))))


def radius(queries: DataFrame, rows: DataFrame, k: int, width: float, dimensions: int, part_rows: int = PART_ROWS) -> DataFrame:
    """(query, qx, reach): a squared distance within which rows of at least ``k`` keys lie, if there are as many.

    It is 0 where so many rows have the query's values. Else it comes from the query's buckets, or from the rows of the
    smallest keys where these give too few.
    """
    full = rows.filter(F.col("nth") == k).select(F.col("x").alias("qx")).distinct().withColumn("full", F.lit(True))
    known = stored(queries.join(full, "qx", "left"))
    open_ = known.filter("full is null").select("query", "qx")
    pairs = _met(_bucketed(open_, "qx", width, dimensions), _bucketed(rows, "x", width, dimensions), part_rows)
    near = pairs.groupBy("query", "key").agg(F.min(_distance(F.col("qx"), F.col("x"))).alias("distance"))
    found = _closest(near, k).groupBy("query").agg(F.count("*").alias("n"), F.max("distance").alias("held")).filter(F.col("n") == k)
    first = rows.groupBy("key").agg(F.first("x").alias("x")).orderBy("key").limit(k)  # a few rows for all queries
    anchors = first.agg(F.collect_list("x").alias("rows"))
    fixed = open_.select("query", "qx", anchors.scalar().alias("anchors"))
    far = F.array_max(F.transform("anchors", lambda a: _distance(F.col("qx"), a)))
    reached = fixed.withColumn("far", far).join(found, "query", "left").select("query", "qx", F.coalesce(F.least("held", "far"), F.lit(0.0)).alias("reach"))
    return reached.unionByName(known.filter("full").select("query", "qx", F.lit(0.0).alias("reach")))


def nearest(
    table: DataFrame, queries: DataFrame, k: int, key: str = "mailchimp_id", width: float = 2.0, part_rows: int = PART_ROWS
) -> DataFrame:
    """(query, key, rank, distance) of the ``k`` nearest other rows of each query, squared distances.

    ``table`` and ``queries`` hold a unique key and the values ``x`` (equally long, none null; rows with a null are not met).
    ``width`` is that of a bucket, in the units of the values.
    """
    def whole(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).alias("key"), "x").filter(F.col("key").isNotNull() & F.forall("x", lambda v: v.isNotNull()))

    rows = stored(_smallest(whole(table), k + 1))
    first = rows.select(F.size("x").alias("d")).first()
    dimensions = first["d"] if first else 0
    asked = whole(queries).select(F.col("key").alias("query"), F.col("x").alias("qx"))
    values = stored(asked.select("qx").distinct().withColumn("query", F.monotonically_increasing_id()))
    reaching = stored(radius(values, rows, k + 1, width, dimensions, part_rows))
    span = reaching.agg(F.percentile_approx(F.sqrt("reach"), 0.5).alias("typical"), F.sqrt(F.max("reach")).alias("largest")).first()
    bin_width = max(float(span["typical"] or 0.0), float(span["largest"] or 0.0) / MOST_PROBES, 1e-6)
    direction = np.random.default_rng(SEED + 1).normal(size=dimensions)
    direction = direction / max(float(np.linalg.norm(direction)), 1e-300)
    place = lambda c: F.floor(c / bin_width)
    binned = rows.select("key", "x", place(_dot(F.col("x"), direction)).alias("cell"))
    # A little more than the radius, for the last digits of sums.
    slack = F.sqrt("reach") * (1 + 1e-9) + 1e-9
    on = _dot(F.col("qx"), direction)
    probes = reaching.withColumn("cell", F.explode(F.sequence(place(on - slack), place(on + slack))))
    pairs = _met(probes, binned, part_rows).withColumn("distance", _distance(F.col("qx"), F.col("x")))
    order = Window.partitionBy("query").orderBy("distance", "key")
    met = pairs.filter(F.col("distance") <= F.col("reach")).select("query", "qx", "key", "distance")
    shared = met.withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= k + 1).select("qx", "key", "distance")
    return _closest(asked.join(shared, "qx").filter(F.col("query") != F.col("key")).select("query", "key", "distance"), k)


def neighbour_scores(found: DataFrame, labels: DataFrame, key: str = "mailchimp_id") -> DataFrame:
    """(query, score): the share of class 1 among a query's neighbours."""
    named = labels.select(F.col(key).alias("key"), "label")
    return found.join(named, "key").groupBy("query").agg(F.avg("label").alias("score"))
