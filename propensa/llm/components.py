"""Connected components of a table of links, as Spark jobs.

Large and small star steps: every node links its larger, then its smaller
neighbours to its least neighbour, until nothing changes. Each step is one
aggregate and one join by node; its links are written to the shared folder, so
lineage stays short and a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensa.session import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    every = _both_ways(links)
    least = every.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return every.where("b > a").join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    others = down.join(least, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, int(row.s or 0)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it reaches."""
    links = stored(links.where("a != b").select("a", "b").distinct())
    before = None
    while (now := _state(links)) != before and now[0]:
        before = now
        links = stored(_small_star(stored(_large_star(links))))
    heads = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stored(links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads))
