"""Long tag rows to one wide 0/1 row per subscriber."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.functions.names import tag_columns
from propensa.operators.joins import look_up
from propensa.operators.running import Running, running_totals

MAX_TAGS_CONF = "spark.sql.pivotMaxValues"


def tag_vocabulary(tags: DataFrame) -> list[str]:
    """Distinct tags in sorted order; more than the pivot limit of the session is an error."""
    limit = int(tags.sparkSession.conf.get(MAX_TAGS_CONF, "10000"))
    rows = tags.select("tag").filter(F.col("tag").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct tags: raise {MAX_TAGS_CONF} or group the tags first")
    return sorted(r["tag"] for r in rows)


def save_vocabulary(spark: SparkSession, vocabulary: list[str], path: str) -> None:
    """Keep the fitted tags, so that later tables get the same columns."""
    rows = [(tag, name) for tag, name in tag_columns(vocabulary, []).items()]
    spark.createDataFrame(rows, "tag string, column_name string").write.mode("overwrite").parquet(path)


def load_vocabulary(spark: SparkSession, path: str) -> list[str]:
    return sorted(r["tag"] for r in spark.read.parquet(path).select("tag").collect())


def tag_pivot(
    tags: DataFrame,
    vocabulary: list[str] | None = None,
    key: str = "mailchimp_id",
    strict: bool = True,
    taken: list[str] | None = None,
) -> DataFrame:
    """One row per subscriber that has tags, one 0/1 column per tag of the vocabulary.

    Tags outside a given vocabulary are left out, and its unused tags become columns of zeros.
    ``strict`` raises on a repeated (subscriber, tag) pair; otherwise repeats collapse.
    ``taken`` lists columns of the table to be joined later, which no tag may shadow.
    """
    if vocabulary is None:
        vocabulary = tag_vocabulary(tags)
    names = tag_columns(vocabulary, [key, *(taken or [])])
    present = F.lit(1)
    if strict:
        repeated = F.concat(F.lit("repeated tag for "), F.max(F.col(key)).cast("string"))
        mark = F.when(F.count(F.col("tag")) > 1, F.raise_error(repeated).cast("int")).otherwise(present)
    else:
        mark = F.max(present)
    wide = tags.groupBy(key).pivot("tag", vocabulary).agg(mark)
    return wide.toDF(key, *names.values()).fillna(0, subset=list(names.values()))


def ranked_vocabulary(tags: DataFrame) -> DataFrame:
    """Distinct tags with their place in sorted order, as a table: there may be more than fit a list on the driver.

    Columns: tag, place (from 0), size (number of tags).
    """
    distinct = tags.select("tag").filter(F.col("tag").isNotNull()).distinct().withColumn("__one", F.lit(1).cast("long"))
    ranked = running_totals(distinct, ["tag"], Running(sums={"__upto": "__one"}, totals={"size": "__one"}))
    return ranked.select("tag", (F.col("__upto") - 1).alias("place"), "size")


def tag_vectors(
    tags: DataFrame, vocabulary: DataFrame | None = None, key: str = "mailchimp_id", strict: bool = True
) -> DataFrame:
    """One sparse 0/1 vector per subscriber that has tags, for vocabularies of any size.

    Columns: the key, size (of the vocabulary), indices (ascending) and values. A place in the vector is a column of
    ``tag_pivot`` over the same tags. Tags outside a given vocabulary are left out. ``strict`` raises on a
    repeated (subscriber, tag) pair; otherwise repeats collapse.
    """
    vocabulary = ranked_vocabulary(tags) if vocabulary is None else vocabulary
    pairs = tags.select(key, "tag").filter(F.col("tag").isNotNull()).groupBy(key, "tag").agg(F.count("*").alias("__times"))
    if strict:
        repeated = F.concat(F.lit("repeated tag for "), F.col(key).cast("string"))
        pairs = pairs.withColumn("__times", F.when(F.col("__times") > 1, F.raise_error(repeated).cast("long")).otherwise(F.col("__times")))
    placed = pairs.join(vocabulary, "tag")
    rows = placed.groupBy(key).agg(
        F.max("size").alias("size"), F.array_sort(F.collect_list("place")).alias("indices"), F.max("__times").alias("__times"))
    # The count is read, so that the check of repeats is not pruned away.
    return rows.filter(F.col("__times") > 0).select(key, "size", "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values"))


def with_tags(leads: DataFrame, wide_tags: DataFrame, key: str = "mailchimp_id") -> DataFrame:
    """Left join of the wide tags by the key alone; subscribers without tags keep nulls."""
    return look_up(leads, wide_tags, key, key)
