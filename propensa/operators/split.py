"""Train, validation and test folds from a seeded hash of the row key.

A fold depends on the key and the seed alone, never on row order or on the
number of partitions, so a lost task that runs again gives the same rows.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from propensa.functions.hashing import hash_text, hash_unit
from propensa.operators.running import Running, running_totals

TRAIN, VALIDATION, TEST = "train", "val", "test"

# Fold sizes and seed of the model split.
VAL_SIZE = 0.2
TEST_SIZE = 0.2
SEED = 123

MAX_CLASSES = 100
# Hash characters that rows are first counted by (16 values each).
PREFIX_LENGTH = 3


def split_fast(
    df: DataFrame, key: str, val_size: float = VAL_SIZE, test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """Folds by fixed cut points of the hash: one map over the rows, sizes right on average."""
    unit = F.col("__unit")
    train_end = 1 - val_size - test_size
    fold = (
        F.when(unit < F.lit(round(train_end, 12)), TRAIN)
        .when(unit < F.lit(round(train_end + val_size, 12)), VALIDATION)
        .otherwise(TEST)
    )
    return df.withColumn("__unit", hash_unit(key, seed)).withColumn("fold", fold).drop("__unit")


def split_exact(
    df: DataFrame,
    label: str,
    key: str,
    val_size: float = VAL_SIZE,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    ranges: int | None = None,
) -> DataFrame:
    """Folds stratified by label with exact sizes, each class cut by rank in hash order.

    Counts per class and hash prefix tell which prefix holds a cut; only rows with
    those prefixes are ranked, so the table itself is never sorted or shuffled.
    The folds are then one map over ``df``.
    """
    hashed, prefix = hash_text(key, seed), F.substring(hash_text(key, seed), 1, PREFIX_LENGTH)
    counts = _prefix_counts(df, label, prefix)
    sizes = fold_sizes({c: sum(by_prefix.values()) for c, by_prefix in counts.items()}, val_size, test_size)
    # The ranks at which the train and the validation fold of a class end.
    ends = {c: (size[TRAIN], size[TRAIN] + size[VALIDATION]) for c, size in sizes.items()}
    places = {(c, rank): _place(counts[c], rank) for c, ranks in ends.items() for rank in ranks if rank > 0}

    last: dict[tuple[Any, int], Row] = {}
    if places:
        near = reduce(or_, [
            (F.col(label) == F.lit(c)) & (prefix == F.lit(p))
            for c, p in sorted({(c, p) for (c, _), (p, _) in places.items()}, key=str)
        ])
        ranked = running_totals(
            df.filter(near)
            .groupBy(label, key)
            .agg(F.count("*").alias("__n"))
            .withColumns({"__hash": hashed, "__prefix": prefix}),
            order=["__hash", key],
            what=Running(sums={"__upto": "__n"}),
            groups=[label, "__prefix"],
            ranges=ranges,
        )
        at_cut = reduce(or_, [
            (F.col(label) == F.lit(c)) & (F.col("__prefix") == F.lit(p))
            & (F.col("__upto") >= rank - before) & (F.col("__upto") - F.col("__n") < rank - before)
            for (c, rank), (p, before) in places.items()
        ])
        for row in ranked.filter(at_cut).collect():
            for (c, rank), (p, before) in places.items():
                within = rank - before
                if (row[label], row["__prefix"]) == (c, p) and row["__upto"] - row["__n"] < within <= row["__upto"]:
                    last[c, rank] = row

    def upto(c: Any, rank: int) -> Column:
        if (c, rank) not in last:
            return F.lit(False)
        cut_hash, cut_key = F.lit(last[c, rank]["__hash"]), F.lit(last[c, rank][key])
        return (F.col("__hash") < cut_hash) | ((F.col("__hash") == cut_hash) & (F.col(key) <= cut_key))

    fold = F.when(F.lit(False), TEST)
    for c, (train_end, val_end) in ends.items():
        of_class = F.col(label) == F.lit(c)
        fold = fold.when(of_class & upto(c, train_end), TRAIN).when(of_class & upto(c, val_end), VALIDATION)
    return df.withColumn("__hash", hashed).withColumn("fold", fold.otherwise(TEST)).drop("__hash")


def _prefix_counts(df: DataFrame, label: str, prefix: Column) -> dict[Any, dict[str, int]]:
    """Rows per class and hash prefix: a number of counts that does not grow with the rows."""
    limit = MAX_CLASSES * 16**PREFIX_LENGTH
    rows = (
        df.groupBy(F.col(label).alias("c"), prefix.alias("p"))
        .agg(F.count("*").alias("n"))
        .limit(limit + 1)
        .collect()
    )
    counts: dict[Any, dict[str, int]] = {}
    for row in rows:
        counts.setdefault(row["c"], {})[row["p"]] = row["n"]
    if None in counts:
        raise ValueError(f"{sum(counts[None].values())} rows have no {label}")
    if len(counts) > MAX_CLASSES or len(rows) > limit:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    return counts


def _place(by_prefix: dict[str, int], rank: int) -> tuple[str, int]:
    """The prefix that holds a rank, and the number of rows before that prefix."""
    before = 0
    for prefix in sorted(by_prefix):
        if before + by_prefix[prefix] >= rank:
            return prefix, before
        before += by_prefix[prefix]
    raise ValueError(f"rank {rank} is beyond the {before} rows")


def fold_sizes(
    class_counts: dict[Any, int], val_size: float = VAL_SIZE, test_size: float = TEST_SIZE
) -> dict[Any, dict[str, int]]:
    """Rows of each class per fold.

    The held-out part is rounded up and then halved the same way; each part is
    shared over the classes in proportion, whole rows first, the rest by the
    largest remainder (the smaller class value first on equal remainders).
    """
    rows = sum(class_counts.values())
    held_out = _round_up((val_size + test_size) * rows)
    train = share(class_counts, rows - held_out)
    rest = {c: n - train[c] for c, n in class_counts.items()}
    test_rows = _round_up(test_size / (val_size + test_size) * held_out)
    val = share(rest, held_out - test_rows)
    return {
        c: {TRAIN: train[c], VALIDATION: val[c], TEST: rest[c] - val[c]} for c in class_counts
    }


def share(class_counts: dict[Any, int], draws: int) -> dict[Any, int]:
    """Split ``draws`` over the classes in proportion to their counts."""
    rows = sum(class_counts.values())
    if rows == 0:
        return dict.fromkeys(class_counts, 0)
    parts = {c: divmod(n * draws, rows) for c, n in class_counts.items()}
    left = draws - sum(whole for whole, _ in parts.values())
    by_remainder = sorted(parts, key=lambda c: (-parts[c][1], c))
    extra = set(by_remainder[:left])
    return {c: whole + (c in extra) for c, (whole, _) in parts.items()}


def _round_up(x: float) -> int:
    """Ceiling that ignores the noise of the float product."""
    return -int(-round(x, 6) // 1)


def fold_rows(df: DataFrame, *folds: str) -> DataFrame:
    """Rows of the named folds: a filter, where stacking two frames would scan twice."""
    return df.filter(F.col("fold").isin(*folds))
