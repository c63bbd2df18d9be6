"""Running totals in a global order, without sending everything to one task.

A window with no partition key puts all rows in one task. Here rows are range
partitioned on the order instead: each range is summed on its own, the few
range totals are accumulated, and every row adds the total of the ranges before
it. Both branches read one written table, so they see the same ranges. The
session's shuffle settings give the number of ranges, and adaptive execution joins
neighbours up to its advisory size, so a small table is the same plan with one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensa.session import stored

RANGE = "__range"


@dataclass(frozen=True)
class Running:
    """What to add to each row.

    ``sums`` and ``totals`` map an output column to the column summed, up to and
    including the row and over the whole group. ``following`` maps an output
    column to the column read from the next row in the order.
    """

    sums: dict[str, str]
    totals: dict[str, str] = field(default_factory=dict)
    following: dict[str, str] = field(default_factory=dict)


def running_totals(
    rows: DataFrame,
    order: Sequence[str],
    what: Running,
    groups: Sequence[str] = (),
    descending: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Add running sums to ``rows`` in the order of ``order``, within ``groups``.

    ``order`` must be unique within a group: aggregate ties first. The rows are
    written once, by range; ``ranges`` states their number.
    """
    sort = _sort(order, descending)
    by = [*[F.col(g).asc() for g in groups], *sort]
    dealt = rows.repartitionByRange(*by) if ranges is None else rows.repartitionByRange(ranges, *by)
    ranged = stored(dealt.withColumn(RANGE, F.spark_partition_id()))

    # One row per (group, range): at most the number of ranges plus the number of groups.
    key = F.struct(*order)
    first = F.max_by if descending else F.min_by
    sums = {src: f"__sum_{src}" for src in {*what.sums.values(), *what.totals.values()}}
    firsts = {src: f"__first_{src}" for src in set(what.following.values())}
    per_range = ranged.groupBy(*groups, RANGE).agg(
        *[F.sum(src).alias(name) for src, name in sums.items()],
        *[first(src, key).alias(name) for src, name in firsts.items()],
    )
    group = Window.partitionBy(*groups)
    by_range = group.orderBy(RANGE)
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(g).alias(f"__key_{g}") for g in [*groups, RANGE]],
        *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"__before_{src}") for src, name in sums.items()],
        *[F.sum(name).over(group).alias(f"__total_{src}") for src, name in sums.items()],
        *[F.lead(name).over(by_range).alias(f"__next_{src}") for src, name in firsts.items()],
    )

    within = Window.partitionBy(*groups, RANGE).orderBy(*sort)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = within.rowsBetween(1, 1)
    summed = ranged.select(
        "*",
        *[F.sum(src).over(upto).alias(f"__local_{src}") for src in set(what.sums.values())],
        *[F.lead(src).over(within).alias(f"__ahead_{src}") for src in firsts],
        F.count(F.lit(1)).over(after).alias("__more"),
    )
    same_key = reduce(
        and_,
        [summed[g].eqNullSafe(offsets[f"__key_{g}"]) for g in groups],
        summed[RANGE] == offsets[f"__key_{RANGE}"],
    )
    return summed.join(offsets, same_key, "left").select(
        *rows.columns,
        *[
            (F.col(f"__local_{src}") + F.col(f"__before_{src}")).alias(out)
            for out, src in what.sums.items()
        ],
        *[F.col(f"__total_{src}").alias(out) for out, src in what.totals.items()],
        *[
            F.when(F.col("__more") > 0, F.col(f"__ahead_{src}")).otherwise(F.col(f"__next_{src}")).alias(out)
            for out, src in what.following.items()
        ],
    )


def _sort(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]
