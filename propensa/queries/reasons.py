"""Reasons of scores: over a given ensemble, which SQL can repeat, and over the fitted model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.plans import reasons as rs
from propensa.queries import leads, models
from propensa.queries.twins import with_tables

INPUTS = ["member_rating", "tag_count", "optin_days", "optin_month", "is_free_email", "tag_view_00"]

# A given ensemble. Nodes in order: (value, left, right, input, threshold); values are 64ths, so that sums are exact.
TREES = [
    (1.0, [(6, 1, 2, 0, 3.0), (-10, 3, 4, 1, 4.0), (21, 5, 6, 3, 6.0), (-19, -1, -1, -1, None), (3, -1, -1, -1, None),
           (14, -1, -1, -1, None), (30, 7, 8, 5, 0.0), (27, -1, -1, -1, None), (44, -1, -1, -1, None)]),
    (0.5, [(2, 1, 2, 2, -700.0), (-9, 3, 4, 0, 2.0), (17, 5, 6, 4, 0.0), (-25, -1, -1, -1, None), (1, -1, -1, -1, None),
           (11, -1, -1, -1, None), (23, -1, -1, -1, None)]),
    (0.5, [(-4, 1, 2, 1, 2.0), (-12, -1, -1, -1, None), (5, 3, 4, 0, 4.0), (-1, -1, -1, -1, None), (13, -1, -1, -1, None)]),
    (0.25, [(8, -1, -1, -1, None)]),
]
DEPTH = 3
GRID = {"member_rating": [1, 2, 3, 4, 5], "tag_count": [0, 2, 4, 8], "is_free_email": [0, 1]}


def given_forest(spark: SparkSession) -> rs.Forest:
    rows = [(t, weight, n, value / 64, left, right, feature, threshold, None)
            for t, (weight, nodes) in enumerate(TREES) for n, (value, left, right, feature, threshold) in enumerate(nodes)]
    return rs.forest(spark.createDataFrame(rows, rs.NODES), DEPTH, INPUTS)


def given_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.coalesce(F.col(c), F.lit(0)).cast("double") if c.startswith("tag_") else F.col(c).cast("double") for c in INPUTS]
    return leads.engineered(spark, sf_dir).select("mailchimp_id", F.array(*columns).alias("x"))


def lead_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.reasons(given_leads(spark, sf_dir), given_forest(spark))


def margin_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.partial_dependence(given_leads(spark, sf_dir), given_forest(spark), GRID)


def model_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three main reasons of every lead's score by the fitted model."""
    model = models._model(spark, sf_dir)
    _, table = models._featurized(spark, sf_dir)
    explained = rs.fitted_forest(model.pipeline.stages[-1], model.features, spark)
    return rs.reasons(rs.with_values(table, "mailchimp_id"), explained, top=3)


def model_dependence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean margin of the fitted model over the quantiles of its numeric inputs: all but the country, whose codes have no order."""
    model = models._model(spark, sf_dir)
    table = rs.with_values(models._featurized(spark, sf_dir)[1], "mailchimp_id")
    explained = rs.fitted_forest(model.pipeline.stages[-1], model.features, spark)
    numeric = [f for f in model.features if f != "country_code"]
    return rs.partial_dependence(table, explained, rs.quantile_grid(table, explained, numeric, 5))


QUERIES = {
    "lead_reasons": lead_reasons,
    "margin_dependence": margin_dependence,
    "model_reasons": model_reasons,
    "model_dependence": model_dependence,
}


def _number(value: float | None) -> str:
    return "null" if value is None else repr(float(value))


_NODES = ", ".join(
    f"({t}, {weight}, {n}, {value / 64!r}, {left}, {right}, {feature}, {_number(threshold)})"
    for t, (weight, nodes) in enumerate(TREES) for n, (value, left, right, feature, threshold) in enumerate(nodes))
_INPUTS = "[" + ", ".join(f"coalesce({c}, 0)::double" if c.startswith("tag_") else f"{c}::double" for c in INPUTS) + "]"
_GRID = ", ".join(f"({INPUTS.index(name)}, '{name}', {float(v)})" for name, values in GRID.items() for v in values)
_NAMES = "[" + ", ".join(f"'{c}'" for c in INPUTS) + "]"


def _walk(start: str, keys: str) -> str:
    """Every step of every lead through every tree: the node it leaves, the node it enters."""
    own = ", ".join(f"w.{k}" for k in keys.split(", "))
    return f"""
        nodes(tree, weight, node, value, l, r, feature, threshold) as (values {_NODES}),
        begun as ({start}),
        walk as (
            with recursive w as (
                select {keys}, x, tree, 0 as node, 0 as step from begun, (select distinct tree from nodes)
                union all
                select {own}, x, w.tree, case when x[n.feature + 1] <= n.threshold then n.l else n.r end, step + 1
                from w join nodes n on n.tree = w.tree and n.node = w.node where n.l >= 0)
            select * from w),
        base as (select sum(weight * value) as base from nodes where node = 0)"""


SQL = {
    "lead_reasons": with_tables("engineered") + "," + _walk(f"select mailchimp_id, {_INPUTS} as x from engineered", "mailchimp_id") + f""",
        changes as (
            select a.mailchimp_id, m.feature, a.x[m.feature + 1] as value, m.weight * (n.value - m.value) as change
            from walk a join walk b on a.mailchimp_id = b.mailchimp_id and a.tree = b.tree and b.step = a.step + 1
            join nodes m on m.tree = a.tree and m.node = a.node join nodes n on n.tree = b.tree and n.node = b.node),
        sums as (select mailchimp_id, feature as place, value, sum(change)::double as contribution from changes group by all)
        select mailchimp_id, ({_NAMES})[place + 1] as feature, value, contribution, base::double as base,
               (base + sum(contribution) over (partition by mailchimp_id))::double as margin,
               row_number() over (partition by mailchimp_id order by abs(contribution) desc, place) as rank
        from sums, base""",
    "margin_dependence": with_tables("engineered") + f""",
        grid(place, feature, value) as (values {_GRID}),""" + _walk(
        f"""select mailchimp_id, feature, value, list_transform({_INPUTS}, lambda v, i: case when i - 1 = place then value else v end) as x
            from engineered, grid""", "mailchimp_id, feature, value") + """,
        leaves as (
            select w.mailchimp_id, w.feature, w.value, sum(n.weight * n.value) as margin
            from walk w join nodes n on n.tree = w.tree and n.node = w.node and n.l < 0 group by all)
        select feature, value, avg(margin)::double as mean_margin from leaves group by feature, value""",
}
