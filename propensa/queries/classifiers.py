"""Classifiers over a few given inputs, small enough that SQL can repeat the fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.plans import boosting as bo
from propensa.plans import classifiers as cl
from propensa.plans import neighbours as nb
from propensa.queries import leads
from propensa.queries.twins import with_tables

# Inverses and sums of fractions depend on their order in the last digits.
DIGITS = 8
PAIR = ["member_rating", "optin_month"]
STUMP_INPUTS = ["member_rating", "optin_month", "is_free_email"]
ROUNDS = 4
NEAR_INPUTS = ["member_rating", "optin_month", "tag_count", "is_free_email", "optin_day_of_week"]
NEIGHBOURS = 5
GIVEN_TRIALS = [
    {"max_depth": 2, "learning_rate": 0.5, "n_estimators": 3, "subsample": 1.0, "colsample_bytree": 1.0},
    {"max_depth": 3, "learning_rate": 0.25, "n_estimators": 2, "subsample": 1.0, "colsample_bytree": 1.0},
]


def given_rows(spark: SparkSession, sf_dir: str, inputs: list[str]) -> DataFrame:
    """Inputs of every lead, with a label that depends on them: purchases of the stand-in tables do not."""
    rows = leads.engineered(spark, sf_dir)
    learnable = "cast((member_rating * 3 + optin_month + mailchimp_id * 7919 % 11 > 20) as int) as label"
    return rows.select("mailchimp_id", F.expr(learnable), F.array(*[F.col(c).cast("double") for c in inputs]).alias("x"))


def _discriminant_scores(spark: SparkSession, sf_dir: str, quadratic: bool) -> DataFrame:
    rows = given_rows(spark, sf_dir, PAIR)
    model = cl.discriminant(cl.moments(rows), quadratic)
    odds = model.log_odds(F.col("x"))
    return rows.select("mailchimp_id", F.round(odds, DIGITS).alias("log_odds"), (odds > 0).cast("int").alias("prediction"))


def class_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.moments(given_rows(spark, sf_dir, PAIR))


def _stumps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, cl.StumpModel]:
    rows = given_rows(spark, sf_dir, STUMP_INPUTS)
    cuts = cl.cut_points(rows)
    return rows, cl.StumpModel(cuts, cl.boost(cl.binned(rows, cuts), ROUNDS))


def boosted_stumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stumps of the given rounds: what they split, their error and their vote."""
    _, model = _stumps(spark, sf_dir)
    rows = [(s["round"], STUMP_INPUTS[s["feature"]], model.cuts[s["feature"]][s["bin"]], s["upper"], s["error"], s["vote"]) for s in model.stumps]
    found = spark.createDataFrame(rows, "round int, feature string, cut double, upper int, error double, vote double")
    return found.withColumns({c: F.round(c, DIGITS) for c in ("error", "vote")})


def stump_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = _stumps(spark, sf_dir)
    return rows.select("mailchimp_id", F.round(model.votes(F.col("x")), DIGITS).alias("votes"))


def boosted_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The splits of all trees of two given trials that are grown together."""
    rows = given_rows(spark, sf_dir, STUMP_INPUTS)
    cuts = cl.cut_points(rows)
    grown, _ = bo.grow(cl.binned(rows, cuts).withColumn("learn", F.lit(True)), GIVEN_TRIALS, len(STUMP_INPUTS), "mailchimp_id")
    found = [(t, r, node, STUMP_INPUTS[f], cuts[f][b], gain) for t, trees in enumerate(grown) for r, tree in enumerate(trees)
             for node, (f, b, gain) in tree.splits.items()]
    splits = spark.createDataFrame(found, "trial int, tree int, node int, feature string, cut double, gain double")
    return splits.withColumn("gain", F.round("gain", 6))


def _nearest(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = given_rows(spark, sf_dir, NEAR_INPUTS)
    return rows, nb.nearest(rows, rows.filter("mailchimp_id % 50 = 0"), NEIGHBOURS)


def nearest_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest other leads of every fiftieth, among all."""
    return _nearest(spark, sf_dir)[1].select("query", F.col("key").alias("mailchimp_id"), "rank", "distance")


def neighbour_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, found = _nearest(spark, sf_dir)
    return nb.neighbour_scores(found, rows)


QUERIES = {
    "nearest_leads": nearest_leads,
    "neighbour_scores": neighbour_scores,
    "boosted_splits": boosted_splits,
    "class_moments": class_moments,
    "lda_scores": lambda s, d: _discriminant_scores(s, d, False),
    "qda_scores": lambda s, d: _discriminant_scores(s, d, True),
    "boosted_stumps": boosted_stumps,
    "stump_votes": stump_votes,
}

_ROWS = with_tables("engineered") + """,
    given as (
        select mailchimp_id, cast(member_rating * 3 + optin_month + mailchimp_id * 7919 % 11 > 20 as int) as label,
               member_rating::double as member_rating,
               optin_month::double as optin_month, is_free_email::double as is_free_email
        from engineered)"""

# Two inputs: the inverse of a 2 x 2 matrix is written out.
_SCATTER = _ROWS + """,
    means as (select label, count(*)::double as n, avg(member_rating) as a, avg(optin_month) as b from given group by label),
    scatter as (
        select label, any_value(n) as n, any_value(a) as a, any_value(b) as b, sum((member_rating - a) ** 2) as aa,
               sum((member_rating - a) * (optin_month - b)) as ab, sum((optin_month - b) ** 2) as bb
        from given join means using (label) group by label)"""


def _scored(inverse: str, density: str) -> str:
    return f"""{_SCATTER},
    {inverse},
    far as (
        select mailchimp_id, i.label, {density} as part
        from given g, inverse i),
    odds as (select mailchimp_id, sum(case when label = 1 then part else -part end) as odds from far group by mailchimp_id)
    select mailchimp_id, round(odds, {DIGITS}) as log_odds, cast(odds > 0 as int) as prediction from odds"""


_FORM = ("((member_rating - a) ** 2 * ibb - 2 * (member_rating - a) * (optin_month - b) * iab + (optin_month - b) ** 2 * iaa) / det / 2")


_ABOVE = "case b.feature " + " ".join(f"when '{c}' then {c}" for c in STUMP_INPUTS) + " end > b.cut"


def _stump_sql() -> str:
    """Round after round: the grouped sums, the best split, the new weights."""
    parts = [_ROWS + ", weights0 as (select *, 1.0::double as weight from given)"]
    for k in range(ROUNDS):
        cells = " union all ".join(
            f"select {i} as place, '{c}' as feature, {c} as cut, sum(case when label = 1 then weight else 0 end) as one, "
            f"sum(case when label = 0 then weight else 0 end) as zero from weights{k} group by {c}" for i, c in enumerate(STUMP_INPUTS))
        parts.append(f"""splits{k} as (
            select place, feature, cut, sum(one) over w as one_low, sum(zero) over w as zero_low, sum(one) over (partition by place) as ones,
                   sum(zero) over (partition by place) as zeros, lead(cut) over w is not null as inside
            from ({cells}) window w as (partition by place order by cut)),
        rated{k} as (
            select *, (one_low + zeros - zero_low) / (ones + zeros) as wrong from splits{k} where inside),
        best{k} as (
            select {k} as round, feature, cut, upper, error, ln((1 - error) / error) as vote
            from (select place, feature, cut, 1 as upper, wrong as error from rated{k}
                  union all select place, feature, cut, 0, 1 - wrong from rated{k})
            order by round(error, 9), place, cut, upper desc limit 1),
        weights{k + 1} as (
            select g.* replace (case when (case when ({_ABOVE}) = (b.upper = 1) then 1 else 0 end) <> label
                                     then weight * ((1 - error) / error) else weight end as weight)
            from weights{k} g, best{k} b)""")
    return ", ".join(parts)


def _split_sql() -> str:
    """Tree after tree and level after level of each trial: derivatives, cells, gains, best splits, new margins."""
    parts, found = [], []
    for t, trial in enumerate(GIVEN_TRIALS):
        parts.append(f"rows{t}_0 as (select *, 0.0::double as margin from given)")
        for r in range(trial["n_estimators"]):
            name = f"{t}_{r}"
            parts.append(f"""in{name}_0 as (
                select *, 1 as node, round((p - label) / {bo.UNIT!r})::bigint as g, round(p * (1 - p) / {bo.UNIT!r})::bigint as h
                from (select *, 1 / (1 + exp(-margin)) as p from rows{name}))""")
            for level in range(trial["max_depth"]):
                here = f"in{name}_{level}"
                cells = " union all ".join(
                    f"select node, {i} as place, '{c}' as feature, {c} as cut, sum(g)::bigint as g, sum(h)::bigint as h from {here} "
                    f"where node >= {1 << level} group by node, {c}" for i, c in enumerate(STUMP_INPUTS))
                side = lambda g, h: f"({g} * {bo.UNIT!r}) * ({g} * {bo.UNIT!r}) / ({h} * {bo.UNIT!r} + {bo.SHRINK})"
                parts.append(f"""best{name}_{level} as (
                    select * from (
                        select node, place, feature, cut, round({side('gl', 'hl')} + {side('(g - gl)', '(h - hl)')} - {side('g', 'h')}, {bo.DIGITS}) as gain
                        from (select node, place, feature, cut, (sum(g) over w)::double as gl, (sum(h) over w)::double as hl,
                                     (sum(g) over (partition by node, place))::double as g, (sum(h) over (partition by node, place))::double as h
                              from ({cells}) window w as (partition by node, place order by cut))
                        where hl >= {int(bo.LEAST_CHILD / bo.UNIT)} and h - hl >= {int(bo.LEAST_CHILD / bo.UNIT)})
                    where gain > 0 qualify row_number() over (partition by node order by gain desc, place, cut) = 1),
                in{name}_{level + 1} as (
                    select a.* replace (case when b.node is null then a.node else 2 * a.node + (case when {_ABOVE} then 1 else 0 end) end as node)
                    from {here} a left join best{name}_{level} b on a.node = b.node)""")
                found.append(f"select {t} as trial, {r} as tree, node, feature, cut, round(gain, 6) as gain from best{name}_{level}")
            last = f"in{name}_{trial['max_depth']}"
            parts.append(f"""leaf{name} as (
                select node, -(sum(g)::double * {bo.UNIT!r}) / (sum(h)::double * {bo.UNIT!r} + {bo.SHRINK}) as value from {last} group by node),
            rows{t}_{r + 1} as (
                select mailchimp_id, label, {', '.join(STUMP_INPUTS)}, margin + {trial['learning_rate']} * value as margin
                from {last} join leaf{name} using (node))""")
    return _ROWS + ", " + ", ".join(parts) + " " + " union all ".join(found)


_PAIRS = with_tables("engineered") + f""",
        given as (
            select mailchimp_id, cast(member_rating * 3 + optin_month + mailchimp_id * 7919 % 11 > 20 as int) as label,
                   [{', '.join(f'{c}::double' for c in NEAR_INPUTS)}] as x from engineered),
        near as (
            select q.mailchimp_id as query, r.mailchimp_id, r.label, list_sum(list_transform(list_zip(q.x, r.x), lambda p: (p[1] - p[2]) ** 2)) as distance
            from given q join given r on q.mailchimp_id % 50 = 0 and q.mailchimp_id <> r.mailchimp_id),
        ranked as (
            select *, row_number() over (partition by query order by distance, mailchimp_id) as rank
            from near qualify rank <= {NEIGHBOURS})"""

SQL = {
    "nearest_leads": _PAIRS + " select query, mailchimp_id, rank, distance from ranked",
    "neighbour_scores": _PAIRS + " select query, avg(label) as score from ranked group by query",
    "boosted_splits": _split_sql(),
    "class_moments": _ROWS + """,
        values_of as (select label, unnest([0, 1, 2]) as i, unnest([1.0::double, member_rating, optin_month]) as v, mailchimp_id from given)
        select a.label::bigint as label, a.i, b.i as j, sum(a.v * b.v) as total
        from values_of a join values_of b using (mailchimp_id, label) where a.i <= b.i group by all""",
    "lda_scores": _scored("""pooled as (select sum(aa) / (sum(n) - 2) as aa, sum(ab) / (sum(n) - 2) as ab, sum(bb) / (sum(n) - 2) as bb from scatter),
    inverse as (select s.label, s.n, s.a, s.b, p.aa as iaa, p.ab as iab, p.bb as ibb, p.aa * p.bb - p.ab ** 2 as det from scatter s, pooled p)""", f"ln(n) - {_FORM}"),
    "qda_scores": _scored("""inverse as (
        select label, n, a, b, aa / (n - 1) as iaa, ab / (n - 1) as iab, bb / (n - 1) as ibb, (aa * bb - ab ** 2) / (n - 1) ** 2 as det from scatter)""",
                          f"ln(n) - ln(det) / 2 - {_FORM}"),
    "boosted_stumps": _stump_sql() + " " + " union all ".join(
        f"select round, feature, cut, upper, round(error, {DIGITS}) as error, round(vote, {DIGITS}) as vote from best{k}" for k in range(ROUNDS)),
    "stump_votes": _stump_sql() + f""", all_best as ({' union all '.join(f'select * from best{k}' for k in range(ROUNDS))})
        select mailchimp_id, round(sum(case when ({_ABOVE}) = (b.upper = 1) then vote else -vote end), {DIGITS}) as votes
        from given g, all_best b group by mailchimp_id""",
}
