"""Metrics over a fixed score column, so that each has an exact twin."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators import metrics as mx
from propensa.queries.crm import joined_table
from propensa.queries.twins import with_tables

# Sums of fractions depend on their order in the last digits.
DIGITS = 10


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every subscriber with its label and a score that leans towards the label."""
    key, label = F.col("mailchimp_id"), F.col("made_purchase")
    table = joined_table(spark, sf_dir).select(
        key, label.alias("label"), ((key * 7919 % 1009 + 300 * label) / 1309.0).alias("score")
    )
    return mx.predict(table).select("mailchimp_id", "label", "prediction", "score")


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(c, DIGITS).alias(c) if dtype == "double" else F.col(c) for c, dtype in df.dtypes
    ])


REPLICATES = 40
THRESHOLDS = [i / 20 for i in range(1, 20)]


def by_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the domain of the subscriber's email."""
    domain = F.substring_index("user_email", "@", -1).alias("domain")
    domains = joined_table(spark, sf_dir).select("mailchimp_id", domain)
    return scores(spark, sf_dir).join(domains, "mailchimp_id")


QUERIES = {
    "predictions": scores,
    "classification_metrics": lambda s, d: rounded(mx.classification_metrics(scores(s, d))),
    "agreement_metrics": lambda s, d: rounded(mx.agreement_metrics(scores(s, d))),
    "confusion_matrix": lambda s, d: mx.confusion_matrix(scores(s, d)),
    "classification_report": lambda s, d: rounded(mx.classification_report(scores(s, d))),
    "roc_auc": lambda s, d: rounded(mx.roc_auc(scores(s, d))),
    "average_precision": lambda s, d: rounded(mx.average_precision(scores(s, d))),
    "roc_curve": lambda s, d: mx.roc_curve(scores(s, d)),
    "pr_curve": lambda s, d: mx.pr_curve(scores(s, d)),
    "threshold_sweep": lambda s, d: rounded(mx.threshold_sweep(scores(s, d), THRESHOLDS)),
    "calibration_bins": lambda s, d: rounded(mx.calibration_bins(scores(s, d))),
    "slice_metrics": lambda s, d: rounded(mx.slice_metrics(by_provider(s, d), "domain")),
    "group_gaps": lambda s, d: rounded(mx.group_gaps(by_provider(s, d), "domain", "mailchimp_id", REPLICATES)),
    "low_confidence": lambda s, d: rounded(mx.low_confidence(scores(s, d))),
}

_COUNTS = with_tables("scored") + """,
    counts as (
        select count(*) filter (where label = 1 and prediction = 1)::double as tp,
               count(*) filter (where label = 0 and prediction = 1)::double as fp,
               count(*) filter (where label = 1 and prediction = 0)::double as fn,
               count(*) filter (where label = 0 and prediction = 0)::double as tn
        from scored)
"""


def _poisson_cuts(most: int = 12) -> list[float]:
    """The shares of at most 0, 1, 2 ... draws when their number is Poisson with mean 1."""
    return list(accumulate(math.exp(-1) / math.factorial(k) for k in range(most)))


def _class(label: int) -> str:
    hits, wrong, missed = ("tp", "fp", "fn") if label else ("tn", "fn", "fp")
    return f"""
        select '{label}' as class, {hits} / ({hits} + {wrong}) as precision, {hits} / ({hits} + {missed}) as recall,
               2 * {hits} / (2 * {hits} + {wrong} + {missed}) as f1_score,
               cast({hits} + {missed} as bigint) as support
        from counts"""


SQL = {
    "predictions": with_tables("scored") + "select * from scored",
    "classification_metrics": _COUNTS + f"""
        select round((tp + tn) / (tp + fp + fn + tn), {DIGITS}) as accuracy,
               round(tp / (tp + fp), {DIGITS}) as precision, round(tp / (tp + fn), {DIGITS}) as recall,
               round(2 * tp / (2 * tp + fp + fn), {DIGITS}) as f1_score
        from counts""",
    "agreement_metrics": _COUNTS + f"""
        select round((agreed - chance) / (1 - chance), {DIGITS}) as kappa,
               round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), {DIGITS}) as mcc
        from (select *, (tp + tn) / (tp + fp + fn + tn) as agreed,
                     ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / ((tp + fp + fn + tn) ** 2) as chance
              from counts)""",
    "confusion_matrix": with_tables("scored") + """
        select a.label, p.prediction, count(s.label) as count
        from (values (0), (1)) a(label), (values (0), (1)) p(prediction)
        left join scored s on s.label = a.label and s.prediction = p.prediction
        group by 1, 2""",
    "classification_report": _COUNTS + ", classes as (" + _class(0) + " union all " + _class(1) + f""")
        select class, round(precision, {DIGITS}) as precision, round(recall, {DIGITS}) as recall,
               round(f1_score, {DIGITS}) as f1_score, support
        from (
            select * from classes
            union all
            select 'accuracy', null, null, (tp + tn) / (tp + fp + fn + tn), cast(tp + fp + fn + tn as bigint)
            from counts
            union all
            select 'macro avg', avg(precision), avg(recall), avg(f1_score), cast(sum(support) as bigint) from classes
            union all
            select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1_score * support) / sum(support), cast(sum(support) as bigint) from classes)""",
    "roc_auc": with_tables("steps") + f"""
        select round(sum(neg * (tp - pos + pos / 2)) / (max(all_pos) * max(all_neg))::double, {DIGITS}) as roc_auc
        from steps""",
    "average_precision": with_tables("steps") + f"""
        select round(sum(pos * (tp / (tp + fp)::double)) / max(all_pos)::double, {DIGITS}) as average_precision
        from steps""",
    "roc_curve": with_tables("steps") + """
        select fp / all_neg::double as fpr, tp / all_pos::double as tpr, score as threshold
        from steps
        where (tp = pos and fp = neg) or next_pos is null or pos <> next_pos or neg <> next_neg
        union all select 0.0::double, 0.0::double, 'infinity'::double""",
    "pr_curve": with_tables("steps") + """
        select tp / (tp + fp)::double as precision, tp / all_pos::double as recall, score as threshold from steps
        union all select 1.0::double, 0.0::double, null""",
    "threshold_sweep": with_tables("scored") + f""",
        cuts(threshold) as (values {', '.join(f'({t}::double)' for t in THRESHOLDS)}),
        outcomes as (
            select threshold, count(*) filter (where label = 1 and score > threshold) as tp,
                   count(*) filter (where label = 0 and score > threshold) as fp,
                   count(*) filter (where label = 1 and score <= threshold) as fn,
                   count(*) filter (where label = 0 and score <= threshold) as tn
            from cuts, scored group by threshold)
        select *, round(coalesce(tp / nullif(tp + fp, 0)::double, 0), {DIGITS}) as precision,
               round(coalesce(tp / nullif(tp + fn, 0)::double, 0), {DIGITS}) as recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::double, 0), {DIGITS}) as f1_score
        from outcomes""",
    "calibration_bins": with_tables("scored") + f"""
        select least(floor(score * 10)::int, 9) as bin, count(*) as n, round(avg(score), {DIGITS}) as mean_score,
               round(avg(label), {DIGITS}) as observed
        from scored group by 1""",
    "slice_metrics": with_tables("scored") + f""",
        cells as (
            select split_part(user_email, '@', 2) as domain, count(*) as n,
                   count(*) filter (where label = 1 and prediction = 1)::double as tp,
                   count(*) filter (where label = 0 and prediction = 1)::double as fp,
                   count(*) filter (where label = 1 and prediction = 0)::double as fn,
                   count(*) filter (where label = 0 and prediction = 0)::double as tn
            from scored join joined using (mailchimp_id) group by 1)
        select domain, n, round((tp + fn) / n, {DIGITS}) as rate, round((tp + tn) / n, {DIGITS}) as accuracy,
               round(coalesce(tp / nullif(tp + fp, 0), 0), {DIGITS}) as precision,
               round(coalesce(tp / nullif(tp + fn, 0), 0), {DIGITS}) as recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), {DIGITS}) as f1_score
        from cells""",
    "group_gaps": with_tables("scored") + f""",
        rows_of as (select split_part(user_email, '@', 2) as domain, mailchimp_id, label, prediction from scored join joined using (mailchimp_id)),
        hashed as (
            select *, md5('7:' || mailchimp_id || ':' || block) as h
            from rows_of, (select unnest(range({-(-REPLICATES // 4)})) as block)),
        unit as (
            select domain, label, prediction, 4 * block + i as replicate, ('0x' || substr(h, 8 * i::int + 1, 8))::bigint / 4294967296.0::double as u
            from hashed, (select unnest(range(4)) as i)),
        drawn as (
            select domain, label, prediction, replicate,
                   list_sum(list_transform({_poisson_cuts()}, lambda c: (u >= c)::int)) as w from unit where replicate < {REPLICATES}
            union all select domain, label, prediction, -1, 1 from rows_of),
        sums as (
            select domain, replicate, sum(w)::double as n, sum(w * prediction)::double as chosen, sum(w * label)::double as positive,
                   sum(w * label * prediction)::double as hit, (sum(w) filter (where label = prediction))::double as correct from drawn group by all),
        total as (
            select replicate, sum(chosen) / nullif(sum(n), 0) as s, sum(hit) / nullif(sum(positive), 0) as r, sum(correct) / nullif(sum(n), 0) as a
            from sums group by replicate),
        gaps as (
            select domain, replicate, n, chosen / nullif(n, 0) as selection, hit / nullif(positive, 0) as recall, coalesce(correct, 0) / nullif(n, 0) as accuracy,
                   selection - s as selection_gap, recall - r as recall_gap, accuracy - a as accuracy_gap
            from sums join total using (replicate))
        select domain, cast(max(n) filter (where replicate < 0) as bigint) as n,
               {', '.join(f"round(max({c}) filter (where replicate < 0), {DIGITS}) as {c}" for m in ("selection", "recall", "accuracy") for c in (m, m + "_gap"))},
               {', '.join(f"round(quantile_cont({m}_gap, {q!r}) filter (where replicate >= 0), {DIGITS}) as {m}_{side}"
                          for m in ("selection", "recall", "accuracy") for side, q in (("low", (1 - 0.95) / 2), ("high", (1 + 0.95) / 2)))}
        from gaps group by domain""",
    "low_confidence": with_tables("scored") + f"""
        select mailchimp_id, label, prediction, round(score, {DIGITS}) as score, round(abs(score - 0.5), {DIGITS}) as distance,
               abs(score - 0.5) < 0.1 as uncertain
        from scored""",
}
