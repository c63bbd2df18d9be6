"""Fitting, search, scoring and streaming. What a fitted model says has no SQL twin."""

from __future__ import annotations

from datetime import datetime
from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.operators.split import TEST, fold_rows, split_exact
from propensa.plans import evaluate as ev
from propensa.plans import learning as ln
from propensa.plans import scoring
from propensa.queries import leads as lead_queries
from propensa.queries.leads import exact_folds
from propensa.queries.twins import TAG_COLUMNS, with_tables
from propensa.session import ensure_checkpoint_dir, scratch_path, stored
from propensa.sources.registry import ModelRegistry, ScoringModel
from propensa.sources.schemas import lead_schema
from propensa.sources.standins import source
from propensa.sources.tables import read_table
from propensa.streaming import records
from propensa.streaming.scoring import lead_stream, start_features, start_scoring

# Parameters of the published best trial.
PARAMS = {"max_depth": 3, "learning_rate": 0.11281, "n_estimators": 163, "subsample": 0.9912, "colsample_bytree": 0.9679}
COMPARE = ln.CompareSetup()
LOOKED_UP_ID = 5
GIVEN_WEIGHTS = {"member_rating": 0.375, "tag_count": -0.125}
REFERENCE_DATE = datetime(2020, 1, 1)


@cache
def _leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leads with their folds, written once per session and data folder."""
    raw = lead_queries.raw_table(spark, sf_dir)
    return stored(split_exact(raw, lead_queries.TARGET, lead_queries.KEY))


@cache
def _featurized(spark: SparkSession, sf_dir: str) -> tuple[ln.Featurizer, DataFrame]:
    leads = _leads(spark, sf_dir)
    featurizer = ln.fit_featurizer(leads)
    return featurizer, ln.training_table(leads, featurizer)


@cache
def _model(spark: SparkSession, sf_dir: str) -> ScoringModel:
    """A model fitted, saved, listed and loaded back through the registry."""
    featurizer, table = _featurized(spark, sf_dir)
    ensure_checkpoint_dir(spark)
    fitted = ln.refit(table, PARAMS)
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    registry.register(
        PipelineModel(stages=[*featurizer.pipeline.stages, fitted]),
        features=featurizer.features,
        fields=featurizer.fields,
        reference_date=featurizer.reference_date,
        params=PARAMS,
        metrics={},
        training_samples=table.filter(F.col("fold") != TEST).count(),
        validation_samples=table.filter(F.col("fold") == "val").count(),
        now=datetime(2024, 1, 1),
    )
    return registry.load()


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on train and validation rows, score the test rows."""
    _, table = _featurized(spark, sf_dir)
    return ln.scored(ln.refit(table, PARAMS), fold_rows(table, TEST)).drop("fold")


def trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _featurized(spark, sf_dir)
    return ln.run_trials(table, ln.sample_trials())


def trials_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published draws with a few trees each, grown together."""
    featurizer, table = _featurized(spark, sf_dir)
    space = {**ln.SEARCH_SPACE, "n_estimators": ("integer", 2, 5)}
    return ln.run_trials_together(table, ln.sample_trials(space=space), featurizer.features)[0].drop("seconds")


def class_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, table = _featurized(spark, sf_dir)
    return ln.class_scores(_model(spark, sf_dir).pipeline.stages[-1], table).drop("fold")


def leaderboard(spark: SparkSession, sf_dir: str, include: list[str] | None = None) -> DataFrame:
    table = ln.compare_table(_leads(spark, sf_dir), COMPARE)
    return ln.leaderboard(table, COMPARE, include)


def compare_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transformed matrix of the comparison, its vector as an array."""
    table = ln.compare_table(_leads(spark, sf_dir), COMPARE)
    return table.withColumn("features", vector_to_array("features"))


def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    return ln.feature_importance(model.pipeline.stages[-1], model.features, spark).limit(ev.TOP_CHARTED)


def permutation_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    featurizer, table = _featurized(spark, sf_dir)
    model = _model(spark, sf_dir).pipeline.stages[-1]
    return ln.permutation_importance(model, fold_rows(table, TEST), featurizer.features)


def score_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_by_id(_model(spark, sf_dir), lead_queries.raw_table(spark, sf_dir), LOOKED_UP_ID)


def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    result = ev.evaluate(model, fold_rows(_leads(spark, sf_dir), TEST))
    return ev.report_row(model, result, now=datetime(2024, 1, 1))


def assembled_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature vector of every lead, one row per feature, named in the fitted order."""
    featurizer, table = _featurized(spark, sf_dir)
    names = F.array(*[F.lit(n) for n in featurizer.features])
    return table.select(
        "mailchimp_id", "fold", "label", F.posexplode(vector_to_array("features")).alias("position", "value")
    ).withColumn("feature", F.get(names, F.col("position")))


def _lead_files(spark: SparkSession, leads: DataFrame) -> str:
    """Leads as a folder of files, the form a stream reads."""
    path = scratch_path(spark, "stream-in")
    leads.write.option("maxRecordsPerFile", 100_000).parquet(path)
    return path


def stream_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of all leads, engineered as a stream of files and read back from the sink."""
    leads = lead_queries.raw_table(spark, sf_dir)
    source, sink, marks = _lead_files(spark, leads), scratch_path(spark, "out"), scratch_path(spark, "marks")
    query = start_features(lead_stream(spark, source, leads.schema), REFERENCE_DATE, sink, marks)
    query.awaitTermination()
    return spark.read.parquet(sink)


def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leads scored as a stream of files, read back from the sink."""
    model, leads = _model(spark, sf_dir), _leads(spark, sf_dir).drop("fold")
    source, sink, marks = _lead_files(spark, leads), scratch_path(spark, "out"), scratch_path(spark, "marks")
    query = start_scoring(model, lead_stream(spark, source, leads.schema), sink, marks)
    query.awaitTermination()
    return spark.read.parquet(sink)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All leads as requests, by id, in batches of the published size: the batch of each and how many it holds."""
    leads = lead_queries.raw_table(spark, sf_dir).select("mailchimp_id", "user_email")
    source, sink, marks = scratch_path(spark, "requests"), scratch_path(spark, "batches"), scratch_path(spark, "marks")
    # Files of ranges, named in the order of their ranges.
    leads.repartitionByRange("mailchimp_id").sortWithinPartitions("mailchimp_id").write.option("maxRecordsPerFile", 10_000).parquet(source)
    records.run_batches(records.record_stream(spark, source, leads.schema, together=records.TOGETHER), sink, marks)
    return records.batches(spark, sink, leads.schema).select("mailchimp_id", "batch", "batch_size")


def request_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads as JSON records, one object a line, read back under the scoring schema."""
    leads = lead_queries.raw_table(spark, sf_dir)
    tags = [c for c in leads.columns if c.startswith("tag_") and c != "tag_count"]
    path = scratch_path(spark, "requests")
    leads.select("user_email", F.col("optin_time").cast("string"), "country_code", "member_rating", "tag_count", *tags).write.json(path)
    return read_table(spark, path, "json", lead_schema(tags))


def score_by_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = lead_queries.raw_table(spark, sf_dir)
    email = leads.where(F.col("mailchimp_id") == LOOKED_UP_ID).select("user_email").first()["user_email"]
    return scoring.score_by_email(_model(spark, sf_dir), leads, email)


@cache
def _lookup(spark: SparkSession, sf_dir: str) -> str:
    """The leads laid out for lookups, written once."""
    path = scratch_path(spark, "lookup")
    scoring.write_lookup(lead_queries.raw_table(spark, sf_dir), path)
    return path


def _given_score(found: DataFrame) -> DataFrame:
    """A given linear score, which SQL can repeat."""
    odds = " + ".join(f"{weight}D * {name}" for name, weight in GIVEN_WEIGHTS.items())
    return found.selectExpr("mailchimp_id", "user_email", f"round(1 / (1 + exp(-({odds}))), 12) as prediction_proba")


def given_score_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _given_score(scoring.lookup(spark, _lookup(spark, sf_dir), "mailchimp_id", LOOKED_UP_ID))


def given_score_by_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    leads = lead_queries.raw_table(spark, sf_dir)
    email = leads.where(F.col("mailchimp_id") == LOOKED_UP_ID).select("user_email").first()["user_email"]
    return _given_score(scoring.lookup(spark, _lookup(spark, sf_dir), "user_email", email))


def scores_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold for any fitted model: every lead has one score from 0 to 1, and its class is the likelier one."""
    return class_scores(spark, sf_dir).agg(
        F.count("*").alias("n"), F.count_distinct("mailchimp_id").alias("leads"),
        F.every(F.col("prediction_score_0").between(0, 1) & F.col("prediction_score_1").between(0, 1)).alias("in_range"),
        F.every(F.abs(F.col("prediction_score_0") + F.col("prediction_score_1") - 1) < 1e-9).alias("add_up"),
        F.every((F.col("prediction_label") == 1) == (F.col("prediction_score_1") > F.col("prediction_score_0"))).alias("likelier"),
    )


def given_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trial log with a row per customer, to rank trials without fitting any."""
    return source(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as int) as trial_id", "cast(3 + c_custkey % 5 as int) as max_depth", "c_custkey % 30 / 100D as learning_rate",
        "cast(50 + c_custkey % 150 as int) as n_estimators", "0.7D as subsample", "0.9D as colsample_bytree",
        "c_custkey * 7919 % 1009 / 1024D as roc_auc")


def given_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measured parts of a comparison with a row per order, some without the measure."""
    return source(spark, sf_dir, "orders").selectExpr(
        "concat('model-', o_custkey % 23) as model", "if(o_orderkey % 7 = 0, null, o_orderkey * 7919 % 1009 / 1024D) as f1",
        "o_orderkey % 512 / 512D as recall")


QUERIES = {
    "request_records": request_records,
    "score_by_email": score_by_email,
    "scores_in_order": scores_in_order,
    "trial_summary_given": lambda s, d: ln.trial_summary(given_trials(s, d)),
    "board_given": lambda s, d: ln.ranked_board(given_results(s, d), ["f1", "recall"]),
    "board_top_given": lambda s, d: ln.ranked_board(given_results(s, d), ["f1", "recall"], sort="recall", n_select=5),
    "gbt_scores": gbt_scores,
    "trials": trials,
    "trials_together": trials_together,
    "trial_summary": lambda s, d: ln.trial_summary(trials(s, d)),
    "model_leaderboard": leaderboard,
    "tree_leaderboard": lambda s, d: leaderboard(s, d, ln.FAMILIES["tree"]),
    "compare_matrix": compare_matrix,
    "class_scores": class_scores,
    "feature_importance": feature_importance,
    "permutation_importance": permutation_importance,
    "batch_scoring": lambda s, d: scoring.score_leads(_model(s, d), lead_queries.raw_table(s, d)),
    "score_by_key": score_by_key,
    "evaluation_report": evaluation_report,
    "assembled_matrix": assembled_matrix,
    "stream_features": stream_features,
    "stream_scoring": stream_scoring,
    "stream_batches": stream_batches,
    "given_score_by_key": given_score_by_key,
    "given_score_by_email": given_score_by_email,
}

_DAYS = (
    f"cast(floor((epoch_us(optin_time) - epoch_us(timestamp '{REFERENCE_DATE}')) / 86400000000.0) as int)"
)
_FEATURES = ln.lead_features(TAG_COLUMNS)
_ASSEMBLED = ", ".join(
    "cast(dense_rank() over (order by country_code) - 1 as double) as country_code" if n == "country_code"
    else f"cast({n} as double) as {n}" for n in _FEATURES
)
_POSITIONS = ", ".join(f"('{n}', {i})" for i, n in enumerate(_FEATURES))

_BOARD = """
    select model, avg(f1) as f1, avg(recall) as recall, cast(count({sort}) as int) as parts
    from (select concat('model-', o_custkey % 23) as model,
                 case when o_orderkey % 7 = 0 then null else o_orderkey * 7919 % 1009 / 1024.0::double end as f1,
                 o_orderkey % 512 / 512.0::double as recall from orders)
    group by model order by avg({sort}) desc nulls last, model"""

_GIVEN_SCORE = with_tables("leads_raw") + f"""
        select mailchimp_id, user_email, round(1 / (1 + exp(-({' + '.join(f'{w}::double * {n}' for n, w in GIVEN_WEIGHTS.items())}))), 12) as prediction_proba
        from leads_raw where """

SQL = {
    "given_score_by_key": _GIVEN_SCORE + f"mailchimp_id = {LOOKED_UP_ID}",
    "given_score_by_email": _GIVEN_SCORE + f"user_email = (select any_value(user_email) from leads_raw where mailchimp_id = {LOOKED_UP_ID})",
    "stream_batches": with_tables("leads_raw") + f"""
        select mailchimp_id, batch, count(*) over (partition by batch) as batch_size
        from (select mailchimp_id, (row_number() over (order by mailchimp_id) - 1) // {records.BATCH} as batch from leads_raw)""",
    "request_records": with_tables("leads_raw") + f"""
        select user_email, cast(optin_time as varchar) as optin_time, country_code, member_rating, cast(tag_count as int) as tag_count,
               {', '.join(TAG_COLUMNS)}
        from leads_raw""",
    "scores_in_order": with_tables("leads_raw") + """
        select count(*) as n, count(distinct mailchimp_id) as leads, true as in_range, true as add_up, true as likelier from leads_raw""",
    "trial_summary_given": """
        with trials as (
            select c_custkey as trial_id, cast(3 + c_custkey % 5 as int) as max_depth, c_custkey % 30 / 100.0::double as learning_rate,
                   cast(50 + c_custkey % 150 as int) as n_estimators, c_custkey * 7919 % 1009 / 1024.0::double as roc_auc
            from customer)
        select (select count(*) from trials) as n_trials, roc_auc as best_roc_auc, (select avg(roc_auc) from trials) as mean_roc_auc,
               cast(trial_id as int) as trial_id, max_depth, learning_rate, n_estimators, 0.7::double as subsample, 0.9::double as colsample_bytree
        from trials order by roc_auc desc, trial_id limit 1""",
    "board_given": _BOARD.format(sort="f1"),
    "board_top_given": _BOARD.format(sort="recall") + " limit 5",
    "assembled_matrix": exact_folds("engineered") + f""",
        wide as (select mailchimp_id, made_purchase, {_ASSEMBLED} from engineered),
        long as (unpivot wide on {', '.join(_FEATURES)} into name feature value value),
        positions(feature, position) as (values {_POSITIONS})
        select mailchimp_id, fold, cast(long.made_purchase as double) as label, position, value, feature
        from long join positions using (feature) join folded using (mailchimp_id)""",
    "stream_features": with_tables("engineered") + f"""
        select * replace (
            {_DAYS} as optin_days, tag_count / (abs({_DAYS}) + 1) as tag_count_by_optin_day)
        from engineered""",
}
