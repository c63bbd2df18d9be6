"""The command surface: each step reads tables, writes tables and returns what it wrote."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.ml import PipelineModel

from propensa.operators import quality as q
from propensa.operators.encode import Encoders
from propensa.operators.pivot import load_vocabulary, save_vocabulary, tag_vocabulary
from propensa.operators.split import TEST, TRAIN, VALIDATION, fold_rows, split_exact
from propensa.operators.summaries import conversion_rate
from propensa.plans import learning, suites
from propensa.plans.evaluate import Evaluation, evaluate, write_report
from propensa.plans.ingest import join_subscribers
from propensa.plans.prepare import KEY, TARGET, merge_tags, prepare_leads
from propensa.session import stored
from propensa.sources.registry import ModelRegistry
from propensa.sources.tables import CrmTables, preview, profile, read_table, write_table


def ingest(spark: SparkSession, crm: CrmTables, output_path: str, fmt: str = "parquet", verbose: bool = False) -> DataFrame:
    """Join the CRM tables and write one row per subscriber."""
    write_table(join_subscribers(crm), output_path, fmt)
    joined = read_joined(spark, output_path, fmt)
    if verbose:
        for name in ("subscribers", "tags", "transactions"):
            profile(getattr(crm, name), name).show(truncate=False)
            preview(getattr(crm, name)).show()
        conversion_rate(joined).show()
        preview(joined).show()
    return joined


def read_joined(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    from propensa.sources.schemas import SUBSCRIBERS_JOINED

    return read_table(spark, path, fmt, SUBSCRIBERS_JOINED)


def check_crm(crm: CrmTables, results_path: str | None = None, failing_path: str | None = None) -> DataFrame:
    """Quality suites of the raw tables, at the detail published for each.

    ``failing_path`` receives all failing transactions, the one suite reported in full.
    """
    checks = suites.transactions_suite()
    results = (
        q.validate(crm.subscribers, "subscribers", suites.subscribers_suite(), q.BASIC)
        .unionByName(q.validate(crm.tags, "tags", suites.tags_suite(), q.SUMMARY), allowMissingColumns=True)
        .unionByName(q.validate(crm.transactions, "transactions", checks, q.COMPLETE))
    )
    if failing_path:
        write_table(q.failing_rows(crm.transactions, checks), failing_path)
    return _finish(results, results_path)


def check_joined(joined: DataFrame, results_path: str | None = None) -> DataFrame:
    """Quality suite of the joined table."""
    return _finish(q.validate(suites.as_written(joined), "joined", suites.joined_suite()), results_path)


def check_business_rules(joined: DataFrame, results_path: str | None = None) -> DataFrame:
    results = q.validate(suites.with_domain(joined), "business_rules", suites.business_suite())
    return _finish(results, results_path)


def check_all(crm: CrmTables, joined: DataFrame, results_path: str | None = None) -> DataFrame:
    """All suites: raw tables, joined table and business rules."""
    results = (
        check_crm(crm)
        .unionByName(check_joined(joined), allowMissingColumns=True)
        .unionByName(check_business_rules(joined), allowMissingColumns=True)
    )
    return _finish(results, results_path)


def _finish(results: DataFrame, path: str | None) -> DataFrame:
    if path is None:
        return results
    kept = stored(results)
    q.write_results(kept, path)
    return kept


def preprocess(
    spark: SparkSession,
    joined: DataFrame,
    crm: CrmTables,
    raw_path: str,
    cleaned_path: str,
    fitted_path: str,
    fit: bool = True,
    reference_date: datetime | None = None,
) -> DataFrame:
    """Write the leads with their tags and the engineered leads.

    Fitting writes the tag vocabulary and the encoders under ``fitted_path``;
    otherwise those written there are applied.
    """
    tags_path, codes_path = f"{fitted_path}/tags", f"{fitted_path}/codes"
    if fit:
        vocabulary = tag_vocabulary(crm.tags)
        save_vocabulary(spark, vocabulary, tags_path)
    else:
        vocabulary = load_vocabulary(spark, tags_path)
    write_table(merge_tags(joined, crm.tags, vocabulary), raw_path)
    encoders = None if fit else Encoders.load(spark, codes_path)
    prepared = prepare_leads(spark.read.parquet(raw_path), encoders, fit, reference_date)
    if fit:
        prepared.encoders.save(codes_path)
    write_table(prepared.leads, cleaned_path)
    return spark.read.parquet(cleaned_path)


def train(
    leads: DataFrame,
    registry: ModelRegistry,
    test_path: str,
    trials_path: str | None = None,
    metric: str = "roc_auc",
    num_trials: int = learning.TRIALS,
    num_workers: int = learning.WORKERS,
    space: dict | None = None,
    now: datetime | None = None,
) -> str:
    """Split, search, refit the best parameters and register the model. Returns its id.

    The test leads are written untouched, so that evaluation runs the whole saved model. ``trials_path`` is the
    log of the search; started again with it, the search goes on where it stopped.
    """
    folded = stored(split_exact(leads, TARGET, KEY))
    write_table(fold_rows(folded, TEST), test_path)
    featurizer = learning.fit_featurizer(folded)
    table = learning.training_table(folded, featurizer)
    params = learning.sample_trials(num_trials, space=space)
    trials = stored(learning.run_trials(table, params, num_workers, log=trials_path))
    chosen = learning.best_params(trials, metric)
    model = learning.refit(table, chosen)
    best = trials.orderBy(F.desc(metric), "trial_id").first()
    sizes = {r["fold"]: r["count"] for r in table.groupBy("fold").count().collect()}
    return registry.register(
        PipelineModel(stages=[*featurizer.pipeline.stages, model]),
        features=featurizer.features,
        fields=featurizer.fields,
        reference_date=featurizer.reference_date,
        params=chosen,
        metrics={m: best[m] for m in ("f1", "recall", "roc_auc")},
        training_samples=sizes.get(TRAIN, 0) + sizes.get(VALIDATION, 0),
        validation_samples=sizes.get(VALIDATION, 0),
        now=now,
    )


def evaluate_latest(
    spark: SparkSession, registry: ModelRegistry, test_path: str, output_path: str, model_id: str | None = None
) -> Evaluation:
    """Evaluate a registered model (the newest by default) on the kept test leads."""
    model = registry.load(model_id)
    result = evaluate(model, spark.read.parquet(test_path))
    write_report(model, result, output_path)
    return result


def health(registry: ModelRegistry) -> dict[str, str]:
    """Whether a model can be loaded."""
    try:
        registry.load()
    except Exception:  # noqa: BLE001 - any reason means that no model is available
        return {"status": "error", "message": "no model could be loaded"}
    return {"status": "ok", "message": "model is loaded"}
