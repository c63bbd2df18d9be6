from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from propensa.__main__ import main
from propensa.operators.columns import MissingColumns
from propensa.operators.split import TEST, fold_rows, split_exact
from propensa.plans import evaluate as ev
from propensa.plans import jobs, scoring
from propensa.plans import learning as ln
from propensa.session import stored
from propensa.sources import standins, tables
from propensa.sources.registry import ModelRegistry, latest_artifacts
from propensa.sources.schemas import lead_schema
from propensa.streaming.scoring import lead_stream, start_scoring

PARAMS = {"max_depth": 3, "learning_rate": 0.3, "n_estimators": 8, "subsample": 1.0, "colsample_bytree": 1.0}


@pytest.fixture(scope="module")
def leads(spark):
    """Leads whose label depends on the rating and on one tag."""
    h = F.col("id") * 7919 % 1013
    rating = (1 + h % 5).cast("int")
    tag = (h % 3 == 0).cast("int")
    df = spark.range(600).select(
        F.col("id").alias("mailchimp_id"),
        F.concat(F.lit("u"), "id", F.lit("@gmail.com")).alias("user_email"),
        F.date_add(F.lit("2019-01-01").cast("date"), (h % 400).cast("int")).cast("timestamp").alias("optin_time"),
        F.when(h % 2 == 0, "us").when(h % 7 == 0, "zz").otherwise("de").alias("country_code"),
        rating.alias("member_rating"), tag.cast("long").alias("tag_count"), tag.alias("tag_a"),
        F.lit(None).cast("int").alias("tag_b"),
        ((rating >= 4) | (tag == 1)).cast("int").alias("made_purchase"),
    )
    return split_exact(df, "made_purchase", "mailchimp_id").cache()


@pytest.fixture(scope="module")
def fitted(leads):
    featurizer = ln.fit_featurizer(leads)
    table = ln.training_table(leads, featurizer)
    return featurizer, table, ln.refit(table, PARAMS)


@pytest.fixture(scope="module")
def registry(spark, fitted, tmp_path_factory):
    featurizer, table, model = fitted
    registry = ModelRegistry(spark, str(tmp_path_factory.mktemp("models")))
    for day, params in ((1, {"old": 1}), (2, PARAMS)):
        registry.register(
            PipelineModel(stages=[*featurizer.pipeline.stages, model]), featurizer.features, featurizer.fields,
            featurizer.reference_date, params, {"roc_auc": 0.5}, 480, 120, now=datetime(2024, 1, day),
        )
    return registry


def test_trial_parameters_are_reproducible():
    trials = ln.sample_trials()
    assert len(trials) == 12
    # The published best parameters are the sixth draw.
    assert trials[5] == {
        "max_depth": 3, "learning_rate": 0.11281253075766182, "n_estimators": 163,
        "subsample": 0.991209407318471, "colsample_bytree": 0.9679363363966593,
    }
    assert all(3 <= t["max_depth"] <= 7 and 50 <= t["n_estimators"] < 200 for t in trials)


def test_model_learns(fitted):
    _, table, model = fitted
    found = ln.evaluate_scores(ln.scored(model, fold_rows(table, TEST)))
    assert found["roc_auc"] > 0.95 and found["f1_score"] > 0.9


def test_feature_order(fitted):
    featurizer, table, _ = fitted
    assert featurizer.features == [
        "member_rating", "country_code", "tag_count", "tag_a", "tag_b", "optin_days", "optin_month",
        "optin_day_of_week", "optin_day_of_year", "optin_quarter", "optin_is_weekend", "is_free_email",
        "tag_count_by_optin_day",
    ]
    assert table.first()["features"].size == len(featurizer.features)


def test_trials_and_summary(spark, fitted):
    _, table, _ = fitted
    space = {**ln.SEARCH_SPACE, "n_estimators": ("integer", 2, 4), "max_depth": ("integer", 2, 4)}
    trials = ln.run_trials(table, ln.sample_trials(2, space=space), workers=2)
    rows = sorted(trials.collect(), key=lambda r: r["trial_id"])
    summary = ln.trial_summary(trials).first()
    assert [r["trial_id"] for r in rows] == [0, 1] and summary["n_trials"] == 2
    assert summary["best_roc_auc"] == max(r["roc_auc"] for r in rows)
    best = max(rows, key=lambda r: r["roc_auc"])
    assert ln.best_params(trials)["learning_rate"] == best["learning_rate"]


@pytest.fixture
def fitted_on(monkeypatch):
    """Partition sizes of the rows that each fit gets, and its parameters; the fit itself is Spark's."""
    seen = []
    trees = ln.boosted_trees

    class Noted:
        def __init__(self, params, seed):
            self.params, self.estimator = params, trees(params, seed)

        def fit(self, rows):
            seen.append((self.params, sorted(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()), sorted(map(str, rows.collect()))))
            return self.estimator.fit(rows)

    monkeypatch.setattr(ln, "boosted_trees", lambda params, seed=ln.MODEL_SEED: Noted(params, seed))
    return seen


def _uneven(fitted):
    """A training table in two files of very unequal size, most of its keys missing and some rows twice."""
    _, table, _ = fitted
    rows = table.withColumn("mailchimp_id", F.expr("if(mailchimp_id % 3 = 0, mailchimp_id, null)"))
    twice = rows.unionAll(rows.filter("mailchimp_id % 6 = 0"))
    place = F.expr("if(mailchimp_id = 9, 1, 0)")
    return stored(twice.repartitionByRange(2, place))


def test_large_fits_pass_over_even_tasks(spark, fitted, fitted_on, monkeypatch):
    table = _uneven(fitted)
    kept = sorted(map(str, fold_rows(table, "train", "val").collect()))
    monkeypatch.setattr(ln, "SPREAD_ROWS", 100, raising=False)
    monkeypatch.setattr(ln, "LEAST_TASK_ROWS", 100, raising=False)
    models = [ln.refit(table, {**PARAMS, "n_estimators": 2, "subsample": 0.8}).toDebugString.split("\n", 1)[1] for _ in range(2)]
    (_, sizes, rows), (_, again, _) = fitted_on
    assert rows == kept and sizes == again and sum(sizes) == len(kept)
    assert len(sizes) == len(kept) // 100 and max(sizes) < 2 * min(sizes)
    assert models[0] == models[1]
    monkeypatch.setattr(ln, "MOST_TASK_ROWS", 10, raising=False)
    monkeypatch.setattr(ln, "LEAST_TASK_ROWS", 1, raising=False)
    cores = spark.sparkContext.defaultParallelism
    assert ln.spread(fold_rows(table, "train", "val")).rdd.getNumPartitions() == cores * -(-len(kept) // (10 * cores))


def test_small_fits_stay_as_they_lie(fitted):
    rows = fold_rows(_uneven(fitted), "train", "val")
    assert ln.spread(rows) is rows


def test_save_and_load_give_equal_scores(leads, fitted, registry):
    featurizer, _, model = fitted
    loaded = registry.load()
    before = PipelineModel(stages=[*featurizer.pipeline.stages, model]).transform(leads)
    a = {r[0]: r[1] for r in before.select("mailchimp_id", "probability").collect()}
    b = {r[0]: r[1] for r in scoring.score(loaded, leads).select("mailchimp_id", "prediction_proba").collect()}
    assert all(abs(a[k][1] - b[k]) < 1e-12 for k in a)


def test_registry_picks_the_newest(registry):
    assert registry.entries().count() == 2
    loaded = registry.load()
    assert loaded.metadata["stamp"] == "20240102_000000" and loaded.metadata["params"] == PARAMS
    assert registry.load("gbt_best_20240101_000000").metadata["params"] == {"old": 1}
    with pytest.raises(FileNotFoundError):
        registry.load("none")
    assert jobs.health(registry)["status"] == "ok"


def test_empty_registry(spark, tmp_path):
    assert jobs.health(ModelRegistry(spark, str(tmp_path / "none")))["status"] == "error"


def test_latest_artifacts(spark):
    names = spark.createDataFrame(
        [("m_20240101_000000.x",), ("m_20240103_000000.x",), ("m_latest.x",)], "name string"
    )
    assert tuple(latest_artifacts(names).first()) == ("20240103_000000", "m_20240103_000000.x")
    assert latest_artifacts(names.filter("name = 'm_latest.x'")).count() == 0


def test_scoring_one_lead_uses_the_fitted_date(leads, registry):
    model = registry.load()
    everyone = {r[0]: r[1] for r in scoring.score_leads(model, leads).collect()}
    alone = scoring.score_by_email(model, leads, "u7@gmail.com").first()
    assert alone["prediction_proba"] == everyone["u7@gmail.com"]
    by_id = scoring.score_by_id(model, leads, 7).first()
    assert (by_id["lead_id"], by_id["prediction_proba"]) == (7, everyone["u7@gmail.com"])
    assert all(0 <= p <= 1 for p in everyone.values())


def test_scoring_rejects_bad_input(spark, leads, registry):
    model = registry.load()
    with pytest.raises(ValueError, match="not an email"):
        scoring.score_by_email(model, leads, "nobody")
    with pytest.raises(ValueError, match="positive"):
        scoring.score_by_id(model, leads, 0)
    with pytest.raises(MissingColumns) as error:
        scoring.score_leads(model, leads.drop("tag_a", "country_code"))
    assert error.value.names == ["country_code", "tag_a"]
    unseen = leads.limit(1).withColumn("country_code", F.lit("fr"))
    with pytest.raises(Exception, match="(?i)unseen label|fr"):
        scoring.score_leads(model, unseen).collect()


def test_stream_equals_batch(spark, leads, registry, tmp_path):
    model = registry.load()
    source = leads.drop("fold")
    source.repartition(5).write.parquet(str(tmp_path / "in"))
    stream = lead_stream(spark, str(tmp_path / "in"), source.schema, max_files=2)
    query = start_scoring(model, stream, str(tmp_path / "out"), str(tmp_path / "marks"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    streamed = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert streamed == sorted(tuple(r) for r in scoring.score_leads(model, leads).collect())

    # A second run finds nothing new.
    again = start_scoring(model, stream, str(tmp_path / "out"), str(tmp_path / "marks"))
    again.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 600


def test_evaluation(spark, leads, registry, tmp_path):
    model = registry.load()
    result = ev.evaluate(model, fold_rows(leads, TEST))
    assert result.test_set_size == 120 and result.metrics["roc_auc"] > 0.95
    assert result.importance.count() == 13
    ev.write_report(model, result, str(tmp_path))
    report = spark.read.json(str(tmp_path / "evaluation_report")).first()
    stored = json.loads(report["evaluation_results"])
    assert stored["feature_importance"][0]["importance"] >= stored["feature_importance"][1]["importance"]
    assert json.loads(report["model_metadata"])["params"] == PARAMS


def test_permutation_importance(fitted):
    featurizer, table, model = fitted
    found = {r["feature"]: r["importance"] for r in ln.permutation_importance(model, table, featurizer.features).collect()}
    assert set(found) == set(featurizer.features)
    assert sorted(found, key=found.get)[-1] == "member_rating"
    assert abs(found["is_free_email"]) < 1e-12 and abs(found["tag_b"]) < 1e-12


def test_class_scores(fitted):
    _, table, model = fitted
    row = ln.class_scores(model, table).first()
    assert abs(row["prediction_score_0"] + row["prediction_score_1"] - 1) < 1e-9


def test_leaderboard(leads):
    setup = ln.CompareSetup(folds=2, iterations=3)
    table = ln.compare_table(leads, setup)
    board = ln.leaderboard(table, setup, include=["dt", "nb", "catboost"], sort="auc")
    rows = board.collect()
    assert {r["model"] for r in rows} == {"dt", "nb"}
    assert rows[0]["auc"] >= rows[1]["auc"]
    name, _, held_out = ln.fit_best(table, setup, board, "auc")
    assert name == rows[0]["model"]
    assert 0 < held_out.count() < 300
    assert ln.leaderboard(table, setup, include=["dt", "nb"], n_select=1).count() == 1


def test_jobs_end_to_end(spark, sf_dir, tmp_path):
    crm = standins.crm_standins(spark, sf_dir)
    for name in ("subscribers", "tags", "transactions"):
        tables.write_table(getattr(crm, name), str(tmp_path / "crm" / name), "csv")
    base = ["--crm-path", str(tmp_path / "crm"), "--format", "csv"]
    joined, results = str(tmp_path / "joined"), str(tmp_path / "results")
    main(["ingest", *base, "--output-path", joined], spark)
    main(["test-all", *base, "--input-path", joined, "--results-path", results], spark)
    assert spark.read.json(results).select("suite").distinct().count() == 5
    main(["preprocess", *base, "--input-path", joined, "--raw-output-path", str(tmp_path / "raw"),
          "--cleaned-output-path", str(tmp_path / "clean"), "--fitted-path", str(tmp_path / "fitted")], spark)
    main(["preprocess", *base, "--input-path", joined, "--raw-output-path", str(tmp_path / "raw2"),
          "--cleaned-output-path", str(tmp_path / "clean2"), "--fitted-path", str(tmp_path / "fitted"),
          "--apply"], spark)
    clean, again = (spark.read.parquet(str(tmp_path / n)) for n in ("clean", "clean2"))
    assert clean.columns == again.columns and clean.exceptAll(again).count() == 0
    raw = spark.read.parquet(str(tmp_path / "raw"))
    registry = ModelRegistry(spark, str(tmp_path / "models"))
    space = {**ln.SEARCH_SPACE, "n_estimators": ("integer", 2, 4)}
    model_id = jobs.train(
        raw, registry, str(tmp_path / "test"), str(tmp_path / "trials"), num_trials=2, space=space
    )
    entry = registry.load(model_id).metadata
    total = raw.count()
    assert entry["training_samples"] + spark.read.parquet(str(tmp_path / "test")).count() == total
    main(["evaluate", "--registry", str(tmp_path / "models"), "--test-path", str(tmp_path / "test"),
          "--output-path", str(tmp_path / "evaluation")], spark)

    # Requests as JSON records.
    tag_fields = [c for c in raw.columns if c.startswith("tag_") and c != "tag_count"]
    fields = lead_schema(tag_fields).fieldNames()
    raw.fillna(0).select(*fields).write.json(str(tmp_path / "requests"))
    main(["score", "--registry", str(tmp_path / "models"), "--json", "--input-path", str(tmp_path / "requests"),
          "--output-path", str(tmp_path / "scores")], spark)
    scores = spark.read.json(str(tmp_path / "scores"))
    assert scores.columns == ["prediction_proba", "user_email"] and scores.count() == total
    main(["health", "--registry", str(tmp_path / "models")], spark)


def test_a_search_goes_on_where_it_stopped(spark, fitted, tmp_path, monkeypatch):
    _, table, _ = fitted
    space = {**ln.SEARCH_SPACE, "n_estimators": ("integer", 1, 3), "max_depth": ("integer", 1, 3)}
    params, log = ln.sample_trials(12, space=space), str(tmp_path / "log")
    fits, build = [], ln.boosted_trees

    def counted(chosen, seed):
        if len(fits) == limit:
            raise RuntimeError("driver lost")
        fits.append(chosen)
        return build(chosen, seed)

    monkeypatch.setattr(ln, "boosted_trees", counted)
    limit = 5
    with pytest.raises(RuntimeError, match="driver lost"):
        ln.run_trials(table, params, workers=1, log=log)
    assert ln.logged_trials(spark, log).count() == 5
    limit = 100
    resumed = ln.run_trials(table, params, workers=3, log=log)
    assert len(fits) == 12
    whole = ln.run_trials(table, params, workers=3)
    kept = [c for c in whole.columns if c != "seconds"]
    assert resumed.select(kept).collect() == whole.select(kept).collect() and len(fits) == 24
    assert ln.run_trials(table, params, log=log).select(kept).collect() == whole.select(kept).collect() and len(fits) == 24
    # Other rows, or another seed, are another search.
    ln.run_trials(table.filter("mailchimp_id % 10 > 0"), params[:1], log=log)
    ln.run_trials(table, params[:1], seed=1, log=log)
    assert len(fits) == 26
