from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from data import COLUMNS, frame, prose
from test_native import ITEM, plain_leaks
from test_ngram_join import plain_components

from propensa.llm import language, mixing
from propensa.llm.tables import read


def written(spark, df, tmp_path, name):
    path = f"{tmp_path}/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A folder of tables with rejects, copies, leaks and sources."""
    folder = tmp_path_factory.mktemp("corpus")
    rows = [(i, prose(i, 80 + i % 50), "en" if i % 4 else "de", f"s{i % 3}", 1) for i in range(120)]
    rows += [(200 + i, rows[i][1], "en", "s0", 1) for i in range(0, 30, 3)]
    rows += [(300 + i, prose(300 + i, 30) + "\n" + ITEM + "\n" + prose(400 + i, 20), "en", "s1", 1) for i in range(5)]
    rows += [(400, None, "en", "s0", 1), (401, "", "en", "s0", 1), (402, "12 34 !! ..", "en", "s0", 1)]
    frame(spark, rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, ITEM)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows


def test_stages_one_by_one(spark, small, tmp_path):
    folder, rows = small
    docs = read(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "decontamination", "mixing", "tokens"]

    kept = written(spark, stages["language"](spark, docs, folder), tmp_path, "1")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {400, 401, 402}  # without a letter

    one = written(spark, stages["near_duplicates"](spark, kept, folder), tmp_path, "2")
    assert one.columns == docs.columns
    before = [tuple(r) for r in kept.collect()]
    heads = {component for some, i, n, component in plain_components(before) if component == i}
    assert sorted(r.doc_id for r in one.collect()) == sorted(heads)

    clean = written(spark, stages["decontamination"](spark, one, folder), tmp_path, "3")
    assert clean.columns == docs.columns
    leaked = {d for d, _ in plain_leaks([tuple(r) for r in one.collect()], [(0, ITEM)])}
    assert leaked == set(range(300, 305))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - leaked

    mix = written(spark, stages["mixing"](spark, clean, folder), tmp_path, "4")
    assert mix.columns == docs.columns
    wanted = Counter({r.doc_id: r.taken // r.size for r in mixing.taken(mixing.assign(mixing.sized(clean))).collect() if r.taken})
    assert Counter(r.doc_id for r in mix.collect()) == wanted

    tokens = written(spark, stages["tokens"](spark, mix, folder), tmp_path, "5")
    assert Counter(r.doc_id for r in tokens.collect()) == wanted


def test_run_gives_the_last_stage(spark, small):
    folder, _ = small
    rows = corpus_pipeline.run(spark, folder).collect()
    assert sum(r.n_tokens for r in rows) == max(r.start + r.n_tokens for r in rows)
    assert corpus_pipeline.queries().keys() == {"pipeline"} and corpus_pipeline.oracle_sql() == {}


def test_clean_documents_stay(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, sf_dir).collect()}
    lettered = {r.doc_id for r in docs.collect() if any(map(str.isalpha, r.text or ""))}
    assert len(lettered - kept) <= 0.02 * len(lettered)


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "mixing", "tokens"])
def test_stages_of_an_empty_table(spark, small, name):
    folder, _ = small
    docs = read(spark, folder, "documents")
    assert dict(corpus_pipeline.STAGES)[name](spark, docs.limit(0), folder).count() == 0


def test_rejected_by_score_only_below_chance():
    assert corpus_pipeline.LEAST_SCORE <= 0.3 and language.UNKNOWN == "und"
