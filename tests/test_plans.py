"""Shape of the physical plans, and the whole analysis."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import tables as t
from proxysift import AnalysisParams
from proxysift import operators as op
from proxysift.plans import detect_anomalies, run_analysis, train
from proxysift.session import durable, shared_folder

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records") / "table")
    t.proxy_view(spark, SF).write.parquet(path)
    return path


def test_cleaning_is_pushed_into_the_scan(spark, stored):
    text = plan(op.clean_records(spark.read.parquet(stored)))
    for name in ("timestamp", "cIp", "csHost", "csUriPath"):
        assert f"IsNotNull({name})" in text.split("PushedFilters")[1].split("ReadSchema")[0]
    columns = text.split("FileScan parquet [")[1].split("]")[0]
    assert "csUriQuery" in columns and "event_id" not in columns and "csUriExtension" not in columns


def test_words_need_no_shuffle_and_no_python(spark, stored):
    records = op.clean_records(spark.read.parquet(stored))
    worded = op.with_words(records, durable(t.ranked(spark, SF)), durable(op.agent_counts(records)))
    text = plan(worded)
    assert "Exchange hash" not in text and "SortMergeJoin" not in text
    assert text.count("BroadcastHashJoin") == 2
    assert "EvalPython" not in text
    counted = plan(op.document_word_counts(worded))
    assert counted.count("regexp_extract_all") == 1
    assert counted.count("Exchange hashpartitioning") == 1


def test_analysis_input_is_made_once_and_spread(spark, tmp_path):
    """One row group of events: every core has a share, and cleaning reads stored columns."""
    for name in ("events", "pages"):
        t.table(spark, SF, name).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    records = t.cleaned(spark, str(tmp_path))
    assert "Join" not in plan(records) and "regexp" not in plan(records)
    files = t.stored_view(spark, str(tmp_path)).groupBy("_metadata.file_path").agg(F.count("*").alias("rows"))
    sizes = [row.rows for row in files.collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and max(sizes) < 2 * min(sizes)
    whole = op.clean_records(t.proxy_view(spark, str(tmp_path)))
    assert records.exceptAll(whole).isEmpty() and whole.exceptAll(records).isEmpty() and not whole.isEmpty()


def test_lines_are_split_once(spark):
    parsed = op.parse_lines(t.raw_lines(spark, SF))
    assert plan(op.record_table(parsed)).count("array_remove") == 1
    assert plan(op.rejected(parsed)).count("array_remove") == 1


def test_normalisation_has_no_single_topic_window(spark):
    weights = spark.range(100).select(
        F.col("id").cast("string").alias("word"), F.lit(0).alias("topic"), F.lit(1.0).alias("weight")
    )
    assert "Window" not in plan(op.normalise_weights(weights))


def test_analysis_end_to_end(spark, stored, tmp_path):
    params = AnalysisParams(topics=4, iterations=5, model_path=str(tmp_path / "model"))
    records = op.clean_records(spark.read.parquet(stored))
    ranked = durable(t.ranked(spark, SF))
    trained = train(records, ranked, params)
    for row in trained.probs.collect():
        assert len(row.topic_probs) == 4 and all(0 <= p <= 1 for p in row.topic_probs)
    found = detect_anomalies(records, ranked, params)
    scores = [row.score for row in found.collect()]
    assert scores == sorted(scores) and all(0 <= s <= 0.5 for s in scores)
    assert found.columns == [*records.columns, "word", "score"]
    assert len(scores) == op.with_valid_word(trained.worded).count()
    assert (tmp_path / "model" / "metadata").exists()
    scored = op.score_records(trained.worded, trained.mix, trained.probs, 4)
    by_records = sorted(row.score for row in op.filter_suspicious(scored).collect())
    first = detect_anomalies(records, ranked, AnalysisParams(topics=4, iterations=5, top=7))
    assert first.count() == 7 and "TakeOrderedAndProject" in plan(first)
    assert len(by_records) == len(scores)


def test_analysis_as_a_job(spark, stored, tmp_path):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir()) if folder.exists() else set()
    records = op.clean_records(spark.read.parquet(stored))
    out = str(tmp_path / "out")
    run_analysis(spark, records, t.ranked(spark, SF), AnalysisParams(topics=4, iterations=3, top=5), out)
    assert spark.read.parquet(out).count() == 5
    assert set(folder.iterdir()) == before


def test_analysis_with_drawn_documents(spark, stored):
    """The whole analysis by the fit that reads what it draws; only folders and sizes differ."""
    params = AnalysisParams(topics=4, iterations=4, optimizer="drawn", batch=0.2, threshold=1.0)
    records = op.clean_records(spark.read.parquet(stored))
    found = durable(detect_anomalies(records, durable(t.ranked(spark, SF)), params))
    assert op.out_of_order(found).first()["within"] == 0
    trained = train(records, durable(t.ranked(spark, SF)), params)
    assert found.count() == op.with_valid_word(trained.worded).count()
    shares = trained.mix.select(F.aggregate("topic_prob_mix", F.lit(0.0), lambda a, b: a + b).alias("s")).collect()
    assert all(abs(row.s - 1) < 1e-9 for row in shares)
