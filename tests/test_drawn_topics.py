"""The model that reads only what it draws, against plain loops and Spark's own models."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import tables as t
from proxysift import AnalysisParams
from proxysift import operators as op
from proxysift.operators import drawn_topics as dt
from proxysift.session import durable, shared_folder
from proxysift.sources import save_model

SF = "/root/testdata/sf0.001"
K = 4


def test_digamma_and_trigamma():
    points = np.array([0.01, 0.5, 1.0, 3.3, 6.0, 40.0, 1e6])
    slope = [(math.lgamma(x * (1 + 1e-6)) - math.lgamma(x * (1 - 1e-6))) / (2e-6 * x) for x in points]
    assert np.allclose(dt.digamma(points), slope, rtol=1e-6)
    assert abs(dt.digamma(np.array([1.0]))[0] + 0.5772156649015329) < 1e-9
    step = 1e-5 * points
    assert np.allclose(dt.trigamma(points), (dt.digamma(points + step) - dt.digamma(points - step)) / (2 * step), rtol=1e-4)


@pytest.fixture(scope="module")
def corpus(spark):
    counts = t.word_counts(spark, SF)
    words = durable(op.word_dictionary(counts))
    entries = durable(op.lookup_join(counts, words, "word", "inner").select(
        "clientip", F.col("word_number").cast("bigint").alias("word_number"), "word_count"
    ))
    return counts, words, entries


def test_draws(spark):
    documents = spark.range(20_000).select(F.col("id").cast("string").alias("d"))
    drawn = documents.select("d", dt.drawn_iterations(F.col("d"), 50, 0.02, 5).alias("i"))
    rows = {r.d: r.i for r in drawn.collect()}
    assert all(i == sorted(set(i)) and all(1 <= x <= 50 for x in i) for i in rows.values())
    sizes = [sum(x in i for i in rows.values()) for x in (1, 25, 50)]
    assert all(abs(size - 400) < 100 for size in sizes)
    assert rows == {r.d: r.i for r in drawn.collect()}
    assert rows != {r.d: r.i for r in documents.select("d", dt.drawn_iterations(F.col("d"), 50, 0.02, 6).alias("i")).collect()}
    assert documents.limit(1).select(dt.drawn_iterations(F.col("d"), 3, 1.0, 1)).first()[0] == [1, 2, 3]


def plain(entries, words, documents, params, fraction):
    """The same fit with the whole matrix of weights in one loop."""
    drawn = {}
    batches = entries.select("*", F.explode(dt.drawn_iterations(F.col("clientip"), params.iterations, fraction, params.seed)).alias("i"))
    for row in batches.collect():
        drawn.setdefault(row.i, {}).setdefault(row.clientip, []).append((row.word_number, row.word_count))
    alpha, eta = np.full(K, params.alpha), params.beta
    weights = np.array([dt.first_weights(w, K, params.seed) for w in range(words)])
    for i in range(1, params.iterations + 1):
        rate, gained, logs = (1024 + i) ** -0.51, np.zeros((words, K)), np.zeros(K)
        beta = np.exp(dt.digamma(weights) - dt.digamma(weights.sum(axis=0)))
        for tokens in drawn.get(i, {}).values():
            at, n = [w for w, _ in tokens], np.array([c for _, c in tokens], dtype=float)
            gamma, shares = dt.document_topics(n, beta[at], alpha)
            gained[at] += shares
            logs += dt.digamma(gamma) - dt.digamma(gamma.sum()[None])
        size = len(drawn.get(i, {}))
        weights = (1 - rate) * weights + rate * (eta + gained * (documents / size if size else 0))
        if size:
            alpha = dt._updated_alpha(alpha, logs, size, rate)
    return weights, alpha


@pytest.mark.parametrize("fraction", [0.02, 0.5])
def test_fit_equals_a_plain_loop(corpus, fraction):
    _, words, entries = corpus
    documents = entries.select("clientip").distinct().count()
    params = AnalysisParams(topics=K, iterations=6, alpha=0.5, beta=0.5, seed=3)
    model = op.fit_drawn(entries, words, documents, params, fraction)
    size = words.count()
    weights, alpha = plain(entries, size, documents, params, fraction)
    found = {r.word_number: r.weights for r in model.weights.collect()}
    assert sorted(found) == list(range(size))
    assert np.allclose([found[w] for w in range(size)], weights, rtol=1e-9)
    assert np.allclose(model.alpha, alpha, rtol=1e-9) and np.allclose(model.totals, weights.sum(axis=0), rtol=1e-9)
    # What an iteration reads are the rows of the documents it draws.
    rows = entries.count()
    assert all((r == 0) == (d == 0) for r, d in zip(model.rows_read, model.documents, strict=True))
    assert sum(model.rows_read) < 2 * rows * params.iterations * fraction + 100
    assert sum(model.documents) < 2 * documents * params.iterations * fraction + 10


def test_held_out_likelihood_is_that_of_sparks_fit(corpus, spark):
    counts, words, entries = corpus
    test = F.abs(F.xxhash64("clientip")) % 5 == 0
    train, held = entries.where(~test), entries.where(test)
    size = words.count()
    vectors = durable(op.vector_corpus(counts.where(~test), words, size))
    documents = vectors.count()
    params = AnalysisParams(topics=K, iterations=20, alpha=0.5, beta=0.5, batch=0.3, seed=11)
    model = op.fit_topics(vectors.persist(), documents, params)
    matrix = model.topicsMatrix().toArray()
    theirs = spark.createDataFrame([(w, row.tolist()) for w, row in enumerate(matrix)], "word_number bigint, weights array<double>")
    ours = op.fit_drawn(train, words, documents, params, 0.3)

    def judged(weights, alpha):
        return op.log_likelihood(held, op.mix_by_joins(held, weights, alpha), weights, K)

    a, b = judged(theirs, tuple(model.estimatedDocConcentration().toArray())), judged(ours.weights, ours.alpha)
    one = weights_of_one_topic(train)
    alone = op.log_likelihood(held, held.select(F.col("clientip").alias("document_name"), F.array(F.lit(1.0)).alias("topic_prob_mix")).distinct(), one, 1)
    assert abs(a - b) / abs(a) < 0.01
    assert b > alone - 0.5 and not math.isnan(b)


def weights_of_one_topic(train):
    """Every word's count, as a model with one topic; words of held-out rows alone are left out."""
    return durable(train.groupBy("word_number").agg(F.array(F.sum("word_count").cast("double")).alias("weights")))


@pytest.mark.parametrize("limit_bytes", [1 << 26, 0])
def test_mix_equals_sparks_transform(corpus, spark, limit_bytes):
    counts, words, entries = corpus
    size = words.count()
    vectors = durable(op.vector_corpus(counts, words, size))
    params = AnalysisParams(topics=K, iterations=10, alpha=0.5, beta=0.5, batch=0.5)
    model = op.fit_topics(vectors.persist(), vectors.count(), params)
    matrix = model.topicsMatrix().toArray()
    weights = spark.createDataFrame([(w, row.tolist()) for w, row in enumerate(matrix)], "word_number bigint, weights array<double>")
    found = op.mix_by_joins(entries, weights, tuple(model.estimatedDocConcentration().toArray()), tolerance=1e-6, limit_bytes=limit_bytes)
    want = {r.document_name: r.topic_prob_mix for r in op.topic_mix(model, vectors).collect()}
    mix = {r.document_name: r.topic_prob_mix for r in found.collect()}
    assert sorted(mix) == sorted(want)
    assert max(abs(a - b) for name in want for a, b in zip(mix[name], want[name], strict=True)) < 1e-3


def test_documents_side_by_side_settle_as_alone(monkeypatch):
    rng = np.random.default_rng(5)
    sizes = np.array([3, 1, 40, 7, 7, 300, 2, 1])
    counts, beta = rng.integers(1, 9, sizes.sum()).astype(float), rng.gamma(1.0, 1.0, (sizes.sum(), K))
    alpha = np.array([0.1, 0.5, 1.0, 2.0])
    for rows in (dt.BLOCK_ROWS, 50, 1):
        monkeypatch.setattr(dt, "BLOCK_ROWS", rows)
        for tolerance, steps in ((1e-3, 100), (1e-9, 4)):
            gamma, shares = dt.many_document_topics(sizes, counts, beta, alpha, tolerance, steps)
            at = 0
            for i, size in enumerate(sizes):
                one = slice(at, at := at + size)
                g, s = dt.document_topics(counts[one], beta[one], alpha, tolerance, steps)
                assert np.allclose(gamma[i], g, rtol=1e-9) and np.allclose(shares[one], s, rtol=1e-9)


def test_a_task_settles_many_documents(spark):
    """Few bytes are spread over the cores, and Python is not called per document."""
    entries = spark.range(20_000).select((F.col("id") / 10).cast("int").cast("string").alias("clientip"), F.lit(1).alias("n"))
    cores = spark.sparkContext.defaultParallelism

    def sized(rows):
        import pyarrow as pa

        return pa.table({"documents": [len(set(rows.column("clientip").to_pylist()))], "rows": [rows.num_rows]})

    found = dt.by_documents(entries, 20_000).applyInArrow(sized, "documents bigint, rows bigint")
    tasks = durable(found.select("*", F.spark_partition_id().alias("task")))
    assert tasks.agg(F.sum("documents"), F.sum("rows")).first()[:] == (2000, 20_000)
    assert tasks.count() <= 3 * 3 * cores and tasks.select("task").distinct().count() > cores


def test_large_documents_are_settled_by_joins(corpus, spark):
    """The same numbers where no document fits one task, and where some do."""
    _, words, entries = corpus
    some = durable(entries.where(F.xxhash64("clientip") % 6 == 0))
    weights = words.select("word_number", F.array(*[(F.abs(F.xxhash64("word", F.lit(i))) % 97 + 1).cast("double") for i in range(K)]).alias("weights"))
    sizes = sorted(r["count"] for r in some.groupBy("clientip").count().collect())

    def run(local_words, limit_bytes):
        found = op.mix_by_joins(some, weights, (0.5,) * K, 0.3, 6, limit_bytes, local_words)
        return {r.document_name: r.topic_prob_mix for r in found.collect()}

    want = run(10**6, 1 << 26)
    for local_words, limit_bytes in ((0, 0), (sizes[len(sizes) // 2], 1 << 26)):
        mix = run(local_words, limit_bytes)
        assert sorted(mix) == sorted(want)
        assert all(np.allclose(mix[name], want[name], rtol=1e-9) for name in want)


def test_topics_of_a_saved_distributed_model(corpus, spark):
    counts, words, _ = corpus
    vectors = durable(op.vector_corpus(counts, words, words.count()))
    model = op.fit_topics(vectors.persist(), vectors.count(), AnalysisParams(topics=K, iterations=4, optimizer="em"))
    path = f"{shared_folder(spark)}/em-model"
    save_model(model, path)
    read = op.saved_topic_weights(spark, path, words)
    want = {(r.word, r.topic): r.weight for r in op.topic_weights(model, words).collect()}
    found = {(r.word, r.topic): r.weight for r in read.collect()}
    assert sorted(found) == sorted(want) and all(abs(found[key] - want[key]) < 1e-9 for key in want)
    assert "LocalTableScan" not in read._jdf.queryExecution().executedPlan().toString()
