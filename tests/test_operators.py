"""Joins, dictionaries, corpus, topics and scoring on small inputs."""

import random

import pytest
from pyspark.sql import functions as F

from proxysift import AnalysisParams, schemas, sources
from proxysift import operators as op


def test_cleaning(spark):
    rows = [
        ("2018-07-01T12:00:00", "10.0.0.1", "h", None, None, None, "200", "/p", "?q", "x"),
        ("2018-07-01", "10.0.0.1", "h", "GET", "a", "t", "200", "/p", None, None),
        ("2018-07-01T12:00:00", "10.0.0.1", "h", "GET", "a", "t", "200", None, None, None),
        ("2018-07-01T12:00:00", "10.0.0.1", None, "GET", "a", "t", "200", "/p", None, None),
        (None, "10.0.0.1", "h", "GET", "a", "t", "200", "/p", None, None),
    ]
    clean = op.clean_records(spark.createDataFrame(rows, schemas.ANALYSIS_INPUT))
    assert clean.columns == list(schemas.CLEAN_COLUMNS)
    assert [tuple(r) for r in clean.collect()] == [
        ("2018-07-01", "12:00:00", "10.0.0.1", "h", None, "-", "-", "200", "h/p?q")
    ]


RECORDS = [
    # p_time, host, method, agent, content type, code
    ("07:10:00", "blog.shop.com", "GET", "a", "image/png", "200"),
    ("07:10:00", "www.intel.com", None, "a", "/", None),
    ("x", "blog.shop.com", "GET", "a", "image/png", "200"),
    ("08:00:00", "other.com", "POST", "missing", "-", "404"),
]


def records(spark):
    rows = [
        ("2018-07-01", time, "10.0.0.1", host, method, agent, kind, code, "abcdefgh")
        for time, host, method, agent, kind, code in RECORDS
    ]
    return spark.createDataFrame(rows, schemas.CLEAN)


def test_words(spark):
    ranked = spark.createDataFrame([("shop",)], "domain_label string")
    agents = spark.createDataFrame([("a", 9)], "useragent string, count bigint")
    words = [r.word for r in op.with_words(records(spark), ranked, agents).collect()]
    assert sorted(words) == sorted(
        ["1_7_GET_10_image_3_3_200", "2_7_null_10_unknown_content_type_3_3_unknown_response_code",
         "word_error", "word_error"]
    )


def test_domain_info(spark):
    ranked = spark.createDataFrame([("b",), ("shop",)], "domain_label string")
    hosts = spark.createDataFrame([("a.b.com",), ("www.shop.com",), ("localhost",)], "host string")
    info = {r.host: tuple(r.domain_info) for r in op.with_domain_info(hosts, ranked, "b").collect()}
    assert info["a.b.com"] == ("b", 2, "a", 1, 0.0, 3)
    assert info["www.shop.com"] == ("shop", 1, "www", 3, 0.0, 3)
    assert info["localhost"] == ("None", 0, "None", 0, 0.0, 1)


def test_ranked_list(spark, tmp_path):
    path = tmp_path / "ranked.csv"
    path.write_text("1,shop.com\n2,mail.example.com\nno comma\n3,shop.org,x\n4,\n")
    labels = sources.read_ranked_domains(spark, str(path)).collect()
    assert sorted(r.domain_label for r in labels) == ["mail", "shop"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_picks_join_by_measured_size(spark):
    left = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), "id")
    table = spark.range(5).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("v"))
    small, large = op.lookup_join(left, table, "k"), op.lookup_join(left, table, "k", limit_bytes=10)
    assert "BroadcastHashJoin" in _plan(small) and "SortMergeJoin" in _plan(large)
    assert "BroadcastHashJoin" not in _plan(large)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_hot_key_partition_is_split(spark):
    """A key with most of the rows is divided among tasks and no row is lost."""
    names = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5000)
        left = spark.range(0, 200000, 1, 8).select(key.alias("k"), "id")
        table = spark.range(5000).select(F.col("id").cast("bigint").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        joined = op.lookup_join(left, table, "k", limit_bytes=0)
        assert joined.groupBy().agg(F.count("v")).first()[0] == 200000
        rows = joined.collect()
        assert len(rows) == 200000
        assert "skew=true" in _plan(joined)
    finally:
        for name in names:
            spark.conf.unset(name)


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abcd", [1.0, 2.0]), (None, None)], "s string, a array<double>")
    assert op.measured_bytes(df) == 2 * 16 + 4 + 16
    assert op.measured_bytes(df.limit(0)) == 0
    for odd in ("map<string,int>", "struct<a:int>", "array<string>"):
        with pytest.raises(TypeError, match="cannot be measured"):
            op.measured_bytes(spark.createDataFrame([], f"x {odd}"))


def test_dense_index_over_many_partitions(spark):
    keys = [f"{random.Random(i).random():.12f}" for i in range(3000)] * 2
    df = spark.createDataFrame([(k,) for k in keys], "k string").repartition(16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = op.dense_index(df, "k", "n")
        found = {r.k: r.n for r in index.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert found == {k: i for i, k in enumerate(sorted(set(keys)))}
    assert op.dense_index(df.limit(0), "k", "n").count() == 0


COUNTS = [("b", "w1", 2), ("b", "w3", 1), ("a", "w2", 5), ("a", "w1", 1), ("c", "w3", 4)]


def counts(spark):
    return spark.createDataFrame(COUNTS, "clientip string, word string, word_count bigint")


def test_counts(spark):
    rows = [("a", "w")] * 3 + [("a", "word_error"), ("b", "w")]
    df = spark.createDataFrame(rows, "clientip string, word string")
    assert sorted(map(tuple, op.document_word_counts(df).collect())) == [("a", "w", 3), ("b", "w", 1)]
    agents = spark.createDataFrame([("x",), ("x",), ("-",)], "useragent string")
    assert {r.useragent: r["count"] for r in op.agent_counts(agents).collect()} == {"x": 2, "-": 1}


def test_corpus_forms_agree(spark):
    table = counts(spark)
    words, documents = op.word_dictionary(table), op.document_dictionary(table)
    long = {tuple(r) for r in op.long_corpus(table, words, documents).collect()}
    assert long == {(1, 0, 2), (1, 2, 1), (0, 1, 5), (0, 0, 1), (2, 2, 4)}
    vectors = {r.clientip: r.features for r in op.vector_corpus(table, words, 3).collect()}
    assert vectors["b"].size == 3
    assert {k: v.toArray().tolist() for k, v in vectors.items()} == {
        "a": [1, 5, 0], "b": [2, 0, 1], "c": [0, 0, 4],
    }


def test_batch_fraction():
    assert [round(op.batch_fraction(n), 6) for n in (0, 1, 2, 105)] == [0.75, 0.75, 0.525, 0.01]


def fitted(spark, **changes):
    params = AnalysisParams(**{"topics": 3, "iterations": 5, **changes})
    table = counts(spark)
    words = op.word_dictionary(table)
    corpus = op.vector_corpus(table, words, 3).coalesce(1).persist()
    return op.fit_topics(corpus, corpus.count(), params), corpus, words


@pytest.mark.parametrize("optimizer", ["online", "em"])
def test_topic_model_tables(spark, optimizer):
    model, corpus, words = fitted(spark, optimizer=optimizer)
    for row in op.topic_mix(model, corpus).collect():
        assert sum(row.topic_prob_mix) == pytest.approx(1, abs=1e-9)
    weights = op.topic_weights(model, words)
    probs = op.normalise_weights(weights).collect()
    assert sorted(r.word for r in probs) == ["w1", "w2", "w3"]
    for topic in range(3):
        assert sum(r.topic_probs[topic] for r in probs) == pytest.approx(1, abs=1e-9)


def test_same_seed_same_model(spark):
    first, second = fitted(spark)[0], fitted(spark)[0]
    assert first.topicsMatrix() == second.topicsMatrix()


@pytest.mark.parametrize("optimizer", ["online", "em"])
def test_model_survives_saving(spark, tmp_path, optimizer):
    model, corpus, words = fitted(spark, optimizer=optimizer)
    sources.save_model(model, str(tmp_path / "m"))
    sources.save_model(model, str(tmp_path / "m"))
    loaded = sources.load_model(str(tmp_path / "m"))

    def weights(m):
        rows = op.topic_weights(m, words).collect()
        return {(r.word, r.topic): round(r.weight, 12) for r in rows}

    assert weights(loaded) == weights(model)


def test_normalise_weights(spark):
    rows = [("a", 0, 1.0), ("a", 1, 3.0), ("b", 0, 3.0), ("b", 1, 1.0)]
    df = spark.createDataFrame(rows, "word string, topic int, weight double")
    found = {r.word: r.topic_probs for r in op.normalise_weights(df).collect()}
    assert found == {"a": [0.25, 0.75], "b": [0.75, 0.25]}
    with pytest.raises(Exception, match="no weight for each topic"):
        op.normalise_weights(df.where("word = 'a' OR topic = 1")).collect()


def test_mix_names_and_dominant_topic(spark):
    mix = spark.createDataFrame([(7, [0.25, 0.75])], "document_number bigint, topic_prob_mix array<float>")
    names = spark.createDataFrame([("ip", 7)], "document_name string, document_number bigint")
    row = op.with_dominant_topic(op.mix_by_document_name(mix, names)).first()
    assert tuple(row) == ("ip", [0.25, 0.75], 0.75)


def test_scores(spark):
    mix = spark.createDataFrame([("ip", [0.5, 0.5])], "document_name string, topic_prob_mix array<double>")
    probs = spark.createDataFrame([("w", [0.2, 0.4])], "word string, topic_probs array<double>")
    rows = [("ip", "w"), ("ip", "unseen"), ("unseen", "w"), ("ip", "word_error"), ("unseen", "word_error")]
    df = spark.createDataFrame(rows, "clientip string, word string")
    found = {(r.clientip, r.word): r.score for r in op.score_records(df, mix, probs, 2).collect()}
    assert found == {
        rows[0]: pytest.approx(0.3), rows[1]: 0.0, rows[2]: 0.0, rows[3]: -1.0, rows[4]: -1.0,
    }


def test_arrays_of_a_wrong_length_are_noticed(spark):
    mix = spark.createDataFrame([("ip", [1.0])], "document_name string, topic_prob_mix array<double>")
    probs = spark.createDataFrame([("w", [0.2, 0.4])], "word string, topic_probs array<double>")
    df = spark.createDataFrame([("ip", "w")], "clientip string, word string")
    with pytest.raises(Exception, match="has not 2 values"):
        op.score_records(df, mix, probs, 2).collect()


def test_threshold_and_order(spark):
    df = spark.createDataFrame([(s,) for s in (-1.0, 0.0, 0.5, 0.51, 0.2)], "score double")
    kept = op.least_likely_first(op.filter_suspicious(df, 0.5))
    assert [r.score for r in kept.collect()] == [0.0, 0.2, 0.5]
    assert [r.score for r in op.least_likely_first(df, top=2).collect()] == [-1.0, 0.0]


def test_copies_are_divided_by_the_sort(spark):
    """Identical rows do not all meet in one task of the final sort."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copies = spark.range(0, 40000, 1, 8).select(F.lit("ip").alias("clientip"), F.lit(0.25).alias("score"))
        ordered = op.least_likely_first(copies).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in ordered.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 40000 and len(sizes) > 4 and max(sizes) < 20000


def test_documented_word_example(spark):
    """A ranked host at midnight, CONNECT, no content type, four million agent records."""
    row = ("2018-07-01", "00:10:00", "10.10.10.10", "mail.shop.com", "CONNECT", "a", "-", "200", "mail.shop.com:443")
    ranked = spark.createDataFrame([("shop",)], "domain_label string")
    agents = spark.createDataFrame([("a", 5_000_000)], "useragent string, count bigint")
    worded = op.with_words(spark.createDataFrame([row], schemas.CLEAN), ranked, agents)
    assert worded.first().word == "1_0_CONNECT_13_-_22_4_200"
