"""One registered query per operator; each reads whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as t
from proxysift import AnalysisParams, JobParams, configure, functions, sources
from proxysift import operators as op
from proxysift.operators.topics import batch_fraction
from proxysift.plans import detect_anomalies, run_job, train
from proxysift.plans.ingest_job import proxy_table
from proxysift.session import durable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DECIMALS = 6
# Every client is read in every iteration, and every score is kept.
FIT = AnalysisParams(iterations=10, batch=1.0, threshold=1.0)


def query(build: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def rounded(value: Column, name: str) -> Column:
    return F.round(value, DECIMALS).alias(name)


def text(values: Column, name: str) -> Column:
    """An array as one text, to compare it between engines."""
    return F.array_join(values, "|").alias(name)


def rounded_text(values: Column, name: str) -> Column:
    """An array of numbers as whole millionths, as one text."""
    scaled = F.transform(values, lambda v: F.round(v * 10**DECIMALS).cast("bigint").cast("string"))
    return F.array_join(scaled, "|").alias(name)


# --- sources and sinks ---------------------------------------------------------------


@query
def analysis_input(spark, sf_dir):
    path = t.scratch_path(spark, "records")
    t.proxy_view(spark, sf_dir).write.parquet(path)
    return sources.read_records(spark, path)


@query
def raw_text_source(spark, sf_dir):
    path = t.scratch_path(spark, "lines")
    t.raw_lines(spark, sf_dir).write.text(path)
    return sources.read_lines(spark, path)


@query
def ranked_domain_list(spark, sf_dir):
    path = t.scratch_path(spark, "ranked")
    t.ranked_lines(spark, sf_dir).write.text(path)
    return sources.read_ranked_domains(spark, path)


def _ingested(spark: SparkSession, sf_dir: str) -> JobParams:
    params = JobParams(
        "Proxy", in_path=t.scratch_path(spark, "lines"), out_path=t.scratch_path(spark, "table")
    )
    t.raw_lines(spark, sf_dir).write.text(params.in_path)
    run_job(spark, params)
    return params


@query
def ingest_job_table(spark, sf_dir):
    return spark.read.parquet(_ingested(spark, sf_dir).out_path).withColumn(
        "event_date", F.col("event_date").cast("string")
    )


@query
def ingest_job_rejects(spark, sf_dir):
    return spark.read.parquet(_ingested(spark, sf_dir).invalid_path)


@query
def partitioned_write(spark, sf_dir):
    path = t.scratch_path(spark, "by-date")
    sources.write_table(t.cleaned(spark, sf_dir), path, partitions=["p_date"])
    return (
        spark.read.parquet(path)
        .groupBy(F.col("p_date").cast("string").alias("p_date"))
        .agg(F.count("*").alias("records"), F.countDistinct("clientip").alias("clients"))
    )


@query
def model_save_and_load(spark, sf_dir):
    corpus, documents, words = _corpus(spark, sf_dir)
    path = t.scratch_path(spark, "model")
    model = op.fit_topics(corpus, documents, FIT)
    sources.save_model(model, path)
    again = op.topic_mix(sources.load_model(path), corpus).withColumnRenamed("topic_prob_mix", "again")
    both = durable(op.topic_mix(model, corpus)).join(durable(again), "document_name")
    return both.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("topic_prob_mix") != F.col("again")).alias("differences")
    )


@query
def preview(spark, sf_dir):
    return op.least_likely_first(_scored(spark, sf_dir), top=20).select(
        "clientip", "p_date", "p_time", "word", rounded(F.col("score"), "score")
    )


# --- parsing and cleansing -----------------------------------------------------------


@query
def nonblank_lines(spark, sf_dir):
    return t.raw_lines(spark, sf_dir).where(functions.has_text(F.col("value")))


@query
def quoted_field_split(spark, sf_dir):
    lines = t.raw_lines(spark, sf_dir).where(functions.has_text(F.col("value")))
    return lines.select("value", text(functions.split_quoted(F.col("value")), "fields"))


@query
def field_count_check(spark, sf_dir):
    parsed = op.parse_lines(t.raw_lines(spark, sf_dir))
    return parsed.select("raw", F.size("fields").alias("n_fields"), (F.size("fields") == 31).alias("complete"))


@query
def record_recomposition(spark, sf_dir):
    record = F.array(*functions.record_fields(F.col("fields")))
    return op.accepted(op.parse_lines(t.raw_lines(spark, sf_dir))).select("raw", text(record, "record"))


@query
def parse_outcome(spark, sf_dir):
    return op.parse_lines(t.raw_lines(spark, sf_dir)).select("raw", "error", "stage")


@query
def accepted_lines(spark, sf_dir):
    return op.accepted(op.parse_lines(t.raw_lines(spark, sf_dir))).select("raw")


@query
def rejected_lines(spark, sf_dir):
    return op.rejected(op.parse_lines(t.raw_lines(spark, sf_dir)))


@query
def timestamp_column_by_source(spark, sf_dir):
    parsed = op.accepted(op.parse_lines(t.raw_lines(spark, sf_dir)))
    record = functions.record_fields(F.col("fields"))
    names = ("Proxy", "BlueCoat", "Infobox", "FireEye", "Panlogs", "Snare", "Other")
    picked = [record[op.timestamp_index(name)].alias(name.lower()) for name in names]
    return parsed.select("raw", *picked)


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = functions.record_fields(F.col("fields"))[0]
    parsed = op.parse_lines(t.raw_lines(spark, sf_dir)).where(F.size("fields") == 31)
    return parsed.select(stamp.alias("orig"), functions.parse_time(stamp).alias("moment"))


@query
def time_zone_conversion(spark, sf_dir):
    moment = F.col("moment")
    return _moments(spark, sf_dir).select(
        "orig",
        functions.iso_text(moment, "EST").alias("est"),
        functions.iso_text(moment, "UTC").alias("utc"),
    )


@query
def epoch_seconds(spark, sf_dir):
    return _moments(spark, sf_dir).select("orig", functions.epoch_seconds(F.col("moment")).alias("epoch"))


@query
def time_enrichment_with_original(spark, sf_dir):
    parsed = op.accepted(op.parse_lines(t.raw_lines(spark, sf_dir)))
    return op.with_converted_time(parsed).drop("fields", "moment")


@query
def time_enrichment(spark, sf_dir):
    parsed = op.accepted(op.parse_lines(t.raw_lines(spark, sf_dir)))
    return op.with_converted_time(parsed, keep_original=False).drop("fields", "moment")


@query
def schema_with_event_date(spark, sf_dir):
    return op.record_table(op.parse_lines(t.raw_lines(spark, sf_dir)))


@query
def typed_columns(spark, sf_dir):
    table = op.cast_columns(op.record_table(op.parse_lines(t.raw_lines(spark, sf_dir))))
    return table.select("time", "time_taken", "sc_status", "cs_uri_port", "sc_bytes", "cs_bytes")


@query
def without_time_column(spark, sf_dir):
    return proxy_table(op.parse_lines(t.raw_lines(spark, sf_dir)), JobParams("Proxy"))


@query
def analysis_adapter(spark, sf_dir):
    table = proxy_table(op.parse_lines(t.raw_lines(spark, sf_dir)), JobParams("Proxy"))
    return op.adapt_for_analysis(table)


@query
def cleaned_from_raw_lines(spark, sf_dir):
    table = proxy_table(op.parse_lines(t.raw_lines(spark, sf_dir)), JobParams("Proxy"))
    return op.clean_records(op.adapt_for_analysis(table))


@query
def null_sentinels(spark, sf_dir):
    table = op.record_table(op.parse_lines(t.raw_lines(spark, sf_dir)))
    convert = functions.convert_field
    return table.select(
        "orig_timestamp",
        convert(F.col("cs_method")).alias("method"),
        convert(F.col("time_taken"), "int").alias("taken"),
        convert(F.col("sc_bytes"), "bigint").alias("bytes"),
        convert(F.col("cs_host"), "int").alias("host_number"),
    )


@query
def csv_repair_rows(spark, sf_dir):
    return op.parse_csv(t.csv_lines(spark, sf_dir), ["id", "kind", "user"])[0]


@query
def csv_repair_rejects(spark, sf_dir):
    return op.parse_csv(t.csv_lines(spark, sf_dir), ["id", "kind", "user"])[1]


@query
def literal_replace(spark, sf_dir):
    pages = t.table(spark, sf_dir, "pages")
    return pages.select("page_id", functions.replace_all(F.col("html"), "</", "<//").alias("html"))


# --- projections, filters, null handling ---------------------------------------------


@query
def timestamp_split(spark, sf_dir):
    return op.split_timestamp(t.proxy_view(spark, sf_dir)).select("event_id", "p_date", "p_time")


@query
def column_projection(spark, sf_dir):
    return t.proxy_view(spark, sf_dir).select("cIp", "csHost", "csMethod")


@query
def uri_composition(spark, sf_dir):
    return op.compose_uri(t.proxy_view(spark, sf_dir)).select("event_id", "fulluri")


@query
def column_drop(spark, sf_dir):
    return op.compose_uri(t.proxy_view(spark, sf_dir))


@query
def column_rename(spark, sf_dir):
    return op.rename_columns(t.proxy_view(spark, sf_dir))


def _unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = (op.split_timestamp, op.compose_uri, op.rename_columns)
    df = t.proxy_view(spark, sf_dir)
    for step in steps:
        df = df.transform(step)
    return df


@query
def complete_records(spark, sf_dir):
    return op.drop_incomplete(_unfiltered(spark, sf_dir)).select("event_id", "clientip", "fulluri")


@query
def missing_filled(spark, sf_dir):
    return op.fill_missing(_unfiltered(spark, sf_dir)).select("event_id", "useragent", "resconttype")


@query
def cleaned_records(spark, sf_dir):
    return t.cleaned(spark, sf_dir)


@query
def records_with_word(spark, sf_dir):
    return op.with_valid_word(t.worded(spark, sf_dir))


@query
def suspicious_records(spark, sf_dir):
    suspicious = op.filter_suspicious(_scored(spark, sf_dir), 0.0)
    return suspicious.select(*suspicious.columns[:-1], rounded(F.col("score"), "score"))


# --- scalar features -----------------------------------------------------------------


@query
def domain_parts(spark, sf_dir):
    return op.with_domains(t.cleaned(spark, sf_dir)).select("host", "domain", "subdomain")


@query
def country_code_strip(spark, sf_dir):
    labels = functions.strip_country_code(functions.host_labels(F.col("host")))
    return t.cleaned(spark, sf_dir).select("host", text(labels, "labels"))


@query
def generic_domain_strip(spark, sf_dir):
    labels = functions.strip_top_level_domain(functions.host_labels(F.col("host")))
    return t.cleaned(spark, sf_dir).select("host", text(labels, "labels"))


@query
def domain_features(spark, sf_dir):
    info = op.with_domain_info(t.cleaned(spark, sf_dir), t.ranked(spark, sf_dir), "shop")
    return info.select("host", "domain_info.*").withColumn(
        "subdomainEntropy", F.round("subdomainEntropy", DECIMALS)
    )


@query
def domain_popularity(spark, sf_dir):
    return op.with_popularity(t.cleaned(spark, sf_dir), t.ranked(spark, sf_dir)).select("host", "popularity")


@query
def uri_entropy(spark, sf_dir):
    return t.cleaned(spark, sf_dir).select("fulluri", rounded(functions.string_entropy(F.col("fulluri")), "entropy"))


@query
def html_entropy(spark, sf_dir):
    pages = t.table(spark, sf_dir, "pages")
    return pages.select("page_id", rounded(functions.string_entropy(F.col("html")), "entropy"))


@query
def uri_entropy_bin(spark, sf_dir):
    entropy = functions.string_entropy(F.col("fulluri"))
    return t.cleaned(spark, sf_dir).select("fulluri", functions.entropy_bin(entropy).alias("bin"))


@query
def length_log_bin(spark, sf_dir):
    size = F.length("fulluri")
    return t.cleaned(spark, sf_dir).select(
        "fulluri", functions.log_bin(size).alias("bin"), functions.log_bin(size - 30, 10).alias("bin10")
    )


@query
def length_ceil_log2(spark, sf_dir):
    return t.cleaned(spark, sf_dir).select(
        "fulluri",
        functions.ceil_log2(F.length("fulluri")).alias("bits"),
        functions.ceil_log2(F.length("reqmethod") - 3).alias("method_bits"),
    )


@query
def hour_of_time(spark, sf_dir):
    return t.cleaned(spark, sf_dir).select(
        "p_time", functions.hour_of(F.col("p_time")).alias("hour"),
        functions.hour_of(F.col("fulluri"), ".").alias("bad_hour"),
    )


@query
def content_type_group(spark, sf_dir):
    return t.cleaned(spark, sf_dir).select(
        "resconttype", functions.content_group(F.col("resconttype")).alias("kind")
    )


@query
def response_code_default(spark, sf_dir):
    return t.cleaned(spark, sf_dir).select("fulluri", functions.response_code(F.col("respcode")).alias("code"))


@query
def behaviour_words(spark, sf_dir):
    return t.worded(spark, sf_dir)


# --- aggregations and dictionaries ---------------------------------------------------


@query
def user_agent_counts(spark, sf_dir):
    return op.agent_counts(t.cleaned(spark, sf_dir))


@query
def client_word_counts(spark, sf_dir):
    return op.document_word_counts(t.worded(spark, sf_dir))


@query
def distinct_words(spark, sf_dir):
    return t.word_counts(spark, sf_dir).select("word").distinct()


@query
def distinct_documents(spark, sf_dir):
    return t.word_counts(spark, sf_dir).select("clientip").distinct()


@query
def word_dictionary(spark, sf_dir):
    return op.word_dictionary(t.word_counts(spark, sf_dir))


@query
def document_dictionary(spark, sf_dir):
    return op.document_dictionary(t.word_counts(spark, sf_dir))


@query
def corpus_long(spark, sf_dir):
    counts = t.word_counts(spark, sf_dir)
    return op.long_corpus(counts, op.word_dictionary(counts), op.document_dictionary(counts))


def _corpus(spark: SparkSession, sf_dir: str):
    counts = t.word_counts(spark, sf_dir)
    words = op.word_dictionary(counts)
    corpus = durable(op.vector_corpus(counts, words, words.count())).persist()
    return corpus, corpus.count(), words


@query
def corpus_vectors(spark, sf_dir):
    corpus, _, _ = _corpus(spark, sf_dir)
    vector = corpus.select("clientip", F.unwrap_udt("features").alias("v"))
    cells = F.arrays_zip(F.col("v.indices").alias("word_number"), F.col("v.values").alias("value"))
    return vector.select("clientip", F.col("v.size").alias("size"), F.inline(cells))


@query
def mix_widening(spark, sf_dir):
    mix = t.embedding_mix(spark, sf_dir)
    return mix.select(
        "document_name", rounded_text(functions.widen(F.col("topic_prob_mix")), "mix")
    )


@query
def corpus_size(spark, sf_dir):
    corpus, _, _ = _corpus(spark, sf_dir)
    return corpus.agg(F.count(F.lit(1)).alias("documents"))


@query
def dominant_topic_share(spark, sf_dir):
    return op.with_dominant_topic(t.embedding_mix(spark, sf_dir)).select(
        "document_name", rounded(F.col("maxV").cast("double"), "max_share")
    )


@query
def word_probabilities(spark, sf_dir):
    probs = op.normalise_weights(t.fixed_weights(t.worded(spark, sf_dir)))
    return probs.select("word", rounded_text(F.col("topic_probs"), "probs"))


# --- joins and ordering --------------------------------------------------------------


@query
def counts_with_document_number(spark, sf_dir):
    counts = t.word_counts(spark, sf_dir).withColumnRenamed("clientip", "document_name")
    documents = op.document_dictionary(counts.withColumnRenamed("document_name", "clientip"))
    return op.lookup_join(counts, documents, "document_name", "inner")


@query
def counts_with_word_number(spark, sf_dir):
    counts = t.word_counts(spark, sf_dir)
    return op.lookup_join(counts, op.word_dictionary(counts), "word", "inner")


@query
def mix_with_document_name(spark, sf_dir):
    documents = op.document_dictionary(t.word_counts(spark, sf_dir))
    numbered = t.fixed_mix(spark, sf_dir).join(documents, "document_name").drop("document_name")
    named = op.mix_by_document_name(numbered, documents)
    return named.select("document_name", rounded_text(F.col("topic_prob_mix"), "mix"))


@query
def lookups_in_shared_tables(spark, sf_dir):
    records = t.cleaned(spark, sf_dir)
    known = op.with_popularity(records, t.ranked(spark, sf_dir), own_domain="")
    counted = op.lookup_join(known, durable(op.agent_counts(records)), "useragent", "inner")
    return counted.select("host", "useragent", "popularity", "count")


@query
def records_with_mix(spark, sf_dir):
    mix = t.fixed_mix(spark, sf_dir).withColumnRenamed("document_name", "clientip")
    joined = op.lookup_join(t.cleaned(spark, sf_dir), mix, "clientip")
    return joined.select("clientip", "fulluri", rounded_text(F.col("topic_prob_mix"), "mix"))


@query
def records_with_mix_shuffled(spark, sf_dir):
    """The same join for a mix table above the broadcast limit."""
    mix = t.fixed_mix(spark, sf_dir).withColumnRenamed("document_name", "clientip")
    joined = op.lookup_join(t.cleaned(spark, sf_dir), mix, "clientip", limit_bytes=0)
    return joined.select("clientip", "fulluri", rounded_text(F.col("topic_prob_mix"), "mix"))


@query
def least_likely_records(spark, sf_dir):
    return op.least_likely_first(_scored(spark, sf_dir)).select(
        "clientip", "p_date", "p_time", "word", rounded(F.col("score"), "score")
    )


# --- topic model and scoring ---------------------------------------------------------


@query
def mini_batch_fraction(spark, sf_dir):
    _, documents, _ = _corpus(spark, sf_dir)
    corpus_size_ = t.word_counts(spark, sf_dir).agg(F.countDistinct("clientip").alias("documents"))
    return corpus_size_.withColumn("fraction", F.round(F.lit(batch_fraction(documents)), DECIMALS))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = durable(t.worded(spark, sf_dir))
    mix, probs = t.fixed_mix(spark, sf_dir), t.fixed_probs(records)
    return op.score_records(records, mix, probs, t.TOPICS)


def _topic_sums(weights: DataFrame) -> DataFrame:
    """Words and sum of weights per topic."""
    return weights.groupBy("topic").agg(
        F.count(F.lit(1)).alias("words"), rounded(F.sum("weight"), "total")
    )


def _mix_sums(mix: DataFrame) -> DataFrame:
    """Number and sum of the shares per document."""
    total = F.aggregate("topic_prob_mix", F.lit(0.0), lambda a, v: a + v)
    return mix.withColumns({"topics": F.size("topic_prob_mix"), "total": F.round(total, DECIMALS)})


@query
def topic_model_online(spark, sf_dir):
    corpus, documents, words = _corpus(spark, sf_dir)
    return _topic_sums(op.topic_weights(op.fit_topics(corpus, documents, FIT), words))


@query
def topic_model_em(spark, sf_dir):
    corpus, documents, words = _corpus(spark, sf_dir)
    params = AnalysisParams(iterations=5, optimizer="em")
    return _topic_sums(op.topic_weights(op.fit_topics(corpus, documents, params), words))


@query
def topic_mix_of_documents(spark, sf_dir):
    corpus, documents, _ = _corpus(spark, sf_dir)
    return _mix_sums(op.topic_mix(op.fit_topics(corpus, documents, FIT), corpus)).drop("topic_prob_mix")


@query
def pair_scores(spark, sf_dir):
    records = durable(t.worded(spark, sf_dir))
    counts = op.document_word_counts(records)
    scored = op.score_pairs(counts, t.fixed_mix(spark, sf_dir), t.fixed_probs(records), t.TOPICS)
    return scored.select("clientip", "word", rounded(F.col("score"), "score"))


@query
def scored_records(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.select(*scored.columns[:-1], rounded(F.col("score"), "score"))


def ranked_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records themselves, least likely first."""
    return detect_anomalies(t.cleaned(configure(spark), sf_dir), t.ranked(spark, sf_dir), FIT)


@query
def anomalies(spark, sf_dir):
    """Counts over the ranked records, and how many of them, as written, are out of order."""
    ranked = durable(ranked_anomalies(spark, sf_dir))
    order = op.out_of_order(ranked).select((F.col("within") + F.col("between")).alias("out_of_order"))
    return ranked.agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("clientip").alias("clients"),
        F.countDistinct("word").alias("words"),
        F.count_if(~F.col("score").between(0.0, FIT.threshold)).alias("outside"),
    ).join(order)


@query
def topic_model_drawn(spark, sf_dir):
    """The fit that reads what it draws: exact sums, and whether it has learned from them.

    ``better`` says that its mixes make the corpus likelier than equally frequent words would.
    """
    counts = t.word_counts(spark, sf_dir)
    words = durable(op.word_dictionary(counts))
    entries = durable(op.lookup_join(counts, words, "word", "inner").select("clientip", "word_number", "word_count"))
    documents = entries.select("clientip").distinct().count()
    params = AnalysisParams(iterations=FIT.iterations)
    model = op.fit_drawn(entries, words, documents, params, 0.2)
    mix = durable(op.mix_by_joins(entries, model.weights, model.alpha))
    gain = op.log_likelihood(entries, mix, model.weights, params.topics) + math.log(words.count())
    long = model.weights.select("word_number", F.posexplode("weights").alias("topic", "weight"))
    totals = F.array(*[F.lit(total) for total in model.totals])
    return long.groupBy("topic").agg(
        F.count(F.lit(1)).alias("words"), rounded(F.sum(F.col("weight") / F.get(totals, F.col("topic"))), "total")
    ).withColumn("better", F.lit(gain > 0))


@query
def anomaly_model_tables(spark, sf_dir):
    trained = train(t.cleaned(spark, sf_dir), t.ranked(spark, sf_dir), FIT)
    found = _mix_sums(op.with_dominant_topic(trained.mix))
    return found.select(
        "document_name", "topics", "total", F.col("maxV").between(1.0 / FIT.topics - 1e-9, 1.0).alias("dominant")
    )
