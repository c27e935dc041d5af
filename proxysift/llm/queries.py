"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift.llm import (
    decontamination,
    fill_in_middle,
    fingerprints,
    lm_scoring,
    mixing,
    ngram_join,
    private_data,
    span_dedup,
    tool_calls,
    toxicity,
    turn_repair,
    url_filter,
    warc,
)
from proxysift.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RULES = [
    ("net", "/", url_filter.BLOCK),
    ("example.net", "/en/", url_filter.ALLOW),
    ("example.com", "/de/", url_filter.BLOCK),
    ("org", "/fr/", url_filter.ALLOW),
]


def _query(name: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        return query

    return register


@_query("op4_benchmark_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op5_url_filters")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@_query("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_query("op10_source_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


@_query("op2_substring_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.without_repeated_spans(docs).select("doc_id", "text", "n_sentences", "n_removed")


@_query("op9_lm_scoring")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(table(spark, sf_dir, "documents"))


@_query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tagger = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scores = toxicity.toxicity_scores(docs, tagger)
    return scores.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_toxic", "offsets"
    )


@_query("op1_fingerprints")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@_query("op6_ngram_jaccard")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, sf_dir, "documents")).drop("mark")


TOOLS = [
    ("count", "letters", "integer", True), ("count", "unit", "string", False),
    ("find", "letters", "integer", True), ("find", "exact", "boolean", True),
]


def tool_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations with one to three tool calls in each turn of the assistant, and results.

    The given table has no calls, so they are derived from turn and length: the tool, its
    arguments (some lack one, some have a wrong type or no tool), some ids that occur twice,
    what comes before (calls of the same and of earlier turns, some of later ones, some in a
    circle), and whether there is a result. A result is the whole text of the turn; some
    results belong to no call.
    """
    rows = table(spark, sf_dir, "conversations").withColumn("n", F.char_length("text"))
    n, turn = F.col("n"), F.col("turn")
    last = n % 3

    def call(p: Column) -> Column:
        m = n + p
        name = F.when(m % 11 == 0, "none").when(m % 2 == 0, "find").otherwise("count")
        exact = F.when(m % 3 == 0, ', "exact": true').when(m % 3 == 1, ', "exact": "yes"').otherwise("")
        unit = F.when(m % 3 == 0, '"unit": "letter", ').otherwise("")
        arguments = F.when(
            m % 2 == 0, F.format_string('{ "letters": %d%s }', m, exact)
        ).otherwise(F.format_string('{ %s"letters" : %d }', unit, m))
        own = F.format_string("c%d-%d", turn, F.when((n % 13 == 0) & (p == 1), 0).otherwise(p))
        later = F.format_string('"c%d-%d"', turn, p + 1)
        after = (
            F.when(n % 19 == 0, F.format_string('["c%d-%d"]', turn, F.when(p == 0, last).otherwise(p - 1)))
            .when((n % 17 == 0) & (p < last), later).when(n % 17 == 0, "null")
            .when(p > 0, F.format_string('["c%d-%d", "c%d-0"]', turn, p - 1, turn))
            .when(n % 23 == 0, F.format_string('["c%d-0"]', turn + 2))
            .otherwise(F.format_string('["c%d-0", "c%d-0"]', turn - 2, turn - 1))
        )
        return F.format_string('{"name": "%s", "id": "%s", "after": %s, "arguments": %s}', name, own, after, arguments)

    calls = F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), last), call), ", "), F.lit("]"))
    spoken = rows.select(
        "conv_id", "turn", "role", F.col("text").alias("content"),
        F.when(F.col("role") == "assistant", calls).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"),
    )
    of = F.filter(F.array(
        F.when(n % 7 != 0, F.format_string("c%d-0", turn)), F.when((n % 5 != 0) & (last > 0), F.format_string("c%d-1", turn)),
        F.when(n % 29 == 0, F.format_string("lost%d", turn)),
    ), lambda x: x.isNotNull())
    results = rows.where("role = 'assistant'").select(
        "conv_id", "turn", F.lit("tool").alias("role"), F.col("text").alias("content"),
        F.lit(None).cast("string").alias("tool_calls"), F.explode(of).alias("tool_call_id"),
    )
    return spoken.unionByName(results)


@_query("op7_chat_formatting")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = spark.createDataFrame(TOOLS, "name string, field string, type string, required boolean")
    return tool_calls.format_chats(tool_messages(spark, sf_dir), schemas)


@_query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repaired_after_damage(table(spark, sf_dir, "conversations"))


@_query("op12_fill_in_middle")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples = fill_in_middle.arranged(table(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    return fill_in_middle.restored(examples.drop("pieces")).drop("output", "restored")


@_query("op13_private_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.private_spans(table(spark, sf_dir, "documents"))
