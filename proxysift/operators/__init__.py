"""DataFrame -> DataFrame operators."""

from proxysift.operators.cleaning import (
    clean_records,
    compose_uri,
    drop_incomplete,
    fill_missing,
    rename_columns,
    split_timestamp,
)
from proxysift.operators.corpus import long_corpus, vector_corpus
from proxysift.operators.counts import agent_counts, document_word_counts, with_valid_word
from proxysift.operators.dictionaries import dense_index, document_dictionary, word_dictionary
from proxysift.operators.drawn_topics import DrawnTopics, draw_batches, fit_drawn, log_likelihood, mix_by_joins
from proxysift.operators.ingest import (
    accepted,
    adapt_for_analysis,
    cast_columns,
    parse_csv,
    parse_lines,
    record_table,
    rejected,
    timestamp_index,
    with_converted_time,
)
from proxysift.operators.lookup import fits_broadcast, lookup_join, measured_bytes
from proxysift.operators.scoring import (
    filter_suspicious,
    least_likely_first,
    out_of_order,
    score_pairs,
    score_records,
)
from proxysift.operators.topics import (
    batch_fraction,
    fit_topics,
    mix_by_document_name,
    normalise_weights,
    saved_topic_weights,
    topic_mix,
    topic_weights,
    with_dominant_topic,
)
from proxysift.operators.words import with_domain_info, with_domains, with_popularity, with_words

__all__ = [
    "DrawnTopics", "accepted", "adapt_for_analysis", "agent_counts", "batch_fraction", "cast_columns",
    "clean_records", "compose_uri", "dense_index", "document_dictionary",
    "document_word_counts", "draw_batches", "drop_incomplete", "fill_missing", "filter_suspicious",
    "fit_drawn", "fit_topics", "fits_broadcast", "least_likely_first", "log_likelihood", "long_corpus", "lookup_join", "measured_bytes",
    "mix_by_document_name", "mix_by_joins", "normalise_weights", "out_of_order", "parse_csv", "parse_lines",
    "record_table", "rejected", "rename_columns", "saved_topic_weights", "score_pairs", "score_records",
    "split_timestamp", "timestamp_index", "topic_mix", "topic_weights", "vector_corpus",
    "with_converted_time", "with_domain_info", "with_domains", "with_dominant_topic",
    "with_popularity", "with_words", "word_dictionary", "with_valid_word",
]
