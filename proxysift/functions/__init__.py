"""Column functions; every one is a built-in Spark expression."""

from proxysift.functions.bins import ceil_log2, entropy_bin, log_bin
from proxysift.functions.domain import (
    domain_info,
    extract_domain,
    extract_subdomain,
    host_labels,
    label_count,
    popularity_class,
    strip_country_code,
    strip_top_level_domain,
)
from proxysift.functions.entropy import string_entropy
from proxysift.functions.fields import head_split, record_fields, split_quoted
from proxysift.functions.text import convert_field, has_text, repair_csv, replace_all
from proxysift.functions.times import epoch_seconds, event_date, iso_text, parse_time
from proxysift.functions.vectors import dot, sparse_vector, widen
from proxysift.functions.word import behaviour_word, content_group, hour_of, response_code

__all__ = [
    "behaviour_word", "ceil_log2", "content_group", "convert_field", "domain_info", "dot",
    "entropy_bin", "epoch_seconds", "event_date", "extract_domain", "extract_subdomain",
    "has_text", "head_split", "host_labels", "hour_of", "iso_text",
    "label_count", "log_bin", "parse_time", "popularity_class",
    "record_fields", "repair_csv", "replace_all", "response_code", "sparse_vector",
    "split_quoted", "string_entropy", "strip_country_code", "strip_top_level_domain", "widen",
]
