"""A SQL text per exact query, written independently of the Spark expressions.

The line oracles need no parser: they rebuild the expected fields from the columns a line
was generated from. Country codes other than those of ``CODE_SQL`` do not occur.
"""

from __future__ import annotations

import re
from collections import Counter

from catalog.tables import (
    BAD_HOUR_SQL,
    CODE_SQL,
    CSV_SQL,
    DUCK_STAMP,
    LINE_SQL,
    LINES_SQL,
    PROXY_SQL,
    RANKED_SQL,
    TOPICS,
)


def _proxy(time: str) -> str:
    # The count is a table of one row, so that pages are joined by hash.
    return PROXY_SQL.format(
        time=time, code=CODE_SQL, n_pages="n", pages="pages", events="events, (SELECT count(*) AS n FROM pages)"
    )


_COUNTRIES = "('uk', 'au', 'de', 'eu', 'krd', 'su', 'ac', 'jp')"
_GENERIC = "('com', 'org', 'net', 'int', 'edu', 'gov', 'mil')"

# Broken lines by precedence: quotes, then field count, then time.
_FAULT = """CASE WHEN event_id % 41 = 0 THEN 'Unbalanced quotes'
  WHEN event_id % 43 = 0 THEN 'Columns != 31' WHEN event_id % 37 = 0 THEN 'Invalid timestamp' END"""
_STAMP = """CASE WHEN event_id % 37 = 0 THEN 'not-a-time'
  WHEN event_id % 3 = 0 THEN timestamp || '-05:00' ELSE timestamp || '-0500' END"""
_TAKEN = "CASE WHEN event_id % 29 = 0 THEN '-' ELSE CAST(event_id % 5000 AS VARCHAR) END"
_UTC = "(CAST(timestamp AS TIMESTAMP) + INTERVAL 5 HOUR)"

# The record values behind a line, by record column.
_RECORD = {
    "time": _STAMP,
    "syslog_timestamp": "substr(timestamp, 1, 10) || 'T' || substr(timestamp, 12, 8)",
    "time_taken": _TAKEN,
    "c_ip": "cIp",
    "cs_username": "'user' || CAST(event_id % 17 AS VARCHAR)",
    "cs_auth_group": "'\"Domain Users\"'",
    "x_exception_id": "'-'",
    "sc_filter_result": "'OBSERVED'",
    "cs_categories": "'\"Search Engines;News\"'",
    "cs_referer": "'-'",
    "sc_status": "coalesce(scStatus, '-')",
    "s_action": "'TCP_MISS'",
    "cs_method": "coalesce(csMethod, '-')",
    "rs_content_type": "coalesce(rsContentType, '-')",
    "cs_uri_scheme": "'http'",
    "cs_host": "coalesce(csHost, '-')",
    "cs_uri_port": "'443'",
    "cs_uri_path": "coalesce(csUriPath, '-')",
    "cs_uri_query": "coalesce(csUriQuery, '-')",
    "cs_uri_extension": "coalesce(csUriExtension, '-')",
    "cs_user_agent": "'\"' || coalesce(csUserAgent, '-') || ' (X11; Linux)\"'",
    "s_ip": "'10.9.9.9'",
    "sc_bytes": "CAST(event_id * 1000003 AS VARCHAR)",
    "cs_bytes": "'512'",
    "x_virus_id": "'-'",
    "x_bluecoat_application_name": "'\"none\"'",
    "x_bluecoat_application_operation": "'\"none\"'",
}
_NAMED = ", ".join(f"{value} AS {name}" for name, value in _RECORD.items())
_CASTS = {
    "time_taken": "INTEGER", "sc_status": "INTEGER", "cs_uri_port": "INTEGER",
    "sc_bytes": "BIGINT", "cs_bytes": "BIGINT",
}
_TYPED = ", ".join(f"TRY_CAST({name} AS {kind}) AS {name}" for name, kind in _CASTS.items())


def _joined(values: list[str]) -> str:
    return " || '|' || ".join(f"({value})" for value in values)


# Fields of a line: two that stem from the head, date and stamps, then the record values.
_TAIL = list(_RECORD.values())[2:]
_LINE_FIELDS = _joined(
    ["'<134>gw--sg1'", "'proxy'", "substr(timestamp, 1, 10)", _STAMP, "substr(timestamp, 12, 8)", *_TAIL[:-1]]
)
_DISPLAY = "strftime({}, '%Y-%m-%dT%H:%M:%S') || '.000{}'"
_EST = _DISPLAY.format("CAST(timestamp AS TIMESTAMP)", "-05:00")

_DOT = " + ".join(f"coalesce(topic_prob_mix[{i}], 0) * topic_probs[{i}]" for i in range(1, TOPICS + 1))


def _rounded_text(values: str) -> str:
    return (
        f"array_to_string(list_transform({values}, "
        "lambda v: CAST(CAST(round(v * 1000000) AS BIGINT) AS VARCHAR)), '|')"
    )


# Named intermediate tables; each may use the ones above it.
_TABLES = {
    "pv": _proxy(BAD_HOUR_SQL.format(stamp=DUCK_STAMP)),
    "requests": _proxy(DUCK_STAMP),
    "lines": LINES_SQL.format(pv="requests"),
    "line_facts": f"SELECT *, {LINE_SQL} AS raw, {_FAULT} AS error FROM requests WHERE event_id % 31 <> 0",
    "good_lines": "SELECT * FROM line_facts WHERE error IS NULL",
    "records": f"""SELECT raw, {_NAMED}, {_STAMP} AS orig_timestamp, {_EST} AS iso_timestamp,
        CAST(epoch({_UTC}) AS BIGINT) AS epoch_timestamp,
        replace(substr(timestamp, 1, 10), '-', '') AS event_date FROM good_lines""",
    "csv": CSV_SQL.format(events="events"),
    "ranking": f"SELECT DISTINCT label FROM ({RANKED_SQL.format(pages='pages')}) WHERE page_id % 3 = 0",
    "clean": """SELECT split_part(timestamp, 'T', 1) AS p_date, split_part(timestamp, 'T', 2) AS p_time,
        cIp AS clientip, csHost AS host, csMethod AS reqmethod,
        coalesce(csUserAgent, '-') AS useragent, coalesce(rsContentType, '-') AS resconttype,
        scStatus AS respcode, csHost || csUriPath || coalesce(csUriQuery, '') AS fulluri
        FROM pv WHERE csHost IS NOT NULL AND csUriPath IS NOT NULL""",
    "labels": """SELECT host, string_split(rtrim(host, '.'), '.') AS a FROM (SELECT DISTINCT host FROM clean)""",
    "without_country": f"""SELECT host, a, CASE WHEN a[-1] IN {_COUNTRIES} THEN a[1:len(a) - 1] ELSE a END AS b FROM labels""",
    "suffixed": f"""SELECT host, a, b,
        CASE WHEN b[-1] IN {_GENERIC} THEN b[1:len(b) - 1] ELSE b END AS c,
        len(a) >= 2 AND (a[-1] IN {_COUNTRIES} OR a[-1] IN {_GENERIC}) AS named
        FROM without_country""",
    "domains": """SELECT host, a,
        CASE WHEN named AND len(c) > 0 THEN c[-1] ELSE 'None' END AS domain,
        CASE WHEN named AND len(c) > 1 THEN array_to_string(c[1:len(c) - 1], '.') ELSE 'None' END AS subdomain
        FROM suffixed""",
    "popularity": """SELECT host, CASE WHEN domain = 'intel' THEN 2
        WHEN domain IN (SELECT label FROM ranking) THEN 1 ELSE 0 END AS popularity FROM domains""",
    "characters": """SELECT s, unnest(string_split(s, '')) AS ch FROM (
        SELECT fulluri AS s FROM clean UNION SELECT html FROM pages UNION SELECT subdomain FROM domains)""",
    "shares": """SELECT s, count(*) / length(s) AS p FROM characters GROUP BY s, ch""",
    "entropies": """SELECT s, sum(-p * log10(p) / log10(2)) AS h FROM shares GROUP BY s""",
    "bins": """SELECT s, CASE WHEN h > 5.4 THEN 19 ELSE CAST(len(list_filter(
        [0.0, 0.3, 0.6, 0.9, 1.2, 1.5, 1.8, 2.1, 2.4, 2.7, 3.0, 3.3, 3.6, 3.9, 4.2, 4.5, 4.8, 5.1, 5.4]::DOUBLE[],
        lambda c: c < h)) AS INTEGER) END AS bin FROM entropies""",
    "agents": "SELECT useragent, count(*) AS n FROM clean GROUP BY useragent",
    "worded": """SELECT c.*, CASE WHEN TRY_CAST(split_part(p_time, ':', 1) AS INTEGER) IS NULL THEN 'word_error'
        ELSE p.popularity || '_' || TRY_CAST(split_part(p_time, ':', 1) AS INTEGER) || '_'
        || coalesce(reqmethod, 'null') || '_' || b.bin || '_'
        || CASE WHEN resconttype = '/' THEN 'unknown_content_type' ELSE split_part(resconttype, '/', 1) END
        || '_' || CAST(trunc(log10(a.n) / log10(2)) AS INTEGER)
        || '_' || CAST(trunc(log10(length(fulluri)) / log10(2)) AS INTEGER)
        || '_' || coalesce(respcode, 'unknown_response_code') END AS word
        FROM clean c JOIN popularity p USING (host) JOIN bins b ON b.s = c.fulluri JOIN agents a USING (useragent)""",
    "counts": "SELECT clientip, word, count(*) AS word_count FROM worded WHERE word <> 'word_error' GROUP BY clientip, word",
    "words": "SELECT word, CAST(row_number() OVER (ORDER BY word) - 1 AS INTEGER) AS word_number FROM (SELECT DISTINCT word FROM counts)",
    "documents_no": """SELECT clientip AS document_name, row_number() OVER (ORDER BY clientip) - 1 AS document_number
        FROM (SELECT DISTINCT clientip FROM counts)""",
    "whole": """SELECT '10.0.' || CAST((vec_id + 10) // 256 AS VARCHAR) || '.' || CAST((vec_id + 10) % 256 AS VARCHAR) AS document_name,
        CAST(embedding AS DOUBLE[]) AS topic_prob_mix FROM embeddings""",
    "mix": f"""SELECT document_name, list_transform(range({TOPICS}), lambda t: list_sum(list_filter(sizes, lambda x, i: (i - 1) % {TOPICS} = t)) / list_sum(sizes)) AS topic_prob_mix
        FROM (SELECT document_name, list_transform(topic_prob_mix, lambda x: abs(x)) AS sizes FROM whole)""",
    "topic_ids": f"SELECT unnest(range({TOPICS})) AS topic",
    "seconds": f"SELECT word, CAST(split_part(p_time, ':', 3) AS INTEGER) % {TOPICS} AS topic, count(*) AS n FROM worded GROUP BY ALL",
    "weights": """SELECT w.word, t.topic, coalesce(s.n, 0) + 1.0 AS weight
        FROM (SELECT DISTINCT word FROM worded) w CROSS JOIN topic_ids t LEFT JOIN seconds s USING (word, topic)""",
    "all_probs": """SELECT word, list(p ORDER BY topic) AS topic_probs FROM (
        SELECT word, topic, CAST(weight AS DOUBLE) / sum(CAST(weight AS DOUBLE)) OVER (PARTITION BY topic) AS p FROM weights) GROUP BY word""",
    "probs": "SELECT * FROM all_probs WHERE NOT ends_with(word, '_503')",
    "scored": f"""SELECT w.*, CASE WHEN word = 'word_error' THEN -1.0 ELSE coalesce({_DOT}, 0) END AS score FROM worded w
        LEFT JOIN mix ON document_name = clientip LEFT JOIN probs USING (word)""",
}


def _sql(select: str) -> str:
    """The statement with the tables it needs, directly or through others, in front."""
    needed: set[str] = set()
    stack = [select]
    while stack:
        used = set(re.findall(r"[a-z_]+", stack.pop())) & set(_TABLES) - needed
        needed |= used
        stack.extend(_TABLES[name] for name in used)
    # A table that several others read is made once.
    readers = Counter(name for text in (select, *(_TABLES[n] for n in needed)) for name in set(re.findall(r"[a-z_]+", text)))
    tables = ", ".join(
        f"{name} AS {'MATERIALIZED ' * (readers[name] > 1)}({body})" for name, body in _TABLES.items() if name in needed
    )
    return f"WITH {tables} {select}" if tables else select


_ENRICHED = f"{_EST} AS iso_timestamp, CAST(epoch({_UTC}) AS BIGINT) AS epoch_timestamp"
_PARSED_COLUMNS = ", ".join(name for name in _RECORD if name not in ("time", *_CASTS))
_CLEAN = "p_date, p_time, clientip, host, reqmethod, useragent, resconttype, respcode, fulluri"
_ADAPTED = """orig_timestamp AS timestamp, c_ip AS cIp, nullif(cs_host, '-') AS csHost, nullif(cs_method, '-') AS csMethod,
    cs_user_agent AS csUserAgent, nullif(rs_content_type, '-') AS rsContentType,
    CAST(TRY_CAST(sc_status AS INTEGER) AS VARCHAR) AS scStatus, nullif(cs_uri_path, '-') AS csUriPath,
    nullif(cs_uri_query, '-') AS csUriQuery, nullif(cs_uri_extension, '-') AS csUriExtension"""
_PV_COLUMNS = """timestamp, cIp, csHost, csMethod, csUserAgent, rsContentType, scStatus,
    csUriPath, csUriQuery, csUriExtension"""
_STAGE = "CASE WHEN error = 'Invalid timestamp' THEN 'convertToTargetTZ' WHEN error IS NOT NULL THEN 'parser' END AS stage"

_SELECTS = {
    # sources and sinks
    "analysis_input": f"SELECT {_PV_COLUMNS} FROM pv",
    "raw_text_source": "SELECT value FROM lines",
    "ranked_domain_list": "SELECT label AS domain_label FROM ranking",
    "ingest_job_table": f"SELECT {_PARSED_COLUMNS}, {_TYPED}, orig_timestamp, iso_timestamp, epoch_timestamp, event_date FROM records",
    "ingest_job_rejects": f"SELECT raw, error, {_STAGE} FROM line_facts WHERE error IS NOT NULL",
    "partitioned_write": "SELECT p_date, count(*) AS records, count(DISTINCT clientip) AS clients FROM clean GROUP BY p_date",
    "preview": """SELECT clientip, p_date, p_time, word, round(score, 6) AS score FROM (
        SELECT * FROM scored ORDER BY score, clientip, p_date, p_time, word LIMIT 20)""",
    # parsing and cleansing
    "nonblank_lines": "SELECT value FROM lines WHERE trim(value) <> ''",
    "quoted_field_split": f"""SELECT raw AS value, CASE WHEN event_id % 41 = 0 THEN NULL
        ELSE {_LINE_FIELDS} || CASE WHEN event_id % 43 = 0 THEN '' ELSE '|"none"' END END AS fields FROM line_facts""",
    "field_count_check": """SELECT raw, CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 43 = 0 THEN 30 ELSE 31 END AS n_fields,
        CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_id % 43 <> 0 END AS complete FROM line_facts""",
    "record_recomposition": f"SELECT raw, {_joined(list(_RECORD.values()))} AS record FROM good_lines",
    "parse_outcome": f"SELECT raw, error, {_STAGE} FROM line_facts",
    "accepted_lines": "SELECT raw FROM good_lines",
    "rejected_lines": f"SELECT raw, error, {_STAGE} FROM line_facts WHERE error IS NOT NULL",
    "timestamp_column_by_source": f"""SELECT raw, {_STAMP} AS proxy, {_STAMP} AS bluecoat,
        {_RECORD['cs_username']} AS infobox, {_RECORD['cs_username']} AS fireeye, {_RECORD['cs_username']} AS panlogs,
        'OBSERVED' AS snare, {_RECORD['cs_username']} AS other FROM good_lines""",
    "time_zone_conversion": f"""SELECT {_STAMP} AS orig,
        CASE WHEN event_id % 37 <> 0 THEN {_EST} END AS est,
        CASE WHEN event_id % 37 <> 0 THEN {_DISPLAY.format(_UTC, '+00:00')} END AS utc
        FROM line_facts WHERE event_id % 41 <> 0 AND event_id % 43 <> 0""",
    "epoch_seconds": f"""SELECT {_STAMP} AS orig, CASE WHEN event_id % 37 <> 0 THEN CAST(epoch({_UTC}) AS BIGINT) END AS epoch
        FROM line_facts WHERE event_id % 41 <> 0 AND event_id % 43 <> 0""",
    "time_enrichment_with_original": f"SELECT raw, {_STAMP} AS orig_timestamp, {_ENRICHED} FROM good_lines",
    "time_enrichment": f"SELECT raw, {_ENRICHED} FROM good_lines",
    "schema_with_event_date": f"SELECT {', '.join(_RECORD)}, orig_timestamp, iso_timestamp, epoch_timestamp, event_date FROM records",
    "typed_columns": f"SELECT time, {_TYPED} FROM records",
    "without_time_column": f"SELECT {_PARSED_COLUMNS}, {_TYPED}, orig_timestamp, iso_timestamp, epoch_timestamp, event_date FROM records",
    "analysis_adapter": f"SELECT {_ADAPTED} FROM records",
    "cleaned_from_raw_lines": f"""SELECT split_part(timestamp, 'T', 1) AS p_date, split_part(timestamp, 'T', 2) AS p_time,
        cIp AS clientip, csHost AS host, csMethod AS reqmethod, csUserAgent AS useragent,
        coalesce(rsContentType, '-') AS resconttype, scStatus AS respcode,
        csHost || csUriPath || coalesce(csUriQuery, '') AS fulluri
        FROM (SELECT {_ADAPTED} FROM records) WHERE csHost IS NOT NULL AND csUriPath IS NOT NULL""",
    "null_sentinels": """SELECT orig_timestamp, CASE WHEN cs_method <> '-' THEN cs_method END AS method,
        TRY_CAST(time_taken AS INTEGER) AS taken, TRY_CAST(sc_bytes AS BIGINT) AS bytes,
        CAST(NULL AS INTEGER) AS host_number FROM records""",
    "csv_repair_rows": """SELECT CAST(event_id AS VARCHAR) AS id,
        CASE WHEN event_id % 5 = 0 THEN event_type || ', ''''x''''' WHEN event_id % 7 = 0 THEN event_type || ', y'
             ELSE event_type END AS kind, CAST(user_id AS VARCHAR) AS user
        FROM events WHERE event_id % 13 <> 0 AND event_id % 19 <> 0""",
    "csv_repair_rejects": """SELECT CASE WHEN event_id % 13 = 0 THEN event_id || ',"' || event_type
        ELSE event_id || ',' || event_type END AS line FROM events WHERE event_id % 13 = 0 OR event_id % 19 = 0""",
    "literal_replace": "SELECT page_id, replace(html, '</', '<//') AS html FROM pages",
    # projections, filters, null handling
    "timestamp_split": "SELECT event_id, split_part(timestamp, 'T', 1) AS p_date, split_part(timestamp, 'T', 2) AS p_time FROM pv",
    "column_projection": "SELECT cIp, csHost, csMethod FROM pv",
    "uri_composition": "SELECT event_id, coalesce(csHost, '') || csUriPath || coalesce(csUriQuery, '') AS fulluri FROM pv",
    "column_drop": """SELECT event_id, timestamp, cIp, csHost, csMethod, csUserAgent, rsContentType, scStatus,
        coalesce(csHost, '') || csUriPath || coalesce(csUriQuery, '') AS fulluri FROM pv""",
    "column_rename": """SELECT event_id, timestamp, cIp AS clientip, csHost AS host, csMethod AS reqmethod,
        csUserAgent AS useragent, rsContentType AS resconttype, scStatus AS respcode,
        csUriPath, csUriQuery, csUriExtension FROM pv""",
    "complete_records": """SELECT event_id, cIp AS clientip, csHost || csUriPath || coalesce(csUriQuery, '') AS fulluri
        FROM pv WHERE csHost IS NOT NULL AND csUriPath IS NOT NULL""",
    "missing_filled": "SELECT event_id, coalesce(csUserAgent, '-') AS useragent, coalesce(rsContentType, '-') AS resconttype FROM pv",
    "cleaned_records": f"SELECT {_CLEAN} FROM clean",
    "records_with_word": f"SELECT {_CLEAN}, word FROM worded WHERE word <> 'word_error'",
    "suspicious_records": f"SELECT {_CLEAN}, word, round(score, 6) AS score FROM scored WHERE score <= 0 AND score > -1",
    # scalar features
    "domain_parts": "SELECT host, domain, subdomain FROM clean JOIN domains USING (host)",
    "country_code_strip": "SELECT host, array_to_string(b, '|') AS labels FROM clean JOIN without_country USING (host)",
    "generic_domain_strip": f"""SELECT host, array_to_string(CASE WHEN a[-1] IN {_GENERIC}
        THEN a[1:len(a) - 1] ELSE a END, '|') AS labels FROM clean JOIN labels USING (host)""",
    "domain_features": """SELECT host, domain,
        CASE WHEN domain = 'shop' THEN 2 WHEN domain IN (SELECT label FROM ranking) THEN 1 ELSE 0 END AS "topDomain",
        subdomain, CASE WHEN subdomain = 'None' THEN 0 ELSE CAST(length(subdomain) AS INTEGER) END AS "subdomainLength",
        CASE WHEN subdomain = 'None' THEN 0.0 ELSE round(h, 6) END AS "subdomainEntropy", CAST(len(a) AS INTEGER) AS "numPeriods"
        FROM clean JOIN domains USING (host) JOIN entropies ON s = subdomain""",
    "domain_popularity": "SELECT host, popularity FROM clean JOIN popularity USING (host)",
    "uri_entropy": "SELECT fulluri, round(h, 6) AS entropy FROM clean JOIN entropies ON s = fulluri",
    "html_entropy": "SELECT page_id, round(h, 6) AS entropy FROM pages JOIN entropies ON s = html",
    "uri_entropy_bin": "SELECT fulluri, bin FROM clean JOIN bins ON s = fulluri",
    "length_log_bin": """SELECT fulluri, CAST(trunc(log10(length(fulluri)) / log10(2)) AS INTEGER) AS bin,
        CASE WHEN length(fulluri) <= 30 THEN 0 ELSE CAST(trunc(log10(length(fulluri) - 30)) AS INTEGER) END AS bin10 FROM clean""",
    "length_ceil_log2": """SELECT fulluri, CAST(ceil(log10(length(fulluri)) / log10(2)) AS INTEGER) AS bits,
        CASE length(reqmethod) WHEN 3 THEN -2147483648 WHEN 4 THEN 0 WHEN 7 THEN 2 END AS method_bits FROM clean""",
    "hour_of_time": "SELECT p_time, TRY_CAST(split_part(p_time, ':', 1) AS INTEGER) AS hour, TRY_CAST(split_part(fulluri, '.', 1) AS INTEGER) AS bad_hour FROM clean",
    "content_type_group": """SELECT resconttype, CASE resconttype WHEN '/' THEN 'unknown_content_type' WHEN 'text/html' THEN 'text'
        WHEN 'image/png' THEN 'image' WHEN 'application/json' THEN 'application' ELSE resconttype END AS kind FROM clean""",
    "response_code_default": "SELECT fulluri, coalesce(respcode, 'unknown_response_code') AS code FROM clean",
    "behaviour_words": f"SELECT {_CLEAN}, word FROM worded",
    # aggregations and dictionaries
    "user_agent_counts": "SELECT useragent, n AS count FROM agents",
    "client_word_counts": "SELECT clientip, word, word_count FROM counts",
    "distinct_words": "SELECT DISTINCT word FROM counts",
    "distinct_documents": "SELECT DISTINCT clientip FROM counts",
    "word_dictionary": "SELECT word, word_number FROM words",
    "document_dictionary": "SELECT document_name, document_number FROM documents_no",
    "corpus_long": """SELECT document_number, word_number, word_count FROM counts JOIN words USING (word)
        JOIN documents_no ON document_name = clientip""",
    "corpus_vectors": """SELECT clientip, CAST((SELECT count(*) FROM words) AS INTEGER) AS size, word_number,
        CAST(word_count AS DOUBLE) AS value FROM counts JOIN words USING (word)""",
    "mix_widening": f"SELECT document_name, {_rounded_text('topic_prob_mix')} AS mix FROM whole",
    "corpus_size": "SELECT count(DISTINCT clientip) AS documents FROM counts",
    "dominant_topic_share": "SELECT document_name, round(list_max(topic_prob_mix), 6) AS max_share FROM whole",
    "word_probabilities": f"SELECT word, {_rounded_text('topic_probs')} AS probs FROM all_probs",
    # joins and ordering
    "counts_with_document_number": "SELECT clientip AS document_name, word, word_count, document_number FROM counts JOIN documents_no ON document_name = clientip",
    "counts_with_word_number": "SELECT word, clientip, word_count, word_number FROM counts JOIN words USING (word)",
    "mix_with_document_name": f"SELECT document_name, {_rounded_text('topic_prob_mix')} AS mix FROM mix JOIN documents_no USING (document_name)",
    "lookups_in_shared_tables": """SELECT host, useragent, CASE WHEN domain IN (SELECT label FROM ranking) THEN 1 ELSE 0 END AS popularity,
        n AS count FROM clean JOIN domains USING (host) JOIN agents USING (useragent)""",
    "records_with_mix": f"SELECT clientip, fulluri, {_rounded_text('topic_prob_mix')} AS mix FROM clean LEFT JOIN mix ON document_name = clientip",
    "records_with_mix_shuffled": f"SELECT clientip, fulluri, {_rounded_text('topic_prob_mix')} AS mix FROM clean LEFT JOIN mix ON document_name = clientip",
    "least_likely_records": "SELECT clientip, p_date, p_time, word, round(score, 6) AS score FROM scored",
    # topic model and scoring
    "mini_batch_fraction": """SELECT count(DISTINCT clientip) AS documents,
        round(CASE WHEN count(DISTINCT clientip) < 2 THEN 0.75 ELSE 1.05 / count(DISTINCT clientip) END, 6) AS fraction FROM counts""",
    "topic_model_online": "SELECT CAST(topic AS INTEGER) AS topic, (SELECT count(*) FROM words) AS words, 1.0::DOUBLE AS total FROM topic_ids",
    "topic_model_em": "SELECT CAST(topic AS INTEGER) AS topic, (SELECT count(*) FROM words) AS words, 1.0::DOUBLE AS total FROM topic_ids",
    "topic_model_drawn": "SELECT CAST(topic AS INTEGER) AS topic, (SELECT count(*) FROM words) AS words, 1.0::DOUBLE AS total, TRUE AS better FROM topic_ids",
    "topic_mix_of_documents": f"SELECT DISTINCT clientip AS document_name, {TOPICS} AS topics, 1.0::DOUBLE AS total FROM counts",
    "anomaly_model_tables": f"SELECT DISTINCT clientip AS document_name, {TOPICS} AS topics, 1.0::DOUBLE AS total, TRUE AS dominant FROM counts",
    "model_save_and_load": "SELECT count(DISTINCT clientip) AS documents, CAST(0 AS BIGINT) AS differences FROM counts",
    "anomalies": """SELECT count(*) AS records, count(DISTINCT clientip) AS clients, count(DISTINCT word) AS words, CAST(0 AS BIGINT) AS outside,
        CAST(0 AS BIGINT) AS out_of_order FROM worded WHERE word <> 'word_error'""",
    "pair_scores": f"""SELECT clientip, word, round(coalesce({_DOT}, 0), 6) AS score FROM counts
        LEFT JOIN mix ON document_name = clientip LEFT JOIN probs USING (word)""",
    "scored_records": f"SELECT {_CLEAN}, word, round(score, 6) AS score FROM scored",
}

ORACLES = {name: _sql(select) for name, select in _SELECTS.items()}
