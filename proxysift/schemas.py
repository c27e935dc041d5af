"""Column layouts of the tables the two jobs read and write."""

from pyspark.sql import types as T

# Parsed proxy record, in line order.
PROXY_FIELDS = (
    "time", "syslog_timestamp", "time_taken", "c_ip", "cs_username", "cs_auth_group",
    "x_exception_id", "sc_filter_result", "cs_categories", "cs_referer", "sc_status",
    "s_action", "cs_method", "rs_content_type", "cs_uri_scheme", "cs_host", "cs_uri_port",
    "cs_uri_path", "cs_uri_query", "cs_uri_extension", "cs_user_agent", "s_ip", "sc_bytes",
    "cs_bytes", "x_virus_id", "x_bluecoat_application_name",
    "x_bluecoat_application_operation",
)
TIME_FIELDS = ("orig_timestamp", "iso_timestamp", "epoch_timestamp")
CASTS = {
    "time_taken": "int", "sc_status": "int", "cs_uri_port": "int",
    "sc_bytes": "bigint", "cs_bytes": "bigint",
}

# Column of the ingested table -> column the analysis reads.
ANALYSIS_COLUMNS = {
    "orig_timestamp": "timestamp", "c_ip": "cIp", "cs_host": "csHost",
    "cs_method": "csMethod", "cs_user_agent": "csUserAgent",
    "rs_content_type": "rsContentType", "sc_status": "scStatus",
    "cs_uri_path": "csUriPath", "cs_uri_query": "csUriQuery",
    "cs_uri_extension": "csUriExtension",
}
CLEAN_NAMES = {
    "cIp": "clientip", "csHost": "host", "csMethod": "reqmethod",
    "csUserAgent": "useragent", "rsContentType": "resconttype", "scStatus": "respcode",
}
CLEAN_COLUMNS = (
    "p_date", "p_time", "clientip", "host", "reqmethod", "useragent", "resconttype",
    "respcode", "fulluri",
)


def _strings(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


LINES = _strings(["value"])
REJECTS = _strings(["raw", "error", "stage"])
ANALYSIS_INPUT = _strings(ANALYSIS_COLUMNS.values())
CLEAN = _strings(CLEAN_COLUMNS)
_TYPES = {"int": T.IntegerType(), "bigint": T.LongType()}
PARSED = T.StructType(
    [
        T.StructField(name, _TYPES.get(CASTS.get(name), T.StringType()))
        for name in (*PROXY_FIELDS[1:], *TIME_FIELDS[:2])
    ]
    + [T.StructField("epoch_timestamp", T.LongType()), T.StructField("event_date", T.StringType())]
)
