"""Proxy data derived from the given tables: analysis input, ranked list, raw lines.

The given tables hold no proxy log, so each event becomes one request for a page. Unusual
hosts, missing values and broken lines are planted by row number. The same SQL text serves
Spark and the checking database; only the timestamp format differs.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from proxysift import operators as op
from proxysift import sources
from proxysift.session import durable, shared_folder

TOPICS = 20

# The hour of some records is no number.
BAD_HOUR_SQL = (
    "CASE WHEN e.event_id % 101 = 0 THEN concat(substr({stamp}, 1, 11), 'xx', substr({stamp}, 14)) ELSE {stamp} END"
)
SPARK_STAMP = "date_format(e.ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
DUCK_STAMP = "strftime(e.ts, '%Y-%m-%dT%H:%M:%S')"

PROXY_SQL = r"""
SELECT e.event_id,
  {time} AS timestamp,
  concat('10.0.', CAST(floor(e.user_id / 256) AS INT), '.', CAST(e.user_id % 256 AS INT)) AS cIp,
  CASE WHEN e.event_id % 97 = 0 THEN NULL
       WHEN e.event_id % 73 = 0 THEN '10.1.2.3'
       WHEN e.event_id % 71 = 0 THEN 'www.intel.com'
       WHEN e.event_id % 67 = 0 THEN '1.2.3.4.in-addr.arpa'
       WHEN e.event_id % 61 = 0 THEN concat('www.shop.co.', {code})
       WHEN e.event_id % 59 = 0 THEN 'com.uk'
       WHEN e.event_id % 53 = 0 THEN concat('portal.com.', {code}, '.')
       WHEN e.event_id % 47 = 0 THEN 'localhost'
       ELSE replace(regexp_extract(p.url, '^[a-z]+://([^/?#]+)', 1), '.example.', '.') END AS csHost,
  CASE WHEN e.event_id % 89 = 0 THEN NULL WHEN e.event_type = 'purchase' THEN 'POST'
       WHEN e.event_type = 'signup' THEN 'CONNECT' ELSE 'GET' END AS csMethod,
  CASE WHEN e.user_id % 11 = 0 THEN NULL
       ELSE concat('agent/', CAST(e.user_id % 7 AS INT)) END AS csUserAgent,
  CASE WHEN e.event_type = 'view' THEN 'text/html' WHEN e.event_type = 'click' THEN 'image/png'
       WHEN e.event_type = 'signup' THEN NULL WHEN e.event_type = 'error' THEN '/'
       ELSE 'application/json' END AS rsContentType,
  CASE WHEN e.event_type = 'error' THEN '503' WHEN e.event_id % 83 = 0 THEN NULL
       ELSE '200' END AS scStatus,
  CASE WHEN e.event_id % 79 = 0 THEN NULL
       ELSE regexp_extract(p.url, '^[a-z]+://[^/]+(/[^?#]*)', 1) END AS csUriPath,
  CASE WHEN p.url LIKE '%?%' THEN regexp_extract(p.url, '([?][^#]*)', 1) ELSE NULL END AS csUriQuery,
  CASE WHEN p.url LIKE '%.html' THEN 'html' ELSE NULL END AS csUriExtension
FROM (SELECT *, event_id % {n_pages} AS page FROM {events}) e JOIN {pages} p ON p.page_id = e.page
"""

# Country codes of the planted hosts.
CODE_SQL = """CASE e.event_id % 8 WHEN 0 THEN 'uk' WHEN 1 THEN 'au' WHEN 2 THEN 'de' WHEN 3 THEN 'eu'
  WHEN 4 THEN 'krd' WHEN 5 THEN 'su' WHEN 6 THEN 'ac' ELSE 'jp' END"""

RANKED_SQL = r"""
SELECT page_id, regexp_extract(url, '://(?:www[.]|blog[.]|m[.])?([^./]+)', 1) AS label, url
FROM {pages}
"""

LINE_SQL = r"""concat(
  '<134>gw--sg1 proxy ', substr(timestamp,1,10), ' ',
  CASE WHEN event_id % 37 = 0 THEN 'not-a-time'
       WHEN event_id % 3 = 0 THEN concat(timestamp,'-05:00')
       ELSE concat(timestamp,'-0500') END, ' ', substr(timestamp,12,8), ' ',
  CASE WHEN event_id % 29 = 0 THEN '-' ELSE CAST(event_id % 5000 AS VARCHAR(20)) END,
  ' ', cIp, ' user', CAST(event_id % 17 AS INT),
  '  "Domain  Users" - OBSERVED "Search Engines;News" - ',
  coalesce(scStatus,'-'), ' TCP_MISS ', coalesce(csMethod,'-'), ' ', coalesce(rsContentType,'-'),
  ' http ', coalesce(csHost,'-'), ' 443 ', coalesce(csUriPath,'-'), ' ',
  coalesce(csUriQuery,'-'), ' ', coalesce(csUriExtension,'-'), ' ',
  CASE WHEN event_id % 41 = 0 THEN '"Agent 1.0 (X11'
       ELSE concat('"', coalesce(csUserAgent,'-'), ' (X11; Linux)"') END,
  ' 10.9.9.9 ', CAST(event_id * 1000003 AS BIGINT), ' 512 - "none"',
  CASE WHEN event_id % 43 = 0 THEN '' ELSE ' "none"' END)"""

LINES_SQL = f"SELECT event_id, CASE WHEN event_id % 31 = 0 THEN '   ' ELSE {LINE_SQL} END AS value FROM {{pv}}"

CSV_SQL = r'''
SELECT event_id,
 CASE WHEN event_id % 13 = 0 THEN concat(event_id, ',"', event_type)
      WHEN event_id % 19 = 0 THEN concat(event_id, ',', event_type)
      WHEN event_id % 5 = 0 THEN concat(event_id, ',"', event_type, ', ""x""",', user_id)
      WHEN event_id % 7 = 0
      THEN concat(event_id, ',', chr(92), '"', event_type, ', y', chr(92), '"', ',', user_id)
      ELSE concat(event_id, ',', event_type, ',', user_id) END AS value
FROM {events}
'''


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def proxy_view(spark: SparkSession, sf_dir: str, bad_hours: bool = True, spread: bool = False) -> DataFrame:
    """The analysis input with its ``event_id``; ``spread`` deals the events evenly over the cores first."""
    events = table(spark, sf_dir, "events")
    if spread:
        events = events.repartition(spark.sparkContext.defaultParallelism)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    text = PROXY_SQL.format(
        time=BAD_HOUR_SQL.format(stamp=SPARK_STAMP) if bad_hours else SPARK_STAMP,
        code=CODE_SQL, n_pages=pages.count(), events="{events}", pages="{pages}",
    )
    return spark.sql(text, events=events, pages=pages)


def stored_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis input as a stored table, dealt evenly over the cores.

    Its rows are made once. Read as a view, every condition of the cleaning would make the
    columns that it names again, in as few tasks as the events have row groups.
    """
    return durable(proxy_view(spark, sf_dir, spread=True))


def ranked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rank,domain`` lines for every third page, a line without a comma for the others."""
    hosts = spark.sql(RANKED_SQL, pages=table(spark, sf_dir, "pages"))
    line = F.concat_ws(",", F.col("page_id").cast("string"), F.concat("label", F.lit(".com")))
    return hosts.select(F.when(F.col("page_id") % 3 == 0, line).otherwise(F.col("label")).alias("value"))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``domain_label`` of the ranked list, without the detour over a file."""
    domain = F.split_part("value", F.lit(","), F.lit(2)).alias("domain")
    return sources.ranked_labels(ranked_lines(spark, sf_dir).select(domain))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LINES_SQL, pv=proxy_view(spark, sf_dir, bad_hours=False)).select("value")


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    return spark.sql(CSV_SQL, events=events).select("value")


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_records(stored_view(spark, sf_dir))


def worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = cleaned(spark, sf_dir)
    agents = durable(op.agent_counts(records))
    return op.with_words(records, ranked(spark, sf_dir), agents)


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return durable(op.document_word_counts(worded(spark, sf_dir)))


def client_of(number: str) -> Column:
    """Client address made from a number, shifted so that the first clients have no mix."""
    n = F.col(number) + 10
    return F.concat(
        F.lit("10.0."), F.floor(n / 256).cast("string"), F.lit("."), (n % 256).cast("string")
    )


def embedding_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``document_name, topic_prob_mix``: each embedding as it is."""
    return table(spark, sf_dir, "embeddings").select(
        client_of("vec_id").alias("document_name"), F.col("embedding").alias("topic_prob_mix")
    )


def fixed_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``document_name, topic_prob_mix``: each embedding folded into shares of the topics.

    A topic's share is the sum of the absolute values at its place and every ``TOPICS``
    places after it, divided by the sum of all.
    """
    sizes = F.transform("topic_prob_mix", lambda v: F.abs(v.cast("double")))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

    shares = F.transform(
        F.sequence(F.lit(0), F.lit(TOPICS - 1)),
        lambda topic: total(F.filter(sizes, lambda _, i: i % TOPICS == topic)) / total(sizes),
    )
    return embedding_mix(spark, sf_dir).select("document_name", shares.alias("topic_prob_mix"))


def fixed_weights(records: DataFrame) -> DataFrame:
    """``word, topic, weight``: records of a word by second of the minute, plus one."""
    bucket = F.split_part("p_time", F.lit(":"), F.lit(3)).cast("int") % TOPICS
    weights = [(F.count_if(bucket == t) + 1).cast("double").alias(f"w{t}") for t in range(TOPICS)]
    wide = records.groupBy("word").agg(*weights)
    return wide.select(
        "word", F.posexplode(F.array(*[f"w{t}" for t in range(TOPICS)])).alias("topic", "weight")
    )


def fixed_probs(records: DataFrame) -> DataFrame:
    """``word, topic_probs``; words of the response code 503 count as unseen."""
    probs = op.normalise_weights(fixed_weights(records))
    return durable(probs.where(~F.endswith("word", F.lit("_503"))))
