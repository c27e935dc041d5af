"""Domain features, popularity class and behaviour word of every record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.functions import (
    behaviour_word,
    domain_info,
    extract_domain,
    extract_subdomain,
    popularity_class,
)
from proxysift.functions.binding import with_bound
from proxysift.operators.lookup import lookup_join


def with_domains(df: DataFrame, host: str = "host") -> DataFrame:
    """Append ``domain`` and ``subdomain``."""
    column = F.col(host)
    return df.withColumns({"domain": extract_domain(column), "subdomain": extract_subdomain(column)})


def _with_ranking(df: DataFrame, ranked: DataFrame, host: str) -> DataFrame:
    """Append ``_domain`` and ``_ranked``, whether the ranked list holds the domain."""
    labels = ranked.select(F.col("domain_label").alias("_domain"), F.lit(True).alias("_ranked"))
    return lookup_join(with_bound(df, "_domain", extract_domain(F.col(host))), labels, "_domain")


def with_popularity(
    df: DataFrame, ranked: DataFrame, own_domain: str = C.OWN_DOMAIN, host: str = "host"
) -> DataFrame:
    """Append ``popularity``: 2 own domain, 1 ranked, 0 other."""
    found = _with_ranking(df, ranked, host)
    level = popularity_class(F.col("_domain"), F.col("_ranked"), own_domain)
    return found.select(*df.columns, level.alias("popularity"))


def with_domain_info(
    df: DataFrame, ranked: DataFrame, own_domain: str = "", host: str = "host"
) -> DataFrame:
    """Append ``domain_info``, the struct of all domain features."""
    found = _with_ranking(df, ranked, host).withColumn("_front", extract_subdomain(F.col(host)))
    info = domain_info(F.col(host), F.col("_domain"), F.col("_front"), F.col("_ranked"), own_domain)
    return found.select(*df.columns, info.alias("domain_info"))


def with_words(
    df: DataFrame, ranked: DataFrame, agents: DataFrame, own_domain: str = C.OWN_DOMAIN
) -> DataFrame:
    """Append ``word`` to cleaned records.

    ``agents`` are the counts per user agent of the data the words are made for.
    """
    counts = agents.select("useragent", F.col("count").alias("_agent_count"))
    featured = lookup_join(with_popularity(df, ranked, own_domain), counts, "useragent")
    word = behaviour_word(
        F.col("popularity"), F.col("host"), F.col("p_time"), F.col("reqmethod"), F.col("fulluri"),
        F.col("resconttype"), F.col("_agent_count"), F.col("respcode"),
    )
    return with_bound(featured, "word", word).select(*df.columns, "word")
