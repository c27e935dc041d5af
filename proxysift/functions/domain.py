"""Domain features of a host name.

The registered domain sits just before a suffix of one label (a country code or a generic
top-level domain) or two (a generic one in front of a country code). All expressions work
on the string itself with ``substring_index``; no label array is built per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from proxysift import constants as C
from proxysift.functions.entropy import string_entropy


def _trimmed(host: Column) -> Column:
    return F.rtrim(host, F.lit("."))


def _dots(name: Column) -> Column:
    return F.length(name) - F.length(F.replace(name, F.lit("."), F.lit("")))


def _label_from_end(name: Column, position: int) -> Column:
    return F.substring_index(F.substring_index(name, ".", -position), ".", 1)


def _suffix_labels(name: Column, countries: Sequence[str] | None) -> Column:
    """Number of suffix labels, NULL when the name has none (addresses, bare names)."""
    last = F.substring_index(name, ".", -1)
    generic = F.when(_label_from_end(name, 2).isin(*C.TOP_LEVEL_DOMAINS), 2).otherwise(1)
    return (
        F.when(~F.contains(name, F.lit(".")), F.lit(None))
        .when(last.isin(*C.TOP_LEVEL_DOMAINS), 1)
        .when(last.isin(*(countries or C.COUNTRY_CODES)), generic)
    )


def extract_domain(host: Column, countries: Sequence[str] | None = None) -> Column:
    """The registered domain of a host, ``None`` (the text) when there is none."""
    name = _trimmed(host)
    suffix = _suffix_labels(name, countries)
    return (
        F.when(host.isNull(), F.lit(None))
        .when(suffix == 1, _label_from_end(name, 2))
        .when((suffix == 2) & (_dots(name) >= 2), _label_from_end(name, 3))
        .otherwise(C.NO_DOMAIN)
    )


def extract_subdomain(host: Column, countries: Sequence[str] | None = None) -> Column:
    """Everything in front of the domain, ``None`` (the text) when there is nothing."""
    name = _trimmed(host)
    suffix = _suffix_labels(name, countries)

    def front(labels: int) -> Column:
        tail = F.substring_index(name, ".", -labels)
        return F.left(name, F.length(name) - F.length(tail) - 1)

    return (
        F.when(host.isNull(), F.lit(None))
        .when((suffix == 1) & (_dots(name) >= 2), front(2))
        .when((suffix == 2) & (_dots(name) >= 3), front(3))
        .otherwise(C.NO_DOMAIN)
    )


def host_labels(host: Column) -> Column:
    """The labels of a host; empty labels at its end do not count."""
    name = _trimmed(host)
    return F.when((name == "") & (host != ""), F.array().cast("array<string>")).otherwise(
        F.split(name, r"\.")
    )


def label_count(host: Column) -> Column:
    name = _trimmed(host)
    return F.when((name == "") & (host != ""), 0).otherwise(_dots(name) + 1)


def _drop_last(labels: Column, endings: Sequence[str]) -> Column:
    return F.when(
        F.try_element_at(labels, F.lit(-1)).isin(*endings),
        F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0))),
    ).otherwise(labels)


def strip_country_code(labels: Column, countries: Sequence[str] | None = None) -> Column:
    return _drop_last(labels, countries or C.COUNTRY_CODES)


def strip_top_level_domain(labels: Column) -> Column:
    return _drop_last(labels, C.TOP_LEVEL_DOMAINS)


def popularity_class(domain: Column, is_ranked: Column, own_domain: str = C.OWN_DOMAIN) -> Column:
    """2 for the own domain, 1 for a ranked one, 0 for any other."""
    ranked = F.when(is_ranked, 1).otherwise(0)
    return F.when(domain == own_domain, 2).otherwise(ranked) if own_domain else ranked


def domain_info(
    host: Column, domain: Column, subdomain: Column, is_ranked: Column, own_domain: str
) -> Column:
    """Struct of the domain features, from a domain and subdomain already extracted."""
    exists = subdomain != C.NO_DOMAIN
    return F.struct(
        domain.alias("domain"),
        popularity_class(domain, is_ranked, own_domain).alias("topDomain"),
        subdomain.alias("subdomain"),
        F.when(exists, F.length(subdomain)).otherwise(0).alias("subdomainLength"),
        F.when(exists, string_entropy(subdomain)).otherwise(0.0).alias("subdomainEntropy"),
        label_count(host).alias("numPeriods"),
    )
