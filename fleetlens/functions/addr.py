"""Host and port of an address string, as column expressions.

Three forms, following the reference's address tests:
``scheme://host:port/...`` (host lower-cased, port null if absent),
``host:port`` and a bare ``host`` (port null). Regexes rather than
``parse_url`` so that odd but common inputs (underscores, no scheme) do not
turn into nulls, and so the same patterns run in the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

URL_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^@/?#]*@)?(\[[^\]/]*\]|[^:/?#]*)(?::([0-9]*))?"
# Brackets of an IPv6 host are not part of the host name.
BRACKETS = r"^\[|\]$"
HOST_PORT_PATTERN = r"^([^:/]+):([0-9]+)$"


def _port(s: Column) -> Column:
    return F.when(s != "", s.try_cast("int"))


def host_of(addr: Column) -> Column:
    url = F.regexp_replace(F.regexp_extract(addr, URL_PATTERN, 1), BRACKETS, "")
    return (F.when(addr.rlike(URL_PATTERN), F.lower(url))
            .when(addr.rlike(HOST_PORT_PATTERN), F.regexp_extract(addr, HOST_PORT_PATTERN, 1))
            .otherwise(addr))


def port_of(addr: Column) -> Column:
    return (F.when(addr.rlike(URL_PATTERN), _port(F.regexp_extract(addr, URL_PATTERN, 2)))
            .when(addr.rlike(HOST_PORT_PATTERN), _port(F.regexp_extract(addr, HOST_PORT_PATTERN, 2)))
            .otherwise(F.lit(None).cast("int")))
