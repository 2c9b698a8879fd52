"""Surrogate keys, audit hashes and ids taken out of URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col

# Fixed value: text that stands for NULL inside a surrogate key.
NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str | Column, null_text: str = NULL_IN_KEY) -> Column:
    """32-digit md5 over the parts, joined by ``-``; a NULL part has its own text."""
    texts = [F.coalesce(as_col(p).cast("string"), F.lit(null_text)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def audit_hash(*parts: str | Column, separator: str = "|") -> Column:
    """SHA-256 over all parts; the separator keeps ('ab','c') apart from ('a','bc')."""
    texts = [F.coalesce(as_col(p).cast("string"), F.lit("NULL")) for p in parts]
    return F.sha2(F.concat_ws(separator, *texts), 256)


def id_from_uri(uri: str | Column, resource: str | None = None) -> Column:
    """Number at the end of a URI, optionally only below ``/resource/``; NULL without one."""
    head = f"/{resource}/" if resource else ""
    return F.regexp_extract(as_col(uri), f"{head}([0-9]+)$", 1).try_cast("bigint")


def number_after(text: str | Column, marker: str) -> Column:
    """First number behind a marker, such as ``deputado=`` in a file path."""
    return F.regexp_extract(as_col(text), f"{marker}([0-9]+)", 1).try_cast("bigint")


def key_or_placeholder(key: str | Column, natural: str | Column, prefix: str) -> Column:
    """The dimension key, or a readable stand-in for a row without a match."""
    return F.coalesce(as_col(key), F.concat(F.lit(prefix), as_col(natural).cast("string")))
