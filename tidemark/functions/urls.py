"""URL keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fetch_key(url: Column) -> Column:
    """One request, one key: scheme and host in lower case, no fragment, no closing slash, query kept."""
    bare = F.regexp_replace(url, "#.*$", "")
    part = lambda g: F.regexp_extract(bare, "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\\?.*)?$", g)
    path = F.regexp_replace(part(3), "/+$", "")
    whole = F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(path == "", "/").otherwise(path), F.when(part(4) == "?", "").otherwise(part(4)))
    return F.when(part(1) == "", bare).otherwise(whole)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
