"""URL helpers (C13) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a news site keeps the numeric article id in its URLs.
ARTICLE_ID_PATTERNS = {
    "liputan6": r"/read/(\d+)/",
    "merdeka": r"-(\d+)-mvk\.html",
}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def article_id(url: Column | str, source: Column | str) -> Column:
    """Numeric article id by the source's URL pattern; NULL when the source has none or no match."""
    u, s = _c(url), _c(source)
    out = F.lit(None).cast("string")
    for name, pat in ARTICLE_ID_PATTERNS.items():
        out = F.when(s == name, F.nullif(F.regexp_extract(u, pat, 1), F.lit(""))).otherwise(out)
    return out


def absolute(url: Column | str, base: Column | str) -> Column:
    """A site-relative link made absolute against `base` (links starting with 'http' are kept)."""
    u = _c(url)
    return F.when(u.startswith("http"), u).otherwise(F.concat(_c(base), u))


def first_segment(url: Column | str) -> Column:
    """Category = first path segment ('/bisnis/read/1/x' -> 'bisnis')."""
    path = F.regexp_replace(_c(url), r"^(https?://[^/]+)?/+", "")
    return F.split(path, "/").getItem(0)


def video_id(url: Column | str) -> Column:
    """Value of the `v` query parameter ('' when absent, like the reference's default)."""
    return F.coalesce(F.try_parse_url(_c(url), F.lit("QUERY"), F.lit("v")), F.lit(""))


def proxy_to_origin(url: Column | str) -> Column:
    """A local-proxy URL carrying the real host in `?host=` -> https://<host><path>; others kept."""
    u = _c(url)
    host = F.try_parse_url(u, F.lit("QUERY"), F.lit("host"))
    path = F.coalesce(F.try_parse_url(u, F.lit("PATH")), F.lit(""))
    return F.when(u.contains("localhost") & host.isNotNull() & (host != ""),
                  F.concat(F.lit("https://"), host, path)).otherwise(u)
