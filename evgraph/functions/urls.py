"""URLs: normalisation, package URLs, and routes to a work's bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import percent_encoded

_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def normalised_url(value: Column) -> Column:
    """Lower scheme and host, no default port, no `utm_` parameters, the others sorted, no fragment, no trailing slash."""
    text = F.trim(value)
    scheme, place, path, query = (F.regexp_extract(text, _PARTS, i) for i in range(1, 5))
    scheme = F.lower(scheme)
    place = F.lower(F.regexp_replace(place, r"^[^@]*@", ""))
    port = F.regexp_extract(place, r":(\d+)$", 1)
    host = F.regexp_replace(place, r":\d*$", "")
    default = (port == "") | ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80"))
    place = F.when(default, host).otherwise(F.concat(host, F.lit(":"), port))
    path = F.when(path.isin("", "/"), F.lit("/")).otherwise(F.regexp_replace(path, "/+$", ""))
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(F.lower(p), F.lit("utm_")))
    pairs = F.array_sort(F.transform(kept, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", "")).otherwise(F.lit("")).alias("v"))))
    query = F.array_join(F.transform(pairs, lambda p: F.concat(p["k"], F.lit("="), p["v"])), "&")
    out = F.concat(scheme, F.lit("://"), place, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when((scheme == "") | (host == ""), text).otherwise(out)


def package_url(registry: Column, name: Column, version: Column) -> Column:
    kind = F.lower(registry)
    return F.concat(F.lit("pkg:"), kind, F.lit("/"), percent_encoded(name), F.when(version.isNotNull() & (version != ""), F.concat(F.lit("@"), percent_encoded(version))).otherwise(F.lit("")))


def routes(domain: Column, ref: Column) -> Column:
    """Routes to the bytes of a work, cheapest first: an array of (route, url)."""
    of = lambda name, *url: F.struct(F.lit(name).alias("route"), F.concat(*[F.lit(u) if isinstance(u, str) else u for u in url]).alias("url"))
    none = F.array().cast("array<struct<route:string,url:string>>")
    return (
        F.when(domain == "book", F.array(of("origin", "https://www.gutenberg.org/ebooks/", ref, ".txt.utf-8"), of("html", "https://www.gutenberg.org/ebooks/", ref)))
        .when(domain == "github", F.array(of("origin", "https://github.com/", ref), of("api", "https://api.github.com/repos/", ref)))
        .when(F.startswith(domain, F.lit("youtube")), F.array(of("origin", "https://www.youtube.com/watch?v=", ref)))
        .otherwise(none)
    )
