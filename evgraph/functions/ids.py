"""Identifier policy: which schemes identify, how values are normalised, and which values mean absence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import nfkc

# Scheme, category, scope, uniqueness, mutability, authority, eligible for automatic resolution.
RULES = (
    ("github_id", "identifier", "source", "unique", "immutable", "github", True),
    ("github_node_id", "identifier", "source", "unique", "immutable", "github", True),
    ("orcid", "identifier", "global", "unique", "stable", "orcid", True),
    ("viaf", "identifier", "global", "unique", "stable", "viaf", True),
    ("isni", "identifier", "global", "unique", "stable", "isni", True),
    ("wikidata", "identifier", "global", "unique", "stable", "wikidata", True),
    ("loc_authority", "identifier", "global", "unique", "stable", "loc", True),
    ("openalex_author_id", "identifier", "source", "unique", "stable", "openalex", True),
    ("dblp_pid", "identifier", "source", "unique", "stable", "dblp", True),
    ("youtube_channel_id", "identifier", "source", "unique", "stable", "youtube", True),
    ("software_heritage_origin", "identifier", "source", "unique", "stable", "software_heritage", False),
    ("github_login", "alias", "source", "unique", "mutable", "github", False),
    ("x_handle", "alias", "source", "unknown", "mutable", "x", False),
    ("username", "alias", "source", "unknown", "mutable", "source", False),
    ("real_name", "attribute", "none", "non_unique", "mutable", "source", False),
    ("name", "attribute", "none", "non_unique", "mutable", "source", False),
    ("company", "attribute", "none", "non_unique", "mutable", "source", False),
    ("location", "attribute", "none", "non_unique", "mutable", "source", False),
    ("topic", "attribute", "none", "non_unique", "mutable", "source", False),
    ("biography", "attribute", "none", "non_unique", "mutable", "source", False),
    ("bio", "attribute", "none", "non_unique", "mutable", "source", False),
    ("website", "attribute", "none", "non_unique", "mutable", "source", False),
    ("profile_type", "attribute", "none", "non_unique", "mutable", "source", False),
    ("account_created_at", "attribute", "none", "non_unique", "stable", "source", False),
    ("followers", "metric", "none", "non_unique", "mutable", "source", False),
    ("follower_count", "metric", "none", "non_unique", "mutable", "source", False),
)
# Numbers and words that stand for no account.
NUMERIC_ABSENT = ("0", "-1", "-99", "99999999")
TEXT_ABSENT = ("none", "null", "nil", "n/a", "na", "unknown", "undefined", "ghost", "deleted", "deleted-user", "anonymous", "unclaimed", "placeholder")

# How old platform names are read: the same everywhere, the same within their source, names that may change.
GLOBAL_STABLE = ("orcid", "viaf", "isni", "wikidata", "loc_authority", "library_of_congress", "ror")
SOURCE_STABLE = ("github_id", "github_numeric_id", "github_user_id", "github_node_id", "youtube_channel_id", "openalex_author_id", "dblp_pid", "software_heritage_id")
MUTABLE = ("github_login", "x_handle", "reddit_user", "mastodon_handle", "bluesky_handle", "youtube_handle", "username", "login", "handle")

ELIGIBLE = tuple(r[0] for r in RULES if r[1] == "identifier" and r[3] == "unique" and r[6])
UNIQUE = tuple(r[0] for r in RULES if r[3] == "unique")


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RULES), "scheme string, category string, scope string, uniqueness string, mutability string, authority string, auto_eligible boolean")


def classified(frame: DataFrame, scheme: str = "scheme") -> DataFrame:
    """Adds the registry's columns; a scheme that isn't in it is quarantined as unknown."""
    rules = F.broadcast(registry(frame.sparkSession).withColumnRenamed("scheme", "_scheme"))  # 26 rows
    out = frame.withColumn("_key", F.lower(F.trim(F.coalesce(F.col(scheme), F.lit(""))))).join(rules, F.col("_key") == F.col("_scheme"), "left")
    unknown = {"category": "unknown", "scope": "none", "uniqueness": "unknown", "mutability": "unknown", "authority": "unclassified", "auto_eligible": False}
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in unknown.items()}).drop("_key", "_scheme")


def platform_key(platform: Column) -> Column:
    return F.replace(F.lower(F.trim(platform)), F.lit("-"), F.lit("_"))


def semantics(platform: Column) -> Column:
    """Scope, stability and uniqueness of an old platform's values; an unlisted or null one promises nothing."""
    key = platform_key(platform)
    of = lambda *v: F.struct(*[F.lit(x).alias(n) for x, n in zip(v, ("scope", "stability", "uniqueness"), strict=True)])
    return F.when(key.isin(*GLOBAL_STABLE), of("global", "stable", "unique")).when(key.isin(*SOURCE_STABLE), of("source", "stable", "unique")).when(key.isin(*MUTABLE), of("source", "mutable", "unknown")).otherwise(of("source", "unknown", "unknown"))


def auto_resolvable(scheme: Column) -> Column:
    return F.lower(F.trim(scheme)).isin(*ELIGIBLE)


def absent(scheme: Column, value: Column) -> Column:
    """Whether a normalised value stands for no account rather than for one."""
    key, text = F.lower(F.trim(F.coalesce(scheme, F.lit("")))), F.trim(F.coalesce(value, F.lit("")))
    low = F.lower(text)
    return (
        (text == "")
        | low.isin(*TEXT_ABSENT)
        | (key.isin("github_id", "github_node_id") & text.isin(*NUMERIC_ABSENT))
        | ((key == "github_id") & F.coalesce((text.try_cast("decimal(38,0)") <= 0), F.lit(False)))
        | ((key == "orcid") & text.rlike("^[0X-]+$"))
        | ((key == "wikidata") & low.isin("q0", "q"))
    )


def normalised(scheme: Column, value: Column, text: Column | None = None) -> Column:
    """A value in its scheme's form. `text`: the trimmed NFKC form, if it is at hand as a column."""
    key = F.lower(F.trim(F.coalesce(scheme, F.lit(""))))
    text = F.trim(nfkc(F.coalesce(value.cast("string"), F.lit("")))) if text is None else text
    low = F.lower(text)
    digits = F.upper(F.regexp_replace(F.replace(low, F.lit("https://orcid.org/"), F.lit("")), "[^0-9xX]", ""))
    orcid = F.when(F.length(digits) == 16, F.regexp_replace(digits, r"^(.{4})(.{4})(.{4})(.{4})$", "$1-$2-$3-$4")).otherwise(F.upper(text))
    entity = F.regexp_extract(text, r"(?i)(?:^|/)(Q\d+)$", 1)
    rest = F.regexp_replace(text, r"^[^:/?#]+://", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(rest, r"^([^/?#]*)", 1), r"^[^@]*@|:\d*$", ""))
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), "/+$", "")
    whole = F.regexp_replace(text, r"^([+-]?)0*(\d+)$", "$1$2")
    return (
        F.when(text == "", F.lit(""))
        .when(key == "github_id", F.when(text.rlike(r"^[+-]?\d+$"), F.regexp_replace(F.regexp_replace(whole, r"^\+", ""), r"^-0$", "0")).otherwise(text))
        .when(key.isin("github_node_id", "youtube_channel_id"), text)
        .when(key.isin("github_login", "x_handle", "username"), F.lower(F.regexp_replace(text, "^@+", "")))
        .when(key == "orcid", orcid)
        .when(key == "wikidata", F.upper(F.when(entity != "", entity).otherwise(text)))
        .when(key == "website", F.when(host != "", F.concat(host, path)).otherwise(F.regexp_replace(low, "/+$", "")))
        .otherwise(low)
    )


def quoted(text: Column) -> Column:
    """A JSON string literal."""
    return F.regexp_extract(F.to_json(F.struct(text.cast("string").alias("x"))), r'^\{"x":(.*)\}$', 1)


def stable_id(prefix: str, *parts: Column, length: int = 24) -> Column:
    """`prefix:` and the first digits of a digest of the parts as JSON strings."""
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(F.concat_ws("\x1f", *[quoted(p) for p in parts]), 256), 1, length))


def observation_id(source: Column, kind: Column, native: Column) -> Column:
    """Of a source's record about a thing: never a canonical id."""
    digest = F.substring(F.sha2(F.concat_ws("\x1f", source, kind, native), 256), 1, 24)
    return F.concat(F.lit("obs:"), source, F.lit(":"), kind, F.lit(":"), digest)


def percent_encoded(text: Column) -> Column:
    """Percent encoding with %20 for a space."""
    return F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))


def auth_token(key: Column, secret: Column, at: Column) -> Column:
    return F.sha1(F.concat(key, secret, at))
