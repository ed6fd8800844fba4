"""Names and plain text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Honorifics that a comparison key leaves out.
HONORIFICS = ("sir", "dame", "lord", "lady", "baron", "baroness", "earl", "duke", "rev", "dr", "prof", "jr", "sr", "saint", "st", "mrs", "mr", "ms")
NOT_LETTERS = r"[^\p{L}\p{N}\p{M}]+"


@F.pandas_udf(StringType())
def folded(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """NFKC, then case folding; the one step of a name key that has no built-in function."""
    for s in parts:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x).casefold())


@F.pandas_udf(StringType())
def nfkc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def words_of(text: Column) -> Column:
    """Tokens of a text: runs of letters, numbers and marks."""
    return F.filter(F.split(F.lower(text), NOT_LETTERS), lambda w: w != "")


def unaccented(text: Column) -> Column:
    """Latin letters without their diacritics, as a search index keeps them."""
    return F.translate(F.lower(text), "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿ", "aaaaaaceeeeiiiinoooooouuuuyy")


def search_tokens(text: Column) -> Column:
    return words_of(unaccented(text))


def collapsed(text: Column) -> Column:
    """Lower case with single spaces."""
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _key(text: Column) -> Column:
    plain = F.regexp_replace(text, r"\([^)]*\)", " ")
    kept = F.filter(F.split(plain, NOT_LETTERS), lambda w: (w != "") & ~w.isin(*HONORIFICS))
    return F.array_join(kept, " ")


def name_key(name: Column) -> Column:
    """Comparison key of a name: folded, without parentheses, punctuation and honorifics; never an id."""
    return _key(folded(F.coalesce(name.cast("string"), F.lit(""))))


def ascii_name_key(name: Column) -> Column:
    """`name_key` for ASCII text, all built in."""
    return _key(F.lower(F.coalesce(name.cast("string"), F.lit(""))))


def parts_of(name: Column, key=name_key) -> tuple[Column, Column]:
    """Surname and given names for comparison: cut at a comma, else the last word is the surname."""
    whole = key(name)
    words = F.split(whole, " ")
    many = F.size(words) >= 2
    comma = F.contains(name, F.lit(","))
    surname = F.when(comma, key(F.substring_index(name, ",", 1))).when(many, F.element_at(words, -1)).otherwise(whole)
    given = F.when(comma, key(F.regexp_replace(name, r"^[^,]*,", ""))).when(many, F.array_join(F.slice(words, 1, F.size(words) - 1), " ")).otherwise(F.lit(""))
    return surname, given


def first_text(*columns: Column, default: str | None = None) -> Column:
    """The first value that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in columns], F.lit(default))


def shortened(text: Column, size: int = 200) -> Column:
    """At most `size` characters, null if none are left."""
    return F.nullif(F.substring(F.coalesce(text, F.lit("")), 1, size), F.lit(""))


def before_slash(text: Column) -> Column:
    return F.substring_index(text, "/", 1)


def after_slash(text: Column) -> Column:
    """All after the first slash, empty if there is none."""
    return F.when(F.contains(text, F.lit("/")), F.regexp_replace(text, r"^[^/]*/", "")).otherwise(F.lit(""))


def html_escaped(value: Column) -> Column:
    """A value as text of a page or of a quoted attribute; empty for null."""
    out = F.coalesce(value.cast("string"), F.lit(""))
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(plain), F.lit(safe))
    return out


def strict_int(raw: Column, default: int | None = None) -> Column:
    """The whole number that a text is, with a sign, single underscores between digits and white space around it allowed; the default
    for a null or empty text; null for all else, and beyond 64 bits."""
    digits = F.replace(F.regexp_replace(raw, r"^\s+|\s+$", ""), F.lit("_"), F.lit(""))
    whole = F.when(raw.rlike(r"^\s*[+-]?[0-9]+(?:_[0-9]+)*\s*$"), digits.try_cast("bigint"))
    return F.when(raw.isNull() | (raw == ""), F.lit(default).cast("bigint")).otherwise(whole)


def repository_path(path: Column) -> Column:
    """A path within a repository: forward slashes, no empty or `.` steps, no leading dots and slashes."""
    steps = F.filter(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda x: ~x.isin("", "."))
    return F.regexp_replace(F.array_join(steps, "/"), "^[./]+", "")


def path_matches(pattern: Column, path: Column) -> Column:
    """Whether a path is one that a pattern owns: `root/**` is the root and all below it; else `*`, `?` and `[...]` as in a shell, where
    `*` goes over slashes."""
    whole, glob = repository_path(path), F.regexp_replace(F.replace(pattern, F.lit("\\"), F.lit("/")), "^[./]+", "")
    root = F.regexp_replace(glob, r"/+\*\*$|/\*\*$", "")
    within = (whole == root) | F.startswith(whole, F.concat(root, F.lit("/")))
    quoted = F.regexp_replace(F.regexp_replace(glob, r"([\\.+^$(){}|])", r"\\$1"), r"\[!", "[^")
    regex = F.concat(F.lit("^(?s:"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit(r")\z"))
    return F.when(F.endswith(glob, F.lit("/**")), within).otherwise(F.rlike(whole, regex))
