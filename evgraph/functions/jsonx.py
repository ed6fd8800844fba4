"""JSON: parsing that doesn't fail, canonical text, digests, and keys at any depth."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType


def string_list(text: Column) -> Column:
    """A JSON array of strings; empty for anything that is none."""
    return F.coalesce(F.from_json(text, "array<string>", {"mode": "PERMISSIVE"}), F.array().cast("array<string>"))


def field(text: Column, path: str, kind: str = "string") -> Column:
    """A field of a JSON text, null where text or field is none."""
    return F.try_variant_get(F.try_parse_json(text), path, kind)


def unwrapped(text: Column, key: str) -> Column:
    """A field that may be wrapped as {"value": ...}."""
    v = F.try_parse_json(text)
    return F.coalesce(F.try_variant_get(v, f"$.{key}.value", "string"), F.try_variant_get(v, f"$.{key}", "string"))


@F.pandas_udf(StringType())
def canonical(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON with sorted keys and no spaces; null for what isn't JSON or holds no finite number."""

    def of(text):
        try:
            return None if text is None else json.dumps(json.loads(text), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)
        except ValueError:
            return None

    for s in parts:
        yield s.map(of)


def _sorted(value: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        parts = [_sorted(value[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*parts)) if parts else value
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _sorted(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(F.transform_values(value, lambda _, v: _sorted(v, kind.valueType)))))
    return value


def canonical_of(frame: DataFrame, value: Column) -> Column:
    """JSON text of a typed column of a frame: keys sorted at any depth, no spaces, nulls as such, so that a field that is null and one
    that is absent differ. All built in; what has no type but is text goes through `canonical`."""
    kind = frame.select(value.alias("v")).schema["v"].dataType
    return F.to_json(_sorted(value, kind), {"ignoreNullFields": "false"})


def keys_at_any_depth(text: Column) -> Column:
    """Lower-case keys of all objects in a JSON text at any depth, sorted, once each; none for what isn't JSON. All built in: the text is
    written anew by the JSON library, so that a quote that is no end of a string can be renamed and strings are what lies between two
    quotes; those that a colon follows are keys. An object that has a key twice has it."""
    whole = F.get_json_object(text, "$")
    plain = F.replace(F.replace(whole, F.lit("\\\\"), F.lit("\\u005c")), F.lit('\\"'), F.lit("\\u0022"))
    strings = F.regexp_extract_all(F.when(F.substring(whole, 1, 1).isin("{", "["), plain), F.lit('"[^"]*+"(?:[ \\t\\r\\n]*+:)?'), F.lit(0))
    keys = F.array_join(F.transform(F.filter(strings, lambda k: F.endswith(k, F.lit(":"))), lambda k: F.rtrim(F.rtrim(k, F.lit(":")))), ",")
    return F.array_sort(F.array_distinct(F.transform(string_list(F.concat(F.lit("["), F.coalesce(keys, F.lit("")), F.lit("]"))), lambda k: F.lower(F.trim(k)))))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def is_digest(text: Column) -> Column:
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def canonical_digest(value: object) -> str:
    """Of one value on the driver, as `digest(canonical(...))` of its text."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


NODES = ArrayType(StructType([StructField("id", StringType()), StructField("types", ArrayType(StringType())), StructField("name", StringType()), StructField("url", StringType()), StructField("same_as", ArrayType(StringType()))]))
LD_BLOCK = r"(?is)<script[^>]*type\s*=\s*[\"']?application/ld\+json[\"']?[^>]*>(.*?)</script>"


def ld_blocks(html: Column) -> Column:
    """Texts of a page's linked-data blocks."""
    return F.filter(F.regexp_extract_all(html, F.lit(LD_BLOCK), 1), lambda b: F.trim(b) != "")


@F.pandas_udf(NODES)
def ld_nodes(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Nodes of a linked-data text, `@graph` and lists flattened however deep; none for what isn't JSON. `sources.linked` has them as
    variants with their places."""

    def listed(x):
        return [] if x is None else x if isinstance(x, list) else [x]

    def plain(x):
        return x if isinstance(x, str) and x else None

    def of(text):
        try:
            stack, out = [json.loads(text)] if text else [], []
        except (ValueError, RecursionError):
            return []
        while stack:
            x = stack.pop()
            if isinstance(x, list):
                stack += x[::-1]
            elif isinstance(x, dict):
                if any(k not in ("@context", "@graph") for k in x):
                    types = [re.sub(r".*[/#]", "", t) for t in listed(x.get("@type")) if isinstance(t, str)]
                    out.append({"id": plain(x.get("@id")) or plain(x.get("url")), "types": types, "name": plain(x.get("name")) or plain(x.get("headline")), "url": plain(x.get("url")), "same_as": [s for s in listed(x.get("sameAs")) if isinstance(s, str)]})
                stack += listed(x.get("@graph"))[::-1]
        return out

    for s in parts:
        yield s.map(of)
