"""Canonical text forms and digests."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_json(fields: dict[str, Column], *, keep_nulls: bool = False) -> Column:
    """A JSON object with sorted keys, no spaces and a closing newline; nulls left out unless kept."""
    body = F.struct(*(fields[k].alias(k) for k in sorted(fields)))
    options = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.concat(F.to_json(body, options), F.lit("\n"))


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def prefixed_digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), sha256(text))


def crc32_hex(data: Column) -> Column:
    """CRC-32 as eight upper-case hex digits."""
    return F.lpad(F.hex(F.crc32(data)), 8, "0")


@F.pandas_udf(T.StringType())
def fold_case(text: pd.Series) -> pd.Series:
    """NFC, then full case folding, which no built-in function does (ß becomes ss)."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFC", t).casefold())


@F.pandas_udf(T.StringType())
def percent_encode(path: pd.Series) -> pd.Series:
    """A path with all but unreserved characters and slashes percent-encoded; a space is %20."""
    from urllib.parse import quote

    return path.map(lambda p: None if p is None else quote(p, safe="/"))


def base64_components(path: Column) -> Column:
    """Parts of a path between slashes, each in base64."""
    return F.transform(F.split(path, "/"), lambda c: F.base64(c.cast("binary")))


def path_of_components(parts: Column) -> Column:
    return F.array_join(F.transform(parts, lambda c: F.unbase64(c).cast("string")), "/")


def strict_field(json: Column, path: str, kind: str) -> Column:
    """A field of open JSON if it has its kind (string, long, double or boolean), else null: never a converted one."""
    types = {"string": ("STRING",), "long": ("BIGINT",), "double": ("DOUBLE", "BIGINT"), "boolean": ("BOOLEAN",)}
    found = F.try_variant_get(F.try_parse_json(json), path, "variant")
    own = F.schema_of_variant(found)
    fits = own.isin(*types[kind]) if kind != "double" else own.isin(*types[kind]) | own.startswith("DECIMAL")
    return F.when(fits, F.try_variant_get(found, "$", kind))
