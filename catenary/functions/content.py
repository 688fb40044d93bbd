"""Content: canonical JSON, hashes, normalised titles, dates and years."""

from __future__ import annotations

import hashlib
import json
import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a normalised title, at most.
TITLE_BYTES = 512


def _number(x: float) -> str:
    """A float in its shortest form, with exponents as short as they go (1e-8)."""
    if math.isinf(x) or math.isnan(x):
        return "null"
    return re.sub(r"e([+-])0*(\d+)$", lambda m: f"e{'-' if m[1] == '-' else '+'}{m[2]}", repr(x)).replace("e+", "e")


def canonical_json(value) -> str:
    """JSON without spaces, members by name."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical_json(value[k])}" for k in sorted(value, key=str.encode)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical_json, value)) + "]"
    return _number(value) if isinstance(value, float) else json.dumps(value, ensure_ascii=False)


def decoded_json(text: str | None):
    """A JSON text without superfluous encodings; None if it is none."""
    try:
        value = json.loads(text) if text else None
        while isinstance(value, str):
            value = json.loads(value)
        return value
    except ValueError:
        return None


@F.pandas_udf(T.StringType())
def content_hash(texts: pd.Series) -> pd.Series:
    """SHA-256 of the canonical form of a JSON text; null where it is no JSON."""

    def one(text: str | None) -> str | None:
        value = decoded_json(text)
        return None if value is None else hashlib.sha256(canonical_json(value).encode()).hexdigest()

    return texts.map(one)


def normalized(text: str | None) -> str:
    """Compatibility form, each character in lower case by itself, what is neither letter nor number a space, spaces single."""
    if not text:
        return ""
    lowered = "".join(c.lower() for c in unicodedata.normalize("NFKC", text))
    return " ".join("".join(c if _alphanumeric(c) else " " for c in lowered).split())


def _alphanumeric(c: str) -> bool:
    """A letter, a number, or a vowel sign, which Unicode counts as alphabetic though it is a mark."""
    return c.isalnum() or (unicodedata.category(c) in ("Mn", "Mc") and unicodedata.combining(c) == 0)


@F.pandas_udf(T.StringType())
def normalize_title(texts: pd.Series) -> pd.Series:
    """The normalised title; null if nothing is left or it is too long."""
    out = texts.map(normalized)
    return out.where(out.map(lambda t: 0 < len(t.encode()) <= TITLE_BYTES), None)


def year_of(text: Column) -> Column:
    """A year as an integer or in the first four characters of a text; null outside 1..9999."""
    year = F.substring(text, 1, 4).try_cast("int")
    return F.when(year.between(1, 9999), year)


def strict_date(text: Column) -> Column:
    """A calendar date written year-month-day; null for what is no day of the calendar."""
    return F.when(text.rlike(r"^\d{1,4}-\d{1,2}-\d{1,2}$"), F.try_to_date(text, "yyyy-M-d"))


def imdb_id(text: Column) -> Column:
    return F.when(text.rlike("^tt[0-9]+$"), text)


def positive_id(text: Column) -> Column:
    number = text.try_cast("bigint")
    return F.when(number > 0, number)


def key_uri(source: Column, key: Column) -> Column:
    """source://kind/id of a key kind:id."""
    return F.concat(source, F.lit("://"), F.substring_index(key, ":", 1), F.lit("/"), F.regexp_replace(key, "^[^:]*:", ""))


def domain_of(key: Column) -> Column:
    return F.split_part(key, F.lit(":"), F.lit(1))


def record_kind(text: Column) -> Column:
    """A record kind in the singular, null if it is none."""
    lowered = F.lower(text)
    return F.when(lowered == "series", lowered).when(lowered.rlike("^(movie|season|episode)s?$"), F.regexp_replace(lowered, "s$", ""))
