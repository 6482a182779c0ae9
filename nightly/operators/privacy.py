"""Masking of personal columns."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F, types as T

# Hashes depend on them.
SALT_ENV = "SPS_SALT"
DEFAULT_SALT = "sleep-pattern-salt"
# A column is sensitive if its name contains one of these.
SENSITIVE_PARTS = ("name", "email", "id")
EXEMPT = ("user_id", "source")
HASH_CHARS = 16


def is_sensitive(column: str, fields: Iterable[str] = ()) -> bool:
    """Named explicitly, or by a part of the name; exempt names never are.

    The name test is a plain substring test, so `midpoint_hour_local` counts.
    """
    name = column.lower()
    if name in EXEMPT:
        return False
    return name in {f.lower() for f in fields} or any(p in name for p in SENSITIVE_PARTS)


def scrub(
    df: DataFrame, fields: Iterable[str] = (), *, salt_env: str = SALT_ENV, salt: str | None = None
) -> DataFrame:
    """Drop sensitive numeric columns and replace other sensitive values by a salted hash.

    NULL stays NULL.
    """
    if salt is None:
        salt = os.environ.get(salt_env, DEFAULT_SALT)
    fields = list(fields)
    kept = []
    for field in df.schema.fields:
        if not is_sensitive(field.name, fields):
            kept.append(F.col(field.name))
        elif not isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            salted = F.concat(F.lit(f"{salt}:"), F.col(field.name).cast("string"))
            kept.append(F.substring(F.sha2(salted, 256), 1, HASH_CHARS).alias(field.name))
    return df.select(*kept)
