"""Deterministic identifiers."""

from __future__ import annotations

from uuid import UUID

from pyspark.sql import Column
from pyspark.sql import functions as F


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version 5 identifier of `name`, lower case."""
    seed = F.concat(F.unhex(F.lit(UUID(namespace).hex)), name.cast("binary"))
    digest = F.sha1(seed)
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        variant,
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )
