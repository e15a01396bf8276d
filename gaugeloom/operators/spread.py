"""Bucket numbers that follow an exact count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_count(keys: DataFrame, per_bucket: int) -> Column:
    """How many buckets hold these distinct keys at about `per_bucket` each (scalar subquery)."""
    return keys.agg(F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(per_bucket)))).scalar()
