"""Keeps costly column expressions from being repeated by the planner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame, fields: Column, replaced: list[str]) -> DataFrame:
    """Add the struct's fields as columns, behind a generator of exactly one row.

    The planner copies plain column expressions into every later filter that reads them. For parsing
    that would repeat the costly part many times; it does not look through a generator.
    """
    kept = [c for c in df.columns if c not in replaced]
    return df.select(*kept, F.inline(F.array(fields)))
