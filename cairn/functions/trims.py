"""Trimming of given characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(chars: str, c: Column) -> Column:
    return F.trim(c, F.lit(chars))


def rstrip(chars: str, c: Column) -> Column:
    return F.rtrim(c, F.lit(chars))


def lstrip(chars: str, c: Column) -> Column:
    return F.ltrim(c, F.lit(chars))
