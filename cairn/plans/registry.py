"""All queries of the catalog engine and their oracles, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import catalog, documents, evidence, extras, folds, news, records, runs, streams, urls

_PLANS = (urls, folds, evidence, catalog, news, runs, documents, streams, records, extras)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _plan in _PLANS:
    QUERIES |= _plan.QUERIES
    ORACLES |= _plan.ORACLES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages kept of each site and the quality of what is kept."""
    return urls.site_quality(spark, sf_dir)
