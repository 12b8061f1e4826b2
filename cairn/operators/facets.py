"""Faceted browsing of the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as v


def compliance_facet(value: Column, facet: str | None) -> Column:
    """The more general facets admit the more specific levels."""
    return F.lit(True) if facet in (None, "all") else value.isin(*v.COMPLIANCE_FACETS[facet])


def country_facet(country: Column, facet: str | None) -> Column:
    if facet in (None, "all"):
        return F.lit(True)
    return (country == "United States") if facet == "us-only" else (country != "United States")


def category_facet(primary: Column, meta: Column, facet: str | None) -> Column:
    """Equality with the primary category; ``avionics`` stands for all rows flagged as such."""
    return F.lit(True) if facet in (None, "all") else meta if facet == "avionics" else primary == facet


def member(categories: Column, sector: str, union: tuple[str, ...] = ()) -> Column:
    """A sector page lists vendors with its category, or with any of a meta-category's."""
    return F.arrays_overlap(categories, F.array(*[F.lit(x) for x in union])) if union else F.array_contains(categories, sector)


def apply(rows: DataFrame, tests: list[Column], query: str = "", search: str = "search") -> DataFrame:
    """All facets at once, then the substring search."""
    if query:
        tests = [*tests, F.col(search).contains(query.lower())]
    return rows.where(reduce(lambda a, b: a & b, tests, F.lit(True)))


def counts(rows: DataFrame, *facets: str) -> DataFrame:
    """Visible rows per value of each facet, all facets in one pass."""
    stacked = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in facets])).alias("x"))
    return stacked.groupBy("x.facet", "x.value").agg(F.count("*").alias("n"))


def sectors(sectors_dim: DataFrame, vendors: DataFrame, key: str, reviewed: str) -> DataFrame:
    """Vendors and latest review of each sector; sectors without vendors are dropped."""
    return sectors_dim.join(vendors.groupBy(key).agg(F.count("*").alias("vendors"), F.max(reviewed).alias("latest")), key)


def readiness_facet(value: Column, facet: str | None) -> Column:
    return F.lit(True) if facet in (None, "all") else value == facet


# The domains a vendor page may name.
DOMAINS = ("uav", "ugv", "usv", "uuv")


def valid_domains(domains: Column) -> Column:
    """Known domains only, in their own order."""
    return F.filter(domains, lambda x: x.isin(*DOMAINS))


# The order of sectors on the front page.
SECTOR_ORDER = (
    "avionics", "propulsion-electronics", "propulsion-mechanical", "power-systems", "flight-vehicle-control", "sensors-navigation", "isr-payloads", "electronic-warfare", "munitions",
    "communications", "mechanical-subsystems", "structures-materials", "airframes", "recovery-systems", "flight-termination", "ground-segment", "test-measurement",
)


def listed_order(value: Column, order: tuple[str, ...] = SECTOR_ORDER) -> Column:
    """Place in a fixed list, to sort by; what the list lacks comes first, at -1."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), value), F.lit(0)) - 1
