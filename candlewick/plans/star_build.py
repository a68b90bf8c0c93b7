"""Build the warehouse layers for a fixture (lazily, one Catalyst plan)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from candlewick.operators import clean, enrich, series, star
from candlewick.sources import fixtures
from candlewick.sources.spine import spine_from_bounds


@dataclass
class Warehouse:
    """Silver -> staged -> enriched -> dims -> fact for one bars input."""

    silver: DataFrame
    meta: DataFrame
    spine: DataFrame
    chunk_rows: int | str | None = series.AUTO

    @cached_property
    def staged(self) -> DataFrame:
        return clean.stage_prices(self.silver)

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich.enrich(self.staged, chunk_rows=self.chunk_rows)

    @cached_property
    def dim_asset(self) -> DataFrame:
        return star.dim_asset(self.meta)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.spine)

    @cached_property
    def fact(self) -> DataFrame:
        return star.fact_price(self.enriched, self.dim_asset, self.dim_date)


def fixture_calendar(t: fixtures.Tables) -> DataFrame:
    return spine_from_bounds(fixtures.calendar_bounds(t), "lo", "hi")


def main_warehouse(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    t = fixtures.Tables(spark, sf_dir)
    return Warehouse(fixtures.bars(t), fixtures.asset_meta(t), fixture_calendar(t), **kw)


def sparse_warehouse(spark: SparkSession, sf_dir: str, **kw) -> Warehouse:
    t = fixtures.Tables(spark, sf_dir)
    return Warehouse(fixtures.bars_sparse(t), fixtures.asset_meta_sparse(t),
                     fixture_calendar(t), **kw)
