"""Claims prepared once per session and data folder, shared by all queries.

As in any claims workflow the silver table is written once and everything else reads
it.  Feature columns are row-local expressions on top, so they are not stored.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from claimlens.models.baseline import mean_severity
from claimlens.operators.cleaning import filter_claims, number_claims
from claimlens.operators.features import FeatureSpec, apply_features, fit_features
from claimlens.operators.split import learn_rows, with_split
from claimlens.sources import catalog
from claimlens.sources.claims import VIEW_KEY, claims_of, claims_view, joined_sources
from claimlens.sources.storage import sorted_in_memory, stage, stage_path, unstage

# the test tables start in 1995; the first year is dropped in place of 1987
AFTER_YEAR = 1995
DATABASE = "claims_lab"


class Workspace:
    def __init__(self, spark: SparkSession, data_dir: str) -> None:
        self.spark = spark
        self.data_dir = data_dir

    @property
    def bronze(self) -> DataFrame:
        """All claims as they arrive."""
        return claims_view(self.spark, self.data_dir)

    @cached_property
    def bronze_table(self) -> str:
        """Name of the external table holding the claims as received."""
        catalog.create_database(self.spark, DATABASE, stage_path(self.spark, "database"))
        name = f"{DATABASE}.bronze_{uuid.uuid4().hex[:8]}"
        catalog.publish(
            self.bronze, name, stage_path(self.spark, "bronze"), "Claims as received"
        )
        return name

    @property
    def filtered(self) -> DataFrame:
        view = claims_view(self.spark, self.data_dir, first_year=AFTER_YEAR + 1)
        return filter_claims(view, AFTER_YEAR)

    @property
    def filtered_sources(self) -> DataFrame:
        """The same claims as columns of the joined sources."""
        joined = joined_sources(self.spark, self.data_dir, first_year=AFTER_YEAR + 1)
        sources = [c for c in joined.columns if c not in (*VIEW_KEY, "Claim")]
        return filter_claims(claims_of(joined, *sources), AFTER_YEAR).select(*joined.columns)

    @cached_property
    def silver(self) -> DataFrame:
        """Filtered claims numbered by descending size, with split and shuffle key.

        What is joined, sorted and written on the way are source columns; the claims' own are made last.
        The hashes behind the split cost more than reading it, so they are written too.  The
        joined claims are written before they are sampled and sorted; that table and the
        sorted one go when silver is there.
        """
        with sorted_in_memory(self.spark):
            joined = stage(self.filtered_sources, "filtered-claims")
        numbered = number_claims(joined, VIEW_KEY)
        silver = stage(with_split(claims_of(numbered, "Id")), "silver")
        unstage(numbered)
        unstage(joined)
        return silver

    @cached_property
    def spec(self) -> FeatureSpec:
        return fit_features(self.silver)

    @cached_property
    def features(self) -> DataFrame:
        return apply_features(self.silver, self.spec)

    @cached_property
    def mean_claim(self) -> float:
        return mean_severity(learn_rows(self.features))


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, data_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace(spark, key[1])
    return _open[key]
