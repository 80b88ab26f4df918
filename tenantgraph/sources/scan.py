"""Sources: where a resource's rows come from. Columns outside the declared schema never leave the scan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantgraph.errors import QueryFailed
from tenantgraph.resource import Resource


def decoded(df: DataFrame, resource: Resource, *more: Column) -> DataFrame:
    """The declared columns, cast to their storage classes, and more; a column the data lacks is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in resource.schema], *more)


@dataclass(frozen=True)
class ParquetSource:
    """root/[database/]label.parquet, or what `views` makes for a label."""

    spark: SparkSession
    root: str
    views: dict[str, Callable[[SparkSession, str], DataFrame]] = field(default_factory=dict)

    def scan(self, resource: Resource, database: str | None) -> DataFrame:
        root = f"{self.root}/{database}" if database else self.root
        view = self.views.get(resource.label)
        return decoded(view(self.spark, root) if view else self.spark.read.parquet(f"{root}/{resource.label}.parquet"), resource)


@dataclass(frozen=True)
class MemorySource:
    """(database or None, label) -> DataFrame."""

    frames: dict[tuple[str | None, str], DataFrame]

    def scan(self, resource: Resource, database: str | None) -> DataFrame:
        if (key := (database, resource.label)) not in self.frames:
            raise QueryFailed("unknown_label", field=resource.label)
        return decoded(self.frames[key], resource)
