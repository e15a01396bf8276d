"""Adding a data source: two readers are all it has to supply."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from gaugeloom.plans.series import harvest_series
from gaugeloom.schema import DEFAULT_MINUTES, SEQ, STATION, TIME, VALUE
from gaugeloom.session import stage
from gaugeloom.sources import gauge, model, tide

Reader = Callable[..., DataFrame]


@dataclass
class SourceRegistry:
    """Source name -> (observation reader, metadata reader). Names are case-insensitive."""

    readers: dict[str, tuple[Reader, Reader]] = field(default_factory=dict)

    def register(self, name: str, observations: Reader, metadata: Reader) -> None:
        self.readers[name.upper()] = (observations, metadata)

    def names(self) -> list[str]:
        return list(self.readers)

    def _of(self, name: str) -> tuple[Reader, Reader]:
        if name.upper() not in self.readers:
            raise ValueError(f"unknown source {name!r}; known: {', '.join(self.readers)}")
        return self.readers[name.upper()]

    def observations(self, spark: SparkSession, name: str, path: str, **options) -> DataFrame:
        return self._of(name)[0](spark, path, **options)

    def metadata(self, spark: SparkSession, name: str, path: str, **options) -> DataFrame:
        return self._of(name)[1](spark, path, **options)

    def series(
        self, spark: SparkSession, name: str, path: str, minutes: int = DEFAULT_MINUTES, **options
    ) -> DataFrame:
        """Repaired, resampled, aligned and filled series of a source, whose rows are read and joined once."""
        rows = self.observations(spark, name, path, **options).select(STATION, TIME, VALUE, SEQ)
        return harvest_series(stage(rows, name.lower()), minutes)


def standard_sources() -> SourceRegistry:
    """The tide, gauge and model sources; more can be registered."""
    found = SourceRegistry()
    found.register("NOAA", tide.read_tide_obs, tide.read_tide_meta)
    found.register("CONTRAILS", gauge.read_product, gauge.read_meta)
    found.register("ASGS", model.read_product, model.read_meta)
    return found
