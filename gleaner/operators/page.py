"""Per-page values every extraction branch shares."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.profiles import SourceProfile
from gleaner.schema import entity_struct


@dataclass(frozen=True)
class PageContext:
    """Columns of the page row that entities copy."""

    source: SourceProfile
    url: Column
    date: Column
    city: Column
    crawl_id: Column
    category: Column

    @classmethod
    def of(cls, source: SourceProfile) -> PageContext:
        return cls(
            source, F.col("url"), F.col("_date"), F.col("_city"), F.col("crawl_id"), F.col("_category"))

    def entity(self, **fields: Column) -> Column:
        shared = {
            "platform": F.lit(self.source.name), "city": self.city, "date": self.date,
            "source_url": self.url, "crawl_id": self.crawl_id,
        }
        return entity_struct(**{**shared, **fields})
