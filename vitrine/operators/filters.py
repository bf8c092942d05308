"""The report filter: price range, condition, brands, period."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MarketFilter:
    """What a report user has selected; ``None`` or an empty list means all."""

    as_of: date
    period_days: int = 7
    min_price: int = 0
    max_price: int | None = None
    condition: str | None = None
    brands: list[str] = field(default_factory=list)

    @property
    def cutoff(self) -> date:
        return self.as_of - timedelta(days=self.period_days)

    def predicate(self) -> Column:
        chosen = (
            (F.col("price") > 0)
            & (F.col("price") >= self.min_price)
            & (F.col("collected_at") >= F.lit(self.cutoff))
        )
        if self.max_price is not None:
            chosen = chosen & (F.col("price") <= self.max_price)
        if self.condition is not None:
            chosen = chosen & (F.col("condition") == self.condition)
        if self.brands:
            chosen = chosen & F.col("brand").isin(self.brands)
        return chosen

    def rows_of(self, facts: DataFrame) -> DataFrame:
        """The selected rows of ``facts``; of stored facts only the folders since the cutoff are opened.

        The instant alone says nothing about the folders, which go by the
        collection date, so the cutoff is put to both.
        """
        chosen = facts.filter(self.predicate())
        if "collection_date" in facts.columns:
            chosen = chosen.filter(F.col("collection_date") >= F.lit(self.cutoff))
        return chosen

    def of_brands(self, brand: Column) -> Column:
        """Brand choice alone, for reports that apply it after their limit."""
        return brand.isin(self.brands) if self.brands else F.lit(True)
