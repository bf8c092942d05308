"""One run over all layers: staging view, fact upsert, marts, quality report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from vitrine.operators.quality import rule_report, run_status
from vitrine.plans import marts
from vitrine.plans.audit import row_counts
from vitrine.plans.facts import facts, read_facts, upsert_facts
from vitrine.plans.graph import Model, build_models
from vitrine.plans.staging import staged
from vitrine.sources.tables import materialise_table


@dataclass
class Layers:
    """The stored tables of a run by layer name, rows counted as they were written, its stored quality report."""

    tables: dict[str, DataFrame]
    report: DataFrame | None = None
    rows: dict[str, int] = field(default_factory=dict)

    def audit(self) -> DataFrame:
        return row_counts(self.tables, self.rows)

    def quality(self) -> DataFrame:
        if self.report is not None:
            return self.report
        return rule_report(
            self.tables["staging.stg_products"],
            self.tables["marts.fct_products"],
            self.tables["marts.dim_sellers"],
        )

    def status(self) -> DataFrame:
        """COMPLETED or PARTIAL; the tables stay as they are in both cases."""
        return run_status(self.quality())


def _of_all(mart: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """A mart over the observations of a layer and the history."""
    return lambda live, history: mart(marts.all_observations(live, history))


STAGING = Model(staged, ("raw",), instant="collected_at")

# The marts that are rebuilt in full.  Most read the facts; the price series and the price
# variation read staging, so that rows the fact watermark left out still count.
MARTS = {
    "dim_sellers": Model(_of_all(marts.brand_dimension), ("fct_products", "history")),
    "agg_price_variation": Model(_of_all(marts.price_variation), ("stg_products", "history")),
    "agg_market_overview": Model(_of_all(marts.market_overview), ("fct_products", "history")),
    "agg_price_evolution": Model(_of_all(marts.price_evolution), ("stg_products", "history")),
    "agg_condition_distribution": Model(_of_all(marts.condition_distribution), ("fct_products", "history")),
    "agg_price_histogram": Model(_of_all(marts.price_histogram), ("fct_products", "history")),
    "agg_discount_vs_volume": Model(_of_all(marts.discount_buckets), ("fct_products", "history")),
    "agg_free_shipping": Model(_of_all(marts.free_shipping_mix), ("fct_products", "history")),
}


def layer_name(name: str) -> str:
    return {"raw": "raw.products", "stg_products": "staging.stg_products"}.get(name, f"marts.{name}")


def layers(tables: dict[str, DataFrame], rows: dict[str, int] | None = None) -> Layers:
    """Layers of stored tables by model name; the history is nobody's layer."""
    own = [name for name in tables if name != "history"]
    return Layers(
        {layer_name(name): tables[name] for name in own},
        rows={layer_name(name): rows[name] for name in own if name in rows} if rows else {},
    )


def run(spark: SparkSession, raw: DataFrame, history: DataFrame, home: str, at_once: int = 4) -> Layers:
    """Builds and stores every layer below ``home``: staging once, facts added to, marts and report rebuilt.

    The history is stored too, so that no mart derives it again.
    """
    first = build_models(
        spark, {"stg_products": STAGING, "history": Model(lambda: history)}, home, {"raw": raw}, at_once
    )
    fact_path = f"{home}/fct_products"
    upsert_facts(spark, fact_path, facts(first.tables["stg_products"]))
    there = {**first.tables, "fct_products": read_facts(spark, fact_path)}
    built = build_models(spark, MARTS, home, there, at_once)
    done = layers(built.tables, {**first.rows, **built.rows})
    return replace(done, report=materialise_table(done.quality(), f"{home}/quality"))


def rebuild(spark: SparkSession, raw: DataFrame, history: DataFrame, home: str, at_once: int = 4) -> Layers:
    """All layers from nothing, facts in full, each table as soon as what it needs is stored."""
    models = {
        "raw": Model(lambda: raw),
        "history": Model(lambda: history.select(*marts.OBSERVATION_COLUMNS)),
        "stg_products": STAGING,
        "fct_products": Model(facts, ("stg_products",)),
        **MARTS,
    }
    built = build_models(spark, models, home, at_once=at_once)
    return layers(built.tables, built.rows)
