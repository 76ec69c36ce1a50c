"""The 13 models, their inputs, and a lazy warehouse over them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from remitlens.plans import facts, marts, staging
from remitlens.sources import bindings


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]


# In dependency order.
MODELS: dict[str, Model] = {
    "stg_tickets": Model(staging.stg_tickets, ("raw_tickets",)),
    "stg_cdrs": Model(staging.stg_cdrs, ("raw_cdrs",)),
    "stg_transfers": Model(staging.stg_transfers, ("raw_transfers",)),
    "stg_payments": Model(staging.stg_payments, ("raw_payments",)),
    "fct_telecom_calls": Model(facts.fct_telecom_calls, ("stg_cdrs",)),
    "fct_financial_transfers": Model(facts.fct_financial_transfers, ("stg_transfers",)),
    "fct_support_tickets": Model(facts.fct_support_tickets, ("stg_tickets",)),
    "fct_payments": Model(facts.fct_payments, ("stg_payments",)),
    "mart_fraud_prevention": Model(
        marts.mart_fraud_prevention,
        ("fct_telecom_calls", "fct_financial_transfers", "fct_support_tickets"),
    ),
    "mart_customer_360": Model(
        marts.mart_customer_360,
        ("fct_telecom_calls", "fct_financial_transfers", "fct_support_tickets", "fct_payments"),
    ),
    "mart_revenue_analytics": Model(
        marts.mart_revenue_analytics, ("fct_payments", "fct_telecom_calls", "fct_financial_transfers")
    ),
    "mart_network_quality": Model(marts.mart_network_quality, ("stg_cdrs",)),
    "mart_corridor_analytics": Model(marts.mart_corridor_analytics, ("stg_transfers",)),
}


# What an unevaluated mart reads instead of a full fact: the part of it that marts use.
MART_INPUTS = {"fct_financial_transfers": (facts.transfer_totals, "stg_transfers")}


class Warehouse:
    """Raw inputs plus every model as an unevaluated DataFrame, built on first use.

    A report on a mart stays one Spark plan down to the scans, so only the columns it needs are aggregated. A run that
    writes the models (see ``runner``) builds the marts from the written facts instead.
    """

    def __init__(self, raw: Mapping[str, Callable[[], DataFrame]]):
        self._raw = dict(raw)
        self._built: dict[str, DataFrame] = {}

    @classmethod
    def over(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        """The warehouse over the supplied tables."""
        tables = bindings.SourceTables(spark, sf_dir)
        return cls({name: partial(bind, tables) for name, bind in bindings.RAW_INPUTS.items()})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            if name in self._raw:
                self._built[name] = self._raw[name]()
            else:
                model = MODELS[name]
                source_of = self._mart_input if name.startswith("mart_") else self.__getitem__
                self._built[name] = model.build(*[source_of(source) for source in model.inputs])
        return self._built[name]

    def _mart_input(self, name: str) -> DataFrame:
        if name not in MART_INPUTS:
            return self[name]
        build, source = MART_INPUTS[name]
        key = f"{name}/mart_input"
        if key not in self._built:
            self._built[key] = build(self[source])
        return self._built[key]
