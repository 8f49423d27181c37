"""The star schema as a graph of lazy DataFrames, and its daily run."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemart.functions.times import Instant
from tidemart.operators.marts import customer_orders, order_revenue
from tidemart.operators.quality import DECLARED, dq_suite, null_counts
from tidemart.operators.staging import stg_customers, stg_lineitem, stg_orders
from tidemart.sources.tables import (
    RAW_TABLES,
    as_view,
    load_raw,
    materialize,
    register_models,
    scan_source,
)

STAGING = ("stg_customers", "stg_orders", "stg_lineitem")
MARTS = ("customer_orders", "order_revenue")


class Models(Mapping[str, DataFrame]):
    """Models by name, each put together when it is first asked for.

    A model refers to another one by taking its DataFrame. Nothing runs until a
    result is asked for, and only the tables and columns it needs are scanned.
    """

    def __init__(self, recipes: Mapping[str, Callable[[Models], DataFrame]]):
        self._recipes = recipes
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._recipes[name](self)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._recipes)

    def __len__(self) -> int:
        return len(self._recipes)


def build_models(spark: SparkSession, location: str, loaded_at: Instant = None) -> Models:
    """Staging and marts over a folder of Parquet files or a raw database."""

    def raw(table: str) -> DataFrame:
        return scan_source(spark, location, table)

    return Models(
        {
            "stg_customers": lambda m: stg_customers(raw("customer"), loaded_at),
            "stg_orders": lambda m: stg_orders(raw("orders"), loaded_at),
            "stg_lineitem": lambda m: stg_lineitem(raw("lineitem"), loaded_at),
            "customer_orders": lambda m: customer_orders(m["stg_customers"], m["stg_orders"]),
            "order_revenue": lambda m: order_revenue(m["stg_orders"], m["stg_lineitem"]),
        }
    )


def run_daily(
    spark: SparkSession,
    src_dir: str,
    raw: str = "raw",
    marts: str = "marts",
    location: str | None = None,
    tables: tuple[str, ...] = RAW_TABLES,
    buckets: Mapping[str, tuple[str, int]] | None = None,
) -> DataFrame:
    """Load what is missing, refresh the marts, register all models, run the tests.

    The NULL tests of a mart are measured while it is written.
    """
    load_raw(spark, src_dir, raw, tables, buckets, location)
    models = dict(build_models(spark, raw))
    for name in STAGING:
        models[name] = as_view(models[name], name)
    measured = {}
    for name in MARTS:
        models[name], measured[name] = materialize(
            models[name], f"{marts}.{name}", location, measure=null_counts(DECLARED[name]))
    register_models(models)
    return dq_suite(models, measured=measured)
