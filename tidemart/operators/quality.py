"""Declared data-quality tests, each a count of failing rows or keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.joins import anti_join_orphans


@dataclass(frozen=True)
class ModelTests:
    """Tests of one model; ``relationships`` lists (column, parent model, parent key)."""

    not_null: Sequence[str]
    unique: str | None = None
    relationships: Sequence[tuple[str, str, str]] = field(default=())


# The declared tests, 10 not-null, 4 unique and 1 relationship.
DECLARED: Mapping[str, ModelTests] = {
    "stg_customers": ModelTests(("customer_id", "customer_name"), "customer_id"),
    "stg_orders": ModelTests(
        ("order_id", "customer_id", "order_amount"),
        "order_id",
        (("customer_id", "stg_customers", "customer_id"),),
    ),
    "stg_lineitem": ModelTests(("order_id", "line_number")),
    "customer_orders": ModelTests(("customer_id",), "customer_id"),
    "order_revenue": ModelTests(("order_id", "customer_id"), "order_id"),
}


def _nulls(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def _rows(wide: DataFrame, model: Column, readings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(model, column, test, failures) rows from the columns of a one-row frame."""
    cells = [
        F.struct(
            F.lit(column).alias("column"), F.lit(test).alias("test"),
            F.col(source).alias("failures"),
        )
        for source, column, test in readings
    ]
    return wide.select(model.alias("model"), F.explode(F.array(*cells)).alias("t")).select(
        "model", "t.*"
    )


def dq_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """NULL rows of each column, all columns in one pass."""
    wide = df.agg(*[_nulls(name).alias(name) for name in columns])
    return _rows(wide, F.lit(""), [(name, name, "not_null") for name in columns]).select(
        "column", "failures"
    )


def dq_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Key values that occur more than once, with their count; NULL keys are ignored."""
    return (
        df.dropna(subset=list(columns))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def dq_grain(fact: DataFrame, *grain: str) -> DataFrame:
    """Violations of the declared grain: one row per date, artist, track and source."""
    return dq_unique(fact, *(grain or ("event_date", "artist_id", "track_id", "source")))


def dq_relationships(child: DataFrame, key: str, parent: DataFrame, pkey: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    orphans = anti_join_orphans(child, key, parent, pkey)
    return orphans.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("failures"))


def _own_tests(name: str, df: DataFrame, tests: ModelTests) -> DataFrame:
    """not_null and unique tests of one model in one scan.

    With a unique test the rows are first counted per key, and the NULL counts
    ride along on the same shuffle.
    """
    nulls = {f"_null_{i}": column for i, column in enumerate(tests.not_null)}
    readings = [(alias, column, "not_null") for alias, column in nulls.items()]
    if tests.unique is None:
        wide = df.agg(*[_nulls(column).alias(alias) for alias, column in nulls.items()])
        return _rows(wide, F.lit(name), readings)
    per_key = df.groupBy(F.col(tests.unique).alias("_key")).agg(
        F.count(F.lit(1)).alias("_copies"),
        *[_nulls(column).alias(alias) for alias, column in nulls.items()],
    )
    repeated = F.col("_key").isNotNull() & (F.col("_copies") > 1)
    wide = per_key.agg(
        F.count_if(repeated).alias("_repeated"),
        *[F.coalesce(F.sum(alias), F.lit(0)).alias(alias) for alias in nulls],
    )
    return _rows(wide, F.lit(name), [("_repeated", tests.unique, "unique"), *readings])


def null_counts(tests: ModelTests) -> dict[str, Column]:
    """The not_null tests of a model as aggregates, to be measured while it is written."""
    return {column: _nulls(column) for column in tests.not_null}


def _measured_tests(df: DataFrame, name: str, nulls: Mapping[str, int]) -> DataFrame:
    rows = [(name, column, "not_null", failures) for column, failures in nulls.items()]
    return df.sparkSession.createDataFrame(rows, "model string, column string, test string, failures bigint")


def dq_suite(
    models: Mapping[str, DataFrame],
    declared: Mapping[str, ModelTests] = DECLARED,
    measured: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """All declared tests as (model, column, test, failures, passed), in one job.

    ``measured`` has the NULL counts of models that were measured while they were
    written; of those only the key is read again, for its unique test.
    """
    parts = []
    for name, tests in declared.items():
        known = (measured or {}).get(name)
        if known is not None:
            parts.append(_measured_tests(models[name], name, known))
            tests = replace(tests, not_null=())
        if tests.not_null or tests.unique:
            parts.append(_own_tests(name, models[name], tests))
        for column, parent, pkey in tests.relationships:
            failures = dq_relationships(models[name], column, models[parent], pkey)
            parts.append(_rows(failures, F.lit(name), [("failures", column, "relationships")]))
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumn("passed", F.col("failures") == 0)
        .orderBy("model", "column", "test")
    )
