"""Labels and threshold colours for metric panels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Steps = Sequence[tuple[float | None, str]]

# The lower bound of each step and its status. ``None`` is the base.
SUCCESS_RATE_STEPS: Steps = ((None, "red"), (80, "yellow"), (95, "green"))
FAILED_RUNS_STEPS: Steps = ((None, "green"), (1, "red"))
SNAPSHOT_AGE_STEPS: Steps = ((None, "green"), (300, "yellow"), (3600, "red"))
PENDING_FILES_STEPS: Steps = ((None, "green"), (1, "red"))
MEMORY_STEPS: Steps = ((None, "green"), (536870912, "yellow"), (1073741824, "red"))
CPU_STEPS: Steps = ((None, "green"), (0.5, "yellow"), (1.0, "red"))
LAKE_STEPS: Mapping[str, Steps] = {
    "lake_snapshots": ((None, "blue"),),
    "lake_snapshots_per_hour": ((None, "green"),),
    "lake_tables": ((None, "purple"),),
    "lake_records": ((None, "blue"),),
    "lake_storage_bytes": ((None, "green"),),
    "lake_snapshot_age_seconds": SNAPSHOT_AGE_STEPS,
    "lake_files_pending_deletion": PENDING_FILES_STEPS,
    "lake_schemas": ((None, "blue"),),
}


def threshold_status(value: Column, steps: Steps) -> Column:
    """Status of the highest step that ``value`` reaches; NULL for NULL."""
    base = next(status for bound, status in steps if bound is None)
    bounded = sorted(((b, s) for b, s in steps if b is not None), reverse=True)
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, status in bounded:
        chain = chain.when(value >= bound, status)
    return chain.otherwise(base)


def table_label(schema: Column, table: Column) -> Column:
    """``schema.table`` as a series label."""
    return F.concat_ws(".", schema, table)


def choose(key: Column, values: Mapping[str, Column | str]) -> Column:
    """The value whose name equals ``key``; NULL for an unknown key."""
    chain = F
    for name, value in values.items():
        chain = chain.when(key == name, value)
    return chain
