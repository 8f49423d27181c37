"""Panel queries over metric samples (metric, labels, ts, value).

A series is a metric with one full label set and has at most one sample per
instant.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.functions import ratio, table_label, threshold_status
from tidemart.functions.status import CPU_STEPS, LAKE_STEPS, Steps, choose
from tidemart.functions.times import Instant, instant_like, micros
from tidemart.operators.filters import label_nonempty, positive_limit

SECOND = 1_000_000

# Metric names of the container panels.
MEMORY = "container_memory_working_set_bytes"
MEMORY_LIMIT = "container_spec_memory_limit_bytes"
CPU = "container_cpu_usage_seconds_total"
NETWORK = {
    "rx": "container_network_receive_bytes_total",
    "tx": "container_network_transmit_bytes_total",
}
DISK = {
    "read": "container_fs_reads_bytes_total",
    "write": "container_fs_writes_bytes_total",
}


def label(name: str) -> Column:
    return F.col("labels")[name]


def series_id() -> Column:
    """Canonical text of the full label set, equal for equal sets."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries("labels"))))


def sum_by(samples: DataFrame, name: str = "name") -> DataFrame:
    """Sum over all series that share a label value, per instant."""
    return (
        samples.groupBy(label(name).alias(name), "ts").agg(F.sum("value").alias("value"))
    )


def memory_by_name(samples: DataFrame) -> DataFrame:
    """Working-set memory per container over time."""
    return sum_by(label_nonempty(samples.where(F.col("metric") == MEMORY)))


def last_max(samples: DataFrame, *by: str) -> DataFrame:
    """Last value and maximum of each series over the range."""
    return samples.groupBy(*by).agg(
        F.max_by("value", "ts").alias("last"), F.max("value").alias("max")
    )


def last_not_null(samples: DataFrame, *by: str) -> DataFrame:
    """Last value that is not NULL, for a single-number panel."""
    return (
        samples.where(F.col("value").isNotNull())
        .groupBy(*by)
        .agg(F.max_by("value", "ts").alias("value"))
    )


def _by_rows(cut: DataFrame, span: int, rows: int) -> DataFrame:
    """Adds ``_own``, the start of a sample's chunk, and ``_width``, the chunk's length in microseconds.

    A first pass counts the samples of each series by slot, an hour or more.
    Slots with more than ``rows`` are halved until they hold about as many, but not below
    ``span``. Only those slots are in the table that is joined.
    """
    halvings = max(0, (max(3600 * SECOND, 12 * span) // span - 1).bit_length())
    slot = span << halvings
    place = ["metric", "_series", "_slot"]
    cut = cut.withColumn("_slot", F.col("_us") - F.pmod(F.col("_us"), F.lit(slot)))
    dense = cut.groupBy(*place).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows)
    level = F.least(F.ceil(F.log2(F.col("_n") / rows)), F.lit(halvings)).cast("int")
    width = F.expr(f"shiftright({slot}L, coalesce(_level, 0))")
    return (
        cut.join(dense.select(*place, level.alias("_level")), place, "left")
        .withColumn("_width", width)
        .withColumn("_own", F.col("_us") - F.pmod(F.col("_us"), F.col("_width")))
    )


def counter_rate(
    samples: DataFrame,
    window_s: int = 120,
    chunk_s: int | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Per-second increase of every counter over the last ``window_s`` seconds.

    The increase is the sum of the steps between neighbouring samples in
    (t - window, t]; after a reset (a smaller value) the step is the new value.
    It is divided by the time between the first and the last of those samples
    and is NULL when there are fewer than two. Samples without a value are left out.

    One series may hold a large share of all samples, so a series is cut into
    time chunks, each its own window partition. A sample within ``window_s`` of
    the end of its chunk is also given to the next one, which is all that
    chunk's first rates can look back at: results equal those of an uncut
    series. ``chunk_s`` is at least the window, by default twelve windows or an
    hour, so that at most one row in twelve is copied on even data. With
    ``chunk_rows`` chunks follow the samples instead: after a pass that counts them, a
    series is cut the finer the denser it is, down to one window, so that no task
    holds much more than twice the given number or twice the samples of a window.

    Both windows are running ones, linear in the rows. A sliding frame would
    visit every sample of the window again for each of its rows, which is
    quadratic where samples are dense.
    """
    span = window_s * SECOND
    known = (
        samples.where(F.col("value").isNotNull()).withColumn("_series", series_id())
        .withColumn("_us", micros(F.col("ts")))
    )
    if chunk_rows is None:
        width = max(chunk_s or max(3600, 12 * window_s), window_s) * SECOND
        own = F.col("_us") - F.pmod(F.col("_us"), F.lit(width))
        known = known.withColumns({"_own": own, "_width": F.lit(width)})
    else:
        known = _by_rows(known, span, chunk_rows)
    next_start = F.col("_own") + F.col("_width")
    seen_later = F.col("_us") > next_start - span
    cut = known.withColumn(
        "_chunk",
        F.explode(F.when(seen_later, F.array("_own", next_start)).otherwise(F.array("_own"))),
    )
    series = Window.partitionBy("metric", "_series", "_chunk")
    upwards = series.orderBy("_us")
    value, before = F.col("value"), F.col("_before")
    step = F.when(value < before, value).otherwise(value - before)
    risen = F.sum(F.coalesce(step, F.lit(0.0))).over(
        upwards.rowsBetween(Window.unboundedPreceding, 0)
    )
    own_chunk = F.col("_chunk") == F.col("_own")
    sample = F.struct(F.col("_us").alias("at"), F.lit(1).alias("kind"))
    bound = F.struct((F.col("_us") - span).alias("at"), F.lit(0).alias("kind"))
    # Walking back in time, the sample passed last before a bound is the first in its window.
    first = F.last(
        F.when(F.col("e.kind") == 1, F.struct("_us", "_risen")), ignorenulls=True
    ).over(
        series.orderBy(F.desc("e.at"), F.asc("e.kind")).rowsBetween(Window.unboundedPreceding, 0)
    )
    seconds = (F.col("_us") - F.col("_first._us")) / F.lit(float(SECOND))
    return (
        cut.withColumn("_before", F.lag("value").over(upwards))
        .withColumn("_risen", risen)
        .withColumn("e", F.explode(F.when(own_chunk, F.array(sample, bound))
                                   .otherwise(F.array(sample))))
        .withColumn("_first", first)
        .where(F.col("e.kind") == 0)
        .withColumn("rate", ratio(F.col("_risen") - F.col("_first._risen"), seconds))
        .select("metric", "labels", "ts", "rate")
    )


def io_rates(
    samples: DataFrame, directions: Mapping[str, str], window_s: int = 120
) -> DataFrame:
    """Byte rates per series of several counters, in one pass over the samples."""
    wanted = label_nonempty(samples.where(F.col("metric").isin(*directions.values())))
    direction = choose(F.col("metric"), {name: text for text, name in directions.items()})
    return counter_rate(wanted, window_s).select(
        direction.alias("direction"), "labels", "ts", "rate"
    )


def network_rates(samples: DataFrame, window_s: int = 120) -> DataFrame:
    return io_rates(samples, NETWORK, window_s)


def disk_rates(samples: DataFrame, window_s: int = 120) -> DataFrame:
    return io_rates(samples, DISK, window_s)


def cpu_percent(samples: DataFrame, window_s: int = 120) -> DataFrame:
    """CPU use per container in percent of one core."""
    cpu = label_nonempty(samples.where(F.col("metric") == CPU))
    return (
        counter_rate(cpu, window_s)
        .groupBy(label("name").alias("name"), "ts")
        .agg((F.sum("rate") * 100).alias("value"))
    )


def series_ratio_join(
    samples: DataFrame, numerator: str, denominator: str, by: Sequence[str] | None = None
) -> DataFrame:
    """One metric divided by another of the same labels and instant.

    All labels must match, unless ``by`` names those that count; the result
    shows ``by``, or the label ``name``. Of several samples the largest counts.

    Both sides come from one scan and meet in one aggregation with map-side
    combine, instead of two scans and a join. Instants at which either side is
    missing, or the denominator is not positive, give no row.
    """
    metric, value = F.col("metric"), F.col("value")
    shown, match = by or ("name",), [] if by else [series_id().alias("_series")]
    both = (
        samples.where(metric.isin(numerator, denominator))
        .groupBy(*[label(name).alias(name) for name in shown], *match, "ts")
        .agg(
            F.max(F.when(metric == numerator, value)).alias("_num"),
            F.max(F.when(metric == denominator, value)).alias("_den"),
        )
    )
    return positive_limit(both.where(F.col("_num").isNotNull()), "_den").select(
        *shown, "ts", ratio(F.col("_num"), F.col("_den")).alias("value")
    )


def memory_ratio(samples: DataFrame) -> DataFrame:
    """Working set as a share of the memory limit, where a limit is set."""
    return series_ratio_join(label_nonempty(samples), MEMORY, MEMORY_LIMIT)


def rank_current(series: DataFrame, n: int | None = None) -> DataFrame:
    """Last value of every named series, largest first."""
    last = series.groupBy("name").agg(F.max_by("value", "ts").alias("value"))
    ordered = last.orderBy(F.desc_nulls_last("value"), F.asc("name"))
    return ordered if n is None else ordered.limit(n)


def cpu_status(samples: DataFrame, window_s: int = 120) -> DataFrame:
    """Last CPU use of every container in percent, with the colour of its panel."""
    known = cpu_percent(samples, window_s).where(F.col("value").isNotNull())
    return rank_current(known).withColumn("status", threshold_status(F.col("value"), CPU_STEPS))


def growth(
    samples: DataFrame,
    metrics: Sequence[str],
    step_s: int,
    start: Instant,
    end: Instant,
    stale_after_s: int | None = None,
) -> DataFrame:
    """Last value of each metric per step, carried forward over empty steps.

    A value is carried for less than ``stale_after_s`` seconds after its own step, so
    that a metric that stops leaves a gap; None carries it to the end.

    The samples are reduced to one row per metric and step first. Each row then
    covers the steps up to the next one, so the gaps are filled without a
    calendar table and without a join; what is left per metric is as long as
    the panel is wide.
    """
    kind = samples.schema["ts"].dataType
    width = step_s * SECOND

    def step_of(ts: Column) -> Column:
        return micros(ts) - F.pmod(micros(ts), F.lit(width))

    first, last = instant_like(samples, "ts", start), instant_like(samples, "ts", end)
    per_step = (
        samples.where(F.col("metric").isin(*metrics) & F.col("ts").between(first, last))
        .groupBy("metric", step_of(F.col("ts")).alias("_step"))
        .agg(F.max_by("value", "ts").alias("value"))
    )
    following = F.lead("_step").over(Window.partitionBy("metric").orderBy("_step"))
    until = F.coalesce(following - width, step_of(last))
    if stale_after_s is not None:
        # The last step that begins before the value is stale.
        until = F.least(until, F.col("_step") + (max(stale_after_s * SECOND, 1) - 1) // width * width)
    return (
        per_step.withColumn("_until", until)
        .select("metric", F.explode(F.sequence("_step", "_until", F.lit(width))).alias("_us"),
                "value")
        .select("metric", F.timestamp_micros("_us").cast(kind).alias("ts"), "value")
    )


def current(samples: DataFrame, steps: Mapping[str, Steps] = LAKE_STEPS) -> DataFrame:
    """Latest value of every global gauge with the status of its panel."""
    latest = last_not_null(samples.where(F.col("metric").isin(*steps)), "metric")
    status = choose(
        F.col("metric"),
        {name: threshold_status(F.col("value"), bounds) for name, bounds in steps.items()},
    )
    return latest.select("metric", "value", status.alias("status"))


def current_by_table(samples: DataFrame) -> DataFrame:
    """Latest value of the per-table gauges, labelled ``schema.table``."""
    return (
        samples.where(F.col("value").isNotNull())
        .groupBy(
            "metric", table_label(label("schema"), label("table")).alias("table_label")
        )
        .agg(F.max_by("value", "ts").alias("value"))
    )
