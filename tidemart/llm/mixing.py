"""Mix sources to target weights by nested hash thresholds.

Each source has a target number of words. Whole passes over a source are taken
as long as they fit; of the rest, documents are taken in the order of a hash of
their id until the budget is used. The order is never made: a histogram of words
by source and leading hash bits finds the bucket in which the budget ends, only
that bucket is read again with finer bits, and in the end a document is kept if
its hash is below its source's threshold.

Scale: a level shuffles at most ``sources x 2^bits`` sums per task, summed
before the shuffle, so a source with a third of all rows is no larger than
another. One row per source goes through a window without keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import WORD, n_words, stage, table

# Fixed values of the contract: weights by source in code point order, share of all words, most repeats.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
# Bits of the hash that each level of the histogram refines; 40 in all, 10 hexadecimal digits.
LEVELS = (12, 14, 14)
BITS = sum(LEVELS)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            cap: int = CAP) -> DataFrame:
    """Target of every source, from rows (source, size) of its documents.

    A source's target is weight times a common rate, but at most ``cap`` times
    its size; the rate is such that all targets add up to ``share`` of all
    words. That is where resharing the excess by weight ends. Sorted by the
    rate at which a source reaches its cap, the capped ones come first, so
    running sums give the rate. A null source is a source, the last one.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = each.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    full = F.col("source_size") * F.lit(cap)
    by_rate = Window.orderBy((full / F.col("weight")), F.col("source").isNull(), F.col("source"))
    before = by_rate.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sums = ranked.select(
        "source", "source_size", "weight", full.alias("full"),
        F.coalesce(F.sum(full).over(before), F.lit(0)).alias("used"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("passed"),
        F.sum("source_size").over(everything).alias("words"),
        F.sum("weight").over(everything).alias("all_weights"))
    rate = (F.col("words") * F.lit(float(share)) - F.col("used")) / (F.col("all_weights") - F.col("passed"))
    rated = sums.withColumn("rate", rate)
    # The first source that its rate does not fill sets the rate of all behind it.
    fits = F.when(F.col("rate") * F.col("weight") <= F.col("full"), F.col("rate"))
    common = F.first(fits, ignorenulls=True).over(by_rate.rowsBetween(Window.unboundedPreceding, 0))
    return rated.withColumn("common", common).select(
        "source", "source_size",
        F.coalesce(F.col("common") * F.col("weight"), F.col("full").cast("double")).alias("target"))


def with_thresholds(docs: DataFrame, goals: DataFrame) -> DataFrame:
    """Adds per source ``passes`` (whole takes) and ``below`` (hash below which one more is taken).

    ``docs`` has source, size and hash. Words whose hash lies under a bucket's
    lower end are within the budget; the bucket in which the sum passes it is
    refined. At the finest level the bucket holds one hash value: it is taken
    if that brings the source nearer to its target.
    """
    same = F.col("d.source").eqNullSafe(F.col("g.source"))
    passes = F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    state = goals.select(
        "source", "source_size", "target", passes.alias("passes"),
        (F.col("target") - passes * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("low"))
    left = BITS
    for bits in LEVELS:
        left -= bits
        width = 1 << left
        known = stage(state, "budgets")
        inside = docs.alias("d").join(known.alias("g"), same & (F.col("low") >= 0) & (
            F.shiftright("hash", left + bits) == F.shiftright("low", left + bits))).select(
            F.col("d.source").alias("source"), F.shiftright("hash", left).alias("bucket"), "size")
        sums = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        running = Window.partitionBy("source").orderBy("bucket")
        ended = sums.alias("s").join(known.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
            F.col("s.source").alias("source"), "bucket", "words", "budget").withColumn(
            "up_to", F.sum("words").over(running)).filter(F.col("up_to") > F.col("budget"))
        first = ended.groupBy("source").agg(F.min_by(F.struct("bucket", "words", "up_to"), "bucket").alias("b"))
        state = known.alias("g").join(first.alias("f"), F.col("g.source").eqNullSafe(F.col("f.source")), "left").select(
            F.col("g.source").alias("source"), "source_size", "target", "passes",
            # No bucket passes the budget: every document lies under the threshold.
            F.when(F.col("b").isNull(), F.col("budget")).otherwise(
                F.col("budget") - (F.col("b.up_to") - F.col("b.words"))).alias("budget"),
            F.when(F.col("b").isNull(), F.lit(-1)).otherwise(F.col("b.bucket") * width).alias("low"),
            F.col("b.words").alias("at_end"))
    nearer = (F.col("at_end") - F.col("budget")) < F.col("budget")
    below = F.when(F.col("low") < 0, F.lit(1 << BITS)).otherwise(F.col("low") + nearer.cast("long"))
    return state.select("source", "source_size", "target", "passes", below.alias("below"))


def hash_of(*columns: str):
    """40 bits of an MD5 of the columns as text; null is a value of its own."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def takes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and ``times`` (how often the mix takes the document).

    Null text: size 0. Rows with the same id share their fate; a null id is an
    id. A source without words has target 0 and takes nothing. An empty table
    gives no rows.
    """
    sized = stage(docs.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        n_words(F.col(text_column)).alias("size"), hash_of(id_column).alias("hash")), "sizes")
    found = stage(with_thresholds(sized, targets(sized)), "thresholds")
    return sized.alias("d").join(
        found.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        "doc_id", "size", "source_size", "target",
        F.least(F.col("passes") + (F.col("hash") < F.col("below")).cast("long"), F.lit(CAP)).alias("times"))


def mix(docs: DataFrame, **names: str) -> DataFrame:
    """The contract's columns: doc_id, size, source_size, target, taken (words, repeats counted)."""
    return takes(docs, **names).select(
        "doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def resample(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, all columns kept."""
    sized = docs.withColumns({"#size": n_words(F.col("text")), "#hash": hash_of("doc_id")})
    few = stage(sized.select("source", F.col("#size").alias("size"), F.col("#hash").alias("hash")), "sizes")
    found = stage(with_thresholds(few, targets(few)), "thresholds").select(
        F.col("source").alias("#source"), "passes", "below")
    found = found.withColumnsRenamed({"passes": "#passes", "below": "#below"})
    times = F.least(F.col("#passes") + (F.col("#hash") < F.col("#below")).cast("long"), F.lit(CAP))
    return sized.join(found, F.col("source").eqNullSafe(F.col("#source"))).withColumn(
        "#copy", F.explode(F.sequence(F.lit(1), F.lit(CAP)))).filter(
        F.col("#copy") <= times).select(*[f"`{c}`" for c in docs.columns])


def op10_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"))


_HASH = "('0x' || substr(md5(coalesce(cast(doc_id as varchar), '-')), 1, 10))::bigint"
TARGETS_SQL = f"""
sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as size, {_HASH} as hash
  from docs
), each as (
  select source, cast(sum(size) as bigint) as source_size,
    [{", ".join(map(str, WEIGHTS))}][(row_number() over (order by source is null, source) - 1) % {len(WEIGHTS)} + 1] as weight
  from sized group by source
), sums as (
  select *, {CAP} * source_size as room,
    coalesce(sum({CAP} * source_size) over before, 0) as used, coalesce(sum(weight) over before, 0) as passed,
    sum(source_size) over () as words, sum(weight) over () as all_weights
  from each
  window before as (order by {CAP} * source_size::double / weight, source is null, source
                    rows between unbounded preceding and 1 preceding)
), rated as (
  select *, (words::double * {SHARE} - used::double) / (all_weights - passed)::double as rate from sums
), goals as (
  select source, source_size, coalesce(weight * min(case when rate * weight <= room then rate end) over (
      order by {CAP} * source_size::double / weight, source is null, source
      rows between unbounded preceding and current row), room::double) as target
  from (select source, source_size, weight, room,
      first_value(case when rate * weight <= room then rate end ignore nulls) over (
        order by {CAP} * source_size::double / weight, source is null, source
        rows between unbounded preceding and current row) as rate from rated)
), placed as (
  select doc_id, size, source_size, target, hash,
    cast(floor(target / greatest(source_size, 1)) as bigint) as passes,
    sum(size) over (partition by d.source order by hash range between unbounded preceding and current row) as up_to,
    sum(size) over (partition by d.source, hash) as tied
  from sized d join goals g on d.source is not distinct from g.source
), cut as (
  select *, target - passes * source_size as budget from placed
), times as (
  select doc_id, size, source_size, target, hash, least(passes + case when up_to <= budget
    or (up_to - tied <= budget and up_to - budget < budget - (up_to - tied)) then 1 else 0 end, {CAP}) as times
  from cut
)"""
SQL = f"""with docs as (select * from documents), {TARGETS_SQL}
select doc_id, cast(size as bigint) as size, source_size, target, cast(times * size as bigint) as taken from times"""
