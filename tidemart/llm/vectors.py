"""Vectors that take part in a search, pivots, and blocks of queries against blocks of rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import stage

PIVOT_SAMPLE = 8192
BLOCK_ROWS, BLOCK_QUERIES, SLICE_QUERIES = 8192, 1 << 17, 1024


def finite(vector: Column) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(whole & (F.size(vector) > 0), F.lit(False))


def usable(vectors: DataFrame, id_column: str, vector_column: str, label: str) -> DataFrame:
    """Staged (row, vec_id, vec as doubles) of the rows with a whole finite vector.

    Vectors of different lengths can't be compared: those of the most frequent
    length take part. A null id is an id like others, but never a query.
    """
    found = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                           F.col(vector_column).cast("array<double>").alias("vec")).filter(finite(F.col("vec")))
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), label)
    size = found.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return found.filter(F.size("vec") == size["size"]) if size else found


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def pivot_sample(vectors: DataFrame, rows: int = PIVOT_SAMPLE) -> np.ndarray:
    """At most ``rows`` vectors, chosen by a hash of the row."""
    few = vectors.select("vec", F.xxhash64("row").alias("order"), "row").orderBy("order", "row").limit(rows)
    return matrix(few.select("vec").toArrow().column("vec"))


def spread_pivots(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """``n`` centres of the sample at most, by some rounds of k-means."""
    random = np.random.default_rng(3)
    points = np.unique(sample, axis=0)
    pivots = points[random.permutation(len(points))[:n]].astype(float)
    for _ in range(rounds):
        nearest = np.argmin(squared(sample, pivots), axis=1)
        for k in range(len(pivots)):
            if (mine := nearest == k).any():
                pivots[k] = sample[mine].mean(axis=0)
    return pivots


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T, 0.0)


def in_blocks(rows: DataFrame, queries: DataFrame, sizes: dict[int, int], work, schema: str) -> DataFrame:
    """``work(rows, queries)`` on every block of a list's rows and the queries that visit the list, a slice at a time.

    Both sides have ``list``. A list's rows are dealt to blocks of about
    ``BLOCK_ROWS``; a query goes to each of them, and only to those of the lists it visits. A task
    holds one block of rows and lets its queries pass by, so it needs no more memory for more
    queries. A block visited by more than ``BLOCK_QUERIES`` queries is dealt to several tasks;
    that alone copies rows. ``sizes`` has the rows of every list; lists are of a bounded number.
    """
    spark = rows.sparkSession
    visits = dict(map(tuple, queries.groupBy("list").count().collect()))
    dealt = [(k, max(1, -(-n // BLOCK_ROWS)), max(1, -(-visits[k] // BLOCK_QUERIES))) for k, n in sizes.items() if k in visits]
    plan = F.broadcast(spark.createDataFrame(dealt, "list int, blocks int, groups int"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    left = rows.join(plan, "list").withColumns({"a": part("blocks"), "b": spread("groups"), "kind": F.lit(0)})
    right = queries.join(plan, "list").withColumns({"b": part("groups"), "a": spread("blocks"), "kind": F.lit(1)})
    both = left.unionByName(right, allowMissingColumns=True).drop("blocks", "groups")
    keys = ["list", "a", "b", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, whole = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.column_stack([batch.column(k).to_numpy() for k in keys])
            cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for low, high in zip(cuts[:-1], cuts[1:]):
                key, part_of = tuple(marks[low, :3].tolist()), batch.slice(low, high - low)
                if marks[low, 3] == 0:
                    if key != held:
                        held, block, whole = key, [], None
                    block.append(part_of)
                elif key == held:
                    whole = pa.Table.from_batches(block) if whole is None else whole
                    for at in range(0, high - low, SLICE_QUERIES):
                        found = work(whole, pa.Table.from_batches([part_of.slice(at, SLICE_QUERIES)]))
                        yield from found.to_batches()

    return both.repartition(*keys[:3]).sortWithinPartitions(*keys).mapInArrow(run, schema)
