"""Exact search for the largest inner products by a pivot-distance index.

With one more coordinate, sqrt(M^2 - |x|^2) for rows (M: the largest norm) and 0
for queries, the largest inner product is the smallest distance. Rows are keyed
by their nearest pivot and the distance to it; each pivot's rows are cut into
annuli by distance. A query first searches the annuli nearest to it, until they
hold enough rows. Its k-th score then bounds what can still matter: by the
triangle inequality an annulus [from, to] around a pivot at distance d holds
nothing nearer than max(from - d, d - to), and is left out if that is too far.

The number of pivots grows with the square root of the rows up to ``MOST_PIVOTS``, so
that annuli stay short; rows of an annulus are searched in bounded blocks, a query goes only
to the annuli it visits, and a row is sent on only if it beats the query's bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table
from tidemart.llm.vectors import in_blocks, matrix, pivot_sample, spread_pivots, squared, usable

PIVOTS, MOST_PIVOTS, ANNULI = 16, 256, 8
VISIT_ROWS = 1024
SCALE = 64
TOP = 20
QUERY_STEP = 20
FOUND = "query_row long, query_id long, vec_id long, score long"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where that is exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(most - (vectors * vectors).sum(axis=1), 0.0))
    return np.column_stack([vectors, rest])


def best(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """Of a block of rows the k best of each query in a block, if they beat its bound."""
    columns = [[], [], [], []]
    if rows.num_rows and queries.num_rows:
        numbers = rows.column("row").to_numpy()
        ids = rows.column("vec_id").fill_null(np.iinfo(np.int64).max).to_numpy()
        order = np.lexsort((numbers, ids))
        ids, numbers = ids[order], numbers[order]
        scores = products(matrix(queries.column("vec")), matrix(rows.column("vec"))[order])
        least, least_id = queries.column("least").to_numpy(), queries.column("least_id").to_numpy()
        names, own = queries.column("vec_id").to_numpy(), queries.column("row").to_numpy()
        for i in range(len(names)):
            line = scores[i]
            good = np.flatnonzero((line > least[i]) | ((line == least[i]) & (ids < least_id[i])))
            good = good[numbers[good] != own[i]]
            # Rows are in order of id, and a stable sort keeps that among equal scores.
            good = good[np.argsort(-line[good], kind="stable")[:k]]
            for column, values in zip(columns, (np.full(len(good), own[i]), np.full(len(good), names[i]), ids[good], line[good])):
                column.append(values)
    return pa.table({name: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64())
                     for name, c in zip(("query_row", "query_id", "vec_id", "score"), columns)})


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(vectors: DataFrame, queries_where, k: int = TOP, id_column: str = "vec_id",
           vector_column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query row, its own row left out.

    ``queries_where`` is a condition on ``vec_id``. Rows that repeat a vector or
    an id are rows of their own. Fewer rows than k: all of them. An empty table
    or one without usable vectors gives no rows.
    """
    whole = usable(vectors, id_column, vector_column, "vectors")
    rows = whole.withColumn("vec", F.transform("vec", lambda x: F.floor(x * F.lit(float(scale)))))
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    most, n = rows.agg(F.max(norm), F.count("*")).first()
    most = float(most or 0.0)
    n_pivots = min(MOST_PIVOTS, max(PIVOTS, int(n**0.5) // 8))
    sample = pivot_sample(rows).astype(float)
    pivots = spread_pivots(lifted(sample, most), n_pivots) if len(sample) else np.zeros((1, 1))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = squared(lifted(matrix(batch.column(2)).astype(float), most), pivots)
            nearest = far.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(np.sqrt(far[np.arange(len(far)), nearest]))],
                ["row", "vec_id", "vec", "pivot", "distance"])

    schema = "row long, vec_id long, vec array<long>"
    index = stage(rows.select("row", "vec_id", "vec").mapInArrow(keyed, schema + ", pivot int, distance double"), "index")
    edges = index.groupBy("pivot").agg(F.percentile_approx(
        "distance", [i / ANNULI for i in range(1, ANNULI)], 1000).alias("edges"))
    listed = index.join(F.broadcast(edges), "pivot").withColumn(
        "list", (F.col("pivot") * ANNULI + F.size(F.filter("edges", lambda e: F.col("distance") > e))).cast("int"))
    listed = stage(listed.drop("edges"), "annuli")
    annuli = listed.groupBy("list").agg(
        F.first("pivot").alias("pivot"), F.count("*").alias("n"), F.min("distance").alias("lo"),
        F.max("distance").alias("hi")).orderBy("list").toPandas()
    lists, sizes = annuli["list"].to_numpy(), annuli["n"].to_numpy()
    around, lo, hi = annuli["pivot"].to_numpy(), annuli["lo"].to_numpy(), annuli["hi"].to_numpy()
    slack = 1e-6 * (1.0 + np.sqrt(most))

    def visits(first_round: bool):
        """Task: queries to (query, list) for the annuli of a round."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(at, VISIT_ROWS) for b in batches for at in range(0, b.num_rows, VISIT_ROWS)):
                asked = matrix(batch.column(2)).astype(float)
                flat = np.column_stack([asked, np.zeros(len(asked))])
                away = np.sqrt(squared(flat, pivots))[:, around]
                bound = np.maximum(0.0, np.maximum(lo - away, away - hi) - slack)
                order = np.argsort(bound, axis=1, kind="stable")
                # The nearest annuli that hold more than k rows, the query itself among them, come first.
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                near = np.zeros(bound.shape, bool)
                np.put_along_axis(near, order, before <= k, axis=1)
                if first_round:
                    chosen = near
                else:
                    least = batch.column(3).to_numpy().astype(float)
                    reach = (flat * flat).sum(axis=1) + most - 2 * least
                    # No bound yet if the first annuli did not give k rows.
                    open_end = batch.column(3).to_numpy() == np.iinfo(np.int64).min
                    chosen = ~near & ((bound * bound <= reach[:, None] * (1 + 1e-9) + slack) | open_end[:, None])
                i, j = np.nonzero(chosen)
                taken = pa.RecordBatch.from_arrays(batch.columns, ["row", "vec_id", "vec", "least", "least_id"]).take(pa.array(i))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(lists[j].astype(np.int32))], ["row", "vec_id", "vec", "least", "least_id", "list"])

        return run

    with_bound = schema + ", least long, least_id long, list int"
    listed = listed.select("row", "vec_id", "vec", "list")
    queries = rows.select("row", "vec_id", "vec").filter(F.col("vec_id").isNotNull()).filter(queries_where)
    by_list = dict(zip(lists.tolist(), sizes.tolist()))
    work = lambda one, two: best(one, two, k)
    none = F.lit(np.iinfo(np.int64).min)
    opening = queries.withColumns({"least": none, "least_id": none}).mapInArrow(visits(True), with_bound)
    first = stage(ranked(in_blocks(listed, opening, by_list, work, FOUND), k), "nearest")
    bounds = first.filter(F.col("rank") == k).select(
        F.col("query_row").alias("row"), F.col("score").alias("least"), F.col("vec_id").alias("least_id"))
    bounded = queries.join(bounds, "row", "left").withColumns(
        {"least": F.coalesce("least", none), "least_id": F.coalesce("least_id", none)})
    rest = in_blocks(listed, bounded.mapInArrow(visits(False), with_bound), by_list, work, FOUND)
    biggest = F.lit(np.iinfo(np.int64).max)
    return ranked(first.drop("rank").unionByName(rest), k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.nullif("vec_id", biggest).alias("vec_id"), "score")


def op8_pivot_distance_topk(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


SQL = f"""with v as (
  select vec_id, row_number() over () as row, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as vec
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(embedding) > 0
), scored as (
  select q.vec_id as query_id, q.row, x.vec_id, list_inner_product(q.vec::double[], x.vec::double[])::bigint as score
  from v q join v x on q.row <> x.row where q.vec_id % {QUERY_STEP} = 0
)
select query_id, rank, vec_id, score from (
  select *, row_number() over (partition by row order by score desc, vec_id nulls last)::int as rank from scored)
where rank <= {TOP}"""
