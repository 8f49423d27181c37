"""Codes of vectors: each part of a vector is written as the number of its nearest codebook entry.

The nearest entry is found through a tree over the entries of a codebook: a
node has some split points, every other entry belongs to its nearest split point,
and for each pair of split point and child the node keeps the range of their
distances. A query's distance to the split points and the best distance so far
rule out whole children. Ranges are widened by more than any rounding can
take away and a child goes only if it is strictly farther, so that the
best entry and all entries as near are looked at; these are compared in whole numbers.

Scale: vectors become whole numbers once, in a staged table. Every round sends
one row for each component of each codebook from a task, whatever its rows;
codebooks (parts x entries) are all that the driver and the tasks hold.

Handling: vectors are padded with zeros to the longest one's length, rounded up
to a multiple of the number of parts. Null ids come last where ids are ordered,
rows that repeat an id are ordered by their components and count each. With fewer
vectors than entries the codebooks are shorter. A component beyond 2^27 in
whole numbers stops the job, since squared distances would leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table

PARTS, ENTRIES, ROUNDS, STEPS = 16, 64, 2, 256
SPLITS, LEAF = 8, 8
MOST = 1 << 27
SLACK = 1e-12


def squared(points: np.ndarray, point: np.ndarray) -> np.ndarray:
    return ((points - point) ** 2).sum(axis=1)


@dataclass(frozen=True)
class Node:
    """Split points with children, or a leaf whose entries are all looked at."""

    entries: list[int]
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def grow(points: np.ndarray, entries: list[int]) -> Node:
    """A tree over some entries: split points far from each other, ranges of distances split by child."""
    if len(entries) <= LEAF:
        return Node(entries)
    mine = points[entries]
    chosen = [0]
    gaps = squared(mine, mine[0])
    while len(chosen) < SPLITS:
        chosen.append(int(gaps.argmax()))
        gaps = np.minimum(gaps, squared(mine, mine[chosen[-1]]))
    distance = np.sqrt(np.array([squared(mine, mine[k]) for k in chosen]).astype(float))
    others = np.setdiff1d(np.arange(len(entries)), chosen)
    owner = distance[:, others].argmin(axis=0)
    low, high = np.zeros((len(chosen), len(chosen))), np.zeros((len(chosen), len(chosen)))
    children: list[Node | None] = []
    for j in range(len(chosen)):
        members = others[owner == j]
        if len(members):
            low[:, j], high[:, j] = distance[:, members].min(axis=1), distance[:, members].max(axis=1)
        children.append(grow(points, [entries[k] for k in members]) if len(members) else None)
    return Node([entries[k] for k in chosen], children, low, high)


class Codebook:
    """Entries of one part, and the nearest of them to whole-number queries."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.root = grow(points, list(range(len(points))))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each query; of equally near entries the lowest number."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        entry = np.full(len(queries), len(self.points))

        def look(rows: np.ndarray, number: int) -> np.ndarray:
            found = squared(queries[rows], self.points[number])
            better = (found < best[rows]) | ((found == best[rows]) & (number < entry[rows]))
            best[rows[better]], entry[rows[better]] = found[better], number
            return found

        def visit(node: Node, rows: np.ndarray) -> None:
            away = [look(rows, number) for number in node.entries]
            if not node.children:
                return
            away = np.sqrt(np.array(away).astype(float))
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                radius = np.sqrt(best[rows].astype(float))
                room = SLACK * (away + radius + node.high[:, j, None])
                near = ((away - radius - room <= node.high[:, j, None])
                        & (away + radius + room >= node.low[:, j, None])).all(axis=0)
                visit(child, rows[near])

        if len(queries) and len(self.points):
            visit(self.root, np.arange(len(queries)))
        return entry, best


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, steps: int) -> DataFrame:
    """Staged (vec_id, label, ints) of the vectors without null or non-finite components."""
    scaled = lambda x: F.floor(x.cast("double") * steps)
    far = F.raise_error(F.lit(f"a component is beyond {MOST} steps")).cast("int")
    kept = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(label_column).alias("label"),
                          F.col(vector_column).alias("vec")).filter(F.coalesce(F.forall(
                              "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    ints = F.transform("vec", lambda x: F.when(F.abs(scaled(x)) <= MOST, scaled(x).cast("int")).otherwise(far))
    return stage(kept.select("vec_id", "label", ints.alias("ints")), "vectors")


def cut(column: pa.Array, width: int, parts: int) -> np.ndarray:
    """Rows of parts of ``width`` components, padded with zeros."""
    out = np.zeros((len(column), width * parts), np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), sizes)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, at] = column.flatten().to_numpy()
    return out.reshape(len(column), parts, width)


SUMS = "part int, entry int, at int, total long"


def refined(found: DataFrame, books: list[Codebook], width: int) -> list[Codebook]:
    """Every entry moved to the floor of the mean of the parts nearest to it; unused ones stay."""
    parts = len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = len(books[0].points)
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            vectors = cut(batch.column(0), width, parts)
            for p, book in enumerate(books):
                entry, _ = book.nearest(vectors[:, p])
                sums[p, :, width] += np.bincount(entry, minlength=entries)
                for at in range(width):
                    # Whole numbers below 2^53 within a batch, so their sum as doubles is exact.
                    sums[p, :, at] += np.bincount(entry, vectors[:, p, at], entries).astype(np.int64)
        part, entry, at = np.indices(sums.shape)
        used = np.broadcast_to(sums[:, :, width:] > 0, sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(x[used].astype(np.int32)) for x in (part, entry, at)]
                                         + [pa.array(sums[used])], ["part", "entry", "at", "total"])

    totals = found.select("ints").mapInArrow(run, SUMS).groupBy("part", "entry", "at").agg(F.sum("total").alias("total"))
    sums = np.zeros((parts, len(books[0].points), width + 1), np.int64)
    rows = totals.toArrow()
    sums[tuple(rows.column(c).to_numpy() for c in ("part", "entry", "at"))] = rows.column("total").to_numpy()
    return [Codebook(np.where(mine[:, width:] > 0, mine[:, :width] // np.maximum(mine[:, width:], 1), book.points))
            for mine, book in zip(sums, books)]


def fit(found: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """Codebooks of all vectors, starting from those of the smallest ids. None for no vectors."""
    width = -(-(found.agg(F.max(F.size("ints")).alias("size")).first()["size"] or 0) // parts)
    first = found.select("vec_id", "ints").orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).toArrow()
    if not first.num_rows:
        return []
    start = cut(first.column("ints").combine_chunks(), width, parts)
    books = [Codebook(start[:, p]) for p in range(parts)]
    for _ in range(rounds):
        books = refined(found, books, width)
    return books


def encode(found: DataFrame, books: list[Codebook]) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distances summed over the parts)."""
    parts, width = len(books), books[0].points.shape[1] if books else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = cut(batch.column(2), width, parts)
            codes, error = np.empty((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for p, book in enumerate(books):
                entry, far = book.nearest(vectors[:, p])
                codes[:, p] = entry
                error += far
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([c.tobytes().hex() for c in codes], pa.string()),
                                              pa.array(error)], ["vec_id", "label", "code", "error"])

    kind = found.schema["label"].dataType.simpleString()
    return found.select("vec_id", "label", "ints").mapInArrow(
        run, f"vec_id long, label {kind}, code string, error long")


def digest(books: list[Codebook]) -> str:
    numbers = [str(x) for book in books for x in book.points.reshape(-1).tolist()]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                 label_column: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
                 steps: int = STEPS) -> DataFrame:
    """vec_id, code, error, label_error (error summed over rows of one label, nulls together) and codebooks_sha256."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    found = whole_numbers(vectors, id_column, vector_column, label_column, steps)
    books = fit(found, parts, entries, rounds)
    coded = stage(encode(found, books), "codes")
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes(table(spark, folder, "embeddings"))


def _sql() -> str:
    distance = "list_sum(list_transform(range(1, w + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"
    text = """with recursive kept as materialized (
        select vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as ints
        from embeddings where embedding is not null and len(list_filter(
            embedding, lambda x: x is null or not isfinite(cast(x as double)))) = 0),
    sizes as materialized (select cast(ceil(max(len(ints)) / 16.0) as bigint) as w from kept),
    numbered as materialized (select *, row_number() over (order by vec_id nulls last, ints) as row from kept),
    parts as materialized (
        select row, p, w, list_transform(range(1, w + 1), lambda i: coalesce(ints[p * w + i], 0)) as v
        from numbered, sizes, range(16) t(p)),
    book0 as materialized (select p, row - 1 as entry, v as c from parts where row <= 64),"""
    for k in range(3):
        text += f"""
    near{k} as materialized (
        select row, p, any_value(w) as w, any_value(v) as v, min(struct_pack(far := cast({distance} as bigint), entry := entry)) as best
        from parts join book{k} using (p) group by row, p),"""
        if k < 2:
            text += f"""
    mean{k} as materialized (
        select p, entry, list((s - ((s % n) + n) % n) // n order by i) as c from (
            select p, best.entry as entry, i, cast(sum(v[i]) as bigint) as s, count(*) as n
            from near{k}, lateral (select unnest(range(1, w + 1)) as i) group by all) group by all),
    book{k + 1} as materialized (
        select p, entry, coalesce(m.c, b.c) as c from book{k} b left join mean{k} m using (p, entry)),"""
    return text + """
    coded as materialized (
        select row, string_agg(lpad(format('{:x}', best.entry), 2, '0'), '' order by p) as code,
               cast(sum(best.far) as bigint) as error from near2 group by row)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
           (select sha256(string_agg(array_to_string(c, ','), ',' order by p, entry)) from book2) as codebooks_sha256
    from coded join numbered using (row)"""


SQL = _sql()
