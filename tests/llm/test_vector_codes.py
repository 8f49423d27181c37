"""Vector codes against looking at every entry, and against SQL."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemart.llm import vector_codes as vc


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """{(vec_id, label, vector): (code, error)} and the digest, by full loops."""
    kept = [(i, label, [math.floor(256 * float(x)) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for *_, v in kept), default=0) // parts)
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    cut = [[(v + [0] * (parts * width))[p * width:(p + 1) * width] for p in range(parts)] for *_, v in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(p, c[p])[1]].append(c[p])
            books[p] = [[sum(x) // len(groups[k]) for x in zip(*groups[k])] if k in groups else book
                        for k, book in enumerate(books[p])]
    out, by_label = [], defaultdict(int)
    for (i, label, _), c in zip(kept, cut):
        best = [nearest(p, c[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in best), sum(far for far, _ in best)))
        by_label[label] += out[-1][3]
    text = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted((str(i), code, error, by_label[label], text) for i, label, code, error in out)


def found_codes(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256)
                  for r in vc.vector_codes(df, **options).collect())


@given(st.lists(st.lists(st.integers(-40, 40), min_size=2, max_size=2), min_size=1, max_size=90),
       st.lists(st.lists(st.integers(-60, 60), min_size=2, max_size=2), min_size=1, max_size=30))
@settings(max_examples=200, deadline=None)
def test_nearest_entry_with_ties(points, queries):
    points, queries = np.array(points, np.int64), np.array(queries, np.int64)
    entry, far = vc.Codebook(points).nearest(queries)
    all_far = ((queries[:, None] - points[None]) ** 2).sum(axis=2)
    assert entry.tolist() == all_far.argmin(axis=1).tolist()
    assert far.tolist() == all_far.min(axis=1).tolist()


def test_children_are_left_out():
    """The tree does less than look at every entry."""
    random = np.random.default_rng(0)
    points = random.integers(-10_000, 10_000, (64, 2))
    book, seen = vc.Codebook(points), 0
    plain = vc.squared

    def counted(rows, point):
        nonlocal seen
        seen += len(rows)
        return plain(rows, point)

    vc.squared = counted
    try:
        book.nearest(random.integers(-10_000, 10_000, (1000, 2)))
    finally:
        vc.squared = plain
    assert seen < 0.6 * 64 * 1000


def test_large_numbers_stay_exact():
    points = np.array([[vc.MOST, 0], [vc.MOST, 1], [-vc.MOST, 0], [vc.MOST - 1, 0]] * 5 + [[0, 0]], np.int64)
    queries = np.array([[-vc.MOST, 1], [-vc.MOST, 0], [vc.MOST, 1], [1, 1]], np.int64)
    entry, far = vc.Codebook(points).nearest(queries)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(q, p)), k) for k, p in enumerate(points)) for q in queries]
    assert list(zip(far.tolist(), entry.tolist())) == want


def test_random_vectors(spark):
    random = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in v], int(i) % 3 if i % 5 else None)
            for i, v in zip(random.permutation(300), random.normal(size=(300, 32)))]
    assert found_codes(spark, rows) == plain_codes([(i, np.array(v, np.float32).tolist(), k) for i, v, k in rows])


def test_odd_vectors(spark):
    """Nulls anywhere, other lengths, repeated rows and ids, ties."""
    rows = [(1, [0.5, -0.25, 0.0], 1), (1, [0.5, -0.25, 0.0], 1), (2, None, 1), (3, [0.1, None, 0.2], 2), (4, [float("nan")], 2),
            (5, [float("inf"), 0.0], 2), (None, [0.5] * 7, None), (None, [0.25] * 7, None), (6, [], 2), (7, [-0.001] * 8, 2),
            (-3, [1.0, 1.0, 1.0], None)]
    small = {"parts": 4, "entries": 3, "rounds": 2}
    assert found_codes(spark, rows, **small) == plain_codes(
        [(i, None if v is None else np.array([math.nan if x is None else x for x in v], np.float32).tolist(), k)
         for i, v, k in rows], **small)
    assert found_codes(spark, [], **small) == []
    assert found_codes(spark, rows[2:6], **small) == []
    with pytest.raises(Exception, match="beyond"):
        found_codes(spark, [(1, [1e9], 1)])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [i / 7, -i / 3], i % 2, "x", "y") for i in range(9)],
                               "vec_id long, embedding array<double>, label int, code string, ints string")
    assert vc.vector_codes(df, parts=2, entries=4).count() == 9


def test_query_against_sql(spark, sf):
    duckdb.sql(f"create or replace view embeddings as select * from '{sf}/embeddings.parquet/*.parquet'"
               if __import__("os").path.isdir(f"{sf}/embeddings.parquet") else
               f"create or replace view embeddings as select * from '{sf}/embeddings.parquet'")
    found = vc.op11_vector_codes(spark, sf)
    want = duckdb.sql(f"select {', '.join(found.columns)} from ({vc.SQL})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(want) and want
