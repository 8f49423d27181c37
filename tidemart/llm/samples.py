"""Bounded labelled samples, and the words that tell two classes apart."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import LOWER, UPPER, binary, stage

SAMPLE_ROWS = 20_000
RESOLUTION = 1 << 30
FLUSH_WORDS = 200_000

# A-Z to lower case, ASCII signs to spaces: then bytes.split gives bare words.
_SIGNS = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())
BARE = bytes.maketrans((UPPER + _SIGNS).encode(), (LOWER + " " * len(_SIGNS)).encode())


def bare_words(value: bytes | None) -> list[bytes]:
    return value.translate(BARE).split() if value else []


def words_and_stems(value: bytes | None) -> set[bytes]:
    """Distinct bare words, and the first four and five letters of longer ones, marked by a star."""
    words = set(bare_words(value))
    return words | {w[:4] + b"*" for w in words if len(w) > 4} | {w[:5] + b"*" for w in words if len(w) > 5}


def distinct_words(value: bytes | None) -> set[bytes]:
    return set(bare_words(value))


def by_hash(share: float, order: str = "#order"):
    """The rows whose hash lies in a share of all hashes."""
    return F.pmod(F.xxhash64(order, F.lit(17)), F.lit(RESOLUTION)) < int(min(1.0, share) * RESOLUTION)


def with_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``#order``, a hash of id and text: the same for copies of a row, in any order of the rows."""
    return docs.withColumn("#order", F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1)), F.coalesce("text", F.lit(""))))


def once_each(rows: DataFrame) -> DataFrame:
    """One row of those that repeat id and text, reduced in the tasks first."""
    others = [c for c in rows.columns if c not in ("doc_id", "#order")]
    return rows.groupBy("doc_id", "#order").agg(*[F.first(c).alias(c) for c in others])


def labelled(docs: DataFrame, labels: DataFrame, target: str, bound: int = SAMPLE_ROWS) -> DataFrame:
    """Labelled rows of ``docs`` with ``#label`` 0 or 1 and ``#order``: all, or about ``bound`` of them by a hash.

    The labels are first held against the ids of ``docs``, so labels of
    other tables take no part in the bound. It counts distinct rows: copies with the same id and
    text are one. Only ids and hashes are shuffled; the ids of the
    sample are broadcast, about ``bound`` of them. Rows with a null id or label are left out; an id with two
    labels counts as 1.
    """
    marks = labels.select(F.col("doc_id").alias("#id"), F.col(target).cast("int").alias("#label")).filter(
        F.col("#id").isNotNull() & F.col("#label").isNotNull()).groupBy("#id").agg(F.max("#label").alias("#label"))
    ordered = with_order(docs)
    own = ordered.select(F.col("doc_id").alias("#id"), "#order").filter(F.col("#id").isNotNull()).distinct()
    own = stage(own.join(marks, "#id"), "labelled")
    few = own.filter(by_hash(bound / max(1, own.count()))).withColumnRenamed("#order", "#wanted")
    found = ordered.join(F.broadcast(few), (F.col("doc_id") == F.col("#id")) & (F.col("#order") == F.col("#wanted")))
    return once_each(found.drop("#id", "#wanted"))


def word_counts(batches: Iterator[pa.RecordBatch], tokens=distinct_words) -> Iterator[pa.RecordBatch]:
    """(word, ones, zeros): documents of either class that hold the word, summed before the shuffle."""

    def out() -> pa.RecordBatch:
        words = list({**ones, **zeros})
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([ones[w] for w in words], pa.int64()),
             pa.array([zeros[w] for w in words], pa.int64())], ["word", "ones", "zeros"])

    ones, zeros = Counter(), Counter()
    for batch in batches:
        for value, label in zip(binary(batch.column(0)), batch.column(1).to_pylist()):
            (ones if label else zeros).update(tokens(value))
            if len(ones) + len(zeros) > FLUSH_WORDS:
                yield out()
                ones.clear()
                zeros.clear()
    yield out()


def telling_words(train: DataFrame, most: int, text_column: str = "text", tokens=distinct_words) -> dict[bytes, int]:
    """The ``most`` words whose shares in the two classes differ most, numbered.

    Ranked by the deviation of the difference of two shares; at least three
    documents hold each. The result is bounded by ``most``.
    """
    n = train.agg(F.sum("#label").alias("ones"), F.count("*").alias("all")).first()
    ones, zeros = n["ones"] or 0, n["all"] - (n["ones"] or 0)
    if not ones or not zeros:
        return {}
    sums = train.select(F.col(text_column).alias("text"), "#label").mapInArrow(
        lambda batches: word_counts(batches, tokens), "word binary, ones long, zeros long").groupBy("word").agg(
        F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    share = (F.col("ones") + F.col("zeros") + 1) / (ones + zeros + 2)
    apart = F.abs(F.col("ones") / ones - F.col("zeros") / zeros) / F.sqrt(share * (1 - share) * (1 / ones + 1 / zeros))
    best = sums.filter(F.col("ones") + F.col("zeros") >= 3).withColumn("apart", apart).orderBy(
        F.desc("apart"), "word").limit(most).collect()
    return {bytes(row["word"]): k for k, row in enumerate(best)}


def present(words: set[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    return np.array(sorted(vocabulary[w] for w in words & vocabulary.keys()), np.int32)
