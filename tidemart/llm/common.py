"""Words, staged tables and small numeric helpers that the operators share.

Columns: every operator takes the names of the columns it reads and copies them
to names of its own first, so other columns of the input, whatever they are
called, never clash with the ones made inside.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.encoding import gather
from tidemart.session import delete_folder, fresh_path, restage

# A word is a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
BATCH_BYTES = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on texts go from a task to Python in batches of about 4 MB, however long they are.

    A setting of the session. Spark's own limit is 64 MB or 10,000 rows, held several times over in
    the executor and in its Python workers, for every core.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write once into the shared folder and read back: cuts lineage, survives lost executors.

    Use it where rows are read more than once and cost more to make than to read.
    """
    spark = df.sparkSession
    return restage(df, fresh_path(spark, label), spark, **options)


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """A staged table and its number of rows, counted while it is written."""
    seen = Observation()
    kept = stage(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return kept, seen.get["n"]


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        delete_folder(df.sparkSession, folder)


def word_lists(texts):
    """Words of one text after the other, A-Z in lower case; a null text has none.

    ``bytes.split`` splits at exactly the white space named in ``WORD``, and
    ``bytes.lower`` changes A-Z only. One text is held as words at a time.
    """
    for value in binary(texts):
        yield value.lower().split() if value else []


def binary(texts):
    """UTF-8 bytes of an Arrow string array, one text after the other."""
    import pyarrow as pa

    for value in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()):
        yield value.as_py()


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def n_words(column: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60.0, 60.0)))


def minimize(value_and_slope, start: np.ndarray, steps: int = 100, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search."""
    x = start.astype(float)
    value, slope = value_and_slope(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way = -slope
        kept = []
        for s, y in reversed(moves):
            a = s @ way / (s @ y)
            way = way - a * y
            kept.append(a)
        if moves:
            s, y = moves[-1]
            way = way * (s @ y) / (y @ y)
        for (s, y), a in zip(moves, reversed(kept)):
            way = way + s * (a - y @ way / (s @ y))
        down = slope @ way
        if down > -1e-10:
            break
        rate = 1.0 if moves else min(1.0, 1.0 / np.abs(slope).sum())
        for _ in range(30):
            new_value, new_slope = value_and_slope(x + rate * way)
            if new_value <= value + 1e-4 * rate * down:
                break
            rate /= 2
        else:
            break
        s, y = rate * way, new_slope - slope
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        done = value - new_value < 1e-9 * max(1.0, abs(value))
        x, value, slope = x + s, new_value, new_slope
        if done:
            break
    return x


class SparseRows:
    """Rows of feature numbers, each feature with value 1: numbers end to end, and where each row ends (from 0)."""

    def __init__(self, column: np.ndarray, ends: np.ndarray, width: int) -> None:
        self.column, self.ends, self.width, self.n = column, ends, width, len(ends) - 1
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(ends))

    @classmethod
    def of(cls, lists, width: int) -> SparseRows:
        """Of an Arrow list column, without a Python object for any row."""
        lists = lists.combine_chunks()
        ends = lists.offsets.to_numpy().astype(np.int64)
        return cls(lists.flatten().to_numpy(), ends - ends[0], width)

    def take(self, which: np.ndarray) -> SparseRows:
        return SparseRows(*gather(self.column, self.ends, np.asarray(which, np.int64)), self.width)

    def __add__(self, other: SparseRows) -> SparseRows:
        return SparseRows(np.concatenate([self.column, other.column]),
                          np.concatenate([self.ends, self.ends[-1] + other.ends[1:]]), self.width)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, per_row[self.row], self.width)
