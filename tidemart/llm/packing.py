"""Sum-of-squares packing of tokenized documents into sequences of a fixed length.

A document becomes token ids; only a document longer than a sequence is cut.
Full pieces are sequences of their own. The others are packed by the
sum-of-squares rule: with N(g) open sequences that have g free places, a piece
goes where the sum of N(g)^2 over all g becomes smallest.

The token ids stay with their pieces: little-endian, four bytes each, staged once.
Only row numbers and lengths are packed; the places found are joined back to the ids.

Scale: the pieces are dealt to shards of a bounded number of pieces by a hash of
a row number, so that neither one key nor copies of one document make a shard
large; the state in a task is the shard's pieces and one counter per gap. The
sequences that a shard leaves badly filled are opened again, dealt to fewer
shards and packed once more, until one shard holds what is left or a round does not lower
the number of shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table
from tidemart.llm.encoding import word_encoder

LENGTH = 2048
SHARD_PIECES = 1 << 15
GOOD_GAP = 8


PIECES = "doc_id long, piece int, start long, length long, ids binary"
BATCH_BYTES = 1 << 22


def pieces(docs: DataFrame, vocabulary: str, length: int = LENGTH, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids. A null text is empty: one id 0."""
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)],
                                          [f.split()[0] for f in PIECES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, ends in encoder.batch(batch.column(1)):
                # Every document ends with id 0. Bytes, not a memoryview: Arrow never lets go of a view it has read.
                data = np.insert(ids, ends[1:], 0).astype("<u4").tobytes()
                rows, held = [], 0
                begins = (ends + np.arange(len(ends))).tolist()
                for doc, low, high in zip(names[first:], begins[:-1], begins[1:]):
                    for number, at in enumerate(range(low, high, length)):
                        stop = min(at + length, high)
                        rows.append((doc, number, at - low, stop - at, data[4 * at:4 * stop]))
                        held += stop - at
                        if 4 * held >= BATCH_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text_column).alias("text")).mapInArrow(run, PIECES)


def sum_of_squares(sizes: np.ndarray, length: int) -> np.ndarray:
    """The sequence of every piece, in the given order of pieces.

    Placing size s into gap g changes the sum by 2 (N(g - s) - N(g)) + 2, for a
    new sequence by 2 N(length - s) + 1; a sequence without a gap is closed and
    not counted. Ties go to the smallest gap.
    """
    counts = np.zeros(length + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(length + 1)]
    made = 0
    out = np.empty(len(sizes), np.int64)
    for i, s in enumerate(sizes.tolist()):
        # change[k]: into gap s + k, for gaps that exist
        change = counts[:length - s] - counts[s:length]
        change[0] = -counts[s]
        change = np.where(counts[s:length] > 0, 2 * change + 2, np.iinfo(np.int64).max)
        if len(change):
            change[0] -= (counts[s] > 0)
        best = int(np.argmin(change)) if len(change) else 0
        fresh = 2 * counts[length - s] + 1 if s < length else 0
        if len(change) and change[best] <= fresh:
            gap = s + best
            where = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, where = length, made
            made += 1
        if gap > s:
            counts[gap - s] += 1
            stacks[gap - s].append(where)
        out[i] = where
    return out


def fill_in_order(sizes: np.ndarray, length: int) -> np.ndarray:
    """Sum-of-squares packing, longest pieces first."""
    order = np.argsort(-sizes, kind="stable")
    out = np.empty(len(sizes), np.int64)
    out[order] = sum_of_squares(sizes[order], length)
    return out


PACKED = "row long, length long, shard long, bin long, offset long, gap long"


def pack(found: DataFrame, length: int = LENGTH, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Pieces with ``sequence_id``, ``offset`` and ``ids_crc32``; gapless from 0 in every sequence.

    Nulls in doc_id and repeated rows are pieces like others. An empty table
    gives an empty result. The tokens of a sequence are the ``ids`` of its pieces, by
    ``offset``.
    """
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "pieces", compression="zstd")
    whole = found.filter(F.col("length") == length).select(
        *[c for c in found.columns if c != "row"],
        (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    places = []
    left = found.filter(F.col("length") < length).select("row", "length")
    n = left.count()
    shards = max(1, -(-n // shard_pieces))

    def run(key: tuple[pa.Scalar, ...], data: pa.Table) -> pa.Table:
        data = data.sort_by("row")
        sizes = data.column("length").to_numpy()
        bins = fill_in_order(sizes, length)
        order = np.argsort(bins, kind="stable")
        ends = np.cumsum(sizes[order])
        first = np.r_[True, bins[order][1:] != bins[order][:-1]]
        begin = (ends - sizes[order])[first][np.cumsum(first) - 1]
        offset = np.empty_like(ends)
        offset[order] = ends - sizes[order] - begin
        gap = length - np.bincount(bins, sizes).astype(np.int64)[bins]
        for name, values in (("bin", bins), ("offset", offset), ("gap", gap)):
            data = data.append_column(name, pa.array(values, pa.int64()))
        return data.select([f.split()[0] for f in PACKED.split(", ")])

    round_number = 0
    while True:
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(round_number)), F.lit(shards)))
        packed = dealt.groupBy("shard").applyInArrow(run, PACKED)
        fewer = 1
        if shards > 1:
            packed = stage(packed, "packed")
            left = packed.filter(F.col("gap") > GOOD_GAP).select("row", "length")
            fewer = max(1, -(-left.count() // shard_pieces))
        last = fewer >= shards
        good = packed if last else packed.filter(F.col("gap") <= GOOD_GAP)
        places.append(good.select(
            "row", (F.col("bin") + F.col("shard") * (1 << 31) + F.lit(round_number << 58)).alias("sequence_id"),
            "offset"))
        if last:
            break
        shards = fewer
        round_number += 1
    found_places = reduce(DataFrame.unionByName, places)
    parts = found.filter(F.col("length") < length).join(found_places, "row").select(whole.columns)
    return whole.unionByName(parts).withColumn("ids_crc32", F.crc32("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """The packed sequences of ``docs``, a row for each piece, with its token ids."""
    return pack(pieces(docs, vocabulary, length), length)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the packed ids in place of the ids."""
    packed = pack_documents(table(spark, folder, "documents"), default_vocabulary())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
