"""Token ids on disk as wavelet matrices: one compressed file per shard.

A shard holds the ids of a run of documents as a wavelet matrix: one plane of
bits for each bit of an id, from the highest; each plane is in the order that the
planes above it leave, all zeros before all ones. With the ones counted before
every block of 512 bits, a token is read, counted or found in as many steps as
there are planes, without unpacking the rest.

File: the magic number, a head of fixed numbers, the sizes of the sections, then
the sections, each compressed: ids of the documents, which of them are null,
lengths, and for each plane its block counts and its bits.

Scale: documents are dealt by range of doc_id, so a task writes a run of them in order,
a file at a time; a file closes after ``SHARD_TOKENS`` ids, and a document is never
cut, so a task holds one file or one longer document. A task that is run again
writes under new names; only files named by the written list of shards are read.
Where a shard begins comes from sums over tasks, so nothing passes through one
task whole. Files are opened by Arrow's file systems, by path or URI.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table
from tidemart.llm.encoding import word_encoder
from tidemart.session import fresh_path

SHARD_TOKENS = 1 << 22
BATCH_BYTES = 1 << 22
END_ID = 1
BLOCK_BITS = 512
TASKS_A_BLOCK = 1024

MAGIC = b"TWM1"
HEAD = struct.Struct("<4sIQQ")  # magic number, planes, ids, documents
LEVEL = 3


class WaveletMatrix:
    """Ids below 2^planes with access, counting and lookup by position."""

    def __init__(self, n: int, planes: Sequence[np.ndarray], counts: Sequence[np.ndarray]) -> None:
        self.n, self.planes, self.counts = n, planes, counts
        self.zeros = [n - self.ones_before(k, np.array([n]))[0] for k in range(len(planes))]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = int(ids.max()).bit_length() if len(ids) else 0
        now = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        planes, counts = [], []
        for shift in range(levels - 1, -1, -1):
            bits = (now >> shift).astype(np.uint8) & 1
            # One block more than full ones, so that the place after the last bit has a block too.
            plane = np.zeros((len(now) // BLOCK_BITS + 1) * (BLOCK_BITS // 8), np.uint8)
            packed = np.packbits(bits, bitorder="little")
            plane[:len(packed)] = packed
            ones = np.bitwise_count(plane.view(np.uint64)).reshape(-1, BLOCK_BITS // 64).sum(axis=1, dtype=np.uint64)
            planes.append(plane)
            counts.append(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint64))
            one = bits.view(bool)
            now = np.concatenate([now[~one], now[one]])
        return cls(len(ids), planes, counts)

    def bit(self, level: int, at: np.ndarray) -> np.ndarray:
        return (self.planes[level][at >> 3] >> (at & 7).astype(np.uint8)) & 1

    def ones_before(self, level: int, at: np.ndarray) -> np.ndarray:
        """Rank: the ones of a plane before each place."""
        words = self.planes[level].view(np.uint64)
        block = at // BLOCK_BITS
        total = self.counts[level][block].astype(np.int64)
        for k in range(BLOCK_BITS // 64):
            # Whole words before the place, and the part of the word that holds it.
            width = np.clip(at - block * BLOCK_BITS - 64 * k, 0, 64)
            word = words[block * (BLOCK_BITS // 64) + k]
            some = np.where(width == 64, word, word & ((np.uint64(1) << (width & 63).astype(np.uint64)) - np.uint64(1)))
            total += np.bitwise_count(some)
        return total

    def place_of(self, level: int, value: int, number: np.ndarray) -> np.ndarray:
        """Select: the place of the ``number``-th (from 0) bit ``value`` of a plane."""
        before = self.counts[level].astype(np.int64)
        if not value:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = np.searchsorted(before, number, side="right") - 1
        out = np.empty(len(number), np.int64)
        for some in np.array_split(np.arange(len(number)), len(number) // 65_536 + 1):
            rows = self.planes[level].reshape(-1, BLOCK_BITS // 8)[block[some]]
            bits = np.unpackbits(rows, axis=1, bitorder="little") == value
            seen = bits.cumsum(axis=1, dtype=np.int16)
            left = number[some] - before[block[some]]
            out[some] = block[some] * BLOCK_BITS + (seen <= left[:, None]).sum(axis=1)
        return out

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some places."""
        at = np.asarray(at, np.int64)
        found = np.zeros(len(at), np.int64)
        for level in range(len(self.planes)):
            bits = self.bit(level, at)
            ones = self.ones_before(level, at)
            found = 2 * found + bits
            at = np.where(bits, self.zeros[level] + ones, at - ones)
        return found

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the copies of a token within [low, high) lie below the last plane."""
        if token < 0 or token >> len(self.planes):
            return 0, 0
        ends = np.array([low, high])
        for level in range(len(self.planes)):
            ones = self.ones_before(level, ends)
            one = (token >> (len(self.planes) - 1 - level)) & 1
            ends = self.zeros[level] + ones if one else ends - ones
        return int(ends[0]), int(ends[1])

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often a token occurs in [low, high)."""
        begin, end = self._range(token, low, self.n if high is None else high)
        return end - begin

    def find(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """All places of a token in [low, high), ascending."""
        at = np.arange(*self._range(token, low, self.n if high is None else high))
        for level in range(len(self.planes) - 1, -1, -1):
            one = (token >> (len(self.planes) - 1 - level)) & 1
            at = self.place_of(level, one, at - self.zeros[level] if one else at)
        return at

    def all(self) -> np.ndarray:
        """All ids, from the last plane up."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            zeros = self.zeros[level]
            above = np.empty_like(now)
            above[~one] = now[:zeros]
            above[one] = now[zeros:] | now.dtype.type(1 << (len(self.planes) - 1 - level))
            now = above
        return now.astype(np.uint32)


def to_file(doc_ids: Sequence[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard in the file format."""
    import zstandard

    matrix = WaveletMatrix.of(ids)
    none = np.array([d is None for d in doc_ids], np.uint8)
    sections = [np.array([d or 0 for d in doc_ids], "<i8"), none, np.asarray(lengths, "<i8")]
    for plane, counts in zip(matrix.planes, matrix.counts):
        sections += [counts.astype("<u8"), plane]
    squeeze = zstandard.ZstdCompressor(level=LEVEL)
    packed = [squeeze.compress(x.tobytes()) for x in sections]
    sizes = np.array([len(x) for x in packed], "<u8").tobytes()
    return b"".join([HEAD.pack(MAGIC, len(matrix.planes), len(ids), len(none)), sizes, *packed])


def from_file(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """doc_ids, lengths and ids of a shard."""
    import zstandard

    magic, planes, n, _ = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    sizes = np.frombuffer(data, "<u8", 3 + 2 * planes, HEAD.size)
    at, parts, loose = HEAD.size + sizes.nbytes, [], zstandard.ZstdDecompressor()
    for size in sizes.tolist():
        parts.append(loose.decompress(data[at:at + size]))
        at += size
    ids, none, lengths = np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<i8")
    matrix = WaveletMatrix(n, [np.frombuffer(x, np.uint8) for x in parts[4::2]],
                           [np.frombuffer(x, "<u8") for x in parts[3::2]])
    return [None if no else d for d, no in zip(ids.tolist(), none.tolist())], lengths, matrix


def opened(path: str):
    """(file system, path) of a path or URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


SHARDS = "part long, file string, before long, n_docs long, n_tokens long"


def write_shards(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, id_column: str = "doc_id",
                 text_column: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of ``docs`` into ``folder`` in ascending doc_id order; the written list of shards.

    Null ids come first; rows that repeat an id follow each other, ordered by a
    hash of their text. A null text is empty, and every document ends with
    ``end_id``. The list has file, start (ids in all files before it), n_docs and
    n_tokens. An empty table writes no file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = word_encoder(vocabulary)
        system, root = opened(folder)
        system.create_dir(root, recursive=True)
        docs, pieces, held, before = [], [], 0, 0

        def close() -> pa.RecordBatch:
            nonlocal held, before
            ids, name = np.concatenate(pieces), f"{part:07d}-{before:012d}-{uuid.uuid4().hex}.wm"
            data = to_file(docs, np.array([len(x) for x in pieces]), ids)
            with system.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(data)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([f"{folder}/{name}"]), pa.array([before]), pa.array([len(docs)]), pa.array([held])],
                ["part", "file", "before", "n_docs", "n_tokens"])
            before += held
            held = 0
            docs.clear(), pieces.clear()
            return row

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, ids, ends in encoder.batch(batch.column(1)):
                for k, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    docs.append(names[first + k])
                    pieces.append(np.append(ids[a:b], np.uint32(end_id)))
                    held += b - a + 1
                    if held >= shard_tokens:
                        yield close()
        if docs:
            yield close()

    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"),
                       F.monotonically_increasing_id().alias("row"))
    # The row number spreads rows that are equal in all else.
    order = [F.col("doc_id").asc_nulls_first(), "tie", "row"]
    written = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(run, SHARDS)
    return with_starts(stage(written, "shards"))


def with_starts(shards: DataFrame) -> DataFrame:
    """``start`` of every shard: sums over blocks of tasks, then over the tasks of a block."""
    block = F.floor(F.col("part") / TASKS_A_BLOCK).alias("block")
    tasks = shards.groupBy(block, "part").agg(F.sum("n_tokens").alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    blocks = tasks.groupBy("block").agg(F.sum("n").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(*earlier)), F.lit(0)).alias("block_start"))
    within = F.sum("n").over(Window.partitionBy("block").orderBy("part").rowsBetween(*earlier))
    starts = tasks.select("block", "part", F.coalesce(within, F.lit(0)).alias("in_block")).join(blocks, "block").select(
        "part", (F.col("block_start") + F.col("in_block")).alias("part_start"))
    return shards.join(starts, "part").select(
        "file", (F.col("part_start") + F.col("before")).alias("start"), "n_docs", "n_tokens")


def spread(shards: DataFrame) -> DataFrame:
    """Files dealt evenly, at most eight to a task. The list is staged, since dealing rows out needs a fixed order."""
    shards = stage(shards.select("file", "start"), "files")
    n = shards.count()
    return shards.repartition(max(1, min(n, shards.sparkSession.sparkContext.defaultParallelism), -(-n // 8)))


def read_file(path: str) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    system, place = opened(path)
    with system.open_input_stream(place, compression=None) as file:
        return from_file(file.read())


DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian, four bytes each) of every document of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs, lengths, matrix = read_file(path)
                data = matrix.all().astype("<u4").tobytes()
                ends = np.cumsum(lengths)
                first = 0
                while first < len(docs):
                    done = ends[first - 1] if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, done + BATCH_BYTES // 4, side="right")))
                    begins = ends[first:last] - lengths[first:last]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[first:last], pa.int64()), pa.array(start + begins), pa.array(lengths[first:last]),
                         pa.array([data[4 * a:4 * (a + n)] for a, n in zip(begins.tolist(), lengths[first:last].tolist())],
                                  pa.binary())], ["doc_id", "start", "n_tokens", "ids"])
                    first = last

    return spread(shards).mapInArrow(run, DOCUMENTS)


def find_tokens(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, position): every place of some tokens, counted over all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                matrix = read_file(path)[2]
                for token in tokens:
                    at = matrix.find(token) + start
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), token, np.int64)), pa.array(at)],
                                                     ["token", "position"])

    return spread(shards).mapInArrow(run, "token long, position long")


def count_tokens(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """(token, n): how often some tokens occur in all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                matrix = read_file(path)[2]
                yield pa.RecordBatch.from_arrays([pa.array(list(tokens), pa.int64()),
                                                  pa.array([matrix.count(t) for t in tokens], pa.int64())], ["token", "n"])

    return spread(shards).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def tokens_at(shards: DataFrame, positions: Sequence[int]) -> DataFrame:
    """(position, token) of a short list of places, from the files that hold them."""
    wanted = np.array(sorted(set(positions)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                mine = wanted[(wanted >= start) & (wanted < start + n)]
                if len(mine):
                    yield pa.RecordBatch.from_arrays([pa.array(mine), pa.array(read_file(path)[2].access(mine - start))],
                                                     ["position", "token"])

    return shards.select("file", "start", "n_tokens").mapInArrow(run, "position long, token long")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op13_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of the ids that the written files give back."""
    shards = write_shards(table(spark, folder, "documents"), fresh_path(spark, "tokens"), default_vocabulary())
    return read_documents(shards).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
