"""Near duplicates: MinHash signatures, banding, verification, connected components.

Two documents are linked if their sets of five-word shingles have a Jaccard
similarity of 0.75 or more. 128 universal hash minima in 32 bands of 4 rows
miss a pair at exactly 0.75 with probability 5e-6, and a more similar one less.

Large groups of copies never become pairs:

1. Documents with equal sets are one class; only a class's first row goes on.
2. In each bucket of a band every class is compared with one centre only; what
   is linked to it is one component. A second round takes other centres.
3. What then shares a bucket with another component is compared with what it
   shares a rare shingle with, so that no link between components is lost and
   documents that share a common passage only are not compared. The join looks
   at sizes, at what can still be shared after the first common shingle and at
   two bits of each minimum, and emits what passes that; a shingle of many rows is dealt to many tasks by a salt that follows its rows.

Every link is confirmed on the full sets, made again from the whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemart.llm.common import drop_staged, stage, stage_counted, table, word_lists
from tidemart.llm.components import components

WORDS = 5
BANDS, ROWS = 32, 4
SIMILARITY = 75
CENTRE_ROUNDS = 2
SALT_MEMBERS = 1024
FREQUENT = 1 << 16
# Of 256 signature bits 32 differ at similarity 0.75, with a deviation of 6.3: five deviations more pass.
MOST_BITS = 64

_RANDOM = np.random.default_rng(7)
_A = _RANDOM.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_MIX = _RANDOM.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX[6]
    return x ^ (x >> np.uint64(29))


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    total = np.full(n, len(words) if len(words) < WORDS else 0, np.uint64)
    for i in range(min(WORDS, len(words))):
        total = mixed(total + each[i:i + n]) * _MIX[i]
    return np.unique(total)


def minima(found: np.ndarray) -> np.ndarray:
    """The smallest value of every universal hash (a x + b) >> 32 over the set."""
    out = np.full(BANDS * ROWS, 2**32, np.uint64)
    for at in range(0, len(found), 512):
        part = found[at:at + 512]
        values = np.multiply.outer(_A, part)
        values += _B[:, None]
        np.minimum(out, values.min(axis=1) >> np.uint64(32), out=out)
    return out


SETS = ("doc_id long, row long, n_shingles long, key1 long, key2 long, bands array<long>, "
        "s0 long, s1 long, s2 long, s3 long, packed binary")
NAMES = [part.split()[0] for part in SETS.split(", ")]


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=1)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    for batch in batches:
        ids = batch.column(0)
        n = len(ids)
        sizes = np.zeros(n, np.int64)
        keys = np.zeros((n, 2), np.uint64)
        bands = np.zeros((n, BANDS), np.uint64)
        bits = np.zeros((n, 4), np.uint64)
        packed = []
        for i, words in enumerate(word_lists(batch.column(2))):
            found = shingles(words)
            packed.append(squeeze.compress(b" ".join(words)))
            if not len(found):
                continue
            sizes[i] = len(found)
            whole = xxhash.xxh3_128_intdigest(found.tobytes())
            keys[i] = whole & (2**64 - 1), whole >> 64
            least = minima(found)
            key = np.arange(BANDS, dtype=np.uint64)
            for row in least.reshape(BANDS, ROWS).T:
                key = mixed(key * _MIX[7] + row)
            bands[i] = key
            low = np.concatenate([least & np.uint64(1), (least >> np.uint64(1)) & np.uint64(1)])
            bits[i] = (low.reshape(4, 64) * weights).sum(axis=1)
        signed = lambda x: pa.array(x.view(np.int64))
        band_lists = pa.ListArray.from_arrays(
            pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), signed(bands.reshape(-1)))
        yield pa.RecordBatch.from_arrays(
            [ids, batch.column(1), pa.array(sizes), signed(keys[:, 0].copy()), signed(keys[:, 1].copy()), band_lists,
             *[signed(bits[:, k].copy()) for k in range(4)], pa.array(packed, pa.binary())], NAMES)


@F.arrow_udf(BooleanType())
def similar(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether the full sets of two packed texts are similar enough, in whole numbers."""
    import zstandard

    loose = zstandard.ZstdDecompressor()
    kept: dict[bytes, np.ndarray] = {}

    def whole(data: bytes) -> np.ndarray:
        if data not in kept:
            if len(kept) >= 64:
                kept.clear()
            kept[data] = shingles(loose.decompress(data).split())
        return kept[data]

    out = []
    for a, b in zip(left, right):
        x, y = whole(a.as_py()), whole(b.as_py())
        both = len(np.intersect1d(x, y, assume_unique=True))
        out.append(100 * both >= SIMILARITY * (len(x) + len(y) - both))
    return pa.array(out, pa.bool_())


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose sets are similar enough. ``texts`` has rep and packed."""
    one = texts.select(F.col("rep").alias("a"), F.col("packed").alias("left_text"))
    two = texts.select(F.col("rep").alias("b"), F.col("packed").alias("right_text"))
    return pairs.join(one, "a").join(two, "b").filter(similar("left_text", "right_text")).select("a", "b")


def differing(x: str, y: str):
    """Signature bits that differ."""
    differ = [F.bit_count(F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}"))) for k in range(4)]
    return differ[0] + differ[1] + differ[2] + differ[3]


def by_centre(links_to_centres: DataFrame, jumps: int = 2) -> DataFrame:
    """(node, label): where the links lead in up to 2^jumps steps; every row has one centre, and no cycle."""
    found = links_to_centres.select(F.col("a").alias("node"), F.col("b").alias("label"))
    for _ in range(jumps):
        ahead = found.select(F.col("node").alias("label"), F.col("label").alias("next"))
        found = found.join(ahead, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return found


def class_labels(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, label) of the class representatives that are linked with another: the component's smallest one.

    What links to centres connect is worked out once, after all rounds with
    centres; between them a row only needs to know which centre it leads to. The links
    found after that are few and are put between components, not rows.
    """
    signs = ["s0", "s1", "s2", "s3"]
    nothing = classes.select(F.col("rep").alias("node"), F.col("rep").alias("label")).limit(0)
    reps = sets.join(classes.select("rep"), F.col("row") == F.col("rep"), "left_semi")
    buckets = reps.select(F.col("row").alias("rep"), F.explode("bands").alias("key"))
    many = buckets.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    members, n = stage_counted(buckets.join(many, "key"), "buckets")
    if not n:
        return nothing
    # How many others a class meets in its buckets: the original of a group of copies meets most.
    near = members.groupBy("rep").agg(F.sum("members").alias("met"))
    texts = stage(sets.select(F.col("row").alias("rep"), *signs, "packed").join(near, "rep"), "texts")
    marks = texts.select("rep", *signs)
    popular = texts.select("rep", "met")
    labels = found = None
    for number in range(CENTRE_ROUNDS):
        open_rows = (members if labels is None else across(members, labels)).join(popular, "rep")
        # First the class that meets most others, then others at random.
        order = F.xxhash64("rep", F.lit(number)) if number else F.struct(-F.col("met"), F.col("rep"))
        centres = open_rows.groupBy("key").agg(F.min_by("rep", order).alias("centre"))
        pairs = open_rows.join(centres, "key").filter("rep != centre").select(
            F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
        passed = pairs.alias("p").join(marks.alias("x"), F.col("p.a") == F.col("x.rep")).join(
            marks.alias("y"), F.col("p.b") == F.col("y.rep")).select("p.a", "p.b", differing("x", "y").alias("apart")).filter(
            F.col("apart") <= MOST_BITS)
        # The nearest centre by signature is tried; the others are left to what follows.
        nearest = passed.groupBy("a").agg(F.min_by("b", F.struct("apart", "b")).alias("b"))
        new = stage(confirmed(nearest, texts), "links")
        found = new if found is None else found.unionByName(new)
        if number == 0:
            # The first centre is the one highest in one order, so its links have no cycle.
            labels = stage(by_centre(new), "centres")
    labels = stage(components(found, "a", "b"), "labels")
    left_over, n = stage_counted(across(members, labels).select("rep", "label").distinct().join(texts, "rep"), "left-over")
    if n:
        rest = stage(sharing_rare(left_over), "rest")
        late = confirmed(rest, texts)
        for end in ("a", "b"):
            late = late.join(left_over.select(F.col("rep").alias(end), F.col("label").alias(f"of_{end}")), end)
        joined = stage(components(late, "of_a", "of_b").select(
            F.col("node").alias("label"), F.col("label").alias("whole")), "joined")
        # A class alone in its component has no label yet, but may have a late link.
        alone = joined.select(F.col("label").alias("node"), "label")
        late_labels = stage(labels.unionByName(alone).distinct().join(joined, "label", "left").select(
            "node", F.coalesce("whole", "label").alias("label")), "labels")
        for done in (labels, rest, joined):
            drop_staged(done)
        labels = late_labels
    for done in (members, texts, left_over):
        drop_staged(done)
    return labels


PREFIXES = "rep long, label long, size long, tail long, s0 long, s1 long, s2 long, s3 long, shingle long"


def frequent_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, n) of shingles that several documents of the task hold."""
    import zstandard

    loose = zstandard.ZstdDecompressor()
    waiting: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(waiting) if waiting else np.zeros(0, np.uint64), return_counts=True)
        waiting.clear()
        many = counts > 3
        return pa.RecordBatch.from_arrays(
            [pa.array(values[many].view(np.int64)), pa.array(counts[many].astype(np.int64))], ["shingle", "n"])

    held = 0
    for batch in batches:
        for data in batch.column(0):
            waiting.append(shingles(loose.decompress(data.as_py()).split()))
            held += len(waiting[-1])
            if held > 2_000_000:
                yield out()
                held = 0
    yield out()


def sharing_rare(rest: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may still be linked.

    Two sets of this similarity share one of the first quarter (and one more)
    of either's shingles in any common order. The order puts frequent shingles last,
    so documents that share but a common passage never meet. It need not be
    exact, only the same everywhere: the most frequent shingles are sent to all
    tasks, at most ``FREQUENT`` of them, the others are in order of their hash.
    """
    common = rest.select("packed").mapInArrow(frequent_shingles, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    frequent = common.column("shingle").to_numpy().view(np.uint64)
    by_hash = np.argsort(frequent)
    sorted_frequent = frequent[by_hash]
    rank = -by_hash  # the most frequent one has the first row and goes last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        loose = zstandard.ZstdDecompressor()
        for batch in batches:
            firsts, sizes, tails = [], [], []
            for data in batch.column(6):
                found = shingles(loose.decompress(data.as_py()).split())
                n = len(found)
                at = np.minimum(np.searchsorted(sorted_frequent, found), max(0, len(frequent) - 1))
                known = sorted_frequent[at] == found if len(frequent) else np.zeros(n, bool)
                place = np.where(known, rank[at] if len(frequent) else 0, -FREQUENT - 1)
                order = np.argsort(place, kind="stable")
                firsts.append(found[order[:n - -(-SIMILARITY * n // 100) + 1]])
                sizes.append(n)
                tails.append(n - np.arange(len(firsts[-1])))
            i = np.repeat(np.arange(len(firsts)), [len(x) for x in firsts])
            taken = batch.select([0, 1, 2, 3, 4, 5]).take(pa.array(i))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns[:2], pa.array(np.array(sizes, np.int64)[i]),
                 pa.array(np.concatenate(tails) if tails else np.zeros(0, np.int64)), *taken.columns[2:],
                 pa.array((np.concatenate(firsts) if firsts else np.zeros(0, np.uint64)).view(np.int64))],
                [part.split()[0] for part in PREFIXES.split(", ")])

    rows = rest.select("rep", "label", "s0", "s1", "s2", "s3", "packed").mapInArrow(run, PREFIXES)
    rows = stage(rows, "prefixes")
    counts = rows.groupBy("shingle").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high"))
    # Only shingles of more than one component; many rows of one are dealt to many tasks.
    counts = counts.filter("low != high").select("shingle", F.ceil(F.col("members") / SALT_MEMBERS).alias("salts"))
    salted = rows.join(counts, "shingle")
    x = salted.withColumn("salt", F.pmod(F.xxhash64("rep"), "salts")).alias("x")
    y = salted.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).alias("y")
    # From the first shared shingle on, either set has only its tail to share; the links need this much.
    sizes_fit = (100 + SIMILARITY) * F.least("x.tail", "y.tail") >= SIMILARITY * (F.col("x.size") + F.col("y.size"))
    return x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.salt") == F.col("y.salt"))
                  & (F.col("x.label") < F.col("y.label")) & sizes_fit & (differing("x", "y") <= MOST_BITS)).select(
        F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()


def across(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket rows with their component, for buckets that hold more than one."""
    named = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep"))
    mixed_keys = named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter(
        "least != most").select("key")
    return named.join(mixed_keys, "key", "left_semi")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    row_column: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, ``row`` and ``first`` (one row of each component).

    A document without words has an empty set, is linked with nothing and kept.
    ``component_id`` is the smallest doc_id of the component; null if all are
    null. Rows that repeat a doc_id are documents of their own; with equal text
    they are in one component and both ``kept``, but one is ``first``: that with the
    smallest doc_id, nulls last. ``row_column`` tells rows apart; without it they are numbered.
    """
    row = F.col(row_column).cast("long") if row_column else F.monotonically_increasing_id()
    sets = stage(docs.select(F.col(id_column).cast("long").alias("doc_id"), row.alias("row"),
                             F.col(text_column).alias("text")).mapInArrow(sets_of, SETS), "sets")
    full = sets.filter("n_shingles > 0")
    classes = stage(full.groupBy("key1", "key2").agg(
        F.min("row").alias("rep"), F.min("doc_id").alias("least_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first_row")), "classes")
    labels = class_labels(sets, classes)
    grouped = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "label", F.coalesce("label", "rep"))
    whole = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"),
                                         F.min("first_row").alias("first_row"))
    known = stage(grouped.select("key1", "key2", "label").join(whole, "label").select(
        "key1", "key2", "component_id", F.col("first_row.row").alias("first")), "known")
    drop_staged(classes)
    named = full.select("row", "doc_id", "n_shingles", "key1", "key2").join(known, ["key1", "key2"])
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull() & F.col("component_id").isNull())
    out = named.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "row",
                       (F.col("row") == F.col("first")).alias("first"))
    empty = sets.filter("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"), "row",
        F.lit(True).alias("first"))
    return out.unionByName(empty)


def op6_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("row", "first")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, one of each component, all columns kept.

    The row with the smallest doc_id stays, null ids last; of rows that repeat
    it, one. Rows are numbered in a staged table, so only numbers and flags are joined back.
    """
    rows = stage(docs.withColumn("#row", F.monotonically_increasing_id()), "rows")
    found = near_duplicates(rows, row_column="#row").filter("first").select(F.col("row").alias("#kept"))
    return rows.join(found, F.col("#row") == F.col("#kept"), "left_semi").drop("#row")
