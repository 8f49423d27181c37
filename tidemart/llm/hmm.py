"""A hidden Markov language model, trained by Baum-Welch over partitions.

Symbols: the end of a text, the most frequent words (``HEAD``), and for all
other words one of ``CLASSES`` classes by their last letters. A state emits
symbols; a word within its class has a chance that does not depend on the state,
from its count in the training texts. So the model gives every text an exact
likelihood, by the scaled forward recursion over the whole text, while states,
transitions and emissions stay small enough to be sent to every task.

Counts of all words are joined with the rare words of each document and never
gathered. Each step of training adds up expected counts in every partition and
sums them by symbol. Training texts are worked on whole, in windows of at most
``WINDOW`` tokens; a window that does not begin a text has initial chances of
its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table, word_lists

STATES = 8
HEAD = 48_000
CLASSES = 256
STEPS = 5
WINDOW = 512
GROUP_TOKENS = 250_000
FLUSH_WORDS = 300_000
# Fixed values of the contract: added to every count; the part of ids that is held out.
ADDED = 0.1
FOLDS = 10
EMISSION_ADDED = 0.05


def word_class(word: bytes) -> int:
    return crc32(word[-3:]) % CLASSES


def held_out(id_column) -> F.Column:
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) with sums made before the shuffle; memory is bounded by ``FLUSH_WORDS`` words."""
    counts: Counter[bytes] = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for words in word_lists(batch.column(0)):
            counts.update(words)
            if len(counts) > FLUSH_WORDS:
                yield out()
                counts.clear()
    yield out()


@dataclass(frozen=True)
class Parameters:
    """Chances: first state, state after a window's cut, transitions, emissions by (symbol, state)."""

    first: np.ndarray
    middle: np.ndarray
    moves: np.ndarray
    emits: np.ndarray


class Packed:
    """Sequences of symbols side by side, longest first, so that a step works on all that go on."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        sizes = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.flat = np.concatenate([sequences[i] for i in self.order]).astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        # live[t]: sequences longer than t
        self.live = len(sizes) - np.searchsorted(self.sizes[::-1], np.arange(self.sizes[0]), side="right")


def log_likelihood(parameters: Parameters, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural logarithm of each sequence's chance; every sequence has at least one symbol."""
    if not sequences:
        return np.zeros(0)
    p = Packed(sequences)
    total = np.zeros(len(sequences))
    state = np.broadcast_to(parameters.first, (len(sequences), STATES))
    for t, n in enumerate(p.live.tolist()):
        emitted = parameters.emits[p.flat[p.starts[:n] + t]]
        state = (state[:n] if t == 0 else state[:n] @ parameters.moves) * emitted
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log(scale)
    out = np.empty(len(sequences))
    out[p.order] = total
    return out


class Expected:
    """Expected counts of one partition."""

    def __init__(self, symbols: int) -> None:
        self.first = np.zeros(STATES)
        self.middle = np.zeros(STATES)
        self.moves = np.zeros((STATES, STATES))
        self.emits = np.zeros((symbols, STATES))

    def add(self, parameters: Parameters, sequences: list[np.ndarray], begins: np.ndarray) -> None:
        p = Packed(sequences)
        begins = begins[p.order]
        # Packed by time: what a step makes lies together.
        live = p.live.tolist()
        ends = np.cumsum(p.live)
        symbols = np.empty(len(p.flat), np.int64)
        forward = np.empty((len(p.flat), STATES))
        scales = np.empty(len(p.flat))
        state = np.where(begins[:, None], parameters.first, parameters.middle)
        for t, n in enumerate(live):
            part = slice(ends[t] - n, ends[t])
            found = p.flat[p.starts[:n] + t]
            symbols[part] = found
            state = (state if t == 0 else state[:n] @ parameters.moves) * parameters.emits[found]
            scale = state.sum(axis=1)
            state = state / scale[:, None]
            forward[part], scales[part] = state, scale
        back = np.ones((live[-1], STATES))
        for t in range(len(live) - 1, -1, -1):
            n = live[t]
            part = slice(ends[t] - n, ends[t])
            if len(back) < n:
                back = np.concatenate([back, np.ones((n - len(back), STATES))])
            weighted = parameters.emits[symbols[part]] * back / scales[part][:, None]
            if t:
                self.moves += forward[ends[t - 1] - live[t - 1]:ends[t - 1]][:n].T @ weighted
            forward[part] *= back
            back = weighted @ parameters.moves.T
        start = forward[:live[0]]
        self.first += start[begins].sum(axis=0)
        self.middle += start[~begins].sum(axis=0)
        for k in range(STATES):
            self.emits[:, k] += np.bincount(symbols, forward[:, k], len(self.emits))


COUNTS = "kind int, at int, " + ", ".join(f"k{k} double" for k in range(STATES))


def expected_counts(parameters: Parameters):
    """Task: coded training texts to expected counts (kind, at, one column for each state)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Expected(len(parameters.emits))
        group: list[np.ndarray] = []
        begins: list[bool] = []
        waiting = 0
        for batch in batches:
            for data in batch.column(0):
                symbols = np.frombuffer(data.as_py(), np.uint16)
                for at in range(0, len(symbols), WINDOW):
                    group.append(symbols[at:at + WINDOW])
                    begins.append(at == 0)
                    waiting += len(group[-1])
                    if waiting >= GROUP_TOKENS:
                        sums.add(parameters, group, np.array(begins))
                        group, begins, waiting = [], [], 0
        if group:
            sums.add(parameters, group, np.array(begins))
        used = np.flatnonzero(sums.emits.sum(axis=1))
        kinds = np.r_[np.zeros(len(used)), np.ones(STATES), 2, 3].astype(np.int32)
        places = np.r_[used, np.arange(STATES), 0, 0].astype(np.int32)
        values = np.concatenate([sums.emits[used], sums.moves * parameters.moves, sums.first[None], sums.middle[None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(places), *[pa.array(values[:, k].copy()) for k in range(STATES)]],
            ["kind", "at", *[f"k{k}" for k in range(STATES)]])

    return run


def starting_parameters(frequencies: np.ndarray) -> Parameters:
    """Emissions near the frequencies, different by chance; states that tend to stay."""
    random = np.random.default_rng(11)
    emits = frequencies[:, None] * random.gamma(2.0, 0.5, (len(frequencies), STATES))
    moves = np.full((STATES, STATES), 0.05 / max(1, STATES - 1)) + np.eye(STATES) * (0.95 - 0.05 / max(1, STATES - 1))
    even = np.full(STATES, 1 / STATES)
    return Parameters(even, even, moves, emits / emits.sum(axis=0))


def train(coded: DataFrame, frequencies: np.ndarray, steps: int = STEPS) -> Parameters:
    """Baum-Welch. ``coded`` has the training texts' ``symbols``; what is gathered is one row per symbol."""
    now = starting_parameters(frequencies)
    for _ in range(steps):
        rows = coded.select("symbols").mapInArrow(expected_counts(now), COUNTS).groupBy("kind", "at").agg(
            *[F.sum(f"k{k}").alias(f"k{k}") for k in range(STATES)]).toArrow()
        kinds, places = rows.column("kind").to_numpy(), rows.column("at").to_numpy()
        values = np.column_stack([rows.column(f"k{k}").to_numpy() for k in range(STATES)])
        emits = np.zeros_like(now.emits)
        emits[places[kinds == 0]] = values[kinds == 0]
        # A state that has seen a symbol little leans on how frequent the symbol is.
        emits += EMISSION_ADDED * STATES * len(frequencies) * frequencies[:, None]
        moves = np.zeros_like(now.moves)
        moves[places[kinds == 1]] = values[kinds == 1]
        moves += 0.1
        first, middle = [values[kinds == k].sum(axis=0) + 0.1 for k in (2, 3)]
        now = Parameters(first / first.sum(), middle / middle.sum(), moves / moves.sum(axis=1, keepdims=True),
                         emits / emits.sum(axis=0))
    return now


CODED = ("doc_id long, held_out boolean, n_tokens long, symbols binary, "
         "rare array<binary>, times array<int>")


def coder(head: dict[bytes, int]):
    """Task: texts to symbols, and the words outside the head with how often they stand in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = len(head) + 1
        for batch in batches:
            coded, rare, times, sizes = [], [], [], []
            for words in word_lists(batch.column(2)):
                symbols = [head.get(w, -1) for w in words]
                others = Counter()
                for i, s in enumerate(symbols):
                    if s < 0:
                        word = words[i]
                        others[word] += 1
                        symbols[i] = base + word_class(word)
                symbols.append(0)
                coded.append(np.array(symbols, np.uint16).tobytes())
                rare.append(list(others))
                times.append(list(others.values()))
                sizes.append(len(symbols))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(coded, pa.binary()),
                 pa.array(rare, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int32()))],
                [part.split()[0] for part in CODED.split(", ")])

    return run


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    A null text is empty: one token, its end. A null id is taken as an empty
    text for the choice of training rows, so it is held out. Without training
    rows all counts are 0.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    learned = source.filter(~F.col("held_out"))
    words = stage(learned.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(
        F.sum("n").alias("n")), "words")
    texts = learned.count()
    totals = words.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("all")).first()
    kinds, tokens = totals["kinds"] + (texts > 0), totals["all"] + texts
    top = words.orderBy(F.desc("n"), "word").limit(HEAD).collect()
    head = {bytes(row["word"]): k + 1 for k, row in enumerate(top)}
    counts = np.zeros(1 + len(head) + CLASSES)
    counts[0] = texts
    counts[1:len(head) + 1] = [row["n"] for row in top]

    # Words outside the head: their class's counts, one row for each class.
    in_class = F.crc32(F.substring("word", -3, 3)) % CLASSES
    last = top[-1] if top else None
    tail = words.filter((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > F.lit(bytes(last["word"]))))
                        if last else F.lit(False))
    class_tokens, class_kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in tail.groupBy(in_class.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect():
        class_tokens[row["c"]], class_kinds[row["c"]] = row["n"], row["k"]
    counts[len(head) + 1:] = class_tokens
    # A class has room for words that no training text has.
    room = counts + ADDED * np.r_[np.ones(1 + len(head)), class_kinds + 1]
    frequencies = room / room.sum()

    coded = stage(source.mapInArrow(coder(head), CODED).withColumn("row", F.monotonically_increasing_id()), "coded")
    model = train(coded.filter(~F.col("held_out")), frequencies, steps)

    base_all = tokens + ADDED * (kinds + 1)
    base_log = np.log10((counts + ADDED) / base_all)
    base_log[len(head) + 1:] = 0.0
    certain = np.r_[counts[:len(head) + 1] > 0, np.zeros(CLASSES, bool)]

    def likelihoods(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = [np.frombuffer(x.as_py(), np.uint16) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(certain[s].sum()) for s in sequences], pa.int64()),
                 pa.array([float(base_log[s].sum()) for s in sequences], pa.float64()),
                 pa.array(log_likelihood(model, sequences) / np.log(10))], ["row", "known", "base", "likely"])

    scored = coded.select("row", "symbols").mapInArrow(
        likelihoods, "row long, known long, base double, likely double")
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "row", F.col("r.rare").alias("word"), F.col("r.times").alias("times"))
    in_classes = F.array(*[F.lit(float(x)) for x in class_tokens + ADDED * (class_kinds + 1)])
    n = F.coalesce("n", F.lit(0)) + ADDED
    by_row = rare.join(tail, "word", "left").select(
        "row", F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10(n / F.lit(float(base_all)))).alias("base"),
        (F.col("times") * F.log10(n / F.element_at(in_classes, (in_class + 1).cast("int")))).alias("likely")).groupBy("row").agg(
        F.sum("known").alias("more_known"), F.sum("base").alias("more_base"), F.sum("likely").alias("more_likely"))
    zero = lambda name: F.coalesce(name, F.lit(0))
    return coded.select("row", "doc_id", "held_out", "n_tokens").join(scored, "row").join(by_row, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("more_known")).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") + zero("more_base")).alias("base_score"),
        (F.col("likely") + zero("more_likely")).alias("score"))


def op1_hidden_markov_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))
