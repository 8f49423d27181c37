"""Text operators on small tables, against brute force."""

from __future__ import annotations

import itertools
import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tables import marked_docs, marks, no_docs, odd_docs  # noqa: F401

from tidemart.llm import hmm, minhash, mixing, packing, quality, samples, toxicity

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"


def rows(df):
    return [row.asDict() for row in df.collect()]


def words(text):
    return (text or "").encode().lower().split()


def test_scores_count_every_token(odd_docs):
    found = rows(hmm.score(odd_docs, steps=1))
    given = [(r.doc_id, r.text) for r in odd_docs.collect()]
    learned = [t for i, t in given if zlib.crc32(str("" if i is None else i).encode()) % 10]
    counts = Counter(w for t in learned for w in [*words(t), None])
    n, kinds = sum(counts.values()), len(counts)
    want = sorted((str(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]),
                   round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in [*words(t), None]), 4))
                  for i, t in given)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in found) == want
    assert {r["train_tokens"] for r in found} == {n}
    assert all(math.isfinite(r["score"]) for r in found)


def test_forward_recursion_is_exact():
    random = np.random.default_rng(0)
    share = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(random.random(shape))
    p = hmm.Parameters(share(hmm.STATES), share(hmm.STATES), share(hmm.STATES, hmm.STATES), share(hmm.STATES, 5).T.copy())
    sequences = [np.array(s, np.uint16) for s in ([0, 3, 1], [2], [4, 4])]
    for sequence, found in zip(sequences, hmm.log_likelihood(p, sequences)):
        total = 0.0
        for path in itertools.product(range(hmm.STATES), repeat=len(sequence)):
            chance = p.first[path[0]] * p.emits[sequence[0], path[0]]
            for a, b, s in zip(path, path[1:], sequence[1:]):
                chance *= p.moves[a, b] * p.emits[s, b]
            total += chance
        assert found == pytest.approx(math.log(total))


def test_training_raises_the_likelihood(spark, sf):
    found = hmm.score(spark.read.parquet(f"{sf}/documents.parquet"))
    sums = {r["held_out"]: r for r in found.groupBy("held_out").agg({"score": "sum", "base_score": "sum"}).collect()}
    assert all(r["sum(score)"] > r["sum(base_score)"] for r in sums.values())


def test_scores_of_nothing(no_docs):
    assert hmm.score(no_docs, steps=1).count() == 0


def brute_groups(docs):
    sets = {}
    for i, text in docs:
        w = words(text)
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(sets, 2):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {i: (len(sets[i]), label[i]) for i in sets}


def test_near_duplicates_equal_brute_force(spark):
    import random

    dice = random.Random(2)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for i in range(150):
        own = [f"q{i}x{k}" for k in range(dice.choice([3, 8, 14, 25]))]
        docs.append((i, " ".join(own + passage)))
    base = [f"b{i}" for i in range(200)]
    for i in range(150, 260):
        copy = list(base)
        for _ in range(dice.randint(0, 8)):
            copy[dice.randrange(len(copy))] = f"edit{dice.random()}"
        docs.append((i, " ".join(copy)))
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    want = brute_groups(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == want
    assert found.filter("kept").count() == found.filter("first").count() == len({v[1] for v in want.values()})


def test_near_duplicates_of_odd_rows(odd_docs):
    found = rows(minhash.near_duplicates(odd_docs))
    assert len(found) == odd_docs.count()
    assert [r["component_id"] for r in found if r["n_shingles"] == 2] == [1, 1, 1, 1]
    assert sorted(r["doc_id"] for r in found if r["n_shingles"] == 0) == [3, 4]
    left = minhash.keep_first(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 7, 8]
    assert minhash.near_duplicates(odd_docs.limit(0)).count() == 0


def test_the_smallest_id_of_a_group_stays(spark):
    """Whatever the order of the rows and their partitions; nulls come last."""
    text = "one two three four five six seven"
    docs = [(9, text), (5, text), (None, text), (7, text + " eight nine"), (2, "other words stand in here now"),
            (None, "words of rows without any number here"), (None, "words of rows without any number here")]
    for order in (docs, docs[::-1], docs[3:] + docs[:3]):
        for parts in (1, 3) if order is docs else (2,):
            left = minhash.keep_first(spark.createDataFrame(order, "doc_id long, text string").repartition(parts))
            assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "5", "7", "None"]


def test_small_inputs_need_few_jobs(spark):
    group = f"jobs-{id(spark)}"
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g")], "doc_id long, text string")
    spark.sparkContext.setJobGroup(group, "two rows")
    try:
        assert minhash.keep_first(docs).count() == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < 25


def test_samples_are_bounded_by_rows(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.range(0, 4_000_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    assert samples.labelled(docs, labels, "toxic", 20_000).count() == 1000
    twice = spark.range(200_000).select((F.col("id") % 2).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    found = samples.labelled(twice, labels, "toxic", 100)
    assert 50 < found.count() < 160
    assert found.select("doc_id", "text").exceptAll(twice).count() == 0
    copies = twice.withColumn("text", F.lit("same"))
    assert samples.labelled(copies, labels, "toxic", 100).count() == 2
    assert samples.labelled(docs.limit(0), labels, "toxic").count() == 0


def check_packing(found, docs, length):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for doc, text in docs:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        for number, at in enumerate(range(0, len(ids), length)):
            cut = np.array(ids[at:at + length], "<u4")
            want[doc, number, at, len(cut), zlib.crc32(cut.tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences)


def test_packing(odd_docs, spark, sf):
    check_packing(rows(packing.pack_documents(odd_docs, VOCABULARY)), [(r.doc_id, r.text) for r in odd_docs.collect()], 2048)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    found = rows(packing.pack(packing.pieces(docs, VOCABULARY), shard_pieces=64))
    made = check_packing(found, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    assert made <= 1.08 * sum(r["length"] for r in found) / 2048 + 1
    assert packing.pack_documents(odd_docs.limit(0), VOCABULARY).count() == 0


def test_packed_sequences_hold_the_ids(odd_docs):
    """The tokens come out, not only their digests: joined by piece they are those of the documents."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(VOCABULARY)
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"])
    want = {r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 0] for r in docs.collect()}
    unpacked = defaultdict(list)
    packed = packing.pack(packing.pieces(docs, VOCABULARY, length=64), length=64, shard_pieces=4)
    for r in sorted(rows(packed), key=lambda r: r["start"]):
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        unpacked[r["doc_id"]].extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert unpacked == want


def test_ids_that_were_handed_on_are_freed(spark):
    """What a Python worker holds does not grow with the texts that it has cut into pieces."""
    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    run = packing.pieces(Docs(), VOCABULARY)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["some words " * 3000] * 40)], ["doc_id", "text"])
    held = []
    tracemalloc.start()
    try:
        for _ in range(4):
            assert sum(sum(found.column(3).to_pylist()) for found in run(iter([batch]))) == 40 * 6001
            held.append(tracemalloc.get_traced_memory()[0])
    finally:
        tracemalloc.stop()
    assert held[-1] - held[0] < 100_000, held  # the ids of a batch are 960 kB


def test_sum_of_squares_rule():
    """Every piece goes where the sum of squares becomes smallest."""
    random = np.random.default_rng(1)
    sizes = random.integers(1, 20, 300)
    placed = packing.sum_of_squares(sizes, 20)
    fill = Counter()
    squares = lambda gaps: sum(v * v for v in Counter(g for g in gaps if g).values())
    for i, size in enumerate(sizes):
        options = {}
        for where in [*fill, None]:
            if where is None or fill[where] + size <= 20:
                after = dict(fill)
                after["new" if where is None else where] = after.get(where, 0) + size
                options[where] = squares(20 - v for v in after.values())
        chosen = placed[i] if placed[i] in fill else None
        assert options[chosen] == min(options.values())
        fill[placed[i]] += size
    assert max(fill.values()) <= 20


def test_mix_of_odd_rows(odd_docs):
    found = rows(mixing.mix(odd_docs))
    assert len(found) == odd_docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    total = sum(r["size"] for r in found)
    targets = {(r["source_size"], r["target"]) for r in found}
    assert sum(t for _, t in targets) == pytest.approx(1.5 * total)
    assert rows(mixing.mix(odd_docs)) == found or sorted(map(str, rows(mixing.mix(odd_docs)))) == sorted(map(str, found))
    again = mixing.resample(odd_docs)
    assert again.columns == odd_docs.columns
    assert sum(len(words(r.text)) for r in again.collect()) == sum(r["taken"] for r in found)
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_mix_comes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 50), ("s0", "s1", "s2", None)[min(3, i % 9)]) for i in range(6000)],
                                 "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in rows(mixing.mix(docs)):
        taken[r["target"]] += r["taken"]
        target[r["target"]] = r["target"]
    assert all(abs(taken[t] - t) <= 50 for t in target)


def test_severity_separates(marked_docs, marks, odd_docs, no_docs):
    model = toxicity.train(marked_docs, marks)
    assert np.all(np.diff(model.thresholds) > 0)
    found = {r.doc_id: r for r in toxicity.severity(marked_docs, model).collect()}
    held = range(120, 180)
    assert np.mean([found[i].toxic == (i % 3 == 1) for i in held]) > 0.85
    assert toxicity.severity(odd_docs, model).count() == odd_docs.count()
    assert toxicity.drop_toxic(odd_docs, marks.limit(0)).count() == odd_docs.count()
    assert toxicity.severity(no_docs, model).count() == 0


def test_ordinal_slope():
    """The gradient is that of the likelihood."""
    from tidemart.llm.common import SparseRows

    random = np.random.default_rng(4)
    found = [np.flatnonzero(random.random(6) < 0.5) for _ in range(400)]
    matrix = SparseRows(np.concatenate(found), np.cumsum([0, *map(len, found)]), 6)
    truth = matrix.times(np.array([2.0, -2, 0, 0, 1, 0])) + random.logistic(size=400)
    grades = np.digitize(truth, [0, 1, 2])
    weights, thresholds = toxicity.fit_ordinal(matrix, grades, ridge=0.1)
    assert np.allclose(weights, [2, -2, 0, 0, 1, 0], atol=0.7) and np.all(np.diff(thresholds) > 0)


def test_quality_separates(marked_docs, marks, odd_docs, no_docs):
    model = quality.train(marked_docs, marks)
    found = {r.doc_id: r for r in quality.quality(marked_docs, model).collect()}
    assert np.mean([found[i].good == (i % 3 != 0) for i in range(120, 180)]) > 0.9
    assert quality.quality(odd_docs, model).count() == odd_docs.count()
    assert quality.keep_good(odd_docs, marks.limit(0)).count() == odd_docs.count()
    assert quality.quality(no_docs, model).count() == 0
