"""Fitted models against enumeration and finite differences, and every stage of the pipeline against brute force."""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tables import marked_docs, marks  # noqa: F401
from test_text import brute_groups, check_packing, rows, words

import corpus_pipeline
from tidemart.llm import hmm, minhash, mixing, quality, toxicity
from tidemart.llm.common import SparseRows, stage


def random_parameters(symbols, seed=0):
    random = np.random.default_rng(seed)
    share = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(random.random(shape) + 0.05)
    return hmm.Parameters(share(hmm.STATES), share(hmm.STATES), share(hmm.STATES, hmm.STATES), share(hmm.STATES, symbols).T.copy())


def paths(p, sequence, begins):
    """Every path of states with its chance."""
    for path in itertools.product(range(hmm.STATES), repeat=len(sequence)):
        chance = (p.first if begins else p.middle)[path[0]] * p.emits[sequence[0], path[0]]
        for a, b, s in zip(path, path[1:], sequence[1:]):
            chance *= p.moves[a, b] * p.emits[s, b]
        yield path, chance


def test_expected_counts_by_enumeration():
    p = random_parameters(6)
    sequences = [np.array(s, np.uint16) for s in ([0, 3, 1], [2], [4, 4], [5, 0, 5])]
    begins = np.array([True, True, False, False])
    found = hmm.Expected(6)
    found.add(p, sequences, begins)
    want = hmm.Expected(6)
    for sequence, begin in zip(sequences, begins):
        every = list(paths(p, sequence, begin))
        whole = sum(c for _, c in every)
        for path, chance in every:
            (want.first if begin else want.middle)[path[0]] += chance / whole
            for a, b in zip(path, path[1:]):
                want.moves[a, b] += chance / whole
            for state, symbol in zip(path, sequence):
                want.emits[symbol, state] += chance / whole
    assert np.allclose(found.first, want.first) and np.allclose(found.middle, want.middle)
    assert np.allclose(found.moves * p.moves, want.moves) and np.allclose(found.emits, want.emits)


def test_a_training_step_is_that_of_the_enumeration(spark):
    """One step over two partitions: chances in proportion to expected counts and what is added to them."""
    texts = [[1, 2, 0], [3, 0], [2, 2, 0], [0]]
    coded = spark.createDataFrame([(np.array(t, np.uint16).tobytes(),) for t in texts], "symbols binary").repartition(2)
    frequencies = np.array([0.4, 0.1, 0.3, 0.2])
    start = hmm.starting_parameters(frequencies)
    found = hmm.train(coded, frequencies, 1)
    want = hmm.Expected(4)
    want.add(start, [np.array(t, np.uint16) for t in texts], np.ones(4, bool))
    emits = want.emits + hmm.EMISSION_ADDED * hmm.STATES * 4 * frequencies[:, None]
    moves = want.moves * start.moves + 0.1
    assert np.allclose(found.emits, emits / emits.sum(axis=0))
    assert np.allclose(found.moves, moves / moves.sum(axis=1, keepdims=True))
    assert np.allclose(found.first, (want.first + 0.1) / (want.first + 0.1).sum())


def test_whole_score_by_enumeration(spark, monkeypatch):
    """All paths of states, and the chance of every rare word in its class, known or not."""
    monkeypatch.setattr(hmm, "HEAD", 2)
    kept = {}
    train = hmm.train
    monkeypatch.setattr(hmm, "train", lambda *a: kept.setdefault("model", train(*a)))
    texts = ["the cat sat", "the dog", "The the cat", "", None, "a bird sat", "the xyz", "sat sat", "unseen words", "dog dog dog"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    found = rows(hmm.score(docs, steps=2))
    learned = [words(t) for i, t in enumerate(texts * 2) if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for t in learned for w in t)
    head = sorted(counts, key=lambda w: (-counts[w], w))[:2]
    tail = [w for w in counts if w not in head]
    model = kept["model"]
    for r in found:
        symbols, inside = [], 0.0
        for w in words((texts * 2)[r["doc_id"]]):
            if w in head:
                symbols.append(1 + head.index(w))
                continue
            mine = hmm.word_class(w)
            symbols.append(1 + len(head) + mine)
            others = [x for x in tail if hmm.word_class(x) == mine]
            inside += math.log10(((counts[w] if w in tail else 0) + 0.1) / (
                sum(counts[x] for x in others) + 0.1 * (len(others) + 1)))
        symbols.append(0)
        likely = sum(chance for _, chance in paths(model, symbols, True))
        assert r["score"] == pytest.approx(math.log10(likely) + inside, abs=1e-9)


def numeric_slope(value, at, step=1e-5):
    return np.array([(value(at + step * e) - value(at - step * e)) / (2 * step) for e in np.eye(len(at))])


def test_ordinal_fit_by_finite_differences():
    """At the fitted weights and thresholds no small change raises the penalized likelihood."""
    random = np.random.default_rng(6)
    x = random.random((300, 5)) < 0.4
    grades = np.digitize(x @ np.array([2.0, -1, 0.5, 0, 1]) + random.logistic(size=300), [0, 1, 2.5])
    matrix = SparseRows(np.nonzero(x)[1], np.concatenate([[0], np.cumsum(x.sum(axis=1))]), 5)
    weights, thresholds = toxicity.fit_ordinal(matrix, grades, ridge=0.7)

    def loss(p):
        w, t = p[:5], np.concatenate([[-np.inf], p[5:], [np.inf]])
        up = 1 / (1 + np.exp(-(t[grades + 1] - x @ w)))
        low = 1 / (1 + np.exp(-(t[grades] - x @ w)))
        return -np.log(up - low).sum() + 0.35 * (w @ w)

    assert np.abs(numeric_slope(loss, np.concatenate([weights, thresholds]))).max() < 0.05


def test_severity_by_the_definition(spark, marked_docs, marks):
    model = toxicity.train(marked_docs, marks)
    texts = {r.doc_id: r.text for r in marked_docs.collect()}
    names = {k.decode(): v for k, v in model.vocabulary.items()}
    for r in toxicity.severity(marked_docs, model).collect():
        bare = "".join(c if c.isalnum() or ord(c) > 126 else " " for c in texts[r.doc_id].lower()).split()
        held = set(bare) | {w[:n] + "*" for w in bare for n in (4, 5) if len(w) > n}
        score = sum(model.weights[k] for w, k in names.items() if w in held)
        up_to = [1 / (1 + math.exp(score - t)) for t in model.thresholds] + [1.0]
        chances = np.diff([0.0, *up_to])
        assert r.severity == pytest.approx(sum(j * c for j, c in enumerate(chances)), abs=1e-9)
        assert r.p_toxic == pytest.approx(1 - chances[0], abs=1e-9) and r.toxic == (1 - chances[0] >= model.toxic_from)
        assert r.grade == int(np.argmax(chances))


def test_logistic_fit_and_calibration_by_finite_differences():
    random = np.random.default_rng(7)
    x = random.random((250, 6)) < 0.5
    x[:, 0] = True
    labels = (x @ np.array([0.3, 1.5, -2, 0, 0.5, 0]) + random.logistic(size=250) > 0).astype(float)
    matrix = SparseRows(np.nonzero(x)[1], np.concatenate([[0], np.cumsum(x.sum(axis=1))]), 6)
    weights = quality.fit_logistic(matrix, labels, ridge=0.5)

    def loss(w):
        scores = x @ w
        return np.logaddexp(0, scores).sum() - labels @ scores + 0.25 * (w[1:] @ w[1:])

    assert np.abs(numeric_slope(loss, weights)).max() < 0.05
    scores = x @ weights
    a, b = quality.calibration(scores, labels)

    def off(p):
        odds = p[0] * scores + p[1]
        return np.logaddexp(0, odds).sum() - labels @ odds + 0.5 * (p[0] - 1) ** 2 + 0.05 * p[1] ** 2

    assert np.abs(numeric_slope(off, np.array([a, b]))).max() < 0.05


def test_quality_by_the_definition(marked_docs, marks):
    """Every score from the weights of the features that a document has, in both views."""
    model = quality.train(marked_docs, marks)
    e = model.encoder
    for r in quality.quality(marked_docs, model).collect():
        row = next(x for x in marked_docs.collect() if x.doc_id == r.doc_id) if r.doc_id < 12 else None
        if row is None:
            continue
        held, text, meta = quality.measures(row.text.encode(), row.n_chars)
        first = 1 + len(e.vocabulary)
        text_score = model.text_weights[0] + sum(model.text_weights[1 + k] for w, k in e.vocabulary.items() if w in held) + sum(
            model.text_weights[first + 16 * i + sum(v > cut for cut in e.text_cuts[i])] for i, v in enumerate(text))
        last = 1 + 6 * 16
        meta_score = model.meta_weights[0] + sum(
            model.meta_weights[1 + 16 * i + sum(v > cut for cut in e.meta_cuts[i])] for i, v in enumerate(meta)
        ) + model.meta_weights[last + zlib.crc32(row.source.encode()) % 256] + model.meta_weights[
            last + 257 + zlib.crc32(row.lang.encode()) % 64]
        (a, b), (c, d), (f, g) = model.text_scale, model.meta_scale, model.joint_scale
        odds = f * (a * text_score + b + c * meta_score + d - model.prior) + g
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-9)
        assert r.good == (r.score >= quality.GOOD_FROM)


def test_views_exchange_what_they_are_sure_of():
    """A view that alone knows a feature teaches it to the other through the pool."""
    random = np.random.default_rng(9)

    def view(labels, right):
        x = np.column_stack([np.ones(len(labels)), np.where(random.random(len(labels)) < right, labels, 1 - labels),
                             random.random(len(labels)) < 0.5]).astype(bool)
        return SparseRows(np.nonzero(x)[1], np.concatenate([[0], np.cumsum(x.sum(axis=1))]), 3)

    truth, pool = (random.random(200) < 0.5).astype(int), (random.random(2000) < 0.5).astype(int)
    encoder = quality.Encoder({}, np.zeros((4, 15)), np.zeros((6, 15)))
    for rounds in (0, 3):
        seed = np.random.default_rng(9)
        random = seed
        views = quality.co_train(view(truth, 0.999), view(truth, 0.75), truth.astype(float), view(pool, 0.999), view(pool, 0.75),
                                 encoder, rounds)
        if not rounds:
            alone = abs(views.meta_weights[1])
    # More rows for the weaker view: its telling feature stays near the log odds of 3 to 1 on either side, 2.2.
    assert abs(abs(views.meta_weights[1]) - 2 * math.log(3)) < abs(alone - 2 * math.log(3)) + 0.3
    assert abs(views.text_weights[1]) > abs(views.meta_weights[1])


def test_every_stage_of_the_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    whole = {r.doc_id: r.asDict() for r in docs.collect()}
    step = dict(corpus_pipeline.STAGES)

    good = stage(step["quality"](spark, docs, sf), "t")
    flags = {r.doc_id: r.good for r in quality.quality(docs, quality.train(docs, labels)).collect()}
    assert ids(good) == sorted(i for i, ok in flags.items() if ok) and 0 < good.count() < docs.count()

    clean = stage(step["toxicity"](spark, good, sf), "t")
    flags = {r.doc_id: r.toxic for r in toxicity.severity(good, toxicity.train(good, labels)).collect()}
    assert ids(clean) == sorted(i for i, bad in flags.items() if not bad)

    single = stage(step["near_duplicates"](spark, clean, sf), "t")
    groups = brute_groups([(r.doc_id, r.text) for r in clean.collect()])
    assert ids(single) == sorted(i for i, (_, label) in groups.items() if i == label)
    for df in (good, clean, single):
        assert df.columns == docs.columns
        assert all(r.asDict() == whole[r.doc_id] for r in df.collect())

    mixed = stage(step["source_mix"](spark, single, sf), "t")
    taken = {r.doc_id: r.taken for r in mixing.mix(single).collect()}
    words_of = Counter()
    for r in mixed.collect():
        words_of[r.doc_id] += len(words(r.text))
    assert {i: n for i, n in words_of.items() if n} == {i: n for i, n in taken.items() if n}

    packed = rows(step["packing"](spark, mixed, sf))
    check_packing(packed, [(r.doc_id, r.text) for r in mixed.collect()], 2048)
    shown = lambda found: Counter((r["doc_id"], r["piece"], r["start"], r["length"], bytes(r["ids"])) for r in found)
    assert shown(rows(corpus_pipeline.run(spark, sf))) == shown(packed)
    assert minhash.keep_first(docs.limit(0)).count() == 0
