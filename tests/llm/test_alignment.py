"""Alignment of two tokenizers against comparing every pair of byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tables import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from tidemart.llm import alignment

PATHS = alignment.default_vocabularies()
ONE = Tokenizer.from_file(PATHS[0])
ONE.encode_special_tokens = True
TWO = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
BYTES = {c: b for b, c in alignment.ALPHABET.items()}


def plain_tokens(text):
    """[(id, bytes)] of both tokenizers; nothing if either does not give the text back."""
    if not text:
        return [], []
    one = ONE.encode(" " + text, add_special_tokens=False)
    a = [(k, bytes(BYTES[c] for c in t)) for k, t in zip(one.ids, one.tokens)]
    b = []
    for k in TWO.encode(text):
        piece = TWO.id_to_piece(k)
        b.append((k, bytes([int(piece[3:5], 16)]) if TWO.is_byte(k) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == whole for side in (a, b))
    return (a, b) if same else ([], [])


def ranges(tokens):
    at = 0
    for number, data in tokens:
        yield number, at, at + len(data)
        at += len(data)


def plain_alignment(text):
    a, b = (list(ranges(side)) for side in plain_tokens(text))
    common = sorted({e for *_, e in a} & {e for *_, e in b})
    groups = []
    for low, high in zip([0, *common], common):
        groups.append(tuple(",".join(str(k) for k, s, e in side if low <= s and e <= high) for side in (a, b)))
    links = [(x, y) for x, s, e in a for y, t, f in b if s < f and t < e]
    digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
    return len(a), len(b), len(groups), digest, Counter(links)


def expected(texts):
    each = [plain_alignment(t) for t in texts]
    counts = Counter(p for *_, links in each for p in links)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [(n_a, n_b, groups, sum(links.values()), sum(n for p, n in links.items() if counts[p] == most[p[0]]),
             sum(n * counts[p] for p, n in links.items()), digest) for n_a, n_b, groups, digest, links in each]


TEXT = st.one_of(st.text(max_size=50), st.text(alphabet="ab  \n\t ▁　é!'st<|endoftext|>1\x1c\x00中🎉", max_size=50))


@given(st.lists(st.one_of(st.none(), TEXT), max_size=10))
@settings(max_examples=200, deadline=None)
@example(["a  b   c \n\n d ", " lead", "\nx　y", " ", "tail  ", "<|endoftext|>", "<s> </s> <unk>", "▁", "a▁b"])
def test_group_against_brute_force(texts):
    tools = alignment.both(*PATHS)
    found = alignment.linked(tools, tools.tokens(texts))
    for i, text in enumerate(texts):
        n_a, n_b, groups, digest, links = plain_alignment(text)
        assert (found["n_a"][i], found["n_b"][i], found["n_groups"][i], found["groups_sha256"][i]) == (n_a, n_b, groups, digest)
        assert found["n_links"][i] == sum(links.values())
        codes, times = found["pairs"][i] or ([], [])
        assert {divmod(int(c), len(tools.two.bytes)): int(t) for c, t in zip(codes, times)} == links


@given(st.sets(st.integers(0, 3000), min_size=1), st.sets(st.integers(0, 3000)))
def test_galloping_against_counting(short, long):
    short, long = np.array(sorted(short)), np.array(sorted(long), np.int64)
    assert alignment.gallop(short, long).tolist() == [int((long < x).sum()) for x in short]


def check(docs, **options):
    given_rows = docs.collect()
    want = sorted(zip([str(r.doc_id) for r in given_rows], expected([r.text for r in given_rows])))
    found = alignment.align_documents(docs, *PATHS, **options).collect()
    assert sorted((str(r.doc_id), (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256))
                  for r in found) == want


def test_documents_against_brute_force(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 1500"))


def test_pairs_beyond_the_head_are_joined(spark, sf):
    check(spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 600"), head_pairs=50)
    check(spark.read.parquet(f"{sf}/documents.parquet").filter("length(text) < 300"), head_pairs=0)


def test_odd_documents(spark, odd_docs, no_docs):
    check(odd_docs.filter("doc_id is null or doc_id not in (5, 6)"))
    long = alignment.align_documents(odd_docs, *PATHS).filter("doc_id in (5, 6)").collect()
    assert len(long) == 2 and len({r.groups_sha256 for r in long}) == 1 and long[0].n_groups > 25_000
    assert alignment.align_documents(no_docs, *PATHS).collect() == []


def test_whole_texts_of_the_table(spark, sf):
    """Numbers of tokens of whole texts, however long, by the tokenizers themselves."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in alignment.op12_token_alignment(spark, sf).collect():
        a, b = plain_tokens(texts[row.doc_id])
        assert (row.n_a, row.n_b) == (len(a), len(b))
    assert public_tokenizers.path("byte_bpe_50k.json") == PATHS[0]
