"""Alignment of the tokens that two tokenizers make of the same text.

Both tokenizers cut the same bytes, so a text is two ascending lists of byte
ends. The shorter list drives: each of its ends gallops from the place of the
one before it, in doubling steps and then by halves, into the longer list. Ends
found in both cut the tokens into groups; the difference of the places of two
neighbouring ends is the range of tokens that a token overlaps.

Counts of linked id pairs over all documents are summed in the tasks first. The
most frequent pairs (``HEAD_PAIRS``, a bound) go to all tasks; links of all others
find their counts by a join. Tokens are made once and staged as pairs.

Handling: a text that is null, empty, or not given back byte by byte by both
tokenizers has no tokens: zeros and an empty digest. Rows that repeat, also with
the same or a null doc_id, are documents of their own, and count as such.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import stage, table
from tidemart.llm.encoding import ALPHABET, BYTE_OF, gather, group_ends, token_bytes

LANE = 64
HEAD_PAIRS = 1 << 18
GROUP_BYTES = 1 << 22
COUNT_LINKS = 1 << 22

# Unicode white space, as the first tokenizer's rule for words sees it.
SPACE = " \t-\r\u0085   -     　"
SPACES = frozenset(c for c in map(chr, range(0x3001)) if re.match(f"[{SPACE}]", c))
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+(?:[{SPACE}]+\\Z)?|[{SPACE}]+")
INNER_SPACE = re.compile(f"[^{SPACE}][{SPACE}]")
BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class ByteTokens:
    """The byte-level vocabulary: ids of chunks, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        tokens = [ALPHABET[b] for b in range(256)] + [
            "".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        tokens = list(dict.fromkeys(tokens))
        self.ids = np.array([vocabulary[t] for t in tokens], np.int64)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = token_bytes(token) if BYTE_OF.keys() >= set(token) else token.encode()
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        ranks = {token_bytes(t): k for k, t in enumerate(tokens)}
        self.merges = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def chunks(self, chunks: list[str], n_joined: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks, end to end, and where each ends (from 0).

        The first ``n_joined`` begin with white space and end with other text,
        so they can be encoded as one text.
        """
        joined = self.ids[np.array(self.merges.encode_ordinary("".join(chunks[:n_joined])), np.int64)]
        stops = np.cumsum([0, *map(len, map(str.encode, chunks[:n_joined]))])
        ends = np.searchsorted(np.cumsum(self.sizes[joined]), stops[1:]) + 1
        others, other_ends = flat_of([self.ids[self.merges.encode_ordinary(c)] for c in chunks[n_joined:]])
        return np.concatenate([joined, others]), np.concatenate([[0], ends, len(joined) + other_ends[1:]])


class PieceTokens:
    """The vocabulary of pieces, which puts a space before a text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(len(self.model))]
        plain = [p.replace("▁", " ") for p in pieces]
        # A piece may join these to the text before them; elsewhere merges never cross from text to space.
        self.joining = "".join({m[0][1] for p in plain for m in INNER_SPACE.finditer(p)})
        self.bytes = [bytes([int(m[1], 16)]) if (m := BYTE_PIECE.fullmatch(p)) else p.encode() for p in plain]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.space = self.model.piece_to_id("▁")

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.int64)

    def chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
        """Ids of the chunks, where each ends (from 0), and the chunks that only the whole text can tell."""
        found = self.model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        apart = []
        for i, chunk in enumerate(chunks):
            if chunk[0] != " ":  # the space put before it is not the text's own
                if not found[i] or found[i][0] != self.space:
                    apart.append(i)
                found[i] = found[i][1:]
        ends = np.cumsum([0, *map(len, found)])
        return np.fromiter(chain.from_iterable(found), np.int64, ends[-1]), ends, apart


@dataclass(frozen=True)
class Tokens:
    """Ids of both tokenizers for a group of texts, end to end, and where each text ends (from 0)."""

    a: np.ndarray
    a_ends: np.ndarray
    b: np.ndarray
    b_ends: np.ndarray

    def of(self, which: np.ndarray) -> Tokens:
        return Tokens(*gather(self.a, self.a_ends, which), *gather(self.b, self.b_ends, which))


def flat_of(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int64)
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.int64)), ends


@lru_cache(maxsize=2)
def both(first: str, second: str) -> Both:
    return Both(first, second)


class Both:
    """The two tokenizers together."""

    def __init__(self, first: str, second: str) -> None:
        self.one, self.two = ByteTokens(first), PieceTokens(second)
        self.sizes = [self.one.sizes, self.two.sizes]
        self.digits = [decimals(len(t.bytes)) for t in (self.one, self.two)]
        # Texts with these are encoded whole.
        self.whole_only = re.compile(f"[{re.escape(self.two.joining)}]") if self.two.joining else None

    def tokens(self, texts: list[str | None]) -> Tokens:
        """Ids of each text; none of either if the bytes differ.

        Either tokenizer cuts before white space that follows other text, so
        distinct chunks are encoded once for the group.
        """
        whole = {i for i, t in enumerate(texts) if t and self.whole_only and self.whole_only.search(t)}
        per_text = [CHUNK.findall(" " + t) if t and i not in whole else [] for i, t in enumerate(texts)]
        sizes = np.array([len(x) for x in per_text], np.int64)
        coded = pa.array(chain.from_iterable(per_text), pa.string()).dictionary_encode()
        del per_text
        chunks = coded.dictionary.to_pylist()
        ends_in_space = np.array([c[-1] in SPACES for c in chunks], bool)
        order = np.argsort(ends_in_space, kind="stable")
        chunks = [chunks[k] for k in order.tolist()]
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        which = place[coded.indices.to_numpy()]
        a, a_ends = self.one.chunks(chunks, len(chunks) - int(ends_in_space.sum()))
        b, b_ends, apart = self.two.chunks(chunks)
        wrong = self.wrong(chunks, a, a_ends, b, b_ends)
        cuts = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for flat, starts in ((a, a_ends), (b, b_ends)):
            ids, ends = gather(flat, starts, which)
            out += [ids, ends[cuts]]
        result = Tokens(*out)
        if not (whole or wrong or apart):
            return result
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        of_chunks = lambda some: set(text_of[np.isin(which, list(some))].tolist())
        whole |= of_chunks(apart)
        none = np.zeros(0, np.int64)
        parts_a, parts_b = np.split(result.a, result.a_ends[1:-1]), np.split(result.b, result.b_ends[1:-1])
        for i in of_chunks(wrong.difference(apart)):
            parts_a[i] = parts_b[i] = none
        for i in whole:
            raw = b" " + texts[i].encode()
            parts_a[i], _ = self.one.chunks([" " + texts[i]], 0)
            parts_b[i] = self.two.whole(texts[i])
            if not (self.same(self.one, parts_a[i], raw) and self.same(self.two, parts_b[i], raw)):
                parts_a[i] = parts_b[i] = none
        return Tokens(*flat_of(parts_a), *flat_of(parts_b))

    def wrong(self, chunks: list[str], a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> set[int]:
        """Numbers of the chunks whose bytes either tokenizer does not give back."""
        raw = [c.encode() for c in chunks]
        text, sizes = b"".join(raw), np.array([len(c) for c in raw], np.int64)
        found: set[int] = set()
        for tokens, ids, ends in ((self.one, a, a_ends), (self.two, b, b_ends)):
            if self.same(tokens, ids, text) and (run_sums(tokens.sizes[ids], ends) == sizes).all():
                continue
            cuts = ends.tolist()
            found |= {k for k, c in enumerate(raw) if not self.same(tokens, ids[cuts[k]:cuts[k + 1]], c)}
        return found

    @staticmethod
    def same(tokens: ByteTokens | PieceTokens, ids: np.ndarray, text: bytes) -> bool:
        return b"".join(map(tokens.bytes.__getitem__, ids.tolist())) == text


def decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of the numbers below n, left in rows of one width, and how many they are."""
    text = np.arange(n).astype("S")
    width = text.dtype.itemsize
    return text.view(np.uint8).reshape(n, width), np.char.str_len(text)


def lower_bounds(longer: np.ndarray, start: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first place at or after ``start`` whose value is not less than wanted: doubling steps, then halves.

    ``longer`` ends with a value that is larger than any wanted.
    """
    low, high = start.copy(), start.copy()
    step = 1
    open_rows = np.flatnonzero(longer[high] < wanted)
    while len(open_rows):
        low[open_rows] = high[open_rows] + 1
        high[open_rows] = np.minimum(high[open_rows] + step, len(longer) - 1)
        step *= 2
        open_rows = open_rows[longer[high[open_rows]] < wanted[open_rows]]
    open_rows = np.flatnonzero(low < high)
    while len(open_rows):
        middle = (low[open_rows] + high[open_rows]) >> 1
        less = longer[middle] < wanted[open_rows]
        low[open_rows[less]] = middle[less] + 1
        high[open_rows[~less]] = middle[~less]
        open_rows = open_rows[low[open_rows] < high[open_rows]]
    return low


def gallop(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each value of one ascending list how many of the other are less.

    The list is cut into lanes of ``LANE`` values that move on together; every
    value starts where the one before it has ended.
    """
    n = len(shorter)
    if not n:
        return np.zeros(0, np.int64)
    longer = np.append(longer, np.iinfo(np.int64).max)
    lanes = -(-n // LANE)
    grid = np.append(shorter, np.full(lanes * LANE - n, shorter[-1])).reshape(lanes, LANE)
    out = np.empty((lanes, LANE), np.int64)
    at = np.zeros(lanes, np.int64)
    for k in range(LANE):
        at = out[:, k] = lower_bounds(longer, at, grid[:, k])
    return out.reshape(-1)[:n]


@dataclass(frozen=True)
class Aligned:
    """Of two lists of tokens: which ends are common, and the first and last token of the longer that each of the shorter overlaps."""

    common: np.ndarray
    first: np.ndarray
    last: np.ndarray


def align(shorter: np.ndarray, longer: np.ndarray) -> Aligned:
    """Both lists of byte ends are ascending and have the same last value."""
    last = gallop(shorter, longer)
    common = longer[last] == shorter if len(shorter) else np.zeros(0, bool)
    # Where the next token begins, its first partner does too, unless the end lies within one.
    first = np.concatenate([[0], (last + common)[:-1]]) if len(shorter) else last
    return Aligned(common, first, last)


def run_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends[1:]] - total[ends[:-1]]


def linked(tools: Both, tokens: Tokens) -> dict[str, list | np.ndarray]:
    """Of every text of a group: numbers of groups and links, the digest, and its id pairs with their links."""
    n = len(tokens.a_ends) - 1
    out = {"n_a": np.diff(tokens.a_ends), "n_b": np.diff(tokens.b_ends), "n_groups": np.zeros(n, np.int64),
           "n_links": np.zeros(n, np.int64), "groups_sha256": [""] * n, "pairs": [None] * n}
    for swapped in (False, True):
        which = np.flatnonzero((out["n_a"] > out["n_b"]) == swapped)
        which = which[out["n_a"][which] > 0]
        if not len(which):
            continue
        mine = tokens.of(which)
        a_stops, b_stops = np.cumsum(tools.sizes[0][mine.a]), np.cumsum(tools.sizes[1][mine.b])
        found = align(b_stops, a_stops) if swapped else align(a_stops, b_stops)
        text_ends = mine.b_ends if swapped else mine.a_ends
        links = found.last - found.first + 1
        out["n_groups"][which] = run_sums(found.common, text_ends)
        out["n_links"][which] = run_sums(links, text_ends)
        short = np.repeat(np.arange(len(links)), links)
        before = np.cumsum(links) - links
        long = np.arange(len(short)) + (found.first - before)[short]
        a, b = (mine.a[long], mine.b[short]) if swapped else (mine.a[short], mine.b[long])
        text_of = np.repeat(np.arange(len(which)), run_sums(links, text_ends))
        for i, pairs in zip(which.tolist(), distinct(text_of, a * len(tools.two.bytes) + b, len(which))):
            out["pairs"][i] = pairs
        other = np.zeros(len(a_stops) if swapped else len(b_stops), bool)
        other[found.last[found.common]] = True
        commons = (other, found.common) if swapped else (found.common, other)
        for i, digest in zip(which.tolist(), digests(tools, mine, *commons)):
            out["groups_sha256"][i] = digest
    return out


def distinct(text_of: np.ndarray, codes: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, links of each) of every text, pairs ascending."""
    order = np.lexsort((codes, text_of))
    codes, text_of = codes[order], text_of[order]
    new = np.concatenate([[True], (codes[1:] != codes[:-1]) | (text_of[1:] != text_of[:-1])])
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(codes)))
    cuts = np.searchsorted(text_of[at], np.arange(n + 1))
    for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield codes[at[low:high]], times[low:high]


def digests(tools: Both, tokens: Tokens, a_common: np.ndarray, b_common: np.ndarray) -> Iterator[str]:
    """SHA-256 of every text's groups, as ``a1,a2|b1;a3|b2,b3``."""
    a_last, b_last = np.flatnonzero(a_common), np.flatnonzero(b_common)
    a_group, b_group = np.cumsum(a_common) - a_common, np.cumsum(b_common) - b_common
    # A group's first ids come after those of all groups before, its second ones after its first.
    a_at = np.arange(len(a_group)) + np.concatenate([[0], b_last + 1])[a_group]
    b_at = np.arange(len(b_group)) + a_last[b_group] + 1
    wide = max(d.shape[1] for d, _ in tools.digits)
    n = len(a_at) + len(b_at)
    letters, sizes = np.zeros((n, wide + 1), np.uint8), np.empty(n, np.int64)
    for at, ids, common, (digits, lengths), sign in ((a_at, tokens.a, a_common, tools.digits[0], b"|"),
                                                    (b_at, tokens.b, b_common, tools.digits[1], b";")):
        letters[at, :digits.shape[1]] = digits[ids]
        sizes[at] = lengths[ids]
        letters[at, lengths[ids]] = np.where(common, ord(sign), ord(","))
    stops = tokens.a_ends[1:] + tokens.b_ends[1:]
    sizes += 1
    sizes[stops - 1] -= 1  # no sign after a text's last id
    text = letters[np.arange(wide + 1) < sizes[:, None]].tobytes()
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], stops])].tolist()
    for low, high in zip(ends[:-1], ends[1:]):
        yield hashlib.sha256(text[low:high]).hexdigest()


def pack_pairs(squeeze, pairs: tuple[np.ndarray, np.ndarray] | None) -> bytes:
    if pairs is None:
        return b""
    return squeeze.compress(np.diff(pairs[0], prepend=0).astype("<u8").tobytes() + pairs[1].astype("<u4").tobytes())


def unpack_pairs(loose, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    whole = loose.decompress(data) if data else b""
    n = len(whole) // 12
    return np.cumsum(np.frombuffer(whole, "<u8", n)).astype(np.int64), np.frombuffer(whole, "<u4", n, 8 * n).astype(np.int64)


ROWS = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
NAMES = [part.split()[0] for part in ROWS.split(", ")]


def aligned_documents(docs: DataFrame, first: str, second: str, id_column: str = "doc_id",
                      text_column: str = "text") -> DataFrame:
    """Staged: one row per document with its numbers, digest and packed id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tools = both(first, second)
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            begin = 0
            for end in group_ends(batch.column(2), GROUP_BYTES):
                part = batch.slice(begin, end - begin)
                begin = end
                found = linked(tools, tools.tokens(part.column(2).to_pylist()))
                found["pairs"] = [pack_pairs(squeeze, p) for p in found["pairs"]]
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], *(pa.array(found[c], k) for c, k in zip(NAMES[2:], kinds))], NAMES)

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       F.col(text_column).alias("text"))
    return stage(rows.mapInArrow(run, ROWS), "aligned", compression="zstd")


def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, n): the documents of a task that hold each pair."""
    import zstandard

    loose = zstandard.ZstdDecompressor()
    waiting: list[np.ndarray] = []
    held = 0

    def out() -> pa.RecordBatch:
        codes, n = np.unique(np.concatenate(waiting) if waiting else np.zeros(0, np.int64), return_counts=True)
        waiting.clear()
        return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64))], ["code", "n"])

    for batch in batches:
        for data in batch.column(0):
            waiting.append(unpack_pairs(loose, data.as_py())[0])
            held += len(waiting[-1])
            if held >= COUNT_LINKS:
                yield out()
                held = 0
    yield out()


SCORED = "doc_id long, row long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def align_documents(docs: DataFrame, first: str, second: str, id_column: str = "doc_id", text_column: str = "text",
                    head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256, a row for each row of ``docs``."""
    found = aligned_documents(docs, first, second, id_column, text_column)
    size = len(both(first, second).two.bytes)
    counts = found.select("pairs").mapInArrow(count_pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = stage(counts.withColumn("a", F.floor(F.col("code") / size).cast("long")), "counts")
    # One row for each id of the first vocabulary at most.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("n").alias("most")))
    counts = stage(counts.join(highest, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")
    head = counts.orderBy(F.desc("n"), "code").limit(head_pairs).toArrow().sort_by("code")
    codes, n, best = (head.column(c).to_numpy().astype(np.int64) for c in ("code", "n", "best"))

    def places(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(codes, mine), max(0, len(codes) - 1))
        return at, codes[at] == mine if len(codes) else np.zeros(len(mine), bool)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        loose = zstandard.ZstdDecompressor()
        for batch in batches:
            n_best, sums = [], []
            for data in batch.column(7):
                mine, times = unpack_pairs(loose, data.as_py())
                at, known = places(mine)
                at, times = at[known], times[known]
                n_best.append(int((best[at] * times).sum()))
                sums.append(int((n[at] * times).sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), batch.column(6)],
                [part.split()[0] for part in SCORED.split(", ")])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        loose = zstandard.ZstdDecompressor()
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine, times = unpack_pairs(loose, data.as_py())
                _, known = places(mine)
                if not known.all():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full((~known).sum(), row, np.int64)), pa.array(mine[~known]), pa.array(times[~known])],
                        ["row", "code", "times"])

    left = found.select("row", "pairs").mapInArrow(rare, "row long, code long, times long").join(counts, "code")
    more = left.groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("more_sum"),
                                   F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    known = found.mapInArrow(score, SCORED)
    return known.join(more, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_documents(table(spark, folder, "documents"), *default_vocabularies())
