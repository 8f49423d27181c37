"""Token ids of whole texts by public tokenizers, a bounded group of texts at a time.

The words of a group are split and numbered by Arrow, only distinct ones go
through a tokenizer, and the ids are put together with numpy. Nothing is kept
between groups, so memory follows the size of a group (or of one long text).
"""

from __future__ import annotations

import json
import string
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20

# How byte-level vocabularies write the 256 bytes as characters.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
HIDDEN = [b for b in range(256) if b not in set(SHOWN)]
ALPHABET = {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(HIDDEN)}
BYTE_OF = {c: b for b, c in ALPHABET.items()}


def token_bytes(token: str) -> bytes:
    """The bytes that an entry of a byte-level vocabulary stands for."""
    return bytes(map(BYTE_OF.__getitem__, token))


def group_ends(texts: pa.Array, limit: int = GROUP_BYTES) -> list[int]:
    """Where to cut an array of texts so that a group has about ``limit`` bytes, or is one longer text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes)
    ends, begin = [], 0
    while begin < len(sizes):
        done = total[begin - 1] if begin else 0
        begin = max(begin + 1, int(np.searchsorted(total, done + limit, side="right")))
        ends.append(begin)
    return ends


def gather(flat: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``flat[starts[k]:starts[k + 1]]`` for every k of ``which``, end to end, and where each ends (from 0)."""
    begin = starts[which]
    sizes = starts[which + 1] - begin
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kind = np.int32 if max(ends[-1], len(flat)) < 1 << 31 else np.int64
    at = np.repeat((begin - ends[:-1]).astype(kind), sizes)
    at += np.arange(ends[-1], dtype=kind)
    return flat[at], ends


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class WordEncoder:
    """Ids of the tokenizer of words with ends.

    It never joins anything across white space, so the ids of a text are those
    of its words one after the other. Distinct words of a group go through the
    merges in one call, as parts with an end mark: a byte that no word holds,
    which the first merges join with the last letter. Words that normalization
    may change, and texts with special tokens, go through the whole tokenizer.
    """

    MARK = b" "

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            ends = token.endswith(suffix)
            return token_bytes(token[:-len(suffix)] if ends else token) + (self.MARK if ends else b"")

        tokens = [ALPHABET[b] for b in range(256)] + [ALPHABET[b] + suffix for b in range(256)]
        for merge in model["merges"]:
            tokens.append("".join(merge.split(" ") if isinstance(merge, str) else merge))
        ranks: dict[bytes, int] = {}
        for token in tokens:
            ranks.setdefault(raw(token), len(ranks))
        ids = {raw(token): vocabulary[token] for token in reversed(tokens)}
        self.id_of_rank = np.array([ids[key] for key in ranks], np.uint32)
        self.ends = np.array([key.endswith(self.MARK) and len(key) > 1 for key in ranks])
        self.merges = tiktoken.Encoding("parts", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        # The tokenizer's own rule for parts of a word.
        self.parts = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        # No white space or combining mark below U+0250 but for these; U+0130 has two-letter lower case.
        self.odd = regex.compile("[^!-~\n\u00a1-\u012f\u0131-\u024f]").search

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def by_whole(self, text: str) -> np.ndarray:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, end to end, and where each ends (from 0)."""
        joined = "\n".join(words)
        some_odd = self.odd(joined) is not None
        parts: list[str] = []
        last = np.zeros(len(words), np.int64)  # parts up to and with the word's
        others: dict[int, np.ndarray] = {}
        for i, (word, low) in enumerate(zip(words, joined.lower().split("\n") if not some_odd else words)):
            if some_odd and self.odd(word):
                others[i] = self.by_whole(word)
            elif word:
                low = low.lower() if some_odd else low
                if low.isalpha():
                    parts.append(low)
                else:
                    stem = low.rstrip(string.punctuation)
                    if not stem:
                        parts.append(low)
                    elif stem.isalpha():
                        parts.append(stem)
                        parts.append(low[len(stem):])
                    else:
                        parts.extend(self.parts(low))
            last[i] = len(parts)
        ranks = np.array(self.merges.encode_ordinary(" ".join(parts) + " ") if parts else [], np.int64)
        part_stops = np.concatenate([[0], np.flatnonzero(self.ends[ranks]) + 1])
        ids, ends = self.id_of_rank[ranks], np.concatenate([[0], part_stops[last]])
        if others:
            each = np.split(ids, ends[1:-1])
            for i, found in others.items():
                each[i] = found
            ids, ends = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        return ids, ends

    def group(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, end to end, and where each ends (from 0). A null text is empty."""
        texts = pc.fill_null(texts, "")
        # The tokenizer lowers letters itself, but not in its special tokens.
        special = pc.match_substring(texts, "<|")
        marked = pc.any(special).as_py()
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.if_else(special, "", texts) if marked else texts))
        coded = pc.dictionary_encode(lists.flatten())
        flat, starts = self.words(coded.dictionary.to_pylist())
        ids, word_ends = gather(flat, starts, coded.indices.to_numpy().astype(np.int64))
        cuts = lists.offsets.to_numpy().astype(np.int64)
        ends = word_ends[cuts - cuts[0]]
        if marked:
            each = np.split(ids, ends[1:-1])
            for i in np.flatnonzero(special.to_numpy(zero_copy_only=False)):
                each[i] = self.by_whole(texts[int(i)].as_py())
            ids, ends = np.concatenate(each), np.concatenate([[0], np.cumsum([len(x) for x in each])])
        return ids, ends

    def batch(self, texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(number of the first text, ids, ends) of every group of an array."""
        begin = 0
        for end in group_ends(texts, limit):
            yield begin, *self.group(texts.slice(begin, end - begin))
            begin = end
            pa.default_memory_pool().release_unused()
