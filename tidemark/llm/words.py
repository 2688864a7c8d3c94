"""Subword ids of whole texts by a word-level tokenizer: distinct chunks are merged side by side, the rest is looked up."""

from __future__ import annotations

import functools
import json
import os

import numpy as np

from tidemark.llm.common import lower_ascii, span_hashes, text_buffers, word_spans

# Words and other pieces remembered in a task, at about 50 bytes each; with more of them it starts anew.
CACHED_CHUNKS = 1_000_000
# Words of more bytes go to the library one by one.
LONGEST = 48
# Words merged side by side.
TOGETHER = 8192
# What a byte is: white space, a letter, a sign that is no part of a contraction or special token, or anything else.
SPACE, LETTER, SIGN, OTHER = range(4)
_KIND = np.full(256, OTHER, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = SPACE
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[[ord(c) for c in "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"]] = SIGN
NOTHING = 0xFFFF
NO_RANK = np.int32(1 << 30)
_SPREAD = np.uint32(2654435761)


def _byte_signs() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it prints, else one from 256 on."""
    printed = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printed else next(others)) for b in range(256)]


class _Merges:
    """A tokenizer's merges as a hash table of pairs, for many words at a time."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        if max(vocabulary.values()) >= NOTHING:
            raise ValueError("ids have to fit 16 bits")
        signs = _byte_signs()
        self.inner = np.array([vocabulary[s] for s in signs], np.uint32)
        self.last = np.array([vocabulary[s + suffix] for s in signs], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 16 | vocabulary[b] for a, b in pairs], np.uint32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.uint32)
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        # A pair of two NOTHINGs marks a free place.
        self.keys, self.ranks = np.full(size, 0xFFFFFFFF, np.uint32), np.full(size, NO_RANK, np.int32)
        for rank, (key, place) in enumerate(zip(keys.tolist(), self._places(keys).tolist(), strict=True)):
            while self.keys[place] != 0xFFFFFFFF:
                place = (place + 1) % size
            self.keys[place], self.ranks[place] = key, rank

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _SPREAD) >> np.uint32(32 - self.bits)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << np.uint32(16) | right
        places = self._places(keys)
        found = self.keys[places]
        ranks = np.where(found == keys, self.ranks[places], NO_RANK)
        other = np.nonzero((found != keys) & (found != 0xFFFFFFFF))
        while len(other[0]):
            places[other] = (places[other] + np.uint32(1)) & np.uint32(len(self.keys) - 1)
            found = self.keys[places[other]]
            ranks[other] = np.where(found == keys[other], self.ranks[places[other]], NO_RANK)
            again = (found != keys[other]) & (found != 0xFFFFFFFF)
            other = tuple(x[again] for x in other)
        return ranks

    def merge(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words ``data[start : start + size]`` in a row, and the number of ids of each word."""
        order = np.argsort(sizes, kind="stable")
        counts = np.empty(len(sizes), np.int64)
        parts = []
        for first in range(0, len(order), TOGETHER):
            mine = order[first : first + TOGETHER]
            table, counts[mine] = self._merged(data, starts[mine], sizes[mine])
            parts.append(table[table != NOTHING])
        flat = np.concatenate([np.zeros(0, np.uint32), *parts])
        begins = np.empty(len(sizes), np.int64)
        begins[order] = np.cumsum(counts[order]) - counts[order]
        return flat[ranges(begins, counts)], counts

    def _merged(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One row of ids per word, filled up with NOTHING: the leftmost pair of the lowest rank is merged in each
        row, round by round, until no row has one."""
        width, n = int(sizes[-1]), len(sizes)
        column = np.arange(width)
        octets = data[np.minimum(starts[:, None] + column, len(data) - 1)]
        ids = np.where(column < sizes[:, None], self.inner[octets], np.uint32(NOTHING))
        rows = np.arange(n)
        ids[rows, sizes - 1] = self.last[octets[rows, sizes - 1]]
        out, counts = np.full((n, width), NOTHING, np.uint32), sizes.copy()
        ids = np.concatenate([ids, np.full((n, 1), NOTHING, np.uint32)], 1)
        ranks = self.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)
            best = ranks[np.arange(len(rows)), at]
            live = best < NO_RANK
            if not live.all():
                done = ~live
                out[rows[done]] = ids[done, :width]
                rows, ids, ranks, at, best = rows[live], ids[live], ranks[live], at[live], best[live]
                if not len(rows):
                    break
            counts[rows] -= 1
            line = np.arange(len(rows))
            # What stands behind the merged pair moves up by one place.
            behind = np.minimum(np.arange(width + 1) + (np.arange(width + 1) > at[:, None]), width)
            ids = np.take_along_axis(ids, behind, 1)
            ranks = np.take_along_axis(ranks, np.minimum(behind[:, :-1], width - 1), 1)
            ids[line, at] = self.made[best]
            ranks[line, at] = self.rank(ids[line, at], ids[line, at + 1])
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.rank(ids[inner, at[inner] - 1], ids[inner, at[inner]])
        return out, counts


def ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of each ``begin .. begin + length``, in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def with_ends(ids: np.ndarray, borders: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts in a row, and the places between the texts, with ``end`` behind each text."""
    grown = borders + np.arange(len(borders))
    out = np.full(grown[-1], end, np.uint32)
    inside = np.ones(len(out), bool)
    inside[grown[1:] - 1] = False
    out[inside] = ids
    return out, grown


@functools.lru_cache(maxsize=2)
def _loaded(path: str):
    """The library's tokenizer and the merges, once per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path), _Merges(path)


def lower_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte of UTF-8 texts, and the bytes with ASCII and Latin-1 letters in lower case. The two bytes
    of a Latin-1 letter count as letters."""
    kind, low = _KIND[data], lower_ascii(data)
    first = np.flatnonzero(data[:-1] == 0xC3)
    second = data[first + 1]
    letter = (second != 0x97) & (second != 0xB7)
    kind[first[letter]] = LETTER
    kind[first[letter] + 1] = LETTER
    low[first[letter & (second < 0x9F)] + 1] += 0x20
    return kind, low


class WordTokens:
    """Encodes texts with a byte-level BPE tokenizer of the ``tokenizers`` library that drops white space, lower-cases
    and cuts words from signs, without joining across white space.

    A text is cut at ASCII white space; ids equal those of the whole text, since no normalisation or pre-token of such
    a tokenizer spans it. A chunk of letters with signs behind them is two pieces; any other chunk is one. Pieces are
    told apart by 64-bit hashes, and each distinct one is worked on once: words of ASCII and Latin-1 letters are merged
    side by side in numpy, by the tokenizer's own merges; all others go through the library. Special tokens in a text
    are found as the library finds them.
    """

    def __init__(self, path: str, cached: int = CACHED_CHUNKS):
        self.library, self.merges = _loaded(path)
        self.cached = cached
        self._forget()

    def _forget(self) -> None:
        # Hashes of known pieces in order; where the ids of each begin in ``flat``, and how many they are.
        self.hashes = np.zeros(0, np.uint64)
        self.begins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, low: np.ndarray, starts, ends, is_word) -> None:
        """Take in the ids of new pieces."""
        words, others = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        flat, of_words = self.merges.merge(low, starts[words], ends[words] - starts[words])
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts[others].tolist(), ends[others].tolist(), strict=True)]
        found = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        of_others = np.array([len(f) for f in found], np.int64)
        counts = np.concatenate([self.counts, of_words, of_others])
        begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(counts[len(self.counts) :]) - counts[len(self.counts) :]])
        every = np.concatenate([self.hashes, hashes[words], hashes[others]])
        self.flat = np.concatenate([self.flat, flat, np.array([i for f in found for i in f], np.uint32)])
        order = np.argsort(every, kind="stable")
        self.hashes, self.begins, self.counts = every[order], begins[order], counts[order]

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """The ids of an Arrow string array's texts in a row, as unsigned 32-bit integers, and the n+1 places where
        one text's ids end and the next one's begin; null is empty."""
        data, offsets = text_buffers(column)
        kind, low = lower_letters(data)
        starts, ends, borders = word_spans(data, offsets, _KIND != SPACE)
        letters, others = (np.zeros(len(kind) + 1, np.int32) for _ in range(2))
        np.cumsum(kind == LETTER, out=letters[1:])
        np.cumsum(kind == OTHER, out=others[1:])
        size = letters[ends] - letters[starts]
        plain = (size > 0) & (size <= LONGEST) & (others[ends] == others[starts]) & (letters[starts + size] - letters[starts] == size)
        middle = np.where(plain, starts + size, ends)
        # Up to two pieces of each chunk; the second is often empty and left out.
        begin, end = np.stack([starts, middle], 1).ravel(), np.stack([middle, ends], 1).ravel()
        used = end > begin
        pieces = np.concatenate([[0], np.cumsum(used)])[2 * borders]
        begin, end = begin[used], end[used]
        first = np.stack([plain, np.zeros(len(plain), bool)], 1).ravel()[used]
        odd = np.stack([~plain, np.zeros(len(plain), bool)], 1).ravel()[used]
        hashes = span_hashes(low, begin, end)
        if odd.any():
            # Upper case tells special tokens, so these pieces are told apart by their bytes as they came.
            hashes[odd] ^= span_hashes(data, begin[odd], end[odd]) >> np.uint64(1)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) + len(distinct) > self.cached:
            self._forget()
        new = np.ones(len(distinct), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)] != distinct
        if new.any():
            mine = at[new]
            self._learn(distinct[new], data, low, begin[mine], end[mine], first[mine])
        entry = np.searchsorted(self.hashes, distinct)[which]
        counts = self.counts[entry]
        places = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[ranges(self.begins[entry], counts)], places[pieces]
