"""Byte-level BPE by rank files: encoding with segment trees over byte positions, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_small_batches, slices, tidy

SLICE_BYTES = 4 << 20
# Text chunks and pattern matches remembered in a task; later ones are encoded each time they come.
CACHED_CHUNKS = 700_000
# Matches up to this many bytes are merged together as rows of arrays, longer ones each by themselves.
ROW_BYTES = 64


class Ranks:
    """A rank file: tokens by id, and the rank of every pair of tokens that a merge may join."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ids = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ids = ids
        self.tokens = {i: token for token, i in ids.items()}
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        self.none = max(ids.values()) + 1
        pairs = {}
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        # The last entry stands for pairs beyond all keys; it matches none of them.
        self.keys = np.append(keys, np.int64(-1))
        self.values = np.array([*(pairs[k] for k in keys.tolist()), self.none], np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``none`` where it is no token or one side is missing (-1)."""
        key = left << 32 | right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.values[at], self.none)


def merge_rows(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """Ids of short matches, all merged side by side: one segment tree a row.

    Leaf p holds rank * width + p of the pair that starts at byte p, so the root is the leftmost pair of least
    rank. A merge changes three leaves, those of the joined token, its left neighbour and the token that is gone,
    and each change climbs the tree by logarithmically many levels.
    """
    count = len(words)
    size = np.array([len(w) for w in words])
    width = 1 << max(1, int(size.max() - 1).bit_length())
    byte = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(count, width)
    column = np.arange(width)
    token = np.where(column < size[:, None], ranks.single[byte], -1)
    follow = np.where(column + 1 < size[:, None], column + 1, -1) * np.ones((count, 1), np.int64)
    before = (column - 1) * np.ones((count, 1), np.int64)
    none = ranks.none * width
    tree = np.full((count, 2 * width), none, np.int64)
    pair = ranks.of(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(count, width - 1)
    tree[:, width : 2 * width - 1] = np.where(pair < ranks.none, pair * width + column[:-1], none)
    level = width
    while level > 1:
        half = level // 2
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half

    def climb(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + width
        tree[row, node] = value
        while node[0] > 1:
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    row = np.flatnonzero(tree[:, 1] < none)
    while len(row):
        rank, at = np.divmod(tree[row, 1], width)
        gone = follow[row, at]
        after = follow[row, gone]
        token[row, at] = rank
        token[row, gone] = -1
        follow[row, at] = after
        has = after >= 0
        before[row[has], after[has]] = at[has]
        climb(row, gone, np.full(len(row), none))
        right = ranks.of(token[row, at], np.where(has, token[row, after], -1))
        climb(row, at, np.where(right < ranks.none, right * width + at, none))
        left = before[row, at]
        some = left >= 0
        if some.any():
            r, p = row[some], left[some]
            value = ranks.of(token[r, p], token[r, at[some]])
            climb(r, p, np.where(value < ranks.none, value * width + p, none))
        row = row[tree[row, 1] < none]
    live = token >= 0
    flat = token[live].astype("<u4").tobytes()
    ends = np.cumsum(live.sum(1)).tolist()
    return [flat[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def merge_long(ranks: Ranks, word: bytes) -> bytes:
    """Ids of one match of any length by the same tree, node by node."""
    n = len(word)
    width = 1 << max(1, (n - 1).bit_length())
    none = ranks.none * width
    rank_of, missing = ranks.pairs.get, ranks.none
    token = ranks.single[np.frombuffer(word, np.uint8)].tolist()
    follow, before = [*range(1, n), -1], list(range(-1, n - 1))
    tree = [none] * (2 * width)
    for p in range(n - 1):
        rank = rank_of(token[p] << 32 | token[p + 1], missing)
        tree[width + p] = rank * width + p if rank < missing else none
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def climb(leaf: int, value: int) -> None:
        node = leaf + width
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    def pair(p: int) -> int:
        q = follow[p]
        rank = rank_of(token[p] << 32 | token[q], missing) if q >= 0 else missing
        return rank * width + p if rank < missing else none

    while tree[1] < none:
        rank, at = divmod(tree[1], width)
        gone = follow[at]
        after = follow[gone]
        token[at], token[gone], follow[at] = rank, -1, after
        if after >= 0:
            before[after] = at
        climb(gone, none)
        climb(at, pair(at))
        if before[at] >= 0:
            climb(before[at], pair(before[at]))
    return np.array([t for t in token if t >= 0], "<u4").tobytes()


class Encoder:
    """Encodes texts as the rank file and the splitting pattern say; remembers what it has seen in this task."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = Ranks(path)
        self.split = regex.compile(pattern).findall
        # A cut before a space is safe unless white space stands on both sides of that space.
        self.unsafe = regex.compile(r"\s (?:\s|$)").search
        self.matches: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _chunks(self, text: str) -> list[str]:
        """Parts that the pattern splits alike alone and in the text."""
        if self.unsafe(text):
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + part for part in rest]]

    def _merge(self, words: list[str]) -> dict[str, bytes]:
        raw = [w.encode() for w in words]
        out: dict[str, bytes] = {}
        by_width: dict[int, list[int]] = {}
        for i, b in enumerate(raw):
            if len(b) > ROW_BYTES:
                out[words[i]] = merge_long(self.ranks, b)
            else:
                by_width.setdefault(max(1, (len(b) - 1).bit_length()), []).append(i)
        for members in by_width.values():
            for start in range(0, len(members), 20_000):
                block = members[start : start + 20_000]
                out.update(zip([words[i] for i in block], merge_rows(self.ranks, [raw[i] for i in block]), strict=True))
        return out

    def _learn(self, chunks: set[str]) -> dict[str, bytes]:
        parts = {c: self.split(c) for c in chunks}
        known = self.matches
        fresh = self._merge(list({m for ms in parts.values() for m in ms if m not in known}))
        out = {c: b"".join([known[m] if m in known else fresh[m] for m in ms]) for c, ms in parts.items()}
        if len(known) < CACHED_CHUNKS:
            known.update(fresh)
        if len(self.chunks) < CACHED_CHUNKS:
            self.chunks.update(out)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        cut = [self._chunks(t) if t else [] for t in texts]
        known = self.chunks
        new = {c for chunks in cut for c in chunks if c not in known}
        fresh = self._learn(new) if new else {}
        return [b"".join([known[c] if c in known else fresh[c] for c in chunks]) for chunks in cut]

    def decode(self, ids: bytes) -> bytes:
        tokens = self.ranks.tokens
        return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def encode_and_decode(
    docs: DataFrame, ranks: str, pattern: str, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """Per row: n_tokens, ids_sha256 of the ids, decoded_sha256 of the bytes decoded from them and, with ``with_ids``,
    the ids themselves and the decoded bytes.

    Each match of ``pattern`` is encoded by itself, without special tokens. Null or empty text: no ids. Null and
    repeated keys: row by row. No rows: no rows. Other columns are not read, whatever their names. Very long texts
    and matches take time in proportion to length times its logarithm.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encoder = Encoder(ranks, pattern)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                encoded = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                counts, hashes, decoded_hashes, decoded = [], [], [], []
                for ids in encoded:
                    back = encoder.decode(ids)
                    counts.append(len(ids) // 4)
                    hashes.append(hashlib.sha256(ids).hexdigest())
                    decoded_hashes.append(hashlib.sha256(back).hexdigest())
                    if with_ids:
                        decoded.append(back)
                columns = [part.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded_hashes, pa.string())]
                if with_ids:
                    flat = np.frombuffer(b"".join(encoded), "<u4").astype(np.int32)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                    columns += [pa.ListArray.from_arrays(offsets, pa.array(flat)), pa.array(decoded, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return in_small_batches(docs).select(F.col(key).alias(key), F.col(text).cast("string").alias("_text")).mapInArrow(tidy(run), T.StructType(fields))
