"""Repeated passages: exact removal of byte strings that also start in an earlier document.

A distributed merge sort of suffixes. Texts give suffixes only at anchors that every sufficiently long common string
must contain and that stand in two different texts; each task sorts its own into a run, front-codes it (shared prefix
length and the rest) and deals it to key ranges; a range merges its runs with a loser tree that knows the common
prefix of every contender with the last winner and so never compares those bytes again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    in_small_batches,
    mix,
    saved,
    slices,
    spread,
    text_buffers,
    text_or_empty,
    texts_by_hash,
    tidy,
)

LENGTH = 50
# An anchor is a string of so many bytes; each LENGTH bytes hold one whose hash is the least of theirs.
GRAM = 24
SPAN = LENGTH - GRAM + 1
LEFT = LENGTH - GRAM
# A suffix as it is sorted: LENGTH bytes from the anchor on, LEFT bytes before it backwards, and how many of each exist.
ITEM = LENGTH + LEFT + 2
SLICE_BYTES = 2 << 20
# Text in MB for each group of anchor hashes, and for each key range of suffixes.
HASH_GROUP_MB, RANGE_MB = 16, 8
# Anchors looked at to lay the borders of the key ranges; they set the balance, never the result.
SAMPLE_TEXTS = 400
_ROW = ("id", "d1", "d2")


# ---------------------------------------------------------------- anchors


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    have = 1
    while 2 * have <= width:
        values = pick(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and 64-bit hash of every anchor: gram positions whose hash is the least in some LENGTH bytes of one text.

    Which grams of a string are chosen depends on that string alone, so equal strings share their anchors.
    """
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = np.zeros(n - GRAM + 1, np.uint64)
    wide = data.astype(np.uint64)
    # Eight bytes to a word, three words to a gram.
    word = np.zeros(n - 7, np.uint64)
    for i in range(8):
        word |= wide[i : n - 7 + i] << np.uint64(8 * i)
    for i in range(0, GRAM, 8):
        hashes ^= word[i : i + len(hashes)]
        hashes *= np.uint64(0x9E3779B97F4A7C15)
        hashes ^= hashes >> np.uint64(32)
    hashes = mix(hashes)
    order = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    least = _sliding(order, SPAN, np.minimum)
    # Strings that would reach into the next text choose nothing.
    size = np.diff(offsets)
    end = np.repeat(offsets[1:], size)[: len(least)]
    least[np.arange(len(least)) + LENGTH > end] = 0
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint32), least, np.zeros(SPAN - 1, np.uint32)])
    chosen = np.flatnonzero(_sliding(padded, SPAN, np.maximum)[: len(order)] == order)
    return chosen, hashes[chosen]


def _groups_of(hashes: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The low 48 bits of each hash and the group these belong to."""
    low = hashes & np.uint64((1 << 48) - 1)
    return low, ((low >> np.uint64(16)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def _blob(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string of bytes."""
    import pickle

    import zstandard

    return zstandard.compress(pickle.dumps([np.ascontiguousarray(a) for a in arrays], protocol=5), 1)


def _arrays(blob: bytes) -> list[np.ndarray]:
    import pickle

    import zstandard

    return pickle.loads(zstandard.decompress(blob))


def _slice_number(count: int) -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 24 | count


def _batch(columns: list, names: list[str]):
    import pyarrow as pa

    kinds = {"part": pa.int64(), "run": pa.int64(), "blob": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for c, n in zip(columns, names, strict=True)], names=names)


def _shared_anchors(rows: DataFrame, groups: int) -> DataFrame:
    """For each row key, one bit for each of its anchors: whether the gram also stands in a different text.

    Only 48-bit hashes travel, by hash group, and only bits come back, by slice of texts. Equal texts count as one.
    """

    def hashed(batches: Iterator) -> Iterator:
        count = 0
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=3):
                run = _slice_number(count)
                count += 1
                data, offsets = text_buffers(part.column(3))
                place, hashes = anchors(data, offsets)
                low, group = _groups_of(hashes, groups)
                row = np.searchsorted(offsets, place, side="right") - 1
                keys = [np.array(part.column(i).to_pylist(), np.int64) for i in range(3)]
                parts, blobs = [-1 - run], [_blob(*keys)]
                order = np.argsort(group, kind="stable")
                ranked = group[order]
                for g in np.unique(group).tolist():
                    mine = order[np.searchsorted(ranked, g) : np.searchsorted(ranked, g, side="right")]
                    # Only rows with an anchor in the group, so blocks stay small however many groups there are.
                    there, times = np.unique(row[mine], return_counts=True)
                    value = low[mine]
                    halves = (value >> np.uint64(16)).astype(np.uint32), value.astype(np.uint16)
                    parts.append(g)
                    blobs.append(_blob(there.astype(np.uint32), times.astype(np.uint32), keys[1][there], *halves))
                yield _batch([parts, [run] * len(parts), blobs], ["part", "run", "blob"])

    def meet(group):
        import pandas as pd

        if group["part"].iloc[0] < 0:
            return group
        blocks = [_arrays(b) for b in group["blob"]]
        value = np.concatenate([b[3].astype(np.uint64) << np.uint64(16) | b[4] for b in blocks])
        text = np.concatenate([np.repeat(b[2], b[1]) for b in blocks])
        order = np.argsort(value, kind="stable")
        new = np.r_[True, value[order][1:] != value[order][:-1]]
        of = np.cumsum(new) - 1
        other = text[order] != text[order][new][of]
        shared = np.zeros(len(value), bool)
        shared[order] = (np.bincount(of, weights=other) > 0)[of]
        ends = np.cumsum([len(b[3]) for b in blocks])
        blobs = [_blob(b[0], b[1], shared[e - len(b[3]) : e]) for b, e in zip(blocks, ends, strict=True)]
        return pd.DataFrame({"part": group["part"], "run": group["run"], "blob": blobs})

    def gather(group):
        import pandas as pd

        group = group.sort_values("part")
        keys = _arrays(group["blob"].iloc[0])
        blocks = [_arrays(b) for b in group["blob"].iloc[1:]]
        n = len(keys[0])
        row = np.concatenate([np.repeat(b[0], b[1]) for b in blocks] or [np.zeros(0, np.int64)])
        bits = np.concatenate([b[2] for b in blocks] or [np.zeros(0, bool)])
        order = np.argsort(row, kind="stable")
        borders = np.searchsorted(row[order], np.arange(n + 1))
        bits = bits[order]
        some = [i for i in range(n) if bits[borders[i] : borders[i + 1]].any()]
        masks = [np.packbits(bits[borders[i] : borders[i + 1]]).tobytes() for i in some]
        return pd.DataFrame({**{c: k[some] for c, k in zip(_ROW, keys, strict=True)}, "mask": masks})

    sent = rows.mapInArrow(tidy(hashed), "part long, run long, blob binary")
    back = sent.groupBy("part").applyInPandas(meet, "part long, run long, blob binary")
    masks = back.groupBy("run").applyInPandas(gather, "id long, d1 long, d2 long, mask binary")
    return masks.groupBy(*_ROW).agg(F.first("mask").alias("mask"))


# ---------------------------------------------------------------- runs


def sort_items(data: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The sort items of suffixes at ``place`` in texts from ``start`` to ``end``, as rows of ITEM bytes."""
    out = np.zeros((len(place), ITEM), np.uint8)
    right = np.minimum(LENGTH, end - place)
    left = np.minimum(LEFT, place - start)
    for i in range(LENGTH):
        at = np.minimum(place + i, len(data) - 1)
        out[:, i] = np.where(i < right, data[at], 0)
    for i in range(LEFT):
        at = np.maximum(place - 1 - i, 0)
        out[:, LENGTH + i] = np.where(i < left, data[at], 0)
    out[:, -2], out[:, -1] = right, left
    return out


def _strings(items: np.ndarray, width: int = ITEM) -> np.ndarray:
    """Rows as fixed-length byte strings that sort like the bytes (all rows have the same length, so zeros are safe)."""
    return np.ascontiguousarray(items[:, :width]).view(f"S{width}").ravel()


def front_code(items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared prefix length of each sorted row with the one before (0 for the first), and the bytes that follow it."""
    differs = items[1:] != items[:-1]
    shared = np.zeros(len(items), np.uint8)
    if len(items) > 1:
        shared[1:] = np.where(differs.any(1), differs.argmax(1), ITEM)
    return shared, items[np.arange(ITEM) >= shared[:, None]]


def _runs(met: DataFrame, borders: list[bytes], groups: int) -> DataFrame:
    """Sorted, front-coded runs by key range; for each run one more row with the places its entries stand for."""

    def make(batches: Iterator) -> Iterator:
        edges = np.array(borders, f"S{GRAM}")
        count = 0
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=3):
                run = _slice_number(count)
                count += 1
                data, offsets = text_buffers(part.column(3))
                place, hashes = anchors(data, offsets)
                row = np.searchsorted(offsets, place, side="right") - 1
                _, group = _groups_of(hashes, groups)
                # Bits lie by text, then hash group, then place.
                order = np.lexsort((group, row))
                bits = []
                per_row = np.bincount(row, minlength=part.num_rows)
                for mask, n in zip(part.column(4).to_pylist(), per_row.tolist(), strict=True):
                    bits.append(np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool))
                mine = np.sort(order[np.concatenate(bits)]) if bits else order
                place, row = place[mine], row[mine]
                keys = [np.array(part.column(i).to_pylist(), np.int64) for i in range(3)]
                items = sort_items(data, place, offsets[row], offsets[row + 1])
                order = np.argsort(_strings(items), kind="stable")
                items, row, place = items[order], row[order], (place - offsets[row])[order]
                new = np.r_[True, (items[1:] != items[:-1]).any(1)] if len(items) else np.zeros(0, bool)
                entry = np.cumsum(new) - 1
                single = items[new]
                least = np.full(len(single), np.iinfo(np.int64).max)
                np.minimum.at(least, entry, keys[0][row])
                dealt = np.searchsorted(edges, _strings(single, GRAM), side="right")
                parts, blobs = [-1 - run], [_blob(*keys, entry, row, place, dealt)]
                for p in np.unique(dealt).tolist():
                    a, b = np.searchsorted(dealt, [p, p + 1])
                    parts.append(p)
                    blobs.append(_blob(*front_code(single[a:b]), least[a:b]))
                yield _batch([parts, [run] * len(parts), blobs], ["part", "run", "blob"])

    return met.mapInArrow(tidy(make), "part long, run long, blob binary")


# ---------------------------------------------------------------- merge


def merge_runs(runs: list[tuple[list[int], list[bytes]]]) -> Iterator[tuple[int, int, int, bytes]]:
    """Merge front-coded runs: yields run, entry, prefix shared with the item before, and the item.

    ``runs`` hold shared prefix lengths and remainders. The loser tree keeps, for each contender, its common prefix
    with the last winner. The longer one wins unseen; only equal ones are compared, from that length on.
    """
    k = len(runs)
    head: list[bytes] = [b""] * k
    known = [-1] * k
    at = [-1] * k

    def advance(r: int) -> None:
        at[r] += 1
        shared, rest = runs[r]
        if at[r] < len(rest):
            known[r] = shared[at[r]]
            head[r] = head[r][: known[r]] + rest[at[r]]
        else:
            known[r] = -1

    def loses(a: int, b: int) -> bool:
        """Whether a comes after b; the loser's prefix is brought up to date with the winner's item."""
        ka, kb = known[a], known[b]
        if ka != kb:
            return ka < kb
        if ka < 0:
            return a > b
        x, y = head[a], head[b]
        gap = int.from_bytes(x[ka:], "big") ^ int.from_bytes(y[ka:], "big")
        common = ITEM - (gap.bit_length() + 7) // 8
        if x < y or (common == ITEM and a < b):
            known[b] = common
            return False
        known[a] = common
        return True

    for r in range(k):
        advance(r)
    # losers[node] for nodes 1 to k-1 of a tree whose leaves k to 2k-1 are the runs.
    losers = [0] * max(1, k)
    winner = [0] * (2 * k)
    for r in range(k):
        winner[k + r] = r
    for node in range(k - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        if loses(a, b):
            a, b = b, a
        winner[node], losers[node] = a, b
    top = winner[1] if k > 1 else 0
    while known[top] >= 0:
        yield top, at[top], known[top], head[top]
        advance(top)
        node = (top + k) >> 1
        while node:
            if loses(top, losers[node]):
                top, losers[node] = losers[node], top
            node >>= 1


def least_by_window(items: np.ndarray, least: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """For each sorted distinct item and each offset o, the least document that has the LENGTH bytes which begin o
    bytes before the anchor; the largest integer where the item has no such bytes.

    Items that share no gram with a neighbour have only themselves. The others meet by the hash of the window, and
    neighbours of equal hash are compared byte by byte.
    """
    top = np.iinfo(np.int64).max
    n = len(items)
    right, left = items[:, -2].astype(np.int64), items[:, -1].astype(np.int64)
    offsets = np.arange(LEFT + 1)
    exists = (offsets <= left[:, None]) & (LENGTH - offsets <= right[:, None])
    out = np.where(exists, least[:, None], top)
    together = np.zeros(n, bool)
    if n > 1:
        near = shared[1:] >= GRAM
        together[1:] |= near
        together[:-1] |= near
    some = np.flatnonzero(together)
    if not len(some):
        return out
    around = np.concatenate([items[some, LENGTH : LENGTH + LEFT][:, ::-1], items[some, :LENGTH]], axis=1)
    base = np.uint64(0x9E3779B97F4A7C15)
    whole = np.zeros(len(some), np.uint64)
    first = np.uint64(pow(int(base), LENGTH - 1, 1 << 64))
    for i in range(LENGTH):
        whole = whole * base + around[:, i]
    for start in range(LEFT + 1):
        o = LEFT - start
        here = np.flatnonzero(exists[some, o])
        if len(here):
            value = mix(whole[here])
            order = here[np.lexsort((least[some[here]], value))] if len(here) > 1 else here
            sorted_value = mix(whole[order])
            same = np.zeros(len(order), bool)
            same[1:] = sorted_value[1:] == sorted_value[:-1]
            window = around[:, start : start + LENGTH]
            at = np.flatnonzero(same)
            for a in range(0, len(at), 1 << 16):
                b = at[a : a + (1 << 16)]
                same[b] = (window[order[b]] == window[order[b - 1]]).all(1)
            lead = np.flatnonzero(~same)[np.cumsum(~same) - 1]
            out[some[order], o] = least[some[order[lead]]]
        if start < LEFT:
            whole = (whole - around[:, start] * first) * base + around[:, start + LENGTH]
    return out


def _merged(runs: DataFrame) -> DataFrame:
    """For each run and key range: pieces of offsets with one least document, entry by entry."""

    def merge(group):
        import pandas as pd

        if group["part"].iloc[0] < 0:
            return group
        group = group.sort_values("run")
        blocks = [_arrays(b) for b in group["blob"]]
        coded = []
        for shared, rest, _ in blocks:
            ends = np.cumsum(ITEM - shared.astype(np.int64)).tolist()
            raw = rest.tobytes()
            coded.append((shared.tolist(), [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]))
        of = [np.zeros(len(b[0]), np.int64) for b in blocks]
        kept, prefix, n = [], [], -1
        for run, entry, shared, item in merge_runs(coded):
            if shared < ITEM or n < 0:
                n += 1
                kept.append(item)
                prefix.append(shared)
            of[run][entry] = n
        items = np.frombuffer(b"".join(kept), np.uint8).reshape(-1, ITEM)
        least = np.full(len(items), np.iinfo(np.int64).max)
        for place, block in zip(of, blocks, strict=True):
            np.minimum.at(least, place, block[2])
        table = least_by_window(items, least, np.array(prefix))
        blobs = []
        # Workers keep what they took; the strings of a merge go back before the next stage.
        del coded, kept, items
        for place in of:
            mine = table[place]
            starts = np.ones(mine.shape, bool)
            starts[:, 1:] = mine[:, 1:] != mine[:, :-1]
            entry, offset = np.nonzero(starts)
            blobs.append(_blob(entry.astype(np.int32), offset.astype(np.uint8), mine[entry, offset]))
        return pd.DataFrame({"part": group["part"], "run": group["run"], "blob": blobs})

    return runs.groupBy("part").applyInPandas(merge, "part long, run long, blob binary")


def _covered(merged: DataFrame) -> DataFrame:
    """For each row key, the byte ranges that an earlier document has as well, joined where they touch."""

    def gather(group):
        import pandas as pd

        group = group.sort_values("part")
        *keys, entry, row, place, dealt = _arrays(group["blob"].iloc[0])
        rows, starts, ends = [], [], []
        for part, blob in zip(group["part"].iloc[1:], group["blob"].iloc[1:], strict=True):
            first = np.searchsorted(dealt, part)
            of, offset, least = _arrays(blob)
            # The last offset of a piece is the one before the next piece of the same entry.
            last = np.full(len(of), LEFT, np.int64)
            more = of[1:] == of[:-1]
            last[:-1][more] = offset[1:][more].astype(np.int64) - 1
            a = np.searchsorted(entry, first + of, side="left")
            b = np.searchsorted(entry, first + of, side="right")
            count = b - a
            piece = np.repeat(np.arange(len(of)), count)
            use = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + a[piece]
            good = least[piece] < keys[0][row[use]]
            piece, use = piece[good], use[good]
            rows.append(row[use])
            starts.append(place[use] - last[piece])
            ends.append(place[use] - offset[piece].astype(np.int64) + LENGTH)
        out: dict[str, list] = {c: [] for c in (*_ROW, "ranges")}
        if rows:
            row, start, end = (np.concatenate(x) for x in (rows, starts, ends))
            order = np.lexsort((start, row))
            row, start, end = row[order], start[order], end[order]
            borders = np.searchsorted(row, np.arange(len(keys[0]) + 1))
            for i in range(len(keys[0])):
                s, e = start[borders[i] : borders[i + 1]], end[borders[i] : borders[i + 1]]
                if len(s):
                    far = np.maximum.accumulate(e)
                    new = np.r_[True, s[1:] > far[:-1]]
                    lows, highs = s[new], far[np.r_[np.flatnonzero(new)[1:] - 1, len(s) - 1]]
                    for c, k in zip(_ROW, keys, strict=True):
                        out[c].append(k[i])
                    out["ranges"].append(np.stack([lows, highs], 1).astype("<i8").tobytes())
        return pd.DataFrame(out)

    found = merged.groupBy("run").applyInPandas(gather, "id long, d1 long, d2 long, ranges binary")
    return found.groupBy(*_ROW).agg(F.first("ranges").alias("ranges"))


# ---------------------------------------------------------------- operator


def _borders(rows: DataFrame, ranges: int) -> list[bytes]:
    """Grams that split the anchors of a few texts into ``ranges`` parts."""
    import pyarrow as pa

    if ranges < 2:
        return []
    texts = texts_by_hash(rows, "text", SAMPLE_TEXTS, "d1")
    data, offsets = text_buffers(pa.array(texts, pa.string()))
    place, _ = anchors(data, offsets)
    raw = data.tobytes()
    grams = sorted(raw[p : p + GRAM] for p in place.tolist())
    return sorted({grams[len(grams) * i // ranges] for i in range(1, ranges)}) if grams else []


def find_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``_ranges`` added: the byte ranges to remove, as pairs of little-endian 64-bit integers.

    A text equal to that of a smaller id goes whole, if it has LENGTH bytes, and takes no further part.
    """
    body = text_or_empty(text)
    rows = in_small_batches(docs).select(
        F.col(key).cast("long").alias("id"),
        F.xxhash64(body).alias("d1"),
        F.xxhash64(F.lit(1), body).alias("d2"),
        body.alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("_row"),
    )
    named = rows.where("id IS NOT NULL")
    sized = named.select(*_ROW, "text")
    megabytes = spread(sized, 1, F.octet_length("text"))
    groups, ranges = -(-megabytes // HASH_GROUP_MB), -(-megabytes // RANGE_MB)
    equal = sized.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = (
        sized.select(*_ROW).join(equal.select("d1", "d2", "first"), ["d1", "d2"]).where("id > first").select(*_ROW).distinct()
    )
    masks = saved(_shared_anchors(sized, groups).join(later, list(_ROW), "left_anti"))
    later = saved(later)
    borders = _borders(sized, ranges)
    # Both joins read the same rows, so the texts are shuffled once.
    met = named.join(masks.hint("shuffle_hash"), list(_ROW)).select(*_ROW, "text", "mask")
    # Slices are numbered by row order: a task that runs again after a lost executor must cut the same ones.
    met = met.sortWithinPartitions(*_ROW)
    covered = _covered(_merged(_runs(met, borders, groups)))
    plan = covered.unionByName(later.withColumn("ranges", F.lit(b"all")))
    out = named.join(plan.hint("shuffle_hash"), list(_ROW), "left").select("id", "text", "_row", "ranges")
    rest = rows.where("id IS NULL").select("id", "text", "_row", F.lit(None).cast("binary").alias("ranges"))
    return out.unionByName(rest)


def _cut(data: bytes, ranges: bytes | None) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes go and in how many runs."""
    if ranges is None:
        return data, 0, 0
    if ranges == b"all":
        return (b"", len(data), 1) if len(data) >= LENGTH else (data, 0, 0)
    pairs = np.frombuffer(ranges, "<i8").reshape(-1, 2).tolist()
    kept, at, gone = [], 0, 0
    for a, b in pairs:
        kept.append(data[at:a])
        gone += b - a
        at = b
    return b"".join([*kept, data[at:]]), gone, len(pairs)


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans (maximal runs) and kept_sha256 of the bytes that stay.

    A byte goes if it lies in LENGTH bytes that also start in a document with a smaller id; all is judged on the
    input. Null or short texts lose nothing. Rows with a null id are left as they are and remove nothing elsewhere;
    rows that share an id remove nothing from each other. No rows: no rows. Texts are whole.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for body, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data = (body or "").encode()
                left, gone, spans = _cut(data, ranges)
                out.append((len(data), gone, spans, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = T.StructType(
        [
            T.StructField(key, T.LongType()),
            *[T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("kept_sha256", T.StringType()),
        ]
    )
    return find_repeats(docs, key, text).select("id", "text", "ranges").mapInArrow(tidy(run), schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the text, all columns kept. Bytes of a character that a cut splits
    go with the cut. A null text becomes empty."""

    @F.arrow_udf("string")
    def cut(bodies, ranges):
        import pyarrow as pa

        out = []
        for body, found in zip(bodies.to_pylist(), ranges.to_pylist(), strict=True):
            out.append((body or "") if found is None else _cut((body or "").encode(), found)[0].decode(errors="ignore"))
        return pa.array(out, pa.string())

    left = find_repeats(docs, key, text).select("_row", cut("text", "ranges").alias("_text"))
    return left.select(*[F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
