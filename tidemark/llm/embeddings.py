"""Embedding near-duplicates: exact cosine links by dual traversal of cover trees."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import broadcast_if_small, in_small_batches, mix, saved, tidy
from tidemark.llm.components import components

# Vectors of a block (it has one cover tree), and blocks of a strip (it is one row), at most. A strip of long vectors
# has fewer, one of a small table as many as give FEW_STRIPS strips.
BLOCK = 2_048
STRIP = 8
STRIP_BYTES = 4 << 20
FEW_STRIPS = 16
# Strips that a task holds of either side.
STRIPS_AT_ONCE = 8
# Sampled vectors for each strip, and bytes of the sample at most.
SAMPLED = 32
SAMPLE_BYTES = 16 << 20
# Rounding that a bound on a distance of unit vectors may be off by.
MARGIN = 1e-6
# Below this radius a node is opened into its points at once.
LEAST_RADIUS = 0.05
# A level's pairs of nodes are looked at if so many times as many pairs of points would not take less time.
NODE_COST = 512
# Rows and columns of a part of such products, which stays in the processor's cache.
TILE = (256, 1_024)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that their largest component is between a half and one: cosines stay what
    they are, and no square overflows or vanishes."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1])


def units(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def principal(x: np.ndarray) -> np.ndarray:
    """Places of the rows on about the direction in which they vary most, and that direction (zeros if none does)."""
    centred = x - x.mean(0)
    v = centred[np.einsum("ij,ij->i", centred, centred).argmax()]
    for _ in range(6):
        length = np.linalg.norm(v)
        if length < 1e-100:
            return np.zeros(len(x)), np.zeros(x.shape[1])
        v = centred.T @ (centred @ (v / length))
    v = v / max(np.linalg.norm(v), 1e-100)
    return x @ v, v


class Splits:
    """A binary tree that deals unit vectors of one length to ``leaves`` leaves of about the same size, near ones to
    the same: each node splits them along the principal direction of the sampled vectors that reach it, or by their
    hash where those do not vary (or are too few)."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.leaves = 0
        self.direction: list[np.ndarray] = []
        self.border: list[float] = []
        self.hashed: list[bool] = []
        self.below: list[list[int]] = []
        self._grow(sample, leaves)
        self.direction, self.border = np.array(self.direction), np.array(self.border)
        self.hashed, self.below = np.array(self.hashed, bool), np.array(self.below, np.int64).reshape(-1, 2)

    def _grow(self, sample: np.ndarray, leaves: int) -> int:
        """The number of the node made; leaves count down from -1."""
        if leaves == 1:
            self.leaves += 1
            return -self.leaves
        node, share = len(self.below), (leaves // 2) / leaves
        self.below.append([0, 0])
        place, direction = principal(sample) if len(sample) else (np.zeros(0), np.zeros(sample.shape[1]))
        border = float(np.quantile(place, share)) if len(place) else 0.0
        left = place <= border
        hashed = len(place) < 2 or not share / 2 <= left.mean() <= (1 + share) / 2
        self.direction.append(direction)
        self.border.append(share if hashed else border)
        self.hashed.append(hashed)
        self.below[node][0] = self._grow(sample if hashed else sample[left], leaves // 2)
        self.below[node][1] = self._grow(sample if hashed else sample[~left], leaves - leaves // 2)
        return node

    def leaf(self, unit: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The leaf, from 0, of each row."""
        at = np.full(len(unit), 0 if len(self.below) else -1)
        while len(open_ := np.flatnonzero(at >= 0)):
            node = at[open_]
            place = np.einsum("ij,ij->i", unit[open_], self.direction[node])
            by_hash = mix(hashes[open_].astype(np.uint64) + mix(node.astype(np.uint64))) / 2.0**64
            left = np.where(self.hashed[node], by_hash, place) <= self.border[node]
            at[open_] = self.below[node, np.where(left, 0, 1)]
        return -1 - at


def in_blocks(unit: np.ndarray, most: int) -> list[np.ndarray]:
    """Rows by block of at most ``most``, halved along principal directions."""
    done, todo = [], [np.arange(len(unit))]
    while todo:
        rows = todo.pop()
        if len(rows) <= most:
            done.append(rows)
            continue
        order = np.argsort(principal(unit[rows])[0], kind="stable")
        half = -(-len(rows) // most) // 2 * most
        todo += [rows[order[half:]], rows[order[:half]]]
    return done


def cover_levels(points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A cover tree of unit vectors as levels from the root down: ``(centres, parent, radius)``.

    Levels are nested: a centre of one level is a centre of all below, and the net's radius halves from level to
    level. ``parent`` is the place of each centre's parent in the level above, ``radius`` the largest distance from
    the centre to any point below it. The last level has every point as its own centre with radius 0.
    """
    n = len(points)
    centres = np.array([0])
    owner = np.zeros(n, np.int64)
    distance = np.sqrt(np.maximum(0, 2 - 2 * points @ points[0]))
    reach = max(float(distance.max()), LEAST_RADIUS)
    parent = np.zeros(1, np.int64)
    levels = []
    while True:
        # owner[p] is the place of p's centre in the current level.
        radius = np.zeros(len(centres))
        np.maximum.at(radius, owner, distance)
        levels.append((centres, parent, radius))
        if len(centres) == n:
            return levels
        reach /= 2
        if reach < LEAST_RADIUS:
            everyone = np.arange(n)
            levels.append((everyone, owner.copy(), np.zeros(n)))
            return levels
        chosen, new_owner, new_distance = list(centres), owner.copy(), distance.copy()
        above = list(range(len(centres)))
        # Points too far from their centre choose the first among them as a centre of their own, under the same parent.
        far = np.flatnonzero(distance > reach)
        while len(far):
            p = far[0]
            mine = far[owner[far] == owner[p]]
            gap = np.sqrt(np.maximum(0, 2 - 2 * points[mine] @ points[p]))
            near = mine[gap <= reach]
            new_owner[near] = len(chosen)
            new_distance[near] = gap[gap <= reach]
            new_owner[p], new_distance[p] = len(chosen), 0.0
            chosen.append(p)
            above.append(int(owner[p]))
            covered = np.zeros(n, bool)
            covered[near] = True
            covered[p] = True
            far = far[~covered[far]]
        centres, parent = np.array(chosen), np.array(above)
        owner, distance = new_owner, new_distance


Levels = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


class Block:
    """Vectors, scaled, with their norms and their cover tree."""

    def __init__(self, x: np.ndarray, levels: Levels):
        self.x, self.levels = x, levels
        wide = x.astype(np.float64)
        self.norm = np.linalg.norm(wide, axis=1)
        self.narrow_units = (wide / self.norm[:, None]).astype(np.float32)
        self._below: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return len(self.x)

    def level(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Centres and radii; below the last level it stays as it is."""
        centres, _, radius = self.levels[min(k, len(self.levels) - 1)]
        return centres, radius.astype(np.float64)

    def below(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Children at level ``k`` by parent, where each parent's begin, and how many it has."""
        if k not in self._below:
            parent = self.levels[k][1] if k < len(self.levels) else np.arange(len(self.levels[-1][0]))
            count = np.bincount(parent)
            self._below[k] = np.argsort(parent, kind="stable"), np.cumsum(count) - count, count
        return self._below[k]


def dual_links(a: Block, b: Block, least: float) -> np.ndarray:
    """Pairs ``(row of a, row of b)`` of two blocks with a cosine of at least ``least``; any lengths, doubles.

    Both cover trees are walked together from their roots. A pair of nodes goes on to its children only if the
    distance of their centres, less both covering radii, does not exceed the distance that the cosine allows. Where
    that leaves so many pairs of nodes that all pairs of points take less time, those are multiplied instead.
    """
    limit = np.sqrt(max(0.0, 2 - 2 * least)) + MARGIN
    i = j = np.zeros(1, np.int64)
    for level in range(max(len(a.levels), len(b.levels))):
        if level:
            (ia, sa, na), (jb, sb, nb) = a.below(level), b.below(level)
            opened = na[i] * nb[j]
            if NODE_COST * opened.sum() >= len(a) * len(b):
                return _all_pairs(a, b, least)
            pair = np.repeat(np.arange(len(i)), opened)
            nth = np.arange(len(pair)) - (np.cumsum(opened) - opened)[pair]
            i, j = i[pair], j[pair]
            i, j = ia[sa[i] + nth // nb[j]], jb[sb[j] + nth % nb[j]]
        (ca, ra), (cb, rb) = a.level(level), b.level(level)
        near = _cosines(a, b, ca[i], cb[j]) >= 1 - (ra[i] + rb[j] + limit) ** 2 / 2
        i, j = i[near], j[near]
        if not len(i):
            return np.zeros((0, 2), np.int64)
    i, j = ca[i], cb[j]
    good = _cosines(a, b, i, j) >= least
    return np.stack([i[good], j[good]], 1)


def _all_pairs(a: Block, b: Block, least: float) -> np.ndarray:
    """As ``dual_links``, by products in single precision; doubles decide where those are too close to ``least``."""
    # What rounding may add to or take from a product of unit vectors in single precision.
    off = (a.x.shape[1] + 16) * 1.2e-7
    across = np.ascontiguousarray(b.narrow_units.T)
    rows, columns = TILE
    out = [np.zeros((0, 2), np.int64)]
    for r in range(0, len(a), rows):
        part = a.narrow_units[r : r + rows]
        for c in range(0, len(b), columns):
            product = part @ across[:, c : c + columns]
            i, j = np.divmod(np.flatnonzero(product >= least - off), product.shape[1])
            if len(i):
                good = product[i, j] >= least + off
                close = np.flatnonzero(~good)
                good[close] = _cosines(a, b, i[close] + r, j[close] + c) >= least
                out.append(np.stack([i[good] + r, j[good] + c], 1))
    return np.concatenate(out)


def _cosines(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosines of row pairs, some at a time."""
    out = np.empty(len(i))
    for start in range(0, len(i), 1 << 15):
        part = slice(start, start + (1 << 15))
        x, y = a.x[i[part]].astype(np.float64), b.x[j[part]].astype(np.float64)
        out[part] = np.einsum("ij,ij->i", x, y) / (a.norm[i[part]] * b.norm[j[part]])
    return out


def _roots(rows: np.ndarray, columns: np.ndarray, size: int) -> np.ndarray:
    """The smallest row that each row reaches by the links given, by spreading minima."""
    label = np.arange(size)
    while True:
        new = label.copy()
        np.minimum.at(new, rows, label[columns])
        np.minimum.at(new, columns, label[rows])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def strip_links(a: list[Block], b: list[Block], same: bool, copies: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row of two strips (of one strip, if it is the ``same``): copies linked with it, and the smallest row it reaches."""
    n, root = np.zeros(len(copies)), np.arange(len(copies))
    rows, columns, held = [], [], 0
    at_a = np.cumsum([0, *map(len, a)])
    at_b = np.cumsum([0 if same else at_a[-1], *map(len, b)])
    for k, one in enumerate(a):
        for m, other in enumerate(b):
            if same and m < k:
                continue
            i, j = dual_links(one, other, least).T
            if same and m == k:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            i, j = i + at_a[k], j + at_b[m]
            n += np.bincount(i, copies[j], len(n)) + np.bincount(j, copies[i], len(n))
            rows, columns, held = [*rows, i], [*columns, j], held + len(i)
            if held > 1 << 20:  # a forest of as many links as rows stands for all so far
                root = _roots(np.concatenate(rows), np.concatenate(columns), len(n))
                rows, columns, held = [np.arange(len(n))], [root], 0
    if rows:
        root = _roots(np.concatenate(rows), np.concatenate(columns), len(n))
    return n.astype(np.int64), root


def deduplicate(vectors: DataFrame, least: float = 0.95, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Per row: n_links (other rows linked directly), component_id (smallest id reachable, itself included), kept.

    Equal vectors are linked at once and only one of each goes on. The distinct ones are dealt to strips by a tree of
    splits that a sample gives, and inside a strip to blocks; each block builds its cover tree once. Strips are
    written once, one row each. Each pair of them is read from there by a task and never shuffled, unless the distance
    of their centres exceeds both radii by more than a link can span. Nothing is approximate: splits, strips and
    blocks only decide which pairs need no look.

    Null, empty and zero vectors, vectors with null or non-finite components, and rows with a null id link with
    nothing: n_links 0, component their own id, kept. Vectors of different length never link. Rows that share an id
    are one node of the graph. No rows: no rows. Columns other than the two are not read.
    """
    kind = vectors.schema[key].dataType
    raw = F.col(column).cast("array<double>")
    sound = F.exists(raw, lambda v: v != 0) & ~F.exists(raw, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(
        F.col(key).alias("id"),
        (F.col(key).isNotNull() & F.coalesce(sound, F.lit(False))).alias("sound"),
        F.col(column).alias("v"),
    )
    keyed = rows.select(
        "id",
        "v",
        F.when(F.col("sound"), F.xxhash64("v")).alias("d1"),
        F.when(F.col("sound"), F.xxhash64(F.lit(1), "v")).alias("d2"),
    )
    strips = saved(_strips(keyed.where("d1 IS NOT NULL"), kind))
    limit = float(np.sqrt(max(0.0, 2 - 2 * least))) + MARGIN
    kind_name = kind.simpleString()

    def meet(batches: Iterator) -> Iterator:
        import pickle

        import pyarrow as pa

        opened: OrderedDict[int, list[Block]] = OrderedDict()

        def blocks(strip: int, row) -> list[Block]:
            if strip not in opened:
                opened[strip] = [Block(*block) for block in pickle.loads(row.as_buffer())]
            opened.move_to_end(strip)
            while len(opened) > STRIPS_AT_ONCE + 2:
                opened.popitem(last=False)
            return opened[strip]

        for batch in batches:
            for r in range(batch.num_rows):
                row = {name: batch.column(name)[r] for name in batch.schema.names}
                a, b = row["a_strip"].as_py(), row["b_strip"].as_py()
                sides = "a" if a == b else "ab"
                node = pa.concat_arrays([row[f"{s}_node"].values for s in sides])
                copies = np.concatenate([row[f"{s}_copies"].values.to_numpy() for s in sides])
                n, root = strip_links(blocks(a, row["a_blocks"]), blocks(b, row["b_blocks"]), a == b, copies, least)
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(some)), pa.array(n[some]), node.take(pa.array(root[some]))], names=["node", "n", "root"]
                )

    pairs = in_small_batches(_near_pairs(strips, limit))
    met = saved(pairs.mapInArrow(tidy(meet), f"node {kind_name}, n long, root {kind_name}"))
    found = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = met.groupBy("node").agg(F.sum("n").alias("n")).join(found, "node")
    nodes = strips.select(F.inline(F.arrays_zip("node", "copies", "d1", "d2")))
    # Of a vector that is missing here there is one row, which links with nothing.
    of_vector = (
        nodes.join(broadcast_if_small(linked), "node", "left")
        .where("n IS NOT NULL OR copies > 1")
        .select(
            "d1",
            "d2",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    out = keyed.select("id", "d1", "d2").join(broadcast_if_small(of_vector), ["d1", "d2"], "left")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _near_pairs(strips: DataFrame, limit: float) -> DataFrame:
    """Each pair of strips of one length once, and each strip with itself, if the balls around them are near enough.

    A Cartesian product reads both sides' partitions from where they are written; nothing of it is shuffled.
    """
    a, b = (strips.select(*(F.col(c).alias(f"{side}_{c}") for c in strips.columns if c not in ("d1", "d2"))) for side in "ab")
    squares = F.zip_with("a_centre", "b_centre", lambda x, y: (x - y) * (x - y))
    gap = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))
    # Not an equality, by which Spark would shuffle. Which of two strips is the first alternates, as on a chessboard, so
    # that tasks have about as many pairs each.
    alike = (F.col("a_size") <= F.col("b_size")) & (F.col("a_size") >= F.col("b_size"))
    once = F.when((F.col("a_strip") + F.col("b_strip")) % 2 == 0, F.col("a_strip") <= F.col("b_strip")).otherwise(
        F.col("a_strip") > F.col("b_strip")
    )
    near = alike & once & (gap <= F.col("a_radius") + F.col("b_radius") + F.lit(limit))
    names = [f"{side}_{c}" for side in "ab" for c in ("strip", "node", "copies", "blocks")]
    return a.hint("shuffle_replicate_nl").join(b, near).select(*names)


def _strips(sound: DataFrame, kind: T.DataType) -> DataFrame:
    """Rows ``(strip, size, node, copies, d1, d2, centre, radius, blocks)`` of the distinct vectors: arrays by vector,
    a ball that holds the strip's unit vectors, and its blocks, pickled."""
    narrow = sound.schema["v"].dataType == T.ArrayType(T.FloatType(), sound.schema["v"].dataType.containsNull)
    sound = sound.withColumn("size", F.size("v"))
    if not narrow:
        sound = sound.withColumn("v", F.col("v").cast("array<double>"))
    # As many rows as there are lengths.
    counts = sound.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("d1").alias("distinct")).collect()
    most = {r["size"]: max(1, min(STRIP * BLOCK, STRIP_BYTES // (4 * r["size"]))) for r in counts}
    n = {r["size"]: min(r["n"], r["distinct"]) for r in counts}
    for size in n:
        most[size] = min(most[size], max(BLOCK, -(-n[size] // FEW_STRIPS)))
    leaves = {size: -(-n[size] // most[size]) for size in sorted(n)}
    splits = _sampled_splits(sound, n, leaves)
    first = {size: sum(leaves[s] for s in leaves if s < size) for size in leaves}
    total = sum(leaves.values())
    parts = max(1, min(total, 6), -(-total // STRIPS_AT_ONCE))
    number = np.float32 if narrow else np.float64

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
                x = np.ascontiguousarray(x, number)
                hashes = part.column("d1").to_numpy().view(np.uint64)
                leaf = splits[size].leaf(units(x.astype(np.float64)), hashes) + first[size]
                ends = np.arange(len(x) + 1, dtype=np.int32) * (size * x.itemsize)
                blob = pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(ends), pa.py_buffer(x)])
                kept = [part.column(c) for c in ("node", "copies", "d1", "d2", "size")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int64()), *kept, blob], names=["strip", "node", "copies", "d1", "d2", "size", "x"]
                )

    def assemble(batches: Iterator) -> Iterator:
        """Rows come sorted by leaf; one of which there are more than expected gives several strips."""
        import pyarrow as pa

        leaf, made, held, count = None, 0, [], 0
        for batch in batches:
            leaves_of = batch.column("strip").to_numpy()
            starts = [0, *(np.flatnonzero(np.diff(leaves_of)) + 1).tolist(), len(leaves_of)]
            for start, end in zip(starts, starts[1:], strict=False):
                if end > start and leaves_of[start] != leaf:
                    if held:
                        yield strip(pa.Table.from_batches(held), leaf, made)
                    leaf, made, held, count = int(leaves_of[start]), 0, [], 0
                while start < end:
                    room = max(1, most[batch.column("size")[start].as_py()] * 5 // 4) - count
                    taken = batch.slice(start, min(end - start, room))
                    held, count, start = [*held, taken], count + taken.num_rows, start + taken.num_rows
                    if taken.num_rows == room:
                        yield strip(pa.Table.from_batches(held), leaf, made)
                        made, held, count = made + 1, [], 0
        if held:
            yield strip(pa.Table.from_batches(held), leaf, made)

    def strip(table, leaf: int, made: int):
        import pickle

        import pyarrow as pa

        size = table["size"][0].as_py()
        x = np.frombuffer(b"".join(table["x"].to_pylist()), number).reshape(-1, size)
        x = scaled(x.astype(np.float64))
        unit = units(x)
        order = in_blocks(unit, min(BLOCK, most[size]))
        blocks = []
        for part in order:
            short = x[part].astype(np.float32)
            blocks.append((short if (short == x[part]).all() else x[part], _short_levels(cover_levels(unit[part]))))
        table = table.take(pa.array(np.concatenate(order)))
        lists = [table[c].combine_chunks() for c in ("node", "copies", "d1", "d2")]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in lists]
        centre = unit.mean(0)
        radius = float(np.linalg.norm(unit - centre, axis=1).max())
        numbers = [pa.array([made * total + leaf], pa.int64()), pa.array([size], pa.int32())]
        ball = [pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius], pa.float64())]
        return pa.RecordBatch.from_arrays(
            [*numbers, *lists, *ball, pa.array([pickle.dumps(blocks, protocol=5)], pa.binary())],
            names=["strip", "size", "node", "copies", "d1", "d2", "centre", "radius", "blocks"],
        )

    distinct = sound.groupBy("d1", "d2").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("v").alias("v")
    )
    many = [T.StructField(c, T.ArrayType(t)) for c, t in (("node", kind), *((c, T.LongType()) for c in ("copies", "d1", "d2")))]
    single = [T.StructField(f.name, f.dataType.elementType) for f in many]
    placed = T.StructType(
        [T.StructField("strip", T.LongType()), *single, T.StructField("size", T.IntegerType()), T.StructField("x", T.BinaryType())]
    )
    whole = T.StructType(
        [
            T.StructField("strip", T.LongType()),
            T.StructField("size", T.IntegerType()),
            *many,
            T.StructField("centre", T.ArrayType(T.DoubleType())),
            T.StructField("radius", T.DoubleType()),
            T.StructField("blocks", T.BinaryType()),
        ]
    )
    dealt = in_small_batches(distinct).mapInArrow(tidy(place), placed)
    dealt = dealt.repartitionById(parts, (F.col("strip") % parts).cast("int"))
    return dealt.sortWithinPartitions("strip", "d1", "d2").mapInArrow(tidy(assemble), whole)


def _sampled_splits(sound: DataFrame, n: dict[int, int], leaves: dict[int, int]) -> dict[int, Splits]:
    """The splits for vectors of each length. Sampled are distinct vectors, by their hash."""
    range_ = 1 << 30
    below = {
        size: min(range_, int(range_ * min(SAMPLED * leaves[size], max(1, SAMPLE_BYTES // (8 * size))) / n[size]) + 1)
        for size in leaves
        if leaves[size] > 1
    }
    sample: dict[int, list] = {size: [] for size in leaves}
    if below:
        chance: Column = reduce(lambda c, s: c.when(F.col("size") == s, F.lit(below[s])), below, F.when(F.lit(False), F.lit(0)))
        picked = sound.where(F.pmod(F.xxhash64(F.lit(2), "d1"), F.lit(range_)) < chance).select("d1", "size", "v")
        for r in sorted(picked.dropDuplicates(["d1"]).collect(), key=lambda r: r["d1"]):
            sample[r["size"]].append(np.array(r["v"], np.float64))
    return {
        size: Splits(units(np.array(sample[size])) if sample[size] else np.zeros((0, size)), leaves[size]) for size in leaves
    }


def _short_levels(levels: Levels) -> Levels:
    """``levels`` in smaller numbers; radii are rounded up."""
    return [
        (centres.astype(np.int32), parent.astype(np.int32), np.nextafter(radius.astype(np.float32), np.float32(np.inf)))
        for centres, parent, radius in levels
    ]
