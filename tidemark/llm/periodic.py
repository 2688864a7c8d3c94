"""Periodic runs of words: tiles per octave of periods, solved by Z-functions at their boundaries and stitched."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    SPACED_WORD_BYTES,
    _power_tables,
    in_small_batches,
    mix,
    slices,
    span_hashes,
    stored,
    text_buffers,
    tidy,
    word_spans,
)

LEAST_LENGTH = 6
LEAST_PERIODS = 4
SLICE_BYTES = 1 << 20
# The tiles of documents with more words are dealt to other tasks, those of shorter ones are solved where they lie.
LONG_WORDS = 1 << 16


def z_function(s: list) -> list[int]:
    """Entry i: how many entries from i on equal those from 0 on."""
    n = len(s)
    z = [0] * n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def _primes_of(n: int) -> list[int]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return out + [n] if n > 1 else out


def solve_tile(words: list, border: int, octave: int, periods: list[int] | None = None) -> list[tuple[int, int, int]]:
    """``(period, start, end)`` of the stretches in a tile that hold ``border`` and the word one period on.

    The tile reaches from 2 octaves before its border to 4 behind it, less where the text ends; periods are those
    from ``octave`` to below its double. The Z-function of what follows the border says how far a period holds to the
    right, that of the reversed tile how far to the left. Stretches of a smaller period are left out, as are those
    of at most two periods and those that end inside the tile and are too short for a run: no run needs them.
    """
    low, high = max(border - 2 * octave, 0), min(border + 2 * octave, len(words))
    ahead = z_function(words[border : border + 4 * octave])
    pattern = words[low:border][::-1]
    back = z_function([*pattern, None, *words[low:high][::-1]])
    found = []
    for q in periods or range(octave, 2 * octave):
        if q >= len(ahead) or border + q > high:
            continue
        before = min(back[len(pattern) + 1 + high - border - q], len(pattern))
        length = before + q + ahead[q]
        if length <= 2 * q or any(ahead[q // r] >= q - q // r for r in _primes_of(q)):
            continue
        start, end = border - before, border + q + ahead[q]
        inside = before < 2 * octave and end < border + 4 * octave
        if not inside or length >= max(LEAST_LENGTH, LEAST_PERIODS * q):
            found.append((q, start, end))
    return found


def tiles_worth_solving(ids: np.ndarray, octave: int, n: int) -> Iterator[tuple[int, list[int]]]:
    """``(border, periods)`` of the tiles with borders at multiples of ``2 * octave`` below ``n`` that may hold more than two periods.

    Such a stretch reaches further than half an octave to one side of the border, so the hash of that many words
    at the border equals that one period on. Whole rows of tiles are compared at once.
    """
    block, step = octave // 2 + 1, 2 * octave
    tiles = -(-n // step)
    size = tiles * step
    powers, inverse = _power_tables(len(ids) + 1)
    prefix = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(ids * powers[:-1], out=prefix[1:])
    hashes = (prefix[block : block + size] - prefix[:size]) * inverse[:size]
    rows = hashes.reshape(tiles, step)
    hit = rows[:, octave:] == rows[:, :1]
    if tiles > 1:
        rows = hashes[step - block : size - block].reshape(tiles - 1, step)
        hit[1:] |= rows[:, octave:] == rows[:, :1]
    at, period = np.nonzero(hit)
    for tile in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at)) + 1) if len(at) else ():
        yield int(at[tile[0]]) * step, (period[tile] + octave).tolist()


class _Texts:
    """Word hashes of some texts in a row, longest first, with separators that equal nothing else."""

    def __init__(self, column):
        data, offsets = text_buffers(column)
        starts, ends, borders = word_spans(data, offsets, SPACED_WORD_BYTES)
        self.words = np.diff(borders)
        hashes = span_hashes(data, starts, ends)
        self.order = np.argsort(-self.words, kind="stable")
        sizes = self.words[self.order]
        self.begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        most = int(sizes[0]) if len(sizes) else 0
        # Four octaves beyond the last border are read at most.
        self.ids = mix(np.arange(self.begins[-1] + most + 8, dtype=np.uint64) + np.uint64(0x5EBA_7A70_0000_0000))
        for text, begin in zip(self.order, self.begins, strict=False):
            self.ids[begin : begin + self.words[text]] = hashes[borders[text] : borders[text + 1]]

    def tiles(self) -> Iterator[tuple[int, int, int, list[int]]]:
        """``(text, octave, border in the text, periods)`` over all octaves; only texts of 4 octaves hold a run."""
        octave = 1
        sizes = self.words[self.order]
        while len(sizes) and sizes[0] >= LEAST_PERIODS * octave:
            n = int(self.begins[np.searchsorted(-sizes, -LEAST_PERIODS * octave, side="right")])
            for border, periods in tiles_worth_solving(self.ids[: n + 4 * octave + 4], octave, n):
                slot = int(np.searchsorted(self.begins, border, side="right")) - 1
                yield slot, octave, border, periods
            octave *= 2


_FRAGMENT = "ref long, period long, start long, end long"


def _first_pass(source: DataFrame, key: str, with_text: bool) -> DataFrame:
    """Rows of three kinds: documents (``n_words`` set), fragments (``period`` set) and tiles to deal (``octave`` set).
    A document without any tile worth a look is done; only the others bring their text along."""
    schema = T.StructType(
        [
            T.StructField("ref", T.LongType()),
            T.StructField("key", source.schema[key].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_words", "period", "start", "end", "octave", "border", "at")],
            T.StructField("words", T.BinaryType()),
            T.StructField("text", T.StringType()),
            T.StructField("collapsed", T.StringType()),
            T.StructField("collapsed_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES, text=2):
                texts = _Texts(part.column(2))
                refs = part.column(0).to_pylist()
                fragments, tiles, open_texts = set(), [], set()
                for slot, octave, border, periods in texts.tiles():
                    text, begin = int(texts.order[slot]), int(texts.begins[slot])
                    if border - begin >= texts.words[text]:
                        continue
                    low = max(border - 2 * octave, begin)
                    tile = texts.ids[low : min(border + 4 * octave, begin + int(texts.words[text]))]
                    if texts.words[text] > LONG_WORDS:
                        open_texts.add(text)
                        tiles.append((refs[text], octave, border - begin, low - begin, tile.astype("<u8").tobytes()))
                        continue
                    for period, start, end in solve_tile(tile.tolist(), border - low, octave, periods):
                        open_texts.add(text)
                        fragments.add((refs[text], period, start + low - begin, end + low - begin))
                rows = []
                keys, whole = part.column(1), part.column(2).to_pylist()
                for text, words in enumerate(texts.words.tolist()):
                    row = dict.fromkeys(schema.names) | {"ref": refs[text], "n_words": words}
                    if text in open_texts:
                        row["text"] = whole[text]
                    else:
                        joined = b" ".join((whole[text] or "").encode().split())
                        row["collapsed"] = joined.decode() if with_text else None
                        row["collapsed_sha256"] = hashlib.sha256(joined).hexdigest()
                    rows.append(row)
                keyed = len(rows)
                names = ("ref", "period", "start", "end")
                rows += [dict(zip(names, f, strict=True)) for f in sorted(fragments)]
                names = ("ref", "octave", "border", "at", "words")
                rows += [dict(zip(names, t, strict=True)) for t in tiles]
                columns = [pa.array([r.get(c) for r in rows], out[i]) for i, c in enumerate(schema.names) if c != "key"]
                blank = pa.nulls(len(rows) - keyed, keys.type)
                columns.insert(1, pa.concat_arrays([keys, blank]))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    out = _arrow_types(schema)
    return stored(source.select("ref", key, "_text").mapInArrow(tidy(run), schema))


def _arrow_types(schema: T.StructType) -> list:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(f.dataType) for f in schema]


def _solved(tiles: DataFrame) -> DataFrame:
    """The fragments of dealt tiles."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = set()
            for ref, octave, border, at, words in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.frombuffer(words, "<u8").tolist()
                found.update((ref, q, s + at, e + at) for q, s, e in solve_tile(ids, border - at, octave))
            columns = list(zip(*sorted(found), strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["ref", "period", "start", "end"])

    # By tile, not by document: the tiles of one document go to many tasks.
    dealt = in_small_batches(tiles).repartition("ref", "octave", "border")
    return dealt.select("ref", "octave", "border", "at", "words").mapInArrow(tidy(run), _FRAGMENT)


def stitch(fragments: DataFrame) -> DataFrame:
    """``ref, start, length, period`` of the runs. Fragments of one document and period belong together where they
    share at least a period of words; two runs of one period share less."""
    own = Window.partitionBy("ref", "period").orderBy("start", "end")
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.max("end").over(before) - F.col("period") < F.col("start"), F.lit(True))
    numbered = fragments.withColumn("apart", apart.cast("int")).withColumn("run", F.sum("apart").over(own))
    runs = numbered.groupBy("ref", "period", "run").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.where(F.col("length") >= F.greatest(F.lit(LEAST_LENGTH), LEAST_PERIODS * F.col("period"))).drop("run")


def _collapsed(found: DataFrame, with_text: bool) -> DataFrame:
    """Documents with runs: the words that no run repeats, joined."""
    schema = T.StructType(
        [
            T.StructField("ref", T.LongType()),
            T.StructField("collapsed", T.StringType()),
            T.StructField("collapsed_sha256", T.StringType()),
        ]
    )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts, digests = [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = text.encode().split()
                change = np.zeros(len(words) + 1, np.int64)
                for r in runs or ():
                    change[r["start"] + r["period"]] += 1
                    change[r["start"] + r["length"]] -= 1
                joined = b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)])
                texts.append(joined.decode() if with_text else None)
                digests.append(hashlib.sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(digests, pa.string())], names=schema.names
            )

    return in_small_batches(found).select("ref", "text", "runs").mapInArrow(tidy(run), schema)


def collapse(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True) -> DataFrame:
    """Per document: key, n_words, runs (start, length, period by start, then period), the longest run (start, length,
    period, exponent_milli; ties: smallest start, then period), runs_sha256, collapsed (the text without the words
    that a run repeats, joined by one space; only ``with_text``) and collapsed_sha256.

    A run is a stretch of words of smallest period q, at least ``max(6, 4 * q)`` words long, that can't be extended.
    Periods are solved by octave: tiles of 6 octaves with borders 2 octaves apart overlap so that each run holds a
    border with a period behind it, and so that pieces of a run in neighbouring tiles share a period. Most tiles
    are ruled out by hashes of word blocks at their border; the others are solved one by one, those of documents
    over ``LONG_WORDS`` words in tasks of their own. Fragments meet by document and period. Words are compared by
    64-bit hashes. Texts are shuffled only for documents in which a tile held a repetition.

    Null or empty text: no words, no run, four nulls, the hashes of nothing. Null and repeated keys: row by row. No
    rows: no rows. Other columns are not read. Whole texts of any length are searched.
    """
    source = in_small_batches(docs).select(
        F.monotonically_increasing_id().alias("ref"), F.col(key).alias(key), F.col(text).cast("string").alias("_text")
    )
    passed = _first_pass(source, key, with_text)
    here = passed.where("period IS NOT NULL").select("ref", "period", "start", "end")
    dealt = _solved(passed.where("octave IS NOT NULL"))
    runs = stitch(here.unionByName(dealt))
    per_doc = runs.groupBy("ref").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    documents = passed.where("n_words IS NOT NULL")
    left = documents.where("text IS NOT NULL").select("ref", "key", "n_words", "text").join(per_doc, "ref", "left")
    left = stored(left)
    changed = left.drop("text").join(_collapsed(left, with_text), "ref")
    plain = documents.where("text IS NULL").select(
        "ref", "key", "n_words", F.lit(None).cast(per_doc.schema["runs"].dataType).alias("runs"), "collapsed", "collapsed_sha256"
    )
    every = plain.unionByName(changed).withColumn("runs", F.expr("coalesce(runs, slice(array(named_struct('start', 0L, 'length', 0L, 'period', 0L)), 1, 0))"))
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start, -r.period)))")
    lines = F.expr("transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n'))")
    columns = [
        F.col("key").alias(key),
        "n_words",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.expr("1000L * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
        "runs",
    ]
    return every.withColumn("best", best).select(*columns, *(["collapsed"] if with_text else []))
