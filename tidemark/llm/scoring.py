"""Language-model scores: corpus-wide word counts and a causal self-attention model trained in numpy."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import (
    SPACED_WORD_BYTES,
    column_slices,
    in_small_batches,
    lower_ascii,
    release_memory,
    saved,
    slices,
    span_hashes,
    spread,
    stored,
    text_buffers,
    tidy,
    word_spans,
)
from tidemark.llm.words import WordTokens, ranges, with_ends

# All training texts are dealt to so many rounds, of at least TRAIN_TEXTS texts each; a round is a step at this rate, with
# so many MB of packed tokens a task (less where cores would be idle), and keeps this share of what earlier rounds say of an id's topics.
ROUNDS, TRAIN_TEXTS, ROUND_RATE, ROUND_MB, ROUND_KEEPS = 16, 8, 0.1, 72, 0.5
# Sums of a round are whole multiples of this, so that they don't depend on the order in which they come.
UNIT = 2.0**-24
# No score of attention comes near; what would is held there, so that sums of exponentials stay finite and above zero.
MOST_SCORE = 60.0
WIDTH, TOPICS = 16, 16
# A window scores its last STRIDE tokens and sees up to CONTEXT before them.
STRIDE, CONTEXT = 32, 16
EPOCHS, BATCH, RATE = 3, 96, 0.02
# Gradients of so many positions are summed by id at a time.
SUM_ROWS = 1 << 13
# Scores of attention fall by so much for each token of distance.
FADE = 0.1
HELD_OUT = 2
FOLDS = 7
SLICE_BYTES = 4 << 20
ENCODE_BYTES = 1 << 20
# Pieces of words whose ids a worker process remembers from task to task, at about 40 bytes each.
KNOWN_PIECES = 1_000_000
GROUP_MB = 64
# Stands for the end of a text among the word hashes.
END_WORD = np.uint64(0x5851F42D4C957F2D)


@lru_cache
def _fade(queries: int, keys: int) -> np.ndarray:
    """What the exponentials of attention scores are multiplied by: less with distance, nothing for what lies ahead."""
    ahead = np.arange(keys)[None, :] - (np.arange(queries)[:, None] + keys - queries)
    return np.where(ahead > 0, 0, np.exp(FADE * ahead)).astype(np.float32)


def _exp(x: np.ndarray, low: bool = False) -> np.ndarray:
    """Exponentials in place, of scores held between bounds unless all are known to be ``low``."""
    if not low:
        np.clip(x, -MOST_SCORE, MOST_SCORE, out=x)
    return np.exp(x, out=x)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.einsum("...k->...", x)[..., None]


# What steps of the gradient change; WIDTH and TOPICS are equal, so all but the embedding have one shape.
_LEARNT = ("embed", "query", "key", "value", "gate")


class Attention:
    """One causal self-attention layer over subword ids with a mixture of topic distributions on top.

    The state of a position is its own embedding plus what attention gathers from the positions up to it; it sets
    the shares of the topics, and a topic is a distribution over all ids. So the probabilities of all ids sum to
    one without a softmax over the vocabulary at each token. The end of a text is an id of its own, and the state
    before the first token is that of an end.
    """

    def __init__(self, vocabulary: int, seed: int = 5):
        random = np.random.default_rng(seed)
        self.end = vocabulary
        self.size = vocabulary + 1
        self.embed = random.normal(0, 0.3, (self.size, WIDTH)).astype(np.float32)
        self.query, self.key = (random.normal(0, 0.3, (WIDTH, WIDTH)).astype(np.float32) for _ in range(2))
        self.value, self.gate = (random.normal(0, 0.3, (WIDTH, TOPICS)).astype(np.float32) for _ in range(2))
        self.topics = np.full((self.size, TOPICS), 1 / self.size, np.float32)
        self._tables()

    def _tables(self) -> None:
        """Keys and values, queries and gates of every id, side by side; positions differ only by the fade."""
        self.seen_as = self.embed @ np.concatenate([self.key, self.value], 1)
        self.asks = self.embed @ np.concatenate([self.query, self.gate], 1)
        # What scores of attention and of topics can't exceed: products of lengths, and sums, as values gathered are means.
        asked, seen = (np.sqrt(np.einsum("ik,ik->i", t, t).max()) for t in (self.asks[:, :WIDTH], self.seen_as[:, :WIDTH]))
        gates, values = (np.abs(t[:, WIDTH:]).max() for t in (self.asks, self.seen_as))
        self.low = bool(max(asked * seen, gates + values) < MOST_SCORE)
        self.rooms: dict[str, np.ndarray] = {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """An array that the next batch overwrites: memory that lies in the cache is not asked for anew."""
        if name not in self.rooms or self.rooms[name].shape[1:] != shape[1:] or len(self.rooms[name]) < shape[0]:
            self.rooms[name] = np.empty(shape, np.float32)
        return self.rooms[name][: shape[0]]

    def windows(self, texts: Sequence[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Batches of (inputs, targets, scored, text number); each token of each text is scored in one window.

        The first window of a text has no context and is STRIDE wide, each later one begins CONTEXT earlier.
        """
        size = np.array([len(t) for t in texts], np.int64)
        targets = np.concatenate([*texts, np.zeros(STRIDE, np.int64)])
        start = np.cumsum(size) - size
        inputs = np.concatenate([[self.end], targets[:-1]])
        inputs[start[size > 0]] = self.end
        blocks = -(-size // STRIDE)
        text = np.repeat(np.arange(len(texts)), blocks)
        number = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        at, left = start[text] + number * STRIDE, size[text] - number * STRIDE
        to_score = np.lib.stride_tricks.sliding_window_view(targets, STRIDE)
        for first in (True, False):
            mine = np.flatnonzero((number == 0) == first)
            before = 0 if first else CONTEXT
            for a in range(0, len(mine), BATCH):
                w = mine[a : a + BATCH]
                to_see = np.lib.stride_tricks.sliding_window_view(inputs, before + STRIDE)
                yield to_see[at[w] - before], to_score[at[w]], np.arange(STRIDE) < left[w, None], text[w]

    def shares(self, inputs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Topic shares of the last STRIDE positions of each window, and what they are made of: exponentials of attention
        scores and what divides them, what attention gathers, queries, keys and values. Some hold until the next batch."""
        n, width = inputs.shape
        seen = self.seen_as.take(inputs, 0, self._room("seen", n, width, WIDTH + TOPICS), "clip")
        asks = self.asks.take(inputs[:, -STRIDE:], 0, self._room("asks", n, STRIDE, WIDTH + TOPICS), "clip")
        queries, keys, values = asks[..., :WIDTH], seen[..., :WIDTH], seen[..., WIDTH:]
        attention = _exp(np.matmul(queries, keys.transpose(0, 2, 1), out=self._room("attention", n, STRIDE, width)), self.low)
        attention *= _fade(STRIDE, inputs.shape[1])
        per = 1 / _sums(attention)
        gathered = np.matmul(attention, values)
        gathered *= per
        shares = _exp(asks[..., WIDTH:] + gathered, self.low)
        shares /= _sums(shares)
        return shares, attention, per, gathered, queries, keys, values

    def score(self, texts: Sequence[np.ndarray]) -> np.ndarray:
        """The log10 probability of each text, its end included."""
        out = np.zeros(len(texts))
        for inputs, targets, scored, text in self.windows(texts):
            p = np.einsum("bqk,bqk->bq", self.shares(inputs)[0], self.topics.take(targets, 0))
            out += np.bincount(text, np.where(scored, np.log10(p), 0).sum(1, dtype=np.float64), len(texts))
        return out

    def fit(self, texts: Sequence[np.ndarray], epochs: int = EPOCHS, rate: float = RATE) -> Attention:
        """Attention, gates and embeddings by Adam on the log-likelihood; topics by running responsibilities."""
        random = np.random.default_rng(11)
        counts = np.bincount(np.concatenate([*texts, np.zeros(0, np.int64)]), minlength=self.size).astype(np.float64)
        floor = self._floor(counts)
        held = floor + counts[:, None] * random.dirichlet(np.ones(TOPICS) * 0.5, self.size) * 0.2
        self.moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in _LEARNT}
        self.steps = 0
        batches = list(self.windows(texts))
        for epoch in range(epochs):
            self.seen = np.zeros_like(held)
            for b in random.permutation(len(batches)):
                inputs, targets, scored, _ = batches[b]
                if self.steps % 8 == 0:
                    mixed = held + self.seen
                    self.topics = (mixed / mixed.sum(0)).astype(np.float32)
                self._tables()
                grads, of_targets, blame, of_inputs, sums = self.gradients(inputs, targets, scored)
                grads["embed"] = np.zeros((self.size, WIDTH))
                self._add_rows(self.seen, of_targets, blame)
                self._add_rows(grads["embed"], of_inputs, sums)
                self._step(grads, scored.sum(), rate)
            held = floor + self.seen
        self.topics = (held / held.sum(0)).astype(np.float32)
        self._tables()
        return self

    def _floor(self, counts: np.ndarray) -> np.ndarray:
        """What every topic holds of each id before any responsibility: its smoothed share of all tokens."""
        return ((counts + 0.5) / (counts.sum() + 0.5 * self.size))[:, None] * 30.0 * np.ones(TOPICS)

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, scored: np.ndarray) -> tuple:
        """Of one batch: summed gradients of the matrices by name, then ids and their responsibilities, then ids and
        their gradients of the embedding."""
        shares, attention, per, gathered, queries, keys, values = self.shares(inputs)
        width, unscored = inputs.shape[1], ~scored
        # Behind queries' and keys' gradients stand those of gates and values.
        of_last = self._room("of_last", len(inputs), STRIDE, WIDTH + TOPICS)
        of_all = self._room("of_all", len(inputs), width, WIDTH + TOPICS)
        blame = shares * self.topics.take(targets, 0)
        blame *= (scored / np.einsum("bqk->bq", blame)).astype(np.float32)[..., None]
        up = of_last[..., WIDTH:]
        np.subtract(shares, blame, out=up)
        up[unscored] = 0
        divided = up * per
        to_scores = np.matmul(divided, values.transpose(0, 2, 1), out=self._room("to_scores", len(inputs), STRIDE, width))
        to_scores -= np.einsum("bqk,bqk->bq", gathered, divided)[..., None]
        to_scores *= attention
        flat = lambda a: a.reshape(-1, a.shape[-1])
        np.matmul(to_scores, keys, out=of_last[..., :WIDTH])
        np.matmul(to_scores.transpose(0, 2, 1), queries, out=of_all[..., :WIDTH])
        np.matmul(attention.transpose(0, 2, 1), divided, out=of_all[..., WIDTH:])
        of_last, of_all = flat(of_last), flat(of_all)
        x = self.embed.take(inputs, 0, self._room("x", len(inputs), width, WIDTH), "clip")
        query_gate = flat(np.ascontiguousarray(x[:, -STRIDE:])).T @ of_last
        key_value = flat(x).T @ of_all
        grads = {
            "query": query_gate[:, :WIDTH],
            "key": key_value[:, :WIDTH],
            "value": key_value[:, WIDTH:],
            "gate": query_gate[:, WIDTH:],
        }
        of_x = (of_all @ np.concatenate([self.key, self.value], 1).T).reshape(x.shape)
        of_x[:, -STRIDE:] += (of_last @ np.concatenate([self.query, self.gate], 1).T).reshape(shares.shape)
        return grads, targets.ravel(), flat(blame), inputs.ravel(), flat(of_x)

    def _add_rows(self, total: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Add the rows of each id to its row of ``total``. A batch is sorted by id while it lies in the cache."""
        if len(ids):
            order = np.argsort(ids.astype(np.uint16) if self.size <= 1 << 16 else ids, kind="stable")
            ids = ids[order]
            first = np.flatnonzero(np.diff(ids, prepend=-1))
            total[ids[first]] += np.add.reduceat(rows[order], first, axis=0)

    def _step(self, grads: dict[str, np.ndarray], tokens: float, rate: float) -> None:
        """One step of Adam down the gradient of a mean token."""
        self.steps += 1
        for n in _LEARNT:
            m, v = self.moments[n]
            g = (grads[n] / tokens).astype(np.float32)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            fix = np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            getattr(self, n)[...] -= rate * fix * m / (np.sqrt(v) + 1e-8)

    def sums(self, texts: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """What a round learns from texts: numbers of rows, and the rows in multiples of UNIT. The row of an id is its
        responsibilities and gradients; behind all ids stand the gradients of the matrices."""
        held = np.zeros(self.size, bool)
        # Windows begin with an end and are filled up with id 0.
        held[[0, self.end]] = True
        for text in texts:
            held[text] = True
        ids, place = np.flatnonzero(held), np.cumsum(held) - 1
        seen, embed = _RowSums(len(ids), TOPICS), _RowSums(len(ids), WIDTH)
        small = np.zeros((len(_LEARNT) - 1, WIDTH * TOPICS))
        for inputs, targets, scored, _ in self.windows(texts):
            grads, of_targets, blame, of_inputs, rows = self.gradients(inputs, targets, scored)
            for i, n in enumerate(_LEARNT[1:]):
                small[i] += grads[n].ravel()
            seen.add(place[of_targets], blame)
            embed.add(place[of_inputs], rows)
        small = small.reshape(-1, TOPICS + WIDTH)
        total = np.concatenate([np.concatenate([seen.total(), embed.total()], 1), small])
        return np.append(ids, self.size + np.arange(len(small))), np.rint(total / UNIT).astype(np.int64)

    def begin(self, counts: np.ndarray) -> None:
        """Before the first round: the ids' ``counts`` in all training texts, dealt to topics at random."""
        random = np.random.default_rng(11)
        self.moments = {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in _LEARNT}
        self.steps = 0
        self.seen = counts[:, None] * random.dirichlet(np.ones(TOPICS) * 0.5, self.size) * (0.2 / ROUNDS)
        self.mix(counts)

    def advance(self, sums: np.ndarray, counts: np.ndarray, rate: float = ROUND_RATE) -> None:
        """Topics by the responsibilities of the rounds so far, the rest one step on by those of the last."""
        sums = sums * UNIT
        seen, embed, small = sums[: self.size, :TOPICS], sums[: self.size, TOPICS:], sums[self.size :]
        small = small.reshape(len(_LEARNT) - 1, WIDTH, TOPICS)
        self.seen = ROUND_KEEPS * self.seen + seen
        self._step({"embed": embed, **dict(zip(_LEARNT[1:], small, strict=True))}, max(1.0, seen.sum()), rate)
        self.mix(counts)

    def mix(self, counts: np.ndarray) -> None:
        """Topics hold each id as often as all training texts do; responsibilities tell which topic how much of it."""
        total = self.seen.sum(1, keepdims=True)
        shares = np.divide(self.seen, total, out=np.full_like(self.seen, 1 / TOPICS), where=total > 0)
        held = self._floor(counts) + counts[:, None] * shares
        self.topics = (held / held.sum(0)).astype(np.float32)
        self._tables()

    def __getstate__(self) -> dict:
        """Tasks need no state of the training, and make the tables of ids themselves."""
        return {k: v for k, v in self.__dict__.items() if k not in ("moments", "seen", "seen_as", "asks", "low", "rooms")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._tables()


class _RowSums:
    """The sums of the rows of each id below ``size``. Rows wait until there are SUM_ROWS, so that the table of sums is
    gone through once for many batches."""

    def __init__(self, size: int, width: int):
        self.sums = np.zeros((size, width))
        # The cells of each row, as one vector holds them.
        self.cells = np.arange(size * width).reshape(size, width)
        self.ids, self.rows, self.waiting = [], [], 0

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids.append(ids)
        self.rows.append(rows)
        self.waiting += len(ids)
        if self.waiting >= SUM_ROWS:
            self.total()

    def total(self) -> np.ndarray:
        if self.waiting:
            size, width = self.sums.shape
            cells = self.cells.take(np.concatenate(self.ids), 0)
            self.sums += np.bincount(cells.ravel(), np.concatenate(self.rows).ravel(), size * width).reshape(size, width)
            self.ids, self.rows, self.waiting = [], [], 0
        return self.sums


def held_out(key) -> bool:
    """Whether a document is kept from training: crc32 of its id as text, modulo FOLDS; a null id is an empty text."""
    return zlib.crc32(b"" if key is None else str(key).encode()) % FOLDS == HELD_OUT


def train(prepared: DataFrame, tokenizer: str) -> Attention:
    """The attention model, learnt from all training documents, whole, however long they are.

    Tokens of all training documents, as ``prepare`` wrote them, are counted in Spark. Then each document is in one of
    the rounds, dealt by its place in its slice; a round sums topic responsibilities and gradients in Spark. What comes to
    the driver has the size of the vocabulary.
    """
    model = Attention(WordTokens(tokenizer).library.get_vocab_size())
    size = model.size

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n = np.zeros(size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                for t in _round_texts(blob):
                    n += np.bincount(t, minlength=size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["id", "c0"])

    kept = prepared.where("part < 0").select("ids")
    cores = prepared.sparkSession.sparkContext.defaultParallelism
    kept = kept.coalesce(spread(kept, ROUND_MB, F.octet_length("ids"), cores))
    counts = _summed(kept, count, 1, size)[:, 0]
    model.begin(counts)
    rows = size + (len(_LEARNT) - 1) * WIDTH * TOPICS // (TOPICS + WIDTH)
    # Each text has one end.
    rounds = min(ROUNDS, max(1, int(counts[model.end]) // TRAIN_TEXTS)) if counts.any() else 0
    for number in range(rounds):
        shared = prepared.sparkSession.sparkContext.broadcast(model)

        def learn(batches: Iterator, shared=shared, number=number) -> Iterator:
            import pyarrow as pa

            total = np.zeros((rows, TOPICS + WIDTH), np.int64)
            for batch in batches:
                for blob in batch.column(0).to_pylist():
                    texts = _round_texts(blob, number, rounds)
                    if texts:
                        at, sums = shared.value.sums(texts)
                        total[at] += sums
            at = np.flatnonzero(total.any(1))
            columns = [pa.array(at), *[pa.array(c) for c in total[at].T]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *[f"c{i}" for i in range(total.shape[1])]])

        model.advance(_summed(kept, learn, TOPICS + WIDTH, rows), counts)
        # Also its file on the driver goes.
        shared.destroy()
    return model


@lru_cache(maxsize=1)
def _tokens(tokenizer: str) -> WordTokens:
    """Once per worker process: later tasks know the pieces of earlier ones."""
    return WordTokens(tokenizer, KNOWN_PIECES)


def read_words(tokens: WordTokens, column, end: int) -> tuple[np.ndarray, ...]:
    """The number of words of each text; the distinct hashes of lower-cased words, and which of them each word in a row
    has; the ids of the texts with ``end`` behind each, and the places between the texts.

    No piece of the tokenizer's spans white space, so each spelling of a word is encoded once in each part of the texts.
    Spellings are told apart in upper and lower case, which special tokens are found by.
    """
    import pyarrow as pa

    counts, sizes, hashes, which, ids = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [], [np.zeros(0, np.int64)], []
    known = 0
    for a, b in column_slices(column, ENCODE_BYTES):
        data, offsets = text_buffers(column.slice(a, b - a))
        low = lower_ascii(data)
        starts, ends, upto = word_spans(low, offsets, SPACED_WORD_BYTES)
        lowered = span_hashes(low, starts, ends)
        spelt = lowered.copy()
        upper = np.unique(np.searchsorted(starts, np.flatnonzero(data != low), side="right") - 1)
        spelt[upper] = span_hashes(data, starts[upper], ends[upper])
        distinct, of = np.unique(spelt, return_inverse=True)
        one = np.empty(len(distinct), np.int64)
        one[of] = np.arange(len(of))
        size = ends[one] - starts[one]
        borders = np.concatenate([[0], np.cumsum(size)])
        octets = data[ranges(starts[one], size)]
        words = pa.LargeStringArray.from_buffers(len(one), pa.py_buffer(borders), pa.py_buffer(octets))
        flat, at = tokens.encode(words)
        of_word = np.diff(at)[of]
        ids.append(flat[ranges(at[:-1][of], of_word)])
        sizes.append(np.diff(np.concatenate([[0], np.cumsum(of_word)])[upto]))
        counts.append(np.diff(upto))
        hashes.append(lowered[one])
        which.append(known + of)
        known += len(one)
    word, of = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashes]), return_inverse=True)
    flat = np.concatenate([np.zeros(0, np.uint32), *ids])
    return np.concatenate(counts), word, of[np.concatenate(which)], *with_ends(flat, np.cumsum(np.concatenate(sizes)), end)


def _places(out: np.ndarray) -> np.ndarray:
    """The part of a slice that each text lies in: one for each of the ROUNDS, then that of all held-out texts."""
    return np.where(out, ROUNDS, (np.cumsum(~out) - 1) % ROUNDS)


def _dealt(ids: np.ndarray, borders: np.ndarray, out: np.ndarray) -> bytes:
    """The ids of a slice in parts, so that a round unpacks what it learns from and no more."""
    import pickle

    parts, places = [], _places(out)
    for place in range(ROUNDS + 1):
        mine = np.flatnonzero(places == place)
        size = borders[mine + 1] - borders[mine]
        part = ids[ranges(borders[mine], size)], np.concatenate([[0], np.cumsum(size)]), np.zeros(len(mine), bool)
        parts.append(_blob(*part))
    return pickle.dumps(parts)


def _texts(dealt: bytes, out: np.ndarray) -> list[np.ndarray]:
    """The ids of each text of a slice, of which ``out`` are held out."""
    import pickle

    parts = [iter(_training_texts(part)) for part in pickle.loads(dealt)]
    return [next(parts[place]) for place in _places(out).tolist()]


def _round_texts(dealt: bytes, number: int = 0, rounds: int = 1) -> list[np.ndarray]:
    """The ids of a slice's training texts, or of those in one of the rounds."""
    import pickle

    parts = pickle.loads(dealt)[:ROUNDS]
    if rounds == ROUNDS:
        return _training_texts(parts[number])
    found = [_training_texts(part) for part in parts]
    return [found[i % ROUNDS][i // ROUNDS] for i in range(number, sum(map(len, found)), rounds)]


def _training_texts(blob: bytes, first: int = 0, step: int = 1) -> list[np.ndarray]:
    """The ids of every ``step``-th text that is not held out, from the ``first`` on."""
    ids, borders, out = _arrays(blob)
    return [ids[borders[i] : borders[i + 1]].astype(np.int64) for i in np.flatnonzero(~out)[first::step].tolist()]


def _summed(kept: DataFrame, run, width: int, rows: int) -> np.ndarray:
    """The rows that tasks of ``run`` send, whole numbers, summed by id."""
    names = [f"c{i}" for i in range(width)]
    sent = kept.mapInArrow(tidy(run), ", ".join(["id long", *[f"{n} long" for n in names]]))
    found = sent.groupBy("id").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((rows, width), np.int64)
    if found.num_rows:
        out[found.column("id").to_numpy()] = np.stack([found.column(n).to_numpy() for n in names], 1)
    return out


def _blob(*arrays: np.ndarray) -> bytes:
    import pickle

    import zstandard

    return zstandard.compress(pickle.dumps([np.ascontiguousarray(a) for a in arrays], protocol=5), 1)


def _arrays(blob: bytes) -> list[np.ndarray]:
    import pickle

    import zstandard

    return pickle.loads(zstandard.decompress(blob))


def prepare(docs: DataFrame, tokenizer: str, groups: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Everything that is read off the texts, in one pass and written out: ``part, run, blob, ids``.

    For each slice of texts (``run``) one row with ``part`` below 0: keys, folds and the table of words per document
    in ``blob``, subword ids in ``ids``; and one row for each hash group (``part``) of its distinct words, with how
    often training documents have them.
    """
    rows = in_small_batches(docs).select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        tokens = _tokens(tokenizer)
        end = tokens.library.get_vocab_size()
        short = np.uint16 if end < 1 << 16 else np.uint32
        number = 0
        for batch in batches:
            for part in slices(batch, SLICE_BYTES):
                run = TaskContext.get().partitionId() << 24 | number
                number += 1
                n = part.num_rows
                words, word, of, ids, borders = read_words(tokens, part.column(1), end)
                row = np.concatenate([np.repeat(np.arange(n), words), np.arange(n)])
                # The end takes its place among the words, which are in order.
                place = int(np.searchsorted(word, END_WORD))
                word = np.insert(word, place, END_WORD)
                of = np.concatenate([of + (of >= place), np.full(n, place)])
                out = np.array([held_out(k) for k in part.column(0).to_pylist()], bool)
                trained = np.bincount(of[~out[row]], minlength=len(word))
                cell, times = np.unique(row * len(word) + of, return_counts=True)
                group = ((word >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
                per_row = np.bincount(cell // len(word), minlength=n)
                keys = pa.BufferOutputStream()
                with pa.ipc.new_stream(keys, pa.schema([("id", part.column(0).type)])) as stream:
                    stream.write_batch(pa.RecordBatch.from_arrays([part.column(0)], names=["id"]))
                known = _blob(
                    np.frombuffer(keys.getvalue(), np.uint8),
                    out,
                    per_row.astype(np.uint32),
                    (cell % len(word)).astype(np.uint32),
                    times.astype(np.uint32),
                )
                parts, blobs = [-1 - run], [known]
                for g in np.unique(group).tolist():
                    a, b = np.searchsorted(group, g), np.searchsorted(group, g, side="right")
                    parts.append(g)
                    blobs.append(_blob(word[a:b], trained[a:b].astype(np.uint32)))
                packed = [_dealt(ids.astype(short), borders, out), *[None] * (len(parts) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(parts, pa.int64()),
                        pa.array([run] * len(parts), pa.int64()),
                        pa.array(blobs, pa.binary()),
                        pa.array(packed, pa.binary()),
                    ],
                    names=["part", "run", "blob", "ids"],
                )

    return stored(rows.mapInArrow(tidy(read), "part long, run long, blob binary, ids binary"))


def score(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: held_out, n_tokens, n_known, train_tokens, base_score and score.

    Word counts cover all training documents: each slice of texts sends its distinct word hashes (64 bits) with its
    training counts to hash groups, whose summed counts go back to the slice, in the order they were asked for. A
    group's frequent word is one entry a slice, so no word is a hot key. Texts are read and encoded once; the
    attention model learns from and scores the whole texts' ids that this pass wrote.

    Null or empty text: the end alone. A null id belongs to the fold of the empty text. Repeated rows: each counts.
    No rows: no rows. Other columns are not read, whatever their names.
    """
    groups = spread(docs.select(F.col(text).cast("string").alias("text")), GROUP_MB, F.octet_length("text"))
    prepared = prepare(docs, tokenizer, groups, key, text)
    shared = docs.sparkSession.sparkContext.broadcast(train(prepared, tokenizer))

    def meet(group):
        import pandas as pd

        blocks = [_arrays(b) for b in group["blob"]]
        words = np.concatenate([b[0] for b in blocks])
        distinct, of = np.unique(words, return_inverse=True)
        totals = np.bincount(of, np.concatenate([b[1] for b in blocks]), len(distinct)).astype(np.int64)
        ends = np.cumsum([len(b[0]) for b in blocks])
        blobs = [_blob(totals[of[e - len(b[0]) : e]]) for b, e in zip(blocks, ends, strict=True)]
        # One more row tells how many training tokens and distinct training words the group has.
        whole = {"part": [group["part"].iloc[0]], "run": [-1], "blob": [_blob(np.array([totals.sum(), (totals > 0).sum()]))]}
        told = pd.DataFrame({"part": group["part"], "run": group["run"], "blob": blobs})
        del blocks, words, distinct, of, totals
        release_memory()
        return pd.concat([told, pd.DataFrame(whole)])

    kind = docs.schema[key].dataType
    fields = T.StructType(
        [
            T.StructField("id", kind),
            T.StructField("held_out", T.BooleanType()),
            *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")],
            *[T.StructField(c, T.DoubleType()) for c in ("logs", "score")],
        ]
    )

    def gather(own, answers):
        import pandas as pd
        import pyarrow as pa

        keys, out, per_row, word, times = _arrays(own["blob"].iloc[0])
        answers = answers.sort_values("part")
        counts = np.concatenate([_arrays(b)[0] for b in answers["blob"]])[word]
        row = np.repeat(np.arange(len(per_row)), per_row)
        ids = pa.ipc.open_stream(pa.py_buffer(keys.tobytes())).read_all().column(0)
        n = len(per_row)
        return pd.DataFrame(
            {
                "id": ids.to_pandas(types_mapper=None, integer_object_nulls=True),
                "held_out": out,
                "n_tokens": np.bincount(row, times, n).astype(np.int64),
                "n_known": np.bincount(row, times * (counts > 0), n).astype(np.int64),
                "logs": np.bincount(row, times * np.log10(counts + 1.0), n),
                "score": shared.value.score(_texts(own["ids"].iloc[0], out)),
            }
        )

    told = prepared.where("part >= 0").select("part", "run", "blob").groupBy("part")
    told = saved(told.applyInPandas(meet, "part long, run long, blob binary"))
    sums = [_arrays(r["blob"])[0] for r in told.where("run < 0").select("blob").collect()]
    tokens, words = (int(n) for n in np.sum(sums, axis=0)) if sums else (0, 0)
    own = prepared.where("part < 0").select("run", "blob", "ids").groupBy("run")
    found = own.cogroup(told.where("run >= 0").groupBy("run")).applyInPandas(gather, fields)
    return found.select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(float(np.log10(tokens + words + 1.0)))).alias("base_score"),
        "score",
    )
