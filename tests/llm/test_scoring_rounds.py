"""The attention model's rounds over all training documents."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidemark.llm import scoring
from tidemark.llm.words import WordTokens


def test_each_training_text_is_in_one_round():
    texts = [np.full(n, n, np.uint16) for n in range(1, 41)]
    borders = np.cumsum([0, *map(len, texts)])
    out = np.arange(40) % 7 == 2
    blob = scoring._blob(np.concatenate(texts), borders, out)
    found = [len(t) for r in range(5) for t in scoring._training_texts(blob, r, 5)]
    assert sorted(found) == [n for n, held in zip(range(1, 41), out, strict=True) if not held]


def test_rounds_teach_attention_without_a_start_on_a_sample():
    pick = np.random.default_rng(1)
    # Two languages without common ids: what came before tells which one goes on.
    texts = [np.append(pick.integers(0, 50, 80) + 50 * (i % 2), 100) for i in range(480)]
    train, held = texts[:440], texts[440:]
    counts = np.bincount(np.concatenate(train), minlength=101)
    model = scoring.Attention(100)
    model.begin(counts)
    for number in range(scoring.ROUNDS):
        sums = np.zeros((model.size + 32, scoring.TOPICS + scoring.WIDTH), np.int64)
        at, rows = model.sums(train[number :: scoring.ROUNDS])
        sums[at] += rows
        model.advance(sums, counts)
    # Better than the shares of all tokens, where each id has one in a hundred.
    assert model.score(held).sum() / (40 * 81) > -np.log10(80)


def test_scores_of_attention_that_are_all_low_stay_finite():
    model = scoring.Attention(30)
    model.query *= 1e4
    model._tables()
    assert np.isfinite(model.score([np.arange(64) % 30])).all()
    assert all(np.isfinite(rows).all() for rows in model.sums([np.arange(64) % 30]))


def test_rows_are_summed_by_id_for_many_batches_at_a_time(monkeypatch):
    """The sums do not depend on how many batches wait, and the table of sums is gone through once for all that do."""
    random = np.random.default_rng(1)
    batches = [(random.integers(0, 50, 96), random.normal(size=(96, 4)).astype(np.float32)) for _ in range(20)]
    expected = np.zeros((50, 4))
    for ids, rows in batches:
        np.add.at(expected, ids, rows.astype(np.float64))
    counted = []
    bincount = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *a: (counted.append(1), bincount(*a))[1])
    for wait, times in ((1, 20), (96 * 5, 4), (1 << 20, 1)):
        monkeypatch.setattr(scoring, "SUM_ROWS", wait)
        counted.clear()
        sums = scoring._RowSums(50, 4)
        for ids, rows in batches:
            sums.add(ids, rows)
        assert np.allclose(sums.total(), expected)
        assert len(counted) == times


def test_spellings_are_encoded_once_and_as_whole_texts_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["The cat, the CAT and the Cat " * 50, "", None, " \n", "<|endoftext|> <|ENDOFTEXT|> É é CAN'T can't " * 20, "日本 Ab日本"]
    plain, tokens = WordTokens(path), WordTokens(path)
    end = plain.library.get_vocab_size()
    given, encode = [], tokens.encode
    tokens.encode = lambda column: (given.extend(column.to_pylist()), encode(column))[1]
    counts, word, of, ids, borders = scoring.read_words(tokens, pa.array(texts), end)
    assert sorted(given) == sorted({w for t in texts for w in (t or "").split()})
    expected, at = plain.encode(pa.array(texts))
    found = [t.tolist() for t in np.split(ids, borders[1:-1])]
    assert found == [[*expected[a:b].tolist(), end] for a, b in zip(at[:-1], at[1:], strict=True)]
    assert counts.tolist() == [len((t or "").split()) for t in texts]
    lowered = [w.translate({c: c + 32 for c in range(65, 91)}) for t in texts for w in (t or "").split()]
    assert len(word) == len(set(lowered)) == len({*zip(lowered, of.tolist(), strict=True)})
    assert (np.diff(word.astype(object)) > 0).all()


def test_pieces_and_work_arrays_are_kept():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert scoring._tokens(path) is scoring._tokens(path)
    model = scoring.Attention(30)
    batch = np.arange(96 * 48).reshape(96, 48) % 30
    first, second = (model.shares(batch)[1] for _ in range(2))
    assert first is second or np.shares_memory(first, second)


def test_a_round_unpacks_its_own_texts_only(monkeypatch):
    for n in (1, 15, 16, 40, 100):
        texts = [np.full(i % 9, i, np.uint16) for i in range(n)]
        out = np.arange(n) % 7 == 2
        dealt = scoring._dealt(np.concatenate(texts), np.cumsum([0, *map(len, texts)]), out)
        assert [t.tolist() for t in scoring._texts(dealt, out)] == [t.tolist() for t in texts]
        trained = [t.tolist() for t, held in zip(texts, out, strict=True) if not held]
        for rounds in (1, 3, scoring.ROUNDS):
            for r in range(rounds):
                assert [t.tolist() for t in scoring._round_texts(dealt, r, rounds)] == trained[r::rounds]
    unpacked, arrays = [], scoring._arrays
    monkeypatch.setattr(scoring, "_arrays", lambda blob: (unpacked.append(len(blob)), arrays(blob))[1])
    scoring._round_texts(dealt, 3, scoring.ROUNDS)
    assert len(unpacked) == 1
